"""Blocks of wide columns, each derived from one endpoint of the long table.

The long table is read once. ``summarize`` reduces it to one row for each entity,
endpoint and what a block tells apart there (category, year, scope), with the first value, count and sum; tasks
combine before the shuffle. All else is taken from this small table, which is written: in which endpoints and areas
any row is in scope, which categories and years there are, and the wide columns themselves, all blocks in one aggregation.
A block whose columns come from the data gathers a map in it, from category to first value, instead of an aggregate for each.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import year_index
from ..functions.text import slug_or
from ..shared import materialize, small_enough
from .dedup import first_by

# Midpoints of grade bins, and which bins are low and top.
EXAM_BINS = {"60": 60.0, "61_70": 65.5, "71_80": 75.5, "81_90": 85.5, "91_99": 95.0, "100": 100.0, "100_e_lode": 101.0}
EXAM_LOW, EXAM_TOP = ("60", "61_70"), ("91_99", "100", "100_e_lode")
MIDDLE_BINS = {"6": 6.0, "7": 7.0, "8": 8.0, "9": 9.0, "10": 10.0, "10_e_lode": 11.0}
MIDDLE_LOW, MIDDLE_TOP = ("6", "7"), ("10", "10_e_lode")


def whole_scope(category: Column | None = None, level: Column | None = None, word: str = "scuola") -> Column:
    """Whether a row is about the whole entity, by its category or its level."""
    same = lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))) == word
    return same(F.col("category") if category is None else category) | same(F.col("level") if level is None else level)


def with_scope_fallback(obs: DataFrame, scope: Column, by: list[str]) -> DataFrame:
    """Rows in scope; of each group of ``by`` in which no row is, all rows.

    The groups are endpoints (and areas): a small table that is joined back.
    """
    marked = obs.withColumn("_scope", F.coalesce(scope, F.lit(False)))
    some = marked.groupBy(*by).agg(F.bool_or("_scope").alias("_some"))
    return marked.join(some, by).where(F.col("_scope") | ~F.col("_some")).drop("_scope", "_some")


def slope_by_position(values: list[Column]) -> Column:
    """Least-squares slope of the values over 1, 2, …, nulls left out; null for under two points."""
    points = F.filter(F.array(*[F.struct(F.lit(float(k)).alias("x"), v.cast("double").alias("y")) for k, v in enumerate(values, 1)]), lambda p: p["y"].isNotNull())
    total = lambda f: F.aggregate(points, F.lit(0.0), lambda a, p: a + f(p))
    n = F.size(points)
    mx, my = total(lambda p: p["x"]) / n, total(lambda p: p["y"]) / n
    return F.when(n >= 2, total(lambda p: (p["x"] - mx) * (p["y"] - my)) / F.nullif(total(lambda p: (p["x"] - mx) * (p["x"] - mx)), F.lit(0.0)))


def row_mean(columns: list[Column]) -> Column:
    """Mean of the values that aren't null; null if there are none."""
    values = F.filter(F.array(*[c.cast("double") for c in columns]), lambda v: v.isNotNull()) if columns else F.array().cast("array<double>")
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.nullif(F.size(values), F.lit(0))


#: Areas and endpoints whose scopes are broadcast at most.
BROADCAST_SCOPES = 100_000


@dataclass(frozen=True)
class Block:
    """Columns out of the rows of one endpoint; ``value`` and ``order`` are columns of the long table.

    ``needs`` says what of a row the block tells apart: ``cat``, ``year``, ``scope``. The aggregates run over a summary.
    """

    endpoint: str
    prefix: str = ""
    value: str = "value_num"
    order: str = "src_ord"
    scoped: bool = False

    @property
    def needs(self) -> frozenset[str]:
        return frozenset(["scope"] if self.scoped else [])

    #: The column of the summary whose values become columns, if they aren't listed.
    open_by = None

    def rows(self) -> Column:
        here = (F.col("_ep") == self.endpoint) & (self.count > 0)
        return here & F.col("_kept") if self.scoped else here

    @property
    def first(self) -> Column:
        return F.col(f"_first_{self.value}")

    @property
    def at(self) -> Column:
        return F.col(f"_ord_{self.value}")

    @property
    def count(self) -> Column:
        return F.col(f"_n_{self.value}")

    @property
    def total(self) -> Column:
        return F.col(f"_sum_{self.value}")

    def first_where(self, here: Column) -> Column:
        return first_by(self.first, self.at, here)

    def aggregates(self, found: list) -> dict[str, Column]:
        """Aggregates by column name; ``found`` has the values of ``open_by``, in order."""
        raise NotImplementedError

    def finish(self, wide: DataFrame, found: list) -> DataFrame:
        """What is left to do once the aggregates are there."""
        return wide


@dataclass(frozen=True)
class Years(Block):
    """First value of each year, mean of all, mean of years 1 and 2, slope over years 1 to 5.

    ``years`` lists the years with a column of their own; without a list those that the data have get one, calendar years too.
    """

    label: str = ""
    years: tuple[int, ...] | None = None

    @property
    def needs(self) -> frozenset[str]:
        return super().needs | {"year"}

    @property
    def open_by(self) -> str | None:
        return "_year" if self.years is None else None

    def aggregates(self, found: list) -> dict[str, Column]:
        y, here = F.col("_year"), self.rows()
        out = {f"{self.label}_y{k}": self.first_where(here & (y == k)) for k in (found if self.years is None else self.years)}
        whole = (F.col("_ep") == self.endpoint) & F.col("_whole")
        whole = whole & F.col("_kept") if self.scoped else whole
        # an entity has one such row
        out |= {f"{self.label}_{name}": F.max(F.when(whole, F.col(f"_{name}_{self.value}"))) for name in ("mean_y", "mean_y1y2", "slope_y")}
        return {self.prefix + k: c for k, c in out.items()}


@dataclass(frozen=True)
class Total(Block):
    """Sum of the rows in scope, without fallback."""

    name: str = ""

    @property
    def needs(self) -> frozenset[str]:
        return frozenset(["scope"])

    def aggregates(self, found: list) -> dict[str, Column]:
        return {self.prefix + self.name: F.sum(F.when(self.rows() & F.col("_scope"), self.total))}


@dataclass(frozen=True)
class Single(Block):
    """The first value in scope, or at all if the endpoint has none in scope."""

    name: str = ""
    scoped: bool = True

    def aggregates(self, found: list) -> dict[str, Column]:
        return {self.prefix + self.name: self.first_where(self.rows())}


@dataclass(frozen=True)
class Outcomes(Block):
    """First value of each outcome of a fixed list, named with ``suffix``, and 100 less the first of the list."""

    label: str = ""
    outcomes: tuple[str, ...] = ("ammessi", "non_ammessi", "sospesi")
    complement: str = "tasso_non_ammessi_pct"
    suffix: str = "_pct"
    scoped: bool = True

    @property
    def needs(self) -> frozenset[str]:
        return super().needs | {"cat"}

    def aggregates(self, found: list) -> dict[str, Column]:
        first = {k: self.first_where(self.rows() & (F.col("_cat") == k)) for k in self.outcomes}
        out = {f"{self.prefix}{self.label}_{k}{self.suffix}": c for k, c in first.items()}
        out[f"{self.prefix}{self.label}_{self.complement}"] = F.lit(100.0) - first[self.outcomes[0]]
        return out


@dataclass(frozen=True)
class Bins(Block):
    """Shares in percent of the top and the low bins and the mean of the bins' midpoints, weighted by the values."""

    label: str = ""
    mids: dict[str, float] = field(default_factory=lambda: EXAM_BINS)
    low: tuple[str, ...] = EXAM_LOW
    top: tuple[str, ...] = EXAM_TOP
    scoped: bool = True

    @property
    def needs(self) -> frozenset[str]:
        return super().needs | {"cat"}

    def aggregates(self, found: list) -> dict[str, Column]:
        bin_ = F.substring("_cat", 1, 40)
        mid = reduce(lambda c, kv: c.when(bin_ == kv[0], F.lit(kv[1])), list(self.mids.items())[1:], F.when(bin_ == next(iter(self.mids)), F.lit(next(iter(self.mids.values())))))
        here, w = self.rows() & bin_.isin(*self.mids), self.total.cast("double")
        total = F.nullif(F.sum(F.when(here, w)), F.lit(0.0))
        share = lambda bins: F.coalesce(F.sum(F.when(here & bin_.isin(*bins), w)), F.lit(0.0)) / total * 100
        out = {"share_top_pct": share(self.top), "share_low_pct": share(self.low), "share_mean": F.sum(F.when(here, w * mid)) / total}
        return {f"{self.prefix}{self.label}_{k}": c for k, c in out.items()}


@dataclass(frozen=True)
class Shares(Block):
    """The first value of every category that the data have, as a column of its own, in scope or with the fallback.

    ``name`` makes the column's name out of the category's slug, of 50 characters at most. The categories become columns,
    so Spark's limit on pivot values holds for them.
    """

    name: str = "entrate_{}_pct"
    scoped: bool = True

    @property
    def needs(self) -> frozenset[str]:
        return super().needs | {"cat"}

    open_by = "_cat"

    @property
    def _map(self) -> str:
        return f"_map_{self.prefix}{self.endpoint}_{self.name}"

    def aggregates(self, found: list) -> dict[str, Column]:
        return {self._map: F.collect_list(F.when(self.rows(), F.struct(F.col("_cat").alias("cat"), self.at.alias("at"), self.first.alias("first"))))}

    def finish(self, wide: DataFrame, found: list) -> DataFrame:
        rows = F.col(f"`{self._map}`")
        wide = wide.withColumn(self._map, F.array_sort(rows))
        # of the rows of a category, which stand together, the first one counts
        before = F.concat(F.array(F.lit(None)), F.slice(rows, 1, F.greatest(F.size(rows) - 1, F.lit(0))))
        once = F.zip_with(rows, before, lambda x, p: F.when(~x["cat"].eqNullSafe(p["cat"]), F.struct(x["cat"], x["first"])))
        wide = wide.withColumn(self._map, F.map_from_entries(F.array_compact(once)))
        return wide.withColumns({self.prefix + self.name.format(c): rows[c] for c in found}).drop(self._map)


def summarize(obs: DataFrame, blocks: list[Block], key: str = "entity_id", by: tuple[str, ...] = ()) -> DataFrame:
    """The long table reduced to what the blocks tell apart, as a written table.

    One row for each key, ``by``, name (if there are names), endpoint of a block and that endpoint's category, year and scope, as far as its blocks
    need them: the first value, its order, the count and the sum of each value column. For endpoints of years one more row, ``_whole``, has the means and
    the slope of all their rows. Rows of other endpoints, and without a value, keep their entity and its name.
    """
    by_need = {need: sorted({b.endpoint for b in blocks if need in b.needs}) for need in ("cat", "year", "scope")}
    years = {scoped: {b.endpoint for b in blocks if isinstance(b, Years) and b.scoped is scoped} for scoped in (False, True)}
    if years[False] & years[True]:
        raise ValueError(f"blocks of years with and without scope on {sorted(years[False] & years[True])}")
    of = lambda eps, c, none: F.when(F.col("endpoint_key").isin(sorted(eps)), c) if eps else F.lit(None).cast(none)
    label, level = F.col("category"), F.col("level") if "level" in obs.columns else F.lit("")
    parts = [F.lit(False), F.lit(True)]
    rows = obs.withColumns(
        {
            "_ep": of({b.endpoint for b in blocks}, F.col("endpoint_key"), "string"),
            "_cat": of(by_need["cat"], slug_or(label, "cat_empty", 50), "string"),
            "_year": of(by_need["year"], year_index(label), "int"),
            "_scope": of(by_need["scope"], whole_scope(label, level), "boolean"),
        }
    )
    # after the labels are worked out, so that this is done once a row
    rows = rows.withColumn("_whole", F.explode(F.coalesce(of(by_need["year"], F.array(*parts), "array<boolean>"), F.array(parts[0]))))
    named = ["entity_name"] if "entity_name" in obs.columns else []
    apart = [F.when(~F.col("_whole"), F.col(c)).alias(c) for c in (*named, "_cat", "_year")]
    scope = F.when(~F.col("_whole") | F.coalesce(F.col("endpoint_key").isin(sorted(years[True])), F.lit(False)), F.col("_scope")).alias("_scope")
    columns = []
    for v, o in sorted({(b.value, b.order) for b in blocks}):
        value, y = F.col(v), F.col("_year")
        here, whole = F.col("_ep").isNotNull() & value.isNotNull() & ~F.col("_whole"), F.col("_whole") & y.isNotNull()
        columns += [first_by(value, F.col(o), here).alias(f"_first_{v}"), F.min(F.when(here, F.col(o))).alias(f"_ord_{v}"), F.count(F.when(here, F.lit(1))).alias(f"_n_{v}"), F.sum(F.when(here, value)).alias(f"_sum_{v}")]
        fits = whole & y.between(1, 5)
        columns += [F.avg(F.when(whole, value)).alias(f"_mean_y_{v}"), F.avg(F.when(whole & y.isin(1, 2), value)).alias(f"_mean_y1y2_{v}")]
        columns.append(F.regr_slope(F.when(fits, value), F.when(fits, y.cast("double"))).alias(f"_slope_y_{v}"))
    if named:
        columns.append(F.min("src_ord").alias("_seen"))
    return materialize(rows.groupBy(key, *by, "_whole", "_ep", *apart, scope).agg(*columns), "wide-summary")


def _with_scopes(summary: DataFrame, blocks: list[Block], by: tuple[str, ...]) -> DataFrame:
    """Adds ``_kept``: in scope, or no row of the endpoint (and area) is."""
    scoped = sorted({(b.endpoint, b.value) for b in blocks if b.scoped})
    if not scoped:
        return summary
    groups, counted = ["_ep", *by], reduce(Column.__or__, [(F.col("_ep") == e) & (F.col(f"_n_{v}") > 0) for e, v in scoped])
    some = summary.where(counted).groupBy(*groups).agg(F.bool_or("_scope").alias("_some"))
    some = F.broadcast(some) if small_enough(some, BROADCAST_SCOPES) else some
    return summary.join(some, groups, "left").withColumn("_kept", F.coalesce("_scope", F.lit(False)) | ~F.coalesce("_some", F.lit(False)))


def _open_values(rows: DataFrame, blocks: list[Block]) -> dict[Block, list]:
    """For each block without a list of its own the categories or years that it has."""
    most = int(rows.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    opened = [(k, b) for k, b in enumerate(blocks) if b.open_by]
    if not opened:
        return {}
    owns = F.array_compact(F.array(*[F.when(b.rows() & F.col(b.open_by).isNotNull(), F.struct(F.lit(k).alias("k"), F.col(b.open_by).cast("string").alias("v"))) for k, b in opened]))
    found = rows.select(F.inline(owns)).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} categories and years would become columns")
    return {k: sorted((int(r["v"]) if b.open_by == "_year" else r["v"]) for r in found if r["k"] == k) for k, b in opened}


def aggregate_summary(summary: DataFrame, blocks: list[Block], key: str = "entity_id", by: tuple[str, ...] = ()) -> DataFrame:
    """One row for each entity with the columns of all blocks; scopes are decided within ``by``, which may be less than the summary has."""
    rows = _with_scopes(summary, blocks, by)
    found = _open_values(rows, blocks)
    columns = {}
    for k, b in enumerate(blocks):
        columns |= b.aggregates(found.get(k, []))
    wide = rows.groupBy(key, *by).agg(*[c.alias(name) for name, c in columns.items()])
    for k, b in enumerate(blocks):
        wide = b.finish(wide, found.get(k, []))
    return wide


def aggregate_blocks(obs: DataFrame, blocks: list[Block], key: str = "entity_id", by: tuple[str, ...] = ()) -> DataFrame:
    """One row for each entity with the columns of all blocks, from one pass over the long table.

    Entities without any row of the blocks' endpoints keep theirs. ``by`` are further keys, such as an area, within which the scope's fallback is decided.
    """
    return aggregate_summary(summarize(obs, blocks, key, by), blocks, key, by)


def share_pivot(obs: DataFrame, endpoint: str, key: str = "entity_id", by: tuple[str, ...] = (), name: str = "entrate_{}_pct", scoped: bool = True) -> DataFrame:
    """The first value of every category of an endpoint as a column of its own, for each entity (and area)."""
    return aggregate_blocks(obs.where(F.col("endpoint_key") == endpoint), [Shares(endpoint, name=name, scoped=scoped)], key, by)
