"""Report tables: cleaning with quarantine, label splits, wide pivots, records to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import column_name, strip_prefix, variable_slug
from ..functions.numbers import parse_number
from ..functions.text import squeeze, truncate
from ..shared import materialize
from .dedup import first_by

# Descriptors that are split or dropped, and the measures that stay.
DESCRIPTOR_A, DESCRIPTOR_B, DROPPED_DESCRIPTOR = "2.2.a.1", "2.2.b.2", "1.1.b.1"
KEPT_MEASURES = ("Punteggio medio", "Diff. ESCS (*)")
SPLIT_NAMES = [f"split_a{k}" for k in (1, 2, 3)] + [f"split_b{k}" for k in (1, 2, 3, 4, 5)]
DROPPED_COLUMNS = ("heading", "school_level", "descriptor_name")
#: Why rows are dropped, as ``drop_reason`` names it.
DROP_REASONS = ("descriptor", "label", "measure")
MAX_EXAMPLES = 25


def drop_reason(measures: tuple[str, ...] = KEPT_MEASURES) -> Column:
    """Why a row is dropped, null if it stays; reasons are tried in this order."""
    descriptor, label = F.trim(F.coalesce("descriptor", F.lit(""))), F.trim(F.coalesce("column_label", F.lit("")))
    return (
        F.when(descriptor == DROPPED_DESCRIPTOR, F.lit("descriptor"))
        .when(label == "label", F.lit("label"))
        .when((descriptor == DESCRIPTOR_A) & ~label.isin(*measures), F.lit("measure"))
    )


def split_reports(rows: DataFrame, measures: tuple[str, ...] = KEPT_MEASURES) -> DataFrame:
    """Adds ``drop_reason``, the eight split columns (empty where they don't apply) and ``error`` to (descriptor, heading, column_label, …)."""
    # step by step: each step is a column of its own, so that no step is worked out once for each use
    is_a, is_b = F.trim("descriptor") == DESCRIPTOR_A, F.trim("descriptor") == DESCRIPTOR_B
    out = rows.withColumn("drop_reason", drop_reason(measures))
    out = out.withColumn("_left", F.split(F.when(is_a, F.coalesce("heading", F.lit(""))), " - ", 2))
    out = out.withColumn("_right", F.split(F.get("_left", F.lit(1)), r" \| ", 2))
    out = out.withColumn("_dash", F.split(F.when(is_b, strip_prefix(F.col("column_label"))), " - ", 3))
    out = out.withColumn("_bar", F.split(F.get("_dash", F.lit(2)), r" \| ", 3))
    error = (
        F.when(F.size("_left") == 1, F.lit('missing " - "'))
        .when(F.size("_right") == 1, F.lit('missing " | " after " - "'))
        .when(F.col("_dash").isNotNull() & (F.size("_dash") < 3), F.lit('not enough " - "'))
        .when(F.col("_bar").isNotNull() & (F.size("_bar") < 3), F.lit('not enough " | "'))
    )
    out = out.withColumn("error", F.when(F.col("drop_reason").isNull(), error))
    places = [("_left", 0), ("_right", 0), ("_right", 1), ("_dash", 0), ("_dash", 1), ("_bar", 0), ("_bar", 1), ("_bar", 2)]
    parts = {name: F.coalesce(squeeze(F.get(c, F.lit(k))), F.lit("")) for name, (c, k) in zip(SPLIT_NAMES, places, strict=True)}
    return out.withColumns(parts).drop("_left", "_right", "_dash", "_bar")


class BadRows(ValueError):
    """Rows whose labels can't be split; ``examples`` has some of them."""

    def __init__(self, examples: list):
        super().__init__(f"labels can't be split, for example: {[r.asDict() for r in examples[:3]]}")
        self.examples = examples


def clean_columns(split: DataFrame) -> DataFrame:
    """The columns that clean rows of ``split_reports`` keep."""
    return split.drop("drop_reason", "error", *DROPPED_COLUMNS)


def bad_columns(split: DataFrame) -> DataFrame:
    """The columns that rows in quarantine keep."""
    return split.drop("drop_reason", *SPLIT_NAMES)


def bad_examples(bad: DataFrame) -> list:
    """Up to 25 of the bad rows, with their labels cut short."""
    return bad.withColumns({c: truncate(F.col(c), 300) for c in ("heading", "column_label") if c in bad.columns}).limit(MAX_EXAMPLES).collect()


def clean_reports(rows: DataFrame, on_bad: str = "fail", measures: tuple[str, ...] = KEPT_MEASURES) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows). With ``on_bad="fail"`` any bad row raises ``BadRows`` with up to 25 examples."""
    split = split_reports(rows, measures)
    bad = bad_columns(split.where(F.col("error").isNotNull()))
    if on_bad == "fail" and (examples := bad_examples(bad)):
        raise BadRows(examples)
    return clean_columns(split.where(F.col("drop_reason").isNull() & F.col("error").isNull())), bad


def measure_kind(label: Column) -> Column:
    """``punteggio_medio`` or ``diff_escs`` by the label of a column, else null."""
    s = F.lower(F.coalesce(label, F.lit("")))
    return F.when(s.contains("punteggio medio"), F.lit("punteggio_medio")).when(s.contains("diff") & s.contains("escs"), F.lit("diff_escs"))


def named_values(clean: DataFrame, prefix_a: str = "80_rav_22a1_invalsipunteggiomedio_", prefix_b: str = "80_rav_22b2_variabilitapunteggi_") -> DataFrame:
    """(entity_id, name, v, src_ord): the wide column that each clean row of either descriptor feeds, and its number."""
    kind = measure_kind(F.col("column_label"))
    name_a = F.when((F.col("descriptor") == DESCRIPTOR_A) & kind.isNotNull(), column_name(prefix_a, F.col("split_a1"), F.col("split_a2"), F.col("split_a3"), kind))
    name_b = F.when(F.col("descriptor") == DESCRIPTOR_B, column_name(prefix_b, *[F.col(f"split_b{k}") for k in (1, 2, 3, 4, 5)]))
    named = clean.select("entity_id", F.coalesce(name_a, name_b).alias("name"), parse_number(F.col("value"), "decimal_comma").alias("v"), "src_ord")
    return named.where(F.col("name").isNotNull())


def pivot_first(rows: DataFrame, keys: list[str], name: str, value: str, order: str, names: list[str] | None = None) -> DataFrame:
    """One row for each key with the first value of every name as a column. ``names`` saves the pass that finds them.

    First one aggregate by key and name, which is written; the names are found in it and it is turned, so that
    neither the expressions behind a name nor the rows are worked out once for each column.
    """
    firsts = rows.groupBy(*keys, F.col(name).alias("_name")).agg(first_by(F.col(value), F.col(order)).alias("_first"))
    firsts = materialize(firsts, "pivot-first")
    if names is None:
        most = int(rows.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        names = sorted(r[0] for r in firsts.where("_name IS NOT NULL").select("_name").distinct().limit(most + 1).collect())
        if len(names) > most:
            raise ValueError(f"more than {most} names")
    if not names:
        return firsts.select(*keys).distinct()
    one = lambda n: F.max(F.when(F.col("_name") == n, F.col("_first"))).alias(n)  # noqa: E731  a key has one row for a name
    return firsts.groupBy(*keys).agg(*[one(n) for n in names])


def report_wide(clean: DataFrame) -> DataFrame:
    """One row for each entity with a column for each computed name.

    The clean rows are written first: names and splits in one loop would be too much code to compile.
    """
    return pivot_first(named_values(materialize(clean, "report-clean")), ["entity_id"], "name", "v", "src_ord")


def report_pivot(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Report rows by their index columns with a text column for each slug of the label; null keys are kept."""
    return pivot_first(rows.withColumn("_slug", F.nullif(variable_slug(F.col("column_label")), F.lit(""))), keys, "_slug", "value", "src_ord")


def records_to_long(df: DataFrame, keys: list[str], label: Column, fields: list[str]) -> DataFrame:
    """A row ``label`` and one for each field of every record: (keys, column_label, value).

    Booleans become ``1`` and ``0``, null empty.
    """
    types = dict(df.dtypes)
    text = lambda c: F.when(F.col(c), F.lit("1")).when(~F.col(c), F.lit("0")) if types[c] == "boolean" else F.col(f"`{c}`").cast("string")
    cells = [F.struct(F.lit("label").alias("column_label"), F.coalesce(label.cast("string"), F.lit("")).alias("value"))]
    cells += [F.struct(F.lit(c).alias("column_label"), F.coalesce(text(c), F.lit("")).alias("value")) for c in fields]
    return df.select(*keys, F.inline(F.array(*cells)))
