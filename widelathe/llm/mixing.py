"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations alone.

Every document gets a reproducible 60-bit hash. For each source the tokens are
summed by hash bucket, the running sum over the buckets gives the bucket in
which the budget ends, and only that boundary bucket is looked at again with
finer buckets. What remains is one threshold for each source, so that the mix
is a filter and nothing is sorted. A source whose target is beyond its size is
taken in whole rounds plus the part below the threshold; thresholds of
different targets are nested, since a smaller one is below a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, materialize, small_enough

#: Bits of the hash that each level looks at, from the highest down. After two levels few rows are left, so the last one looks at all other bits.
LEVELS = (12, 12, 36)
HASH_BITS = sum(LEVELS)
#: Tables of a row for each source are broadcast up to this many rows.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def doc_hash(doc_id: Column, text: Column, seed: int) -> Column:
    """A hash of ``HASH_BITS`` bits, not negative."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 64 - HASH_BITS)


def source_ranks(sizes: DataFrame) -> DataFrame:
    """Adds ``rank``: the place of each source by code point from 0, null last.

    The sources are dealt into ranges, numbered inside each range and shifted
    by the rows of the ranges before, so that no task sees all of them.
    """
    ranged = materialize(
        sizes.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("at", F.monotonically_increasing_id()),
        "mix-ranks",
    )
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range, not for each source
    offsets = ranged.groupBy("part").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    return (
        ranged.join(F.broadcast(offsets.select("part", "before")), "part")
        .withColumn("rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("part", "at", "before")
    )


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size).

    ``share`` of all sizes is dealt by weight; a target stops at ``most`` times
    its source's size and the excess is dealt again by weight until none is
    above. Each round is one aggregate; there are at most as many rounds as
    sources that stop.
    """
    ranked = materialize(
        source_ranks(sizes)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * F.lit(float(most))),
        "mix-weights",
    )
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped = 0.0, -1
    while True:
        free = F.col("limit") > F.col("weight") * F.lit(level) if stopped >= 0 else F.lit(True)
        row = ranked.agg(
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0.0)).alias("w"),
            F.coalesce(F.sum(F.when(~free, F.col("limit"))), F.lit(0.0)).alias("full"),
            F.count_if(~free).alias("n"),
        ).first()
        if row["n"] == stopped or not row["w"]:
            break
        stopped, level = row["n"], max(0.0, total - row["full"]) / row["w"]
    return ranked.withColumn("target", F.least("limit", F.col("weight") * F.lit(level))).select("source", "source_size", "target")


def _with_source(rows: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
    """Joins what ``side`` has for each source: by broadcast up to ``BROADCAST_SOURCES`` rows, else by a shuffle."""
    side = side.withColumnRenamed("source", "mix_side")
    side = F.broadcast(side) if small_enough(side, BROADCAST_SOURCES) else side
    return rows.join(side, F.col("source").eqNullSafe(F.col("mix_side")), how).drop("mix_side")


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each source of ``budgets`` (source, budget) the threshold below which documents fit into the budget.

    ``rows`` has source, hash and size. Each level sums the sizes by bucket
    inside the bucket in which the level before ended, and descends. All rows are read
    twice, for the first level's sums and to write out its boundary buckets; later levels read these alone.
    """
    at = materialize(
        budgets.select("source", F.col("budget").alias("left"), F.lit(0).cast("long").alias("prefix")), "mix-level"
    )
    done_bits = 0
    for bits in LEVELS:
        shift = HASH_BITS - done_bits - bits
        # the hash's higher bits pick the boundary bucket, the next ones count inside it
        sums = rows.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("tokens"))
        sums = _with_source(sums, at.select("source", "left"))
        upto = Window.partitionBy("source").orderBy("bucket")
        cut = (
            sums.withColumn("upto", F.sum("tokens").over(upto))
            .groupBy("source")
            .agg(
                F.max(F.when(F.col("upto") <= F.col("left"), F.struct("bucket", "upto"))).alias("fits"),
                F.min(F.when(F.col("upto") > F.col("left"), F.col("bucket"))).alias("over"),
            )
        )
        # where everything fits the boundary is past the last bucket
        old = at.select(F.col("source").alias("s"), F.col("left").alias("had"), F.col("prefix").alias("base"))
        at = materialize(
            old.join(cut, F.col("s").eqNullSafe(F.col("source")), "left").select(
                F.col("s").alias("source"),
                (F.col("had") - F.coalesce("fits.upto", F.lit(0))).alias("left"),
                F.coalesce("over", F.shiftleft(F.col("base") + 1, bits)).alias("prefix"),
            ),
            "mix-level",
        )
        done_bits += bits
        near = _with_source(rows, at).where(F.shiftright("hash", shift) == F.col("prefix"))
        rows = materialize(near.select("source", "hash", "size"), "mix-boundary")
    # at the last level the boundary is one hash; it is taken if that comes nearer to the budget
    tie = _with_source(rows.groupBy("source").agg(F.sum("size").alias("tokens")), at.select("source", "left"))
    tie = tie.select(F.col("source").alias("s"), (F.col("tokens") <= 2 * F.col("left")).alias("takes"))
    return at.join(tie, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", (F.col("prefix") + F.coalesce(F.col("takes"), F.lit(False)).cast("long")).alias("threshold")
    )


def mix(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.0,
    most: float = 3.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    columns: list[str] | None = None,
) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target``, ``rounds`` and ``taken`` to every row.

    ``rounds`` is how often the mix takes the row (0 to ``most``), ``taken`` the
    words that makes. Weights go round the sources in code-point order, null
    last. Rows with the same id and text share their decision, whatever their
    number. Null ids, texts and sources are values like any other; an empty or
    null text has size 0. An empty table gives an empty one. Input columns
    called like an output column are replaced. ``columns``: the input columns to return, all by default.
    """
    made = ["size", "source_size", "target", "rounds", "taken"]
    kept = [c for c in (columns or docs.columns) if c.lower() not in made]
    own = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    base = docs.select(own, F.col(source_col).alias("source"), doc_hash(F.col(id_col), F.col(text_col), seed).alias("hash"), word_count(F.col(text_col)).alias("size"))
    # where the texts aren't part of the result the rows are written whole, so that words are counted once
    whole = text_col not in kept
    rows = materialize(base if whole else base.select("source", "hash", "size"), "mix-rows")
    base, rows = rows if whole else base, rows.select("source", "hash", "size")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = materialize(targets(sizes, weights, share, most), "mix-targets")
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("whole", times)
    budgets = goal.select("source", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long").alias("budget"))
    plan = materialize(_with_source(goal, thresholds(rows, budgets)), "mix-plan")
    out = _with_source(base, plan, "left")
    rounds = F.col("whole") + (F.col("hash") < F.col("threshold")).cast("long")
    return out.select("row.*", "size", "source_size", "target", rounds.alias("rounds"), (F.col("size") * rounds).alias("taken"))
