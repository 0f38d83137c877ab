"""Ordered deduplication: which row of a key counts is stated, never left to chance.

``order`` holds the columns of the source order, earliest first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize, small_enough

#: Lists of files are ranked in one task and broadcast up to this many.
BROADCAST_FILES = 100_000
#: Texts that count as empty, in lower case.
EMPTY_WORDS = ("", "nan", "none", "na")


def source_order(df: DataFrame, name: str = "src_ord") -> DataFrame:
    """Adds the place of each row in the files it was read from, as one number: file, block, row.

    Files count in the order of their paths. A number of fixed width lets aggregates over it hash instead of sort.
    """
    file = F.col("_metadata.file_path")
    paths = df.select(file.alias("_path")).distinct()
    if small_enough(paths, BROADCAST_FILES):
        rank = F.broadcast(paths.withColumn("_rank", F.row_number().over(Window.orderBy("_path"))))
    else:
        rank = row_index(paths, [F.col("_path")], "_rank")
    big = lambda c: c.cast("decimal(38,0)")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    within = F.expr("cast(cast(_metadata.file_block_start AS decimal(15,0)) * 100000000000BD AS decimal(38,0))") + big(row)
    placed = df.withColumns({"_path": file, "_within": within}).join(rank, "_path", "left")
    return placed.withColumn(name, F.expr("cast(cast(_rank AS decimal(12,0)) * 100000000000000000000000000BD + _within AS decimal(38,0))")).drop("_path", "_rank", "_within")


def fixed_width_order(first: Column, then: Column) -> Column:
    """Order by a whole number (5 * 10^18 at most either way), then by a double, as one number; a null double counts as zero.

    Aggregates over a struct of both would sort all rows, over a number of fixed width they hash.
    """
    # the bits of doubles rise with them, those of negative ones fall; NaN is the largest, and there is no negative zero here
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(then.cast("double"), F.lit(0.0)) + F.lit(0.0)).cast("long")
    big = lambda c: c.cast("decimal(38,0)")
    rising = F.when(then < 0, -bits.bitwiseAND(F.lit((1 << 63) - 1))).otherwise(bits)
    return big(big(first) * F.lit(Decimal(1 << 64)).cast("decimal(38,0)") + big(rising))


def is_empty(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c.cast("string"))).isin(*EMPTY_WORDS)


def first_by(value: Column, order: Column, where: Column | None = None) -> Column:
    """An aggregate: the first value that isn't null, in order, among the rows that ``where`` holds for."""
    kept = value.isNotNull() if where is None else value.isNotNull() & where
    return F.min_by(F.when(kept, value), F.when(kept, order))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in order, by one aggregate; of rows that tie in order any one. Null is a key like any other.

    Tasks keep one row for each key before the shuffle. Rows with text are sorted by key for that, rows of numbers alone are not.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def keep_preferred(df: DataFrame, keys: list[str], prefer: list[Column], order: list[Column]) -> DataFrame:
    """The row of each key that ``prefer`` sorts first, then the source order."""
    at = Window.partitionBy(*keys).orderBy(*prefer, *order)
    return df.withColumn("_place", F.row_number().over(at)).where("_place = 1").drop("_place")


def first_nonempty(df: DataFrame, keys: list[str], order: Column, fallback: bool = False) -> DataFrame:
    """For each key and other column the first value that isn't empty; with ``fallback``, else the first at all."""
    aggs = []
    for c in df.columns:
        if c in keys or c == "src_ord":
            continue
        full = first_by(F.col(f"`{c}`"), order, ~is_empty(F.col(f"`{c}`")))
        aggs.append((F.coalesce(full, F.min_by(F.col(f"`{c}`"), order)) if fallback else full).alias(c))
    return df.groupBy(*keys).agg(*aggs)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def row_index(df: DataFrame, order: list[Column], name: str = "row_index") -> DataFrame:
    """Numbers all rows from 0 in order; rows that tie are numbered in any order, without gaps.

    Rows are dealt into ranges, which are written once, so that the numbers and the ranges' counts
    come from the same rows; only the counts meet in one place.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = materialize(ranged.withColumn("_part", F.shiftright("_at", 33)), "row-index")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    return numbered.drop("_at", "_part", "_before")
