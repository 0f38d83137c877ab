"""Statistics of runs, outcomes and drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_stats(fetch_log: DataFrame) -> DataFrame:
    """One row: requests in all, ok, with an http error, with an exception, refused for their rate, from the cache; and entities."""
    status = F.col("status")
    return fetch_log.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("ok")).alias("ok"),
        F.count_if(~F.col("ok") & status.isNotNull()).alias("http_error"),
        F.count_if(~F.col("ok") & status.isNull()).alias("exception"),
        F.count_if(status == 429).alias("rate_limited"),
        F.count_if(F.col("from_cache")).alias("from_cache"),
        F.count_distinct("entity_id").alias("entities"),
    )


def outcome_stats(rows: DataFrame, outcome: Column) -> DataFrame:
    return rows.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def drop_counts(rows: DataFrame, reason: Column) -> DataFrame:
    """How many rows each reason drops; kept rows have no reason and are counted as ``kept``."""
    return rows.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def first_flag(flags: list[Column], names: list[str]) -> Column:
    """A struct of ``1`` and ``0`` texts with the first true flag as the only ``1``; all empty if none is true."""
    at = F.array_position(F.array(*[F.coalesce(f, F.lit(False)) for f in flags]), True)
    return F.struct(*[F.when(at == 0, F.lit("")).when(at == k, F.lit("1")).otherwise(F.lit("0")).alias(n) for k, n in enumerate(names, 1)])
