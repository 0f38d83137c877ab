"""Combining tables: first value wins, unions by name, sources in order of preference, work lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def combine_first(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """All keys and columns of both; where both have a value the left one counts."""
    both = left.alias("l").join(right.alias("r"), keys, "full_outer")
    names = left.columns + [c for c in right.columns if c not in left.columns]
    pick = lambda c: [F.col(f"{s}.`{c}`") for s, df in (("l", left), ("r", right)) if c in df.columns]
    return both.select(*keys, *[F.coalesce(*pick(c)).alias(c) for c in names if c not in keys])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all tables; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_source(rows: DataFrame, entity: list[str], priority: Column) -> DataFrame:
    """The rows of each entity that come from its source of the smallest priority.

    The smallest priority of each entity is an aggregate joined back, so that no
    entity's rows have to meet in one sort.
    """
    ranked = rows.withColumn("_priority", priority)
    best = ranked.groupBy(*entity).agg(F.min("_priority").alias("_best"))
    return ranked.join(best, entity).where(F.col("_priority") == F.col("_best")).drop("_priority", "_best")


def work_list(targets: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Every target with every endpoint of a catalogue, which is a short list and broadcast."""
    if endpoints.limit(10_001).count() > 10_000:
        raise ValueError("the catalogue has more than 10,000 endpoints")
    return targets.join(F.broadcast(endpoints), how="cross")


def backlog(work: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """What of the work list hasn't landed."""
    return work.join(landed.select(*keys), keys, "left_anti")


def backlog_of_table(work: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """What of the work list isn't in a table that is kept in buckets of the keys; only the work list moves."""
    landed = work.sparkSession.table(table).select(*keys)
    return work.join(landed.hint("merge"), keys, "left_anti")


def retry_list(fetch_log: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Keys whose last fetch failed in a way that may pass: 429, any 5xx, or no status."""
    last = fetch_log.groupBy(*keys).agg(F.max_by(F.struct("status", "ok"), order).alias("last"))
    may_pass = F.col("last.status").isNull() | (F.col("last.status") == 429) | F.col("last.status").between(500, 599)
    return last.where(~F.coalesce("last.ok", F.lit(False)) & may_pass).select(*keys)


def valid_cache(landed: DataFrame) -> DataFrame:
    """Landed documents that need no fetch: not empty, and JSON that can be parsed where JSON is meant.

    Documents that were landed as a variant, ``doc``, were parsed then; else ``body`` is.
    """
    parsed = F.col("doc") if "doc" in landed.columns else F.try_parse_json("body")
    return landed.where((F.col("raw_len") > 0) & (~F.col("is_json") | parsed.isNotNull()))


def signatures(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(by, signature) for each group of rows: equal for groups with the same rows in any order.

    Rows are hashed one by one; of the hashes only sums are kept, so nothing is sorted or gathered.
    """
    digest = F.sha2(F.to_json(F.struct(*columns)).cast("binary"), 256)
    part = lambda k: F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")
    sums = [F.coalesce(F.sum(part(k)), F.lit(0)).cast("string") for k in range(4)]
    return rows.groupBy(*by).agg(F.sha2(F.concat_ws("-", F.count(F.lit(1)).cast("string"), *sums).cast("binary"), 256).alias("signature"))


def signature(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the ``signature`` of a whole table."""
    return signatures(rows, columns, [])


def progress(fetch_log: DataFrame, finished: str, total: int, seconds: int) -> DataFrame:
    """(slot, done, rate, percent, eta_s) for each slot of time in which something finished."""
    slot = F.floor(F.unix_timestamp(finished) / seconds) * seconds
    counts = fetch_log.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    done = F.sum("n").over(Window.orderBy("slot"))  # a row for each slot of time
    out = counts.select("slot", done.alias("done"), (F.col("n") / seconds).alias("rate"))
    return out.withColumn("percent", F.col("done") * 100.0 / total).withColumn("eta_s", (F.lit(total) - F.col("done")) / F.col("rate"))
