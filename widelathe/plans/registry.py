"""Where queries and their SQL are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Lists a query under its function's name, or ``name``, with the SQL of the same result if there is one."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a long table: users are entities, event types endpoints, weeks of the month years ``y1`` to ``y5``."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id AS string) AS entity_id",
        "concat('user ', user_id) AS entity_name",
        "event_type AS endpoint_key",
        "concat('y', 1 + (day(ts) - 1) div 7) AS category",
        "if(event_id % 3 = 0, 'Scuola ', '') AS level",
        "value AS value_num",
        "'' AS value_text",
        "event_id AS src_ord",
    )


#: The same in DuckDB, with the year index as a number.
OBS_SQL = """obs AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, 'user ' || user_id AS entity_name, event_type AS endpoint_key,
    1 + (day(ts) - 1) // 7 AS y, event_id % 3 = 0 AS scope, value AS v, event_id AS ord FROM events)"""
