"""Every query with SQL gives the same rows as that SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from widelathe import catalog
from widelathe.operators import blocks, dedup

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6) + 0.0
    return round(float(value), 6) if type(value).__name__ == "Decimal" else value


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df, sql = catalog.queries()[name](spark, SF), duck.sql(catalog.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(sql.columns)
    found = sorted(str(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    wanted = sorted(str(tuple(map(plain, r))) for r in sql.select(*[f'"{c}"' for c in columns]).fetchall())
    assert found == wanted


def same_on(spark, folder, name, **tables):
    """The query and its SQL on tables of one's own, which come as SELECTs; the rows of the query."""
    for t, select in tables.items():
        duckdb.sql(f"COPY ({select}) TO '{folder}/{t}.parquet'")
    connection = duckdb.connect()
    for t in tables:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df, sql = catalog.queries()[name](spark, str(folder)), connection.sql(catalog.oracle_sql()[name])
    rows = df.collect()
    wanted = sql.select(*[f'"{c}"' for c in df.columns]).fetchall()
    assert sorted(str(tuple(map(plain, r))) for r in rows) == sorted(str(tuple(map(plain, r))) for r in wanted)
    return rows


def test_registry_union_has_no_postal_code_of_six_digits(spark, tmp_path):
    customers = f"SELECT * REPLACE (c_custkey * 1000 + 7 AS c_custkey) FROM '{SF}/customer.parquet'"
    suppliers = f"SELECT * REPLACE (s_suppkey * 1000 + 7 + s_suppkey % 2 AS s_suppkey) FROM '{SF}/supplier.parquet'"
    rows = {r["entity_id"]: r for r in same_on(spark, tmp_path, "registry_union", customer=customers, supplier=suppliers)}
    assert rows["AB00099007"]["cap"] == "99007" and rows["AB00100007"]["cap"] is None
    assert rows["AB00001008"]["nome"] == "later" and rows["AB00001008"]["cap"] is None  # a supplier alone


def test_share_pivot_open_hashes_lines_and_takes_the_least_of_ties(spark, tmp_path, monkeypatch):
    plans, written = [], blocks.materialize

    def kept(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, *args)

    monkeypatch.setattr(blocks, "materialize", kept)
    quantity = "CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN -0.25 - l_partkey % 7 WHEN 2 THEN 'inf'::DOUBLE WHEN 3 THEN 1e-9 * l_partkey ELSE l_quantity END"
    lines = f"SELECT * REPLACE (l_orderkey // 200 AS l_orderkey, l_suppkey % 5 AS l_suppkey, {quantity} AS l_quantity) FROM '{SF}/lineitem.parquet'"
    same_on(spark, tmp_path, "share_pivot_open", lineitem=lines)
    assert len(plans) == 1 and "SortAggregate" not in plans[0] and plans[0].count("Exchange hashpartitioning") == 1


def test_an_order_of_fixed_width_is_that_of_its_parts(spark):
    doubles = [0.0, -0.0, 1.0, -1.0, 1e-300, -1e300, 5.0, 5.000000000000001, -5.0, -5.000000000000001, float("inf"), float("-inf"), float("nan")]
    rows = spark.createDataFrame([(o, v) for o in (7, -3, 0, 5 * 10**18, -5 * 10**18) for v in doubles], "o long, v double").withColumn("at", dedup.fixed_width_order(F.col("o"), F.col("v")))
    ordered = lambda *by: [(r["o"], repr(r["v"] + 0.0)) for r in rows.orderBy(*by).collect()]
    assert ordered("at") == ordered("o", "v")


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
