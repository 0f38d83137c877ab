"""Operators on small tables: order, ties, nulls, empty input."""

import pytest
from pyspark.sql import functions as F

from widelathe.operators import blocks, columns, combine, dedup, enrich, html_tables, reports
from widelathe.operators.blocks import EXAM_BINS, MIDDLE_BINS, MIDDLE_LOW, MIDDLE_TOP, Bins, Outcomes, Single, Years
from widelathe.plans.wide import build_wide

LONG = "entity_id string, entity_name string, endpoint_key string, category string, level string, value_num double, src_ord int"


def rows(df, *keys):
    return sorted(map(tuple, (df.select(*keys) if keys else df).collect()), key=str)


@pytest.mark.parametrize("parts", [1, 7])
def test_keep_first_follows_the_order_alone(spark, parts):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), (None, 3, "n"), (None, 4, "m"), ("b", 5, None)], "k string, o int, v string").repartition(parts)
    assert rows(dedup.keep_first(df, ["k"], [F.col("o")])) == [("a", 1, "x"), ("b", 5, None), (None, 3, "n")]
    assert rows(dedup.keep_first(df.limit(0), ["k"], [F.col("o")])) == []


def test_first_nonempty(spark):
    df = spark.createDataFrame([("k", "", 1), ("k", "nan", 2), ("k", " None ", 3), ("k", "x", 4), ("k", "y", 5), ("e", " ", 6), ("e", None, 7)], "k string, v string, src_ord int")
    assert rows(dedup.first_nonempty(df, ["k"], F.col("src_ord"))) == [("e", None), ("k", "x")]
    assert rows(dedup.first_nonempty(df, ["k"], F.col("src_ord"), fallback=True)) == [("e", " "), ("k", "x")]


def test_years_and_slopes(spark):
    data = [("a", "A", "ep", f"y{y}", "", v, o) for o, (y, v) in enumerate([(1, 2.0), (1, 9.0), (2, 4.0), (3, 6.0), (2020, 1.0)])] + [("b", "B", "ep", "y1", "", 1.0, 9), ("c", None, "other", "y1", "", 1.0, 10)]
    wide = build_wide(spark.createDataFrame(data, LONG), [Years("ep", "10_", label="v")])
    got = {r["entity_id"]: r.asDict() for r in wide.collect()}
    assert (got["a"]["10_v_y1"], got["a"]["10_v_y2"], got["a"]["*10_v_slope_y"]) == (2.0, 4.0, 2.0)
    assert got["a"]["*10_v_mean_y"] == pytest.approx(22 / 5) and got["a"]["*10_v_mean_y1y2"] == pytest.approx(5.0)
    assert got["b"]["*10_v_slope_y"] is None and got["c"]["10_v_y1"] is None and got["c"]["entity_name"] is None


def bins(spark, weights, **options):
    data = [("a", "", "ep", c, "", w, k) for k, (c, w) in enumerate(weights)]
    return tuple(blocks.aggregate_blocks(spark.createDataFrame(data, LONG), [Bins("ep", label="b", **options)]).first()[1:])


def test_bins(spark):
    assert bins(spark, [("60", 10.0), ("91-99", 10.0), ("100 e lode", 20.0), ("junk", 5.0)], mids=EXAM_BINS) == (75.0, 25.0, 89.25)
    middle = {"mids": MIDDLE_BINS, "low": MIDDLE_LOW, "top": MIDDLE_TOP}
    assert bins(spark, [("6", 1.0), ("10", 1.0), ("10 e lode", 2.0)], **middle) == (75.0, 25.0, 9.5)
    assert bins(spark, [("6", 0.0)], **middle) == (None, None, None)


def test_scope_fallback_is_decided_for_each_endpoint(spark):
    data = [("a", "", "x", "Scuola ", "", 1.0, 2), ("a", "", "x", "other", "", 9.0, 1), ("a", "", "y", "other", "", 3.0, 3), ("b", "", "x", "other", "", 4.0, 4)]
    wide = blocks.aggregate_blocks(spark.createDataFrame(data, LONG), [Single("x", name="x"), Single("y", name="y")])
    assert rows(wide) == [("a", 1.0, 3.0), ("b", None, None)]


def test_outcomes_complement(spark):
    data = [("a", "", "e", "ammessi", "", 98.5, 1), ("a", "", "e", "Non ammessi", "", 1.0, 2)]
    row = blocks.aggregate_blocks(spark.createDataFrame(data, LONG), [Outcomes("e", label="o", suffix="")]).first()
    assert (row["o_ammessi"], row["o_non_ammessi"], row["o_sospesi"], row["o_tasso_non_ammessi_pct"]) == (98.5, 1.0, None, 1.5)


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`10_abbandoni_mean_y` int, `13_assenze_docenti_sum` int, `*2_x_mean_y` int, key int")
    starred = columns.star_computed(columns.star_computed(df))
    assert columns.column_order(starred.columns, ["key"]) == ["key", "*2_x_mean_y", "*10_abbandoni_mean_y", "13_assenze_docenti_sum"]
    both = spark.createDataFrame([(None, 2)], "a_classi_seconde int, a_classiseconde int")
    assert columns.rename_reports(both).columns == ["a_classiseconde"] and columns.rename_reports(both).first()[0] == 2
    with pytest.raises(ValueError, match="missing"):
        columns.require_columns(df, ["nope"])


def test_combine_first(spark):
    a = spark.createDataFrame([(1, 1, None), (2, 5, 6)], "k int, a int, b int")
    b = spark.createDataFrame([(1, 9, 2), (3, 7, 8)], "k int, a int, b int")
    assert rows(combine.combine_first(a, b, ["k"])) == [(1, 1, 2), (2, 5, 6), (3, 7, 8)]


def test_two_stage_lookup(spark):
    lookup = spark.createDataFrame([("A", "P", "exact", 1), ("A", "", "loose", 0), ("B", "Q", "only", 2)], "place_key string, prov_key string, region string, src_ord int")
    df = spark.createDataFrame([("A", "P"), ("A", "Z"), ("B", "Z"), ("C", "P")], "p string, v string")
    out = enrich.lookup_two_stage(df, lookup, F.col("p"), F.col("v"), ["region"], [F.col("src_ord")])
    assert rows(out, "p", "v", "region") == [("A", "P", "exact"), ("A", "Z", "loose"), ("B", "Z", "only"), ("C", "P", "")]


def test_clean_reports_fails_with_examples(spark):
    df = spark.createDataFrame([("2.2.a.1", "no separators", "Punteggio medio", "1")], "descriptor string, heading string, column_label string, value string")
    with pytest.raises(reports.BadRows) as e:
        reports.clean_reports(df)
    assert len(e.value.examples) == 1


def test_header_names():
    cell = lambda text, colspan=1, rowspan=1: {"text": text, "colspan": colspan, "rowspan": rowspan}
    assert html_tables.header_names([[cell("A", 2)], [cell("x"), cell("y")]]) == ["A | x", "A | y"]
    assert html_tables.header_names([[cell("R", 1, 2), cell("B", 2)], [cell("b"), cell("")]]) == ["R", "B | b", "B"]
    assert html_tables.header_names([[cell("")]]) == ["col1"]


def test_broken_pages_are_told(spark):
    df = spark.createDataFrame([(1, None), (2, "<table class='tableDsc'><tr><td>Situazione</td>")], "doc_id int, html string")
    assert rows(html_tables.table_rows(df), "doc_id", "error") == [(1, "no document"), (2, None)]


def test_row_index_has_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id").repartition(7)
    got = dedup.row_index(df, [F.col("k"), F.col("id")]).orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(1000)) and [(r["k"], r["id"]) for r in got] == sorted((r["k"], r["id"]) for r in got)


def test_row_index_of_wide_rows(spark):
    orders = spark.read.parquet("/root/testdata/sf0.1/orders.parquet").repartition(8)
    got = dedup.row_index(orders, [F.col("o_orderdate")]).select("row_index", "o_orderdate", "o_comment" if "o_comment" in orders.columns else "o_orderstatus")
    n = orders.count()
    top = got.agg(F.count_distinct("row_index"), F.min("row_index"), F.max("row_index")).first()
    assert tuple(top) == (n, 0, n - 1)
    sorted_ = got.orderBy("row_index").select("o_orderdate").toArrow()["o_orderdate"].to_pylist()
    assert sorted_ == sorted(sorted_)
