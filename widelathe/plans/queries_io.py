"""Queries of reports, charts, HTML, sources, sinks and streaming.

What a query writes and reads again goes to a new folder below the one that the cluster shares.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import canonical_code
from ..operators import charts, html_tables, reports, stats
from ..operators.blocks import Shares, Total
from ..operators.columns import pick_column, prefix_columns
from ..operators.combine import union_all
from ..operators.enrich import municipality_lookup
from ..sources import csv, sinks
from ..streaming import ingest as streaming
from . import release
from .registry import OBS_SQL, observations, query, table
from .wide import Sides, build_wide


def _report_rows(spark, sf_dir):
    """Report rows out of parts: two measures of descriptor A, descriptor B, dropped rows and rows that can't be split."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('RM', lpad(p_partkey % 50, 8, '0')) AS entity_id",
        "CASE p_partkey % 8 WHEN 7 THEN '1.1.b.1' WHEN 0 THEN '2.2.a.1' WHEN 1 THEN '2.2.a.1' WHEN 2 THEN '2.2.a.1' WHEN 3 THEN '2.2.a.1' ELSE '2.2.b.2' END AS descriptor",
        "'name' AS descriptor_name",
        "if(p_partkey % 16 = 0, p_name, concat('Scuola secondaria di ii grado - classi ', if(p_size % 2 = 0, 'seconde', 'quinte'), ' | ', if(p_partkey % 3 = 0, 'italiano', 'matematica'))) AS heading",
        "CASE p_partkey % 8 WHEN 0 THEN 'Punteggio medio' WHEN 1 THEN 'Diff. ESCS (*)' WHEN 2 THEN 'label' WHEN 3 THEN 'other' WHEN 4 THEN p_name "
        "ELSE concat('Variabilità dei punteggi - licei - scuola secondaria di ii grado - classi seconde | ', if(p_partkey % 8 = 5, 'italiano', 'inglese reading'), ' | tra le classi') END AS column_label",
        "'x' AS school_level",
        "if(p_partkey % 9 = 0, 'n.d.', replace(concat(p_size, ',5%'), '%', if(p_partkey % 2 = 0, '%', ''))) AS value",
        "p_partkey AS src_ord",
    )


_REPORT_SQL = """rep AS (SELECT p_partkey, 'RM' || lpad(CAST(p_partkey % 50 AS VARCHAR), 8, '0') AS entity_id, p_partkey % 8 AS k, p_partkey % 16 = 0 AS bad_a, p_partkey % 8 = 4 AS bad_b,
    CASE WHEN p_size % 2 = 0 THEN 'seconde' ELSE 'quinte' END AS cls, CASE WHEN p_partkey % 3 = 0 THEN 'italiano' ELSE 'matematica' END AS sub, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size + 0.5::DOUBLE END AS v,
    CASE WHEN p_partkey % 9 = 0 THEN 'n.d.' ELSE p_size || ',5' || CASE WHEN p_partkey % 2 = 0 THEN '%' ELSE '' END END AS value FROM part)"""


@query(f"""WITH {_REPORT_SQL} SELECT p_partkey AS src_ord, CASE WHEN k < 2 THEN 'Scuola secondaria di ii grado' ELSE '' END AS split_a1, CASE WHEN k < 2 THEN 'classi ' || cls ELSE '' END AS split_a2, CASE WHEN k < 2 THEN sub ELSE '' END AS split_a3,
    CASE WHEN k > 4 THEN 'licei' ELSE '' END AS split_b1, CASE WHEN k > 4 THEN 'scuola secondaria di ii grado' ELSE '' END AS split_b2, CASE WHEN k > 4 THEN 'classi seconde' ELSE '' END AS split_b3,
    CASE k WHEN 5 THEN 'italiano' WHEN 6 THEN 'inglese reading' ELSE '' END AS split_b4, CASE WHEN k > 4 THEN 'tra le classi' ELSE '' END AS split_b5 FROM rep WHERE k IN (0, 1, 5, 6) AND NOT bad_a""")
def clean_reports(spark, sf_dir):
    good, _ = reports.clean_reports(_report_rows(spark, sf_dir), on_bad="quarantine")
    return good.select("src_ord", *reports.SPLIT_NAMES)


@query(f"""WITH {_REPORT_SQL} SELECT p_partkey AS src_ord, CASE WHEN k = 0 THEN 'missing " - "' ELSE 'not enough " - "' END AS error FROM rep WHERE bad_a OR bad_b""")
def clean_quarantine(spark, sf_dir):
    _, bad = reports.clean_reports(_report_rows(spark, sf_dir), on_bad="quarantine")
    return bad.select("src_ord", "error")


@query(f"""WITH {_REPORT_SQL} SELECT CASE k WHEN 7 THEN 'descriptor' WHEN 2 THEN 'label' WHEN 3 THEN 'measure' ELSE 'kept' END AS reason, count(*) AS n FROM rep GROUP BY 1""")
def drop_counts(spark, sf_dir):
    return stats.drop_counts(_report_rows(spark, sf_dir), reports.drop_reason())


@query(f"""WITH {_REPORT_SQL}, g AS (SELECT * FROM rep WHERE k IN (0, 1, 5, 6) AND NOT bad_a)
SELECT entity_id, """ + ", ".join(f"arg_min(v, p_partkey) FILTER (v IS NOT NULL AND k = {k} AND cls = '{c}' AND sub = '{s}') AS \"80_rav_22a1_invalsipunteggiomedio_scuola_secondaria_di_ii_grado_classi_{c}_{s}_{m}_\"" for c in ("quinte", "seconde") for s in ("italiano", "matematica") for k, m in ((0, "punteggio_medio"), (1, "diff_escs"))) + """,
    arg_min(v, p_partkey) FILTER (v IS NOT NULL AND k = 5) AS "80_rav_22b2_variabilitapunteggi_licei_scuola_secondaria_di_ii_grado_classi_seconde_italiano_tra_le_classi_",
    arg_min(v, p_partkey) FILTER (v IS NOT NULL AND k = 6) AS "80_rav_22b2_variabilitapunteggi_licei_scuola_secondaria_di_ii_grado_classi_seconde_inglese_reading_tra_le_classi_" FROM g GROUP BY entity_id""")
def report_wide(spark, sf_dir):
    good, _ = reports.clean_reports(_report_rows(spark, sf_dir), on_bad="quarantine")
    return reports.report_wide(good)


@query(f"""WITH {_REPORT_SQL} SELECT entity_id, nullif(p_partkey % 4, 3) AS idx, arg_min(value, p_partkey) FILTER (k = 0) AS punteggio_medio, arg_min(value, p_partkey) FILTER (k = 1) AS diff_escs, arg_min(value, p_partkey) FILTER (k = 2) AS label,
    arg_min(value, p_partkey) FILTER (k = 3) AS other, arg_min(value, p_partkey) FILTER (k = 5) AS "var_licei_secondaria_di_ii_grado_seconde_italiano_tra_le_classi",
    arg_min(value, p_partkey) FILTER (k IN (6, 7)) AS "var_licei_secondaria_di_ii_grado_seconde_inglese_reading_tra_le_classi" FROM rep WHERE k <> 4 GROUP BY ALL""")
def report_pivot_slug(spark, sf_dir):
    rows = _report_rows(spark, sf_dir).where("src_ord % 8 != 4").withColumn("idx", F.nullif(F.col("src_ord") % 4, F.lit(3)))
    return reports.report_pivot(rows, ["entity_id", "idx"])


@query("""
SELECT c_custkey, unnest(['label', 'c_name', 'c_nationkey', 'rich', 'gone']) AS column_label, unnest([c_mktsegment, c_name, CAST(c_nationkey AS VARCHAR), CASE WHEN c_acctbal > 5000 THEN '1' ELSE '0' END, '']) AS value FROM customer
""")
def records_to_long(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("rich", F.col("c_acctbal") > 5000).withColumn("gone", F.lit(None).cast("string"))
    return reports.records_to_long(rows, ["c_custkey"], F.col("c_mktsegment"), ["c_name", "c_nationkey", "rich", "gone"])


def _charts(spark, sf_dir):
    """A chart for each user and event type; its shape follows the user's number."""
    per = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "value"))), lambda s: s["value"]).alias("v"))
    lists = "'series', array(named_struct('name', 'valori', 'data', v))"
    by_categories = f"to_json(named_struct('title', event_type, 'categories', array('y1', 'y2', 'y3'), {lists}))"
    scalar = "to_json(named_struct('title', event_type, 'series', array(named_struct('name', 'a', 'data', v[0], 'y', cast(NULL AS double)), named_struct('name', 'b', 'data', cast(NULL AS double), 'y', v[0] + 1))))"
    index = f"to_json(named_struct('title', event_type, {lists}))"
    none = "to_json(named_struct('title', event_type, 'categories', array('y1'), 'series', array(named_struct('name', 'a', 'data', v[0]))))"
    body = f"CASE user_id % 5 WHEN 0 THEN {by_categories} WHEN 1 THEN {scalar} WHEN 2 THEN {index} WHEN 3 THEN {none} ELSE '{{broken' END AS body"
    return per.selectExpr("cast(user_id AS string) AS entity_id", "if(event_type = 'signup', 'anagrafica_base', event_type) AS endpoint_key", "user_id", "event_type", body)


_CHART_SQL = """p AS (SELECT user_id, event_type, list(value ORDER BY event_id) AS v FROM events GROUP BY ALL),
c AS (SELECT user_id, event_type, 'valori' AS series_name, i - 1 AS category_index, CASE WHEN user_id % 5 = 0 AND i <= 3 THEN 'y' || i END AS category, v[i] AS value, CASE user_id % 5 WHEN 0 THEN 'by_categories' ELSE 'index_only' END AS kind
    FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM p WHERE user_id % 5 IN (0, 2))
    UNION ALL SELECT user_id, event_type, s, NULL, s, CASE s WHEN 'a' THEN v[1] ELSE v[1] + 1 END, 'by_name_scalar' FROM p, (VALUES ('a'), ('b')) AS t(s) WHERE user_id % 5 = 1)"""


@query(f"WITH {_CHART_SQL} SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS endpoint_key, series_name, category_index::INTEGER AS category_index, category, round(value, 6) AS value FROM c WHERE event_type <> 'signup'")
def chart_explode(spark, sf_dir):
    rows = charts.observations(_charts(spark, sf_dir))
    return rows.select("entity_id", "endpoint_key", "series_name", "category_index", "category", F.round(F.col("value").cast("double"), 6).alias("value"))


@query(f"WITH {_CHART_SQL} SELECT kind, count(*) AS n, count(DISTINCT user_id) AS users FROM c GROUP BY kind")
def chart_shapes(spark, sf_dir):
    rows = charts.chart_rows(_charts(spark, sf_dir), keep=("user_id",))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS entity_id, c_name AS nome, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS tipo, 'ok' AS esito, c_nationkey::BIGINT AS n_elements FROM customer WHERE c_custkey % 4 <> 1")
def registry_from_json(spark, sf_dir):
    rec = "if(c_custkey % 3 = 0, named_struct('nome', c_name, 'tipo', c_mktsegment), named_struct('nome', c_name, 'tipo', cast(NULL AS string)))"
    body = f"if(c_custkey % 4 = 1, '{{\"scuole\":[]}}', to_json(named_struct('scuole', array({rec}), 'esito', 'ok', 'numeroTotaleElementi', c_nationkey))) AS body"
    docs = table(spark, sf_dir, "customer").selectExpr("cast(c_custkey AS string) AS entity_id", body)
    return charts.registry_rows(docs)


@query(r"""
SELECT page_id, try_cast(nullif(regexp_extract(replace(replace(f, '.', ''), ',', ''), '([0-9]+)', 1), '') AS BIGINT) AS figure, CAST(NULL AS DOUBLE) AS figure_last,
    CASE WHEN page_id % 7 = 0 THEN 'missing_nome_or_codice' WHEN page_id % 10 = 0 THEN 'http_status_404' WHEN regexp_matches(replace(replace(f, '.', ''), ',', ''), '[0-9]') THEN NULL ELSE 'selectors_not_found_or_no_digits' END AS error
FROM (SELECT page_id, regexp_extract(html, '(?s)class="ad"[^>]*>([^<]*)', 1) || ' ' || CASE WHEN page_id % 3 = 0 THEN CAST(page_id AS VARCHAR) ELSE '' END AS f FROM pages)
""")
def html_kpi(spark, sf_dir):
    number = F.when(F.col("page_id") % 3 == 0, F.col("page_id").cast("string")).otherwise(F.lit(""))
    docs = table(spark, sf_dir, "pages").withColumn("html", F.regexp_replace("html", r'(class="ad"[^>]*>[^<]*)', "$1 \u0001")).withColumn("html", F.replace("html", F.lit("\u0001"), number))
    return html_tables.key_figures(docs, "ad", "ad-last", status=F.when(F.col("page_id") % 10 == 0, 404).otherwise(200), named=[F.when(F.col("page_id") % 7 == 0, F.lit(" ")).otherwise(F.col("url"))]).select("page_id", "figure", "figure_last", "error")


def _table_pages(spark, sf_dir):
    """A page with a report table for each supplier, of three kinds."""
    score = "'<p><b>Classi seconde</b></p><table class=\"tableDsc\"><tr><th>Istituto/Plesso/Indirizzo</th><th>Punteggio medio</th><th>Diff. ESCS (*)</th></tr><tr><td>Istituto</td><td>1</td><td>2</td></tr><tr><td>Classi ', s_name, '</td><td>', s_acctbal, '</td><td>', s_nationkey, '</td></tr></table>'"
    grid = "'<script>x</script><table class=\"tableDsc\"><tr><th rowspan=\"2\">Riga</th><th colspan=\"2\">Classi quinte</th></tr><tr><th>a</th><th>b &amp; c</th></tr><tr><td>altro</td><td>0</td></tr><tr><td>Situazione ', s_suppkey, '</td><td>', s_acctbal, '</td><td>', s_nationkey, '</td><td>più</td></tr></table>'"
    ticks = "'<table class=\"tableDsc\"><tr><th>x</th></tr><tr><td>Situazione</td><td>', if(s_suppkey % 2 = 0, '<img src=x>', ''), '</td><td></td><td class=\"', if(s_suppkey % 5 > 0, 'selected', 'none'), '\"></td></tr></table>'"
    html = f"CASE s_suppkey % 4 WHEN 0 THEN concat({score}) WHEN 1 THEN concat({grid}) WHEN 2 THEN concat({ticks}) ELSE '<p>nothing</p>' END AS html"
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS doc_id", "array('2.2.a.1', '2.2.b.2', '2.2.b.1', '9.9')[cast(s_suppkey % 4 AS int)] AS descriptor", html)


@query("""
SELECT s_suppkey AS doc_id, 0 AS table_idx, 'Classi seconde' AS heading, 'Classi ' || s_name AS institute, s_acctbal AS score, s_nationkey AS diff FROM supplier WHERE s_suppkey % 4 = 0
""")
def html_tables_scores(spark, sf_dir):
    rows = html_tables.table_rows(_table_pages(spark, sf_dir).where("descriptor = '2.2.a.1'"))
    return html_tables.class_rows(rows).withColumn("score", F.col("score").cast("double")).withColumn("diff", F.col("diff").cast("int"))


@query("""
SELECT s_suppkey AS doc_id, 'Riga Classi quinte' AS heading, unnest(['Riga', 'Classi quinte | a', 'Classi quinte | b & c', 'extra_4']) AS column_label, unnest(['Situazione ' || s_suppkey, NULL, CAST(s_nationkey AS VARCHAR), 'più']) AS value FROM supplier WHERE s_suppkey % 4 = 1
""")
def html_tables_grid(spark, sf_dir):
    rows = html_tables.situation_rows(html_tables.table_rows(_table_pages(spark, sf_dir).where("descriptor = '2.2.b.2'")))
    return rows.select("doc_id", "heading", "column_label", F.when(~F.col("column_label").endswith("| a"), F.col("value")).alias("value"))


@query("""
SELECT s_suppkey AS doc_id, CASE WHEN s_suppkey % 2 = 0 THEN '1' ELSE CASE WHEN s_suppkey % 5 > 0 THEN '0' ELSE '' END END AS basso, '0' AS medio_basso,
    CASE WHEN s_suppkey % 2 = 1 AND s_suppkey % 5 > 0 THEN '1' ELSE '0' END AS medio, '0' AS medio_alto, '0' AS alto FROM supplier WHERE s_suppkey % 4 = 2
""")
def html_tables_ticks(spark, sf_dir):
    rows = html_tables.tick_rows(html_tables.table_rows(_table_pages(spark, sf_dir).where("descriptor = '2.2.b.1'")))
    return rows.select("doc_id", *html_tables.TICK_COLUMNS)


@query("""
SELECT CASE s_suppkey % 4 WHEN 0 THEN '2.2.a.1' WHEN 1 THEN '2.2.b.2' WHEN 2 THEN '2.2.b.1' ELSE '9.9' END AS descriptor, CASE WHEN s_suppkey % 4 = 3 THEN 'unknown descriptor' END AS error,
    count(*) * CASE s_suppkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 5 ELSE 1 END AS n FROM supplier GROUP BY s_suppkey % 4
""")
def html_dispatch(spark, sf_dir):
    return html_tables.dispatch(_table_pages(spark, sf_dir)).groupBy("descriptor", "error").agg(F.count(F.lit(1)).alias("n"))


_PART = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
_PART_SQL = "SELECT * FROM part"


@query(_PART_SQL)
def csv_roundtrip(spark, sf_dir):
    path = sinks.work_dir(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "part"), path)
    return spark.read.schema(_PART).options(header=True, escape='"').csv(path)


@query(f"WITH {OBS_SQL} SELECT entity_id, endpoint_key, v AS value_num, ord AS src_ord FROM obs WHERE endpoint_key = 'view'")
def parquet_roundtrip(spark, sf_dir):
    path = sinks.work_dir(spark, "long")
    sinks.write_long(observations(spark, sf_dir), path)
    sinks.write_long(observations(spark, sf_dir), path)  # again: it replaces itself
    return spark.read.parquet(path).where("endpoint_key = 'view'").select("entity_id", "endpoint_key", "value_num", "src_ord")


@query(_PART_SQL)
def quoted_merge(spark, sf_dir):
    path = sinks.work_dir(spark, "blocks")
    sinks.write_blocks(table(spark, sf_dir, "part"), path, "p_size")
    return sinks.read_blocks(spark, path, _PART, [F.col("p_size"), F.col("p_partkey")])


@query("SELECT c_nationkey, count(*) * (octet_length(encode(max(n_name))) + 1) AS bytes, sha256(repeat(max(n_name) || chr(10), CAST(count(*) AS INTEGER))) AS sha256 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def snapshot_files(spark, sf_dir):
    """A text file for each nation with a line for each customer, and the digests of the files as they lie there."""
    path = sinks.work_dir(spark, "snapshot")
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    lines = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"]).select(F.col("n_name").alias("value"), "c_nationkey")
    lines.repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    key = F.regexp_extract("path", "c_nationkey=(\\d+)", 1).cast("int")
    return sinks.snapshot(spark, path).select(key.alias("c_nationkey"), F.col("length").alias("bytes"), "sha256")


@query("SELECT n_nationkey AS CODICE_EP, 'è ' || n_name AS NOME, 'https://h.example/' || n_nationkey AS URL FROM nation")
def catalog_repair(spark, sf_dir):
    line = F.concat(F.lit('"'), "n_nationkey", F.lit(',""è '), "n_name", F.lit('"",https://h.example/'), "n_nationkey", F.lit('"'))
    mangled = table(spark, sf_dir, "nation").select(F.decode(F.encode(line, "UTF-8"), "ISO-8859-1").alias("value"))
    return csv.repair_catalogue(mangled, ["CODICE_EP", "NOME", "URL"]).withColumn("CODICE_EP", F.col("CODICE_EP").cast("int"))


@query("SELECT upper(r_name) AS area, count(*) AS n, sum(s_suppkey)::BIGINT AS keys FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def discover_scan(spark, sf_dir):
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    rows = s.join(F.broadcast(n), s["s_nationkey"] == n["n_nationkey"]).join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"])
    path = sinks.work_dir(spark, "discover")
    rows.select("s_suppkey", "s_name", F.col("r_name").alias("area")).write.partitionBy("area").option("header", True).csv(path)
    areas = tuple(sorted(x[0] for x in r.select("r_name").collect()))  # the names of a short list
    files = csv.discover(spark, [path], "part-*.csv")
    read = spark.read.schema("s_suppkey BIGINT, s_name STRING").option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.csv").csv(path)
    found = read.select("*", F.col("_metadata.file_path").alias("p")).withColumn("area", csv.area_of(F.col("p"), areas))
    known = files.select(F.element_at(F.split("path", "/"), -1).alias("f"))
    return found.join(known, F.element_at(F.split("p", "/"), -1) == F.col("f"), "left_semi").groupBy("area").agg(F.count(F.lit(1)).alias("n"), F.sum("s_suppkey").alias("keys"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 10 = 1 THEN 'a' || chr(10) || p_name WHEN p_partkey % 1000 = 500 THEN 'open ' || p_name ELSE p_name END AS p_name, p_size FROM part WHERE p_partkey % 10 <> 7")
def tolerant_csv(spark, sf_dir):
    """Of ten lines one has a line break in its quotes and one too many fields; of a thousand one has a quote that is never closed."""
    line = F.expr("""CASE WHEN p_partkey % 10 = 1 THEN concat(p_partkey, ',"a\n', p_name, '",', p_size) WHEN p_partkey % 10 = 7 THEN concat(p_partkey, ',', p_name, ',', p_size, ',9,9')
        WHEN p_partkey % 1000 = 500 THEN concat(p_partkey, ',"open ', p_name, ',', p_size) ELSE concat(p_partkey, ',', p_name, ',', p_size) END""")
    path = sinks.work_dir(spark, "tolerant")
    # the lines after an open quote are those that the repair may join: none of them has quotes of its own here
    rows = table(spark, sf_dir, "part").withColumn("_quoted", F.col("p_partkey") % 10 == 1).repartition(4, "_quoted").sortWithinPartitions("_quoted", "p_partkey")
    # each file starts with a header, so that the header is written with the first row of each partition
    header = F.when(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0, F.lit("p_partkey,p_name,p_size\n")).otherwise(F.lit(""))
    rows.select(F.concat(header, line).alias("value")).write.text(path)
    read = csv.read_tolerant(spark, path, ["p_partkey", "p_name", "p_size"])
    return read.selectExpr("cast(p_partkey AS bigint) AS p_partkey", "p_name", "cast(p_size AS int) AS p_size")


@query("SELECT 'C' || c_nationkey AS entity_id, min(c_name) AS a, arg_min(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'x, y' END, c_custkey) FILTER (c_custkey % 3 <> 0) AS b FROM customer GROUP BY c_nationkey")
def three_column_csv(spark, sf_dir):
    lines = table(spark, sf_dir, "customer").select(F.expr("concat('c', c_nationkey, ',', c_name, if(c_custkey % 3 = 0, '', ',x, y'))").alias("value"), "c_custkey")
    rows = csv.three_columns(lines.select(F.concat_ws("\u0001", "value", F.lpad("c_custkey", 12, "0")).alias("value")), ("CODICE_SCUOLA", "a", "b"))
    # the order travels at the line's end
    rows = rows.withColumn("ord", F.regexp_extract(F.concat("a", "b"), "\u0001(.*)$", 1)).withColumns({c: F.regexp_replace(c, "\u0001.*$", "") for c in ("a", "b")})
    return csv.load_key_figures(rows.select("CODICE_SCUOLA", "a", "b", "ord"), F.col("ord")).select("entity_id", "a", "b")


@query("SELECT CAST(c_custkey AS VARCHAR) AS CODICE, CASE c_custkey % 4 WHEN 1 THEN 'Forlì ' WHEN 3 THEN '\"' ELSE '' END || c_name AS NOME, CASE WHEN c_custkey % 4 IN (0, 3) THEN c_mktsegment END AS SEGMENTO FROM customer")
def flexible_csv(spark, sf_dir):
    """One table in four folders of other delimiters, encodings and headers, one of them with quotes that are never closed."""
    path = sinks.work_dir(spark, "flexible")
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey AS codice", "if(c_custkey % 4 = 1, concat('Forlì ', c_name), c_name) AS Nome", "c_mktsegment AS segmento")
    for k, (sep, encoding) in enumerate(((";", "UTF-8"), (",", "ISO-8859-1"), ("\t", "UTF-8"))):
        part = rows.where(F.col("codice") % 4 == k)
        (part if k == 0 else part.drop("segmento")).write.options(header=True, sep=sep, encoding=encoding).csv(f"{path}/{k}")
    broken = rows.where("codice % 4 = 3").select(F.concat(F.lit(""), "codice", F.lit(';"'), "Nome", F.lit(";"), "segmento").alias("value")).repartition("value")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    # a quote in each line but the header, so that a file has an odd or an even number of them
    head = F.when(first, F.lit("codice;Nome;segmento\n")).otherwise(F.lit(""))
    broken.select(F.concat(head, "value").alias("value")).write.text(f"{path}/3")
    read = csv.read_flexible(spark, [path])
    return read.select("CODICE", "NOME", "SEGMENTO")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS \"A;KEY\", o_orderstatus AS \"STATUS\" FROM orders")
def counted_delimiter(spark, sf_dir):
    """The header has as many semicolons as commas; the lines tell that the comma divides."""
    path = sinks.work_dir(spark, "counted")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    head = F.when(first, F.lit("a;key,status\n")).otherwise(F.lit(""))
    table(spark, sf_dir, "orders").select(F.concat(head, "o_orderkey", F.lit(","), "o_orderstatus").alias("value")).write.text(path)
    return csv.read_flexible(spark, [path], by_count=True)


_CLEAN_COLUMNS = ["CODICE_SCUOLA", "DESCRITTORE", "COLONNA", "VALORE", "ORD"]


@query(f"""WITH {_REPORT_SQL} SELECT 'clean' AS place, entity_id, CASE WHEN k < 2 THEN '2.2.a.1' ELSE '2.2.b.2' END AS descriptor, value, p_partkey AS src_ord FROM rep WHERE k IN (0, 1, 5, 6) AND NOT bad_a
UNION ALL SELECT 'quarantine', entity_id, CASE WHEN k = 0 THEN '2.2.a.1' ELSE '2.2.b.2' END, value, p_partkey FROM rep WHERE bad_a OR bad_b""")
def clean_output(spark, sf_dir):
    """Cleaned reports and their quarantine as they were written."""
    path = sinks.work_dir(spark, "clean")
    sinks.write_clean(_report_rows(spark, sf_dir), f"{path}/good", "quarantine", f"{path}/bad")
    read = lambda name, place: spark.read.options(header=True, escape='"').csv(f"{path}/{name}").select(F.lit(place).alias("place"), "entity_id", "descriptor", "value", F.col("src_ord").cast("long"))
    return read("good", "clean").unionByName(read("bad", "quarantine"))


@query(f"""WITH {_REPORT_SQL} SELECT entity_id, CASE WHEN k < 2 THEN '2.2.a.1' ELSE '2.2.b.2' END AS "DESCRITTORE", CASE k WHEN 0 THEN 'Punteggio medio' ELSE 'Diff. ESCS (*)' END AS "COLONNA", value AS "VALORE", CAST(p_partkey AS VARCHAR) AS "ORD"
FROM rep WHERE k IN (0, 1) AND NOT bad_a""")
def clean_report_scan(spark, sf_dir):
    """Cleaned reports read again as text under canonical codes; those with a blank code go."""
    path = sinks.work_dir(spark, "scan")
    good, _ = reports.clean_reports(_report_rows(spark, sf_dir).where("descriptor = '2.2.a.1'"), on_bad="quarantine")
    good = good.selectExpr("concat(' ', lower(entity_id)) AS CODICE_SCUOLA", "descriptor AS DESCRITTORE", "column_label AS COLONNA", "value AS VALORE", "cast(src_ord AS string) AS ORD")
    sinks.write_csv(good.unionByName(good.withColumn("CODICE_SCUOLA", F.lit(" "))), path)
    return csv.read_clean_reports(spark, path, _CLEAN_COLUMNS)


@query("SELECT 'src' AS source, 'x:E' || n_nationkey AS endpoint_key, 'E' || n_nationkey AS title, 'https://h.example/' || n_name AS url_template FROM nation")
def catalogue_export(spark, sf_dir):
    path = sinks.work_dir(spark, "catalogue")
    sinks.write_catalogue(table(spark, sf_dir, "nation").selectExpr("concat('E', n_nationkey) AS endpoint_key", "concat('https://h.example/', n_name) AS url_template"), path, "src", "x")
    return spark.read.option("header", True).csv(path)


@query("""SELECT 'r1' AS release_id, 8::BIGINT AS workers, 'SUD' AS area, count(*) AS requests, count(*) FILTER (event_id % 6 < 2) AS ok, count(*) FILTER (event_id % 6 = 3) AS rate_limited, count(DISTINCT user_id) AS entities, 'raw' AS raw_dir FROM events""")
def run_manifest(spark, sf_dir):
    """The nested manifest of a run, read back out of its JSON."""
    from .queries_wide import fetch_log

    config = {"run": {"workers": 8, "retries": 3}, "filters": {"area": "SUD"}}
    made = sinks.run_manifest(spark, fetch_log(spark, sf_dir), source="src", release_id="r1", config=config, outputs={"raw_dir": "raw"})
    at = lambda p, t="string": F.get_json_object("json", p).cast(t)
    totals = [at(f"$.totals.{c}", "long").alias(c) for c in ("requests", "ok", "rate_limited", "entities")]
    return made.select(at("$.release_id").alias("release_id"), at("$.config.run.workers", "long").alias("workers"), at("$.config.filters.area").alias("area"), *totals, at("$.outputs.raw_dir").alias("raw_dir"))


@query("""
SELECT 'AB' || lpad(CAST(coalesce(c_custkey, s_suppkey) AS VARCHAR), 8, '0') AS entity_id, CASE WHEN length(CAST(c_custkey AS VARCHAR)) <= 5 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS cap,
    CASE c_custkey % 2 WHEN 0 THEN 'Liceo classico' WHEN 1 THEN 'ZZ' END AS "tipoDiIstruzione", coalesce(c_name, 'later') AS nome, s_name AS altro
FROM customer FULL JOIN supplier ON s_suppkey = c_custkey -- a postal code has five digits at most, a longer number is none
""")
def registry_union(spark, sf_dir):
    a = table(spark, sf_dir, "customer").selectExpr("concat('ab', lpad(c_custkey, 8, '0')) AS codice", "cast(c_custkey AS string) AS CAP", "if(c_custkey % 2 = 0, 'pc ', 'zz') AS tipo_di_istruzione", "c_name AS nome", "c_custkey AS o")
    b = table(spark, sf_dir, "supplier").selectExpr("concat('AB', lpad(s_suppkey, 8, '0'), ' ') AS CODICE_SCUOLA", "'later' AS nome", "s_name AS altro", "s_suppkey AS o")
    return csv.load_registry([a, b], "o")


@query("SELECT place_key, prov_key, region, macroarea FROM (SELECT 'NATION ' || n_nationkey AS place_key, CASE WHEN n_nationkey % 2 = 0 THEN 'P' || n_nationkey % 3 ELSE '' END AS prov_key, r_name AS region, n_name AS macroarea FROM nation JOIN region ON n_regionkey = r_regionkey)")
def lookup_loaders(spark, sf_dir):
    path = sinks.work_dir(spark, "lookup")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"]).selectExpr("n_nationkey AS ord", "n_name AS `Denominazione in italiano`", "r_name AS `Denominazione Regione`", "n_name AS `Ripartizione geografica`", "if(n_nationkey % 2 = 0, concat('p', n_nationkey % 3), '') AS Sigla")
    rows.unionByName(rows.withColumn("ord", F.col("ord") + 100)).write.options(header=True, sep=";").csv(path)
    read = csv.read_flexible(spark, [path])
    name = lambda *c: pick_column(read, list(c), required=True)
    return municipality_lookup(read, name("Denominazione in italiano"), name("Sigla automobilistica", "Sigla"), name("Denominazione Regione"), name("Ripartizione geografica"), [F.col("ORD").cast("int")]).drop("src_ord")


@query("SELECT 'S' || c_custkey AS entity_id, c_name AS entity_name, c_mktsegment AS \"REGIONE\" FROM customer WHERE c_mktsegment = 'BUILDING'")
def school_list(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rows = c.selectExpr("concat(' S', c_custkey) AS ` \"CODICESCUOLA\"`", "c_name AS DENOMINAZIONESCUOLA", "c_mktsegment AS REGIONE", "c_custkey AS o")
    again = rows.withColumn("DENOMINAZIONESCUOLA", F.lit("later")).withColumn("o", F.col("o") + 1_000_000)
    blank = rows.limit(5).withColumn(' "CODICESCUOLA"', F.lit("  "))
    return csv.read_school_list(rows.unionByName(again).unionByName(blank), [F.col("o")]).where("REGIONE = 'BUILDING'").select("entity_id", "entity_name", "REGIONE")


@query("SELECT 'E' || n_nationkey AS endpoint_key, n_name AS nome, 'https://h.example/' || n_nationkey AS url_template FROM nation WHERE n_nationkey % 5 <> 0")
def endpoint_catalogue(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").selectExpr("if(n_nationkey % 10 = 0, ' ', concat('E', n_nationkey)) AS codice_ep", "n_name AS nome", "if(n_nationkey % 10 = 5, NULL, concat('https://h.example/', n_nationkey)) AS url")
    return csv.read_catalogue(rows)


@query("SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS endpoint_key, user_id % 3 <> 0 AS ok, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY ALL")
def json_documents(spark, sf_dir):
    """A file for each of the users' documents, read back with its key out of the path."""
    path = sinks.work_dir(spark, "json")
    docs = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    body = F.when(F.col("user_id") % 3 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("user_id", "event_type")))
    sinks.write_document_files(docs.select(F.col("user_id").alias("entity_id"), F.col("event_type").alias("endpoint_key"), body.alias("body")), path)
    rows = csv.read_documents(spark, path)
    # names were encoded for the files, and come encoded once more in the path
    key = (F.url_decode("entity_id").alias("entity_id"), F.url_decode(F.url_decode("endpoint_key")).alias("endpoint_key"))
    return rows.groupBy(*key, "ok").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {OBS_SQL}, a AS (SELECT *, CASE user_id % 3 WHEN 0 THEN 'CENTRO' WHEN 1 THEN 'SUD' END AS area FROM obs JOIN (SELECT event_id, user_id FROM events) ON event_id = ord)
SELECT 'ALL' AS package, count(DISTINCT entity_id) AS rows, count(DISTINCT entity_id) AS entities FROM a UNION ALL SELECT 'areas/' || area, count(DISTINCT entity_id), count(DISTINCT entity_id) FROM a WHERE area IS NOT NULL GROUP BY area""")
def release_layout(spark, sf_dir):
    from .queries_wide import YEAR_BLOCKS

    area = F.when(F.col("entity_id").cast("int") % 3 == 0, "CENTRO").when(F.col("entity_id").cast("int") % 3 == 1, "SUD")
    obs = observations(spark, sf_dir).withColumn("area", area)
    packages = release.release(obs, sinks.work_dir(spark, "release"), "v1", YEAR_BLOCKS[:1])
    return packages.withColumn("entities", F.col("rows"))  # an entity has one row in a package


def _written_release(spark, sf_dir):
    """A release of two areas with a registry and a lookup that lacks some places; where it is."""
    from .queries_wide import YEAR_BLOCKS, _places, _registry

    area = F.when(F.col("src_ord") % 3 == 0, "CENTRO").when(F.col("src_ord") % 3 == 1, "SUD")
    obs = observations(spark, sf_dir).withColumns({"area": area, "src_file": F.concat(F.lit("/in/"), F.col("src_ord") % 6, F.lit(".csv"))})
    root, sides = sinks.work_dir(spark, "release"), Sides(registry=_registry(spark, sf_dir), places=_places(spark, sf_dir))
    release.release(obs, root, "v1", YEAR_BLOCKS[:1], sides, inputs=("/in",))
    return root


_RELEASE_OBS = """a AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, value AS v, event_type AS ep, event_id AS ord, 1 + (day(ts) - 1) // 7 AS y, CASE event_id % 3 WHEN 0 THEN 'CENTRO' WHEN 1 THEN 'SUD' END AS area, event_id % 6 AS file FROM events),
p AS (SELECT 'ALL' AS package, * FROM a UNION ALL SELECT 'areas/' || area, * FROM a WHERE area IS NOT NULL),
r AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_id, 'NATION_' || c_nationkey AS comune, 'P' || c_nationkey % 3 AS provincia, c_nationkey % 7 = 0 AS lost FROM customer)"""


@query(f"""WITH {_RELEASE_OBS} SELECT package, 'v1' AS version, ['/in'] AS inputs, count(DISTINCT entity_id) AS rows, count(*) AS long_rows, count(DISTINCT file) AS files, TRUE AS has_parts, count(DISTINCT CASE WHEN ep = 'view' AND v IS NOT NULL THEN y END) AS year_columns,
    count(DISTINCT CASE WHEN lost THEN entity_id END) AS unmatched, TRUE AS merge_registry, FALSE AS merge_figures, TRUE AS merge_places, ['ALL', 'areas/CENTRO', 'areas/SUD'] AS packages
FROM p LEFT JOIN r USING (entity_id) GROUP BY package""")
def release_manifests(spark, sf_dir):
    """The manifests of all packages of a release, and its root manifest, read back."""
    root = _written_release(spark, sf_dir)
    schema = "package string, version string, inputs array<string>, rows long, column_names array<string>, long_rows long, files long, long_parts long, unmatched long, merge_registry boolean, merge_figures boolean, merge_places boolean"
    made = release.read_manifests(spark, root, "v1", schema)
    top = spark.read.text(f"{root}/v1/manifest").select(F.from_json("value", "release_id string, packages array<string>").alias("t")).select(F.col("t.release_id").alias("version"), "t.packages")
    years = F.size(F.filter("column_names", lambda c: c.rlike("^10_view_y[0-9]+$"))).cast("long")
    made = made.withColumns({"has_parts": F.col("long_parts") > 0, "year_columns": years}).join(F.broadcast(top), "version")  # one row
    return made.drop("column_names", "long_parts")


@query(f"""WITH {_RELEASE_OBS} SELECT DISTINCT package, entity_id, comune, provincia FROM p JOIN r USING (entity_id) WHERE lost""")
def release_unmatched(spark, sf_dir):
    """The unmatched rows that the packages of a release were written with."""
    path = f"{_written_release(spark, sf_dir)}/v1"
    read = lambda place: spark.read.option("header", True).csv(f"{path}/{place}/unmatched.csv")
    columns = ["package", "entity_id", "comune", "provincia"]
    areas = read("areas").withColumn("package", F.concat(F.lit("areas/"), release.AREA))
    return read("ALL").withColumn("package", F.lit("ALL")).select(columns).unionByName(areas.select(columns))


@query("SELECT 'b' AS run, user_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY user_id UNION ALL SELECT 'a', user_id, count(*) FROM events WHERE event_type = 'view' GROUP BY user_id")
def fetch_log_roundtrip(spark, sf_dir):
    path, log = sinks.work_dir(spark, "log"), table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    sinks.append_log(log.where("event_type = 'error'"), path, "b")
    sinks.append_log(log.where("event_type = 'view'"), path, "a")
    sinks.append_log(log.where("event_type = 'click'"), path, "b")  # replaces the first
    return spark.read.parquet(path).groupBy("run", "user_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {OBS_SQL} SELECT entity_id, endpoint_key, 'y' || y AS category, arg_min(v, ord) AS value_num, min(ord) AS src_ord FROM obs GROUP BY ALL")
def incremental_ingest(spark, sf_dir):
    """Two landings, the second of which holds some rows again; only new files are taken, first deliveries count."""
    path = sinks.work_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    normalize = lambda batch: batch.selectExpr("cast(user_id AS string) AS entity_id", "event_type AS endpoint_key", "concat('y', 1 + (day(ts) - 1) div 7) AS category", "value AS value_num", "event_id AS src_ord")
    half = events.agg(F.max("event_id")).first()[0] // 2
    for landed in (events.where(F.col("event_id") <= half), events.where((F.col("event_id") > half) | (F.col("event_id") % 10 == 0))):
        landed.write.mode("append").parquet(f"{path}/in")
        streaming.ingest(spark, f"{path}/in", events.schema, f"{path}/out", f"{path}/checkpoint", normalize)
    return streaming.first_delivery(spark.read.parquet(f"{path}/out"), ["entity_id", "endpoint_key", "category"])


@query("SELECT code, count(*) AS n FROM (SELECT 'RM' || lpad(CAST(c_nationkey AS VARCHAR), 8, '0') AS code FROM customer UNION ALL SELECT 'RM' || lpad(CAST(s_nationkey AS VARCHAR), 8, '0') FROM supplier) GROUP BY code")
def union_by_code(spark, sf_dir):
    a = table(spark, sf_dir, "customer").selectExpr("concat('rm', lpad(c_nationkey, 8, '0'), ' x') AS raw", "c_name AS a")
    b = table(spark, sf_dir, "supplier").selectExpr("concat(' RM', lpad(s_nationkey, 8, '0')) AS raw", "s_name AS b")
    return union_all([a, b]).groupBy(canonical_code(F.col("raw")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


_RENAMED = "80_rav_22a1_invalsipunteggiomedio_superiori_classiseconde_{}_punteggio_medio_"
_FIRST = "arg_min(v, p_partkey) FILTER (v IS NOT NULL AND k = {k} AND cls = '{c}' AND sub = '{s}')"
_VARIED = "80_rav_22b2_variabilitapunteggi_licei_superiori_classiseconde_{}_traleclassi"


@query(f"""WITH {_REPORT_SQL}, {OBS_SQL}, g AS (SELECT CAST(p_partkey % 50 AS VARCHAR) AS entity_id, * EXCLUDE (entity_id) FROM rep WHERE k IN (0, 1, 5, 6) AND NOT bad_a),
r AS (SELECT entity_id, """ + ", ".join(f'{_FIRST.format(k=k, c=c, s=s)} AS "{n}"' for k, c, s, n in [
    *[(0, "seconde", s, _RENAMED.format(s)) for s in ("italiano", "matematica")],
    *[(1, "seconde", s, _RENAMED.format(s).replace("punteggio_medio", "diff_escs")) for s in ("italiano", "matematica")],
    *[(k, "quinte", s, f"80_rav_22a1_invalsipunteggiomedio_superiori_classi_quinte_{s}_{m}_") for s in ("italiano", "matematica") for k, m in ((0, "punteggio_medio"), (1, "diff_escs"))],
]) + f""", arg_min(v, p_partkey) FILTER (v IS NOT NULL AND k = 5) AS "{_VARIED.format('italiano')}", arg_min(v, p_partkey) FILTER (v IS NOT NULL AND k = 6) AS "{_VARIED.format('inglesereading')}" FROM g GROUP BY entity_id),
w AS (SELECT entity_id, min(entity_name) AS entity_name, sum(v) FILTER (endpoint_key = 'purchase' AND scope) AS "13_purchase_sum",
    {", ".join(f"arg_min(v, ord) FILTER (endpoint_key = 'click' AND scope AND y = {y}) AS \"20_entrate_y{y}_pct\"" for y in range(1, 6))} FROM obs GROUP BY entity_id)
SELECT w.*, r.* EXCLUDE (entity_id), list_avg(["{_RENAMED.format('italiano')}", "{_RENAMED.format('matematica')}"]) AS "*media_punteggiomedio_superiori_classiseconde", CAST(NULL AS DOUBLE) AS "*media_punteggiomedio_superiori_classiquinteultimoanno"
FROM w LEFT JOIN r USING (entity_id)""")
def wide_reports(spark, sf_dir):
    """The wide table with a report side, whose column names are shortened and means added, and an open pivot."""
    good, _ = reports.clean_reports(_report_rows(spark, sf_dir), on_bad="quarantine")
    side = reports.report_wide(good.withColumn("entity_id", F.regexp_replace("entity_id", "^RM0*(?=.)", "")))
    return build_wide(observations(spark, sf_dir), [Total("purchase", "13_", name="purchase_sum"), Shares("click", "20_")], Sides(reports=side), slopes="none")


@query("SELECT s_suppkey AS entity_id, s_name AS \"05_s_name\", s_acctbal AS \"05_s_acctbal\" FROM supplier")
def prefixed_columns(spark, sf_dir):
    return prefix_columns(table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS entity_id", "s_name", "s_acctbal AS `05_s_acctbal`"), "05_")
