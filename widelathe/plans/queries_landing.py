"""Queries of landed data: variant documents, streams with state, bucketed tables, counts taken while writing, collated keys."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.labels import readable_report_label
from ..operators import charts, combine, enrich
from ..sources import sinks
from ..streaming import ingest as streaming
from .queries_io import _CHART_SQL, _REPORT_SQL, _charts, _report_rows
from .registry import query, table


def _landed(spark, docs):
    """Documents as they lie in a variant table."""
    path = sinks.work_dir(spark, "documents")
    sinks.write_documents(docs, path)
    return spark.read.parquet(path)


@query(f"WITH {_CHART_SQL} SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS endpoint_key, kind, series_name, category_index::INTEGER AS category_index, category, round(value, 6) AS value FROM c WHERE event_type <> 'signup'")
def landed_charts(spark, sf_dir):
    """Charts read by path out of a variant column, which was parsed when the documents landed."""
    rows = charts.observations(_landed(spark, _charts(spark, sf_dir)), body="doc", keep=("entity_id", "endpoint_key"))
    return rows.select("entity_id", "endpoint_key", "kind", "series_name", "category_index", "category", F.round(F.col("value").cast("double"), 6).alias("value"))


@query("SELECT event_id, event_id % 4 IN (1, 2) AS valid, CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 3 THEN '{' || props END AS bad_body FROM events")
def landed_cache(spark, sf_dir):
    """Which landed documents need no fetch, and the text of those that are no JSON."""
    docs = table(spark, sf_dir, "events").selectExpr("event_id", "if(event_id % 4 = 0, '', if(event_id % 4 = 3, concat('{', props), props)) AS body", "event_id % 4 != 2 AS is_json")
    landed = _landed(spark, docs)
    good = combine.valid_cache(landed).select("event_id", F.lit(True).alias("valid"))
    return landed.select("event_id", "bad_body").join(good, "event_id", "left").select("event_id", F.coalesce("valid", F.lit(False)).alias("valid"), "bad_body")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS entity_id, c_name AS nome, c_nationkey::BIGINT AS numero, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 2 = 0 END AS attiva, CASE WHEN c_custkey % 3 = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'x' END END AS misto,
    'ok' AS esito, c_custkey::BIGINT AS n_elements FROM customer WHERE c_custkey % 4 <> 1""")
def registry_typed(spark, sf_dir):
    """Registries whose fields and types are found by one aggregate over a variant column; one field is of two types and stays text."""
    own = "concat('{\"nome\":', to_json(c_name), ',\"numero\":', c_nationkey, CASE c_custkey % 3 WHEN 0 THEN concat(',\"attiva\":', c_custkey % 2 = 0) WHEN 1 THEN concat(',\"misto\":', if(c_custkey % 2 = 0, cast(c_custkey AS string), '\"x\"')) ELSE '' END, '}')"
    own = own.replace("to_json(c_name)", "concat('\"', c_name, '\"')")
    body = f"if(c_custkey % 4 = 1, '{{\"scuole\":[]}}', concat('{{\"scuole\":[', {own}, '],\"esito\":\"ok\",\"numeroTotaleElementi\":', c_custkey, '}}')) AS body"
    docs = _landed(spark, table(spark, sf_dir, "customer").selectExpr("cast(c_custkey AS string) AS entity_id", body))
    return charts.registry_rows(docs, body="doc", typed=True)


@query(f"""WITH {_REPORT_SQL} SELECT CASE WHEN k = 7 THEN 'dropped_descriptor' WHEN k = 2 THEN 'dropped_label' WHEN k = 3 THEN 'dropped_measure' WHEN bad_a OR bad_b THEN 'bad' ELSE 'clean' END AS place, count(*) AS n FROM rep GROUP BY 1""")
def clean_counts(spark, sf_dir):
    """How many rows went where, counted while reports were cleaned and written."""
    path = sinks.work_dir(spark, "clean")
    counts = sinks.write_clean(_report_rows(spark, sf_dir), f"{path}/good", "quarantine", f"{path}/bad")
    return spark.createDataFrame(list(counts.items()), "place string, n long").where("n > 0")


@query("SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS endpoint_key, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY ALL")
def deduplicated_ingest(spark, sf_dir):
    """Two landings with repeats in the same and in a later batch, each observation taken once by the stream's state."""
    path = sinks.work_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    normalize = lambda stream: stream.selectExpr("cast(user_id AS string) AS entity_id", "event_type AS endpoint_key", "value AS value_num", "event_id AS src_ord", "cast(ts AS timestamp) AS ts")
    half = events.agg(F.max("event_id")).first()[0] // 2
    early, late = events.where(F.col("event_id") <= half), events.where(F.col("event_id") > half)
    for landed in (early.unionByName(early.where("event_id % 10 = 0")), late.unionByName(early.where("event_id % 7 = 0"))):
        landed.write.mode("append").parquet(f"{path}/in")
        streaming.ingest_once(spark, f"{path}/in", events.schema, f"{path}/out", f"{path}/checkpoint", normalize, keys=["src_ord"], time="ts", late="1000 days")
    taken = spark.read.parquet(f"{path}/out")
    return taken.groupBy("entity_id", "endpoint_key").agg(F.count(F.lit(1)).alias("n"), F.sum("src_ord").alias("ids"))


@query("SELECT c_custkey AS user_id, event_type FROM customer, (SELECT DISTINCT event_type FROM events) EXCEPT SELECT user_id, event_type FROM events WHERE value > 10")
def backlog_bucketed(spark, sf_dir):
    """The backlog against a landed table in buckets of its keys, which stays where it lies."""
    from .queries_wide import work_list

    name, keys = f"landed_{uuid.uuid4().hex}", ["user_id", "event_type"]
    landed = table(spark, sf_dir, "events").where("value > 10").select(*keys).distinct()
    sinks.write_bucketed(landed, name, sinks.work_dir(spark, "landed"), keys, 8)
    return combine.backlog_of_table(work_list(spark, sf_dir), name, keys)


@query("SELECT event_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY ALL")
def windowed_activity(spark, sf_dir):
    """Counts and sums by day and type out of a stream of landed events, as its last update left them."""
    path = sinks.work_dir(spark, "activity")
    events = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    events.repartition(4).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    counted = streaming.windowed_activity(stream, "ts", ["event_type"], late="100 days")
    keep = lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/out")
    counted.writeStream.foreachBatch(keep).outputMode("complete").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").select("event_type", F.col("window.start").cast("timestamp_ntz").alias("day"), "n", F.round("value", 2).alias("value"))


@query(r"""
WITH l AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '2.4.c.1' ELSE '2.2.b.2' END AS d, CASE p_partkey % 4 WHEN 0 THEN 'Situazione della scuola - classi | ' || p_name WHEN 1 THEN 'a|b|' || p_name || '|x' WHEN 2 THEN 'x_|_|' || p_name || '_|_y' ELSE '  ' || p_name || ' ' END AS c FROM part),
t AS (SELECT p_partkey, CASE WHEN d = '2.4.c.1' AND len(string_split(c, '|')) > 2 THEN array_to_string(string_split(c, '|')[3:], '|') ELSE c END AS c FROM l),
r AS (SELECT p_partkey, regexp_replace(replace(replace(c, '_|_|', ''), '_|_', ''), '(?i)situazione[_ ]+della[_ ]+scuola', '', 'g') AS c FROM t)
SELECT p_partkey, trim(regexp_replace(regexp_replace(c, '[|_\\\-–—]+', ' ', 'g'), '\s+', ' ', 'g')) AS label FROM r
""")
def report_labels(spark, sf_dir):
    """Labels of report columns for readers; of the descriptor with four parts only the last ones count."""
    label = "CASE p_partkey % 4 WHEN 0 THEN concat('Situazione della scuola - classi | ', p_name) WHEN 1 THEN concat('a|b|', p_name, '|x') WHEN 2 THEN concat('x_|_|', p_name, '_|_y') ELSE concat('  ', p_name, ' ') END"
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "if(p_partkey % 3 = 0, '2.4.c.1', '2.2.b.2') AS descriptor", f"{label} AS column")
    return rows.select("p_partkey", readable_report_label(F.col("descriptor"), F.col("column")).alias("label"))


_SPELT = "CASE {k} % 3 WHEN 0 THEN 'Forlì d''Està ' || {n} WHEN 1 THEN 'FORLI D''ESTA ' || {n} ELSE 'forlí d''èstâ ' || {n} END"


@query(f"""WITH look AS (SELECT strip_accents(lower({_SPELT.format(k='(n_nationkey + 1)', n='n_nationkey')})) AS k, 'class ' || n_regionkey AS c FROM nation WHERE n_nationkey % 5 <> 0)
SELECT c_custkey, {_SPELT.format(k='c_custkey', n='c_nationkey')} AS place, coalesce(c, 'none') AS class FROM customer LEFT JOIN look ON k = strip_accents(lower({_SPELT.format(k='c_custkey', n='c_nationkey')}))""")
def collated_lookup(spark, sf_dir):
    """A lookup whose keys are compared by a collation that is blind to case and accents; each place stands in it twice, spelt differently."""
    spelt = lambda k, n: F.expr(_SPELT.format(k=k, n=n).replace("''", "\\'"))
    nation = table(spark, sf_dir, "nation").where("n_nationkey % 5 != 0")
    look = nation.select(spelt("(n_nationkey + 1)", "n_nationkey").alias("place"), F.concat(F.lit("class "), "n_regionkey").alias("class"))
    look = look.unionByName(look.withColumn("place", F.upper("place")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", spelt("c_custkey", "c_nationkey").alias("place"))
    return enrich.lookup_with_default(rows, look, "place", "class", "none", collation="UNICODE_CI_AI")
