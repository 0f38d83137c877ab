"""Queries of scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels, numbers, text
from ..operators import combine
from .registry import query, table

_C = "customer"


@query("""
WITH s AS (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN ' 1.234,' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') WHEN 1 THEN CAST(c_custkey AS VARCHAR) || ',5'
    WHEN 2 THEN CAST(c_custkey AS VARCHAR) || '.25' WHEN 3 THEN CAST(c_custkey AS VARCHAR) || ' %' WHEN 4 THEN 'n.d.' WHEN 5 THEN '' ELSE '1 ' || CAST(100 + c_custkey % 900 AS VARCHAR) || ',5' END AS raw FROM customer)
SELECT c_custkey, raw, CASE c_custkey % 7 WHEN 0 THEN 1234 + (c_custkey % 100) / 100.0 WHEN 1 THEN c_custkey + 0.5 WHEN 2 THEN c_custkey + 0.25 WHEN 3 THEN CAST(c_custkey AS DOUBLE)
    WHEN 6 THEN 1000 + (100 + c_custkey % 900) + 0.5 END AS value_num, CASE WHEN c_custkey % 7 = 4 THEN 'n.d.' ELSE '' END AS value_text FROM s
""")
def parse_number_eu(spark, sf_dir):
    raw = """CASE c_custkey % 7 WHEN 0 THEN concat(' 1.234,', lpad(c_custkey % 100, 2, '0')) WHEN 1 THEN concat(c_custkey, ',5') WHEN 2 THEN concat(c_custkey, '.25')
        WHEN 3 THEN concat(c_custkey, ' %') WHEN 4 THEN 'n.d.' WHEN 5 THEN '' ELSE concat('1 ', 100 + c_custkey % 900, ',5') END AS raw"""
    rows = table(spark, sf_dir, _C).selectExpr("c_custkey", raw)
    number, rest = numbers.split_value(F.col("raw"))
    return rows.select("c_custkey", "raw", number.alias("value_num"), rest.alias("value_text"))


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_partkey + 0.5 WHEN 1 THEN CAST(p_partkey AS DOUBLE) END AS v FROM part
""")
def parse_number_decimal_comma(spark, sf_dir):
    raw = "CASE p_partkey % 4 WHEN 0 THEN concat(p_partkey, ',5') WHEN 1 THEN concat(p_partkey, '%') WHEN 2 THEN 'N.D.' ELSE concat('1.', 100 + p_partkey, ',4') END AS raw"
    return table(spark, sf_dir, "part").selectExpr("p_partkey", raw).select("p_partkey", numbers.parse_number(F.col("raw"), "decimal_comma").alias("v"))


@query("""
SELECT p_partkey, p_partkey + 0.5 AS v, 12.5 AS w FROM part
""")
def parse_number_it_first(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "concat('circa ', p_partkey, ',5 euro') AS a", "concat('12,5 su ', p_partkey) AS b")
    return rows.select("p_partkey", numbers.parse_number(F.col("a"), "it_first").alias("v"), numbers.parse_number(F.col("b"), "it_first").alias("w"))


@query("SELECT c_custkey, c_custkey * 10 + 1 AS n FROM customer")
def parse_number_int(spark, sf_dir):
    return table(spark, sf_dir, _C).select("c_custkey", numbers.parse_int(F.concat(F.lit("studenti: "), F.col("c_custkey"), F.lit(",1"))).alias("n"))


@query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'RM' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') WHEN 1 THEN 'RM' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') ELSE 'RMPS' || p_partkey END AS code FROM part
""")
def canon_code(spark, sf_dir):
    raw = "CASE p_partkey % 3 WHEN 0 THEN concat(' rm', lpad(p_partkey, 8, '0'), ' ') WHEN 1 THEN concat('cod: rm', lpad(p_partkey, 8, '0'), ' (sede)') ELSE concat('rm-ps ', p_partkey) END AS raw"
    return table(spark, sf_dir, "part").selectExpr("p_partkey", raw).select("p_partkey", text.canonical_code(F.col("raw")).alias("code"))


@query("""
SELECT o_orderkey, trim(regexp_replace(lower(o_orderpriority || ' / ' || o_orderstatus), '[^a-z0-9_]+', '_', 'g'), '_') AS slug,
    substr(trim(regexp_replace(lower(o_orderpriority || ' / ' || o_orderstatus), '[^a-z0-9_]+', '_', 'g'), '_'), 1, 7) AS short,
    CASE WHEN o_orderkey % 5 = 0 THEN 'cat_empty' ELSE trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9_]+', '_', 'g'), '_') END AS named FROM orders
""")
def slug_labels(spark, sf_dir):
    label = F.concat("o_orderpriority", F.lit(" / "), "o_orderstatus")
    blank = F.when(F.col("o_orderkey") % 5 == 0, F.lit("  ")).otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.slug(label).alias("slug"), text.slug(label, 7).alias("short"), text.slug_or(blank, "cat_empty", 40).alias("named"))


@query(r"""
WITH t AS (SELECT doc_id, replace(coalesce(text, ''), 'ß', 'ss') AS s FROM documents),
u AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(upper(strip_accents(s)), '^[\s]+|[\s]+$', '', 'g'), '’', '''', 'g'), '([AEIOU])''', '\1', 'g') AS a, upper(strip_accents(s)) AS b, s FROM t)
SELECT doc_id, trim(regexp_replace(regexp_replace(a, '[^A-Z0-9'' ]+', ' ', 'g'), ' +', ' ', 'g')) AS place,
    trim(regexp_replace(regexp_replace(b, '[^A-Z0-9]+', ' ', 'g'), ' +', ' ', 'g')) AS spaced FROM u
""")
def place_key(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", text.plain_upper(F.coalesce("text", F.lit(""))).alias("plain"))
    return rows.select("doc_id", text.place_key(F.col("plain"), plain=True).alias("place"), text.place_key_spaced(F.col("plain"), plain=True).alias("spaced"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 1 THEN '' ELSE lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS cap FROM customer WHERE c_custkey < 100000
UNION ALL SELECT c_custkey, '' FROM customer WHERE c_custkey >= 100000
""")
def postcode(spark, sf_dir):
    raw = F.when(F.col("c_custkey") % 5 == 1, F.concat(F.lit("CH-"), "c_custkey")).otherwise(F.concat(F.lit(" "), "c_custkey"))
    return table(spark, sf_dir, _C).select("c_custkey", text.postal_code(raw).alias("cap"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Istituto tecnico (Informatica e telecomunicazioni)' WHEN 'O' THEN 'Liceo classico' ELSE 'ZP' END AS label FROM orders")
def label_map(spark, sf_dir):
    code = F.expr("CASE o_orderstatus WHEN 'F' THEN ' tf' WHEN 'O' THEN 'PC' ELSE 'zp ' END")
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.map_label(code).alias("label"))


@query("""
SELECT o_orderkey, CAST(CASE o_orderkey % 5 WHEN 0 THEN 1 + o_orderkey % 6 WHEN 1 THEN 3 WHEN 2 THEN year(o_orderdate) WHEN 3 THEN NULL ELSE 5 END AS INTEGER) AS y FROM orders
""")
def year_from_label(spark, sf_dir):
    label = """CASE o_orderkey % 5 WHEN 0 THEN concat('y', 1 + o_orderkey % 6) WHEN 1 THEN 'Anno 3' WHEN 2 THEN concat('a.s. ', year(o_orderdate), '/', right(year(o_orderdate) + 1, 2))
        WHEN 3 THEN '10' ELSE '5° anno' END AS label"""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", label).select("o_orderkey", numbers.year_index(F.col("label")).alias("y"))


@query("""
SELECT p_partkey, 'https://host.example/api/' || 'P' || p_partkey || '/x/' || replace(p_name, ' ', '%20') AS url, 'https://host.example/s/P' || p_partkey AS short FROM part
""")
def request_url(spark, sf_dir):
    code = F.concat(F.lit("P"), "p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", text.request_url(F.lit("https://host.example/api/{CODE}/x/{NAME}"), code, F.col("p_name")).alias("url"), text.request_url(F.lit("https://host.example/s/{CODE}"), code).alias("short"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'x' ELSE substr(regexp_replace(p_name || ' / ' || p_brand, '[^A-Za-z0-9_.-]+', '_', 'g'), 1, 180) END AS name FROM part")
def safe_name(spark, sf_dir):
    raw = F.when(F.col("p_partkey") % 9 != 0, F.concat("p_name", F.lit(" / "), "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", text.safe_name(raw).alias("name"))


_LABEL_A = "CASE WHEN p_partkey % 10 = 0 THEN p_name WHEN p_partkey % 10 = 1 THEN concat(p_name, ' - ', p_brand) ELSE concat(p_name, '  - ', p_brand, ' | ', p_type, ' | ', p_size) END"


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 10 > 1 THEN p_name END AS a1, CASE WHEN p_partkey % 10 > 1 THEN p_brand END AS a2, CASE WHEN p_partkey % 10 > 1 THEN p_type || ' | ' || p_size END AS a3,
    CASE p_partkey % 10 WHEN 0 THEN 'missing " - "' WHEN 1 THEN 'missing " | " after " - "' END AS error FROM part
""")
def split_label_a(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", labels.split_label_a(F.expr(_LABEL_A)).alias("s")).select("p_partkey", "s.*")


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 10 > 1 THEN p_name END AS b1, CASE WHEN p_partkey % 10 > 1 THEN p_brand END AS b2, CASE WHEN p_partkey % 10 > 1 THEN p_type || ' - z' END AS b3,
    CASE WHEN p_partkey % 10 > 1 THEN CAST(p_size AS VARCHAR) END AS b4, CASE WHEN p_partkey % 10 > 1 THEN 'x | y' END AS b5,
    CASE p_partkey % 10 WHEN 0 THEN 'not enough " - "' WHEN 1 THEN 'not enough " | "' END AS error FROM part
""")
def split_label_b(spark, sf_dir):
    raw = """CASE p_partkey % 10 WHEN 0 THEN concat('Variabilità dei punteggi - ', p_name, ' - ', p_brand) WHEN 1 THEN concat(p_name, ' - ', p_brand, ' - ', p_type, ' | ', p_size)
        ELSE concat('variabilitÃ  dei  punteggi - ', p_name, ' - ', p_brand, ' - ', p_type, ' - z | ', p_size, ' | x | y') END"""
    return table(spark, sf_dir, "part").select("p_partkey", labels.split_label_b(F.expr(raw)).alias("s")).select("p_partkey", "s.*")


@query("SELECT p_partkey, p_name || ' di ' || p_brand AS label FROM part")
def strip_prefix(spark, sf_dir):
    raw = "CASE p_partkey % 3 WHEN 0 THEN concat('VARIABILITA dei punteggi -  ', p_name, ' di ', p_brand) WHEN 1 THEN concat(' ', p_name, '  di ', p_brand) ELSE concat('variabilità dei punteggi - ', p_name, ' di ', p_brand) END"
    return table(spark, sf_dir, "part").select("p_partkey", labels.strip_prefix(F.expr(raw)).alias("label"))


@query(r"""
SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS clean FROM documents
""")
def text_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("clean"))


@query("""
SELECT o_orderkey, trim(o_orderstatus || ' medie ii mat ' || regexp_replace(lower(o_orderpriority), '[-_ ]+', ' ', 'g')) AS short,
    trim(o_orderstatus || ' scuola secondaria di i grado classi seconde matematica ' || regexp_replace(lower(o_orderpriority), '[-_ ]+', ' ', 'g')) AS plain FROM orders
""")
def label_normalize(spark, sf_dir):
    raw = F.concat("o_orderstatus", F.lit("_|_ scuola_secondaria_di_i_grado | classi_seconde – matematica "), F.lower("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.readable_label(raw, short=True).alias("short"), labels.readable_label(raw).alias("plain"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'valore' ELSE 'sezione_' || o_orderkey % 7 END AS heading, CASE WHEN o_orderkey % 7 IN (2, 5) THEN '' ELSE o_orderpriority END AS value FROM orders
""")
def heading_defaults(spark, sf_dir):
    heading = F.concat(F.lit("sezione_"), F.col("o_orderkey") % 7)
    index = F.when(F.col("o_orderkey") % 4 == 0, F.lit(-1)).otherwise(F.lit(1))
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.heading_or_default(heading, index).alias("heading"), labels.blank_special(heading, F.col("o_orderpriority")).alias("value"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'scuola' WHEN 1 THEN lower(o_orderpriority) ELSE 'a, b_' || lower(o_orderstatus) END AS label FROM orders")
def column_label_norm(spark, sf_dir):
    raw = F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'RMIC812345 ' WHEN 1 THEN concat('Situazione della  scuola: ', o_orderpriority) ELSE concat('_A,, B__', o_orderstatus, '_') END")
    rows = table(spark, sf_dir, "orders").withColumn("raw", F.when(F.col("o_orderkey") % 3 == 0, F.lit("RMIC812345")).otherwise(raw))
    return rows.select("o_orderkey", labels.column_label(F.col("raw")).alias("label"))


@query("""
SELECT doc_id, contains(lower(coalesce(text, '')), 'classi') AS classi, regexp_matches(coalesce(text, ''), '(?i)\\bthe\\b') AS word FROM documents
""".replace("\\\\", "\\"))
def row_label_predicates(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.has_part(F.col("text"), "classi").alias("classi"), F.coalesce("text", F.lit("")).rlike(r"(?i)\bthe\b").alias("word"))


@query("""
SELECT doc_id, array_to_string(list_filter(lines, lambda x, i: list_position(lines, x) = i), '|') AS headings FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
""")
def distinct_headings(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_distinct(F.split(F.coalesce("text", F.lit("")), "\n")), "|").alias("headings"))


@query("SELECT doc_id, CASE WHEN length(coalesce(text, '')) > 300 THEN substr(text, 1, 299) || '…' ELSE coalesce(text, '') END AS cut FROM documents")
def truncate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate(F.col("text"), 300).alias("cut"))


@query("""
SELECT event_id, event_id % 4 <> 3 AS is_json, CASE WHEN event_id % 4 < 2 THEN '{"k":' || json_extract_string(props, '$.k') || '}' END AS canonical FROM events
""")
def json_sniff(spark, sf_dir):
    body = F.expr("CASE event_id % 4 WHEN 0 THEN concat('  ', props) WHEN 1 THEN props WHEN 2 THEN concat('[', props) ELSE concat('x', props) END")
    kind = F.when(F.col("event_id") % 4 == 1, F.lit("application/JSON")).otherwise(F.lit("text/html"))
    return table(spark, sf_dir, "events").select("event_id", text.looks_like_json(kind, body).alias("is_json"), text.canonical_json(body).alias("canonical"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def props_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(text, '[\r\n\t]', ' ', 'g'), '[\s\x0B]{2,}', ' ', 'g') AS text FROM documents")
def sanitize_csv(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.sanitize(F.col("text")).alias("text"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS digest, octet_length(encode(coalesce(text, ''))) AS bytes FROM documents")
def snapshot_hash(spark, sf_dir):
    content = F.coalesce("text", F.lit("")).cast("binary")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(content, 256).alias("digest"), F.octet_length(content).cast("long").alias("bytes"))


_SIGNATURE_SQL = """
WITH d AS (SELECT p_size, sha256('{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '"}') AS h FROM part),
n AS (SELECT p_size, list_transform([0, 1, 2, 3], lambda k: CAST('0x' || substr(h, 1 + 15 * k, 15) AS BIGINT)) AS v FROM d),
s AS (SELECT p_size, count(*) AS n, [sum(v[1]), sum(v[2]), sum(v[3]), sum(v[4])] AS t FROM n GROUP BY p_size)
SELECT p_size, sha256(n || '-' || array_to_string(t, '-')) AS signature FROM s
"""


@query(_SIGNATURE_SQL)
def input_signature(spark, sf_dir):
    """The signature of each size's parts, whose rows are dealt anew first."""
    part = table(spark, sf_dir, "part").repartition(7, "p_name")
    return combine.signatures(part, ["p_partkey", "p_name"], ["p_size"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 2 THEN '' ELSE o_orderstatus END AS modality FROM orders")
def report_modality(spark, sf_dir):
    descriptor = F.expr("CASE o_orderkey % 5 WHEN 0 THEN '1.1.a.2_std_dis' WHEN 1 THEN '1.1.a.3_std_dsa' ELSE '1.1.a.2' END")
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.report_modality(descriptor, F.col("o_orderstatus")).alias("modality"))


@query("SELECT doc_id, strip_accents(text) AS folded FROM documents")
def fold_accents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_accents_exact(F.col("text")).alias("folded"))
