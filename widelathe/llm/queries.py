"""The queries of the corpus operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, hard_negatives, html_extract, licences, mixing, quality, sharding, simhash, spelling, token_output, toxicity, url_filter
from .common import held_out, utf8_size

SHARDS = 40
TOKENIZER = "byte_bpe_50k.json"
#: (host, path, verdict) of the listed URLs.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(_read(spark, sf_dir, "pages"), columns=["page_id", "url"])
    return out.select("page_id", "url", "text", "n_chars", "n_template")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_read(spark, sf_dir, "documents"), k=3, tau=2)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (utf8_size(F.col("text")) + 16).alias("size"), F.crc32(text).alias("text_crc32"))
    out = sharding.assign_shards(rows, SHARDS, order=[F.col(c) for c in ("doc_id", "text_crc32", "size")])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return url_filter.filter_urls(_read(spark, sf_dir, "pages"), rules, columns=["page_id"])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_read(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, most=3.0, columns=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", "taken", "rounds")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    out = decontaminate.scan(docs.select("doc_id", "text"), items, size=10)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_output.token_table(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=0)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licences.scan(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", *labels, "score", "obligation")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(_read(spark, sf_dir, "documents"), least_letters=5, least_n=3, slip_one_in=97)
    return spelling.group_variants(words, ratio=2.0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector, id_ = F.col("embedding"), F.col("vec_id")
    rows = _read(spark, sf_dir, "embeddings").where(F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    label = F.when(id_ % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    whole = F.transform(vector, lambda v: F.floor(v.cast("double") * 256)).alias("embedding")
    return hard_negatives.mine(rows.select("vec_id", label, whole), id_ % 100 == 0, positives=5, negatives=10, low=30, high=90)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_html_extraction, op2_simhash_near_dedup, op3_toxicity, op4_sharding, op5_url_filter, op6_mixing, op7_quality, op8_decontamination, op9_exact_dedup, op10_token_output, op11_license_scan, op12_spelling_variants, op13_hard_negatives)
    return {f.__name__: f for f in own}


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP5_SQL = rf"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {", ".join(repr(r) for r in RULES)}),
urls AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_UPPER.lower()}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
numbered AS (SELECT *, row_number() OVER () AS n FROM urls),
fits AS (SELECT n, arg_max(rhost || rpath, length(rhost) * 1001 + length(rpath) * 1000) AS rule,
    arg_max(rverdict, length(rhost) * 1001 + length(rpath) * 1000) AS verdict
    FROM numbered JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM numbered LEFT JOIN fits USING (n)
"""

OP8_SQL = rf"""
WITH doc_words AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS win
    FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (SELECT r, k, n, array_to_string(w[k : k + n - 1], ' ') AS win
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc_words, sizes WHERE len(w) >= n)),
found AS (SELECT r, k, g.n, item FROM grams g JOIN windows USING (n, win)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT r, k, n FROM found)) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

OP9_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS place FROM n)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY place) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

OP13_SQL = r"""
WITH r AS (SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT a.u AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM r a JOIN r b ON a.u <> b.u WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS k FROM s WHERE same),
n AS (SELECT anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor, k ORDER BY s.score DESC, s.vec_id) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s USING (anchor, anchor_id) WHERE k <= 5 AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score)
SELECT * REPLACE (CAST(rank AS INTEGER) AS rank) FROM n WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_url_filter": OP5_SQL, "op8_decontamination": OP8_SQL, "op9_exact_dedup": OP9_SQL, "op13_hard_negatives": OP13_SQL}
