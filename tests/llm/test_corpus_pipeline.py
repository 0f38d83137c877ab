"""The pipeline's stages on the smallest tables."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_corpus_operators import brute_scan, groups_of, shingles

from widelathe.llm import mixing, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "mixing", "sharding"]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = corpus_pipeline.drop_toxic(spark, docs, SF).cache()
    toxic = toxicity.score(docs, model).where("predicted = 1")
    assert clean.columns == columns and clean.count() == docs.count() - toxic.count()
    single = corpus_pipeline.drop_near_copies(spark, clean, SF).cache()
    texts = lambda df: {" ".join(r["text"].lower().split()) for r in df.select("text").collect()}
    assert single.columns == columns and single.count() == len(texts(single)) <= len(texts(clean))
    apart = corpus_pipeline.drop_contaminated(spark, single, SF).cache()
    assert apart.columns == columns and apart.count() <= single.count()
    mixed = corpus_pipeline.mix_sources(spark, apart, SF)
    assert mixed.columns == columns and mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3


def test_run_against_brute_force(spark):
    """The documents that come out, and how often, by the definition of each stage; the learnt scores and the mix have brute-force tests of their own."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = {r["doc_id"]: r["text"] for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    single = set(groups_of(sets, near).values())
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    apart = {i for i in single if brute_scan(texts[i], items)[1] == 0}
    assert len(apart) < len(single) < len(texts) < docs.count()
    mixed = mixing.mix(docs.where(F.col("doc_id").isin(sorted(apart)))).select("doc_id", "rounds").collect()
    wanted = Counter({r["doc_id"]: r["rounds"] for r in mixed if r["rounds"]})
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in out) == wanted
    rows = {r["doc_id"]: tuple(r) for r in docs.collect()}
    assert all(tuple(r[c] for c in docs.columns) == rows[r["doc_id"]] for r in out)
    sizes = Counter(r["shard"] for r in out)
    assert set(sizes) <= set(range(40)) and max(sizes.values()) - min(sizes.get(k, 0) for k in range(40)) <= 1
    assert {(r["shard"], r["slot"]) for r in out} == {(k, s) for k, n in sizes.items() for s in range(n)}
