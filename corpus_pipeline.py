"""A training corpus from ``documents``, in five stages.

Every stage takes the whole texts of all rows that the one before kept, and an empty table gives an empty one. Null texts count as empty; where rows are told apart by
their ids, null ids come last. Further columns of ``documents`` are left out by all stages but the last, so that none clashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widelathe.llm import decontaminate, mixing, sharding, simhash, toxicity
from widelathe.llm.common import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is 0.7 or more go. Equal texts have equal scores, so that repeated rows go or stay together; null and empty texts stay unless all else is toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the one with the smallest id stays; of repeated rows, and of null and empty texts, one."""
    return simhash.keep_one(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item, or a whole shorter item, go. Null and empty texts stay, repeated rows go or stay together."""
    return decontaminate.scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where(~F.col("contaminated")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is repeated as often as the mix takes it; one that isn't taken goes. Rows with the same id and text share their decision, null sources are one source, empty texts have size 0."""
    mixed = mixing.mix(docs).where("rounds > 0")
    return mixed.withColumn("round", F.explode(F.sequence(F.lit(1), F.col("rounds").cast("int")))).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard of 40 and its slot there, repeated rows each their own; rows that tie in all columns may change places."""
    order = [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")), F.col("source"), F.col("lang"), F.col("n_chars")]
    return sharding.assign_shards(docs, 40, order=order)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("decontamination", drop_contaminated), ("mixing", mix_sources), ("sharding", shard)]

#: The learnt scores and the fingerprints' bit counts have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
