"""The folder that driver and executors share, and tables written to it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: The folders made inside each ``scratch`` that is open, the innermost last.
_open: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where that is unset, a session of one machine gets one of its own; a cluster has to name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new folder below the shared one. Inside ``scratch`` it goes when that ends; with ``keep`` when the next outer one does."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if scopes := _open[: -1 if keep else None]:
        scopes[-1].append(path)
    return path


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it again: this cuts the lineage at a table that outlives any executor."""
    spark = df.sparkSession
    path = new_path(spark, name, keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside go at its end, but for those that are kept: no plan that is used later may read them."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, found without counting further."""
    return df.limit(rows + 1).count() <= rows
