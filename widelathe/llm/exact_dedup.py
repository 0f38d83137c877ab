"""Exact deduplication by a log-structured merge index, in DataFrame operations alone.

Documents enter as memtables: Spark aggregates each by digest, keeps the best
row of every digest and flushes the result as a run, a Parquet folder sorted by
digest, with a filter: a bitmap of the places that its digests hash to. Compaction merges
the runs into one, keeping the best identifier and adding the counts. Later
documents are looked up: those whose place is empty in a run's filter are new to it, and only the
others meet the run. Of what is hit, the texts themselves are
compared with the text of the row that stays, since equal digests alone prove
nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, join_checked, materialize, new_path, stripped

#: Rows of one digest that are compared with one copy of the text that stays.
SALT_ROWS = 500
#: Digests of repeated texts that are broadcast at most, 40 bytes each.
BROADCAST_DIGESTS = 400_000
#: Rows of a memtable.
MEMTABLE_ROWS = 50_000_000
#: Bits of a filter for each digest, and pieces of a filter (4 KB each) that are broadcast at most.
FILTER_BITS, BROADCAST_PIECES = 16, 16_384


def digest(text: Column) -> Column:
    """SHA-256 of the text less its ASCII white space; null counts as empty."""
    return F.sha2(stripped(text).cast("binary"), 256)


def _best() -> Column:
    """Orders rows of a digest: most code points first, then smallest id, nulls last."""
    return F.struct((-F.col("length")).alias("less"), F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("uid").alias("uid"))


class DigestIndex:
    """Runs of (digest, best, n) below one folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.runs, self.made = spark, path or new_path(spark, "lsm"), [], 0
        #: (folder, places) of each run's filter
        self.filters: dict[str, tuple[str, int]] = {}

    def flush(self, rows: DataFrame, memtables: int = 1) -> None:
        """Writes ``rows`` (id, digest, length, uid) as sorted runs, one for each memtable; one job reads the rows once."""
        memtable = F.pmod(F.xxhash64("uid"), F.lit(memtables)).cast("int")
        best = rows.groupBy(memtable.alias("run"), "digest").agg(F.min(_best()).alias("best"), F.count(F.lit(1)).alias("n"))
        folder = self._folder("flush")
        best.sortWithinPartitions("run", "digest").write.partitionBy("run").parquet(folder)
        present = {r[0] for r in self.spark.read.parquet(folder).select("run").distinct().collect()} if memtables > 1 else {0}
        self.runs += [f"{folder}/run={k}" for k in range(memtables) if k in present]

    def _folder(self, name: str) -> str:
        self.made += 1
        return f"{self.path}/{name}-{self.made:05d}"

    def compact(self) -> None:
        """Merges all runs into one: the best row of each digest stays, counts add up."""
        if len(self.runs) < 2:
            return
        run = self._folder("merged")
        merged = self.read().groupBy("digest").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        # grouped by digest already: sorting inside the partitions needs no other shuffle
        merged.sortWithinPartitions("digest").write.parquet(run)
        self.runs = [run]

    def read(self) -> DataFrame:
        """(digest, best, n) of all runs; after a compaction each digest stands once."""
        return self.spark.read.parquet(*self.runs)

    def filter_of(self, run: str) -> tuple[DataFrame, int]:
        """((piece, bits), places) of a run: the bitmap of the places of its digests, made when it is first asked for."""
        if run not in self.filters:
            digests = self.spark.read.parquet(run).select("digest")
            places = max(1 << 15, FILTER_BITS * digests.count())
            at = place(places)
            pieces = digests.groupBy(F.bitmap_bucket_number(at).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
            folder = self._folder("filter")
            pieces.write.parquet(folder)
            self.filters[run] = folder, places
        folder, places = self.filters[run]
        return self.spark.read.parquet(folder), places

    def may_hold(self, batch: DataFrame, run: str) -> DataFrame:
        """The rows of ``batch`` whose digest may be in the run: all that are, and about one in ``FILTER_BITS`` of the others."""
        pieces, places = self.filter_of(run)
        at = place(places)
        asked = batch.withColumns({"piece": F.bitmap_bucket_number(at), "bit": F.bitmap_bit_position(at)})
        byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        found = join_checked(asked, pieces, ["piece"], "inner", BROADCAST_PIECES)
        return found.where(F.call_function("shiftright", byte, (F.col("bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1).drop("piece", "bit", "bits")

    def lookup(self, batch: DataFrame) -> DataFrame:
        """(digest, best, n) of the distinct digests of ``batch`` that a run holds."""
        asked = batch.select("digest").distinct()
        hits = [self.spark.read.parquet(run).join(self.may_hold(asked, run), "digest", "left_semi") for run in self.runs]
        found = reduce(DataFrame.unionByName, hits) if hits else None
        if found is None:
            return self.spark.createDataFrame([], "digest string, best struct<less:long,none:boolean,id:long,uid:long>, n long")
        return found.groupBy("digest").agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def place(places: int) -> Column:
    """The place of a digest in a filter."""
    return F.pmod(F.xxhash64("digest"), F.lit(places))


def new_texts(index: DigestIndex, docs: DataFrame, stored: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text isn't in the index; ``stored`` are the documents that the index was made of.

    Only documents that a run's filter lets pass meet the run, and what hits is compared with the stored text itself. Null texts count as
    empty; equal texts inside ``docs`` all stay. An empty table gives an empty one.
    """
    name, body = fresh(docs, "lsm_digest", "lsm_body")
    asked = docs.withColumn(name, digest(F.col(text_col)))
    hits = materialize(index.lookup(asked.select(F.col(name).alias("digest"))), "lsm-found").select(F.col("digest").alias(name), F.col("best.id").alias("hit"))
    # of the stored documents only id and text are read, so that their other names don't matter
    known = stored.select(F.col(id_col).alias("known"), F.col(text_col).alias("words"))
    texts = known.join(hits, F.col("known").eqNullSafe(F.col("hit"))).where(digest(F.col("words")) == F.col(name))
    texts = texts.groupBy(name).agg(F.min(stripped(F.col("words"))).alias(body))
    return asked.join(texts, name, "left").where(F.col(body).isNull() | (F.col(body) != stripped(F.col(text_col)))).drop(name, body)


def _compare(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests under which some row's text differs from the text of the row that stays.

    ``rows`` has id, uid, digest, length and body for rows of ``groups`` (digest, best, n), which
    hold at least two rows each. Large groups are salted; each salt gets a copy of the one text.
    """
    salts = F.greatest(F.lit(1), F.ceil(F.col("n") / SALT_ROWS)).cast("int")
    hits = rows.join(groups.select("digest", "n", F.col("best.id").alias("stays"), (-F.col("best.less")).alias("longest")), "digest")
    heads = (
        hits.where(F.col("id").eqNullSafe(F.col("stays")) & (F.col("length") == F.col("longest")))
        .groupBy("digest", "n")
        .agg(F.min("body").alias("head"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("n")
    )
    # every row has a salt of its own, whatever its id
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("uid"), salts).cast("int"))
    return salted.join(heads, ["digest", "salt"]).where(F.col("body") != F.col("head")).select("digest").distinct()


def _rows(docs: DataFrame, columns: list[str], id_col: str, text_col: str, key: Column) -> DataFrame:
    """(own: a struct of the columns, row: id, digest, length and uid) as a written table, so that uid stays."""
    id_, text = F.col(id_col), F.col(text_col)
    length = F.coalesce(F.char_length(text), F.lit(0)).cast("long")
    packed = F.struct(id_.alias("id"), key.alias("digest"), length.alias("length"), F.monotonically_increasing_id().alias("uid"))
    return materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("own"), packed.alias("row")), "lsm-rows")


def exact_dedup(
    docs: DataFrame,
    *,
    memtables: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest_of=digest,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row for each input row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical after deleting ASCII white space;
    null counts as empty. Of equal texts the row with the most code points in
    the original text, then the smallest id stays; null ids come last. Of rows
    that tie in all of this (a repeated row, or null ids) exactly one is
    ``kept``. An empty table gives an empty one. ``columns``: the input columns
    to return, by default the id alone; those called like an output column are
    replaced. ``memtables``: how many memtables the rows are split into, by default one for ``MEMTABLE_ROWS`` and two at least.
    Very long texts are compared whole.
    ``digest_of`` is another digest for tests; if texts differ under one digest,
    the texts themselves become the keys.
    """
    made = ["keep_id", "group_size", "kept", "text_sha256"]
    columns = [c for c in (columns or [id_col]) if c.lower() not in made]
    id_, text = F.col(id_col), F.col(text_col)
    rows = _rows(docs, columns, id_col, text_col, digest_of(text))
    keys = rows.select("row.*")
    index = DigestIndex(docs.sparkSession)
    n = rows.count()
    if not n:
        return _marked(rows, keys.groupBy("digest").agg(F.min(_best()).alias("best"), F.count(F.lit(1)).alias("n")), F.col("digest"))
    index.flush(keys, memtables or max(2, -(-n // MEMTABLE_ROWS)))
    index.compact()
    merged = index.read()
    repeated = merged.where(F.col("n") > 1)
    # only texts whose digest occurs again are looked at further
    length = F.coalesce(F.char_length(text), F.lit(0)).cast("long")
    body = docs.select(id_.alias("id"), digest_of(text).alias("digest"), length.alias("length"), stripped(text).alias("body"), F.monotonically_increasing_id().alias("uid"))
    hits = materialize(join_checked(body, repeated.select("digest"), ["digest"], "left_semi", BROADCAST_DIGESTS), "lsm-hits")
    if digest_of is digest and _compare(hits, repeated).isEmpty():
        return _marked(rows, merged, F.col("digest"))
    # texts differ under one digest, or it isn't SHA-256: the texts are the keys
    rows = _rows(docs, columns, id_col, text_col, stripped(text))
    merged = rows.select("row.*").groupBy("digest").agg(F.min(_best()).alias("best"), F.count(F.lit(1)).alias("n"))
    return _marked(rows, materialize(merged, "lsm-merged"), F.sha2(F.col("digest").cast("binary"), 256))


def _marked(rows: DataFrame, merged: DataFrame, sha: Column) -> DataFrame:
    out = rows.join(merged, F.col("row.digest") == F.col("digest"))
    kept = F.col("row.uid") == F.col("best.uid")
    return out.select("own.*", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), sha.alias("text_sha256"))
