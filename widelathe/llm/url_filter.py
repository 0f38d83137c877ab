"""URL filtering by listed hosts and paths: a blocked Bloom filter, then an exact hash join.

A rule (host, path) fits a URL on that host or a subdomain whose path starts
with the rule's. The canonical key of a rule is its host followed by its path.
A URL has a candidate key for each of its host's suffixes and each listed path
length; a Bloom filter whose probes for a key lie in one 64-byte block drops
nearly all of them inside the scan. What passes is joined exactly with the
list, which removes false positives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_checked, materialize

BLOCK_BITS = 512
PROBES = 8
#: Rules that are broadcast at most; a longer list is joined by a shuffle.
BROADCAST_RULES = 200_000
_SEPARATOR = "\x00"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class BlockedBloom:
    """A Bloom filter of fixed size whose probes for a key touch one block.

    The block is the key's XXH64 (seed 42, as Spark's ``xxhash64``) modulo their number.
    """

    def __init__(self, blocks: int, bits: np.ndarray | None = None):
        self.blocks = blocks
        self.bits = bits if bits is not None else np.zeros((blocks, BLOCK_BITS // 8), dtype=np.uint8)

    def _probes(self, key: bytes):
        block = xxhash.xxh64_intdigest(key, 42)
        block -= (block >> 63) << 64
        rest = xxhash.xxh3_128_intdigest(key)
        for _ in range(PROBES):
            yield block % self.blocks, (rest & 511) >> 3, 1 << (rest & 7)
            rest >>= 9

    def add(self, key: bytes) -> None:
        for block, byte, bit in self._probes(key):
            self.bits[block, byte] |= bit

    def __contains__(self, key: bytes) -> bool:
        return all(self.bits[block, byte] & bit for block, byte, bit in self._probes(key))


def build_filter(keys: DataFrame, count: int, *, bits_per_key: int = 16, most_bytes: int = 64 << 20) -> BlockedBloom:
    """The filter of a table with the column key, of at most ``most_bytes``.

    The keys are dealt out by block, so that each part of the filter is filled by
    one task and reaches the driver once. Beyond ``most_bytes`` false positives
    grow more frequent; the exact join removes them all the same.
    """
    bloom = BlockedBloom(max(1, min(-(-count * bits_per_key // BLOCK_BITS), most_bytes * 8 // BLOCK_BITS)))
    blocks_in_part = 1024

    def fill(batches):
        own: dict[int, BlockedBloom] = {}
        for batch in batches:
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part not in own:
                    own[part] = BlockedBloom(bloom.blocks)
                own[part].add(key)
        for part, filled in own.items():
            bits = filled.bits[part * blocks_in_part : (part + 1) * blocks_in_part]
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    part = F.floor(F.pmod(F.xxhash64("key"), F.lit(bloom.blocks)) / blocks_in_part).cast("long")
    dealt = keys.select(F.col("key").cast("binary").alias("key"), part.alias("part")).repartition("part")
    for row in dealt.mapInArrow(fill, "part long, bits binary").toLocalIterator():
        bits = np.frombuffer(row["bits"], dtype=np.uint8).reshape(-1, BLOCK_BITS // 8)
        at = row["part"] * blocks_in_part
        bloom.bits[at : at + len(bits)] |= bits
    return bloom


def _candidates(host: str, path: str, lengths: list[int]):
    """The key of every host suffix with every listed length of path."""
    at = 0
    while True:
        suffix = host[at:]
        for n in lengths:
            if n <= len(path):
                yield suffix + _SEPARATOR + path[:n]
        dot = host.find(".", at)
        if dot < 0:
            return
        at = dot + 1


def filter_urls(pages: DataFrame, rules: DataFrame, *, default: str = "allow", url_col: str = "url", columns: list[str] | None = None) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    ``rules`` has host, path and verdict; of several verdicts for one rule the
    greater by code point counts. The longest rule that fits decides, by the length of
    host and path together, then by the host; where none fits ``rule`` is
    null and the verdict ``default``. A null URL or one without ``://`` has an
    empty host and path and fits no rule, unless a rule is empty too. Empty
    tables of pages or rules work; repeated rows each get their verdict. Input columns called like an
    output column are replaced. ``columns``: the input columns to return, all by default.
    """
    made = ["host", "path", "rule", "verdict"]
    columns = [c for c in (columns or pages.columns) if c.lower() not in made]
    listed = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    listed = materialize(listed.select(F.concat("host", F.lit(_SEPARATOR), "path").alias("key"), "host", "path", "verdict"), "url-rules")
    # lengths of paths are few: a URL's length bounds them
    lengths = sorted(r[0] for r in listed.select(F.char_length("path")).distinct().collect())
    bloom = build_filter(listed.select("key"), listed.count())
    blooms = pages.sparkSession.sparkContext.broadcast((bloom.blocks, bloom.bits))

    @F.arrow_udf("array<string>")
    def possible(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        blocks, bits = blooms.value
        own = BlockedBloom(blocks, bits)
        seen: dict[str, bool] = {}
        out = []
        for host, path in zip(hosts.to_pylist(), paths.to_pylist(), strict=True):
            found = []
            for key in _candidates(host, path, lengths):
                if (hit := seen.get(key)) is None:
                    if len(seen) > 200_000:
                        seen.clear()
                    hit = seen[key] = key.encode("utf-8", "surrogatepass") in own
                if hit:
                    found.append(key)
            out.append(found or None)
        return pa.array(out, pa.list_(pa.string()))

    picked = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    parsed = pages.select(picked, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = materialize(parsed.withColumn("may", possible("host", "path")).withColumn("uid", F.monotonically_increasing_id()), "url-rows")
    hits = rows.where("may IS NOT NULL").select("uid", F.explode("may").alias("key"))
    size = F.char_length("host")
    named = listed.select("key", F.struct((size + F.char_length("path")).alias("n"), size.alias("h"), F.concat("host", "path").alias("rule"), "verdict").alias("best"))
    best = join_checked(hits, named, ["key"], "inner", BROADCAST_RULES).groupBy("uid").agg(F.max("best").alias("best"))
    # rows without a possible hit need no join
    sure = rows.where("may IS NULL").select("row.*", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    told = rows.where("may IS NOT NULL").join(best, "uid", "left")
    told = told.select("row.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    return sure.unionByName(told)
