"""Token ids in binary shards with a minimal perfect hash index.

Documents are dealt into ranges of ascending key, one shard file each, and
encoded there. A shard file holds, after a fixed header:

    keys      int64 for each record in ascending order, null keys first
    starts    uint64 for each record and one more, positions in the payload in ids
    seeds     uint32 for each bucket of the minimal perfect hash
    slots     uint32 for each distinct key: its first record
    prints    uint32 for each distinct key: the key's fingerprint
    payload   the ids of all records one after the other, uint16 or uint32

All numbers are little-endian. A key is hashed to a bucket; the bucket's seed
sends it to its own slot among as many slots as there are distinct keys; the
slot's fingerprint tells keys that were never stored; its record gives
the place in the payload. So a keyed read touches a constant number of places.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, new_path
from .words import utf8

MAGIC = b"TIDS0001"
_HEADER = struct.Struct("<8sQQQII")  # magic, records, null keys, distinct keys, buckets, bytes of an id
KEYS_IN_BUCKET = 4
#: The manifest's folder among the shards.
MANIFEST = "manifest"
#: Chunks whose ids a worker remembers at most.
REMEMBERED = 600_000
_encoders: dict[str, Encoder] = {}

_CHUNK = re.compile(r"[ \n\t\r\f\v]*(?:[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[,.;:!?*#$%&|])|[^ \n\t\r\f\v]+)|[ \n\t\r\f\v]+")
_ODD_SPACE = re.compile(r"[^\S \n\t\r\f\v]")


class Encoder:
    """Ids of texts, by the tokenizers library.

    The tokenizer never joins characters across a place where white space follows
    something else, or where one of some marks follows a letter, so a text's ids are those of
    its chunks cut at such places; a chunk met before is looked up. Texts with rarer white space or a
    special token, and tokenizers of another kind, are encoded as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, "rb") as f:
            self.tokenizer = Tokenizer.from_buffer(f.read())
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        kind = repr(self.tokenizer.pre_tokenizer)
        self.chunks = self.tokenizer.normalizer is None and kind.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in kind
        self.sizes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, k in vocab.items():
            self.sizes[k] = len(token)  # in a byte-level vocabulary a character stands for a byte
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks that start with white space and end without, encoded as one text."""
        joined = "".join(chunks)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=self.dtype)
        ends = np.cumsum(self.sizes[ids])
        lengths = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in chunks])
        cuts = np.searchsorted(ends, lengths, side="left") + 1
        raw, width, out, a = ids.tobytes(), self.dtype.itemsize, {}, 0
        for chunk, b in zip(chunks, cuts.tolist(), strict=True):
            out[chunk] = raw[a * width : b * width]
            a = b
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        cut = [None if not self.chunks or _ODD_SPACE.search(t) or (self.special and self.special.search(t)) else _CHUNK.findall(t) for t in texts]
        known = self.known
        new = {c for chunks in cut if chunks for c in chunks if c not in known}
        extra: dict[str, bytes] = {}
        if new:
            plain = [c for c in new if c[0] in " \n\t\r\f\v" and c[-1] not in " \n\t\r\f\v"]
            for k in range(0, len(plain), 2000):
                extra.update(self._learn(plain[k : k + 2000]))
            extra.update({c: self.whole(c) for c in new if c not in extra})
            if len(known) + len(extra) <= REMEMBERED:
                known.update(extra)
                extra = {}
        get = known.__getitem__ if not extra else lambda c: extra[c] if c in extra else known[c]
        return [self.whole(t) if chunks is None else b"".join([get(c) for c in chunks]) for t, chunks in zip(texts, cut, strict=True)]


def encoder(path: str) -> Encoder:
    """One in each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _hash(keys: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """A 64-bit mix of keys and seeds."""
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) + np.asarray(seed, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(0x9FB21C651E98DF25)
        x = (x ^ (x >> np.uint64(28))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xCA5A826395121157)
        return x ^ (x >> np.uint64(32))


class PerfectHash:
    """A minimal perfect hash: large buckets first, each tries seeds until its keys fall into free slots."""

    def __init__(self, n: int, seeds: np.ndarray):
        self.n, self.seeds = n, seeds

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        n = len(keys)
        count = -(-n // KEYS_IN_BUCKET) or 1
        seeds = np.zeros(count, dtype="<u4")
        bucket = (_hash(keys, 0) % np.uint64(count)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=count)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        taken = np.zeros(n, dtype=bool)
        for b in np.argsort(-sizes, kind="stable"):
            if not sizes[b]:
                break
            own = keys[order[starts[b] : starts[b + 1]]]
            first = 1
            while True:  # 32 seeds at once
                tries = np.arange(first, first + 32, dtype=np.uint64)
                slots = (_hash(own[None, :].repeat(32, 0), tries[:, None]) % np.uint64(n)).astype(np.int64)
                free = ~taken[slots].any(axis=1)
                if len(own) > 1:
                    free &= (np.diff(np.sort(slots, axis=1), axis=1) != 0).all(axis=1)
                if free.any():
                    k = int(np.argmax(free))
                    seeds[b], first = tries[k], 0
                    taken[slots[k]] = True
                    break
                first += 32
        return cls(n, seeds)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        bucket = (_hash(keys, 0) % np.uint64(len(self.seeds))).astype(np.int64)
        return (_hash(keys, self.seeds[bucket].astype(np.uint64)) % np.uint64(self.n)).astype(np.int64)


def _print_of(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 0xF1A6) >> np.uint64(32)).astype("<u4")


def pack(keys: list[int | None], ids: list[bytes], width: int) -> bytes:
    """A shard file of records in ascending order of key, null keys first."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], dtype="<i8")
    distinct, first = np.unique(known, return_index=True)
    mph = PerfectHash.build(distinct)
    slots, prints = np.zeros(len(distinct), dtype="<u4"), np.zeros(len(distinct), dtype="<u4")
    if len(distinct):
        at = mph.slots(distinct)
        slots[at], prints[at] = first + nulls, _print_of(distinct)
    starts = np.zeros(len(keys) + 1, dtype="<u8")
    np.cumsum([len(x) // width for x in ids], out=starts[1:])
    full = np.concatenate((np.zeros(nulls, dtype="<i8"), known))
    head = _HEADER.pack(MAGIC, len(keys), nulls, len(distinct), len(mph.seeds), width)
    return b"".join([head, full.tobytes(), starts.tobytes(), mph.seeds.tobytes(), slots.tobytes(), prints.tobytes(), *ids])


class Shard:
    """A shard file's content; ``get`` reads one document by its key."""

    def __init__(self, raw: bytes):
        magic, self.n, self.nulls, distinct, buckets, self.width = _HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = _HEADER.size
        parts = []
        for kind, count in (("<i8", self.n), ("<u8", self.n + 1), ("<u4", buckets), ("<u4", distinct), ("<u4", distinct)):
            parts.append(np.frombuffer(raw, dtype=kind, count=count, offset=at))
            at += parts[-1].nbytes
        self.keys, self.starts, seeds, self.slots, self.prints = parts
        self.hash = PerfectHash(distinct, seeds)
        self.ids = np.frombuffer(raw, dtype=f"<u{self.width}", offset=at)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first record of each key, -1 where the fingerprint tells that it isn't stored."""
        if not self.hash.n:
            return np.full(len(keys), -1)
        at = self.hash.slots(keys)
        return np.where(self.prints[at] == _print_of(keys), self.slots[at].astype(np.int64), -1)

    def record(self, k: int) -> np.ndarray:
        return self.ids[int(self.starts[k]) : int(self.starts[k + 1])]

    def get(self, key: int) -> np.ndarray | None:
        """Ids of the first document stored under ``key``."""
        k = int(self.find(np.array([key], dtype="<i8"))[0])
        return None if k < 0 or self.keys[k] != key else self.record(k)


def _store(folder: str, name: str, data: bytes) -> None:
    """Writes a file under another name and renames it, so that a repeated task leaves whole files only."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, f"{path}/{name}")


def write_shards(docs: DataFrame, tokenizer: str, folder: str, *, end_id: int = 0, shards: int | None = None, shard_bytes: int = 24 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text, appends ``end_id`` and writes shards of ascending key below ``folder``.

    Returns the manifest (shard, file, first_key, last_key, records, ids), in order of shard. Null
    texts count as empty; null keys come first. Equal keys follow each other,
    told apart by their place in the input, so that repeated rows stand there as often as in the input. Very long texts are encoded whole, in pieces that the
    tokenizer treats alone anyway. An empty table writes no file. Other columns aren't read. A file is written under a name
    that its task alone uses and then renamed: a task that runs again replaces it.
    """
    spark = docs.sparkSession
    (place,) = fresh(docs.select(id_col, text_col), "place")
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0
        shards = max(1, -(-size // shard_bytes))
    order = [F.col("key").asc_nulls_first(), F.col(place).asc()]
    dealt = rows.withColumn(place, F.monotonically_increasing_id()).repartitionByRange(shards, *order).sortWithinPartitions(*order).drop(place)

    def encode(batches):
        shard = TaskContext.get().partitionId()
        own = encoder(tokenizer)
        end = np.array([end_id], dtype=own.dtype).tobytes()
        keys, ids = [], []
        for batch in batches:
            keys += batch.column(0).to_pylist()
            for k in range(0, batch.num_rows, 256):
                ids += [x + end for x in own.encode(batch.column(1).slice(k, 256).to_pylist())]
        if not keys:
            return
        width = own.dtype.itemsize
        name = f"shard-{shard:06d}.tids"
        _store(folder, name, pack(keys, ids, width))
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "file": [name], "first_key": pa.array(keys[:1], pa.int64()), "last_key": pa.array(keys[-1:], pa.int64()), "records": pa.array([len(keys)], pa.int64()), "ids": pa.array([sum(map(len, ids)) // width], pa.int64())}
        )

    dealt.mapInArrow(encode, "shard int, file string, first_key long, last_key long, records long, ids long").write.parquet(f"{folder}/{MANIFEST}")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("shard int, file string, first_key long, last_key long, records long, ids long").parquet(f"{folder}/{MANIFEST}")


class ShardFile:
    """A shard file that is read at the places that a key needs; ``read`` counts the bytes."""

    def __init__(self, folder: str, file: str):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        self.source, self.read = store.open_input_file(f"{path}/{file}"), 0
        magic, self.n, self.nulls, self.distinct, self.buckets, self.width = _HEADER.unpack(self._bytes(0, _HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        sizes = [8 * self.n, 8 * (self.n + 1), 4 * self.buckets, 4 * self.distinct, 4 * self.distinct]
        self.keys, self.starts, self.seeds, self.slots, self.prints, self.ids = (_HEADER.size + sum(sizes[:k]) for k in range(6))

    def _bytes(self, at: int, count: int) -> bytes:
        self.read += count
        return self.source.read_at(count, at)

    def _number(self, kind: str, at: int, k: int) -> int:
        dtype = np.dtype(kind)
        return int(np.frombuffer(self._bytes(at + k * dtype.itemsize, dtype.itemsize), dtype)[0])

    def get(self, key: int) -> np.ndarray | None:
        """Ids of the first document stored under ``key``: a seed, a fingerprint, a slot, a key and two starts are read besides the ids."""
        if not self.distinct:
            return None
        own = np.array([key], dtype="<i8")
        bucket = int(_hash(own, 0)[0] % np.uint64(self.buckets))
        slot = int(_hash(own, np.uint64(self._number("<u4", self.seeds, bucket)))[0] % np.uint64(self.distinct))
        if self._number("<u4", self.prints, slot) != int(_print_of(own)[0]):
            return None
        k = self._number("<u4", self.slots, slot)
        if self._number("<i8", self.keys, k) != key:
            return None
        a, b = np.frombuffer(self._bytes(self.starts + 8 * k, 16), "<u8").tolist()
        return np.frombuffer(self._bytes(self.ids + a * self.width, (b - a) * self.width), f"<u{self.width}")


def lookup(spark: SparkSession, folder: str, key: int) -> np.ndarray | None:
    """Ids of the first document stored under ``key`` below ``folder``, None if there is none.

    The manifest tells the file by its range of keys; of the file only the places that the key needs are read.
    """
    holds = read_manifest(spark, folder).where((F.coalesce("first_key", F.lit(key)) <= key) & (F.col("last_key") >= key))
    for row in holds.orderBy("shard").select("file").limit(2).collect():  # equal keys may go on in the next file
        found = ShardFile(folder, row["file"]).get(key)
        if found is not None:
            return found
    return None


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record of the files below ``folder``: shard, key, record, at (ids before it in its shard), n_tokens, ids_crc32.

    Each record with a key is found through the index of its file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tids").load(folder)
    shard = F.regexp_extract("path", r"shard-(\d+)\.tids$", 1).cast("int")
    schema = "shard int, key long, record int, at long, n_tokens long, ids_crc32 long"

    def records(batches):
        for batch in batches:
            for number, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = Shard(raw.as_buffer())
                found = np.concatenate((np.arange(own.nulls), own.find(own.keys[own.nulls :])))
                # keys that repeat follow their first record
                repeat = np.concatenate(([False], own.keys[1:] == own.keys[:-1]))[: own.n]
                repeat[: own.nulls + 1] = False
                found = np.where(repeat, np.arange(own.n), found)
                if (found < 0).any():
                    raise ValueError(f"shard {number}: a stored key isn't in the index")
                starts = own.starts.astype(np.int64)
                crc = [zlib.crc32(own.record(k).astype("<u4")) for k in found]
                keys = pa.array(own.keys, mask=np.arange(own.n) < own.nulls)
                yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(own.n, number, dtype=np.int32)), "key": keys, "record": pa.array(np.arange(own.n, dtype=np.int32)), "at": pa.array(starts[found]), "n_tokens": pa.array(starts[found + 1] - starts[found]), "ids_crc32": pa.array(crc, pa.int64())})

    return files.select(shard.alias("shard"), "content").mapInArrow(records, schema)


def token_table(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Writes ``docs`` as shards and reads back, for each document, doc_id, start, n_tokens and ids_crc32.

    An empty table writes no file and gives an empty table; else as ``write_shards`` says of nulls, repeated keys and very long texts.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    manifest = write_shards(docs, tokenizer, folder, **options)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    from pyspark.sql import Window

    # a row for each file
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = manifest.select("shard", before.alias("before"))
    rows = read_shards(spark, folder).join(F.broadcast(offsets), "shard")
    return rows.select(F.col("key").alias("doc_id"), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
