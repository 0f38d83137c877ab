"""SimHash near-duplicates with pigeonring filtering.

A fingerprint is cut into 2*tau+1 consecutive segments that form a ring. If two
fingerprints differ in at most tau bits, some segment starts a chain in which
the first l segments together differ in at most l*tau/(2*tau+1) bits, for every
l. For l up to 2 that budget is below one bit, so two neighbouring segments
are equal: they are the key by which candidates meet. The budgets of the longer
chains drop candidates before the full distance is taken.

Keys shared by many fingerprints would make a square of pairs. Above
``PAIRED`` fingerprints on a key each is listed under itself and its one-bit
variants outside the key instead: two fingerprints differ in at most two bits
exactly if they share such a variant, so linking every variant's members to the
smallest of them links the same groups, by a number of rows that is linear.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import scratch
from .common import join_checked, materialize
from .components import components
from .words import space_words, utf8

BITS = 64
#: Fingerprints on one key that are compared pair by pair at most.
PAIRED = 256
#: Shingles whose bits are counted at once.
_COUNTED = 1 << 16
#: Bytes of Spark's hash table of a side that is broadcast: 16 and 8 for each column, by row.
BROADCAST_BYTES = 24 << 20


def join_bounded(big: DataFrame, side: DataFrame, on: list[str], how: str) -> DataFrame:
    """Joins ``side``, whose columns are numbers, by broadcast if it is found to have ``BROADCAST_BYTES`` at most, else by a shuffle."""
    return join_checked(big, side, on, how, BROADCAST_BYTES // (16 + 8 * len(side.columns)))


def shingle_hashes(raw: bytes | None, k: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``k`` words, repeats included; of all words if they are fewer."""
    words = space_words(raw)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    text = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(text, seed)], dtype=np.uint64)
    starts = list(accumulate(map(len, words), lambda at, n: at + n + 1, initial=0))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[a : b - 1], seed) for a, b in zip(starts, starts[k:])), dtype=np.uint64, count=len(words) - k + 1)  # noqa: B905


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; 0 for none."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), _COUNTED):
        bits = np.unpackbits(hashes[k : k + _COUNTED].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: Column, k: int) -> Column:
    """The 64-bit SimHash of a text's ``k``-word shingles as a signed long."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        prints = np.array([fingerprint_of(shingle_hashes(raw, k)) for raw in utf8(texts)], dtype=np.uint64)
        return pa.array(prints.view(np.int64))

    return simhash(text)


def _segments(tau: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each of the 2*tau+1 segments."""
    m = 2 * tau + 1
    edges = [BITS * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _mask(segments: list[tuple[int, int]]) -> int:
    mask = sum(((1 << n) - 1) << a for a, n in segments)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _differ(mask: int) -> Column:
    return F.bit_count(F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(F.lit(mask).cast("long")))


def links(prints: DataFrame, tau: int = 2) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``prints`` (fp, distinct) that differ in at most ``tau`` (1 or 2) bits."""
    if tau not in (1, 2):
        raise ValueError("tau is 1 or 2")
    ring = _segments(tau)
    m = len(ring)
    chains = [[ring[(k + j) % m] for j in range(m)] for k in range(m)]
    masks = [_mask(c[:2]) for c in chains]
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(x).cast("long")) for x in masks])).alias("chain", "key"))
    shared = keyed.groupBy("chain", "key").count().where(F.col("count") > 1)
    met = materialize(keyed.join(materialize(shared, "simhash-keys"), ["chain", "key"]), "simhash-met")

    few = met.where(F.col("count") <= PAIRED)
    budgets = F.lit(False)
    for k, chain in enumerate(chains):
        within = F.col("chain") == k
        for n in range(3, m):
            within &= _differ(_mask(chain[:n])) <= n * tau // m
        budgets |= within
    left, right = few.select("chain", "key", F.col("fp").alias("x")), few.select("chain", "key", F.col("fp").alias("y"))
    near = left.join(right, ["chain", "key"]).where((F.col("x") < F.col("y")) & budgets & (_differ(-1) <= tau))
    pairs = near.select(F.col("x").alias("a"), F.col("y").alias("b"))

    many = met.where(F.col("count") > PAIRED)
    variants = F.lit(None)
    for k, mask in enumerate(masks):
        signed = [(1 << b) - ((1 << BITS) if b == BITS - 1 else 0) for b in range(BITS) if not (mask >> b) & 1]
        if tau == 2:
            own = F.transform(F.array(*[F.lit(x).cast("long") for x in (0, *signed)]), lambda x: x.bitwiseXOR(F.col("fp")))
        else:  # without the bit, under the bit's place: shared by fingerprints that differ there alone
            own = F.transform(F.array(*[F.lit(x).cast("long") for x in signed]), lambda x: F.col("fp").bitwiseAND(F.bitwise_not(x)))
        variants = F.when(F.col("chain") == k, own).otherwise(variants)
    shared = ["chain", "key", "variant"] + ["place"] * (tau == 1)
    listed = many.select("chain", "key", "fp", F.posexplode(variants).alias("place", "variant"))
    low = listed.groupBy(*shared).agg(F.min("fp").alias("a"), F.max("fp").alias("most")).where(F.col("a") != F.col("most"))
    star = listed.join(low, shared).where(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(star).distinct()


def simhash_components(docs: DataFrame, *, k: int = 3, tau: int = 2, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Adds ``fingerprint`` (16 hex digits) and ``component_id`` (smallest id linked, itself included) to every row.

    Texts are linked if their fingerprints differ in at most ``tau`` bits. A text with fewer
    than ``k`` words is one shingle; null and empty texts have fingerprint
    zero and are linked like any other. Null ids are passed over in the
    smallest id, which is null if a component has no other. Very long texts count whole, shingle by shingle; repeated rows have the same fingerprint
    and each a row in the result. An empty table gives an empty one. Input
    columns called like an output column are replaced. ``columns``: the input columns to return, by default the id.
    """
    columns = [c for c in (columns or [id_col]) if c.lower() not in ("fingerprint", "component_id")]
    own = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    rows = materialize(docs.select(own, F.col(id_col).alias("id"), fingerprint(F.col(text_col), k).alias("print")), "simhash-rows")
    prints = materialize(rows.groupBy(F.col("print").alias("fp")).agg(F.min("id").alias("low")), "simhash-prints")
    groups = components(links(prints.select("fp"), tau))
    lows = groups.join(prints, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("low").alias("component_id"))
    united = groups.join(lows, "root").select("node", "component_id")
    named = prints.join(united, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component_id", "low").alias("component_id"))
    out = rows.join(materialize(named, "simhash-named"), F.col("print") == F.col("fp"))
    return out.select("row.*", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Minimum hashes in a band, and bands, of the way by which large groups are found first.
BAND_ROWS, BANDS = 3, 16
#: Bits of a shingle's hash that tell its counter. The counters cover all texts; they set the order of the shingles, which decides the work but not the pairs found.
COUNTER_BITS = 19
#: Texts with one shingle that are compared with the others in one block.
BLOCK = 1024
#: Bits of a text's parity bitmap, and at most those of the wide one that a text with more than ``BITMAP // 4`` shingles has too; powers of two.
BITMAP, WIDE = 1024, 1 << 17
#: Shingles that are hashed at once.
_HASHED = 2048

SIGNATURE = "struct<s1:long,s2:long,fp:long,n:int,bands:array<long>,tokens:array<int>,bits:array<long>,wide:array<long>>"
_SIGNATURE = pa.struct([("s1", pa.int64()), ("s2", pa.int64()), ("fp", pa.int64()), ("n", pa.int32()), ("bands", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int32())), ("bits", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64()))])


def band_keys(own: np.ndarray) -> np.ndarray:
    """A key for each band of minimum hashes of a set of 64-bit hashes; none for an empty set."""
    if not len(own):
        return np.zeros(0, dtype=np.int64)
    rng = np.random.default_rng(20240229)
    size = BANDS * BAND_ROWS
    factor = (rng.integers(0, 1 << 32, size, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    shift = rng.integers(0, 1 << 32, size, dtype=np.uint64).astype(np.uint32)
    short = (own ^ (own >> np.uint64(29))).astype(np.uint32)
    low = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(short), _HASHED):
        np.minimum(low, (short[k : k + _HASHED, None] * factor + shift).min(axis=0), out=low)
    keys = [xxhash.xxh64_intdigest(low[b * BAND_ROWS : (b + 1) * BAND_ROWS].tobytes(), b) for b in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64)


def parity_bits(own: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` bits whether an odd number of the set's hashes fall on it: two bitmaps differ in no more bits than the sets in members."""
    odd = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_bits(own: np.ndarray) -> np.ndarray:
    """A bitmap that grows with the set, empty for a small one."""
    return parity_bits(own, min(WIDE, 1 << (2 * len(own) - 1).bit_length())) if len(own) > BITMAP // 4 else np.zeros(0, dtype=np.int64)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap of the same set with a smaller size."""
    while len(bits) > size:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def counters(own: np.ndarray) -> np.ndarray:
    """The counter of each shingle: the top bits of its hash, as tokens are its low ones."""
    return (own >> np.uint64(BITS - COUNTER_BITS)).astype(np.int64)


def prefix_of(own: np.ndarray, least: float, times: np.ndarray) -> np.ndarray:
    """The first members of a set, rarest first by ``times`` of their counters: two sets of the similarity ``least`` have one of these in common."""
    own = np.unique(own)
    size = len(own) - math.ceil(least * len(own) - 1e-9) + 1
    return own[np.lexsort((own, times[counters(own)]))[:size]].view(np.int64)


def _histogram(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """For each counter the number of (text, shingle of it) over all texts; as large for any number of texts."""

    def count(batches):
        times = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
        for batch in batches:
            for raw in utf8(batch.column(0)):
                np.add.at(times, counters(np.unique(shingle_hashes(raw, k))), 1)
        met = np.flatnonzero(times)
        for at in range(0, len(met), _COUNTED):
            own = met[at : at + _COUNTED]
            yield pa.RecordBatch.from_pydict({"counter": pa.array(own, pa.int32()), "n": pa.array(times[own])})

    found = docs.select(text_col).mapInArrow(count, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    times = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    times[found["counter"].to_numpy()] = found["n"].to_numpy()
    return times


def _signature(text: Column, k: int, least: float, histogram) -> Column:  # noqa: ANN001
    """128 bits that tell the word sequence, the fingerprint, and of the set of shingles: its size, band keys, first members and bitmap."""

    @F.arrow_udf(SIGNATURE)
    def sign(texts: pa.Array) -> pa.Array:
        times = histogram.value
        made = []
        for raw in utf8(texts):
            hashes = shingle_hashes(raw, k)
            own = np.unique(hashes)
            s1, s2 = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(space_words(raw))), dtype=np.int64)
            fp = fingerprint_of(hashes)
            tokens = prefix_of(own, least, times).astype(np.int32)
            made.append({"s1": s1, "s2": s2, "fp": fp - ((fp >> 63) << 64), "n": len(own), "bands": band_keys(own), "tokens": tokens, "bits": parity_bits(own, BITMAP), "wide": wide_bits(own)})
        return pa.array(made, _SIGNATURE)

    return sign(text)


def _similar(a: Column, b: Column, k: int, least: float) -> Column:
    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        own = lru_cache(64)(lambda raw: np.unique(shingle_hashes(raw, k)))  # heads of groups come again and again
        out = []
        for x, y in zip(utf8(left), utf8(right), strict=True):
            x, y = own(x), own(y)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both >= least * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    return similar(a, b)


def _differing(x: str, y: str) -> Column:
    """Bits in which two bitmaps differ."""
    return reduce(Column.__add__, [F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))) for k in range(BITMAP // 64)])


def _may(least: float, n: Column, m: Column, x: str, y: str) -> Column:
    """Whether sets of n and m members with the bitmaps x and y can have the similarity ``least``; never false for those that have."""
    sizes = F.least(n, m) >= F.greatest(n, m) * F.lit(least) - 1e-6
    return sizes & (_differing(x, y) <= (n + m) * F.lit((1 - least) / (1 + least)) + 1e-6)


def _close(n: Column, m: Column, x: Column, y: Column, least: float) -> Column:
    """As ``_may``, by the wide bitmaps of large sets; true where one has none."""

    @F.arrow_udf("boolean")
    def close(ns: pa.Array, ms: pa.Array, xs: pa.Array, ys: pa.Array) -> pa.Array:
        out = []
        for i, j, x, y in zip(ns.to_pylist(), ms.to_pylist(), xs, ys, strict=True):
            x, y = (v.values.to_numpy() if v.is_valid else () for v in (x, y))
            size = min(len(x), len(y))
            out.append(not size or int(np.bitwise_count((folded(x, size) ^ folded(y, size)).view(np.uint64)).sum()) <= (i + j) * (1 - least) / (1 + least) + 1e-6)
        return pa.array(out, pa.bool_())

    return close(n, m, x, y)


class _Near:
    """Texts by the smallest ``uid`` of their word sequence (``node``), and the ways to find similar ones among them."""

    def __init__(self, rows: DataFrame, k: int, least: float, tau: int):
        self.rows, self.k, self.least, self.tau = rows, k, least, tau
        known = rows.select("uid", F.col("sig.s1").alias("s1"), F.col("sig.s2").alias("s2"))
        first = known.groupBy("s1", "s2").agg(F.min("uid").alias("node"), F.max("uid").alias("last")).where(F.col("node") != F.col("last"))
        repeated = materialize(first.select("s1", "s2", "node"), "near-repeated")
        #: (uid, node) of the rows whose word sequence stands in an earlier row
        self.copies = materialize(join_bounded(known, repeated, ["s1", "s2"], "inner").where(F.col("uid") != F.col("node")).select("uid", "node"), "near-copies")
        self.texts = join_bounded(rows.select(F.col("uid"), "sig"), self.copies.select("uid"), ["uid"], "left_anti").select(F.col("uid").alias("node"), "sig.*")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b) whose sets of shingles have the similarity ``least`` or more."""
        pairs = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-pairs")
        wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct(), "near-wanted")
        texts = join_bounded(self.rows.select("uid", "text"), wanted, ["uid"], "inner")
        both = pairs.join(texts.withColumnsRenamed({"uid": "b", "text": "y"}), "b").join(texts.withColumnsRenamed({"uid": "a", "text": "x"}), "a")
        return both.where(_similar(F.col("x"), F.col("y"), self.k, self.least)).select("a", "b")

    def by_fingerprint(self) -> DataFrame:
        """Each text with the first one of those that its fingerprint is linked to by pigeonring search."""
        prints = materialize(self.texts.groupBy("fp").agg(F.min("node").alias("first")), "near-prints")
        groups = components(links(prints.select("fp"), self.tau))
        roots = groups.join(prints.select(F.col("fp").alias("root"), F.col("first").alias("a")), "root").select(F.col("node").alias("fp"), "a")
        heads = prints.join(roots, "fp", "left").select("fp", F.coalesce("a", "first").alias("a"))
        return self.texts.select("fp", F.col("node").alias("b")).join(heads, "fp").where(F.col("a") != F.col("b")).select("a", "b")

    def by_band(self) -> tuple[DataFrame, DataFrame]:
        """(each text with one head, each text with its other heads).

        The head of a band is the text whose own bands are the most crowded: the middle of a group, which is similar
        to most of it, heads all its bands. So each text needs a comparison or two, however large its group.
        """
        listed = self.texts.select("node", F.explode("bands").alias("key"))
        size = materialize(listed.groupBy("key").count().where(F.col("count") > 1), "band-keys")
        met = materialize(join_bounded(listed, size, ["key"], "inner"), "band-met")
        score = met.groupBy("node").agg(F.sum("count").alias("score"))
        heads = met.join(score, "node").groupBy("key").agg(F.max_by("node", F.struct("score", "node")).alias("head"), F.max("score").alias("score"))
        stars = met.join(heads, "key").where(F.col("node") != F.col("head")).groupBy("node", "head").agg(F.max("score").alias("score"))
        stars = materialize(stars, "near-stars")
        best = materialize(stars.groupBy("node").agg(F.max_by("head", F.struct("score", "head")).alias("best")), "near-best")
        others = stars.join(best, "node").where(F.col("head") != F.col("best"))
        return best.select(F.col("best").alias("a"), F.col("node").alias("b")), others.select(F.col("head").alias("a"), F.col("node").alias("b"))

    def rooted(self, frame: DataFrame, found: DataFrame, node: str, root: str) -> DataFrame:
        """Adds the root of each ``node``, which is itself where it has no link."""
        roots = found.select(F.col("node").alias(node), F.col("root").alias(root))
        return join_bounded(frame, roots, [node], "left").withColumn(root, F.coalesce(root, node))

    def apart(self, pairs: DataFrame, found: DataFrame) -> DataFrame:
        """The pairs of different roots that may be similar by their sizes and bitmaps."""
        pairs = self.rooted(self.rooted(pairs, found, "a", "r"), found, "b", "s").where(F.col("r") != F.col("s")).select("a", "b")
        pairs = materialize(pairs, "near-apart")
        wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "near-sized")
        sized = join_bounded(self.texts.select("node", "n", "bits"), wanted, ["node"], "inner")
        both = pairs.join(sized.withColumnsRenamed({"node": "a", "n": "n", "bits": "x"}), "a").join(sized.withColumnsRenamed({"node": "b", "n": "m", "bits": "y"}), "b")
        return both.where(_may(self.least, F.col("n"), F.col("m"), "x", "y")).select("a", "b", "n", "m")

    def close(self, pairs: DataFrame) -> DataFrame:
        """Less those of ``pairs`` (a, b, n, m) whose wide bitmaps show that they can't be similar."""
        pairs = materialize(pairs.distinct(), "near-sized")
        large = pairs.where(F.least("n", "m") > BITMAP // 4)
        wanted = materialize(large.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "near-wanted")
        wide = join_bounded(self.texts.select("node", "wide"), wanted, ["node"], "inner")
        both = large.join(wide.withColumnsRenamed({"node": "b", "wide": "y"}), "b").join(wide.withColumnsRenamed({"node": "a", "wide": "x"}), "a")
        kept = both.where(_close(F.col("n"), F.col("m"), F.col("x"), F.col("y"), self.least))
        return kept.select("a", "b").unionByName(pairs.where(F.least("n", "m") <= BITMAP // 4).select("a", "b"))

    def postings(self, found: DataFrame) -> DataFrame:
        """(token, node, root, n, rest, bits, count, main): the texts that share one of their first shingles with a text of another root.

        ``rest`` is the number of the text's shingles from there on, ``main`` the root that most of the shingle's texts have. Shingles with the
        same texts stand once, under the smallest of them, with the largest ``rest``: such texts meet once, not under every shingle of a passage they share. Lists are the same
        if their lengths and 128 bits of their texts' hashes are.
        """
        rooted = self.rooted(self.texts.select("node", "tokens"), found, "node", "root").select("root", F.explode("tokens").alias("token"))
        shared = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("low") != F.col("high"))
        shared = materialize(shared.select("token"), "near-shared")
        # what is moved for all first shingles is narrow; roots come to those that are shared
        listed = self.texts.select("node", "n", F.posexplode("tokens").alias("at", "token")).select("token", "node", (F.col("n") - F.col("at")).alias("rest"))
        met = join_bounded(listed, shared, ["token"], "inner")
        met = materialize(self.rooted(met, found, "node", "root"), "near-met")
        marks = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in (1, 2)]
        sizes = met.groupBy("token", "root").agg(F.count(F.lit(1)).alias("count"), *marks)
        # of two texts of different roots one at least isn't of the largest root
        main = F.max_by("root", F.struct("count", "root")).alias("main")
        sizes = materialize(sizes.groupBy("token").agg(main, F.sum("count").alias("count"), *[F.bit_xor(f"h{k}").alias(f"h{k}") for k in (1, 2)]), "near-sizes")
        same = ["count", "h1", "h2"]
        once = materialize(sizes.join(sizes.groupBy(*same).agg(F.min("token").alias("one")), same).select("token", "one", "count", "main"), "near-once")
        met = join_bounded(met, once, ["token"], "inner")
        met = met.groupBy(F.col("one").alias("token"), "node", "root", "count", "main").agg(F.max("rest").alias("rest"))
        return materialize(met.join(self.texts.select("node", "n", "bits"), "node"), "near-postings")

    def by_prefix(self, found: DataFrame) -> DataFrame:
        """Pairs of texts of different roots, among them all whose similarity is ``least`` or more.

        Such texts share one of their first shingles in an order that all texts have in common, from the first shared
        one on both have as many as they must share, and their bitmaps differ in few bits. Of texts with one root none meets another.
        """
        met = self.postings(found).withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
        left = met.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        right = met.where(F.col("root") != F.col("main")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        right = right.select("token", "block", F.col("node").alias("b"), F.col("root").alias("r"), F.col("n").alias("m"), F.col("rest").alias("left"), F.col("bits").alias("y"))
        once = (F.col("root") == F.col("main")) | (F.col("node") < F.col("b"))
        enough = F.least("rest", "left") >= (F.col("n") + F.col("m")) * F.lit(self.least / (1 + self.least)) - 1e-6
        may = (F.col("root") != F.col("r")) & once & enough & _may(self.least, F.col("n"), F.col("m"), "bits", "y")
        return left.join(right, ["token", "block"]).where(may).select(F.col("node").alias("a"), "b", "n", "m")

    def groups(self) -> DataFrame:
        """(node, root) of the texts that have near copies, a written table; what leads to it goes.

        Python runs once in each stage at most: workers of several operations at once would share an executor's memory.
        """
        spark = self.rows.sparkSession
        with scratch(spark):
            with scratch(spark):
                first, others = self.by_band()
                others = materialize(others, "near-others", keep=True)
                edges = materialize(self.verified(self.by_fingerprint().unionByName(first)), "near-edges", keep=True)
            with scratch(spark):
                found = materialize(components(edges), "near-found")
                edges = materialize(edges.unionByName(self.verified(self.close(self.apart(others, found)))), "near-edges", keep=True)
            with scratch(spark):
                found = materialize(components(edges), "near-found")
                edges = materialize(edges.unionByName(self.verified(self.close(self.by_prefix(found)))), "near-edges", keep=True)
            return materialize(components(edges), "near-groups", keep=True)


def keep_one(docs: DataFrame, *, k: int = 5, least: float = 0.8, tau: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less all but one of each group of near copies; the smallest id stays, null ids last.

    Texts are near copies if the sets of their ``k``-word shingles have a Jaccard similarity of ``least`` or
    more. Large groups are found first: each text is compared with the first text whose fingerprint it is linked to within ``tau`` bits,
    and with the heads of its bands of minimum hashes. How rare a shingle is comes from a histogram of all texts' shingles, of a fixed size. Then all texts of different groups that share one of their rarest shingles are
    candidates, less those whose bitmaps show that they can't be similar; no similar pair is missed. Every candidate pair is compared
    by its whole shingle sets. Null and empty texts are equal to each other; a text of fewer than ``k`` words is one shingle. Rows that
    tie (a repeated row, or null ids) count as copies too. Very long texts are compared whole. An empty table gives an empty one.
    """
    histogram = docs.sparkSession.sparkContext.broadcast(_histogram(docs, text_col, k))
    everything = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(everything.alias("row"), F.monotonically_increasing_id().alias("uid"), _signature(F.col(text_col), k, least, histogram).alias("sig"))
    rows = materialize(rows, "near-rows")
    histogram.unpersist()
    near = _Near(rows.select("uid", F.col(f"row.`{text_col}`").alias("text"), "sig"), k, least, tau)
    groups = near.groups()
    id_ = F.col(f"row.`{id_col}`")
    keys = rows.select(F.struct(id_.isNull().alias("none"), id_.alias("id"), F.col("uid").alias("uid")).alias("order"), "uid")
    keys = join_bounded(keys, near.copies, ["uid"], "left").select("order", F.coalesce("node", "uid").alias("node"))
    named = near.rooted(keys, groups, "node", "root").select("order", "root")
    best = named.groupBy("root").agg(F.min("order").alias("best"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    gone = join_bounded(named, materialize(best, "near-best"), ["root"], "inner").where(F.col("order.uid") != F.col("best.uid")).select(F.col("order.uid").alias("uid"))
    return join_bounded(rows, materialize(gone, "near-gone"), ["uid"], "left_anti").select("row.*")
