"""Spelling variants: words that differ by one edit, and the frequent word that each rare one is a variant of.

Words meet under half of their letters. Two words that are one edit apart, the shorter of
length m, have their first or their last m // 2 letters in common; so each word is listed under the first and the
last half for its own length and for the length below. Spark deals the words out by these
keys. In each group a bit-sliced position index holds, for every (position, letter), the set of words with that letter
there as the bits of one integer. A query word is run over the index letter by letter: one set of words that agree so
far and three of words one edit apart (a letter replaced; one that only the query has; one that only they have, both read at positions
shifted by one) go forward together, whole sets at a time. Bits stand in order of frequency, so that the lowest one of the
result is the best word and no pair is ever written.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .words import LOWER, utf8

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Distinct words that a task counts before it hands its counts on.
COUNTED = 200_000
#: Words of one index; a larger group has several, each of which meets all words of the group.
BLOCK = 4096


def slipped(run: str, seed: int, one_in: int) -> str:
    """The run, less one letter if ``one_in`` divides its CRC-32, which goes on from ``seed``: the letter that the CRC-32 tells."""
    h = zlib.crc32(run.encode(), seed)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, *, least_letters: int = 5, least_n: int = 3, slip_one_in: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all whole texts and how often they occur.

    Words are runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z in lower case, of ``least_letters`` code points and ``least_n``
    occurrences at least. ``slip_one_in`` plants misspellings: of that share of the (document, run) pairs one letter goes, which one the
    hash of both tells. Tasks add up their own counts first. Null and empty texts have no words; a null id counts as an empty
    one; repeated rows count each; an empty table has no words. Other columns aren't read.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            words, counts = list(total), list(total.values())
            total.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(counts, pa.int64())})

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                runs = Counter(RUN.findall(raw.translate(LOWER).decode("utf-8", "surrogatepass"))) if raw else {}
                seed = zlib.crc32(f"{doc_id or ''}:".encode("utf-8", "surrogatepass"))
                for run, n in runs.items():
                    word = slipped(run, seed, slip_one_in) if slip_one_in else run
                    if len(word) >= least_letters:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield counted()
        yield counted()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


class PositionIndex:
    """The words of a block as bits, by position and letter; the first word is the lowest bit."""

    def __init__(self, words: list[str]):
        self.words = words
        self.every = (1 << len(words)) - 1
        listed: dict[tuple[int, str], list[int]] = defaultdict(list)
        sized: dict[int, list[int]] = defaultdict(list)
        for bit, word in enumerate(words):
            sized[len(word)].append(bit)
            for at, letter in enumerate(word):
                listed[at, letter].append(bit)
        self.at, self.sized = {k: _bits(v, len(words)) for k, v in listed.items()}, {k: _bits(v, len(words)) for k, v in sized.items()}

    def near(self, query: str, m: int, half: int | None = None) -> int:
        """The words one edit apart from ``query`` where the shorter of both has ``m`` letters, less those with the same first ``half`` letters."""
        at, none = self.at.get, 0
        same, replaced, fewer, more = self.every, 0, 0, 0
        known = 0 if half is None else self.every
        for i, letter in enumerate(query):
            here = at((i, letter), none)
            if i == half:
                known = same
            # the query's letter isn't in the word: what agreed so far, and what lagged by one and agrees at the position before
            fewer = same | (fewer & at((i - 1, letter), none))
            # the word has a letter that the query lacks: from here on it is read one position further
            more = (more | same) & at((i + 1, letter), none)
            replaced = (replaced & here) | (same & ~here)
            same &= here
        if half == len(query):
            known = same
        size, sized = len(query), self.sized.get
        if size == m:
            found = (replaced & sized(size, none)) | ((more | same) & sized(size + 1, none))
        else:
            found = fewer & sized(size - 1, none)
        return found & ~known


def _bits(places: list[int], size: int) -> int:
    """The integer with these bits."""
    out = bytearray(size // 8 + 1)
    for k in places:
        out[k >> 3] |= 1 << (k & 7)
    return int.from_bytes(out, "little")


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _searched(m: int, last: bool, rows: list[tuple[str, int, bool, bool]]) -> list[tuple[str, int, str, int]]:
    """For each query of a group the number of its near words and the best of them; rows are (word, n, in the index, a query)."""
    index = sorted({(-n, word) for word, n, indexed, _ in rows if indexed})
    made = PositionIndex([word for _, word in index])
    out = []
    for word, _, _, asked in rows:
        if asked and (found := made.near(word, m, m // 2 if last else None)):
            n, best = index[(found & -found).bit_length() - 1]
            out.append((word, found.bit_count(), best, -n))
    return out


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs each group's queries; rows come sorted by group, and a group is held at a time."""

    def table(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(_FOUND.types)], schema=_FOUND)

    key, rows, found = None, [], []
    for batch in batches:
        for *own, word, n, indexed, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                if key is not None and len(rows) > 1:
                    found += _searched(key[0], key[1], rows)
                key, rows = own, []
            rows.append((word, n, indexed, asked))
        if found:
            yield table(found)
            found = []
    if key is not None and len(rows) > 1:
        found += _searched(key[0], key[1], rows)
    yield table(found)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): for each word that has any, the number of words one edit apart and the one of them with the largest ``n``, of equal ones the smallest.

    ``words`` (word, n) are distinct. A group beyond ``BLOCK`` words is dealt into blocks; each is an index that the words of every block are
    run over, in a task of their own for each two blocks.
    """
    size = F.length("word")

    def keys(m: Column) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        first, last = F.substr("word", F.lit(1), half), F.substr("word", size - half + 1, half)
        return [F.struct(m.alias("m"), F.lit(side).alias("last"), part.alias("half")) for side, part in ((False, first), (True, last))]

    listed = words.select("word", "n", F.explode(F.array(*keys(size), *keys(size - 1))).alias("k")).select("k.*", "word", "n")
    group = ["m", "last", "half"]
    counts = listed.groupBy(*group).agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    listed = listed.join(counts, group).withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    small = listed.where("blocks = 1").select(*group, F.lit(0).alias("block"), F.lit(0).alias("asker"), "word", "n", F.lit(True).alias("indexed"), F.lit(True).alias("asked"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    large = listed.where("blocks > 1").withColumn("own", own)
    index = large.select(*group, F.col("own").alias("block"), every.alias("asker"), "word", "n", F.lit(True).alias("indexed"), F.lit(False).alias("asked"))
    asked = large.select(*group, every.alias("block"), F.col("own").alias("asker"), "word", "n", F.lit(False).alias("indexed"), F.lit(True).alias("asked"))
    by = [*group, "block", "asker"]
    dealt = small.unionByName(index).unionByName(asked).select(*by, "word", "n", "indexed", "asked").repartition(*by).sortWithinPartitions(*by)
    found = dealt.mapInArrow(_search, "word string, n_near long, near string, near_n long")
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.*")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that following ``form`` from ``word`` leads to.

    Every round doubles the length of the ways that are followed; as ``n`` grows by a factor with each form, a few rounds do.
    """
    ways = materialize(forms.select("word", F.col("form").alias("root")), "spelling-ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        ways = materialize(longer, "spelling-ways")
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def group_variants(words: DataFrame, *, ratio: float = 2.0) -> DataFrame:
    """(word, n, form, root, n_near, form_n): every word with the word it is a variant of.

    ``words`` (word, n) are distinct, without nulls. Two words are near if one inserted, deleted or replaced code point tells them apart. ``form`` is
    the near word with the largest ``n`` (of equal ones the smallest in code-point order) if that is ``ratio`` (over 1) times the word's own or more, ``form_n``
    its ``n``; else null. ``root`` is where following the forms ends, the word itself without a form. Further columns of ``words`` are
    left out. An empty table gives an empty one; words of any length, an empty one included, are compared.
    """
    if ratio <= 1:
        raise ValueError("ratio is over 1")
    words = materialize(words.select("word", "n"), "spelling-words")
    near = near_words(words)
    fits = F.col("near_n") >= F.lit(ratio) * F.col("n")
    formed = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[F.when(fits, c).alias(name) for c, name in ((F.col("near"), "form"), (F.col("near_n"), "form_n"))])
    formed = materialize(formed, "spelling-forms")
    roots = roots_of(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")
