"""Toxic passages by maximum-scoring segments.

A token's score is its log-odds between toxic and other labelled texts, under a
Dirichlet prior that is proportional to the token's count in the whole corpus, drawn towards the
prior's own log-odds, zero, as far as its evidence is weak. Every token has its score, positive or negative; a token
without evidence has the prior's. The maximal segments of a text's score sequence are found by one scan; each is a
passage. How large a segment chance makes in a clean text of n tokens follows an
extreme-value law, P(S >= x) = 1 - exp(-K n exp(-lambda x)); what the
segments exceed that by is summed up for the text and mapped to a probability.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, materialize, without
from .words import LETTERS, letter_words, utf8

#: Distinct words that a task counts before it hands on what it has.
_HELD = 250_000
#: Lengths in bytes of the stems that are counted besides whole words.
STEMS = (4, 5, 6)
PASSAGES = "struct<score:double,passages:array<struct<start:int,end:int,score:double>>>"


def training_labels(labels: DataFrame, target: str, max_labelled: int) -> DataFrame:
    """(doc_id, y) of the labelled rows that may be learnt from, of which about ``max_labelled`` at most, picked by hash.

    Several labels of one id count as the largest; rows without an id or label are left out.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(target).cast("int").alias("y"))
    share = min(1.0, max_labelled / max(1, usable.count()))
    return usable if share == 1.0 else usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))


def labelled(docs: DataFrame, labels: DataFrame, target: str, max_labelled: int, how: str) -> DataFrame:
    """(text, y) of ``docs``; the labels are bounded and broadcast, so that no text is moved."""
    known = F.broadcast(training_labels(labels, target, max_labelled))
    return docs.select("doc_id", "text").join(known, "doc_id", how).select("text", "y")


def count_words(rows: DataFrame) -> DataFrame:
    """(word, n, n1, n0): uses in all texts, in those labelled 1 and in those labelled 0. Counts are summed in each task first."""

    def tally(batches):
        counts = {None: Counter(), 1: Counter(), 0: Counter()}
        held = lambda: sum(map(len, counts.values()))

        def rows_of():
            words = list(set().union(*counts.values()))
            per = [[counts[y][w] for w in words] for y in (None, 1, 0)]
            data = [pa.array(words, pa.binary()), *[pa.array(x, pa.int64()) for x in ([a + b + c for a, b, c in zip(*per, strict=True)], per[1], per[2])]]
            for c in counts.values():
                c.clear()
            return pa.RecordBatch.from_arrays(data, ["word", "n", "n1", "n0"])

        for batch in batches:
            for raw, y in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                counts[None if y is None else int(y > 0)].update(letter_words(raw))
                if held() > _HELD:
                    yield rows_of()
        yield rows_of()

    partial = rows.select("text", "y").mapInArrow(tally, "word binary, n long, n1 long, n0 long")
    return partial.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "n1", "n0")])


def log_odds(counts: DataFrame, total: dict[str, float], prior: float, weak: float, least: float) -> DataFrame:
    """Adds ``odds`` (log-odds of class 1 against 0), ``z`` (in standard errors) and ``score`` to (word, n, n1, n0).

    ``total`` has the sums of n, n1 and n0 over all words. ``prior`` is the weight of the corpus-wide
    frequencies in each class, as a share of the class's tokens; of a word in neither class the log-odds are zero.
    ``score`` is the log-odds times z⁴/(z⁴ + weak⁴), in tenths and between ``least`` and 8.
    """
    share = F.col("n") / F.lit(max(1.0, total["n"]))
    size = {c: (total[c] + 1) * prior for c in ("n1", "n0")}
    own = {c: F.col(c) + share * F.lit(size[c]) for c in size}
    side = {c: F.log(own[c] / (F.lit(total[c] + size[c]) - own[c])) for c in size}
    out = counts.withColumn("odds", side["n1"] - side["n0"]).withColumn("z", F.col("odds") / F.sqrt(1 / own["n1"] + 1 / own["n0"]))
    evidence = F.pow(F.abs("z"), F.lit(4.0))
    drawn = F.col("odds") * evidence / (evidence + F.lit(weak**4))
    return out.withColumn("score", F.round(F.greatest(F.lit(least), F.least(F.lit(8.0), F.coalesce(drawn, F.lit(0.0)))), 1))


def segments(scores: list[float], at: list[int] | None = None, gap: float = 0.0) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, after last, score) of a sequence, in linear time.

    With ``at`` the scores stand at these places and every other place has the score ``gap``, at most 0.
    Segments that later ones might extend are kept on a stack with the sums before and after each.
    """
    stack: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, first, after last, link
    total, last = 0.0, -1
    for k, s in zip(range(len(scores)) if at is None else at, scores, strict=True):
        before = total + gap * (k - last - 1)
        total, last = before + s, k
        if s <= 0:
            continue
        low, high, first = before, total, k
        while True:
            # the link of an entry is the last one before it with a smaller sum before
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= high:
                break
            low, first = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((low, high, first, k + 1, j))
    return [(a, b, high - low) for low, high, a, b, _ in stack]


def hashes_of(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words and stems; among some millions of them two meet with a chance of one in millions."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def with_stems(words: list[bytes]) -> list[bytes]:
    """The words, then for each length of ``STEMS`` their stems; of a shorter word the word again."""
    return words + [w[:n] + b"*" if len(w) >= n else w for n in STEMS for w in words]


class Hashed:
    """Places of words in a table by their hashes: 8 bytes for a word, where a dictionary has some 200."""

    def __init__(self, words: pa.ChunkedArray):
        found = np.concatenate([hashes_of(c.to_pylist()) for c in words.chunks] or [np.zeros(0, dtype=np.uint64)])
        self.order = np.argsort(found, kind="stable").astype(np.int32)
        self.keys = found[self.order]

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word, or the table's length for an unknown one."""
        if not len(self.keys):
            return np.zeros(len(words), dtype=np.int64)
        asked = hashes_of(words)
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.order[at], len(self.keys)).astype(np.int64)


class Model:
    """Scores of words and of stems (first bytes of a word), the drift, extreme-value parameters and the calibration curve.

    ``scores`` has (score, standard errors from zero). Of a word and its stems the one with the most evidence gives the score;
    a word without any has the prior's, zero. The drift is added to each, so that chance alone makes no long segments.
    The driver holds and hands on an Arrow table (word, score, z), of which a worker makes its dictionary.
    """

    def __init__(self, scores: dict[bytes, tuple[float, float]] | pa.Table, drift: float, lam: float, k: float, curve: tuple[float, float, float]):
        if isinstance(scores, dict):
            columns = [list(scores), [s for s, _ in scores.values()], [z for _, z in scores.values()]]
            scores = pa.table([pa.array(v, t) for v, t in zip(columns, (pa.binary(), pa.float64(), pa.float64()), strict=True)], ["word", "score", "z"])
        self.table, self.drift, self.lam, self.k, self.curve = scores, drift, lam, k, curve
        self.memo: dict[bytes, float] = {}

    def __getstate__(self) -> dict:
        return {name: v for name, v in self.__dict__.items() if name not in ("scores", "hashed")} | {"memo": {}}

    @functools.cached_property
    def scores(self) -> dict[bytes, tuple[float, float]]:
        words, *values = (c.to_pylist() for c in self.table.columns)
        return dict(zip(words, zip(*values, strict=True), strict=True))

    @functools.cached_property
    def hashed(self) -> tuple[Hashed, np.ndarray, np.ndarray]:
        """Places, scores and standard errors; at the end those of an unknown word."""
        columns = (np.append(self.table[c].to_numpy(), none) for c, none in (("score", 0.0), ("z", -1.0)))
        return Hashed(self.table["word"]), *columns

    def scored(self, words: list[bytes]) -> list[float]:
        table, score, z = self.hashed
        at = table.places(with_stems(words)).reshape(1 + len(STEMS), len(words))
        best = np.take_along_axis(at, z[at].argmax(axis=0)[None], axis=0)[0]
        return (score[best] + self.drift).tolist()

    def word_scores(self, raw: bytes | None) -> list[float]:
        words, memo = letter_words(raw), self.memo
        new = [w for w in dict.fromkeys(words) if w not in memo]
        own = dict(zip(new, self.scored(new), strict=True)) if new else {}
        if len(memo) + len(own) <= _HELD // 2:
            memo.update(own)
        return [memo[w] if w in memo else own[w] for w in words]

    def found(self, raw: bytes | None) -> tuple[int, list[tuple[int, int, float]]]:
        """(number of words, segments as first word, word after the last, score)."""
        scores = self.word_scores(raw)
        return len(scores), segments(scores) if scores and max(scores) > 0 else []

    def passages(self, raw: bytes | None) -> tuple[int, list[tuple[int, int, float]]]:
        """(number of words, significant passages as first word, word after the last, excess)."""
        n, found = self.found(raw)
        if not found:
            return n, []
        chance = math.log(max(self.k * n, 1e-9))
        return n, [(a, b, x) for a, b, s in found if (x := self.lam * s - chance) > 0]

    def excess(self, raw: bytes | None) -> float:
        return sum(x for _, _, x in self.passages(raw)[1])

    def probability(self, excess: float) -> float:
        base, slope, jump = self.curve
        z = base + (jump + slope * math.log1p(excess) if excess > 0 else 0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def lambda_of(histogram: dict[float, int]) -> float:
    """The positive root of sum(p exp(l s)) = 1, p being the shares of the scores s in clean text."""
    n = max(1, sum(histogram.values()))
    total = lambda x: sum(c / n * math.exp(min(700.0, x * s)) for s, c in histogram.items()) - 1
    low, high = 1e-6, 1e-3
    while total(high) < 0 and high < 50:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < 0 else (low, mid)
    return max(0.05, high)


class LeftOut:
    """Scores of the words of a labelled text by the counts of all other texts: what the words would be worth had the text not been learnt from."""

    def __init__(self, table: pa.Table, total: dict[str, float], prior: float, weak: float, least: float, drift: float):
        self.table, self.total, self.prior, self.weak, self.least, self.drift = table, total, prior, weak, least, drift

    def __getstate__(self) -> dict:
        return {name: v for name, v in self.__dict__.items() if name not in ("index", "counts")}

    @functools.cached_property
    def index(self) -> Hashed:
        return Hashed(self.table["word"])

    @functools.cached_property
    def counts(self) -> tuple[np.ndarray, ...]:
        """For every word, and at the end for an unknown one: its share of all tokens, and its uses by label."""
        n, n1, n0 = (np.append(self.table[c].to_numpy().astype(np.float64), 0.0) for c in ("n", "n1", "n0"))
        return n / max(1.0, self.total["n"]), n1, n0

    def _scores(self, at: np.ndarray, own: np.ndarray, length: int, y: int) -> tuple[np.ndarray, np.ndarray]:
        """(score, standard errors from zero, -1 where there is no evidence); as ``log_odds`` has them."""
        share, n1, n0 = (c[at] for c in self.counts)
        used = []
        sides = []
        for n, c, mine in ((n1, "n1", y > 0), (n0, "n0", y <= 0)):
            n, whole = n - own * mine, self.total[c] - length * mine
            size = (whole + 1) * self.prior
            used.append(n)
            sides.append((n + share * size, whole + size))
        known = used[0] + used[1] > 0
        a, b = (np.where(known, c, 1.0) for c, _ in sides)
        odds = np.log(a / (sides[0][1] - a)) - np.log(b / (sides[1][1] - b))
        z = odds / np.sqrt(1 / a + 1 / b)
        evidence = z**4
        score = np.round(np.clip(odds * evidence / (evidence + self.weak**4), self.least, 8.0), 1)
        return score, np.where(known & (score != 0), np.abs(z), -1.0)

    def word_scores(self, raw: bytes | None, y: int) -> list[float]:
        words = letter_words(raw)
        if not words:
            return []
        uses = Counter(words)
        # a short word has no stems: it is asked for again, and counts once
        keys = with_stems(list(uses))
        places = self.index.places(keys)
        at, where = np.unique(places, return_inverse=True)
        stem = np.array([k < len(uses) or keys[k][-1:] == b"*" for k in range(len(keys))])
        own = np.bincount(where, weights=np.tile(np.fromiter(uses.values(), dtype=np.float64), 1 + len(STEMS)) * stem)
        where = where.reshape(1 + len(STEMS), len(uses)).T
        score, z = self._scores(at, own, len(words), y)
        best = np.take_along_axis(where, z[where].argmax(axis=1)[:, None], axis=1)[:, 0]
        picked = np.where(z[best] >= 0, score[best], 0.0) + self.drift
        score = dict(zip(uses, picked.tolist(), strict=True))
        return [score[w] for w in words]


def fit(docs: DataFrame, labels: DataFrame, *, target: str = "toxic", max_labelled: int = 200_000, drift: float = -0.6, prior: float = 0.1, weak: float = 2.5, least: float = -1.0, height: float = 4.0) -> Model:
    """Learns from the labelled rows that aren't held out; the prior counts every text.

    How large segments are in clean text, and what probability an excess stands for, is read off the labelled texts too, each scored by what all the others teach (``LeftOut``),
    as texts that nothing was learnt from would be. They are scored once and their segments kept. Both kinds of label weigh the same in the curve, however rare toxic texts are
    among the labelled ones: a score of 0.7 says that the excess is seven to three times likelier in a toxic text than in another.

    ``max_labelled`` bounds the labelled rows, and with them the words that the model has a score for. ``prior`` is
    the prior's weight as a share of the labelled tokens, ``weak`` the number of standard errors at which a word's log-odds
    count half, ``least`` the lowest score of a word, ``drift`` what is added to each score, ``height`` the score of the segments by which K is found. Without labels of both kinds
    all scores are the smoothed share of label 1. Repeated rows count as often as they stand there; ties don't matter.
    """
    words = materialize(count_words(labelled(docs, labels, target, max_labelled, "left")), "word-counts")
    stems = [words.where(F.length("word") >= n).groupBy(F.concat(F.substring("word", 1, n), F.lit(b"*")).alias("word")) for n in STEMS]
    stems = [g.agg(*[F.sum(c).alias(c) for c in ("n", "n1", "n0")]) for g in stems]
    counts = functools.reduce(DataFrame.unionByName, [words, *stems]).where("n1 + n0 > 0")
    total = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in ("n", "n1", "n0")]).first()
    train = labelled(docs, labels, target, max_labelled, "inner")
    if not total["n1"] or not total["n0"]:
        n, y = train.agg(F.count("y"), F.coalesce(F.sum("y"), F.lit(0))).first()
        return Model({}, drift, 1.0, 1.0, (math.log((y + 0.5) / (n - y + 0.5)), 0.0, 0.0))

    # a word with one use has none left without its text
    left_out = LeftOut(counts.where("n1 + n0 > 1").toArrow(), total.asDict(), prior, weak, least, drift)

    def scanned(batches):
        for batch in batches:
            out = []
            for text, y in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                at = [round(s, 1) for s in left_out.word_scores(text, y)]
                own = Counter(at) if y <= 0 else {}
                out.append((int(y > 0), len(at), [x for _, _, x in segments(at)], list(own), list(own.values())))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(_SCANNED.types)], schema=_SCANNED)

    # of clean text: how often each score stands there, and how many segments are high; there should be K n exp(-lambda height)
    held = materialize(train.mapInArrow(scanned, "y int, n long, segments array<double>, scores array<double>, uses array<long>"), "toxicity-scanned")
    uses = held.where("y = 0").select(F.explode(F.arrays_zip("scores", "uses")).alias("u")).groupBy(F.col("u.scores").alias("score")).agg(F.sum("u.uses").alias("n")).collect()
    histogram = {r["score"]: r["n"] for r in uses}
    above = held.where("y = 0").agg(F.coalesce(F.sum(F.size(F.filter("segments", lambda x: x >= height))), F.lit(0))).first()[0]
    lam = lambda_of(histogram)
    k = max(1e-6, (above + 0.5) / max(1, sum(histogram.values())) * math.exp(lam * height))
    # the curve is fitted to a histogram of the excess
    chance = F.log(F.greatest(F.col("n") * k, F.lit(1e-9)))
    excess = F.aggregate("segments", F.lit(0.0), lambda a, x: a + F.greatest(F.lit(0.0), x * lam - chance))
    bins = held.withColumn("bin", F.round(F.log1p(excess) * 20).cast("int"))
    table = bins.groupBy("bin").agg(F.count_if(F.col("y") > 0).alias("n1"), F.count_if(F.col("y") <= 0).alias("n0")).collect()
    x = np.array([r["bin"] / 20 for r in table])
    kinds = [np.array([r[c] for r in table], dtype=float) for c in ("n1", "n0")]
    curve = _curve(x, *[c * (kinds[0].sum() + kinds[1].sum()) / (2 * c.sum()) if c.sum() else c for c in kinds])
    scores = log_odds(counts, total.asDict(), prior, weak, least).where("score != 0").select("word", "score", F.abs("z").alias("z")).toArrow()
    return Model(scores, drift, lam, k, curve)


_SCANNED = pa.schema([("y", pa.int32()), ("n", pa.int64()), ("segments", pa.list_(pa.float64())), ("scores", pa.list_(pa.float64())), ("uses", pa.list_(pa.int64()))])


def _curve(x: np.ndarray, n1: np.ndarray, n0: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on (1, x, x > 0) by Newton's method with a small ridge; a term by which more excess would lower the score is left out and the others are fitted anew."""
    design = np.stack([np.ones_like(x), x, (x > 0).astype(float)], axis=1)
    used, ridge = [0, 1, 2], np.array([1e-3, 1e-2, 1e-2])
    while True:
        w = _newton(design[:, used], n1, n0, np.diag(ridge[used]))
        wrong = [k for k, v in zip(used, w, strict=True) if k and v < 0]
        if not wrong:
            full = dict(zip(used, w.tolist(), strict=True))
            return full[0], full.get(1, 0.0), full.get(2, 0.0)
        used = [k for k in used if k not in wrong]


def _newton(design: np.ndarray, n1: np.ndarray, n0: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    w, n = np.zeros(design.shape[1]), n1 + n0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (n * p * (1 - p) + 1e-9)[:, None]) + ridge, design.T @ (n1 - n * p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.7, spans: bool = False) -> DataFrame:
    """Adds ``score`` (0 to 1), ``predicted`` (1 from ``threshold``) and, with ``spans``, ``passages`` to every row.

    A passage is a range of characters of the text with its excess over chance. Null and empty
    texts have no passage and the lowest score; very long texts are scanned whole; repeated rows have the same score, an empty table stays empty. Input columns called like an output column are replaced.
    """
    docs = without(docs, "score", "predicted", *["passages"] * spans)

    if not spans:

        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            return pa.array([model.probability(model.excess(raw)) for raw in utf8(texts)], pa.float64())

        out = docs.withColumn("score", scored(text_col))
    else:
        (name,) = [n for n in ["toxic_result"] if n not in docs.columns] or ["_toxic_result"]

        @F.arrow_udf(PASSAGES)
        def found(texts: pa.Array) -> pa.Array:
            made = []
            for raw in utf8(texts):
                _, own = model.passages(raw)
                made.append({"score": model.probability(sum(x for *_, x in own)), "passages": _ranges(raw, own)})
            return pa.array(made, pa.struct([("score", pa.float64()), ("passages", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))]))

        out = docs.withColumn(name, found(text_col))
        out = out.withColumn("score", F.col(f"{name}.score")).withColumn("passages", F.col(f"{name}.passages")).drop(name)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _ranges(raw: bytes | None, own: list[tuple[int, int, float]]) -> list[dict]:
    if not own:
        return []
    flags = np.frombuffer(raw.translate(LETTERS), dtype=np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(chars[starts[a]]), "end": int(chars[ends[b - 1]]), "score": x} for a, b, x in own]
