"""Quality scores: random Fourier features, ridge regression by summed normal equations, isotonic calibration.

A text becomes some two dozen statistics. Random cosines of the standardised
statistics approximate a Gaussian kernel; each partition sums its part of the
normal equations, Spark adds them up, and the driver solves one small system. On
rows that the fit didn't see, the pool-adjacent-violators method turns
scores into probabilities.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, without
from .toxicity import labelled
from .words import LOWER, utf8

#: Names of the statistics, in order.
STATISTICS = (
    "log_bytes", "log_words", "word_length", "letters", "upper", "digits", "beyond_ascii", "spaces", "newlines", "stops",
    "commas", "bars", "brackets", "odd_marks", "exclamations", "distinct_words", "top_word", "top_pair", "distinct_lines",
    "line_length", "short_lines", "words_with_marks", "upper_words", "longest_word",
)
_PARTITIONS = 16


def statistics(raw: bytes | None) -> np.ndarray:
    """The statistics of one whole text; zeros for null and empty."""
    out = np.zeros(len(STATISTICS))
    if not raw:
        return out
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n = len(raw)
    of = lambda chars: sum(int(counts[c]) for c in chars) / n
    words = raw.split()
    lower = [w.translate(LOWER) for w in words]
    m = max(1, len(words))
    uses = Counter(lower)
    pairs = Counter(zip(lower, lower[1:], strict=False))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    out[:] = (
        math.log1p(n), math.log1p(len(words)), (n - counts[32] - counts[10]) / m,
        (counts[65:91].sum() + counts[97:123].sum()) / n, counts[65:91].sum() / n, counts[48:58].sum() / n, counts[128:].sum() / n,
        counts[32] / n, counts[10] / n, of(b".:;"), of(b","), of(b"|"), of(b"[](){}<>"), of(b"#$%&*+=@\\^_~/"), of(b"!?"),
        len(uses) / m, max(uses.values(), default=0) / m, max(pairs.values(), default=0) / m, len(set(lines)) / k,
        math.log1p(n / k), sum(len(x) < 30 for x in lines) / k,
        sum(not (0x61 <= w[-1] | 32 <= 0x7A or w[-1] >= 0x80) for w in words) / m, sum(w.isupper() for w in words) / m,
        math.log1p(max(map(len, words), default=0)),
    )
    return out


class Model:
    """Standardisation, cosines, ridge weights and the calibration steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, gamma: float, seed: int):
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0.0, math.sqrt(2 * gamma), (d, features))
        self.b = rng.uniform(0, 2 * math.pi, features)
        self.beta = np.zeros(features + 1)
        self.steps = (np.array([0.0, 1.0]), np.array([0.5, 0.5]))

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.cos(z @ self.w + self.b) * math.sqrt(2 / len(self.b)), np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), *self.steps)


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators over bins (score, sum of labels, rows): centre and mean label of each pool, not falling."""
    pools: list[list[float]] = []  # sum of labels, rows, weighted score
    for a, b, c in zip(x, y, n, strict=True):
        pools.append([b, c, a * c])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    # half a row of either kind keeps the ends inside (0, 1)
    means = [(s + 0.5) / (c + 1) for s, c, _ in pools]
    return np.array([w / c for _, c, w in pools]), np.maximum.accumulate(means)


def text_statistics(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(raw) for raw in utf8(texts)], pa.list_(pa.float64()))

    return measured(text)


def fit(docs: DataFrame, labels: DataFrame, *, target: str = "quality", max_labelled: int = 200_000, features: int = 256, gamma: float = 0.02, ridge: float = 1.0, seed: int = 7) -> Model:
    """Learns from the labelled rows that aren't held out, of which ``max_labelled`` at most.

    Seven tenths of them, by hash of the statistics, fit the weights; the others calibrate.
    Without labels of both kinds, in an empty table too, every score is the smoothed share of label 1. Statistics are of whole texts, however long, and are clipped at 6 deviations.
    Repeated rows count as often as they stand there and fall on the same side; ties in the statistics share a step of the calibration. Null and empty texts have statistics of zero.
    """
    d = len(STATISTICS)
    rows = labelled(docs, labels, target, max_labelled, "inner").select(text_statistics(F.col("text")).alias("x"), F.when(F.col("y") > 0, 1.0).otherwise(0.0).alias("y"))
    rows = materialize(rows.withColumn("fitted", F.pmod(F.xxhash64("x"), F.lit(10)) < 7), "quality-rows")
    one = rows.agg(F.count("y"), F.coalesce(F.sum("y"), F.lit(0.0)), *[f(F.col("x")[k]) for k in range(d) for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([v or 0.0 for v in one[2::2]])
    scale = np.array([v if v and v > 1e-9 else 1.0 for v in one[3::2]])
    model = Model(mean, scale, features, gamma, seed)
    n, ones = one[0], one[1]
    model.steps = (np.array([0.0, 1.0]), np.full(2, (ones + 0.5) / (n + 1)))
    if not 0 < ones < n:
        return model
    size = features + 1

    def normal(batches):
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            f = model.features(np.array(batch.column(0).to_pylist()).reshape(-1, d))
            left += f.T @ f
            right += f.T @ batch.column(1).to_numpy(zero_copy_only=False)
        for k in range(size):
            yield pa.RecordBatch.from_pydict({"row": pa.array([k], pa.int32()), "part": pa.array([[*left[k], right[k]]], pa.list_(pa.float64()))})

    parts = rows.where("fitted").select("x", "y").coalesce(_PARTITIONS).mapInArrow(normal, "row int, part array<double>")
    sums = parts.select("row", F.posexplode("part").alias("column", "v")).groupBy("row", "column").agg(F.sum("v").alias("v"))
    system = np.zeros((size, size + 1))
    for r in sums.collect():  # the size of the system, whatever the input
        system[r["row"], r["column"]] = r["v"]
    penalty = ridge * np.eye(size)
    penalty[-1, -1] = 1e-6
    model.beta = np.linalg.solve(system[:, :size] + penalty, system[:, size])

    @F.arrow_udf("double")
    def raw(x: pa.Array) -> pa.Array:
        return pa.array(model.raw(np.array(x.to_pylist()).reshape(-1, d)))

    # a thousand bins of the score, whatever the input
    bins = rows.where("NOT fitted").select(F.round(F.least(F.greatest(raw("x"), F.lit(-1.0)), F.lit(2.0)) * 333).alias("bin"), "y")
    table = sorted(bins.groupBy("bin").agg(F.sum("y"), F.count("y")).collect())
    if table:
        model.steps = isotonic(*[np.array(c, dtype=float) for c in zip(*[(b / 333, y, c) for b, y, c in table], strict=True)])
    return model


def score(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``) to every row.

    Null and empty texts have statistics of zero and are scored like any other; very long texts are read whole. Repeated rows and texts that tie in their
    statistics have the same score, an empty table stays empty. Input columns called like an output column are replaced.
    """

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        x = np.array([statistics(raw) for raw in utf8(texts)]).reshape(-1, len(STATISTICS))
        return pa.array(model.probability(x) if len(x) else [], pa.float64())

    out = without(docs, "score", "predicted").withColumn("score", scored(text_col))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
