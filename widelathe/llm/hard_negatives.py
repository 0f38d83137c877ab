"""Hard negatives by threshold joins.

A threshold join finds all rows whose inner product with an anchor is at least the anchor's threshold. The rows of
a batch form an inverted index by dimension, heaviest dimensions first, that leaves out the last dimensions of a row
where the norm of what is left out times the largest such norm of an anchor stays below the least threshold.
Anchors accumulate partial scores over the lists; a row goes as soon as what it has so far and the norms of what remains can't reach
any threshold, and the pairs that stay are completed by the dimensions that weren't indexed.

Thresholds start high, as a bounded sample of the rows suggests, and are lowered for those anchors whose windows
didn't fill. Where a round starts decides its work, never its result: the last round has no threshold but the window's own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Rows from which the first thresholds are guessed, at most.
SAMPLE = 2048
#: Anchors that are sent to the tasks at once, at most about; with 64 dimensions 8 MB.
GROUP = 16_384
#: Rows of an index and anchors that probe it together.
ROWS, PROBES = 4096, 512
#: Dimensions of a posting list's step.
STEP = 8
#: Pairs that a task holds before it keeps only the best of each window.
HELD = 1_000_000
#: Whole numbers up to here are exact as floats.
EXACT = 2.0**52
_LONG = 2**63 - 1


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A row for each vector, padded with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def tail_norms(x: np.ndarray) -> np.ndarray:
    """For each row and step the norm of its dimensions from that step on; 0 after the last."""
    steps = -(-x.shape[1] // STEP)
    squares = np.zeros((len(x), steps * STEP))
    squares[:, : x.shape[1]] = np.square(x, dtype=np.float64)
    sums = squares.reshape(len(x), steps, STEP).sum(axis=2)
    return np.sqrt(np.concatenate([np.cumsum(sums[:, ::-1], axis=1)[:, ::-1], np.zeros((len(x), 1))], axis=1))


class InvertedIndex:
    """Rows by dimension, those with the most indexed dimensions first, so that each list is the head of the rows."""

    def __init__(self, x: np.ndarray, tails: np.ndarray, least: float):
        """``tails``: for each step the largest norm of the anchors' dimensions from there on; ``least``: the least threshold."""
        norms = tail_norms(x)
        covered = norms * tails * (1 + 1e-9) < least
        steps = norms.shape[1] - 1
        # at the last boundary nothing is left out; a row that can't reach the threshold at all is covered there too if it is before
        indexed = np.where(covered.any(axis=1), covered.argmax(axis=1), steps)
        self.order = np.argsort(-indexed, kind="stable")[: np.count_nonzero(indexed)] if least > 0 else np.argsort(-indexed, kind="stable")
        self.x, self.norms, self.indexed, self.steps = x[self.order].astype(np.float64), norms[self.order], indexed[self.order], steps

    def probe(self, q: np.ndarray, norms: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, score) of all pairs whose score is the anchor's ``least`` or more."""
        rows, q = np.arange(len(self.order)), q.astype(np.float64)
        partial = np.zeros((len(rows), len(q)))
        for k in range(self.steps):
            listed = np.count_nonzero(self.indexed[rows] > k)
            if not listed:
                break
            here = slice(k * STEP, (k + 1) * STEP)
            partial[:listed] += self.x[rows[:listed], here] @ q[:, here].T
            rest = self.norms[rows[:listed], k + 1, None] * norms[:, k + 1]
            may = (partial[:listed] + rest * (1 + 1e-9) + 1e-6 >= least).any(axis=1)
            if np.count_nonzero(may) < 0.8 * listed:
                stay = np.concatenate([np.flatnonzero(may), np.arange(listed, len(rows))])
                rows, partial = rows[stay], partial[stay]
        until = self.indexed[rows]
        rest = self.norms[rows, until, None] * norms[:, until].T
        at, anchor = np.nonzero(partial + rest * (1 + 1e-9) + 1e-6 >= least)
        score = partial[at, anchor]
        for k in np.unique(until[at]):
            own = np.flatnonzero(until[at] == k)
            score[own] += np.einsum("ij,ij->i", self.x[rows[at[own]], k * STEP :], q[anchor[own], k * STEP :])
        good = score >= least[anchor]
        return self.order[rows[at[good]]], anchor[good], score[good]


def threshold_join(x: np.ndarray, q: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of ``x``, row of ``q``, score) of all pairs with a score of ``least`` of the anchor or more, in pieces.

    Vectors so long that floats aren't exact are multiplied as Python's whole numbers; scores beyond a long count as its largest or least.
    """
    if not len(x) or not len(q):
        return
    norms = tail_norms(q)
    if tail_norms(x)[:, 0].max() * norms[:, 0].max() >= EXACT:
        score = np.clip(x.astype(object) @ q.astype(object).T, -_LONG - 1, _LONG)
        row, anchor = np.nonzero(score >= least)
        yield row, anchor, score[row, anchor]
        return
    by = np.argsort(-least, kind="stable")  # anchors with like thresholds probe together
    for at in range(0, len(x), ROWS):
        for k in range(0, len(q), PROBES):
            own = by[k : k + PROBES]
            index = InvertedIndex(x[at : at + ROWS], norms[own].max(axis=0), float(least[own].min()))
            row, anchor, score = index.probe(q[own], norms[own], least[own])
            yield row + at, own[anchor], score


def _bounds(column: pa.ChunkedArray, none: float) -> np.ndarray:
    """Floats, or Python's numbers if there are such as floats don't hold."""
    out = np.array([none if v is None else v for v in column.to_pylist()], dtype=object)
    return out if any(EXACT < abs(v) < np.inf for v in out) else out.astype(np.float64)


class _Asked:
    """Anchors of a group, each once, with their windows: what is sent to the tasks."""

    def __init__(self, table: pa.Table, width: int):
        uid, self.anchor = np.unique(table["uid"].to_numpy(), return_inverse=True)
        first = np.unique(self.anchor, return_index=True)[1]
        self.uid, self.window, self.owner = uid, table["window"].to_numpy(), self.anchor
        self.label = table["label"].to_numpy()[first]
        q = matrix(table["vec"], width)[first]
        self.heavy = np.argsort(-np.square(q, dtype=np.float64).sum(axis=0), kind="stable")
        self.q = q[:, self.heavy]
        self.least, self.most = _bounds(table["least"], -np.inf), _bounds(table["hi"], np.inf)
        # the windows of each anchor, side by side
        order = np.argsort(self.anchor, kind="stable")
        place = np.arange(len(order)) - np.searchsorted(self.anchor[order], self.anchor[order])
        self.windows = np.full((len(uid), place.max(initial=-1) + 1), -1)
        self.windows[self.anchor[order], place] = order


class _Best:
    """The best rows of each window among those seen: score, then smaller id."""

    def __init__(self, windows: int, k: int):
        self.k, self.parts, self.held = k, [], 0
        self.least = np.full(windows, -np.inf)

    def add(self, window: np.ndarray, score: np.ndarray, none: np.ndarray, id_: np.ndarray) -> None:
        if len(window):
            self.parts.append((window, score, none, id_))
            self.held += len(window)
        if self.held > HELD:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        window, score, none, id_ = (np.concatenate([p[k] for p in self.parts]) if self.parts else np.zeros(0, dtype=np.int64) for k in range(4))
        order = np.lexsort((id_, none, -score, window)) if score.dtype != object else np.array(sorted(range(len(score)), key=lambda i: (window[i], -score[i], none[i], id_[i])), dtype=np.int64)
        place = np.arange(len(order)) - np.searchsorted(window[order], window[order])
        kept = order[place < self.k]
        full = order[place == self.k - 1]
        if score.dtype != object:
            self.least[window[full]] = score[full]
        self.parts, self.held = [(window[kept], score[kept], none[kept], id_[kept])], len(kept)
        return self.parts[0]


def _task(asked, width: int, k: int, same: bool) -> Callable:  # noqa: ANN001
    """Finds in a partition of rows the best ``k`` of each window at or above its threshold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: _Asked = asked.value
        best = _Best(len(a.owner), k)
        for batch in batches:
            uid, label = batch.column("uid").to_numpy(), batch.column("label").to_numpy(zero_copy_only=False)
            none = batch.column("id").is_null().to_numpy(zero_copy_only=False)
            id_ = batch.column("id").fill_null(_LONG).to_numpy()
            x = matrix(batch.column("vec"), width)[:, a.heavy]
            raised = np.where(best.least > a.least, best.least, a.least)
            least = np.full(len(a.uid), np.inf)
            np.minimum.at(least, a.owner, raised.astype(np.float64))
            for row, anchor, score in threshold_join(x, a.q, least):
                fits = (label[row] == a.label[anchor]) & (uid[row] != a.uid[anchor]) if same else label[row] != a.label[anchor]
                row, anchor, score = row[fits], anchor[fits], score[fits]
                for windows in a.windows.T:
                    window = windows[anchor]
                    own = np.flatnonzero(window >= 0)
                    own = own[(score[own] >= raised[window[own]]) & (score[own] <= a.most[window[own]])]
                    best.add(window[own], score[own], none[row[own]], id_[row[own]])
        window, score, none, id_ = best.settle()
        made = {
            "uid": pa.array(a.uid[a.owner[window]] if len(window) else [], pa.int64()),
            "window": pa.array(a.window[window] if len(window) else [], pa.int32()),
            "score": pa.array([int(s) for s in score], pa.int64()),
            "id": pa.array([None if n else i for n, i in zip(none.tolist(), id_.tolist(), strict=True)], pa.int64()),
        }
        yield pa.RecordBatch.from_pydict(made)

    return run


def _levels(wanted: DataFrame, sample: pa.Table, width: int, k: int, early: int, same: bool) -> DataFrame:
    """Adds ``levels``, the thresholds a window is tried with: its sample's ``early``-th best score, its ``k``-th best, then null for none."""
    kept = wanted.sparkSession.sparkContext.broadcast((sample["uid"].to_numpy(), sample["label"].to_numpy(), matrix(sample["vec"], width)))

    def guess(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, label, x = kept.value
        for whole in batches:
            for at in range(0, whole.num_rows, PROBES):
                batch = whole.slice(at, PROBES)
                q = matrix(batch.column("vec"), width)
                exact = tail_norms(q)[:, 0].max(initial=0) * tail_norms(x)[:, 0].max(initial=0) < EXACT
                scores = q.astype(np.float64) @ x.T.astype(np.float64) if exact else None
                out = []
                for i, row in enumerate(batch.select(["uid", "label", "lo", "hi"]).to_pylist()):
                    found: list[int] = []
                    if exact:
                        fits = (label == row["label"]) & (uid != row["uid"]) if same else label != row["label"]
                        own = scores[i][fits]
                        own = own[(own >= (-np.inf if row["lo"] is None else row["lo"])) & (own <= (np.inf if row["hi"] is None else row["hi"]))]
                        found = np.sort(own)[::-1][:k].astype(np.int64).tolist()
                    tries = [found[r - 1] for r in sorted({early, k}) if len(found) >= r]
                    out.append([*tries, None])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], [*batch.schema.names, "levels"])

    return wanted.mapInArrow(guess, ", ".join(f"`{n}` {t}" for n, t in wanted.dtypes) + ", levels array<long>")


def fill_windows(rows: DataFrame, wanted: DataFrame, k: int, *, same: bool) -> DataFrame:
    """(uid, window, rank, id, score): the first ``k`` rows of each window, all if they are fewer.

    ``rows`` (uid, id, label, vec) and ``wanted`` (uid, label, vec, window, lo, hi) are written tables. A window takes the rows of its anchor's label, less the anchor
    itself, or with ``same`` false those of others, with a score from ``lo`` to ``hi`` (null: no bound). Anchors go to the tasks in groups of about ``GROUP``.
    """
    count, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    width = max(width, 1)
    sample = rows.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).toArrow()
    early = min(k, -(-3 * k * SAMPLE // max(count, 1)))
    rest = materialize(_levels(wanted, sample, width, k, early, same), "negatives-wanted")
    spark, place = rows.sparkSession, Window.partitionBy("uid", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    done = []
    for _ in range(3):
        asking = rest.select("uid", "label", "vec", "window", "hi", F.coalesce(F.get("levels", F.lit(0)), "lo").alias("least"))
        groups = -(-rest.count() // GROUP)
        found = []
        for g in range(groups):
            own = asking.where(F.pmod(F.xxhash64("uid"), F.lit(groups)) == g).toArrow()
            if own.num_rows:
                asked = spark.sparkContext.broadcast(_Asked(own, width))
                some = rows.mapInArrow(_task(asked, width, k, same), "uid long, window int, score long, id long")
                some = some.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
                found.append(materialize(some, "negatives-found"))
                asked.unpersist()
        if not found:
            break
        found = reduce(DataFrame.unionByName, found)
        met = rest.join(found.groupBy("uid", "window").agg(F.count(F.lit(1)).alias("n")), ["uid", "window"], "left")
        short = (F.coalesce("n", F.lit(0)) < k) & (F.size("levels") > 1)
        rest = materialize(met.where(short).withColumn("levels", F.slice("levels", 2, 3)).drop("n"), "negatives-wanted")
        # what a window that goes on has found is found again
        done.append(found.join(rest.select("uid", "window"), ["uid", "window"], "left_anti"))
    if not done:
        return spark.createDataFrame([], "uid long, window int, rank int, id long, score long")
    return reduce(DataFrame.unionByName, done).select("uid", "window", "rank", "id", "score")


def mine(
    rows: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of the rows that ``anchors`` holds for.

    ``vector_col`` holds arrays of whole numbers (longs), the score is the inner product; higher scores come first, of equal ones the smaller id (a whole number; null comes last).
    An anchor's positives are its first ``positives`` other rows of its label. For each anchor and positive the first ``negatives`` rows of other labels
    come whose score is from ``low`` to ``high`` percent of the positive's. Where there are fewer, all count.

    Rows with a null label, vector or component take no part. Of vectors of different lengths the shorter counts as ending in zeros. Repeated rows
    count each, as anchors too; two rows of one anchor are each other's positives. An empty table has no result. Only the three columns are read, so that others don't clash.
    """
    whole = F.col(vector_col).isNotNull() & F.col(label_col).isNotNull() & F.forall(vector_col, lambda v: v.isNotNull())
    kept = rows.where(whole).select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<long>").alias("vec"), F.coalesce(anchors, F.lit(False)).alias("asks")
    )
    kept = materialize(kept, "negatives-rows")
    own = kept.select("uid", "id", "label", "vec")
    asks = kept.where("asks").select("uid", "label", "vec")
    none = F.lit(None).cast("long")
    first = fill_windows(own, asks.select("*", F.lit(0).alias("window"), none.alias("lo"), none.alias("hi")), positives, same=True)
    first = materialize(first.select("uid", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # div cuts towards zero: the lower bound is to go up, the upper one down
    percent = lambda p, up, down: F.expr(f"CAST((CAST(positive_score AS decimal(25,0)) * {int(p)} + IF(positive_score < 0, {down}, {up})) div 100 AS long)")
    bounds = first.select("uid", "window", percent(low, 99, 0).alias("lo"), percent(high, 0, -99).alias("hi")).where("lo <= hi")
    wanted = materialize(asks.join(bounds, "uid"), "negatives-windows")
    found = fill_windows(own, wanted, negatives, same=False)
    named = kept.where("asks").select("uid", F.col("id").alias("anchor_id"))
    out = found.join(first, ["uid", "window"]).join(named, "uid")
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
