"""Sharding by a Feistel permutation of global row numbers.

Rows get the numbers 0 to n-1 in the order of their ids. A keyed Feistel network
permutes these numbers; values that fall outside n are permuted again until
they fall inside (cycle walking). Shard and slot are remainder and quotient of
the permuted number, so that anyone with the seed can compute where row r went
and which row lies in a slot, without a table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, without

ROUNDS = 6
_IN_PARTITION = (1 << 33) - 1


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser of multiplications and shifts."""
    x = (x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Permutation:
    """A permutation of 0 to n-1 that ``seed`` fixes, and its inverse."""

    def __init__(self, n: int, seed: int):
        self.n, self.seed = n, seed
        bits = max(2, (max(n - 1, 1)).bit_length())
        self.low = bits // 2
        self.high = bits - self.low

    def _rounds(self, x: np.ndarray, order) -> np.ndarray:
        # each round changes one of the two parts by a keyed hash of the other
        low, high = np.uint64((1 << self.low) - 1), np.uint64((1 << self.high) - 1)
        a, b = x >> np.uint64(self.low), x & low
        for r in order:
            key = (self.seed * 1_000_003 + r * 7_919 + 12_345) & 0xFFFFFFFFFFFFFFFF
            if r % 2:
                a = a ^ (_mix(b, key) & high)
            else:
                b = b ^ (_mix(a, key) & low)
        return (a << np.uint64(self.low)) | b

    def _walk(self, x: np.ndarray, order: list[int]) -> np.ndarray:
        x = np.asarray(x, dtype=np.uint64).copy()
        with np.errstate(over="ignore"):
            todo = np.arange(len(x))
            while len(todo):
                x[todo] = self._rounds(x[todo], order)
                todo = todo[x[todo] >= self.n]
        return x.astype(np.int64)

    def apply(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, list(range(ROUNDS)))

    def invert(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, list(range(ROUNDS))[::-1])


def row_at(shard: int, slot: int, *, n_rows: int, n_shards: int, seed: int = 0) -> int:
    """The global row number in a slot of a shard."""
    return int(Permutation(n_rows, seed).invert(np.array([slot * n_shards + shard]))[0])


def place_of(row: int, *, n_rows: int, n_shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a global row number."""
    at = int(Permutation(n_rows, seed).apply(np.array([row]))[0])
    return at % n_shards, at // n_shards


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds the global row number ``name`` in the given order, without sorting all rows in one task.

    Rows are dealt into ranges and numbered inside each. Rows that tie are told
    apart by their place in the input, so that a key held by many rows is split.
    """
    at, part, place = fresh(df, "row_at", "row_part", "row_place")
    dealt = df.withColumn(place, F.monotonically_increasing_id())
    keys = [c.asc_nulls_first() for c in order] + [F.col(place).asc()]
    ranged = materialize(
        dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(place).withColumn(at, F.monotonically_increasing_id()), "numbered"
    ).withColumn(part, F.shiftright(at, 33))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # a row for each range
    offsets = ranged.groupBy(part).agg(F.count(F.lit(1)).alias(at)).select(part, F.coalesce(F.sum(at).over(before), F.lit(0)).alias(place))
    return ranged.join(F.broadcast(offsets), part).withColumn(name, F.col(place) + F.col(at).bitwiseAND(F.lit(_IN_PARTITION))).drop(at, part, place)


def assign_shards(df: DataFrame, n_shards: int = 40, *, seed: int = 0, order: list[Column] | None = None, id_col: str = "doc_id") -> DataFrame:
    """Adds ``row_number``, ``shard`` and ``slot`` to every row.

    Shards differ by at most one row and slots run from 0 without gaps. Rows are
    numbered by ``order``, by default the id, null first. Which of several
    rows with the same order gets which number follows their place in the
    input; give columns that tell them apart if that matters. An empty table
    gives an empty one; with fewer rows than shards some shards have none.
    Input columns called like an output column are replaced.
    """
    df = without(df, "row_number", "shard", "slot")
    numbered = number_rows(df, order or [F.col(id_col)], "row_number")
    n = numbered.count()

    @F.arrow_udf("long")
    def permuted(rows: pa.Array) -> pa.Array:
        return pa.array(Permutation(n, seed).apply(rows.to_numpy(zero_copy_only=False)))

    (place,) = fresh(numbered, "place")
    out = numbered.withColumn(place, permuted("row_number"))
    return out.withColumn("shard", (F.col(place) % n_shards).cast("int")).withColumn("slot", F.floor(F.col(place) / n_shards).cast("long")).drop(place)
