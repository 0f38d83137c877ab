"""Benchmark decontamination by Aho-Corasick.

The windows of all test items (runs of ten words; a shorter item is one window)
form an automaton over normalised text. Each document is normalised the same
way and scanned once; every match is mapped back to a run of words, and through the
words' offsets to a range of the original text.

Spark makes the windows, joins those that several items have, deals them into blocks of
bounded size and writes these to the shared folder. A worker loads a block when it needs
it and keeps the automata of a few, so neither the driver nor a task ever holds a large benchmark. Where there
are more blocks than a worker keeps, it holds texts of some size together and takes them through one block after the other, so
that a block is loaded once for that many texts, whatever the size of a batch.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, new_path, without
from .words import LETTERS, letter_words, utf8

#: Windows of one automaton; a larger benchmark has several, by which each batch of texts is scanned in turn.
BLOCK_WINDOWS = 25_000
#: Automata that a worker keeps at most.
KEPT_AUTOMATA = 4
#: Bytes of texts that a worker takes through the blocks together.
HELD_BYTES = 32 << 20
_kept: OrderedDict[str, ahocorasick.Automaton] = OrderedDict()

RESULT = "struct<n_words:long,n_hit:long,spans:array<struct<start:int,end:int>>,items:array<string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])


def item_windows(text: bytes | None, size: int) -> list[bytes]:
    """The windows of a test item, their words joined by spaces."""
    words = letter_words(text)
    count = len(words) - size + 1 if len(words) >= size else bool(words)
    return [b" ".join(words[k : k + size]) for k in range(count)]


def windows_of(benchmark: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(window, items): every window once, with the ids of the items that have it."""

    def windows(batches):
        for batch in batches:
            made = [(item, w) for item, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True) for w in dict.fromkeys(item_windows(raw, size))]
            yield pa.RecordBatch.from_pydict({"item": pa.array([i for i, _ in made], pa.string()), "window": pa.array([w for _, w in made], pa.binary())})

    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).mapInArrow(windows, "item string, window binary")
    return rows.groupBy("window").agg(F.collect_set("item").alias("items"))


def write_blocks(windows: DataFrame) -> list[str]:
    """Writes the windows in blocks and returns their folders; none without windows."""
    every = materialize(windows, "benchmark-windows")
    blocks = -(-every.count() // BLOCK_WINDOWS)
    path = new_path(windows.sparkSession, "benchmark-blocks")
    if blocks:
        every.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)).cast("int")).repartition(blocks, "block").write.partitionBy("block").parquet(path)
    return [f"{path}/block={k}" for k in range(blocks)]


def load_block(folder: str) -> ahocorasick.Automaton:
    """The automaton of a block's windows, each with a space at either end, in a task."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    automaton = ahocorasick.Automaton()
    for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if info.base_name.endswith(".parquet"):
            table = pq.read_table(info.path, columns=["window", "items"], filesystem=store, partitioning=None)
            for window, items in zip(table["window"].to_pylist(), table["items"].to_pylist(), strict=True):
                automaton.add_word(f" {window.decode('utf-8', 'surrogatepass')} ", (window.count(b" ") + 1, tuple(items)))
    automaton.make_automaton()
    return automaton


def _block(folder: str) -> ahocorasick.Automaton:
    """Loaded once in each Python worker, as long as it is among the last ``KEPT_AUTOMATA`` ones."""
    if folder not in _kept:
        while len(_kept) >= KEPT_AUTOMATA:
            _kept.popitem(last=False)
        _kept[folder] = load_block(folder)
    _kept.move_to_end(folder)
    return _kept[folder]


def runs_of(found: list[tuple[int, int]]) -> list[list[int]]:
    """Ranges (first, last) of words, joined where they touch or overlap, in order."""
    runs: list[list[int]] = []
    for first, last in sorted(found):
        if runs and first <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return runs


def _word_spans(raw: bytes, runs: list[list[int]]) -> list[dict[str, int]]:
    """Character offsets in the original text of runs of words."""
    flags = np.frombuffer(raw.translate(LETTERS), dtype=np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # for each byte of UTF-8 the number of characters before it
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(chars[starts[a]]), "end": int(chars[ends[b]])} for a, b in runs]


def _scan_texts(raws: list[bytes | None], folders: list[str]) -> pa.Array:
    """The result of each text, all of them taken through one block after the other."""
    plain, sizes = [], []
    for raw in raws:
        words = letter_words(raw)
        sizes.append(len(words))
        plain.append(f" {b' '.join(words).decode('utf-8', 'surrogatepass')} " if words else "")
    found: list[list[tuple[int, int]]] = [[] for _ in raws]
    items: list[set[str]] = [set() for _ in raws]
    for folder in folders if any(plain) else ():
        automaton = _block(folder)
        for k, text in enumerate(plain if len(automaton) else ()):
            hits = list(automaton.iter(text)) if text else ()
            if hits:
                # a match ends with the space after its last word: as many spaces stand before as the words up to it
                spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4") == 32)
                last = np.searchsorted(spaces, [end for end, _ in hits]) - 1
                for stop, (_, (count, ids)) in zip(last.tolist(), hits, strict=True):
                    found[k].append((stop - count + 1, stop))
                    items[k].update(ids)
    made = []
    for raw, n, hits, ids in zip(raws, sizes, found, items, strict=True):
        runs = runs_of(hits)
        made.append({"n_words": n, "n_hit": sum(b - a + 1 for a, b in runs), "spans": _word_spans(raw, runs) if runs else [], "items": sorted(ids)})
    return pa.array(made, _RESULT)


def scan_batches(batches: Iterator[pa.Array], folders: list[str]) -> Iterator[pa.Array]:
    """The results of batches of texts. With more blocks than are kept batches are held up to ``HELD_BYTES``, and every second time the blocks are met backwards, from those that are still kept."""
    held: list[list[bytes | None]] = []
    size = 0

    def done() -> Iterator[pa.Array]:
        nonlocal held, size, folders
        made = _scan_texts([raw for part in held for raw in part], folders)
        at = 0
        for part in held:
            yield made.slice(at, len(part))
            at += len(part)
        held, size, folders = [], 0, folders[::-1]

    for batch in batches:
        held.append(utf8(batch))
        size += sum(len(raw) for raw in held[-1] if raw)
        if len(folders) <= KEPT_AUTOMATA or size >= HELD_BYTES:
            yield from done()
    if held:
        yield from done()


def _scanned(text: Column, folders: list[str]) -> Column:
    @F.arrow_udf(RESULT)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from scan_batches(batches, folders)

    return scanned(text)


def scan(docs: DataFrame, benchmark: DataFrame, *, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``n_items``, ``items``, ``spans`` and ``contaminated`` to every row.

    ``spans`` are the character ranges of the original text that hit words cover,
    joined where they touch; ``items`` the ids of test items with a window in
    the text, sorted as strings. Null or empty texts have no words; test items
    without words have no window, and items without an id mark words but are not
    listed. Repeated items and repeated rows count like single ones; very long texts are
    scanned whole. An empty benchmark leaves every row clean, an empty table stays empty.
    Input columns called like an output column are replaced. A benchmark of more than ``BLOCK_WINDOWS`` windows is
    scanned for in blocks; each text is read once, and normalised once.
    """
    docs = without(docs, "n_words", "n_hit", "n_items", "items", "spans", "contaminated")
    folders = write_blocks(windows_of(benchmark, size, id_col, text_col))
    (name,) = fresh(docs, "scan_result")
    out = docs.withColumn(name, _scanned(F.col(text_col), folders))
    columns = {c: F.col(f"{name}.{c}") for c in ("n_words", "n_hit", "items", "spans")}
    out = out.withColumns({**columns, "n_items": F.size(columns["items"]).cast("long"), "contaminated": columns["n_hit"] > 0})
    return out.drop(name)
