"""Licence scans, spelling variants and hard negatives against brute force, on small tables."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from widelathe.llm import hard_negatives, licences, queries, spelling

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


# --- licences


def base_places(text):
    words, found = letters(text), []
    for phrase, label in licences.BASE.items():
        p = phrase.split()
        found += [(k, label) for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    return len(words), found


def test_licence_query_against_brute_force(spark, documents):
    rows = {r.doc_id: r for r in queries.op11_license_scan(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert rows.keys() == texts.keys() and any(r.n_base for r in rows.values())
    for key, text in texts.items():
        r, (n, found) = rows[key], base_places(text)
        starts = [k for k, _ in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(found), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in found}))
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and {label for _, label in found} <= set(labels)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)
        own = " ".join(letters(text))
        assert ("gpl-3" in labels) == bool(re.search(r"\bgnu general public license version 3\b", own))
        assert ("all-rights-reserved" in labels) == ("all rights reserved" in own)


@pytest.mark.parametrize(
    ("text", "spelling_", "obligation"),
    [
        ("MIT", "mit", "permissive"),
        (" MIT OR Apache-2.0, see below", "mit or apache-2", "permissive"),
        ("GPL-3.0-or-later AND MIT OR BSD-3-Clause", "gpl-3 and mit or bsd-3-clause", "permissive"),
        ("GPL-3.0-only and (MIT or BSD-3-Clause)", "gpl-3 and (mit or bsd-3-clause)", "copyleft"),
        ("(MIT OR GPL-2.0) AND LGPL-2.1", "(mit or gpl-2) and lgpl-2.1", "weak-copyleft"),
        ("GPL-2.0 WITH Classpath-exception-2.0 AND ISC", "gpl-2 with classpath-exception-2.0 and isc", "weak-copyleft"),
        ("((MIT))", "mit", "permissive"),
        ("CC-BY-NC-4.0 or CC0-1.0", "cc-by-nc or cc0", "permissive"),
        ("MIT and see below", "mit", "permissive"),
        ("MIT) OR GPL-3.0", "mit", "permissive"),
        ("(MIT OR GPL-3.0", None, None),
        ("see below", None, None),
        ("", None, None),
        ("MIT OR", "mit", "permissive"),
        ("AND MIT", None, None),
    ],
)
def test_expressions(text, spelling_, obligation):
    term = licences.parse_expression(text.encode())
    assert (term and term.text, term and licences.OBLIGATIONS[term.rank]) == (spelling_, obligation)


def test_deep_and_long_expressions():
    assert licences.parse_expression(b"(" * 50_000 + b"MIT" + b")" * 50_000).text == "mit"
    assert licences.parse_expression(b"(" * 50_000) is None
    # brute force over random expressions: Python's own precedence of `|`, `&` on sets of permitted choices
    rng = np.random.default_rng(3)
    for _ in range(200):
        ids = [("MIT", 0), ("GPL-3.0", 2), ("LGPL-3.0", 1)]
        parts, ranks, depth = [], [], 0
        for k in range(int(rng.integers(1, 8))):
            if k:
                op = ("and", "or")[rng.integers(2)]
                parts.append(op)
                ranks.append({"and": "*", "or": "+"}[op])
            if rng.integers(3) == 0:
                parts.append("(")
                ranks.append("(")
                depth += 1
            name, rank = ids[rng.integers(3)]
            parts.append(name)
            ranks.append(f"R({rank})")
            if depth and rng.integers(2):
                parts.append(")")
                ranks.append(")")
                depth -= 1
        parts += [")"] * depth
        ranks += [")"] * depth

        class R:
            def __init__(self, v):
                self.v = v

            def __mul__(self, other):
                return R(max(self.v, other.v))

            def __add__(self, other):
                return R(min(self.v, other.v))

        assert licences.parse_expression(" ".join(parts).encode()).rank == eval("".join(ranks), {"R": R}).v


def test_licence_places_and_odd_rows(spark, odd):
    text = "è x\nSPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0\nUnder the MIT-License; CC BY-NC-SA! all rights reserved"
    rows = [(1, text, 5, 6), (2, None, None, None), (3, "", 5, 6), (None, text, 5, 6)]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string, score int, labels int")).collect()
    for r in (got[0], got[3]):
        assert r.labels == ["all-rights-reserved", "cc-by-nc", "cc-by-nc-sa", "gpl-2", "mit"] and r.base_labels == ["cc-by-nc", "mit"]
        assert [(e.expression, e.obligation) for e in r.expressions] == [("gpl-2 with classpath-exception-2.0", "weak-copyleft")]
        assert {p.label: text[p.start : p.end] for p in r.places}["mit"] == "Under the MIT-License"
        assert r.obligation == "reserved" and r.n_base == 2
    assert got[1].n_words == got[2].n_words == 0 and got[1].score == 0 and got[1].labels == []
    wide = licences.scan(odd)
    assert wide.count() == odd.count() and len({c.lower() for c in wide.columns}) == len(wide.columns)
    assert licences.scan(odd.limit(0)).collect() == []
    # many tags in one line of a long text
    long = spark.createDataFrame([(1, "license: x " * 100_000 + "license: MIT")], "doc_id long, text string")
    assert licences.scan(long).first().labels == ["mit"]


# --- spelling


def brute_words(rows, least_letters=5, least_n=3, one_in=97):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_letters:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= least_n}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(words, ratio=2):
    near = defaultdict(list)
    order = sorted(words)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n, form[w], root(w), len(near[w]), words.get(form[w])) for w, n in words.items())


def collected(df):
    return sorted(tuple(r[c] for c in ("word", "n", "form", "root", "n_near", "form_n")) for r in df.collect())


def test_spelling_query_against_brute_force(spark, documents):
    words = brute_words([(r.doc_id, r.text) for r in documents.collect()])
    # a quarter of the vocabulary by brute force, and all of the counts
    assert {r.word: r.n for r in spelling.word_counts(documents, slip_one_in=97).collect()} == words
    some = {w: n for w, n in words.items() if w[0] in "abcs" or n > 40}
    frame = spark.createDataFrame(list(some.items()), "word string, n long")
    assert collected(spelling.group_variants(frame)) == brute_variants(some)
    got = {r.word: r for r in queries.op12_spelling_variants(spark, SF).collect()}
    assert {w: r.n for w, r in got.items()} == words and any(r.form for r in got.values())
    for r in got.values():
        assert r.form is None or (one_apart(r.word, r.form) and r.form_n == words[r.form] >= 2 * r.n)


@pytest.mark.parametrize("block", [4096, 3])
def test_short_words_ties_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = np.random.default_rng(5)
    made = {"".join(rng.choice(list("abé"), rng.integers(0, 8))) for _ in range(260)} | {"", "a", "b", "ab"}
    words = {w: int(rng.integers(1, 6)) * 3 for w in made}
    frame = spark.createDataFrame([(w, n, 1) for w, n in words.items()], "word string, n long, form int")
    assert collected(spelling.group_variants(frame)) == brute_variants(words)


def test_long_chains_and_odd_rows(spark, odd):
    words = {"x" * 40 + "a" * k: 3 * 2 ** (12 - k) for k in range(12)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = collected(spelling.group_variants(frame))
    assert got == brute_variants(words) and {r[3] for r in got} == {"x" * 40}
    assert spelling.group_variants(frame.limit(0)).collect() == []
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert {r.word: r.n for r in spelling.word_counts(odd, least_n=1, least_letters=0, slip_one_in=97).collect()} == brute_words(rows, 0, 1)
    assert spelling.word_counts(odd.limit(0)).collect() == []


def test_counts_handed_on_early(spark, monkeypatch, odd):
    monkeypatch.setattr(spelling, "COUNTED", 5)
    assert {r.word: r.n for r in spelling.word_counts(odd, slip_one_in=0).collect()} == brute_words([(r.doc_id, r.text) for r in odd.collect()], one_in=0)


# --- hard negatives


def brute_negatives(rows, positives=5, negatives=10, low=30, high=90):
    """``rows``: (id, label, vector of whole numbers), without nulls but in ids."""
    key = lambda p: (-p[1], p[0] is None, p[0] or 0)
    width = max((len(v) for _, _, v in rows), default=0)
    padded = [list(v) + [0] * (width - len(v)) for _, _, v in rows]
    out = []
    for i, (anchor, label, _) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        scores = [sum(a * b for a, b in zip(padded[i], v, strict=True)) for v in padded]
        best = sorted(((r[0], scores[j]) for j, r in enumerate(rows) if j != i and r[1] == label), key=key)[:positives]
        others = sorted(((r[0], scores[j]) for j, r in enumerate(rows) if r[1] != label), key=key)
        for p, ps in best:
            fits = [(n, ns) for n, ns in others if low * ps <= 100 * ns <= high * ps][:negatives]
            out += [(anchor, p, k, n, ps, ns) for k, (n, ns) in enumerate(fits, 1)]
    return sorted(out, key=str)


def mined(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_rows(n, seed, labels=4, width=20, spread=60):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    own = rng.integers(0, labels, n)
    x = np.floor(spread * (centres[own] * 0.7 + rng.normal(size=(n, width)))).astype(int)
    return [(k, int(own[k]), x[k].tolist()) for k in range(n)]


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, label int, embedding array<long>, uid int, score int")


def test_negatives_query_against_brute_force(spark):
    raw = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = []
    for r in raw:
        if r.label is not None and r.embedding is not None and all(v is not None and np.isfinite(v) for v in r.embedding):
            rows.append((r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * float(v))) for v in r.embedding]))
    got = mined(queries.op13_hard_negatives(spark, SF))
    assert got and got == brute_negatives(rows)


@pytest.mark.parametrize(("sample", "group", "held"), [(2048, 16_384, 1_000_000), (40, 3, 50), (1, 1, 1)])
def test_negatives_with_few_in_the_sample(spark, monkeypatch, sample, group, held):
    for name, value in (("SAMPLE", sample), ("GROUP", group), ("HELD", held), ("ROWS", 64), ("PROBES", 2)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = random_rows(700, 11) + [(700 + k, 9, [k, 1]) for k in range(3)]
    assert mined(hard_negatives.mine(frame_of(spark, rows), F.col("vec_id") % 100 == 0)) == brute_negatives(rows)


def test_negatives_of_odd_rows(spark):
    same = [5, 5, 5]
    rows = [(k, k % 2, same) for k in range(250)] + [(100, 0, same), (100, 1, [1, 2]), (300, 7, []), (None, 1, same), (400, 1, [0, 0, 0]), (500, 0, [-5, -5, -5])]
    none = [(600, None, same), (601, 1, None), (700, 1, [1, None, 1])]
    got = mined(hard_negatives.mine(frame_of(spark, rows + none), F.col("vec_id") % 100 == 0, low=100, high=100))
    assert got == brute_negatives(rows, low=100, high=100)
    assert mined(hard_negatives.mine(frame_of(spark, rows + none), F.col("vec_id") % 100 == 0)) == brute_negatives(rows)
    assert hard_negatives.mine(frame_of(spark, rows).limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert hard_negatives.mine(frame_of(spark, rows), F.lit(False)).collect() == []
    big = [(k, k % 2, [2**40 + k, 3 - k]) for k in range(0, 210, 10)]
    assert hard_negatives.mine(frame_of(spark, big), F.col("vec_id") % 100 == 0).count() == 0


def test_large_numbers_are_exact(spark):
    rows = [(k, k % 3, [2**29 + 7 * k, 11 - k, (k * k) % 97]) for k in range(0, 260, 10)]
    assert mined(hard_negatives.mine(frame_of(spark, rows), F.col("vec_id") % 100 == 0, low=10, high=100)) == brute_negatives(rows, low=10, high=100)


def test_index_leaves_dimensions_out():
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(500, 32)) * np.linspace(200, 1, 32)).astype(int)
    q, least = x[:20], np.full(20, 400_000.0)
    norms = hard_negatives.tail_norms(q)
    index = hard_negatives.InvertedIndex(x, norms.max(axis=0), 400_000.0)
    assert len(index.order) < 500 and index.indexed.min() < index.steps
    found = {(int(r), int(a)): int(s) for r, a, s in zip(*index.probe(q, norms, least), strict=True)}
    scores = x @ q.T
    assert found == {(int(r), int(a)): int(scores[r, a]) for r, a in zip(*np.nonzero(scores >= 400_000), strict=True)}
