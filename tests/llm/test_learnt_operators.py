"""The learnt operators against brute force on small tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from widelathe.llm import quality, toxicity

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(17)
    vocabulary = [f"{rng.choice('abcdef')}{rng.choice('rstuv')}{k}ing" for k in range(120)]
    data, known = [], []
    for k in range(240):
        toxic = k % 4 == 0
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if toxic:
            at = rng.randint(0, len(text))
            text[at:at] = [rng.choice(("Vile", "foulest", "fouler", "rotten")) for _ in range(6)]
        elif k % 7 == 0:
            text += ["rotten", "foulest"]
        data.append((k, " ".join(text)))
        if k % 5:
            known.append((k, int(toxic), int(len(text) > 30)))
    data += [(500, None), (501, ""), (3, data[3][1])]  # a repeated row
    docs = spark.createDataFrame(data, "doc_id long, text string")
    return docs, spark.createDataFrame(known, "doc_id long, toxic int, quality int"), data, known


def brute_model(data, known, target, prior=0.1, weak=2.5, least=-1.0, without=None):
    """Counts, log-odds and scores of words and stems, by the definition; nothing is learnt from the row numbered ``without``."""
    label = {k: row[target] for k, *row in known if not held(k)}
    n, n1, n0 = Counter(), Counter(), Counter()
    for at, (k, text) in enumerate(data):
        for w in words(text):
            for key in (w, *(w.encode()[:s].decode() + "*" for s in toxicity.STEMS if len(w.encode()) >= s)):
                n[key] += 1
                if k in label and at != without:
                    (n1 if label[k] else n0)[key] += 1
    total = [sum(c for w, c in part.items() if not w.endswith("*")) for part in (n, n1, n0)]
    scores = {}
    for w in n:
        if not n1[w] + n0[w]:
            continue
        a1, a0 = (n[w] / total[0] * prior * (t + 1) for t in total[1:])
        side = [math.log((c + a) / (t + prior * (t + 1) - c - a)) for c, a, t in ((n1[w], a1, total[1]), (n0[w], a0, total[2]))]
        odds = side[0] - side[1]
        z = odds / math.sqrt(1 / (n1[w] + a1) + 1 / (n0[w] + a0))
        s = max(least, min(8.0, odds * z**4 / (z**4 + weak**4)))
        scores[w] = (s, abs(z))
    return scores, label


def test_scores_lambda_k_and_probability(spark, tables):
    docs, labels, data, known = tables
    model = toxicity.fit(docs, labels)
    scores, label = brute_model(data, known, 0)
    got = {w.decode(): v for w, v in model.scores.items()}
    assert set(got) >= {w for w, (s, _) in scores.items() if abs(s) > 0.051}
    assert all(abs(got[w][0] - scores[w][0]) < 0.0501 and got[w][1] == pytest.approx(scores[w][1]) for w in got)
    # neutral and negative words have scores of their own
    assert min(s for s, _ in got.values()) < 0 < max(s for s, _ in got.values())

    def word_score(w, got=got):
        raw = w.encode()
        found = [got[k] for k in (w, *(raw[:n].decode() + "*" for n in toxicity.STEMS if len(raw) >= n)) if k in got]
        return (max(found, key=lambda f: f[1])[0] if found else 0.0) - 0.6

    # segments of a text are judged by what the other texts teach
    clean = []
    for at, (k, text) in enumerate(data):
        if label.get(k) == 0:
            others = {w: (round(s, 1), z) for w, (s, z) in brute_model(data, known, 0, without=at)[0].items() if round(s, 1)}
            clean.append([round(word_score(w, others), 1) for w in words(text)])
    values = Counter(s for text in clean for s in text)
    tokens = sum(values.values())
    assert sum(c * math.exp(model.lam * s) for s, c in values.items()) / tokens == pytest.approx(1, abs=2e-3)
    high = sum(s >= 4.0 for text in clean for _, _, s in toxicity.segments(text))
    assert model.k == pytest.approx((high + 0.5) / tokens * math.exp(model.lam * 4.0), rel=1e-3)

    base, slope, jump = model.curve
    assert slope >= 0 and jump >= 0
    out = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for k, text in data:
        own = [word_score(w) for w in words(text)]
        chance = math.log(max(model.k * len(own), 1e-9)) if own else 0.0
        excess = sum(max(0.0, model.lam * s - chance) for _, _, s in toxicity.segments(own))
        z = base + (jump + slope * math.log1p(excess) if excess > 0 else 0.0)
        assert out[k]["score"] == pytest.approx(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), abs=1e-6)
        assert out[k]["predicted"] == int(out[k]["score"] >= 0.7)
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_normal_equations_and_calibration(spark, tables):
    docs, labels, data, known = tables
    model = quality.fit(docs, labels, features=32)
    label = {k: row[1] for k, *row in known if not held(k)}
    rows = [(quality.statistics(t.encode() if t is not None else None), float(label[k])) for k, t in data if k in label]
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0))
    # which rows fit and which calibrate is told by the same hash
    hashed = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "k int, x array<double>").selectExpr("k", "pmod(xxhash64(x), 10) < 7 AS fitted").collect()
    fitted = np.array([r["fitted"] for r in sorted(hashed)])
    f = model.features(x[fitted])
    penalty = np.eye(33)
    penalty[-1, -1] = 1e-6
    assert np.allclose(model.beta, np.linalg.solve(f.T @ f + penalty, f.T @ y[fitted]), atol=1e-6)
    raw = np.round(np.clip(model.raw(x[~fitted]), -1, 2) * 333)
    bins = sorted(set(raw))
    steps = quality.isotonic(*(np.array(c, dtype=float) for c in zip(*[(b / 333, y[~fitted][raw == b].sum(), (raw == b).sum()) for b in bins], strict=True)))
    assert all(np.allclose(a, b) for a, b in zip(model.steps, steps, strict=True))
    out = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    own = model.features(np.array([quality.statistics(t.encode() if t else None) for _, t in data])) @ model.beta
    for (k, _), s in zip(data, np.interp(own, *steps), strict=True):
        assert out[k] == pytest.approx(s)
    assert out[500] == out[501]
    assert quality.score(docs.limit(0), model).count() == 0


def test_a_curve_never_falls():
    x, n1, n0 = np.array([0.0, 1.0, 2.0]), np.array([1.0, 9.0, 5.0]), np.array([9.0, 1.0, 5.0])
    base, slope, jump = toxicity._curve(x, n1, n0)
    assert slope == 0 and jump > 0
    # the base is that of the terms which are left
    assert 1 / (1 + math.exp(-base)) == pytest.approx(0.1, abs=0.01) and 1 / (1 + math.exp(-base - jump)) == pytest.approx(0.7, abs=0.02)
