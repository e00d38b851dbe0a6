import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from partlens.llm import quality
from tests.conftest import DATA


def test_descent_reaches_the_optimum():
    """The dual solution against sub-gradient optimality of the primal, on a small problem."""
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(40, 8, replace=False)).astype(np.int32) for _ in range(60)]
    values = [rng.normal(size=8) for _ in rows]
    signs = np.where(np.arange(60) % 3 == 0, 1.0, -1.0)
    weights, bias = quality.descend(rows, values, signs, np.full(60, 0.5), rounds=3000)

    def loss(w, b):
        hinge = sum(max(0.0, 1 - s * (w[r] @ v + b)) for r, v, s in zip(rows, values, signs))
        return 0.5 * (w @ w + b * b) + 0.5 * hinge

    best = loss(weights, bias)
    for _ in range(300):
        step = np.zeros_like(weights)
        step[:40] = rng.normal(size=40) * 10 ** rng.uniform(-4, 0)
        assert loss(weights + step, bias + rng.normal() * 1e-3) >= best - 2e-3


def test_held_out_accuracy(spark):
    folder = DATA.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality.scored(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.05


def test_split_and_awkward_rows(docs, frame):
    labels = frame([(0, 1, "x"), (0, 1, "x"), (30, 0, "x"), (40, 0, "x"), (40, 1, "x"), (None, 1, "x"), (60, None, "x")], "doc_id long, quality int, text string")
    got = quality.scored(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 3 == 1)
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.5)
    texts = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    by_text = {}
    for r in got:
        if texts[r.doc_id] is not None and r.doc_id != 30:
            assert by_text.setdefault(texts[r.doc_id], r.score) == r.score


def test_conflicting_and_held_out_labels_are_not_learnt(docs, frame):
    labels = frame([(i, q) for i in range(0, 260, 10) for q in ([0, 1] if i == 50 else [i % 20 // 10])], "doc_id long, quality int")
    chosen = {r[0] for r in quality.sample(docs, labels, "doc_id", "quality", 3, 1, 1000).collect()}
    assert chosen == {i for i in range(0, 260, 10) if i != 50 and zlib.crc32(str(i).encode()) % 3 != 1}
    assert quality.sample(docs, labels, "doc_id", "quality", 3, 1, 5).count() == 5


def test_no_labels_and_no_rows(docs, empty, frame):
    none = frame([], "doc_id long, quality int")
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}
    assert quality.scored(empty, none).collect() == []
    only_good = frame([(0, 1)], "doc_id long, quality int")
    assert quality.scored(docs, only_good).where(F.col("score").isNull()).count() == 0


def plain_features(text):
    """Indicators one n-gram at a time, in whole numbers."""
    full, odd = 2**64 - 1, [int(x) for x in quality.ODD]
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    if not words:
        return []
    look = [xxhash.xxh64_intdigest(quality.shape(w)) for w in words]
    own = [xxhash.xxh64_intdigest(w.lower()) for w in words]
    marks = []
    for width in (1, 2, 8):
        if len(own) >= 2 * width:
            seen = [tuple(own[i : i + width]) for i in range(len(own) - width + 1)]
            share, size = len(set(seen)) / len(seen), min(5, int(math.log10(len(seen)) * 2))
            marks += [1000 * width + 20 * size + tenth for tenth in range(1, 11) if share < tenth / 10] + [1000 * width + 200 + size]
    marks.append(101 if any(a == b for a, b in zip(own, own[1:])) else 100)
    grams = [a * odd[0] for a in look] + [a * odd[1] for a in own] + [m * odd[0] for m in marks]
    grams += [((a * odd[1] + b) & full) * odd[2] for a, b in zip(look, look[1:])]
    grams += [(((a * odd[1] + b) & full) * odd[0] + c) * odd[1] for a, b, c in zip(look, look[1:], look[2:])]
    mixed = [g & full for g in grams]
    return sorted({((g ^ g >> 32) * odd[1] & full) >> 64 - quality.FEATURE_BITS for g in mixed})


def test_whole_scores_against_a_plain_version(frame):
    rng = random.Random(5)
    words = ["Law", "law", "of", "2,019", "...", "!!!!!!", "É", "http://a.b/c?d=1&e=2#f-g-h-i-j-k", "http://a.b/c?d=1&e=2#f-g-h-i-j-l/0"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 17, 60]))) for _ in range(90)]
    quality_of = {i: int("law" in t) for i, t in enumerate(texts) if i % 4}
    got = quality.scored(frame(list(enumerate(texts)), "doc_id long, text string"), frame(list(quality_of.items()), "doc_id long, quality int"))
    learnt = sorted((i, y) for i, y in quality_of.items() if zlib.crc32(str(i).encode()) % 3 != 1)
    rows = [np.array(plain_features(texts[i]), np.int32) for i, _ in learnt]
    ratio, weights, bias = quality.fit(rows, np.array([y for _, y in learnt]))
    found = {r.doc_id: (r.held_out, r.score, r.predicted) for r in got.collect()}
    assert len(found) == 90
    for i, text in enumerate(texts):
        own = plain_features(text)
        length = math.sqrt(sum(ratio[f] ** 2 for f in own))
        margin = bias + sum(weights[f] * ratio[f] / length for f in own if length)
        score = 1 / (1 + math.exp(-2 * margin))
        assert found[i][0] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert math.isclose(found[i][1], score, rel_tol=1e-9) and found[i][2] == int(score >= 0.5)


def test_the_whole_shape_counts():
    a, b = (b"a.b/c?d=1&e=2#f-g-h-i" + end for end in (b"!", b"?"))
    assert quality.shape(a) != quality.shape(b)


@pytest.mark.parametrize("repeats, most", [(300, 10), (300, 300), (1, 10)])
def test_rows_of_one_identifier_stay_within_the_bound(frame, monkeypatch, repeats, most):
    rows = [(2, f"good text {i}") for i in range(repeats)] + [(2, "the same")] * repeats + [(3, "bad bad bad")]
    labels = frame([(2, 1), (3, 0)], "doc_id long, quality int")
    seen, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, signs: seen.append(len(rows)) or fit(rows, signs))
    got = quality.scored(frame(rows, "doc_id long, text string"), labels, folds=1, held=1, most_rows=most)
    assert got.count() == 2 * repeats + 1
    assert seen == [min(most, repeats + 2)]
