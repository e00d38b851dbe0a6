import math
import zlib
from collections import Counter

import numpy as np
import pytest

from partlens.llm import scoring
from partlens.llm.common import WORD
from tests.conftest import DATA
from tests.llm.cases import table


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lower), None]


def plain(rows, folds=10):
    """Counts in one dictionary; the word pairs' part as the formula has it, with exact counts."""
    held = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % folds == 0
    train = [tokens(t) for i, t in rows if not held(i)]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["start", *t], t))
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        t = tokens(t)
        alone = [(count[w] + 0.1) / (n + 0.1 * (v + 1)) for w in t]
        both = []
        for k, (h, w) in enumerate(zip(["start", *t], t)):
            before = count[h] if k else len(train)
            seen = pairs[h if k else "start", w]
            seen = scoring.VALUES[int(math.log2(seen)) + 1] if seen else 0.0
            both.append((min(seen, before, count[w]) + scoring.PRIOR * alone[k]) / (before + scoring.PRIOR))
        out.append((i, held(i), len(t), sum(count[w] > 0 for w in t), n, sum(map(math.log10, alone)), sum(map(math.log10, both))))
    return sorted(out, key=lambda r: str(r[:5]) + f"{r[5]:.6f}")


def same(got, want):
    got = sorted([tuple(r) for r in got], key=lambda r: str(r[:5]) + f"{r[5]:.6f}")
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10)
    # A filter may take unseen pairs for seen ones, now and then.
    assert np.mean(np.isclose([g[6] for g in got], [w[6] for w in want], rtol=1e-9)) > 0.7
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=0.02)


@pytest.mark.parametrize("block, segment", [(10_000_000, 1_000_000), (3_000, 8)])
def test_against_exact_counts(docs, monkeypatch, block, segment):
    monkeypatch.setattr(scoring, "BLOCK_CHARS", block)
    monkeypatch.setattr(scoring, "SEGMENT_KEYS", segment)
    monkeypatch.setattr(scoring, "PACKED_TOKENS", segment * 50)
    same(scoring.scores(docs).collect(), plain([(r[0], r[1]) for r in table()]))


def test_held_out_text_is_likelier_than_by_words_alone(spark):
    rows = scoring.scores(spark.read.parquet(f"{DATA.replace('sf0.001', 'sf0.01')}/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(r.score < 0 and r.n_known <= r.n_tokens for r in rows)


def test_filter_never_undercounts():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    counts = rng.integers(1, 300, len(keys))
    bits = np.zeros((1 << 20) // 8, np.uint8)
    region = np.uint64((1 << 20) // scoring.REGIONS)
    level = scoring.level_of(counts)
    for k in range(1, int(level.max()) + 1):
        own = keys[level >= k]
        for at in scoring.Filter.places(own, k, region):
            at = at + (own >> np.uint64(56)) * region
            np.bitwise_or.at(bits, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))
    held = scoring.Filter(bits)
    assert (held.levels(keys) >= level).all() and np.mean(held.levels(keys) == level) > 0.98
    others = rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    assert np.mean(held.levels(others) > 0) < 0.02


@pytest.mark.parametrize("steps", [[0], [0, 255, 1], [0, 1 << 40, 3], [0, (1 << 63) + 5]])
def test_steps_round_trip(steps):
    assert scoring.widen(scoring.narrow(np.array(steps, np.uint64))).tolist() == steps


def test_empty_and_no_training_texts(empty, frame):
    assert scoring.scores(empty).collect() == []
    only = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = scoring.scores(frame([(only, "a b")], "doc_id long, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert math.isclose(row.base_score, 0.0, abs_tol=1e-12)
