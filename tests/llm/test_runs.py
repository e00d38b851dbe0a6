import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from partlens.llm import queries, runs
from partlens.llm.common import WORD
from tests.llm.cases import table


def plain(words, least=12):
    """Every lag of a text; of stretches alike the smallest lag."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i >= max(q, least - q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def kept(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 3)),
        min_size=1, max_size=8,
    ),
    st.sampled_from([2, 3, 5, 12, 29]),
)
def test_find_runs(parts, least):
    words = [w for root, times, more in parts for w in (root * times + root[:more])]
    assert runs.find_runs(np.array(words), least) == plain(words, least)


def fibonacci(size):
    a, b = [0], [0, 1]
    while len(b) < size:
        a, b = b, b + a
    return b[:size]


@pytest.mark.parametrize("seed", range(4))
def test_longer_texts(seed):
    rng = random.Random(seed)
    words = []
    while len(words) < 1200:
        root = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.choice([1, 2, 7, 13, 60, 200]))]
        words += root * rng.randrange(1, 6) + root[: rng.randrange(len(root))]
    assert runs.find_runs(np.array(words)) == plain(words)
    assert runs.find_runs(np.array(fibonacci(700))) == plain(fibonacci(700))
    assert runs.find_runs(np.array([0] * 500 + [1] + [0] * 400)) == plain([0] * 500 + [1] + [0] * 400)


def test_pairs_stay_few_in_one_repeated_word(monkeypatch):
    met = []
    inner = runs._pairs
    monkeypatch.setattr(runs, "_pairs", lambda *a: met.append(inner(*a)) or met[-1])
    size = 1_000_000
    assert runs.find_runs(np.zeros(size, np.int64)) == [(0, size, 1)]
    assert all(len(lags) <= 4 * size for lags, _ in met)


def test_awkward_rows(docs):
    got = sorted((tuple(r) for r in runs.collapsed(docs).collect()), key=str)
    want = []
    for row in table():
        words = WORD.findall(row[1] or "")
        found = plain(words) if len(words) < 2000 else [tuple(map(int, r)) for r in runs.find_runs(np.unique(words, return_inverse=True)[1])]
        want.append((row[0], len(words), found, " ".join(kept(words, found))))
    assert got == sorted(want, key=str)
    assert sum(len(r[2]) for r in want) > 1


def test_empty(empty):
    assert runs.collapsed(empty).collect() == [] and runs.replayed(empty).collect() == []


def test_query_against_plain(spark, tmp_path, frame):
    rng = random.Random(5)
    texts = [None, "", " ", "one"] + [" ".join(f"w{rng.randrange(rng.choice([3, 60]))}é" for _ in range(rng.randrange(160))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a " * 30), (-7, texts[9]), (8, texts[8])]
    frame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in rows:
        w = WORD.findall(text or "")
        h = 1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(len(w))]
        found = plain(w)
        top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        exponent = 1000 * top[1] // top[2] if found else None
        hashes = [hashlib.sha256(t.encode()).hexdigest() for t in (told, " ".join(kept(w, found)))]
        want.append((i, len(found), *top, exponent, *hashes))
    got = [tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
