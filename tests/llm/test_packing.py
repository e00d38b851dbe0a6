import itertools
from collections import defaultdict

import numpy as np
import pytest

from partlens.llm import packing
from partlens.llm.common import WORD
from tests.llm.cases import table


def padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(200, 11, replace=False))
    counts = rng.integers(1, 50, 11)
    for buckets in (1, 2, 3, 4, 20):
        ends = packing.boundaries(lengths, counts, buckets)
        assert len(ends) <= buckets and ends[-1] == lengths[-1] and ends == sorted(ends)
        least = min(
            padding(lengths, counts, [*some, lengths[-1]]) for n in range(min(buckets, 11)) for some in itertools.combinations(lengths[:-1], n)
        )
        assert padding(lengths, counts, ends) == least
    assert packing.boundaries(np.array([]), np.array([]), 3) == []


@pytest.mark.parametrize("stretch", [100_000, 3])
def test_batches(docs, monkeypatch, stretch):
    monkeypatch.setattr(packing, "STRETCH_ROWS", stretch)
    rows = packing.batches(docs, most_length=100, buckets=4, budget=300).collect()
    spans = defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.start, r.length))
        assert r.length <= r.padded <= 100 and r.start == 100 * r.piece
    want = defaultdict(list)
    for row in table():
        n = len(WORD.findall(row[1] or ""))
        want[row[0]] += [(s, min(100, n - s)) for s in range(0, max(n, 1), 100)]
    assert {k: sorted(v) for k, v in spans.items()} == {k: sorted(v) for k, v in want.items()}
    groups, sizes = defaultdict(list), defaultdict(set)
    for r in rows:
        groups[r.bucket, r.batch].append(r.slot)
        sizes[r.bucket].add(r.padded)
    assert len(sizes) == 4 and all(len(s) == 1 for s in sizes.values())
    for (bucket, batch), slots in groups.items():
        capacity = 300 // max(sizes[bucket])
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= capacity
        assert len(slots) == capacity or batch == max(b for k, b in groups if k == bucket)


def test_empty(empty):
    assert packing.batches(empty).collect() == []


def test_content_of_pieces(docs):
    rows = packing.batches(docs, most_length=100, buckets=4, budget=300, content=True)
    places = sorted(map(str, packing.batches(docs, most_length=100, buckets=4, budget=300).select("doc_id", "piece", "start", "length", "bucket", "padded").collect()))
    assert sorted(map(str, rows.select("doc_id", "piece", "start", "length", "bucket", "padded").collect())) == places
    want = sorted((str(r[0]), s // 100, " ".join(w[s : s + 100])) for r in table() for w in [WORD.findall(r[1] or "")] for s in range(0, max(len(w), 1), 100))
    assert sorted((str(r.doc_id), r.piece, r.content) for r in rows.collect()) == want


def test_lengths_need_a_bound(frame):
    with pytest.raises(ValueError, match="cut items"):
        packing.packed(frame([(1, 10**9)], "id long, length long"), ["id"])
