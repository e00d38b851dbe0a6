import numpy as np
import pytest
from pyspark.sql import functions as F

from partlens.llm import nearest
from tests.conftest import DATA


def plain(rows, asked, k=5):
    """Every query against every row."""
    usable = {}
    for i, v in rows:
        x = np.array(v if v is not None else [], np.float64)
        if i is not None and x.size and np.isfinite(x).all() and x.any():
            usable.setdefault(i, x)
    want = {}
    for q, x in usable.items():
        if asked(q):
            near = [(-(x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())), i) for i, y in usable.items() if i != q and len(y) == len(x)]
            want[q] = sorted(near)[:k]
    return want


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall(spark):
    table = spark.read.parquet(f"{DATA.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    want = plain([(r.vec_id, r.embedding) for r in table.collect()], lambda i: i % 50 == 0)
    got = found(nearest.nearest(table, F.col("vec_id") % 50 == 0))
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        assert len(got[q]) == 5
        scores = dict((i, s) for s, i in near)
        hits += sum(i in scores for _, i in got[q])
        for s, i in got[q]:
            assert i not in scores or abs(s - scores[i]) < 1e-12
    assert hits / (5 * len(want)) >= 0.9


@pytest.mark.parametrize("slice_rows, width", [(1024, 500.0), (5, 500.0), (5, 0.001)])
def test_awkward_rows(frame, monkeypatch, slice_rows, width):
    """With very wide buckets a query visits all rows; with very narrow ones it falls back to them."""
    monkeypatch.setattr(nearest, "SLICE_ROWS", slice_rows)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(12)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(20)] + [(140, [2.0, 4.0, 6.0, 8.0]), (150, [1.0, 2.0, 3.0, 4.0])]
    rows += [(200, None), (250, []), (300, [0.0] * 4), (350, [1.0, None, 0.0, 0.0]), (400, [1.0, float("nan"), 0.0, 0.0]), (450, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(500, [1.0, 2.0]), (501, [2.0, 1.0]), (550, [1.0, 1.0, 1.0]), (None, [1.0, 2.0, 3.0, 4.0]), rows[0], rows[13]]
    table = frame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, _id string, score int")
    got = found(nearest.nearest(table, F.col("vec_id") % 10 == 0, width=width, probes=3))
    want = {q: near for q, near in plain(rows, lambda i: i % 10 == 0).items() if near}
    assert set(got) == set(want)
    for q in want:
        if width < 1 and q % 50 == 0 and 100 <= q <= 150:
            continue  # its copies alone are enough rows, so it does not fall back
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], atol=1e-15)


def test_probes_come_in_order_of_estimated_success():
    place = np.array([0.1, 3.45, -2.8])
    steps = nearest.perturbations(place, 27)
    assert len({tuple(s) for s in steps}) == len(steps) == 27
    inside = place - np.floor(place)
    cost = [sum({-1: f, 1: 1 - f, 0: 0}[s] ** 2 for f, s in zip(inside, row)) for row in steps.tolist()]
    assert cost == sorted(cost) and cost[0] == 0


def test_empty(frame):
    assert nearest.nearest(frame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect() == []
