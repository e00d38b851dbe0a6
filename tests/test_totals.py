"""Totals per window against every pair, and how stripes spread."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partlens.operators import spatial, totals
from partlens.plans import windows as plans
from tests.test_scale import boxes

SIDES = ("xmin", "ymin", "xmax", "ymax")


def table(spark, rows, number, box):
    df = spark.createDataFrame([(i, *b) for i, b in enumerate(rows)], f"{number} long, " + ", ".join(f"{s} double" for s in SIDES))
    return df.select(number, F.struct(*SIDES).alias(box))


def compare(spark, features, windows, value=lambda i: i):
    f = table(spark, features, "id", "bbox").withColumn("id", F.element_at(F.array(*(F.lit(value(i)) for i in range(len(features)))), F.col("id").cast("int") + 1))
    got = totals.overlap_totals(f, table(spark, windows, "w", "window_bbox"), "id")
    assert got.columns == ["w", "window_bbox", "n", "total"]
    want = {}
    for j, b in enumerate(windows):
        met = [value(i) for i, a in enumerate(features) if None not in (*a, *b) and a[0] < b[2] and a[2] > b[0] and a[1] < b[3] and a[3] > b[1]]
        if met:
            want[j] = len(met), sum(met)
    assert {r["w"]: (r["n"], r["total"]) for r in got.collect()} == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(boxes(), boxes())
def test_totals_of_any_boxes_equal_every_pair(spark, features, windows):
    compare(spark, [*features, (None, 0.0, 1.0, 1.0)], [*windows, (0.0, 0.0, None, 1.0)])


@pytest.mark.parametrize("shared", [0.0, 0.5, 1.0])
def test_totals_over_many_stripes(spark, monkeypatch, shared):
    """Coordinates on a coarse lattice touch and repeat; a share of the features starts at one x, and windows at one y."""
    monkeypatch.setattr(totals, "ROOTS", 1)
    monkeypatch.setattr(totals, "BLOCK_ROWS", 5)
    rng = random.Random(7)

    def some(fixed, least):
        x, y = (3.0 if fixed == 0 and rng.random() < shared else rng.randrange(12)), (5.0 if fixed == 1 and rng.random() < shared else rng.randrange(12))
        return float(x), float(y), x + float(rng.choice([least, 1, 2, 9])), y + float(rng.choice([least, 1, 2, 9]))

    compare(spark, [some(0, 0) for _ in range(150)], [some(1, 1) for _ in range(60)])
    compare(spark, [some(0, 0)] * 100, [some(1, 1) for _ in range(20)] * 2)


def test_totals_near_the_end_of_a_long(spark):
    """The sum over all features leaves a long, that of each window does not."""
    features = [(float(i), 0.0, i + 1.0, 1.0) for i in range(6)]
    compare(spark, features, [(i + 0.25, 0.0, i + 0.5, 1.0) for i in range(6)], lambda i: (-1) ** (i // 4) * (2**62 + i))


def test_counting_queries_list_no_pairs(data, monkeypatch):
    def listed(*_, **__):
        raise AssertionError("pairs are listed")

    monkeypatch.setattr(spatial, "overlap_join", listed)
    monkeypatch.setattr(totals, "overlap_join", listed)
    for query in (plans.mixed_extents, plans.many_windows):
        assert query(data).count() > 0
