"""Digest trees and the diff that goes down them."""

import random
from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from partlens.operators import digests
from partlens.session import workspace

SCHEMA = "k string, `a.b` long, tags array<string>, note string"


def plain(old, new):
    out = []
    for key in {r[0] for r in old + new}:
        was, now = ([repr(r) for r in side if r[0] == key] for side in (old, new))
        if Counter(was) != Counter(now):
            out.append((key, "appeared" if not was else "disappeared" if not now else "changed", len(was), len(now)))
    return sorted(out, key=str)


def kept(frame, spark, rows, bits=16):
    return digests.store(frame(rows, SCHEMA), ["k"], workspace(spark, "release"), bits, 2)


def found(old, new, seen=None):
    return sorted([tuple(r) for r in digests.changed_rows(old, new, seen).collect()], key=str)


@pytest.mark.parametrize("bits", [8, 16])
def test_against_all_rows(frame, spark, bits):
    rng = random.Random(bits)
    row = lambda k: (k, rng.choice([None, 1, 2]), rng.choice([None, [], [None, "x"], ["x", None]]), rng.choice([None, "", "n"]))
    old = [row(rng.choice([None, ""]) if rng.random() < 0.05 else f"k{rng.randrange(300)}") for _ in range(900)]
    new = [r if rng.random() < 0.9 else row(r[0]) for r in old if rng.random() < 0.97] + [row(f"new{i}") for i in range(5)]
    assert found(kept(frame, spark, old, bits), kept(frame, spark, new, bits)) == plain(old, new)


def test_repeats_and_nulls_count(frame, spark):
    twice = [("k", 1, None, "a"), ("k", 1, None, "a")]
    other = [("k", 1, None, "b"), ("k", 1, None, "b")]
    moved = [("k", 1, ["a"], None), ("k", 1, ["a"], None)]
    for old, new in [(twice, other), (twice, moved), (twice, twice[:1]), (other, [])]:
        assert found(kept(frame, spark, old), kept(frame, spark, new)) == plain(old, new) != []


def test_equal_and_empty(frame, spark):
    rows = [(f"k{i}", i, [str(i)], None) for i in range(100)]
    assert found(kept(frame, spark, rows), kept(frame, spark, rows[::-1])) == []
    assert found(kept(frame, spark, []), kept(frame, spark, [])) == []
    assert len(found(kept(frame, spark, []), kept(frame, spark, rows))) == 100


def test_only_differing_ranges_are_compared(spark):
    old = spark.range(200_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    new = old.withColumn("v", F.when(F.col("k").isin("5", "77777"), -1).otherwise(F.col("v")))
    a, b = (digests.store(r, ["k"], workspace(spark, "release")) for r in (old, new))
    seen = Observation()
    assert [r.k for r in digests.changed_rows(a, b, seen).orderBy("k").collect()] == ["5", "77777"]
    # Two leaves of 65,536, some three rows each.
    assert 4 <= seen.get["rows"] <= 100
    # Of 256 folders, the scans keep two.
    plan = digests.changed_rows(a, b)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters") >= 2 and "_folder" in plan.split("PartitionFilters")[1][:200]


def test_misuse(frame, spark):
    rows = [("k", 1, None, "a")]
    a = kept(frame, spark, rows)
    with pytest.raises(ValueError):
        digests.changed_rows(a, kept(frame, spark, rows, 8))
    with pytest.raises(ValueError):
        digests.changed_rows(a, digests.store(frame(rows, SCHEMA).withColumn("x", F.lit(1)), ["k"], workspace(spark, "r")))
    with pytest.raises(ValueError):
        digests.with_slots(frame(rows, SCHEMA).withColumn("_SLOT", F.lit(1)), ["k"])
    with pytest.raises(ValueError):
        digests.with_slots(frame(rows, SCHEMA), ["k"], 30)
