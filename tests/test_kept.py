"""Profiles kept by part against the profile of the whole."""

import random

import pytest
from pyspark.sql import functions as F

from partlens.operators import kept, profile, spatial
from partlens.session import workspace

SCHEMA = "part string, kind string, code string, depth int, big long, flag boolean, none string"
WHOLE = spatial.Scope(True, ())


def made(frame, names, seed=0, codes=60):
    rng = random.Random(seed)
    rows = []
    for name in names:
        for _ in range(rng.randrange(40, 80)):
            kind = rng.choice([None, "a", "b", "c", "d"])
            rows.append((name, kind, f"c{rng.randrange(codes)}", rng.choice([None, 1, 2, 3, 4]), 2**53 + rng.randrange(3), True, None))
    return frame(rows, SCHEMA)


class Reader:
    """Reads parts out of one table and remembers which."""

    def __init__(self, table):
        self.table, self.asked = table, []

    def __call__(self, names):
        self.asked.append(list(names))
        return self.table.where(F.col("part").isin(*names))


def parts_of(frame, marks):
    return frame(list(marks.items()), "part string, fingerprint string")


def sorted_rows(df, *without):
    return sorted((tuple(r) for r in df.drop(*without).collect()), key=repr)


def same(got, table):
    want = profile.profile(table.drop("part"), WHOLE)
    for stage in ("counts", "screened", "measured", "chosen", "values"):
        left, right = getattr(got, stage), getattr(want, stage)
        assert left.columns == right.columns
        assert sorted_rows(left, "distinct_sketch") == sorted_rows(right, "distinct_sketch"), stage


def new_store(spark, table):
    return kept.Store(spark, workspace(spark, "kept"), profile.column_kinds(table.drop("part")))


def test_a_release_with_one_changed_part_reads_one(frame, spark):
    first = made(frame, ["p0", "p1", "p2", "p3"])
    store, read = new_store(spark, first), Reader(first)
    marks = {f"p{i}": "1" for i in range(4)}
    same(kept.kept_profile(store, parts_of(frame, marks), read), first)
    assert read.asked[0] == ["p0", "p1", "p2", "p3"]

    second = first.where("part not in ('p1', 'p3')").unionByName(made(frame, ["p1", "p4"], 9, codes=3))
    marks = {"p0": "1", "p1": "2", "p2": "1", "p4": "1"}
    read = Reader(second)
    got = kept.kept_profile(store, parts_of(frame, marks), read)
    # p1 changed, p4 is new, p3 is gone.
    assert read.asked[0] == ["p1", "p4"]
    same(got, second)

    # The same release again counts nothing, and equals one counted from the start.
    read = Reader(second)
    assert kept.update(store, parts_of(frame, marks), read) == [] and read.asked == []
    anew = new_store(spark, second)
    kept.update(anew, parts_of(frame, marks), Reader(second))
    (a, x), (b, y) = (kept.merged(s, parts_of(frame, marks)) for s in (store, anew))
    assert a == b and sorted_rows(x) == sorted_rows(y)
    # A release taken back finds the facts it left.
    back = parts_of(frame, {f"p{i}": "1" for i in range(4)})
    assert kept.update(store, back, read) == []


def test_jobs_that_died_or_met(frame, spark):
    table = made(frame, ["p0", "p1"])
    store, parts = new_store(spark, table), parts_of(frame, {"p0": "1", "p1": "1"})
    # Values without facts, as of a job that died in between.
    stray = frame([("p0", "1", "0", "kind", "text", "a", None, 1000)], kept.VALUES)
    stray.write.parquet(f"{store.path}/values")
    kept.update(store, parts, Reader(table))
    same(kept.kept_profile(store, parts, Reader(table)), table)
    # A second job that kept the same parts meanwhile.
    for name, columns in (("facts", store.facts), ("values", store.values.where("run <> '0'"))):
        again = spark.createDataFrame(
            columns.withColumn("run", F.concat(F.lit("z"), "run")).collect(), columns.schema
        )
        again.write.mode("append").parquet(f"{store.path}/{name}")
    same(kept.kept_profile(store, parts, Reader(table)), table)


def test_empty_and_missing(frame, spark):
    table = made(frame, ["p0"])
    store = new_store(spark, table)
    parts = parts_of(frame, {"p0": "1", "empty": "1"})
    with pytest.raises(ValueError, match="update"):
        kept.merged(store, parts)
    assert kept.update(store, parts, Reader(table)) == ["empty", "p0"]
    assert kept.update(store, parts, Reader(table)) == []
    same(kept.kept_profile(store, parts, Reader(table)), table)
    seen, counts = kept.merged(store, parts_of(frame, {"empty": "1"}))
    assert seen.rows == 0 and seen.few == store.columns and counts.isEmpty()


def test_files(frame, spark):
    folder = workspace(spark, "files")
    made(frame, ["p0", "p1"]).write.partitionBy("part").parquet(folder)
    read, parts = kept.read_files(spark), kept.file_parts(spark, folder)
    files = sorted(r.part for r in parts.collect())
    rows = read(files)
    assert sorted(r.part for r in rows.select("part").distinct().collect()) == files
    store = kept.Store(spark, workspace(spark, "kept"), profile.column_kinds(rows.drop("part")))
    same(kept.kept_profile(store, parts, read), rows)
    made(frame, ["p2"], 4).drop("part").coalesce(1).write.parquet(f"{folder}/part=p2")
    later = kept.update(store, kept.file_parts(spark, folder), read)
    assert len(later) == 1 and "part=p2" in later[0]
