"""Versions of published documents, and lines of files read in splits."""

import os
import random

import pytest
from pyspark.sql import functions as F

from partlens.operators import blocks
from partlens.session import workspace
from partlens.sources import lines, published


def docs(frame, found):
    rows = frame(list(found.items()), "key string, body string")
    return rows.select("key", F.struct("key", "body").alias("doc"))


def put(frame, path, found):
    return published.publish(docs(frame, found), "doc", "key", path)


def held(spark, path, version=None):
    return {r.key: r.json for r in published.published(spark, path, version).collect()}


def tree(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path.removeprefix("file:")) for f in names)


def as_json(found):
    return {k: f'{{"key":"{k}"' + (f',"body":"{v}"' if v is not None else "") + "}" for k, v in found.items()}


def test_only_changes_are_written(frame, spark):
    path = workspace(spark, "published")
    first = {f"d{i}": f"text {i}" for i in range(50)}
    assert held(spark, path) == {} and put(frame, path, first) == 1
    files = tree(path)
    assert put(frame, path, dict(reversed(first.items()))) == 1
    # An unchanged input writes nothing, not even an empty file.
    assert tree(path) == files

    second = {k: v for k, v in first.items() if k != "d7"} | {"d3": None, "new": "n"}
    assert put(frame, path, second) == 2
    written = [r.key for r in spark.read.parquet(f"{path}/documents").where(~F.col("run").isin(runs(spark, path, 1))).collect()]
    assert sorted(written) == ["d3", "new"]
    assert held(spark, path) == as_json(second) and held(spark, path, 1) == as_json(first)
    assert {tuple(r) for r in published.changes(spark, path, 1, 2).collect()} == {("d7", "disappeared"), ("d3", "changed"), ("new", "appeared")}

    # Going back writes again only what the last version lost.
    assert put(frame, path, first) == 3 and held(spark, path) == as_json(first)
    # Nothing but losses writes a manifest and no documents.
    before = [f for f in tree(path) if "/documents/" in f]
    assert put(frame, path, {"d1": "text 1"}) == 4 and held(spark, path) == as_json({"d1": "text 1"})
    assert [f for f in tree(path) if "/documents/" in f] == before
    assert put(frame, path, {}) == 5 and held(spark, path) == {} and put(frame, path, {}) == 5


def runs(spark, path, version):
    return [r.run for r in published._manifest(spark, path, version).select("run").distinct().collect()]


def test_keys_have_one_place(frame, spark):
    path = workspace(spark, "published")
    for rows in ([("a", "1"), ("a", "1")], [("a", "1"), ("a", "2")], [(None, "1")]):
        df = frame(rows, "key string, body string").select("key", F.struct("body").alias("doc"))
        with pytest.raises(ValueError, match="one place"):
            published.publish(df, "doc", "key", path)
    assert published.versions(spark, path) == []
    with pytest.raises(ValueError):
        published.published(spark, path, 1)


def test_a_job_that_died_and_one_that_came_late(frame, spark, monkeypatch):
    path = workspace(spark, "published")
    put(frame, path, {"a": "1"})
    commit = published._commit

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(published, "_commit", dies)
    with pytest.raises(KeyboardInterrupt):
        put(frame, path, {"a": "2", "b": "2"})
    assert held(spark, path) == as_json({"a": "1"})

    def late(session, at, version, run):
        monkeypatch.setattr(published, "_commit", commit)
        assert put(frame, path, {"a": "3"}) == version
        commit(session, at, version, run)

    monkeypatch.setattr(published, "_commit", late)
    with pytest.raises(published.Conflict):
        put(frame, path, {"a": "4"})
    assert held(spark, path) == as_json({"a": "3"})
    assert put(frame, path, {"a": "4"}) == 3 and held(spark, path) == as_json({"a": "4"})


@pytest.mark.parametrize("across", [False, True])
def test_lines_of_split_files(spark, tmp_path, across):
    rng = random.Random(3)
    words = ["```", "```sql", "", "select 1", "  ```", "\r", "a" * 300, "é x"]
    texts = ["\n".join(rng.choice(words) for _ in range(n)) for n in (4000, 1, 700, 0, 2500)]
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.md").write_text(text, newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = lines.numbered_lines(spark, str(tmp_path), across)
        # The large file is many tasks.
        assert got.rdd.getNumPartitions() > 20
        rows = got.withColumn("file_id", F.substring_index("file_id", "/", -1)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want, above = [], 0
    for i, text in enumerate(texts):
        # No line follows the last line feed.
        own = text.split("\n")[: -1 if text.endswith("\n") or not text else None]
        want += [(f"f{i}.md", above + n, line) for n, line in enumerate(own, 1)]
        above += len(own) if across else 0
    assert sorted(map(tuple, rows)) == sorted(want)
    if not across:
        found = spark.createDataFrame(rows, "file_id string, line_no long, text string")
        whole = spark.createDataFrame([(f"f{i}.md", t) for i, t in enumerate(texts)], "file_id string, text string")
        blocks_of = lambda df: sorted(map(tuple, blocks.fenced_blocks(df, block_rows=64).collect()))
        assert blocks_of(found) == blocks_of(blocks.lines_of(whole)) != []


def test_no_files(spark, tmp_path):
    (tmp_path / "empty.md").write_text("")
    assert lines.numbered_lines(spark, str(tmp_path)).collect() == []
