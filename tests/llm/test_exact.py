import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from partlens.llm import exact
from tests.llm.cases import table


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1] or ""].append(row[0])
    found = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            found.append((i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("bits", [256, 3, 0])
def test_copies_whatever_the_digest(docs, bits):
    """With few digest bits different texts share a digest; the byte check keeps them apart."""
    weak = (lambda t: F.pmod(F.xxhash64(t), F.lit(2**bits)).cast("string")) if bits < 256 else exact.sha256
    rows = exact.copies(docs, digest=weak).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=str) == expected(table())
    stays = [r for r in rows if r.kept]
    assert len(stays) == len({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in stays)


def test_without_copies_keeps_columns_and_one_row_of_a_text(docs):
    left = exact.without_copies(docs)
    assert left.columns == docs.columns
    texts = [r.text or "" for r in left.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in table()})


def test_empty(empty):
    assert exact.copies(empty).collect() == []


def test_state_goes_on_with_new_files(spark, frame, tmp_path):
    at, state = str(tmp_path / "in"), str(tmp_path / "state")
    schema = "_digest string, _id long, _file string, _row long"
    for n, rows in enumerate([[("a", 1, "f", 0), ("b", 2, "f", 1)], [("a", 5, "g", 0)], [("a", 3, "h", 0)]]):
        frame(rows, schema).write.mode("append").parquet(at)
        exact.fold(spark.readStream.schema(schema).parquet(at), state)
        found = {r._digest: (r._keep._id, r._n) for r in exact.read_state(spark, state).collect()}
        assert found["a"] == [(1, 1), (5, 2), (5, 3)][n]
        assert found["b"] == (2, 1)


def test_native(docs):
    plan = exact.copies(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
