import hashlib
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from partlens.llm import mixing
from partlens.llm.common import WORD
from tests.llm.cases import table

SIZES = "source string, source_size long"


def by_name(source):
    return (source is None, (source or "").encode())


def reshared(sizes, shares=(5, 2, 1), most=3):
    """Targets by resharing the excess over and over, as the rule is stated."""
    order = sorted(sizes, key=by_name)
    weight = {s: shares[i % len(shares)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in order if s not in full)
        left = total - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / free for s in order}
        above = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def plain(rows, seed=mixing.SEED, most=3):
    docs, sizes = [], defaultdict(int)
    for i, text, _, source in [r[:4] for r in rows]:
        words = WORD.findall(text or "")
        told = "\n".join([seed, "" if i is None else str(i), hashlib.md5((text or "").encode()).hexdigest()])
        u = (int(hashlib.md5(told.encode()).hexdigest()[:13], 16) + 1) / 2**52
        w = 0.5 + len(set(words)) / len(words) if words else 1.5
        docs.append((source, -math.log(u) / w, i is not None, i or 0, len(words), i))
        sizes[source] += len(words)
    targets, out, left = reshared(sizes, most=most), [], {}
    for source, key, _, _, size, i in sorted(docs, key=lambda d: (by_name(d[0]), *d[1:5])):
        budget = math.floor(targets[source] + 0.5)
        epochs, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        rest = left.setdefault(source, rest)
        part = min(rest, size)
        left[source] -= part
        out.append((i, source, size, sizes[source], round(targets[source], 6), epochs, epochs * size + part))
    return sorted(out, key=str)


def got(df, **more):
    rows = [tuple(r) for r in mixing.mixed(df, **more).collect()]
    return sorted([(*r[:4], round(r[4], 6), *r[5:]) for r in rows], key=str)


def rows_by_source():
    sources = ["s", "b", "é", "", None, "B", "\U0001f600", "ﬀ"]
    return [(*r[:3], sources[k % len(sources)], *r[4:]) for k, r in enumerate(table() * 2)]


@pytest.mark.parametrize("size", [mixing.RANGE_ROWS, 4])
def test_against_plain(frame, docs, monkeypatch, size):
    monkeypatch.setattr(mixing, "RANGE_ROWS", size)
    rows = rows_by_source()
    found = got(frame(rows, docs.schema))
    assert found == plain(rows)
    assert any(0 < r[-1] - r[5] * r[2] < r[2] for r in found) and any(r[5] == 3 for r in found)
    given, target = defaultdict(int), {}
    for r in found:
        given[r[1]] += r[-1]
        target[r[1]] = r[4]
        assert 0 <= r[-1] <= 3 * r[2]
    assert all(abs(given[s] - target[s]) <= 0.5 for s in target)


def test_one_source_and_repeats(docs, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 5)
    rows = [(*r[:3], "s", *r[4:]) for r in table()]
    found = got(docs.withColumn("source", F.lit("s")))
    assert found == plain(rows)
    assert all(r[-1] == r[2] for r in found)


@pytest.mark.parametrize("seed", range(5))
def test_targets(frame, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 10**rng.randrange(9)]) for i in range(rng.choice([1, 2, 7, 40]))}
    sizes[None] = rng.randrange(50)
    want = reshared(sizes)
    found = {r.source: r.target for r in mixing.targets(frame(list(sizes.items()), SIZES)).collect()}
    assert found == pytest.approx(want)
    assert sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_nothing_to_share(frame):
    rows = mixing.mixed(frame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in rows) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_weights_decide_the_order(frame):
    rows = [(i, "w " * 10, "a" if i < 2000 else "b", 8.0 if i % 2 else 1.0) for i in range(2400)]
    df = frame(rows, "doc_id long, text string, source string, w double")
    taken = defaultdict(int)
    for r in mixing.mixed(df, F.col("w"), shares=(1, 3)).collect():
        if r.source == "a":
            taken[r.doc_id % 2] += r.taken
    # Half of the source is wanted; a key of eight times the weight is the smaller one eight times in nine.
    assert taken[1] > 1.8 * taken[0]
    # Without a weight a document comes after all that have one.
    last = mixing.mixed(df, F.when(F.col("doc_id") % 2 == 1, F.lit(1.0)), shares=(1, 3)).where("source = 'a'")
    assert {r.taken for r in last.where("doc_id % 2 = 1").collect()} == {10}


def test_runs_agree(docs):
    assert got(docs) == got(docs.repartition(7))
    several = docs.withColumn("source", F.when(F.col("doc_id") % 20 == 0, "s"))
    assert got(several, seed="other") != got(several)


def test_empty(empty):
    assert mixing.mixed(empty).collect() == []
