import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from partlens.llm import substrings
from partlens.llm.common import WORD
from tests.llm.cases import table


def plain(rows, least):
    """Every window of every text in one dictionary."""
    first = {}
    for i, text in rows:
        w = WORD.findall(text or "")
        for s in range(len(w) - least + 1) if i is not None else ():
            k = tuple(w[s : s + least])
            first[k] = min(i, first.get(k, i))
    found = []
    for i, text in rows:
        w = WORD.findall(text or "")
        gone = set()
        for s in range(len(w) - least + 1) if i is not None else ():
            if first[tuple(w[s : s + least])] < i:
                gone.update(range(s, s + least))
        found.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(found, key=str)


def got(df, **more):
    return sorted([tuple(r)[:4] for r in substrings.without_repeats(df, **more).collect()], key=str)


@pytest.mark.parametrize("block", [substrings.BLOCK_WORDS, 500])
def test_against_every_window(docs, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK_WORDS", block)
    want = plain([(r[0], r[1]) for r in table()], 50)
    assert got(docs) == want
    assert sum(r[2] for r in want) > 1000


@pytest.mark.parametrize("least", [32, 37, 50, 64])
def test_passages_at_any_offset(frame, least):
    rng = random.Random(least)
    fresh = iter(range(10**6))
    passages = [[f"p{k}_{i}" for i in range(least + 20)] for k in range(4)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(3):
            w += [f"u{next(fresh)}" for _ in range(rng.randrange(70))]
            cut = rng.choice([least - 1, least, least + 1, least + 20])
            at = rng.randrange(least + 20 - cut + 1)
            w += rng.choice(passages)[at : at + cut]
        rows.append((i, " ".join(w)))
    assert got(frame(rows, "doc_id long, text string"), least=least) == plain(rows, least)


def test_cover_holds_every_difference():
    period, cover = substrings.PERIOD, substrings.COVER
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_text_is_shuffled_once(docs):
    plan = substrings.without_repeats(docs.where(F.col("doc_id").isNotNull()))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_empty(empty):
    assert got(empty) == []


def test_a_worker_sends_few_rows_at_a_time(monkeypatch):
    import numpy as np

    monkeypatch.setattr(substrings, "SENT_ROWS", 4)
    order = np.arange(10)[::-1]
    sent = list(substrings._sent(order, {"_a": np.arange(10) * 2}, {"_m": order > 6}))
    assert [len(s) for s in sent] == [4, 4, 2]
    assert [a for s in sent for a in s["_a"]] == [18, 16, 14, 12, 10, 8, 6, 4, 2, 0]
    assert [m for s in sent for m in s["_m"]] == [True] * 3 + [False] * 7


def test_a_block_is_let_go_before_the_next_is_read():
    import gc
    import weakref

    import numpy as np
    import pandas as pd

    held = []

    def find(row):
        keys = np.arange(substrings.BLOCK_WORDS // 2)
        held.append(weakref.ref(keys))
        return [keys], len(keys)

    batches = iter([pd.DataFrame({"_id": [1, 2, 3, 4], "_text": [""] * 4})])
    for block in substrings._blocks(batches, find):
        del block
        gc.collect()
        # What a document has put in lives on in the copy alone; the document read last is still at hand.
        assert sum(r() is not None for r in held) <= 1
