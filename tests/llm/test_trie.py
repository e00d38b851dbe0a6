import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from partlens.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, _h string, turns string, _shard int"


def plain(sequences):
    """Every prefix of every conversation in one dictionary; ``sequences`` is {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(sequences):
        turns = sequences[c]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    return sorted(
        (
            (
                members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children[p]), leaves[p], saved[p],
                hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
            )
            for p in members
        ),
        key=str,
    )


def told(rows):
    """Conversations as lists of turns, in order."""
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in held.items()}


def replayed(held):
    out = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = held.get(c - int(np.fmod(c, 5)), [])[:h] + own[h:]
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(seed, convs=120):
    rng = random.Random(seed)
    rows, long = [], [(i % 2 and "user" or "assistant", f"é{i // 3}") for i in range(70)]
    for c in range(convs):
        start = long[: rng.choice([0, 1, 2, 3, 40, 70])] if c % 3 else long[:2]
        more = [(rng.choice(["user", None, ""]), rng.choice(["a", "b", "", None, "née"])) for _ in range(rng.randrange(4))]
        turns = start if c % 4 == 0 else start + more
        rows += [(c * 3 - 30, i if i else None, *t) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [5, 60, 700, trie.SHARD_TURNS])
def test_against_every_prefix(frame, shard_turns):
    rows = random_rows(shard_turns)
    df = frame([(*r, "x", "x", "x", 9) for r in rows], SCHEMA)
    want = plain(told(rows))
    assert max(r[1] for r in want) > 60
    assert got(trie.prefix_trie(trie.turn_lists(df), shard_turns)) == want
    assert got(trie.prefix_trie(trie.rebuilt(trie.turn_lists(df)), shard_turns)) == plain(replayed(told(rows)))


def test_one_conversation_repeated_over_shards(frame):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]
    rows += [(c, t, "user", f"turn {t}" if t < 3 else "more") for c in range(300, 330) for t in range(4)]
    assert got(trie.prefix_trie(trie.turn_lists(frame(rows, "conv_id long, turn long, role string, text string")), 40)) == plain(told(rows))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=5), min_size=1, max_size=30), st.data())
def test_shards_tell_their_own_part(paths, data):
    paths = sorted([bytes([t]) * 16 for t in p] for p in paths)
    cuts = sorted(data.draw(st.sets(st.integers(1, max(len(paths) - 1, 1)), max_size=4)) - {len(paths)})
    edges = [0, *cuts, len(paths)]

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    sums = defaultdict(lambda: np.zeros(4, np.int64))
    for n, (a, b) in enumerate(zip(edges, edges[1:])):
        if a == b:
            continue
        seen = common(paths[a], paths[a - 1]) if a else -1
        following = common(paths[b - 1], paths[b]) if b < len(paths) else -1
        found = trie.shard_nodes(paths[a:b], [[7] * len(p) for p in paths[a:b]], np.arange(a, b), seen, following, n)
        for row in found.itertuples():
            assert row.shared == (row.node is not None)
            key = row.node if row.shared else (n, row.Index)
            sums[key] += [row.n_convs, row.n_children, row.n_leaves, row.saved]
    want = plain({c: [("", "1234567" + chr(97 + t[0])) for t in p] for c, p in enumerate(paths)})
    # Texts of eight bytes there, seven here.
    assert sorted(tuple(v) for v in sums.values()) == sorted((r[3], r[4], r[5], r[6] // 8 * 7) for r in want)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 5, 60, 900]))
def test_find_close(seed, size):
    rng = random.Random(seed)
    opens, depth, left = [True], 1, size
    lean = rng.choice([0.5, 0.55, 0.9])
    while depth:
        up = left > 0 and (depth == 1 or rng.random() < lean)
        opens.append(up)
        depth += 1 if up else -1
        left -= up
    stack, want = [], {}
    for i, up in enumerate(opens):
        if up:
            stack.append(i)
        else:
            want[stack.pop()] = i
    places = np.flatnonzero(opens)
    assert trie.Parens(np.array(opens)).find_close(places).tolist() == [want[i] for i in places.tolist()]


def test_awkward_rows(frame):
    rows = [
        (None, 0, "user", "nobody's"), (5, None, None, None), (5, 1, "user", "x"), (5, 1, "user", "x"), (6, 0, "", ""), (7, 0, None, ""),
        (8, 0, "user", "a" * 3_000_000), (9, 0, "user", "a" * 3_000_000), (-4, 2, "u", "ser x"), (-3, 2, "us", "er x"), (-3, 2, "us", "er x"),
    ]
    df = frame([(*r, None, None, None, None) for r in rows], SCHEMA)
    assert got(trie.prefix_trie(trie.turn_lists(df))) == plain(told(rows))


def test_empty(frame):
    assert got(trie.prefix_trie(trie.rebuilt(trie.turn_lists(frame([], SCHEMA))))) == []


def test_query(spark, tmp_path, frame):
    rows = random_rows(3)
    frame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op12_prefix_trie"](spark, str(tmp_path))
    assert got(found) == plain(replayed(told(rows)))
