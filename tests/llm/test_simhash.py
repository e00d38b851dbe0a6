import random

import numpy as np
import pandas as pd
import xxhash

from partlens.llm import simhash
from partlens.llm.common import WORD, components
from tests.llm.cases import table


def plain_print(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, bits):
    top = list(range(len(values)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return [find(i) for i in range(len(values))]


def test_against_all_pairs(docs):
    rows = table()
    values = [plain_print(r[1]) for r in rows]
    groups = plain_components(values, 4)
    least = {g: min(r[0] for r, h in zip(rows, groups) if h == g and r[0] is not None) for g in groups}
    want = sorted([(r[0], f"{v:016x}", least[g]) for r, v, g in zip(rows, values, groups)], key=str)
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == want
    assert len(set(groups)) < len(set(values))


def test_dense_clusters_whatever_the_lists(spark, frame, monkeypatch):
    rng = random.Random(5)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            v = centre
            for _ in range(rng.randrange(9)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    groups = plain_components(values, 4)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    for size, held in ((1024, 1), (7, 1), (1024, 2), (1024, 3)):
        monkeypatch.setattr(simhash, "bytes_of_a_list", lambda *_, held=held: held)
        links = simhash.near_links(frame([(v,) for v in signed], "fingerprint long"), list_rows=size).collect()
        assert all((r.a ^ r.b) != 0 for r in links)
        roots = {r.node: r.root for r in components(frame([(r.a, r.b) for r in links], "a long, b long")).collect()}
        named = [roots.get(v, v) for v in signed]
        assert len({(n, g) for n, g in zip(named, groups)}) == len(set(named)) == len(set(groups))


def test_the_tally_rejects_pairs_of_a_list(monkeypatch):
    """Lists are about fewer bytes than a pair must share, so what a list holds is not yet near."""
    rng = np.random.default_rng(2)
    value = np.sort(rng.integers(0, 2**64, 400, dtype=np.uint64) & np.uint64(0xFFFFFFFF_FFFFFF00) | np.uint64(0x5A))
    near = value[0] ^ np.uint64(0b1001 << 40)
    value = np.append(value, [near])
    tallies = []
    inner = simhash.shared_bytes
    monkeypatch.setattr(simhash, "shared_bytes", lambda apart: tallies.append(inner(apart)) or tallies[-1])
    batch = pd.DataFrame({"_c": 0, "_key": 0x5A, "_i": 0, "_j": 0, "fingerprint": value.view(np.int64)})
    found = pd.concat(list(simhash._linker(4)(iter([batch]))))
    tallies = np.concatenate(tallies)
    assert len(tallies) == 401 * 400 // 2 and (tallies >= 1).all()
    assert (tallies < 4).sum() > 80_000 and (tallies >= 4).sum() >= 1
    assert {frozenset((r.a, r.b)) for r in found.itertuples()} == {frozenset(map(int, (value[0].view(np.int64), near.view(np.int64))))}


def test_lists_hold_every_pair_that_shares_enough():
    for least in range(1, 9):
        for held in range(1, max(2, least)):
            masks = {m & (2**64 - 1) for m in simhash._masks(least, held)}
            assert len(masks) == len(simhash._masks(least, held))
            for shared in range(256):
                if shared.bit_count() >= least:
                    first = [b for b in range(8) if shared >> b & 1][:held]
                    assert sum(0xFF << 8 * b for b in first) in masks
    assert len(simhash._masks(4, 1)) == 5 and len(simhash._masks(4, 2)) == 15 and len(simhash._masks(4, 3)) == 35
    assert [simhash.bytes_of_a_list(n, 4, 1024) for n in (0, 262_144, 262_145, 2**26, 2**26 + 1, 10**12)] == [1, 1, 2, 2, 3, 3]


def test_long_chain_of_links(frame):
    order = list(range(300))
    random.Random(1).shuffle(order)
    found = components(frame(list(zip(order, order[1:])), "a long, b long")).collect()
    assert len(found) == 300 and {r.root for r in found} == {0}


def test_empty(empty):
    assert simhash.near_duplicates(empty).collect() == []
