import random

import pytest
from pyspark.sql import functions as F

from partlens.llm import warc

SCHEMA = "record_id string, url string, at long, kind string, headers map<string,string>, payload string, _range string, url_key string"


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://WWW.Example.org:80/a/b/?utm_source=x#top", "example.org/a/b"),
        ("https://user:pw@example.org/A?b=2&a=1&sid=z", "example.org/A?a=1&b=2"),
        ("http://example.org/p?ref=1", "example.org/p?ref=1"),
        ("//example.org:8080", "example.org:8080"),
        ("example.org?x", "example.org?x"),
        ("", ""),
        (None, None),
    ],
)
def test_url_key(frame, url, key):
    assert frame([(url,)], "u string").select(warc.url_key(F.col("u"))).first()[0] == key


def test_headers(frame):
    block = "HTTP/1.1 304 Not Modified\r\nETag:  \"a\" \r\nVary: x\nvary: y\r\nno colon\r\n\r\nEmpty:"
    row = frame([(block,), (None,)], "b string").select(warc.parse_headers(F.col("b")).alias("h")).collect()
    assert row[0].h == {"etag": '"a"', "vary": "x, y", "empty": ""} and row[1].h == {}


def plain(rows):
    out = []
    for r in rows:
        if r[3] != "revisit":
            continue
        mine = r[4] or {}
        before = [q for q in rows if q[3] == "response" and q[1] == r[1] and (r[2] is not None and (q[2] is None or q[2] < r[2]))]
        best = max(before, key=lambda q: (q[2] is not None, q[2] or 0, q[0]), default=None)
        if best is None:
            out.append((r[0], "no earlier response", None, tuple(sorted(mine.items())), None))
            continue
        theirs = best[4] or {}
        weak = lambda h: h["etag"].removeprefix("W/") if "etag" in h else None
        if weak(mine) and weak(theirs):
            agrees = weak(mine) == weak(theirs)
        elif "last-modified" in mine and "last-modified" in theirs:
            agrees = mine["last-modified"] == theirs["last-modified"]
        else:
            out.append((r[0], "no validator", None, tuple(sorted(mine.items())), None))
            continue
        merged = theirs | {k: v for k, v in mine.items() if k in warc.PERMITTED} if agrees else mine
        out.append((r[0], "resolved" if agrees else "validator differs", best[0] if agrees else None, tuple(sorted(merged.items())), best[5] if agrees else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [1, 20, 60])
def test_against_all_records(frame, monkeypatch, ranges):
    monkeypatch.setattr(warc, "RANGE_ROWS", max(300 // ranges, 1))
    rng = random.Random(ranges)
    rows = []
    for i in range(300):
        kind = rng.choice(["response", "revisit", "revisit", "request"])
        headers = {"etag": rng.choice(["", "W/"]) + f'"{rng.randrange(2)}"'} if rng.random() < 0.7 else {}
        if rng.random() < 0.5:
            headers["last-modified"] = str(rng.randrange(2))
        headers["content-type"] = kind
        url = rng.choice([None, ""]) if rng.random() < 0.1 else "http://h/hot" if rng.random() < 0.6 else f"http://h/{rng.randrange(9)}"
        at = None if rng.random() < 0.04 else rng.randrange(60)
        rows.append((f"k{i:03}", url, at, kind, None if rng.random() < 0.05 else headers, f"p{i}", "x", "y"))
    rows.append(next(r for r in rows if r[3] == "revisit"))
    got = warc.resolve_revisits(frame(rows, SCHEMA)).collect()
    found = sorted([(r.record_id, r.state, r.refers_to, tuple(sorted(r.headers.items())), r.payload) for r in got], key=str)
    assert found == plain(rows)
    assert {f[1] for f in found} == {"resolved", "validator differs", "no validator", "no earlier response"}


def test_empty(frame):
    assert warc.resolve_revisits(frame([], SCHEMA)).collect() == []
