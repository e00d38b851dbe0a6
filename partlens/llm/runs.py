"""Periodic runs of words inside a text: seeds on diagonals, extended to whole runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partlens.llm.common import bounded_batches, text_of, words_of

LEAST_WORDS = 12


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """The rank of each key among the distinct ones, and how many of those there are."""
    distinct, ranks = np.unique(keys, return_inverse=True)
    return ranks.astype(np.int64), len(distinct)


def _grams(ranks: np.ndarray, distinct: int, apart: int, others: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Ranks of the grams that join the one at each place with the one ``apart`` places on."""
    others = ranks if others is None else others
    size = len(others) - apart
    return _ranked(ranks[:size] * distinct + others[apart : apart + size])


def _pairs(ranks: np.ndarray, step: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, start): each anchor, at a multiple of ``step``, with the later places of its gram ``low`` to ``high`` words on."""
    size = len(ranks)
    order = np.argsort(ranks, kind="stable")
    keys = ranks[order] * size + order
    anchors = np.arange(0, size, step)
    base = ranks[anchors] * size
    first = np.searchsorted(keys, base + np.minimum(anchors + low, size))
    last = np.searchsorted(keys, base + np.minimum(anchors + high, size - 1), side="right")
    counts = np.maximum(last - first, 0)
    starts = np.repeat(anchors, counts)
    within = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    return order[np.repeat(first, counts) + within] - starts, starts


def _matched(words: np.ndarray, lag: int, start: int, end: int, reach: int) -> tuple[int, int]:
    """The stretch of words equal to the ones ``lag`` further that holds [start, end); it ends within ``reach`` of both."""
    low = max(start - reach, 0)
    unlike = np.flatnonzero(words[low:start] != words[low + lag : start + lag])
    begin = low + int(unlike[-1]) + 1 if len(unlike) else low
    high = min(end + reach, len(words) - lag)
    unlike = np.flatnonzero(words[end:high] != words[end + lag : high + lag])
    return begin, end + int(unlike[0]) if len(unlike) else high


def _primitive(root: np.ndarray) -> bool:
    """Whether a root is no repetition of a shorter one."""
    size = rest = len(root)
    factor = 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            part = size // factor
            if np.array_equal(root[part:], root[:-part]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def find_runs(words: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; ``words`` are numbers.

    A run of period q and at least max(least, 2q) words equals itself q words on over at least
    max(least - q, q) words. So lags from g to 2g share g words, and lags below ``least`` share half
    of it. Grams of half the guaranteed words are indexed by their place, and each gram at a
    multiple of its size meets its later places at those lags: a stretch of g equal words holds
    one whole. That is at most two pairs a word for each class of lags, however often a word is
    repeated, and grams of the next class come from joining two of this one.

    A table keeps how far each lag is covered: a pair that starts where the one before it ends
    is the same stretch, and only the ends of a stretch are extended, over less than a gram. A
    pair that lies in a run of a smaller period which divides its lag is that run again.
    """
    size = len(words)
    found: list[tuple[int, int, int]] = []
    step = max(least // 4, 1)
    if size < max(least, 2):
        return found
    ranks, distinct = _ranked(words)
    ones, count = ranks, distinct
    width = 1
    while width < step:
        more = min(width, step - width)
        ranks, distinct = _grams(ranks, max(distinct, count), width, ranks if more == width else ones)
        width += more if more == width else 1
    low, high = 1, 4 * step - 1
    while low <= size // 2 and distinct < len(ranks):
        high = min(high, size // 2)
        lags, starts = _pairs(ranks, step, low, high)
        if found and len(lags):
            lags, starts = _not_inside(lags, starts, step, found, size)
        if len(lags):
            order = np.lexsort((starts, lags))
            lags, starts = lags[order], starts[order]
            # The furthest covered place of each lag, moved on by every pair that begins there.
            fresh = np.ones(len(lags), bool)
            fresh[1:] = (lags[1:] != lags[:-1]) | (starts[1:] > starts[:-1] + step)
            heads = np.flatnonzero(fresh)
            ends = starts[np.concatenate((heads[1:], [len(lags)])) - 1] + step
            lags, starts = lags[heads], starts[heads]
            able = ends - starts + 2 * (step - 1) >= np.maximum(lags, least - lags)
            new = []
            for lag, start, end in zip(lags[able].tolist(), starts[able].tolist(), ends[able].tolist()):
                begin, stop = _matched(words, lag, start, end, step)
                if stop - begin >= max(lag, least - lag) and _primitive(words[begin : begin + lag]):
                    new.append((begin, stop - begin + lag, lag))
            found += new
        low, high = 4 * step, 8 * step - 1
        if len(ranks) <= step:
            break
        ranks, distinct = _grams(ranks, distinct, step)
        step *= 2
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def _not_inside(lags: np.ndarray, starts: np.ndarray, step: int, found: list, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs without those that lie in a run whose period divides their lag.

    Runs found so far have periods below all lags at hand. Where one of half a pair's lag or less holds
    the pair, no other holds it: their common stretch would have a period that divides both. So
    the run that reaches furthest among those begun is the only one to ask.
    """
    begun = np.zeros(size + 1, np.int64)
    known = np.array(sorted(found, key=lambda r: r[0] + r[1]), np.int64)
    ends = known[:, 0] + known[:, 1]
    np.maximum.at(begun, known[:, 0], np.arange(1, len(known) + 1))
    which = np.maximum.accumulate(begun)[starts] - 1
    inside = (which >= 0) & (ends[which] >= starts + lags + step) & (lags % known[which, 2] == 0)
    return lags[~inside], starts[~inside]


def _kept(count: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when each run keeps its first period alone."""
    edges = np.zeros(count + 1, np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges)[:count] == 0


def collapsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``runs`` and ``kept_text``.

    ``runs`` are structs of ``start`` (a word's number), ``length`` and ``period``, by start, then
    period: every stretch of words with smallest period q and at least max(``least``, 2q) words that
    cannot grow on either side. ``kept_text`` holds the words, one space between, without those
    that a run repeats after its first period.

    Null and empty texts have no words and no runs; repeated rows come out alike, each on its own;
    null identifiers stay. Runs may overlap and share a start; their order is total. Texts are
    read whole and never compared with each other, so nothing is shuffled: one text must fit in
    a task's memory, and its work grows as its words times the logarithm of their number, were all of
    them one word. An empty table gives no rows, and other columns take no part.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, runs, kept = [], [], []
            for text in batch["_text"]:
                words = words_of(text)
                numbers: dict[bytes, int] = {}
                found = find_runs(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64), least)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                if found:
                    words = [w for w, stays in zip(words, _kept(len(words), found).tolist()) if stays]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"_id": batch["_id"], "n_words": counts, "runs": runs, "kept_text": kept})

    schema = f"_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, kept_text string"
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    return texts.mapInPandas(run, schema).withColumnRenamed("_id", id_col)


def replayed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text, where the texts of one identifier in ten repeat a part of themselves.

    With h the crc32 of the identifier in decimals and g a tenth of it: if h ends in 0, each word i
    from a = g % n on becomes word a + (i - a) % p of the n words, p = 1 + (n - a) / (3 + g % 8).
    Other texts, texts without words and those of null identifiers stay as they are.
    """
    text = text_of(text_col)
    h = F.crc32(F.col(id_col).cast("string"))
    rows = docs.select(F.col(id_col), text.alias("_text"), h.alias("_h"))
    words = F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("_text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = rows.withColumn("_words", words)
    changed = """
        CASE WHEN size(_words) > 0 THEN array_join(
            transform(sequence(0, size(_words) - 1), i -> _words[CAST(
                CASE WHEN i < (_h DIV 10) % size(_words) THEN i
                     ELSE (_h DIV 10) % size(_words) + (i - (_h DIV 10) % size(_words))
                          % (1 + (size(_words) - (_h DIV 10) % size(_words)) DIV (3 + (_h DIV 10) % 8)) END AS INT)]), ' ')
        ELSE _text END
    """
    return rows.select(id_col, F.expr(changed).alias(text_col))
