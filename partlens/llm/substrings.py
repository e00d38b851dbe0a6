"""Passages that an earlier document holds too, found by difference-cover anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from partlens.llm.common import bounded_batches, text_of, words_of

LEAST_WORDS = 50
# Every difference modulo 31 is one of two members of this set.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
BLOCK_WORDS = 150_000
SENT_ROWS = 32_768
BATCH_ROWS = 64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, as far as the longest text so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = 1 << (count - 1).bit_length()
            self.up, self.down = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))), dtype=np.uint64)
                for b in (self.base, self.inverse)
            )
        return self.up[:count], self.down[:count]


_POWERS = [_Powers(base) for base in BASES]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, starts: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A polynomial hash of the ``width`` words from each start."""
    up, down = _POWERS[which].to(len(hashes) + 1)
    if which:
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(BASES[0])
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1], dtype=np.uint64)))
    return (sums[starts + width] - sums[starts]) * down[starts]


def anchor_starts(count: int, least: int) -> np.ndarray:
    """The cover positions of a text of ``count`` words where an anchor fits; none if no window does."""
    if count < least:
        return np.zeros(0, np.int64)
    width = least - PERIOD + 1
    return np.flatnonzero(np.isin(np.arange(count - width + 1) % PERIOD, COVER))


def _settled(keys: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Within a block: one row per key and document, whether it is its key's first, and whether the key has others."""
    order = np.lexsort((ids, *reversed(keys)))
    keys, ids = [k[order] for k in keys], ids[order]
    new_key = np.ones(len(ids), bool)
    new_row = np.ones(len(ids), bool)
    if len(ids):
        new_key[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        new_row[1:] = new_key[1:] | (ids[1:] != ids[:-1])
    order, first = order[new_row], new_key[new_row]
    group = np.cumsum(first) - 1
    return order, first, (np.bincount(group) if len(group) else group)[group] > 1


def _joined(held: list) -> tuple[list[np.ndarray], np.ndarray]:
    return [np.concatenate(k) for k in zip(*[k for k, _ in held])], np.concatenate([i for _, i in held])


def _sent(order: np.ndarray, columns: dict[str, np.ndarray], marks: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
    """``columns`` in ``order`` beside ``marks``, few rows at a time: a batch is held by the worker and by Spark at once."""
    for i in range(0, len(order), SENT_ROWS):
        part = slice(i, i + SENT_ROWS)
        yield pd.DataFrame({n: c[order[part]] for n, c in columns.items()} | {n: m[part] for n, m in marks.items()})


def _blocks(batches: Iterator[pd.DataFrame], find) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Keys and identifiers of all documents of a block, a block being about ``BLOCK_WORDS`` words."""
    held, size = [], 0
    for batch in batches:
        for row in batch.itertuples(index=False):
            keys, words = find(row)
            if len(keys[0]):
                held.append((keys, np.full(len(keys[0]), row[0], np.int64)))
                size += words
            if size >= BLOCK_WORDS:
                block, held, size = _joined(held), [], 0
                yield block
    if held:
        yield _joined(held)


def _apart(settled: Column, *keys: Column) -> Column:
    """The key a row is grouped by: rows that their block has settled need no group and are spread."""
    return F.when(settled, F.xxhash64(*keys, "_id")).otherwise(keys[0])


def shared_anchors(texts: DataFrame, least: int) -> DataFrame:
    """(_id, _anchors): the anchors of a document that another document has as well.

    A block of documents sends each anchor once, for its smallest document; the others of
    the block are known to share it already. So an anchor has at most a row per block.
    """

    def find(row):
        hashes = word_hashes(words_of(row[1]))
        return [window_hashes(hashes, anchor_starts(len(hashes), least), least - PERIOD + 1).view(np.int64)], len(hashes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (anchors,), ids in _blocks(batches, find):
            at, first, many = _settled([anchors], ids)
            yield from _sent(at, {"_a": anchors, "_id": ids}, {"_many": many, "_sent": ~first})

    found = texts.mapInPandas(run, "_a long, _id long, _many boolean, _sent boolean")
    same = W.partitionBy(_apart(F.col("_sent"), F.col("_a")))
    shared = found.withColumn("_spread", F.min("_id").over(same) < F.max("_id").over(same)).where("_many OR _spread")
    return shared.groupBy("_id").agg(F.collect_set("_a").alias("_anchors"))


def _near(hashes: np.ndarray, anchors, least: int) -> np.ndarray:
    """The starts of the windows that hold a shared anchor at most a period from their start."""
    at = anchor_starts(len(hashes), least)
    own = window_hashes(hashes, at, least - PERIOD + 1).view(np.int64)
    at = at[np.isin(own, np.asarray(anchors, np.int64))]
    count = len(hashes) - least + 1
    edges = np.zeros(max(count, 0) + 1, np.int64)
    np.add.at(edges, np.clip(at - PERIOD + 1, 0, count), 1)
    np.add.at(edges, np.clip(at + 1, 0, count), -1)
    return np.flatnonzero(np.cumsum(edges)[:count] > 0)


def repeated_windows(candidates: DataFrame, least: int) -> DataFrame:
    """(_id, _windows): the windows of a document that start in a smaller document as well.

    The windows around shared anchors are compared over their whole length by 96-bit
    hashes. A block sends a window once, for its smallest document.
    """

    def find(row):
        hashes = word_hashes(words_of(row[1]))
        starts = _near(hashes, row[2], least)
        one, two = (window_hashes(hashes, starts, least, which).view(np.int64) for which in (0, 1))
        return [one, (two >> 32).astype(np.int32)], len(hashes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (one, two), ids in _blocks(batches, find):
            at, first, _ = _settled([one, two], ids)
            yield from _sent(at, {"_h": one, "_g": two, "_id": ids}, {"_later": ~first})

    found = candidates.mapInPandas(run, "_h long, _g int, _id long, _later boolean")
    same = W.partitionBy(_apart(F.col("_later"), F.col("_h"), F.col("_g")), "_g")
    later = found.withColumn("_first", F.min("_id").over(same)).where("_later OR _id > _first")
    return later.groupBy("_id").agg(F.collect_set("_h").alias("_windows"))


def _without(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, gone, kept = [], [], []
            for text, windows in zip(batch["_text"], batch["_windows"]):
                words = words_of(text)
                counts.append(len(words))
                stays = np.ones(len(words), bool)
                if windows is not None and len(windows) and len(words) >= least:
                    starts = np.arange(len(words) - least + 1)
                    own = window_hashes(word_hashes(words), starts, least).view(np.int64)
                    hit = np.isin(own, np.asarray(windows, np.int64))
                    edges = np.zeros(len(words) + 1, np.int64)
                    edges[:-least] += hit
                    edges[least:] -= hit
                    stays = np.cumsum(edges)[:-1] == 0
                    words = [w for w, s in zip(words, stays.tolist()) if s]
                gone.append(int(len(stays) - stays.sum()))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"_id": batch["_id"], "n_words": counts, "n_removed": gone, "kept_text": kept, "_key": batch["_key"]})

    return run


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_removed``, ``kept_text`` and ``text_key``.

    A word goes if it lies in a window of ``least`` words that starts in a document with a
    smaller identifier as well; windows are those of the input. ``kept_text`` is the other
    words with one space between, ``text_key`` a 64-bit hash of the text the row came with.

    Only windows of ``least`` - 30 words at cover positions modulo 31 are hashed first.
    Whatever the offset of two equal passages of ``least`` words, one of their first 31
    positions is a cover position in both, so they share an anchor there. The windows
    around shared anchors are then compared in full. Texts are shuffled once, by identifier.

    Null, empty and short texts lose nothing. Rows with one identifier do not count as
    earlier than each other, so repeated rows come out alike, each judged by its own text.
    A row with a null identifier loses nothing and takes nothing from others. An empty table
    gives no rows, and other columns take no part. One text must fit in a task's memory.
    """
    if least < PERIOD + 1:
        raise ValueError(f"windows must have over {PERIOD} words")
    bounded_batches(docs.sparkSession, BATCH_ROWS)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))
    named = texts.where("_id IS NOT NULL")
    candidates = named.join(shared_anchors(named, least), "_id").select("_id", "_text", "_anchors")
    windows = repeated_windows(candidates, least)
    key = F.xxhash64("_text").alias("_key")
    judged = named.join(windows, "_id", "left").select("_id", "_text", "_windows", key)
    unnamed = texts.where("_id IS NULL").select("_id", "_text", F.lit(None).cast("array<long>").alias("_windows"), key)
    schema = "_id long, n_words long, n_removed long, kept_text string, _key long"
    done = judged.mapInPandas(_without(least), schema).union(unnamed.mapInPandas(_without(least), schema))
    return done.select(F.col("_id").cast(kind).alias(id_col), "n_words", "n_removed", "kept_text", F.col("_key").alias("text_key"))
