"""Near duplicates by SimHash over an inverted index of fingerprint bytes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partlens.llm.common import bounded_batches, components, lower_words, stored, text_of

SHINGLE = 4
SEED = 42
MOST_BITS = 4
BYTES = 8
LIST_ROWS = 1024
LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The bits set in over half of the shingles' hashes, as a signed 64-bit integer."""
    words = lower_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    reach = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[s:e], SEED) for s, e in zip(begins[:reach].tolist(), last.tolist())), np.uint64, reach
    )
    # A byte lane counts one bit of each byte; 255 hashes cannot overflow it.
    rows = -(-reach // 255)
    padded = np.zeros(rows * 255, np.uint64)
    padded[:reach] = hashes
    value = 0
    for bit in range(8):
        lanes = ((padded >> np.uint64(bit)) & LANES).reshape(rows, 255).sum(axis=1, dtype=np.uint64)
        counts = lanes.view(np.uint8).reshape(rows, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(counts * 2 > reach).tolist():
            value |= 1 << (8 * byte + bit)
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint as a long) of every whole text; null text counts as empty."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.fromiter((fingerprint(t) for t in batch["_text"]), np.int64, len(batch))
            yield pd.DataFrame({"_id": batch["_id"], "fingerprint": found})

    pair = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    schema = f"_id {pair.schema['_id'].dataType.simpleString()}, fingerprint long"
    return pair.mapInPandas(run, schema).withColumnRenamed("_id", id_col)


def _masks(least_bytes: int, held: int) -> list[int]:
    """A mask for each choice of ``held`` positions that can be the first of ``least_bytes`` shared ones, as signed integers."""
    found = []
    for chosen in combinations(range(BYTES), held):
        if all(byte <= BYTES - least_bytes + place for place, byte in enumerate(chosen)):
            mask = sum(0xFF << (8 * byte) for byte in chosen)
            found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def bytes_of_a_list(rows: int, least_bytes: int, list_rows: int) -> int:
    """How many positional bytes a posting list is about: as few as keep lists of evenly spread values short.

    Always fewer than a pair must share, where that is over one, so that the tally decides.
    """
    held = 1
    while held < least_bytes - 1 and rows > list_rows * 256**held:
        held += 1
    return held


def shared_bytes(apart: np.ndarray) -> np.ndarray:
    """In how many of the eight places two fingerprints have one byte, from what they differ in."""
    return (apart.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)


def _linker(most_bits: int):
    """Rows of lists, sorted by list, to links: a linked row and the smallest one of its cluster.

    Rows of one list are compared at every distance along the list, all lists of a batch
    at once. The bytes that each pair shares are tallied, pairs below the guaranteed number go, and
    those left are verified bit by bit. Clusters, not pairs, come out: at most one link per row.
    """
    least_bytes = BYTES - most_bits

    def clusters(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = np.arange(len(value))
        step, at = 1, np.arange(len(value) - 1)
        while len(at):
            at = at[at + step < len(value)]
            at = at[group[at] == group[at + step]]
            apart = value[at] ^ value[at + step]
            kept = np.flatnonzero(shared_bytes(apart) >= least_bytes)
            near = at[kept[np.bitwise_count(apart[kept]) <= most_bits]]
            one, other = near, near + step
            while len(one):
                a, b = top[one], top[other]
                differ = a != b
                if not differ.any():
                    break
                one, other, a, b = one[differ], other[differ], a[differ], b[differ]
                np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))
                while (top[top] != top).any():
                    top = top[top]
            step += 1
        rows = np.flatnonzero(top != np.arange(len(top)))
        return rows, top[rows]

    def links(batch: pd.DataFrame) -> pd.DataFrame:
        keys = batch[["_c", "_key", "_i", "_j"]].to_numpy()
        group = np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))))
        value = batch["fingerprint"].to_numpy(np.int64).view(np.uint64)
        rows, tops = clusters(group, value)
        return pd.DataFrame({"a": value[rows].view(np.int64), "b": value[tops].view(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = batch[["_c", "_key", "_i", "_j"]].iloc[-1]
            open_list = (batch[["_c", "_key", "_i", "_j"]] == last).all(axis=1)
            rest = batch[open_list]
            done = batch[~open_list].reset_index(drop=True)
            if len(done):
                yield links(done)
        if rest is not None and len(rest):
            yield links(rest.reset_index(drop=True))

    return run


def near_links(prints: DataFrame, most_bits: int = MOST_BITS, list_rows: int = LIST_ROWS) -> DataFrame:
    """(a, b) links that connect all fingerprints at ``most_bits`` or fewer differing bits.

    ``prints`` has distinct ``fingerprint`` values. Of eight bytes, ``most_bits`` differing
    bits leave at least 8 - most_bits equal in place. A posting list holds the fingerprints with one byte at one
    place, of the places that can be the first a pair shares: the first five, for four bits. The list says
    only that a pair shares this byte; the tally of all shared bytes rejects most pairs, and the bits are verified.

    A list of one byte holds a 256th of the corpus. Once that is over ``list_rows``, lists are refined by the
    byte at a later place, and once more, so that they are about two or three bytes: still fewer
    than a pair must share, and no pair is lost, as its first two or three shared bytes make such a list. Lists
    that are long all the same are cut into blocks, and each pair of blocks is a list of its own.
    """
    if not 0 <= most_bits < BYTES:
        raise ValueError("most_bits must be from 0 to 7")
    least_bytes = BYTES - most_bits
    held = bytes_of_a_list(prints.count(), least_bytes, list_rows)
    masks = _masks(least_bytes, held)
    choices = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for c, m in enumerate(masks)]
    )
    postings = prints.select("fingerprint", F.explode(choices).alias("p")).select("fingerprint", F.col("p.c").alias("_c"), F.col("p.key").alias("_key"))
    sizes = postings.groupBy("_c", "_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    lists = postings.join(sizes, ["_c", "_key"]).withColumn("_blocks", F.ceil(F.col("_n") / list_rows).cast("int"))
    lists = lists.withColumn("_own", F.pmod(F.xxhash64("fingerprint"), F.col("_blocks")).cast("int"))
    lists = lists.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    lists = lists.select("_c", "_key", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "fingerprint")
    keys = ["_c", "_key", "_i", "_j"]
    ordered = lists.repartition(*keys).sortWithinPartitions(*keys, "fingerprint")
    return ordered.mapInPandas(_linker(most_bits), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS
) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints at ``most_bits`` or fewer differing bits are linked; ``component_id`` is the
    smallest identifier reachable over links. Only distinct fingerprints are indexed, each
    with its smallest identifier, so exact and equal-fingerprint copies cost nothing.

    A null or empty text has fingerprint zero and is linked like any other. Repeated rows
    come out once each with the same component. A null identifier is never the smallest
    unless the component has no other. An empty table gives no rows. Other columns take
    no part.
    """
    found = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    prints = stored(found.groupBy("fingerprint").agg(F.min(id_col).alias("_first")), "prints")
    links = stored(near_links(prints.select("fingerprint"), most_bits), "near")
    roots = components(links).withColumnRenamed("node", "fingerprint")
    rooted = prints.join(roots, "fingerprint")
    named = rooted.groupBy("root").agg(F.min("_first").alias("_component"))
    linked = rooted.join(named, "root").select("fingerprint", "_component")
    every = prints.join(linked, "fingerprint", "left").select("fingerprint", F.coalesce("_component", "_first").alias("component_id"))
    # Written first, so that both sides of the last join are plain shuffles and Spark can split a common fingerprint.
    return found.join(stored(every, "classes"), "fingerprint").select(
        id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
