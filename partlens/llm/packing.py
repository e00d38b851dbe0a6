"""Batches of texts of like length: optimal length buckets, then token budgets."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from partlens.llm.common import stored

MOST_LENGTH = 2048
MOST_HELD = 16_384
BUCKETS = 12
BUDGET = 65_536
STRETCH_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def piece_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_length: int = MOST_LENGTH) -> DataFrame:
    """:func:`pieces` of a text's words, with the words of each in ``content``, a space between."""
    words = F.regexp_extract_all(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    split = docs.select(F.col(id_col).alias("_id"), words.alias("_words"))
    cut = F.expr(f"""transform(sequence(0L, greatest(ceil(size(_words) / {most_length}D) - 1, 0)), p -> named_struct(
        'piece', p, 'start', p * {most_length}L, 'length', least(size(_words) - p * {most_length}L, {most_length}L),
        'content', array_join(slice(_words, CAST(p * {most_length} + 1 AS INT), {most_length}), ' ')))""")
    return split.select("_id", F.explode(cut).alias("p")).select(F.col("_id").alias(id_col), "p.piece", "p.start", "p.length", "p.content")


def pieces(docs: DataFrame, tokens: Column, id_col: str = "doc_id", most_length: int = MOST_LENGTH) -> DataFrame:
    """Each row's tokens cut into pieces of at most ``most_length``: id, ``piece``, ``start``, ``length``.

    A row without tokens is one piece of length 0, so that no row is lost.
    """
    counted = docs.select(F.col(id_col), F.greatest(tokens.cast("long"), F.lit(0)).alias("_tokens"))
    last = F.greatest(F.ceil(F.col("_tokens") / most_length) - 1, F.lit(0))
    cut = counted.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    start = F.col("piece") * most_length
    return cut.select(id_col, "piece", start.alias("start"), F.least(F.col("_tokens") - start, F.lit(most_length)).alias("length"))


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The greatest length of each bucket, such that padding every row to its bucket's is least.

    Dynamic programming over the distinct lengths: the least padded size of the first j
    lengths in b buckets is that of the first i in b - 1, and the rest padded to length j.
    """
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    size = len(lengths)
    if not size:
        return []
    rows = np.concatenate(([0], np.cumsum(counts))).astype(np.float64)
    best = np.full(size + 1, np.inf)
    best[0] = 0.0
    chosen = []
    for _ in range(min(buckets, size)):
        after, cut = np.full(size + 1, np.inf), np.zeros(size + 1, np.int64)
        after[0] = 0.0
        for j in range(1, size + 1):
            cost = best[:j] + (rows[j] - rows[:j]) * lengths[j - 1]
            cut[j] = np.argmin(cost)
            after[j] = cost[cut[j]]
        best = after
        chosen.append(cut)
    ends, j = [], size
    for cut in reversed(chosen):
        if j == 0:
            break
        ends.append(int(lengths[j - 1]))
        j = int(cut[j])
    return ends[::-1]


def packed(
    items: DataFrame,
    keys: list[str],
    length: str = "length",
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """``items`` with ``bucket``, ``padded`` (its greatest length), ``batch`` and ``slot``.

    Bucket boundaries are optimal for the histogram of all lengths; it has a row per
    distinct length, so lengths must be at most ``MOST_HELD``, as :func:`pieces` makes them; longer ones
    stop the job before a row is brought back. A batch
    holds as many rows as fit in ``budget`` tokens when padded, one at least, and every
    batch of a bucket but the last is full. Rows are numbered in stretches: each stretch
    orders its own rows, and a row per stretch carries the count on, so a bucket may hold
    any share of all rows.
    """
    kept = stored(items, "items")
    longest = kept.agg(F.max(length)).first()[0] or 0
    if longest > MOST_HELD:
        raise ValueError(f"an item has {longest} tokens; cut items to {MOST_HELD} at most")
    histogram = kept.groupBy(length).agg(F.count(F.lit(1)).alias("n")).collect()
    ends = boundaries(np.array([r[0] for r in histogram]), np.array([r["n"] for r in histogram]), buckets)
    total = sum(r["n"] for r in histogram)
    # One condition per bucket, as ``ends`` rises.
    bucket, padded = F.lit(None).cast("int"), F.lit(None).cast("long")
    for number in reversed(range(len(ends))):
        fits = F.col(length) <= ends[number]
        bucket = F.when(fits, F.lit(number)).otherwise(bucket)
        padded = F.when(fits, F.lit(ends[number]).cast("long")).otherwise(padded)
    placed = kept.withColumns({"bucket": bucket, "padded": padded})
    stretches = max(1, math.ceil(total / STRETCH_ROWS))
    placed = placed.withColumn("_stretch", F.pmod(F.xxhash64(*keys), F.lit(stretches)))
    inside = W.partitionBy("bucket", "_stretch").orderBy(*keys)
    carried = placed.groupBy("bucket", "_stretch").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy("bucket").orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = carried.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    numbered = placed.withColumn("_own", F.row_number().over(inside) - 1).join(carried, ["bucket", "_stretch"])
    capacity = F.greatest(F.floor(F.lit(budget) / F.greatest(F.col("padded"), F.lit(1))), F.lit(1))
    place = F.col("_before") + F.col("_own")
    return numbered.select(
        *[F.col(f"`{c}`") for c in items.columns],
        "bucket",
        "padded",
        F.floor(place / capacity).cast("long").alias("batch"),
        F.pmod(place, capacity).cast("long").alias("slot"),
    )


def batches(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_length: int = MOST_LENGTH,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    content: bool = False,
) -> DataFrame:
    """Where every piece of every document goes: id, ``piece``, ``start``, ``length``, ``bucket``,
    ``padded``, ``batch`` and ``slot``; with ``content`` the piece's words as well, a space between.

    Tokens are words. Texts over ``most_length`` words are cut into pieces, so no word is
    lost and the histogram has at most ``most_length`` + 1 rows. Null and empty texts are
    a piece of no words in the bucket of the shortest. Repeated rows are packed each;
    the order of equal ones is open, and they are equal in all columns but their place. A
    null identifier stays. An empty table gives no rows, and other columns take no part.
    """
    if content:
        cut = piece_texts(docs, id_col, text_col, most_length)
        return packed(cut, [id_col, "piece", "length", "content"], "length", buckets, budget)
    cut = pieces(docs, word_count(F.col(text_col)), id_col, most_length)
    return packed(cut, [id_col, "piece", "length"], "length", buckets, budget)
