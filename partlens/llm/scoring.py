"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partlens.llm.common import bounded_batches, crc_bucket, lower_words, stored, text_of

END = b""
SMOOTH = 0.1
PRIOR = 400.0
MOST_FILTER_BITS = 1 << 29
REGIONS = 256
PROBES = 4
LEVELS = 40
BLOCK_CHARS = 8_000_000
PACKED_TOKENS = 2_000_000
SEGMENT_KEYS = 1_000_000
START = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(value: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each value."""
    value = (value ^ (value >> np.uint64(30))) * MIX[0]
    value = (value ^ (value >> np.uint64(27))) * MIX[1]
    return value ^ (value >> np.uint64(31))


def pair_keys(words: list[bytes]) -> np.ndarray:
    """A key for each word together with the word before it; the first has the start before it."""
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    before = np.concatenate((np.array([START]), own[:-1]))
    return mixed(mixed(before) + own)


def level_of(counts: np.ndarray) -> np.ndarray:
    """The quantised count: 1 for 1, 2 for 2 and 3, 3 for 4 to 7, and so on."""
    return np.minimum(np.floor(np.log2(counts)).astype(np.int64) + 1, LEVELS)


#: What a level stands for: the middle, by ratio, of the counts it covers.
VALUES = np.array([0.0] + [math.sqrt(2.0 ** (k - 1) * (2.0**k - 1)) for k in range(1, LEVELS + 1)])


class Filter:
    """Bits in ``REGIONS`` regions. A key's region is its first byte; each of its levels sets
    ``PROBES`` bits there. A count of level k is the keys (n-gram, 1) to (n-gram, k)."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.region_bits = np.uint64(len(bits) * 8 // REGIONS)

    @staticmethod
    def places(keys: np.ndarray, level: int, region_bits: np.uint64) -> Iterator[np.ndarray]:
        """The bits of a level within the region, one array for each probe."""
        one = mixed(keys + np.uint64(level * int(START) % (1 << 64)))
        two = mixed(one) | np.uint64(1)
        for probe in range(PROBES):
            yield (one + np.uint64(probe) * two) % region_bits

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Probe level after level, as long as every bit of the level is set."""
        found = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        for level in range(1, LEVELS + 1):
            own = keys[alive]
            base = (own >> np.uint64(56)) * self.region_bits
            hit = np.ones(len(own), bool)
            for at in self.places(own, level, self.region_bits):
                at = at + base
                hit &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            alive = alive[hit]
            if not len(alive):
                break
            found[alive] = level
        return found


def narrow(steps: np.ndarray) -> bytes:
    """Steps between sorted keys in as few bytes each as the largest needs; the first byte says how many."""
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def widen(packed: bytes) -> np.ndarray:
    low = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, packed[0])
    whole = np.zeros((len(low), 8), np.uint8)
    whole[:, : packed[0]] = low
    return whole.view("<u8").ravel()


def _sized(keys: int, most_bits: int) -> int:
    """A power of two of at least sixteen bits for each expected key, within the bound."""
    return max(1 << 16, min(most_bits, 1 << max(0, 16 * keys - 1).bit_length()))


def build_filter(texts: DataFrame, tokens: int, most_bits: int) -> np.ndarray:
    """The filter over the adjacent words of all ``_text`` rows, ``tokens`` of them at most.

    A task sends the distinct pairs of each stretch of its texts with their counts, packed
    by segment of the key space as steps between sorted keys. Segments are as many as it takes to hold about
    ``SEGMENT_KEYS`` keys each, so the work of one does not grow with the corpus. Each gives
    the bits of its region; only the regions, of a size bounded by ``most_bits``, meet on
    the driver.
    """
    bits = _sized(tokens, most_bits)
    region_bytes = bits // 8 // REGIONS
    deep = max(0, math.ceil(math.log2(max(1, tokens / SEGMENT_KEYS / REGIONS))))
    shift = np.uint64(56 - deep)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def sent(held):
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            segment = (keys >> shift).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1], [True])))
            spans = list(zip(cuts, cuts[1:]))
            steps = [np.diff(keys[a:b], prepend=keys[a]) for a, b in spans]
            often = [np.flatnonzero(counts[a:b] > 1) for a, b in spans]
            return pd.DataFrame({
                "_segment": segment[cuts[:-1]],
                "_first": keys[cuts[:-1]].view(np.int64),
                "_steps": [narrow(x) for x in steps],
                "_often": [o.astype(np.int32).tobytes() for o in often],
                "_counts": [counts[a:b][o].astype(np.int32).tobytes() for (a, b), o in zip(spans, often)],
            })

        held, size = [], 0
        for batch in batches:
            for text in batch["_text"]:
                held.append(pair_keys([*lower_words(text), END]))
                size += len(held[-1])
                if size >= PACKED_TOKENS:
                    yield sent(held)
                    held, size = [], 0
        if held:
            yield sent(held)

    def set_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def region(segment, held):
            keys = np.concatenate([k for k, _ in held])
            each = np.concatenate([c for _, c in held])
            keys, where = np.unique(keys, return_inverse=True)
            level = level_of(np.bincount(where, weights=each))
            own = np.zeros(region_bytes * 8, bool)
            for k in range(1, int(level.max()) + 1):
                for at in Filter.places(keys[level >= k], k, np.uint64(region_bytes * 8)):
                    own[at] = True
            return pd.DataFrame({"_region": [int(segment) >> deep], "_bits": [np.packbits(own, bitorder="little").tobytes()]})

        at, held = None, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if held and row[0] != at:
                    yield region(at, held)
                    held = []
                at = row[0]
                keys = np.cumsum(widen(row[2]), dtype=np.uint64) + np.uint64(row[1] % (1 << 64))
                counts = np.ones(len(keys))
                counts[np.frombuffer(row[3], np.int32)] = np.frombuffer(row[4], np.int32)
                held.append((keys, counts))
        if held:
            yield region(at, held)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, own = None, None
        for batch in batches:
            for number, bits in batch.itertuples(index=False):
                if number != at:
                    if own is not None:
                        yield pd.DataFrame({"_region": [at], "_bits": [own.tobytes()]})
                    at, own = number, np.zeros(region_bytes, np.uint8)
                own |= np.frombuffer(bits, np.uint8)
        if own is not None:
            yield pd.DataFrame({"_region": [at], "_bits": [own.tobytes()]})

    packed = texts.select("_text").mapInPandas(pack, "_segment long, _first long, _steps binary, _often binary, _counts binary")
    regions = packed.repartition("_segment").sortWithinPartitions("_segment").mapInPandas(set_bits, "_region long, _bits binary")
    if deep:
        regions = regions.repartition("_region").sortWithinPartitions("_region").mapInPandas(merge, "_region long, _bits binary")
    found = np.zeros(bits // 8, np.uint8)
    for row in regions.toLocalIterator():
        at = row["_region"] * region_bytes
        found[at : at + region_bytes] |= np.frombuffer(row["_bits"], np.uint8)
    return found


def _block_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct words of each block, and how often its training texts have them."""

    def sent(block, counts):
        return pd.DataFrame({"_block": block, "_word": list(counts), "_count": list(counts.values())})

    at, counts = None, {}
    for batch in batches:
        for block, train, text in batch[["_block", "_train", "_text"]].itertuples(index=False):
            if counts and block != at:
                yield sent(at, counts)
                counts = {}
            at = block
            step = int(train)
            get = counts.get
            for word in [*lower_words(text), END]:
                counts[word] = get(word, 0) + step
    if counts:
        yield sent(at, counts)


def scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    prior: float = PRIOR,
    most_filter_bits: int = MOST_FILTER_BITS,
) -> DataFrame:
    """One row per row of ``docs`` with the counts and log10 probabilities of its whole text.

    Columns: ``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``. Texts whose crc32 of the identifier leaves a remainder by ``folds`` train.

    The base is exact. Texts are dealt into blocks by a hash; a block looks up the corpus
    counts of its distinct words in one join, so a word is a row per block, not per use.
    The model adds what word pairs say: p(w|h) = (c(h,w) + prior * p(w)) / (c(h) + prior),
    where c(h,w) comes from probing a Bloom filter broadcast to the workers, level after
    level of its logarithm. The filter has at most ``most_filter_bits``; as the corpus
    outgrows them, more pairs seem seen than were. No pair counts more than its words.

    Null and empty texts are the end token alone. Repeated rows are scored (and learnt) each
    time. A null identifier counts as empty text in the split. With no training texts every
    token has the base's share of an empty corpus. An empty table gives no rows, and other
    columns take no part.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    train = (crc_bucket(id_col, folds) != 0).alias("_train")
    texts = docs.select(F.col(id_col).alias("_id"), train, text_of(text_col).alias("_text"))
    spaces = F.length("_text") - F.length(F.translate("_text", " \t\n\x0b\f\r", ""))
    size = texts.agg(
        F.sum(F.length("_text") + 1).alias("chars"),
        F.sum(F.when(F.col("_train"), spaces + 2)).alias("tokens"),
        F.sum(F.col("_train").cast("long")).alias("rows"),
    ).first()
    blocks = max(1, math.ceil((size["chars"] or 0) / BLOCK_CHARS))
    pairs = spark.sparkContext.broadcast(build_filter(texts.where("_train"), size["tokens"] or 0, most_filter_bits))

    block = F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)).cast("int").alias("_block")
    dealt = texts.select(block, "_id", "_train", "_text").repartition("_block")
    words = stored(
        dealt.sortWithinPartitions("_block").mapInPandas(_block_words, "_block int, _word binary, _count long"), "words"
    )
    counts = stored(words.groupBy("_word").agg(F.sum("_count").alias("_all")), "counts")
    whole = counts.agg(F.coalesce(F.sum("_all"), F.lit(0)).alias("n"), F.count_if(F.col("_all") > 0).alias("v")).first()
    tokens, distinct, starts = int(whole["n"]), int(whole["v"]), int(size["rows"] or 0)
    looked_up = words.select("_block", "_word").join(counts, "_word").where("_all > 0")

    def score(key, texts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        held = dict(zip(known["_word"], known["_all"])).get
        counts, pairs_met = [], []
        for text in texts["_text"]:
            words = [*lower_words(text), END]
            counts.append(np.fromiter((held(w, 0) for w in words), np.float64, len(words)))
            pairs_met.append(pair_keys(words))
        ends = np.cumsum([len(c) for c in counts])
        count = np.concatenate(counts)
        keys, where = np.unique(np.concatenate(pairs_met), return_inverse=True)
        del held, counts, pairs_met
        pair = VALUES[Filter(pairs.value).levels(keys)][where]
        begins = np.concatenate(([0], ends[:-1]))
        before = np.concatenate(([0.0], count[:-1]))
        before[begins] = starts
        alone = (count + SMOOTH) / (tokens + SMOOTH * (distinct + 1))
        both = (np.minimum(np.minimum(pair, before), count) + prior * alone) / (before + prior)
        return pd.DataFrame({
            "_id": texts["_id"],
            "held_out": ~texts["_train"],
            "n_tokens": np.diff(ends, prepend=0),
            "n_known": np.add.reduceat((count > 0).astype(np.int64), begins),
            "train_tokens": tokens,
            "base_score": np.add.reduceat(np.log10(alone), begins),
            "score": np.add.reduceat(np.log10(both), begins),
        })

    schema = f"_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = dealt.groupBy("_block").cogroup(looked_up.groupBy("_block")).applyInPandas(score, schema)
    return scored.withColumnRenamed("_id", id_col)
