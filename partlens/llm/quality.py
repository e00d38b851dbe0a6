"""A quality classifier: naive Bayes log-count ratios under a linear hinge-loss model."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partlens.llm.common import bounded_batches, crc_bucket, stored, text_of, words_of

FEATURE_BITS = 18
MOST_ROWS = 20_000
COST = 10.0
ROUNDS = 12
SMOOTH = 1.0
SHAPES = 200_000
SIGNS = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b for b in range(256)
)
LETTER_RUN = re.compile(rb"([Aa0])\1+")
PUNCTUATION_RUN = re.compile(rb"([^Aa0])\1{3,}")
MASK = (1 << FEATURE_BITS) - 1
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

def shape(word: bytes) -> bytes:
    """Runs of capitals, other letters and digits as one sign each; punctuation stays, runs cut to three."""
    return PUNCTUATION_RUN.sub(rb"\1\1\1", LETTER_RUN.sub(rb"\1", word.translate(SIGNS)))


class _Known(dict):
    """The hashes of a word's shape and of its lower-case form, side by side, for words met lately."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= SHAPES:
            self.clear()
        found = xxhash.xxh64_intdigest(shape(word)).to_bytes(8, "little") + xxhash.xxh64_intdigest(word.lower()).to_bytes(8, "little")
        if len(word) <= 64:
            self[word] = found
        return found


_known = _Known()


def _repeats(own: np.ndarray) -> np.ndarray:
    """Indicators of how much repeats: for runs of one, two and eight words a mark for each
    tenth that the share of distinct runs stays below, and one for neighbours that are equal."""
    marks = []
    for width in (1, 2, 8):
        if len(own) < 2 * width:
            break
        runs = own[: len(own) - width + 1].copy()
        for k in range(1, width):
            runs = runs * ODD[2] + own[k : len(own) - width + 1 + k]
        share = len(np.unique(runs)) / len(runs)
        size = min(5, int(np.log10(len(runs)) * 2))
        marks += [1000 * width + 20 * size + tenth for tenth in range(1, 11) if share < tenth / 10]
        marks.append(1000 * width + 200 + size)
    marks.append(100 + int((own[1:] == own[:-1]).any()))
    return np.array(marks, np.uint64)


def features(text: str) -> np.ndarray:
    """The hashed indicators of a whole text, each once: n-grams of one to three word shapes,
    single words, and how much of the text repeats, whatever the language."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.int32)
    pairs = np.frombuffer(b"".join([_known[w] for w in words]), np.uint64)
    look, own = pairs[::2], pairs[1::2]
    grams = [look * ODD[0], own * ODD[1], _repeats(own) * ODD[0]]
    if len(words) > 1:
        two = look[:-1] * ODD[1] + look[1:]
        grams.append(two * ODD[2])
    if len(words) > 2:
        grams.append((two[:-1] * ODD[0] + look[2:]) * ODD[1])
    mixed = np.concatenate(grams)
    mixed ^= mixed >> np.uint64(32)
    mixed *= ODD[1]
    return np.unique(mixed >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


def ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """For each indicator the log of its share among the good rows over its share among the others."""
    counts = []
    for label in (1, 0):
        own = [r for r, y in zip(rows, labels) if y == label]
        joined = np.concatenate(own) if own else np.zeros(0, np.int32)
        count = np.bincount(joined, minlength=MASK + 1) + SMOOTH
        counts.append(count / count.sum())
    return np.log(counts[0] / counts[1])


def descend(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, costs: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights of the hinge-loss model, by dual coordinate descent.

    One row at a time, in an order dealt anew each round from a fixed seed: the row's dual
    variable moves to where the others leave it best, between zero and the row's cost.
    The last weight is that of a constant input, the intercept.
    """
    weights, bias = np.zeros(MASK + 1), 0.0
    dual = np.zeros(len(rows))
    norms = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            row, value, sign = rows[i], values[i], signs[i]
            slope = sign * (weights[row] @ value + bias) - 1.0
            new = min(max(dual[i] - slope / norms[i], 0.0), costs[i])
            step = (new - dual[i]) * sign
            if step:
                dual[i] = new
                weights[row] += step * value
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def scaled(row: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The ratios of a row's indicators, as a vector of length one."""
    value = ratio[row]
    length = np.sqrt(value @ value)
    return value / length if length else value


def fit(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(ratios, weights, intercept). Rows of the rarer label cost as much in all as the others."""
    ratio = ratios(rows, labels)
    signs = np.where(labels == 1, 1.0, -1.0)
    alike = np.where(labels == 1, (labels == 1).sum(), (labels != 1).sum())
    weights, bias = descend(rows, [scaled(r, ratio) for r in rows], signs, COST * len(labels) / np.maximum(alike, 1))
    return ratio, weights, bias


def sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, folds: int, held: int, most_rows: int) -> DataFrame:
    """(id, label) of the rows to learn from: at most ``most_rows``, in the order of a hash of the identifier.

    A row is labelled if all its labels agree on 0 or 1, and only if it is not held out.
    """
    known = labels.where((crc_bucket(id_col, folds) != held) & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    agreed = known.groupBy(id_col).agg(F.min(label_col).alias("_label"), F.max(label_col).alias("_most")).where("_label = _most")
    return agreed.orderBy(F.xxhash64(id_col), id_col).limit(most_rows).select(F.col(id_col).alias("_id"), F.col("_label").cast("int").alias("_label"))


def scored(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 3,
    held: int = 1,
    most_rows: int = MOST_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    The model is learnt from at most ``most_rows`` labelled rows whose crc32 of the identifier
    does not leave ``held`` by ``folds``. Their identifiers are sent to the tasks, which bring
    back hashed indicators only; log-count ratios and the hinge-loss weights are fitted on
    those and sent to the tasks that score every whole text. The score follows the text alone.
    Should an identifier have many rows, ``most_rows`` bounds the rows as well, again by hashes.

    Null and empty texts have no indicator and the score of the intercept. Rows of a labelled
    document count once for each text that they hold. A null identifier is never learnt from. Without labelled
    rows every score is 0.5. Labels that contradict each other are left out. An empty table
    gives no rows, and other columns take no part.
    """
    score = scorer(docs, labels, id_col, text_col, label_col, folds, held, most_rows)
    found = docs.select(F.col(id_col), (crc_bucket(id_col, folds) == held).alias("held_out"), score(text_of(text_col)).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def scorer(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 3,
    held: int = 1,
    most_rows: int = MOST_ROWS,
) -> Callable[[Column], Column]:
    """Learn from the labelled rows; a function from a text column to a score column."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()

    def indicators(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t).tobytes() for t in batch["_text"]]
            yield pd.DataFrame({"_id": batch["_id"], "_mark": batch["_mark"], "_label": batch["_label"], "_found": found})

    # At most ``most_rows`` pairs of numbers, so the hint has a bound.
    chosen = F.broadcast(sample(docs, labels, id_col, label_col, folds, held, most_rows))
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    labelled = texts.join(chosen, "_id").select("_id", F.xxhash64("_text").alias("_mark"), "_label", "_text")
    marked = labelled.mapInPandas(indicators, f"_id {kind}, _mark long, _label int, _found binary")
    learnt = stored(marked.groupBy("_id", "_mark").agg(F.max("_label").alias("_label"), F.max("_found").alias("_found")), "indicators")
    first = learnt.select("_id", "_mark").orderBy(F.xxhash64("_id"), "_id", "_mark").limit(most_rows)
    got = sorted(learnt.join(F.broadcast(first), ["_id", "_mark"]).collect(), key=lambda r: (r["_id"], bytes(r["_found"])))
    rows = [np.frombuffer(r["_found"], np.int32) for r in got]
    model = spark.sparkContext.broadcast(fit(rows, np.array([r["_label"] for r in got], np.int64)))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ratio, weights, bias = model.value
        for texts in batches:
            margin = np.zeros(len(texts))
            for at, text in enumerate(texts):
                row = features(text)
                margin[at] = weights[row] @ scaled(row, ratio) + bias
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(2.0 * margin, -700, 700))))

    return score
