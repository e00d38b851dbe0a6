"""From raw documents to packed training batches: five stages, each over all that the one before kept.

A stage keeps the columns of its documents whatever they are called, and nulls in them. The
last one returns each piece's identifier, place and words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partlens.llm import exact, packing, quality, simhash, substrings
from partlens.llm.common import columns_of, free_names, stored, text_of


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    score = quality.scorer(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(score(text_of("text")) >= 0.5)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest identifier."""
    return exact.without_copies(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest identifier."""
    (name,) = free_names(docs, "_first")
    found = simhash.near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = found.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages that an earlier document has; a document with nothing else left goes.

    Texts that lose nothing stay as they are; of others the kept words stay, a space between.
    """
    number, key, kept = free_names(docs, "_number", "_key", "_kept")
    found = substrings.without_repeats(docs).where("n_removed > 0")
    changed = found.select(F.col("doc_id").alias(number), F.col("text_key").alias(key), F.col("kept_text").alias(kept)).distinct()
    joined = docs.join(changed, (F.col("doc_id") == F.col(number)) & (F.xxhash64(text_of("text")) == F.col(key)), "left")
    joined = joined.where(F.col(kept).isNull() | (F.col(kept) != ""))
    text = F.coalesce(kept, "text")
    now = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return joined.select(*[now[name].alias(name) if name in now else column for name, column in zip(docs.columns, columns_of(docs))])


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its words and its place in a batch of like lengths."""
    return packing.batches(docs, content=True)


STAGES = [
    ("quality classifier", good),
    ("exact dedup", distinct),
    ("simhash near dedup", unlike),
    ("substring dedup", unrepeated),
    ("packing", batches),
]

# A trained model, links over fingerprints and dynamic programming: not in SQL. tests/llm/test_pipeline.py has the plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs


QUERIES = {"pipeline": run}
CHECKS = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
