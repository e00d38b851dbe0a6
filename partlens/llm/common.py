"""What several operators share: words, bounded batches, written tables, components."""

from __future__ import annotations

import re
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partlens.session import workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
BATCH_ROWS = 256


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Few rows in an Arrow batch, so that very long texts do not fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder, and read from there.

    Later steps start from the files, whoever computed them.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: str) -> list[bytes]:
    """The words of a text, in UTF-8. No byte of a longer character looks like white space."""
    return WORD_BYTES.findall(text.encode("utf-8", "surrogatepass"))


def lower_words(text: str) -> list[bytes]:
    """The words of a text with A-Z lower-cased, and no other letter."""
    return WORD_BYTES.findall(text.encode("utf-8", "surrogatepass").lower())


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever their names hold."""
    return [F.col(quoted(c)) for c in df.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many lines in front as make it no column of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def text_of(name: str) -> Column:
    """The text of a row, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_bucket(id_col: str, buckets: int) -> Column:
    """The remainder of crc32 of the identifier as text; a null identifier counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % buckets


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable from every node of an edge.

    Alternating large-star and small-star rounds: each round hangs neighbours on the
    smallest one they know, first those above a node, then those below it. The number of
    rounds follows the logarithm of the longest chain. Minima are combined before the
    shuffle, every round is written to the shared folder, and the loop ends when a round
    changes nothing.
    """
    hooks = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(),
        "links",
    )
    mark = _mark(hooks)
    while mark[0]:
        both = hooks.union(hooks.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), F.col("m")))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u > v")
            .distinct()
        )
        hooks = stored(small, "links")
        after = _mark(hooks)
        if after == mark:
            break
        mark = after
    roots = hooks.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return hooks.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _mark(hooks: DataFrame) -> tuple:
    """How many links there are and a sum over them, to see whether a round changed any."""
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(hooks.agg(F.count(F.lit(1)), F.coalesce(total, F.lit(0))).first())
