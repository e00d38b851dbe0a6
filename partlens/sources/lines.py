"""Numbered lines of text files of any size, read in splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows of one task are numbered in the lower bits of monotonically_increasing_id.
IN_TASK = (1 << 33) - 1


def numbered_lines(spark: SparkSession, path: str, across: bool = False) -> DataFrame:
    """(file_id, line_no, text) of the text files at ``path``, lines counted from 1.

    A file is read by as many tasks as it has splits, and no task holds it whole. Within a
    split lines come in order, so a line's number is its place there after the lines of
    the splits before. The first reading counts lines per split, one row for each; the second
    looks the sum up. Lines are neither sorted nor shuffled.

    Lines end at a line feed only. A last line that ends so is followed by no empty line, where
    splitting a text would give one. An empty file has no lines. With ``across`` the count runs
    on from file to file in the order of their paths, as for one text written in many files.
    Files must not change between the readings.
    """
    read = spark.read.option("lineSep", "\n").text(path)
    placed = read.select(
        F.col("_metadata.file_path").alias("file_id"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(IN_TASK)).alias("place"),
        F.col("value").alias("text"),
    )
    splits = placed.groupBy("file_id", "block").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    summed = splits.withColumn("before", before)
    if across:
        # One row per file meets in one window: as many as the listing of the files holds.
        files = splits.groupBy("file_id").agg(F.sum("n").alias("n"))
        above = F.coalesce(F.sum("n").over(W.orderBy("file_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        summed = summed.join(files.select("file_id", above.alias("above")), "file_id").withColumn("before", F.col("before") + F.col("above"))
    offsets = summed.select("file_id", "block", (F.col("before") - F.col("first") + 1).alias("offset"))
    # A row per split, as the driver lists them to plan the scan.
    return placed.join(F.broadcast(offsets), ["file_id", "block"]).select(
        "file_id", (F.col("place") + F.col("offset")).alias("line_no"), "text"
    )
