"""Feature-table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partlens.functions.boxes import Box
from partlens.operators.spatial import Scope, any_window, prune_parts


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """Every part of a table; folders named key=value become columns."""
    return spark.read.parquet(path)


def scan_part(spark: SparkSession, part: str) -> DataFrame:
    """One part by its exact address."""
    return spark.read.parquet(part)


def scan_parts(spark: SparkSession, base: str, parts: Sequence[str]) -> DataFrame:
    """A list of parts of one table, partition columns kept."""
    return spark.read.option("basePath", base).parquet(*parts)


def scan_windows(
    spark: SparkSession, base: str, manifest: DataFrame, windows: Sequence[Box], bbox: str = "bbox"
) -> DataFrame:
    """The rows inside any window, opening only the parts the manifest does not rule out.

    ``manifest`` is (href, bbox). Its kept addresses come back to the driver, where the
    scan's own file list lives in any case.
    """
    kept = windows and [r["href"] for r in prune_parts(manifest, windows).select("href").distinct().toLocalIterator()]
    if not kept or not windows:
        return scan_table(spark, base).where(F.lit(False))
    return scan_parts(spark, base, sorted(kept)).where(any_window(bbox, windows))


def scan_scope(spark: SparkSession, base: str, manifest: DataFrame, scope: Scope, bbox: str = "bbox") -> DataFrame:
    """What a profile of this scope has to read: the whole table, or the parts its windows meet."""
    if scope.exhaustive:
        return scan_table(spark, base)
    return scan_windows(spark, base, manifest, scope.windows, bbox)


def group_count(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Rows per key in key order; a limit is taken after the order."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(key)
    return counted if limit is None else counted.limit(limit)
