"""Profiles kept part by part: a release recounts only the parts that are new or changed.

Of every part are kept its rows, and of every column a bitmap of hashed values, a sketch of the
distinct ones and, where these are few, the counts of all values. All of it merges: bitmaps by
OR, sketches by union, counts by sum. A column above the limit in one part is above it in the
whole, so counts left out for a part are never wanted.

A store only grows. Facts of a part are found by its name and fingerprint, so those of an
earlier state are never met again; what a job that died wrote without its facts is never
read, as facts are written last.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partlens.operators import profile
from partlens.session import cut_lineage, literal_rows

FACTS = "part string, fingerprint string, run string, rows bigint, column string, present bigint, bits binary, sketch binary"
VALUES = "part string, fingerprint string, run string, column string, kind string, text string, number double, n bigint"


def file_parts(spark: SparkSession, folder: str) -> DataFrame:
    """(part, fingerprint) of the Parquet files below a folder: path, and size with time of writing.

    No content is read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(folder)
    return files.select(
        F.col("path").alias("part"), F.concat_ws("-", "length", F.unix_micros("modificationTime")).alias("fingerprint")
    )


def read_files(spark: SparkSession) -> Callable[[Sequence[str]], DataFrame]:
    """A reader of some of :func:`file_parts`: their rows with the file as ``part``."""
    return lambda paths: spark.read.parquet(*paths).withColumn("part", F.col("_metadata.file_path"))


@dataclass(frozen=True)
class Store:
    """Where the facts of parts are kept. ``kinds`` and ``rules`` must stay the same for one store."""

    spark: SparkSession
    path: str
    kinds: Mapping[str, str]
    rules: profile.Rules = profile.RULES

    @property
    def columns(self) -> list[str]:
        return [c for c, kind in self.kinds.items() if kind != profile.OTHER]

    def _table(self, name: str, schema: str) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return literal_rows(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    @property
    def facts(self) -> DataFrame:
        return self._table("facts", FACTS)

    @property
    def values(self) -> DataFrame:
        return self._table("values", VALUES)


def _distinct(column: str) -> Column:
    """A sketch of the distinct values, of whatever type the column has."""
    return F.hll_sketch_agg(F.xxhash64(F.col(column)))


def _slot(column: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.pmod(F.xxhash64(F.col(column)), F.lit(profile.BITMAP_SLOTS)))


def fresh_parts(store: Store, parts: DataFrame) -> DataFrame:
    """Parts (part, fingerprint) without facts."""
    return parts.select("part", "fingerprint").distinct().join(store.facts, ["part", "fingerprint"], "left_anti")


def update(store: Store, parts: DataFrame, read: Callable[[Sequence[str]], DataFrame]) -> list[str]:
    """Keep the facts of those ``parts`` that have none, and name the parts that were read.

    ``read`` returns the rows of the named parts with a column ``part``. A part without rows
    keeps facts that say so, and is not read again. Brings back the names of the new parts, which their scan
    holds in any case, and the names of few-valued columns.
    """
    fresh = cut_lineage(fresh_parts(store, parts), "fresh")
    names = sorted(r["part"] for r in fresh.collect())
    if not names:
        return names
    run, columns = uuid.uuid4().hex, store.columns
    rows = read(names)
    whole = rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count(F.col(c)).alias(f"p{i}") for i, c in enumerate(columns)),
        *(F.bitmap_construct_agg(_slot(c)).alias(f"b{i}") for i, c in enumerate(columns)),
        *(_distinct(c).alias(f"s{i}") for i, c in enumerate(columns)),
    )
    cells = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"), F.coalesce(f"p{i}", F.lit(0)).alias("present"),
                F.col(f"b{i}").alias("bits"), F.when(F.col(f"p{i}") > 0, F.col(f"s{i}")).alias("sketch"),
            )
            for i, c in enumerate(columns)
        )
    )
    # A row without a column says how many rows the part has, also where no column is profiled.
    none = F.array(F.struct(*(F.lit(None).cast(t).alias(n) for n, t in (("column", "string"), ("present", "bigint"), ("bits", "binary"), ("sketch", "binary")))))
    listed = fresh.join(whole, "part", "left").select(
        "part", "fingerprint", F.lit(run).alias("run"), F.coalesce("_rows", F.lit(0)).alias("rows"),
        F.inline(F.concat(none, cells) if columns else none),
    )
    facts = cut_lineage(listed, "facts")
    few = facts.where(F.bitmap_count("bits") <= store.rules.max_distinct).select("part", "column")
    wanted = sorted(r["column"] for r in few.select("column").distinct().collect())
    counted = (
        profile.unpivot(rows, ["part"], store.kinds, wanted)
        .groupBy("part", "slot", "text", "number")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kept = profile.name_slots(counted, store.kinds, wanted).join(few, ["part", "column"], "left_semi")
    of_run = kept.join(fresh, "part").withColumn("run", F.lit(run))
    of_run.select("part", "fingerprint", "run", "column", "kind", "text", "number", "n").write.mode("append").parquet(f"{store.path}/values")
    facts.write.mode("append").parquet(f"{store.path}/facts")
    return names


def merged(store: Store, parts: DataFrame) -> tuple[profile.Survey, DataFrame]:
    """The survey and the value counts of the given parts together, from what is kept.

    Two jobs that kept one part at once do not count it twice: the smaller run holds.
    Brings back one row per column.
    """
    facts = parts.select("part", "fingerprint").distinct().join(store.facts, ["part", "fingerprint"], "left")
    missing = facts.where(F.col("run").isNull())
    if not missing.isEmpty():
        raise ValueError(f"no facts are kept of some parts, such as {missing.first()['part']!r}: update the store first")
    valid = facts.groupBy("part", "fingerprint").agg(F.min("run").alias("run"))
    own = ["part", "fingerprint", "run"]
    by_column = (
        facts.join(valid, own, "left_semi")
        .groupBy("column")
        .agg(
            F.sum("rows").alias("rows"), F.sum("present").alias("present"),
            F.bitmap_count(F.bitmap_or_agg("bits")).alias("bits"),
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sketched"),
        )
        .collect()
    )
    held = {r["column"]: r for r in by_column}
    rows = held[None]["rows"] if None in held else 0
    seen = {c: held.get(c) for c in store.columns}
    few = [c for c, r in seen.items() if r is None or r["bits"] <= store.rules.max_distinct]
    sketched = {c: (r["sketched"] or 0) if r else 0 for c, r in seen.items()}
    counts = (
        store.values.join(valid, own, "left_semi")
        .where(F.col("column").isin(few))
        .groupBy("column", "kind", "text", "number")
        .agg(F.sum("n").alias("n"))
        .select(F.lit("all").alias("window"), "column", "kind", "text", "number", "n")
    )
    return profile.Survey(rows, few, sketched), counts


def kept_profile(
    store: Store, parts: DataFrame, read: Callable[[Sequence[str]], DataFrame], preferred: str | None = None
) -> profile.Profile:
    """The profile of a whole release; new and changed parts alone are read.

    Same stages as ``profile.profile`` over every row, and the same results but for
    ``distinct_sketch``, whose sketch is one that merges. ``sampled`` reads all parts once it is
    asked for, as confirming the values of a legend does.
    """
    update(store, parts, read)
    seen, counts = merged(store, parts)
    names = sorted(r["part"] for r in parts.select("part").distinct().collect())
    sampled = read(names).drop("part").withColumn("window", F.lit("all")) if names else literal_rows(store.spark, [], "window string")
    return profile.settle(sampled, dict(store.kinds), seen, cut_lineage(counts, "counts"), 1, store.rules, preferred)
