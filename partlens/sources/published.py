"""Published documents: what changed is written, and a version appears whole or not at all.

Below a path lie ``documents`` (key, json) by the run that wrote them, a manifest for each version
(key, digest, run), and one small file per version under ``versions`` that names its manifest. A version
counts from the moment that file is there. Documents and manifests that no such file
leads to, as of a job that died, are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partlens.session import literal_rows

MANIFEST = "key string, digest string, run string"
DOCUMENTS = "key string, json string, run string"


class Conflict(RuntimeError):
    """Another job published the next version first."""


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the published versions, in order."""
    folder, files = _files(spark, f"{path}/versions")
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    if not version:
        return literal_rows(spark, [], MANIFEST)
    name = spark.read.text(f"{path}/versions/{version:08d}").first()["value"]
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifests/{name}")


def _commit(spark: SparkSession, path: str, version: int, run: str) -> None:
    """Put the file of a version in place, in one step that fails if it is there already."""
    jvm = spark._jvm
    staged, files = _files(spark, f"{path}/staged/{run}")
    final, _ = _files(spark, f"{path}/versions/{version:08d}")
    files.mkdirs(final.getParent())
    out = files.create(staged, False)
    out.write(bytearray(run.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(staged), files.makeQualified(final), plain)
    except Exception as error:
        if files.exists(final):
            raise Conflict(f"version {version} was published by another job") from error
        raise


def publish(df: DataFrame, doc: str, key: str, path: str) -> int:
    """Publish the documents of ``df`` (struct ``doc`` under string ``key``) as the newest version; its number.

    The SHA-256 of every document is met with the last manifest. Documents that are new or
    changed are written, those that are missing leave the manifest, and where there are
    neither nothing is written and the number stays. An empty table publishes an empty
    version, if the last one held anything.

    Null or repeated keys are an error, as a document has one place. ``Conflict`` says that
    another job was first; publishing again then compares with what that one wrote.
    Brings back four counts.
    """
    spark = df.sparkSession
    held = versions(spark, path)
    last = held[-1] if held else 0
    before = _manifest(spark, path, last)
    made = df.select(F.col(key).cast("string").alias("key"), F.to_json(doc).alias("json")).withColumn("digest", F.sha2("json", 256))
    # Digests alone meet. A repeated key shows in its count, whatever its documents.
    now = made.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.max("digest").alias("digest"))
    old = before.select(F.col("key").alias("old_key"), F.col("digest").alias("old_digest"), "run")
    met = now.join(old, now["key"] == old["old_key"], "full_outer")
    new = F.col("times").isNotNull() & ~F.col("digest").eqNullSafe(F.col("old_digest"))
    seen = met.agg(
        F.count_if(F.col("times").isNotNull() & F.col("key").isNull()).alias("nulls"),
        F.count_if(F.col("times") > 1).alias("repeated"),
        F.count_if(new).alias("written"),
        F.count_if(F.col("times").isNull()).alias("gone"),
    ).first()
    if seen["nulls"] or seen["repeated"]:
        raise ValueError(f"{seen['nulls']} null and {seen['repeated']} repeated keys: a document has one place")
    if not seen["written"] and not seen["gone"]:
        return last
    run = uuid.uuid4().hex
    if seen["written"]:
        same = before.select("key", "digest")
        changed = made.join(same, ["key", "digest"], "left_anti").select("key", "json")
        changed.write.mode("errorifexists").parquet(f"{path}/documents/run={run}")
    kept = met.where(F.col("times").isNotNull()).select("key", "digest", F.when(new, F.lit(run)).otherwise(F.col("run")).alias("run"))
    kept.write.mode("errorifexists").parquet(f"{path}/manifests/{run}")
    _commit(spark, path, last + 1, run)
    return last + 1


def published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(key, json) of a version, the newest if none is given.

    Only runs that the manifest names are met; the partition column leaves other folders shut
    where Spark finds the manifest small.
    """
    held = versions(spark, path)
    if version is None:
        version = held[-1] if held else 0
    elif version not in held:
        raise ValueError(f"version {version} was not published")
    listed = _manifest(spark, path, version).select("key", "run")
    folder, files = _files(spark, f"{path}/documents")
    if not files.exists(folder):
        return literal_rows(spark, [], "key string, json string")
    return spark.read.schema(DOCUMENTS).parquet(f"{path}/documents").join(listed, ["key", "run"], "left_semi").select("key", "json")


def changes(spark: SparkSession, path: str, was: int, now: int) -> DataFrame:
    """(key, change) between two versions from their manifests alone: appeared, disappeared or changed."""
    a, b = (_manifest(spark, path, v).select("key", F.col("digest").alias(n)) for v, n in ((was, "was"), (now, "now")))
    change = F.when(F.col("was").isNull(), "appeared").when(F.col("now").isNull(), "disappeared").otherwise("changed")
    return a.join(b, "key", "full_outer").where(~F.col("was").eqNullSafe(F.col("now"))).select("key", change.alias("change"))
