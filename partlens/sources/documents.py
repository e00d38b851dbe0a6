"""JSON documents of a catalog as rows."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The document types that form a catalog.
TYPES = ("Catalog", "Collection", "Feature")

LINK = "array<struct<rel:string,href:string,type:string,title:string,latest:boolean>>"
ASSETS = "map<string,struct<href:string,type:string,roles:array<string>,title:string>>"


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """(path, raw, doc) of every JSON file below ``root``, hidden and style files left out.

    ``path`` is relative to the root; ``doc`` is null where the text is not JSON.
    """
    base = re.sub("^file:/+", "/", root.rstrip("/"))
    if "://" not in base:
        base = os.path.abspath(base)
    # File paths come as encoded addresses; a plus sign stands for itself in them.
    address = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    full = F.regexp_replace(address, "^file:/+", "/")
    files = (
        spark.read.option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .text(base)
        .select(F.substring(full, F.lit(len(base) + 2), F.length(full)).alias("path"), F.col("value").alias("raw"))
    )
    parts = F.split("path", "/")
    hidden = F.exists(parts, lambda p: p.startswith("."))
    style = F.col("path").endswith(".style.json") | F.array_contains(parts, "styles")
    return files.where(~hidden & ~style).withColumn("doc", F.try_parse_json("raw"))


def nodes(documents: DataFrame) -> DataFrame:
    """(path, type, id, doc) of the documents that belong to a catalog."""
    kind = F.try_variant_get("doc", "$.type", "string")
    return documents.select(
        "path", kind.alias("type"), F.try_variant_get("doc", "$.id", "string").alias("id"), "doc"
    ).where(F.col("type").isin(*TYPES))


def malformed(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("doc").isNull()).select(
        F.lit("error").alias("severity"), F.lit("invalid JSON").alias("rule_id"), "path",
        F.lit("the file is not JSON").alias("message"),
    )


def misshapen(node_rows: DataFrame) -> DataFrame:
    """A finding for every field of links or assets that is there and is not of their form."""
    def wrong(field: str, form: str):
        there = F.try_variant_get("doc", f"$.{field}", "variant")
        bad = there.isNotNull() & ~F.is_variant_null(there) & F.try_variant_get("doc", f"$.{field}", form).isNull()
        return F.when(bad, F.lit(field))

    found = F.array_compact(F.array(wrong("links", LINK), wrong("assets", ASSETS)))
    return node_rows.select("path", F.explode(found).alias("field")).select(
        F.lit("error").alias("severity"), F.lit("misshapen field").alias("rule_id"), "path",
        F.concat("field", F.lit(" is not of its form")).alias("message"),
    )


def links(node_rows: DataFrame) -> DataFrame:
    """(path, position, rel, href, type, title, latest), one row per link."""
    parsed = F.try_variant_get("doc", "$.links", LINK)
    # The outer form spares a test for empty lists that would convert every list twice.
    rows = node_rows.select("path", F.posexplode_outer(parsed).alias("position", "_l"))
    return rows.where(F.col("position").isNotNull()).select("path", "position", "_l.*")


def assets(node_rows: DataFrame) -> DataFrame:
    """(path, key, href, type, roles, title), one row per asset."""
    parsed = F.try_variant_get("doc", "$.assets", ASSETS)
    rows = node_rows.select("path", F.explode_outer(parsed).alias("key", "_a"))
    return rows.where(F.col("key").isNotNull()).select("path", "key", "_a.*")
