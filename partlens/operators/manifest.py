"""Summaries and published records made from the part manifest and its collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partlens.functions.boxes import clamp_bbox
from partlens.functions.paths import object_address, slug, theme_of, type_of
from partlens.functions.text import human_title, plural, release_timestamp, thousands, title_from_slug
from partlens.session import literal_rows

ROW_GROUP_CAP = 150_000
PARQUET_TYPE = "application/vnd.apache.parquet"


def with_object_address(parts: DataFrame, bucket: str) -> DataFrame:
    return parts.withColumn("s3", object_address(F.col("href"), bucket))


def collection_summary(parts: DataFrame) -> DataFrame:
    """Parts, rows, row-group range and geometry types per collection.

    The geometry format knows a handful of type names, so their set stays small.
    """
    return parts.groupBy("collection").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("rows").alias("rows"),
        F.min("row_groups").alias("min_row_groups"),
        F.max("row_groups").alias("max_row_groups"),
        F.max("max_row_group_rows").alias("max_row_group_rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("geometry_types")))).alias("geometry_types"),
    )


def geometry_kinds(parts: DataFrame) -> DataFrame:
    """Polygon, line and point flags per collection; polygon when no type is known."""

    def has(test):
        return F.max(F.coalesce(F.exists("geometry_types", test), F.lit(False)))

    line = lambda g: g.contains("LineString") & ~g.contains("Polygon")
    flags = parts.groupBy("collection").agg(
        has(lambda g: g.contains("Polygon")).alias("polygon"),
        has(line).alias("line"),
        has(lambda g: g.contains("Point") & ~g.contains("Polygon") & ~g.contains("LineString")).alias("point"),
    )
    none = ~(F.col("polygon") | F.col("line") | F.col("point"))
    return flags.withColumn("polygon", F.col("polygon") | none)


def fingerprint(collections: DataFrame, parts: DataFrame, release: str, cap: int = ROW_GROUP_CAP) -> DataFrame:
    """What a release states per collection: part count, licence, versions, largest row group.

    A collection that has lost its parts stays, with a part count of 0.
    """
    facts = parts.groupBy("collection").agg(
        F.count(F.lit(1)).alias("items"),
        F.sort_array(F.collect_set("geoparquet_version")).alias("geoparquet"),
        F.max("max_row_group_rows").alias("max_row_group_rows"),
    )
    return collections.select("collection", "columns", "license").join(facts, "collection", "left").select(
        F.lit(release).alias("release"),
        "collection",
        "columns",
        F.coalesce("items", F.lit(0)).alias("items"),
        "license",
        F.coalesce("geoparquet", F.array().cast("array<string>")).alias("geoparquet"),
        "max_row_group_rows",
        F.lit(cap).cast("bigint").alias("row_group_cap"),
    )


def theme_rollup(collections: DataFrame) -> DataFrame:
    """Collections, parts and rows per theme plus the grand total, where theme is null."""
    return (
        collections.withColumn("theme", theme_of(F.col("collection")))
        .rollup("theme")
        .agg(
            F.count(F.lit(1)).alias("collections"),
            F.sum("parts").alias("parts"),
            F.sum("rows").alias("rows"),
        )
    )


def licence_groups(collections: DataFrame) -> DataFrame:
    """Every licence with its collections, one row each, and the size of the group."""
    sizes = collections.groupBy("license").agg(F.count(F.lit(1)).alias("collections"))
    return collections.select("license", "collection").join(sizes, "license")


def parts_per_collection(nodes: DataFrame, links: DataFrame, assets: DataFrame) -> DataFrame:
    """Item links per collection; one when it links none but holds the data itself.

    A collection with neither has nothing to read and carries an error.
    """
    linked = links.where(F.col("rel") == "item").groupBy("path").agg(F.count(F.lit(1)).alias("linked"))
    own = assets.where(F.col("key") == "data").select("path").distinct().withColumn("own", F.lit(1))
    counted = (
        nodes.where(F.col("type") == "Collection")
        .select("path")
        .join(linked, "path", "left")
        .join(own, "path", "left")
    )
    name = F.regexp_replace("path", "/[^/]*$", "")
    parts = F.coalesce("linked", "own", F.lit(0)).cast("bigint")
    return counted.select(
        name.alias("collection"),
        slug(name).alias("slug"),
        parts.alias("parts"),
        F.when(parts == 0, "no item link and no data asset").alias("error"),
    )


def longest_first(collections: DataFrame) -> DataFrame:
    return collections.orderBy(F.desc("parts"), "collection")


def collection_records(
    collections: DataFrame, release: str, mixed_themes: Sequence[str] = ()
) -> DataFrame:
    """Published facts of a collection: title, licence, held extent and release stamp."""
    theme = theme_of(F.col("collection"))
    kind = type_of(F.col("collection"))
    mixed = theme.isin(*mixed_themes) if mixed_themes else F.lit(False)
    return collections.select(
        "collection",
        theme.alias("theme"),
        kind.alias("type"),
        human_title(F.col("title"), kind).alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.when(mixed, F.lit("other")).otherwise(F.col("license")).alias("license"),
        clamp_bbox(F.col("bbox")).alias("bbox"),
        F.lit(release_literal(release)).alias("updated"),
        mixed.alias("licence_link"),
    )


def release_literal(release: str) -> str:
    return f"{release[:10]}T00:00:00Z"


def _data_asset() -> Column:
    """The asset of one part, from its ``part_id``, ``href`` and ``s3``."""
    return F.struct(
        F.col("href").alias("href"),
        F.lit(PARQUET_TYPE).alias("type"),
        F.array(F.lit("data")).alias("roles"),
        F.concat(F.lit("GeoParquet part "), "part_id").alias("title"),
        F.struct(
            F.struct(F.col("s3").alias("href"), F.lit("Object store, no credentials needed").alias("title")).alias("s3")
        ).alias("alternate"),
    )


def _link(rel: str, href: str) -> Column:
    return F.struct(F.lit(rel).alias("rel"), F.lit(href).alias("href"), F.lit("application/json").alias("type"))


def _texts(values: Sequence[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def collection_documents(
    records: DataFrame, columns: DataFrame, parts: DataFrame, extensions: Sequence[str] = ()
) -> DataFrame:
    """One collection document per record, as a struct ready for a JSON sink.

    ``records`` come from :func:`collection_records`, ``columns`` are (collection, position,
    column, description) and ``parts`` (collection, part_id, href, s3). A collection of one
    part holds the data itself, as an asset. Links to items are rows of their own (see
    :func:`single_part_rule`): there may be any number.
    """
    # A table has a schema's worth of columns.
    ordered = F.array_sort(F.collect_list(F.struct("position", "column", "description")))
    listed = columns.groupBy("collection").agg(ordered.alias("_columns"))
    held = parts.groupBy("collection").agg(F.count(F.lit(1)).alias("_parts"), F.min(F.struct("part_id", "href", "s3")).alias("_only"))
    only = held.where(F.col("_parts") == 1).select("collection", "_only.*").withColumn("_data", _data_asset()).select("collection", "_data")
    named = F.transform(
        F.coalesce("_columns", F.array().cast("array<struct<position:int,column:string,description:string>>")),
        lambda c: F.struct(c["column"].alias("name"), c["description"].alias("description")),
    )
    interval = F.array(F.array(F.col("updated"), F.lit(None).cast("string")))
    return (
        records.join(listed, "collection", "left")
        .join(only, "collection", "left")
        .select(
            "collection",
            F.concat("collection", F.lit("/collection.json")).alias("path"),
            F.struct(
                F.lit("Collection").alias("type"),
                F.lit("1.1.0").alias("stac_version"),
                _texts(sorted(extensions)).alias("stac_extensions"),
                F.col("type").alias("id"),
                "title",
                "description",
                "license",
                F.struct(
                    F.struct(F.array("bbox").alias("bbox")).alias("spatial"), F.struct(interval.alias("interval")).alias("temporal")
                ).alias("extent"),
                "updated",
                named.alias("table:columns"),
                F.struct(F.col("_data").alias("data")).alias("assets"),
                F.array(_link("root", "../../catalog.json"), _link("parent", "../catalog.json")).alias("links"),
            ).alias("doc"),
        )
    )


def item_records(parts: DataFrame, extensions: Sequence[str] = ()) -> DataFrame:
    """One item document per part, as a struct ready for a JSON sink.

    ``geometry`` of the part, a GeoJSON geometry as a struct, goes in as it is.
    """
    return parts.select(
        "collection",
        "part_id",
        F.concat("collection", F.lit("/items/"), "part_id", F.lit(".json")).alias("path"),
        F.struct(
            F.lit("Feature").alias("type"),
            F.lit("1.1.0").alias("stac_version"),
            _texts(extensions).alias("stac_extensions"),
            F.col("part_id").alias("id"),
            type_of(F.col("collection")).alias("collection"),
            clamp_bbox(F.col("bbox")).alias("bbox"),
            F.col("geometry"),
            F.struct(
                F.col("datetime").alias("datetime"), F.col("rows").alias("table:row_count")
            ).alias("properties"),
            F.struct(_data_asset().alias("data")).alias("assets"),
            F.array(
                _link("root", "../../../catalog.json"),
                _link("parent", "../collection.json"),
                _link("collection", "../collection.json"),
            ).alias("links"),
        ).alias("doc"),
    )


def single_part_rule(parts: DataFrame) -> DataFrame:
    """Where each part is published: on its collection when it is the only one, else as an item."""
    counts = parts.groupBy("collection").agg(F.count(F.lit(1)).alias("parts"))
    single = F.col("parts") == 1
    placed = parts.select("collection", "part_id", "rows").join(counts, "collection")
    return placed.select(
        "collection",
        "part_id",
        F.when(single, F.concat("collection", F.lit("/collection.json")))
        .otherwise(F.concat("collection", F.lit("/items/"), "part_id", F.lit(".json")))
        .alias("path"),
        F.when(single, "data asset").otherwise("item").alias("placed_as"),
        F.when(
            ~single,
            F.concat(F.lit("Part "), "part_id", F.lit(", "), thousands(F.col("rows")), F.lit(" rows")),
        ).alias("link_title"),
    )


def theme_records(collections: DataFrame, release: str) -> DataFrame:
    """One record per theme with the number of collections it lists."""
    split = collections.select(
        theme_of(F.col("collection")).alias("theme"), type_of(F.col("collection")).alias("type")
    ).distinct()
    return split.groupBy("theme").agg(F.count(F.lit(1)).alias("n")).select(
        "theme",
        title_from_slug(F.col("theme")).alias("title"),
        F.concat(F.lit("Holds "), plural(F.col("n"), "collection"), F.lit(".")).alias("description"),
        release_timestamp(F.lit(release)).alias("updated"),
    )


def child_links(collections: DataFrame) -> DataFrame:
    """The child links of the root and of every theme, one row each; sort by (path, href)."""
    theme, kind = theme_of(F.col("collection")), type_of(F.col("collection"))
    of_theme = collections.select(
        F.concat(theme, F.lit("/catalog.json")).alias("path"),
        F.concat(F.lit("./"), kind, F.lit("/collection.json")).alias("href"),
        title_from_slug(kind).alias("title"),
    )
    of_root = collections.select(
        F.lit("catalog.json").alias("path"),
        F.concat(F.lit("./"), theme, F.lit("/catalog.json")).alias("href"),
        title_from_slug(theme).alias("title"),
    )
    return of_theme.unionByName(of_root).distinct()


def select_keys(collections: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted collections; a key that names none is an error. No key selects all."""
    if not wanted:
        return collections
    listed = literal_rows(collections.sparkSession, [(w,) for w in sorted(set(wanted))], "collection string")
    unknown = listed.join(collections, "collection", "left_anti").orderBy("collection").take(1)
    if unknown:
        raise ValueError(f"unknown collection {unknown[0][0]!r}")
    return collections.where(F.col("collection").isin(*wanted))
