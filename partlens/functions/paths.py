"""Path, link-target and address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of data files that may be kept outside a published catalog.
DATA_SUFFIXES = (
    ".parquet",
    ".pmtiles",
    ".tif",
    ".tiff",
    ".copc.laz",
    ".laz",
    ".gpkg",
    ".zarr",
    ".geojsonl",
    ".shp",
    ".zip",
)


def is_remote(href: Column) -> Column:
    return href.contains("://") | href.startswith("#") | href.startswith("mailto:")


def is_web(href: Column) -> Column:
    return href.startswith("http://") | href.startswith("https://")


def is_data_file(href: Column) -> Column:
    ending = "|".join(s.replace(".", r"\.") for s in DATA_SUFFIXES)
    return F.lower(href).rlike(f"({ending})$")


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, r"[^/]*$", "")


def resolve(base_file: Column, href: Column) -> Column:
    """A relative target seen from the folder of ``base_file``, dots collapsed.

    A target that climbs above the root keeps its leading "..", and so matches no
    path of the catalog.
    """
    steps = F.split(F.concat(parent_dir(base_file), href), "/")

    def step(done: Column, part: Column) -> Column:
        climbs = (F.size(done) > 0) & (F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("..")) != "..")
        return (
            F.when(part.isin("", "."), done)
            .when((part == "..") & climbs, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.concat(done, F.array(part)))
        )

    start = F.array().cast("array<string>")
    return F.array_join(F.aggregate(steps, start, step), "/")


def theme_of(key: Column) -> Column:
    return F.substring_index(key, "/", 1)


def type_of(key: Column) -> Column:
    """Everything after the first slash."""
    return F.regexp_replace(key, "^[^/]*/", "")


def slug(key: Column) -> Column:
    return F.translate(key, "/", "-")


def folder_name(url: Column) -> Column:
    """The last folder of a url: its last segment but one."""
    return F.try_element_at(F.split(F.rtrim(url, F.lit("/")), "/"), F.lit(-2))


def host_of(url: Column) -> Column:
    """The host and port of a url; null when it names none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.nullif(host, F.lit(""))


def object_address(href: Column, bucket: str) -> Column:
    """The s3:// address behind an https one; null for any other host."""
    rest = F.regexp_extract(href, r"\.amazonaws\.com/(.*)$", 1)
    return F.when(
        href.contains(".amazonaws.com/"), F.concat(F.lit(f"s3://{bucket}/"), rest)
    )
