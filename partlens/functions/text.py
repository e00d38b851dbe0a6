"""Text, number-format and version expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy(text: Column) -> Column:
    """Every run of white space, of any script, becomes one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def version_of(text: Column) -> Column:
    """The first X.Y.Z in a text as struct(major, minor, patch); null when none."""
    pattern = r"(\d+)\.(\d+)\.(\d+)"
    part = [F.regexp_extract(text, pattern, i).try_cast("bigint") for i in (1, 2, 3)]
    return F.when(
        part[2].isNotNull(),
        F.struct(part[0].alias("major"), part[1].alias("minor"), part[2].alias("patch")),
    )


def version_literal(major: int, minor: int, patch: int) -> Column:
    return F.struct(
        F.lit(major).cast("bigint").alias("major"),
        F.lit(minor).cast("bigint").alias("minor"),
        F.lit(patch).cast("bigint").alias("patch"),
    )


def version_within(
    version: Column, low: tuple[int, int, int], high: tuple[int, int, int]
) -> Column:
    """low <= version < high, part by part."""
    return (version >= version_literal(*low)) & (version < version_literal(*high))


def is_final_version(name: Column) -> Column:
    return name.rlike(r"^\d+\.\d+\.\d+$")


def title_from_slug(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("_"), F.lit(" ")))


def human_title(upstream: Column, slug: Column) -> Column:
    """The given title, unless it is missing or only repeats the slug."""
    words = F.lower(F.replace(slug, F.lit("_"), F.lit(" ")))
    given = F.lower(F.trim(F.replace(upstream, F.lit("_"), F.lit(" "))))
    repeats = F.coalesce(upstream, F.lit("")).eqNullSafe("") | (given == words)
    return F.when(repeats, title_from_slug(slug)).otherwise(upstream)


def pairs_to_map(text: Column) -> Column:
    """"a:1 b:2" as a map; a pair splits on its first colon only.

    A key given again takes the later value. A pair without a colon is an error.
    """
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    wrong = lambda w: F.raise_error(F.concat(F.lit("no colon in the pair "), w)).cast("string")
    pairs = F.transform(
        words,
        lambda w: F.struct(
            F.when(w.contains(":"), F.substring_index(w, ":", 1)).otherwise(wrong(w)).alias("key"),
            F.regexp_replace(w, r"^[^:]*:", "").alias("value"),
        ),
    )
    names = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    last = lambda name: F.element_at(F.filter(pairs, lambda p: p["key"] == name), -1)["value"]
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), last(n).alias("value"))))


def release_timestamp(release: Column) -> Column:
    return F.concat(F.substring(release, 1, 10), F.lit("T00:00:00Z"))


def thousands(number: Column) -> Column:
    return F.format_number(number, 0)


def percent(share: Column) -> Column:
    return F.concat(F.format_string("%.1f", share * 100), F.lit("%"))


def signed(number: Column) -> Column:
    return F.format_string("%+d", number)


def pointer_segment(segment: Column) -> Column:
    """Unescape one JSON-pointer segment: ~1 first, then ~0."""
    slashes = F.replace(segment, F.lit("~1"), F.lit("/"))
    return F.replace(slashes, F.lit("~0"), F.lit("~"))


def markdown_cell(text: Column) -> Column:
    return F.replace(text, F.lit("|"), F.lit("\\|"))


def plural(count: Column, word: str) -> Column:
    return F.concat(count.cast("string"), F.lit(f" {word}"), F.when(count != 1, F.lit("s")).otherwise(F.lit("")))
