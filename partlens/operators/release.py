"""Release diff: what changed between two fingerprints, and what blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partlens.operators.manifest import ROW_GROUP_CAP


def appeared_or_gone(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found in one side only, with ``change`` appeared or disappeared."""
    o = old.select(*keys).distinct().withColumn("_o", F.lit(True))
    n = new.select(*keys).distinct().withColumn("_n", F.lit(True))
    return (
        o.join(n, keys, "full_outer")
        .where(F.col("_o").isNull() | F.col("_n").isNull())
        .select(*keys, F.when(F.col("_o").isNull(), "appeared").otherwise("disappeared").alias("change"))
    )


def in_both(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.select(*keys).intersect(new.select(*keys))


def same_list(a: Column, b: Column) -> Column:
    """Equal apart from order, repeats kept; a missing list equals an empty one."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.coalesce(a, empty)) == F.array_sort(F.coalesce(b, empty))


def column_changes(old_columns: DataFrame, new_columns: DataFrame) -> DataFrame:
    """Columns that moved inside collections known to both releases.

    Inputs are (collection, column) rows, so a wide collection is many rows, not one.
    """
    shared = in_both(old_columns, new_columns, ["collection"])
    moved = appeared_or_gone(old_columns, new_columns, ["collection", "column"])
    return moved.join(shared, "collection", "left_semi")


def cap_of(row_group_cap: Column, default_cap: int = ROW_GROUP_CAP) -> Column:
    """The cap on rows of a row group; none or zero means the default."""
    return F.coalesce(F.nullif(row_group_cap, F.lit(0)), F.lit(default_cap)).cast("bigint")


def over_cap(current: DataFrame, default_cap: int = ROW_GROUP_CAP) -> DataFrame:
    """Collections whose largest row group exceeds their cap."""
    return current.withColumn("cap", cap_of(F.col("row_group_cap"), default_cap)).where(
        F.coalesce("max_row_group_rows", F.lit(0)) > F.col("cap")
    )


def compare(
    old: DataFrame, new: DataFrame, old_columns: DataFrame, new_columns: DataFrame
) -> DataFrame:
    """Every difference as a finding (collection, rule, subject, was, now, blocking).

    A part count may move and never blocks; every other change does. The row-group cap
    reads all of the new release, collections that only just appeared included. The two
    releases meet once per collection and once per column, and each meeting lists all of
    its findings.
    """
    facts = ("items", "license", "geoparquet", "max_row_group_rows", "row_group_cap")
    side = lambda df, s: df.select(
        "collection", F.lit(True).alias(f"{s}_here"), *(F.col(f).alias(f"{s}_{f}") for f in facts)
    )
    met = side(old, "o").join(side(new, "n"), "collection", "full_outer")
    c = F.col
    in_old, in_new = c("o_here").isNotNull(), c("n_here").isNotNull()
    both = in_old & in_new
    text = lambda v: F.lit(None).cast("string") if v is None else v.cast("string")

    def finding(when: Column, rule: str, was: Column | None = None, now: Column | None = None, blocking: bool = True) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(rule).alias("rule"), text(None).alias("subject"), text(was).alias("was"), text(now).alias("now"),
                F.lit(blocking).alias("blocking"),
            ),
        )

    listed = lambda v: F.array_join(F.array_sort(v), ", ")
    items = [F.coalesce(c(f"{s}_items"), F.lit(0)) for s in "on"]
    cap, tallest = cap_of(c("n_row_group_cap")), F.coalesce("n_max_row_group_rows", F.lit(0))
    of_tables = F.array_compact(
        F.array(
            finding(~in_new, "collection disappeared"),
            finding(~in_old, "collection appeared"),
            finding(both & ~c("o_license").eqNullSafe(c("n_license")), "licence changed", c("o_license"), c("n_license")),
            finding(
                both & ~same_list(c("o_geoparquet"), c("n_geoparquet")),
                "format version changed", listed(c("o_geoparquet")), listed(c("n_geoparquet")),
            ),
            finding(in_new & (tallest > cap), "row group above cap", cap, tallest),
            finding(both & (items[0] != items[1]), "part count moved", *items, blocking=False),
        )
    )
    moved = appeared_or_gone(old_columns, new_columns, ["collection", "column"])
    of_columns = moved.join(met.where(both).select("collection"), "collection", "left_semi").select(
        "collection", F.concat(F.lit("column "), "change").alias("rule"), c("column").alias("subject"),
        text(None).alias("was"), text(None).alias("now"), F.lit(True).alias("blocking"),
    )
    return met.select("collection", F.inline(of_tables)).unionByName(of_columns)


def part_deltas(findings: DataFrame) -> DataFrame:
    """(collection, was, now, delta) of the part counts that moved."""
    was, now = F.col("was").cast("bigint"), F.col("now").cast("bigint")
    return findings.where(F.col("rule") == "part count moved").select(
        "collection", was.alias("was"), now.alias("now"), (now - was).alias("delta")
    )
