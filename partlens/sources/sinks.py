"""Writers. Each one writes from the tasks; no output passes through a single one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partlens.functions.text import markdown_cell, signed
from partlens.session import literal_rows

RUN = 1000


def json_lines(df: DataFrame, doc: str, key: str) -> DataFrame:
    """(key, json) with null fields left out and every name in the order of the struct."""
    return df.select(key, F.to_json(F.col(doc)).alias("json"))


def write_json(df: DataFrame, doc: str, key: str, path: str, files: int) -> None:
    """One JSON document per line. A document's file follows from a hash of its key and its
    place from the key itself, so an unchanged input gives the same bytes."""
    (
        json_lines(df, doc, key)
        .repartition(files, key)
        .sortWithinPartitions(key)
        .select("json")
        .write.mode("errorifexists")
        .text(path)
    )


def report_lines(
    findings: DataFrame,
    title: str,
    columns: Sequence[str] = ("rule_id", "path", "message"),
    note: str | None = None,
) -> DataFrame:
    """A Markdown report as lines (section, line_key, line); order by the first two.

    Section 0 is the heading with an optional note, 1 the table head and 2 the findings,
    or 1 alone says that there is none.
    """
    spark = findings.sparkSession
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in columns]
    shown = [
        markdown_cell(cell) if name == "message" else F.concat(F.lit("`"), cell, F.lit("`"))
        for name, cell in zip(columns, cells, strict=True)
    ]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *shown), F.lit(" |"))
    body = findings.select(
        F.lit(2).alias("section"), F.concat_ws("\u0001", *cells).alias("line_key"), row.alias("line")
    )
    # Labels as they read in the report.
    names = {"rule_id": "Rule", "path": "Path", "message": "Message"}
    head = [names.get(c, c) for c in columns]
    schema = "section int, line_key string, line string"
    said = [f"### `{title}`", ""] + ([note, ""] if note else [])
    heading = literal_rows(spark, [(0, str(i), line) for i, line in enumerate(said, 1)], schema)
    if findings.isEmpty():
        rest = [(1, "1", "No error-severity finding.")]
    else:
        rest = [(1, "1", "| " + " | ".join(head) + " |"), (1, "2", "|" + "---|" * len(head))]
    return heading.unionByName(literal_rows(spark, rest, schema)).unionByName(body)


def delta_lines(deltas: DataFrame) -> DataFrame:
    """Table lines of the part counts that moved, by collection."""
    line = F.format_string(
        "| `%s` | %d | %d | %s |", "collection", "was", "now", signed(F.col("delta"))
    )
    return deltas.select(F.lit(2).alias("section"), F.col("collection").alias("line_key"), line.alias("line"))


def delta_report(deltas: DataFrame, was: str, now: str) -> DataFrame:
    """The part counts that moved between two releases, as report lines."""
    schema = "section int, line_key string, line string"
    spark = deltas.sparkSession
    heading = literal_rows(spark, [(0, "1", f"Release `{was}` becomes `{now}`."), (0, "2", "")], schema)
    if deltas.isEmpty():
        return heading.unionByName(literal_rows(spark, [(1, "1", "No part count moved.")], schema))
    head = [(1, "1", "| Collection | Before | After | Delta |"), (1, "2", "|---|---:|---:|---:|")]
    return heading.unionByName(literal_rows(spark, head, schema)).unionByName(delta_lines(deltas))


def write_lines(lines: DataFrame, path: str) -> None:
    """Report lines as text files whose names follow the order of the lines.

    Equal lines are counted first and written in runs of a thousand, so that a line
    repeated very often does not end up in one sort partition.
    """
    runs = (
        lines.groupBy("section", "line_key", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RUN))))
        .withColumn("here", F.least(F.col("n") - F.col("run") * RUN, F.lit(RUN)).cast("int"))
    )
    ordered = runs.orderBy("section", "line_key", "line", "run")
    repeated = ordered.select(F.explode(F.array_repeat("line", F.col("here"))).alias("line"))
    repeated.write.mode("errorifexists").text(path)


def write_tsv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Rows in the given order; the other columns break ties, so the sort can split them."""
    rest = [c for c in df.columns if c not in order]
    df.orderBy(*order, *rest).write.mode("errorifexists").option("sep", "\t").option("header", True).csv(path)


def mirror_parts(parts: DataFrame, path: str) -> None:
    """All part records as one table whose box prunes, one folder per theme."""
    box = F.struct(
        *(F.element_at("bbox", i).alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"), 1))
    )
    (
        parts.withColumn("bbox", box)
        .withColumn("theme", F.substring_index("collection", "/", 1))
        .write.mode("errorifexists")
        .partitionBy("theme")
        .parquet(path)
    )


def refresh(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` holds.

    The rebalance gathers each partition into few files and splits one that is too large.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
