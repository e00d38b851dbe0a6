"""Fenced blocks of Markdown guides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partlens.scale import BLOCK_ROWS, running_last

FENCE = "`" * 3


def lines_of(documents: DataFrame, key: str = "file_id", text: str = "text") -> DataFrame:
    """(file_id, line_no, text) with lines counted from 1."""
    # A split is never empty; the outer form only spares a test that would split twice.
    return documents.where(F.col(text).isNotNull()).select(
        F.col(key).alias("file_id"), F.posexplode_outer(F.split(F.col(text), "\n", -1)).alias("at", "text")
    ).select("file_id", (F.col("at") + 1).cast("bigint").alias("line_no"), "text")


def fenced_blocks(
    lines: DataFrame, language: str = "sql", *, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every closed fence of a language: (file_id, line_no of its opening, trimmed text).

    The text of a block is one value here; :func:`fenced_lines` keeps its lines apart.
    """
    body, closed = _fenced(lines, language, block_rows)
    whole = F.concat_ws(
        "\n", F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda s: s["text"])
    )
    texts = body.groupBy("file_id", "start").agg(whole.alias("whole"))
    return closed.join(texts, ["file_id", "start"], "left").select(
        "file_id",
        F.col("start").alias("line_no"),
        F.regexp_replace(F.coalesce("whole", F.lit("")), r"(?U)^\s+|\s+$", "").alias("block"),
    )


def fenced_lines(lines: DataFrame, language: str = "sql", *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every line inside a closed fence: (file_id, block, line_no, text), ``block`` being the line of
    its opening. A block of any length is as many rows."""
    body, _ = _fenced(lines, language, block_rows)
    return body.select("file_id", F.col("start").alias("block"), "line_no", "text")


def _fenced(lines: DataFrame, language: str, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The lines inside closed fences, with the line of the opening as ``start``, and those openings.

    The kind of the last fence line above a row says whether the row is inside a block,
    and the last opening that was not itself inside one says which. A fence that is never
    closed yields nothing.
    """
    text, at = F.col("text"), F.col("line_no")
    kind = F.when(text.rlike(rf"^{FENCE}{language}(?U)\s*$"), 1).when(text.rlike(rf"^{FENCE}(?U)\s*$"), 0)
    marked = lines.withColumn("kind", kind)
    fence = F.when(F.col("kind").isNotNull(), F.struct(at.alias("at"), F.col("kind").alias("open")))
    inside = running_last(marked, ["file_id"], "line_no", fence, "above", before=True, block_rows=block_rows)
    within = F.coalesce(F.col("above.open") == 1, F.lit(False))
    opening = F.when((F.col("kind") == 1) & ~within, at)
    placed = running_last(
        inside.withColumn("within", within), ["file_id"], "line_no", opening, "start", block_rows=block_rows
    ).where(F.col("within"))
    closed = placed.where(F.col("kind") == 0).select("file_id", "start")
    body = placed.where(F.col("kind").isNull() | (F.col("kind") == 1)).select("file_id", "start", "line_no", "text")
    return body.join(closed, ["file_id", "start"], "left_semi"), closed


def document_blocks(documents: DataFrame, language: str = "sql", key: str = "file_id", text: str = "text") -> DataFrame:
    """The closed fences of whole texts, found inside each row without a shuffle.

    Same result as splitting into lines first. A text is cut at the lines that start with
    a fence. Of the cuts that open or close, only changes between the two matter: an
    opening inside a block and a closing outside one are plain text.
    """
    cut = f"\n{FENCE}"
    first_line = lambda piece: F.substring_index(piece, "\n", 1)
    kind = lambda piece: (
        F.when(first_line(piece).rlike(rf"^{language}(?U)\s*$"), 1).when(first_line(piece).rlike(r"^(?U)\s*$"), 0)
    )
    breaks = lambda t: F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))
    cuts = F.filter(
        F.transform("_pieces", lambda p, i: F.struct(i.alias("at"), F.when(i > 0, kind(p)).alias("open"))),
        lambda c: c["open"].isNotNull(),
    )
    turns = F.filter("_cuts", lambda c, i: (i == 0) | (F.get("_cuts", i - 1)["open"] != c["open"]))
    spans = F.filter(
        F.transform("_turns", lambda c, i: F.struct(c["open"], c["at"].alias("from"), F.get("_turns", i + 1)["at"].alias("to"))),
        lambda s: (s["open"] == 1) & s["to"].isNotNull(),
    )

    def block(span):
        body = F.array_join(F.slice("_pieces", span["from"] + 1, span["to"] - span["from"]), cut)
        above = F.aggregate(F.slice("_breaks", F.lit(1), span["from"]), F.lit(0), lambda n, b: n + b)
        return F.struct(
            (above + span["from"]).cast("bigint").alias("line_no"),
            F.regexp_replace(F.regexp_replace(body, "^[^\n]*\n?", ""), r"(?U)^\s+|\s+$", "").alias("block"),
        )

    return (
        documents.where(F.col(text).contains(FENCE))
        .select(F.col(key).alias("file_id"), F.split(F.concat(F.lit("\n"), text), cut, -1).alias("_pieces"))
        .withColumn("_breaks", F.transform("_pieces", breaks))
        .withColumn("_cuts", cuts)
        .withColumn("_turns", turns)
        .withColumn("_blocks", F.transform(spans, block))
        # The outer form keeps Spark from testing for empty lists below, where that test
        # would cut every text a second time.
        .select("file_id", F.inline_outer("_blocks"))
        .where(F.col("line_no").isNotNull())
    )


def guides_without_blocks(files: DataFrame, blocks: DataFrame) -> DataFrame:
    """Guides that hold no block. An empty guide is a failure, never a pass."""
    return files.join(blocks.select("file_id").distinct(), "file_id", "left_anti")
