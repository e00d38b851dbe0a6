"""Which nodes of a directed graph lie on a cycle, and with which others."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from partlens.session import cut_lineage


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder, and its rows."""
    seen = Observation()
    kept = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")), name, seen)
    return kept, seen.get["n"]


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that goes by key to the tasks, however few its rows.

    A round joins several times, and there are many rounds: sides that Spark broadcasts, each small enough by
    itself, together grow faster than the edges, and all of them pass through the driver.
    """
    return df.hint("merge")


def _trimmed(edges: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Without edges from nodes that none leads to and to nodes that lead nowhere, round by round.

    Such edges are on no cycle. It is a saving only: the rounds end once one drops less than a tenth.
    """
    while rows:
        starts = edges.select(F.col("src").alias("dst")).distinct()
        ends = edges.select(F.col("dst").alias("src")).distinct()
        edges, left = counted(edges.join(dealt(starts), "dst", "left_semi").join(dealt(ends), "src", "left_semi").select("src", "dst"), "trimmed")
        if left > 0.9 * rows:
            return edges, left
        rows = left
    return edges, rows


def _least(edges: DataFrame) -> DataFrame:
    """(node, before, after): the smallest node that leads to a node and the smallest it leads to, itself included.

    Both are found in the same rounds, and a round sends on only the labels that the one before has lowered.
    """
    both = edges.select(F.lit(True).alias("ahead"), "src", "dst")
    both = both.unionByName(edges.select(F.lit(False).alias("ahead"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    nodes = both.select("ahead", F.col("src").alias("node")).union(both.select("ahead", F.col("dst").alias("node"))).distinct()
    state = changed = cut_lineage(nodes.withColumn("label", F.col("node")), "labels")
    none = F.lit(None).cast(state.schema["label"].dataType)
    while True:
        sent = changed.withColumnRenamed("node", "src").join(dealt(both), ["ahead", "src"]).select("ahead", F.col("dst").alias("node"), "label")
        met = state.withColumn("_old", F.col("label")).unionByName(sent.withColumn("_old", none))
        lowest = met.groupBy("ahead", "node").agg(F.min("label").alias("label"), F.min("_old").alias("_old"))
        seen = Observation()
        moved = lowest.withColumn("_moved", F.col("label") < F.col("_old")).drop("_old")
        moved = cut_lineage(moved.observe(seen, F.count_if("_moved").alias("n")), "labels", seen)
        state = moved.drop("_moved")
        if not seen.get["n"]:
            break
        changed = moved.where("_moved").drop("_moved")
    before, after = F.when(F.col("ahead"), F.col("label")), F.when(~F.col("ahead"), F.col("label"))
    return state.groupBy("node").agg(F.min(before).alias("before"), F.min(after).alias("after"))


def cycle_groups(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, group) for every node on a cycle: the nodes that lead to it and back are its group, named by the smallest.

    Each round marks every node with the smallest node that leads to it and the smallest it leads to. Nodes
    of one group have the same marks, so edges between nodes marked otherwise go. Once none goes, the two
    marks of a node are one: all that share them lead to that node and back, a whole strongly
    connected component. A node that leads to itself alone is a group of one; nodes on no cycle
    are not listed, and edges without an end count for nothing.
    """
    pairs = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    pairs = cut_lineage(pairs, "pairs")
    alone = pairs.where("src = dst").select(F.col("src").alias("node"), F.col("src").alias("group"))
    left, rows = _trimmed(*counted(pairs.where("src != dst"), "left"))
    while rows:
        marks = cut_lineage(_least(left), "marks")
        here = marks.select(F.col("node").alias("src"), F.struct("before", "after").alias("_from"))
        there = marks.select(F.col("node").alias("dst"), F.struct("before", "after").alias("_to"))
        within = left.join(dealt(here), "src").join(dealt(there), "dst").where("_from = _to").select("src", "dst")
        left, kept = counted(within, "left")
        if kept == rows:
            several = marks.select("node", F.col("before").alias("group"))
            return cut_lineage(several.unionByName(alone.join(dealt(several.select("node")), "node", "left_anti")), "groups")
        left, rows = _trimmed(left, kept)
    return alone
