"""Window pruning, window sampling and the range join behind them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partlens.functions.boxes import Box, axis_limit, clamp_bbox, overlaps
from partlens.scale import HOT_ROWS, salted_join

GRID_WIDTH = 1024.0
LAST_LEVEL = 24


@dataclass(frozen=True)
class Scope:
    """What one profile reads: every row, or the rows inside some windows."""

    exhaustive: bool
    windows: tuple[Box, ...]

    @property
    def names(self) -> list[str]:
        return ["all"] if self.exhaustive else [w.name for w in self.windows]


def any_window(bbox: str, windows: Sequence[Box]) -> Column:
    return reduce(lambda a, b: a | b, (overlaps(bbox, w) for w in windows))


def prune_parts(parts: DataFrame, windows: Sequence[Box], bbox: str = "bbox") -> DataFrame:
    """Parts whose own box meets a window. A part without a box may hold anything, so it stays."""
    return parts.where(F.col(bbox).isNull() | any_window(bbox, windows))


def window_parts(parts: DataFrame, windows: Sequence[Box], bbox: str = "bbox") -> DataFrame:
    """One row per (window, part) that has to be read; ``windows`` is a short fixed list."""
    hits = F.array_compact(
        F.array(
            *(
                F.when(F.col(bbox).isNull() | overlaps(bbox, w), F.lit(w.name))
                for w in windows
            )
        )
    )
    return parts.withColumn("window", F.explode(hits))


def scan_scopes(parts: DataFrame, windows: Sequence[Box], bbox: str = "bbox") -> DataFrame:
    """Per collection: the scope "all", or with ``windows`` a scope for each with the parts it meets.

    Every collection has a row for every scope. One with 0 parts has nothing to sample there.
    """
    size = parts.groupBy("collection").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("parts"))
    if not windows:
        return size.select("collection", F.lit("all").alias("scope"), "rows", "parts", F.lit(True).alias("exhaustive"))
    met = window_parts(parts, windows, bbox).groupBy("collection", F.col("window").alias("scope")).agg(F.count(F.lit(1)).alias("parts"))
    every = size.select("collection", "rows", F.explode(F.array(*(F.lit(w.name) for w in windows))).alias("scope"))
    return every.join(met, ["collection", "scope"], "left").select(
        "collection", "scope", "rows", F.coalesce("parts", F.lit(0)).alias("parts"), F.lit(False).alias("exhaustive")
    )


def plan_scope(parts: DataFrame, windows: Sequence[Box] = (), bbox: str = "bbox") -> Scope:
    """The scope of one collection: every row, or the rows in those ``windows`` that meet a part.

    The caller says which; a table's size does not. Brings back at most one name per window.
    """
    if not windows:
        return Scope(True, ())
    met = {r["window"] for r in window_parts(parts, windows, bbox).select("window").distinct().collect()}
    if not met:
        raise ValueError("no part meets any of the windows: there is nothing to sample")
    return Scope(False, tuple(w for w in windows if w.name in met))


def sample(features: DataFrame, scope: Scope, bbox: str = "bbox") -> DataFrame:
    """Rows with the scope they belong to; a row inside two windows counts in both.

    The windows go in as literals, so the overlap reaches the Parquet scan and
    row groups outside every window are skipped.
    """
    if scope.exhaustive:
        return features.withColumn("window", F.lit("all"))
    if not scope.windows:
        raise ValueError("a sample needs windows")
    inside = features.where(any_window(bbox, scope.windows))
    return window_parts(inside, scope.windows, bbox)


def _level(box: Column) -> Column:
    """The finest level whose cells are wider than the box, which then meets two of them at most along a side.

    A cell of level l is a 2^l-th of ``GRID_WIDTH``, a power of two, so all edges are exact.
    Boxes without an extent go to the last level, endless ones to the first.
    """
    side = F.greatest(F.abs(box.xmax - box.xmin), F.abs(box.ymax - box.ymin))
    # The sliver keeps a rounded logarithm from naming cells that are too narrow.
    rough = F.floor(F.log2(GRID_WIDTH / F.greatest(side, F.lit(GRID_WIDTH / 2**LAST_LEVEL))) - 1e-9)
    return F.greatest(F.coalesce(rough, F.lit(0)), F.lit(0)).cast("int")


def _cell(value: Column, scale: Column) -> Column:
    """The cell a coordinate is in, of cells that are 1 / ``scale`` wide; coordinates beyond the grid are on its edge."""
    held = F.least(F.greatest(value, F.lit(-GRID_WIDTH / 2)), F.lit(GRID_WIDTH / 2 - 1))
    return F.floor((held + GRID_WIDTH / 2) * scale).cast("int")


def _complete(df: DataFrame, bbox: str) -> DataFrame:
    """``df`` with ``_home``, the level of its box, without boxes that lack a coordinate."""
    box = F.col(bbox)
    whole = box.xmin.isNotNull() & box.ymin.isNotNull() & box.xmax.isNotNull() & box.ymax.isNotNull()
    return df.where(whole).withColumn("_home", _level(box))


def _layered(df: DataFrame, bbox: str, layers: dict[int, list[int]]) -> DataFrame:
    """A row per cell of the box on every layer that ``layers`` names for its level; layers 2l and 2l + 1 are on level l."""
    box = F.col(bbox)
    named = {
        home: F.array(*[F.struct(F.lit(n).alias("layer"), F.lit(2.0 ** (n // 2) / GRID_WIDTH).alias("scale")) for n in of])
        for home, of in layers.items()
        if of
    }
    if not named:
        return df.where(F.lit(False)).withColumns({"_layer": F.lit(0), "_scale": F.lit(0.0), "_cx": F.lit(0), "_cy": F.lit(0)}).drop("_home")
    of = F.create_map(*[v for home, found in named.items() for v in (F.lit(home), found)])
    placed = df.withColumn("_on", F.explode(of[F.col("_home")])).drop("_home")
    placed = placed.withColumns({"_layer": F.col("_on.layer"), "_scale": F.col("_on.scale")}).drop("_on")
    across = F.sequence(_cell(box.xmin, F.col("_scale")), _cell(box.xmax, F.col("_scale")))
    up = F.sequence(_cell(box.ymin, F.col("_scale")), _cell(box.ymax, F.col("_scale")))
    return placed.withColumn("_cx", F.explode(across)).withColumn("_cy", F.explode(up))


def overlap_join(
    features: DataFrame,
    windows: DataFrame,
    *,
    salt_by: Sequence[str],
    window_salt_by: Sequence[str] | None = None,
    bbox: str = "bbox",
    window_bbox: str = "window_bbox",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every (feature, window) pair that strictly overlaps, for boxes of any size and a window table of any size.

    Every box is at home on the level of a quadtree whose cells are as wide as itself, and a pair meets, by
    equality on the cell, on the coarser of its two levels: there one of them is at home and the other
    visits. So a box has at most four cells on a level, a city block and a country
    meet in one of the country's cells, and rows that only visit a level never meet each other. One pass over
    both sides counts their boxes per level, and no box visits a level where none of the other side is.

    Where a side has over ``hot_rows`` boxes a cell may be crowded, and is spread over the product of the
    shares that features (by ``salt_by``) and windows (by ``window_salt_by``) make in it. A pair that
    shares several cells is kept in one of them only, the one holding the larger of the two
    lower-left corners, which both boxes cover whenever they overlap. Boxes that lack a
    coordinate overlap nothing.
    """
    b, w = F.col(bbox), F.col(window_bbox)
    mine, theirs = _complete(features, bbox), _complete(windows, window_bbox)
    sides = mine.select("_home", F.lit(0).alias("side")).unionByName(theirs.select("_home", F.lit(1).alias("side")))
    # At most a row per side and level.
    counted = sides.groupBy("side", "_home").agg(F.count(F.lit(1)).alias("n")).collect()
    here, there = ({r["_home"]: r["n"] for r in counted if r["side"] == side} for side in (0, 1))
    if not here or not there:
        here = there = {0: 0}
    # Layer 2l is for features at home on level l and any windows there, 2l + 1 for features that visit and windows at home.
    left = {h: [2 * h] * (max(there) >= h) + [2 * n + 1 for n in sorted(there) if n < h] for h in here}
    right = {h: [2 * n for n in sorted(here) if n <= h] + [2 * h + 1] * (max(here) > h) for h in there}
    placed = _layered(mine, bbox, left), _layered(theirs, window_bbox, right).drop("_scale")
    keys = ["_layer", "_cx", "_cy"]
    if max(sum(here.values()), sum(there.values())) > hot_rows:
        by = window_salt_by or [c for c in windows.columns if c != window_bbox]
        met = salted_join(*placed, keys, salt_by, by, hot_rows=hot_rows)
    else:
        met = placed[0].join(placed[1], keys)
    strict = (b.xmin < w.xmax) & (b.xmax > w.xmin) & (b.ymin < w.ymax) & (b.ymax > w.ymin)
    corner = _cell(F.greatest(b.xmin, w.xmin), F.col("_scale")), _cell(F.greatest(b.ymin, w.ymin), F.col("_scale"))
    return met.where(strict & (F.col("_cx") == corner[0]) & (F.col("_cy") == corner[1])).drop(*keys, "_scale")


def bbox_audit(records: DataFrame, bbox: str = "bbox") -> DataFrame:
    """One row per coordinate of a four-number box that lies outside the world."""
    held = clamp_bbox(F.col(bbox))
    return (
        records.withColumn("_held", held)
        .select(*records.columns, "_held", F.posexplode(bbox).alias("position", "before"))
        .where(F.abs("before") > axis_limit(F.col("position")))
        .withColumn("after", F.element_at("_held", F.col("position") + 1))
        .withColumn("axis", F.when(F.col("position") % 2 == 0, "lon").otherwise("lat"))
        .drop("_held", bbox)
    )
