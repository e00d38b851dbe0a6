"""How many features each window meets, and the total of a column over them, without listing the pairs."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from partlens.operators.spatial import overlap_join
from partlens.scale import BLOCK_ROWS
from partlens.session import cut_lineage

# Each side has a stripe for this many times the root of the features, so that pairs of stripes stay well below the features.
ROOTS = 8
SHARE_BITS = 20
COORDINATES = ("x0", "y0", "x1", "y1")
SUMS = ("n", "high", "low")
MET = "_window long, n long, high long, low long"
LEVELS = "_x0 int, _y0 int, _x1 int, _y1 int"


def _dominated(ranks: np.ndarray, weights: np.ndarray, first: np.ndarray, below: np.ndarray) -> np.ndarray:
    """For each query the sum of ``weights`` over the ``first`` points whose rank is under ``below``, one bit of the ranks at a time."""
    found = np.zeros((len(first), weights.shape[1]), np.int64)
    low, high = np.zeros_like(first), first
    for bit in reversed(range(len(ranks).bit_length())):
        ones = (ranks >> bit & 1).astype(bool)
        zeros_before = np.concatenate(([0], np.cumsum(~ones)))
        order = np.concatenate((np.flatnonzero(~ones), np.flatnonzero(ones)))
        ranks, weights = ranks[order], weights[order]
        zeros = int(zeros_before[-1])
        sums = np.zeros((zeros + 1, weights.shape[1]), np.int64)
        np.cumsum(weights[:zeros], axis=0, out=sums[1:])
        left, right = zeros_before[low], zeros_before[high]
        up = (below >> bit & 1).astype(bool)
        found[up] += sums[right[up]] - sums[left[up]]
        low, high = np.where(up, zeros + low - left, left), np.where(up, zeros + high - right, right)
    return found


def _stripe_totals(points: pa.Table, queries: pa.Table) -> pa.Table:
    """What the points of one stripe add to each of its queries: those below it in ``a`` and ``b0``, less those below it in ``a`` and ``b1``.

    Stripes of lower corners ask for less, those of upper corners for less or equal and count against.
    """
    names = ["_window", *SUMS]
    if not (points.num_rows and queries.num_rows):
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    of = lambda table, name: table.column(name).to_numpy()
    upper = bool(of(queries, "_stripe")[0] >> SHARE_BITS & 1)
    order = np.argsort(of(points, "a"), kind="stable")
    weights = np.stack([of(points, s)[order] for s in SUMS], axis=1)
    first = np.searchsorted(of(points, "a")[order], of(queries, "a"), side="right" if upper else "left")
    found = np.zeros((queries.num_rows, len(SUMS)), np.int64)
    for name, side, sign in (("b0", "left", 1), ("b1", "right", -1)):
        b = of(points, name)[order]
        along = np.argsort(b, kind="stable")
        ranks = np.empty(len(b), np.int64)
        ranks[along] = np.arange(len(b))
        found += sign * _dominated(ranks, weights, first, np.searchsorted(b[along], of(queries, name), side=side))
    if upper:
        found = -found
    some = found.any(axis=1)
    return pa.table(dict(zip(names, (of(queries, "_window")[some], *found[some].T), strict=True)))


def _striped(df: DataFrame, edges: dict[str, np.ndarray], *, spread: bool) -> DataFrame:
    """``df`` with the stripe of each coordinate.

    An edge comes several times for a value that many features share. With ``spread``, for features, such rows are
    dealt over the stripes between by their number. A query is placed before all of them where it asks for less, else behind.
    """

    def run(batches):
        for batch in batches:
            place = {}
            for name, edge in edges.items():
                value = batch.column(name).to_numpy(zero_copy_only=False)
                low, high = np.searchsorted(edge, value, "left"), np.searchsorted(edge, value, "right")
                if spread:
                    low = low + batch.column("_number").to_numpy(zero_copy_only=False) % (high - low + 1)
                place[f"_{name}"] = pa.array(low if spread or name[1] == "0" else high, pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, *place.values()], names=[*batch.schema.names, *place])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kept}, {LEVELS}")


def _lower_stripes(points: DataFrame, last: dict[str, int]) -> DataFrame:
    """For every stripe in y and every in x the sums of the points in lower stripes of y, as points below all others of that stripe.

    They are at most as many as pairs of stripes, for either corner.
    """
    cells = points.groupBy("_x0", "_x1", "_y0", "_y1").agg(*(F.sum(s).alias(s) for s in SUMS))
    corners = F.array(*(
        F.struct(F.lit(y).alias("y"), F.lit(x).alias("x"), F.col(f"_y{y}").alias("t"), F.col(f"_x{x}").alias("s"), F.lit(last[f"y{y}"]).alias("last"))
        for y in (0, 1) for x in (0, 1)
    ))
    each = cells.select(F.explode(corners).alias("c"), *SUMS).groupBy("c.y", "c.x", "c.t", "c.s", "c.last").agg(*(F.sum(s).alias(s) for s in SUMS))
    row = W.partitionBy("y", "x", "s").orderBy("t")
    running = each.select(
        "y", "x", "t", "s", F.coalesce(F.lead("t").over(row), "last").alias("until"), *(F.sum(s).over(row).alias(s) for s in SUMS)
    )
    # An endless coordinate is below no query.
    beside = [F.when(F.col("x") == x, F.col("s").cast("double")).otherwise(F.lit(math.inf)).alias(f"b{x}") for x in (0, 1)]
    dealt = running.where("until > t").withColumn("t", F.explode(F.sequence(F.col("t") + 1, F.col("until"))))
    return dealt.select(_stripe(F.col("t"), F.lit(2) + F.col("y")), F.lit(-math.inf).alias("a"), *beside, *SUMS)


def _stripe(place: Column, side: Column) -> Column:
    """The number of a stripe; sides 0 to 3 are x of the lower and upper corner, then y of these."""
    return (F.shiftleft(place.cast("long") * 4 + side, SHARE_BITS)).alias("_stripe")


def _rows(df: DataFrame, sides: list[tuple[str, Column, Column]], kept: list[str]) -> DataFrame:
    """A row per side of each box: its stripe, the coordinate ``a`` along it and the two it is compared by there."""
    each = F.array(*(
        F.struct(_stripe(F.col(f"_{a}"), F.lit(side)), F.col(a).alias("a"), b0.alias("b0"), b1.alias("b1"))
        for side, (a, b0, b1) in enumerate(sides)
    ))
    return df.select(F.explode(each).alias("r"), *kept).select("r.*", *kept)


def _edges(points: DataFrame, rows: int) -> dict[str, np.ndarray]:
    """For each coordinate the values between its stripes: about the root of the rows, as doubles."""
    stripes = math.ceil(math.sqrt(rows) / ROOTS)
    if stripes < 2:
        return {name: np.array([]) for name in COORDINATES}
    at = [i / stripes for i in range(1, stripes)]
    found = points.agg(*(F.percentile_approx(name, at, max(10_000, 10 * stripes)).alias(name) for name in COORDINATES)).first()
    return {name: np.sort(np.array(found[name], np.float64)) for name in COORDINATES}


def _counted(points: DataFrame, queries: DataFrame, rows: int) -> DataFrame:
    """(_window, n, high, low), in parts to be added up: what the points add to each query."""
    edges = _edges(points, rows)
    points, queries = _striped(points, edges, spread=True), _striped(queries, edges, spread=False)
    number = lambda name: F.col(name).cast("double")
    along_x = [(a, F.col("y0"), F.col("y1")) for a in ("x0", "x1")]
    below = _rows(points, along_x + [(a, number("_x0"), number("_x1")) for a in ("y0", "y1")], [*SUMS])
    below = below.unionByName(_lower_stripes(points, {name: len(edge) for name, edge in edges.items()}))
    asked = _rows(queries, along_x + [(a, number("_x0"), number("_x1") - 1) for a in ("y0", "y1")], ["_window"])
    # A row per stripe with queries; one with very many deals them into shares, each of which meets all its points.
    dealt = F.broadcast(asked.groupBy("_stripe").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("_shares")))
    below = below.join(dealt, "_stripe").withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    asked = asked.join(dealt, "_stripe").withColumn("_share", F.pmod(F.xxhash64("_window"), "_shares"))
    below, asked = (df.withColumn("_stripe", F.col("_stripe") + F.col("_share")).drop("_shares", "_share") for df in (below, asked))
    return below.groupBy("_stripe").cogroup(asked.groupBy("_stripe")).applyInArrow(_stripe_totals, MET)


def overlap_totals(features: DataFrame, windows: DataFrame, value: str, *, bbox: str = "bbox", window_bbox: str = "window_bbox") -> DataFrame:
    """Every window that strictly overlaps a feature, with ``n``, how many it does, and ``total``, the sum of ``value`` over them.

    The pairs grow with the product of the two tables, so none is listed. A window meets the features that start
    before its end, less those that end by its start, along x and likewise along y: four sums over the features
    with one corner below a point. For each, x and y are cut into stripes of about as many features.
    Features in the point's stripe of x are compared in a task of that stripe; those in a lower stripe of x and
    in the point's stripe of y in a task of that one; those lower in both come as one row for each
    pair of stripes. Stripes are as many as the root of the features, and so are, eight times, the features in one. A
    coordinate that many features share is spread over stripes, and a stripe that many windows ask is met in shares.

    That holds for features that do not end before they start, and windows that end behind their start. Others are met
    pair by pair, by ``overlap_join``. Boxes that lack a coordinate overlap nothing; a null ``value`` adds nothing.
    """
    whole = F.lit(True)
    for side in ("xmin", "ymin", "xmax", "ymax"):
        whole = whole & F.col(f"{bbox}.{side}").isNotNull()
    b, w, amount = F.col(bbox), F.col(window_bbox), F.coalesce(F.col(value).cast("long"), F.lit(0))
    mine = features.where(whole).select(
        F.monotonically_increasing_id().alias("_number"),
        *(b[side].cast("double").alias(name) for name, side in zip(COORDINATES, ("xmin", "ymin", "xmax", "ymax"), strict=True)),
        F.lit(1).cast("long").alias("n"),
        # Halves, so that no sum over all features leaves a long.
        F.shiftright(amount, 32).alias("high"),
        amount.bitwiseAND(F.lit(2**32 - 1)).alias("low"),
        ((b.xmin <= b.xmax) & (b.ymin <= b.ymax) & ~F.isnan(b.xmax) & ~F.isnan(b.ymax)).alias("_plain"),
    )
    plain = (w.xmin < w.xmax) & (w.ymin < w.ymax) & ~F.isnan(w.xmax) & ~F.isnan(w.ymax)
    theirs = windows.withColumns({"_window": F.monotonically_increasing_id(), "_plain": F.coalesce(plain, F.lit(False))})
    mine, here = _kept(mine, "features")
    theirs, there = _kept(theirs, "windows")
    parts = []
    if here["plain"] and there["plain"]:
        # A query's x0 bounds the lower corner of the features, its x1 the upper one.
        bounds = zip(COORDINATES, ("xmax", "ymax", "xmin", "ymin"), strict=True)
        queries = theirs.where("_plain").select("_window", *(w[side].cast("double").alias(name) for name, side in bounds))
        parts.append(_counted(mine.where("_plain"), queries, here["plain"]))
    for some, few, odd in ((mine.where("NOT _plain"), theirs, here["odd"]), (mine.where("_plain"), theirs.where("NOT _plain"), there["odd"])):
        if odd:
            box = F.struct(F.col("x0").alias("xmin"), F.col("y0").alias("ymin"), F.col("x1").alias("xmax"), F.col("y1").alias("ymax"))
            boxes = some.select("_number", *SUMS, box.alias("bbox")), few.select("_window", F.col(window_bbox).alias("window_bbox"))
            parts.append(overlap_join(*boxes, salt_by=["_number"], window_salt_by=["_window"]).select("_window", *SUMS))
    met = windows.sparkSession.createDataFrame([], MET) if not parts else reduce(DataFrame.unionByName, parts)
    met = met.groupBy("_window").agg(*(F.sum(s).alias(f"_{s}") for s in SUMS)).where("_n > 0")
    total = F.col("_high").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("_low").cast("decimal(20,0)")
    return theirs.drop("_plain").join(met, "_window").select(*windows.columns, F.col("_n").alias("n"), total.cast("long").alias("total"))


def _kept(df: DataFrame, name: str) -> tuple[DataFrame, dict[str, int]]:
    """``df`` written to the shared folder, which settles its numbers, and how many of its boxes are plain and odd."""
    seen = Observation()
    counts = [F.count_if("_plain").alias("plain"), F.count_if(~F.col("_plain")).alias("odd")]
    return cut_lineage(df.observe(seen, *counts), name, seen), seen.get
