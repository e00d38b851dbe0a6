"""A space-filling curve as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hilbert_key(x: Column, y: Column, bits: int = 16) -> Column:
    """The place of a cell on the Hilbert curve over 2^bits by 2^bits cells; ``x`` and ``y`` are its numbers.

    From the largest square to the smallest, a step takes the quarter the cell is in and turns the
    rest of the way as that quarter of the curve is turned.
    """
    state = "struct<x: bigint, y: bigint, d: bigint>"

    def step(s: Column, bit: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        right, upper = F.when(s.x.bitwiseAND(size) > 0, 1).otherwise(0), F.when(s.y.bitwiseAND(size) > 0, 1).otherwise(0)
        inner_x, inner_y = s.x.bitwiseAND(size - 1), s.y.bitwiseAND(size - 1)
        flipped = (upper == 0) & (right == 1)
        turned_x, turned_y = F.when(flipped, size - 1 - inner_x).otherwise(inner_x), F.when(flipped, size - 1 - inner_y).otherwise(inner_y)
        quarter = (right * 3).bitwiseXOR(upper)
        return F.struct(
            F.when(upper == 0, turned_y).otherwise(turned_x).alias("x"),
            F.when(upper == 0, turned_x).otherwise(turned_y).alias("y"),
            (s.d * 4 + quarter).alias("d"),
        ).cast(state)

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d")).cast(state)
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda s: s.d)


def box_key(bbox: str, bits: int = 16) -> Column:
    """The Hilbert place of a box's centre on the world; without a coordinate null, beyond the world on its edge."""
    b = F.col(bbox)
    cells = 2**bits

    def cell(low: Column, high: Column, limit: float) -> Column:
        along = F.floor(((low + high) / 2 + limit) / (2 * limit) * cells)
        return F.least(F.greatest(along, F.lit(0)), F.lit(cells - 1))

    whole = b.xmin.isNotNull() & b.ymin.isNotNull() & b.xmax.isNotNull() & b.ymax.isNotNull()
    return F.when(whole, hilbert_key(cell(b.xmin, b.xmax, 180.0), cell(b.ymin, b.ymax, 90.0), bits))
