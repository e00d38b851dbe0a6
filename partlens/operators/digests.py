"""Digests over ranges of hashed keys: two releases meet only where their digests differ.

A release is stored with a tree of digests. Keys are dealt by their hash into 2^``bits`` leaves, and
each level above joins sixteen ranges of the one below. Comparing starts at the root and goes
down only into ranges that differ, so rows of equal ranges are neither shuffled nor, where a
whole folder is equal, read. A hash deals evenly whatever the keys, and gives both releases the
same ranges without either knowing the other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partlens.session import cut_lineage

LEAF_BITS = 16
# The slots of all leaves are broadcast, so their number has a bound: 8 MB of longs.
MOST_LEAF_BITS = 20
STEP_BITS = 4
FOLDER_BITS = 8
PIECES = 4
OWN = ("_slot", "_folder")


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def row_hash(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    """64 bits of the given columns. A null differs from every value, and nested values go by their JSON."""
    parts = []
    for c in columns:
        nested = isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType))
        value = F.to_json(F.struct(_named(c)), {"ignoreNullFields": "false"}) if nested else _named(c)
        parts += [_named(c).isNull(), value]
    return F.xxhash64(F.lit(seed), *parts)


def pieces(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """128 bits of a row as eight numbers below 65,536, whose sums hold for 10^14 rows.

    Sums, unlike a bitwise exclusive or, tell repeated rows from absent ones.
    """
    hashes = [row_hash(df, columns, seed) for seed in (1, 2)]
    return [F.shiftrightunsigned(h, 16 * i).bitwiseAND(F.lit(0xFFFF)) for h in hashes for i in range(PIECES)]


def with_slots(rows: DataFrame, keys: Sequence[str], bits: int = LEAF_BITS, folder_bits: int = FOLDER_BITS) -> DataFrame:
    """``rows`` with the leaf and the folder of their key."""
    if bits % STEP_BITS or not 0 < folder_bits <= min(bits, 12) or bits > MOST_LEAF_BITS:
        raise ValueError(f"leaves take up to {MOST_LEAF_BITS} bits in steps of {STEP_BITS}, folders 1 to 12 of them")
    taken = [c for c in rows.columns if c.lower() in OWN]
    if taken:
        raise ValueError(f"columns of these names are the store's own: {taken}")
    slot = F.shiftrightunsigned(row_hash(rows, keys, 0), 64 - bits)
    return rows.withColumn("_slot", slot).withColumn("_folder", F.shiftright("_slot", bits - folder_bits).cast("int"))


def leaves(slotted: DataFrame) -> DataFrame:
    """(slot, n, digest) of every leaf that holds a row. Sums combine before the shuffle."""
    values = [c for c in slotted.columns if c not in OWN]
    sums = [F.sum(p).alias(f"d{i}") for i, p in enumerate(pieces(slotted, values))]
    grouped = slotted.groupBy(F.col("_slot").alias("slot")).agg(F.count(F.lit(1)).alias("n"), *sums)
    return grouped.select("slot", "n", F.array(*(f"d{i}" for i in range(2 * PIECES))).alias("digest"))


def tree(bottom: DataFrame, bits: int) -> DataFrame:
    """All levels as (depth, slot, n, digest), ``depth`` counting bits from the root at 0."""
    depths = F.sequence(F.lit(0), F.lit(bits), F.lit(STEP_BITS))
    nodes = bottom.withColumn("depth", F.explode(depths)).withColumn(
        "slot", F.expr(f"shiftright(slot, {bits} - depth)")
    )
    sums = [F.sum(F.col("digest")[i]).alias(f"d{i}") for i in range(2 * PIECES)]
    return (
        nodes.groupBy("depth", "slot")
        .agg(F.sum("n").alias("n"), *sums)
        .select("depth", "slot", "n", F.array(*(f"d{i}" for i in range(2 * PIECES))).alias("digest"))
    )


@dataclass(frozen=True)
class Stored:
    """A release with its digests, below one path."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    bits: int = LEAF_BITS
    folder_bits: int = FOLDER_BITS

    @property
    def rows(self) -> DataFrame:
        """The rows with their leaf and folder. A release without rows has its columns from a file of none."""
        shape = self.spark.read.parquet(f"{self.path}/shape").schema
        return self.spark.read.schema(shape).parquet(f"{self.path}/rows")

    @property
    def nodes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/digests")


def store(rows: DataFrame, keys: Sequence[str], path: str, bits: int = LEAF_BITS, folder_bits: int = FOLDER_BITS) -> Stored:
    """Write a release by ranges of its keys, and its digests beside it.

    The digests are taken from what was written. Rows of a folder lie in the order of their
    leaves; a folder that is too large is split by the rebalance.
    """
    slotted = with_slots(rows, keys, bits, folder_bits)
    slotted.limit(0).write.mode("errorifexists").parquet(f"{path}/shape")
    (
        slotted.hint("rebalance", "_folder")
        .sortWithinPartitions("_folder", "_slot")
        .write.mode("errorifexists")
        .partitionBy("_folder")
        .parquet(f"{path}/rows")
    )
    written = Stored(rows.sparkSession, path, tuple(keys), bits, folder_bits)
    tree(leaves(written.rows), bits).write.mode("errorifexists").parquet(f"{path}/digests")
    return written


def differing(old: DataFrame, new: DataFrame, bits: int) -> DataFrame:
    """The leaves (slot) whose digests differ, found from the root downwards.

    A level is met only below the ranges of the level above that differ; there are at
    most 2^``bits`` of them, so they are broadcast.
    """
    found = None
    for depth in range(0, bits + 1, STEP_BITS):
        level = [nodes.where(F.col("depth") == depth).select("slot", "n", "digest") for nodes in (old, new)]
        if found is not None:
            above = F.broadcast(found.withColumnRenamed("slot", "above"))
            level = [n.join(above, F.shiftright(n["slot"], STEP_BITS) == F.col("above"), "left_semi") for n in level]
        a, b = (n.select("slot", F.struct("n", "digest").alias(side)) for n, side in zip(level, "ab", strict=True))
        found = a.join(b, "slot", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("slot")
    return found


def changed_rows(old: Stored, new: Stored, seen: Observation | None = None) -> DataFrame:
    """(keys…, change, was_rows, now_rows) of every key whose rows differ.

    ``change`` is appeared, disappeared or changed. Rows of one key are compared as a
    bag by 128-bit digests, so order does not matter and repeats do. Null keys are one
    key. Two equal releases, or two empty ones, give no rows. Releases of different columns or
    types are an error: that is for ``column_changes``.

    Brings back the folders that differ, 2^``folder_bits`` numbers at most. ``seen`` gets ``rows``, how many
    rows of both releases were compared.
    """
    if (old.keys, old.bits, old.folder_bits) != (new.keys, new.bits, new.folder_bits):
        raise ValueError("the releases are stored by other keys or other ranges")
    shape = lambda s: sorted((f.name, f.dataType.simpleString()) for f in s.rows.schema.fields)
    if shape(old) != shape(new):
        raise ValueError("the releases hold other columns")
    slots = cut_lineage(differing(old.nodes, new.nodes, old.bits), "slots").withColumnRenamed("slot", "_slot")
    up = old.bits - old.folder_bits
    folders = sorted(r[0] for r in slots.select(F.shiftright("_slot", up).cast("int")).distinct().collect())
    values = sorted(c for c in old.rows.columns if c not in OWN)

    def side(release: Stored, sign: int) -> DataFrame:
        rows = release.rows.where(F.col("_folder").isin(folders)).join(F.broadcast(slots), "_slot", "left_semi")
        held = [(F.lit(sign) * p).alias(f"_d{i}") for i, p in enumerate(pieces(rows, values))]
        return rows.select(F.struct(*(_named(k) for k in release.keys)).alias("_key"), F.lit(sign).alias("_side"), *held)

    both = side(old, -1).unionByName(side(new, 1))
    if seen is not None:
        both = both.observe(seen, F.count(F.lit(1)).alias("rows"))
    sums = [F.sum(f"_d{i}").alias(f"_d{i}") for i in range(2 * PIECES)]
    met = both.groupBy("_key").agg(F.count_if(F.col("_side") < 0).alias("was_rows"), F.count_if(F.col("_side") > 0).alias("now_rows"), *sums)
    moved = F.exists(F.array(*(f"_d{i}" for i in range(2 * PIECES))), lambda d: d != 0)
    change = F.when(F.col("was_rows") == 0, "appeared").when(F.col("now_rows") == 0, "disappeared").when(moved, "changed")
    return met.withColumn("change", change).where(F.col("change").isNotNull()).select("_key.*", "change", "was_rows", "now_rows")
