"""Mixtures of sources by target weights: weighted sampling by exponential keys up to token budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from partlens.llm.common import stored, text_of

SHARES = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix"
RANGE_ROWS = 200_000


def unit_hash(*parts: Column) -> Column:
    """A number in (0, 1] that stands for chance: 52 bits of an md5 of the parts, null as empty."""
    text = F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + 1) / F.lit(float(1 << 52))


def variety(words: Column) -> Column:
    """A document's quality weight by its own words: half, and the share of them that are distinct."""
    share = F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))
    return F.when(F.size(words) > 0, F.lit(0.5) + share).otherwise(F.lit(1.5))


def targets(sizes: DataFrame, shares: Sequence[int] = SHARES, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (one row per ``source`` with ``source_size``) with ``target``.

    Sources by code point, null last, weigh ``shares`` in turn and share the sum of all sizes. A target
    stops at ``most_epochs`` times its source's size, and what is above goes to the others by weight,
    until none is above. A round asks for two sums over the sources whose weight is worth less than
    their stop, and raises that worth; it ends when no further source stops.
    """
    order = F.col("source").asc_nulls_last()
    # Numbers follow from ranges of sources and a row per range; ranges are written, so that no task deals them anew.
    ranged = stored(sizes.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "sources")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(W.partitionBy("_range").orderBy(order)) - 1
    turn = F.pmod(place, F.lit(len(shares))).cast("int")
    weight = F.element_at(F.array(*[F.lit(int(s)) for s in shares]), turn + 1)
    weighed = stored(ranged.join(before, "_range").select("source", "source_size", weight.alias("weight")), "weights")
    stop = F.col("source_size") * most_epochs
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    worth, seen = 0.0, None
    while True:
        stops = stop < F.lit(worth) * F.col("weight")
        full, free = weighed.agg(
            F.coalesce(F.sum(F.when(stops, stop)), F.lit(0)), F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0))
        ).first()
        if (full, free) == seen:
            break
        seen = full, free
        worth = (total - full) / free if free else 0.0
    reached = F.lit(worth) * F.col("weight")
    return weighed.withColumn("target", F.when(stop < reached, stop.cast("double")).otherwise(reached))


def mixed(
    docs: DataFrame,
    weight: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shares: Sequence[int] = SHARES,
    most_epochs: int = MOST_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: id, ``source``, ``size``, ``source_size``, ``target``, ``epochs``, ``taken``.

    ``size`` is the number of words, and :func:`targets` says how many words each source gives, rounded
    to whole ones. A source is read whole as often as its budget holds it (``epochs``). For the rest
    each document draws the key -ln(u) / w, with u a hash of the seed, its identifier and its
    text, and w its quality weight (``weight``, a column over ``docs``; by default :func:`variety`); weights
    null or not above zero come last. Documents follow by rising key until their words fill the
    budget, and the one that crosses it gives only its first words. ``taken`` counts all words given.

    Null texts have no words and nothing to take; null sources are one source, the last; null
    identifiers are as good as others. Equal keys go by identifier, then size. Rows that
    repeat in all of these are counted as one row with a number of copies, and come out each. An empty
    table gives no rows, and other columns take no part. Runs with the same seed agree.

    Texts are read once and not shuffled. Documents are dealt by ranges of (source, key), so a
    source may fill many tasks, and a row per source and range carries the sum of words on.
    """
    words = F.regexp_extract_all(text_of(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    given = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).cast("string").alias("source"),
        words.alias("_words"),
        unit_hash(F.lit(seed), F.col(id_col), F.md5(text_of(text_col))).alias("_u"),
        (variety(words) if weight is None else weight.cast("double")).alias("_w"),
    )
    key = F.when(F.col("_w") > 0, -F.log("_u") / F.col("_w")).otherwise(F.lit(float("inf")))
    drawn = given.select("_id", "source", F.size("_words").cast("long").alias("size"), key.alias("_key"))
    alike = ["source", "_key", "_id", "size"]
    counted = stored(drawn.groupBy(*alike).agg(F.count(F.lit(1)).alias("_copies")), "drawn")

    given_words = F.col("size") * F.col("_copies")
    sums = counted.groupBy("source").agg(F.sum(given_words).alias("source_size"))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("_budget DIV source_size")).otherwise(F.lit(0).cast("long"))
    wanted = targets(sums, shares, most_epochs).withColumn("_budget", budget).withColumn("epochs", epochs)
    wanted = wanted.select(F.col("source").alias("_source"), "source_size", "target", "epochs",
                           (F.col("_budget") - F.col("epochs") * F.col("source_size")).alias("_rest"))

    ranges = max(1, -(-counted.count() // RANGE_ROWS))
    ranged = stored(counted.repartitionByRange(ranges, *alike).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("source", "_range").agg(F.sum(given_words).alias("_words"))
    earlier = W.partitionBy("source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(F.col("source").alias("_from"), F.col("_range").alias("_at"),
                          F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_carried"))
    inside = W.partitionBy("source", "_range").orderBy("_key", "_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.withColumn("_own", F.coalesce(F.sum(given_words).over(inside), F.lit(0)))
    placed = placed.join(carried, F.col("source").eqNullSafe(F.col("_from")) & (F.col("_range") == F.col("_at")))
    placed = placed.join(wanted, F.col("source").eqNullSafe(F.col("_source")))
    each = placed.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    before = F.col("_carried") + F.col("_own") + F.col("_copy") * F.col("size")
    part = F.greatest(F.least(F.col("_rest") - before, F.col("size")), F.lit(0))
    return each.select(
        F.col("_id").alias(id_col), "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
    )
