"""Nearest vectors by multiprobe p-stable hashing, with exact distances at the end."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from partlens.llm.common import stored

TABLES = 8
HASHES = 8
WIDTH = 2.0
PROBES = 90
SLICE_ROWS = 1024
SEED = 11
TOGETHER = 256


def projections(table: int, size: int, hashes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """The Gaussian directions and offsets of a table, the same wherever they are drawn."""
    draw = np.random.default_rng([SEED, table, size])
    return draw.normal(size=(size, hashes)), draw.uniform(0, width, hashes)


def places(vectors: np.ndarray, table: int, hashes: int, width: float) -> np.ndarray:
    """Where unit vectors fall on each line, in buckets of ``width``."""
    lines, offsets = projections(table, vectors.shape[1], hashes, width)
    unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return (np.einsum("ij,jk->ik", unit, lines) + offsets) / width


def keys(buckets: np.ndarray, size: int) -> np.ndarray:
    """One number for the buckets on all lines."""
    value = np.full(len(buckets), size, np.uint64)
    for column in buckets.astype(np.int64).T.view(np.uint64) if len(buckets) else ():
        value = (value ^ (column + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(31)
    return value.view(np.int64)


def perturbations(place: np.ndarray, probes: int) -> np.ndarray:
    """Steps to the ``probes`` likeliest buckets, the own one first.

    A neighbour lies beyond a near boundary more often than a far one, so sets of steps
    are visited in the order of the sum of squared distances to the boundaries crossed.
    """
    inside = place - np.floor(place)
    ways = sorted([(d * d, line, step) for line, f in enumerate(inside) for d, step in ((f, -1), (1 - f, 1))])
    found = [np.zeros(len(place), np.int64)]
    waiting = [(ways[0][0], (0,))]
    while waiting and len(found) < probes:
        cost, chosen = heapq.heappop(waiting)
        steps = np.zeros(len(place), np.int64)
        for way in chosen:
            steps[ways[way][1]] += ways[way][2]
        if len({ways[way][1] for way in chosen}) == len(chosen):
            found.append(steps)
        last = chosen[-1]
        if last + 1 < len(ways):
            more = ways[last + 1][0]
            heapq.heappush(waiting, (cost + more, (*chosen, last + 1)))
            heapq.heappush(waiting, (cost + more - ways[last][0], (*chosen[:-1], last + 1)))
    return np.array(found)


def _unpack(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def _usable(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors as packed doubles; null, empty, zero and non-finite ones are left out."""
    for batch in batches:
        ids, packed = [], []
        for number, vector in zip(batch["_id"], batch["_vector"]):
            values = np.array([] if vector is None else vector, np.float64)
            if values.size and np.isfinite(values).all() and values.any():
                ids.append(number)
                packed.append((values + 0.0).tobytes())
        yield pd.DataFrame({"_id": pd.Series(ids, dtype="int64"), "_packed": pd.Series(packed, dtype=object)})


def _smallest(most: int):
    """Of the rows of a batch with one vector, those with the smallest identifiers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates().sort_values("_id")
            yield batch[batch.groupby("_packed").cumcount() < most]

    return run


def _same_size(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, part in batch.groupby(batch["_packed"].map(len)):
        yield part


def _searcher(keep: int):
    """Per slice of a bucket: hold its vectors, then score the probes against all of them."""
    names = ["_table", "_key", "_slice", "_size"]

    def best(data: pd.DataFrame, asked: pd.DataFrame) -> Iterator[pd.DataFrame]:
        there = _unpack(data["_packed"])
        numbers, ids = data["_class"].to_numpy(np.int64), data["_ids"].to_numpy()
        lengths = np.sqrt(np.einsum("ij,ij->i", there, there))
        for at in range(0, len(asked), TOGETHER):
            part = asked.iloc[at : at + TOGETHER]
            own = _unpack(part["_packed"])
            own_lengths = np.sqrt(np.einsum("ij,ij->i", own, own))
            score = np.einsum("ij,kj->ik", own, there) / (own_lengths[:, None] * lengths)
            order = np.lexsort((np.broadcast_to(numbers, score.shape), -score), axis=1)[:, :keep]
            yield pd.DataFrame({
                "_query": np.repeat(part["_class"].to_numpy(np.int64), order.shape[1]),
                "_class": numbers[order].ravel(),
                "_ids": ids[order].ravel(),
                "_score": np.take_along_axis(score, order, 1).ravel(),
            })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, data, asked = None, [], []

        def done() -> Iterator[pd.DataFrame]:
            if data and asked:
                yield from best(pd.concat(data), pd.concat(asked))

        for batch in batches:
            batch["_size"] = batch["_packed"].map(len)
            for key, part in batch.groupby(names, sort=False):
                if key != at:
                    yield from done()
                    at, data, asked = key, [], []
                rows, probes = part[part["_ids"].notna()], part[part["_ids"].isna()]
                if len(rows):
                    data.append(rows)
                if len(probes):
                    asked.append(probes)
                if sum(map(len, asked)) >= 4 * TOGETHER:
                    yield from done()
                    asked = []
        yield from done()

    return run


def nearest(
    vectors: DataFrame,
    query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    probes: int = PROBES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``k`` rows nearest by cosine to each row
    where ``query`` holds, nearest first, ties to the smaller identifier.

    Every row is in one bucket of each table: where it falls on ``hashes`` random lines cut
    into pieces of ``width``. A query visits its own bucket and the likeliest ones around it,
    ``probes`` in all, and is scored exactly, in double precision, against all rows of them;
    the tables' results are merged. Large buckets are cut into slices of about
    ``SLICE_ROWS`` rows, so that one holds no more than another. A query that meets fewer
    than ``k`` rows this way is then scored against all rows, slice by slice.

    Rows with one vector are searched once; with k + 1 identifiers each, since no query
    can need more. Null, empty, zero and non-finite vectors take no part, as queries
    neither, nor do null identifiers. Vectors of unlike length are never compared. Repeated
    rows count as one. A query alone in the table has no rows, an empty table none at
    all, and other columns take no part.
    """
    keep = k + 1
    flagged = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_vector"), query.alias("_asked"))
    flagged = flagged.where("_id IS NOT NULL AND _vector IS NOT NULL")
    rows = flagged.select("_id", "_vector").mapInPandas(_usable, "_id long, _packed binary")
    few = rows.mapInPandas(_smallest(keep), "_id long, _packed binary").distinct()
    first = W.partitionBy("_packed").orderBy("_id")
    few = few.withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= keep)
    classes = stored(
        few.groupBy("_packed").agg(F.sort_array(F.collect_list("_id")).alias("_ids")).select(F.col("_ids")[0].alias("_class"), "_ids", "_packed"),
        "classes",
    )
    asked = flagged.where("_asked").select("_id", "_vector").mapInPandas(_usable, "_id long, _packed binary").distinct()
    asked = stored(asked.join(classes.select("_packed", "_class"), "_packed").select(F.col("_id").alias("query_id"), "_class"), "queries")
    sought = stored(classes.join(asked.select("_class").distinct(), "_class").select("_class", "_packed"), "sought")

    def buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _same_size(batch):
                own = _unpack(part["_packed"])
                for table in range(tables):
                    at = np.floor(places(own, table, hashes, width))
                    yield part.assign(_table=table, _key=keys(at, own.shape[1]))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _same_size(batch):
                own = _unpack(part["_packed"])
                for table in range(tables):
                    at = places(own, table, hashes, width)
                    steps = [np.floor(p) + perturbations(p, probes) for p in at]
                    counts = [len(s) for s in steps]
                    yield pd.DataFrame({
                        "_class": np.repeat(part["_class"].to_numpy(), counts),
                        "_table": table,
                        "_key": keys(np.concatenate(steps), own.shape[1]),
                    })

    def searched(index: DataFrame, visits: DataFrame) -> DataFrame:
        """The best ``keep`` rows for each query class, of the buckets it visits."""
        sizes = stored(
            index.groupBy("_table", "_key").agg(F.ceil(F.count(F.lit(1)) / SLICE_ROWS).cast("int").alias("_slices")), "buckets"
        )
        there = index.join(sizes, ["_table", "_key"]).select(
            "_table", "_key", F.pmod(F.xxhash64("_class"), F.col("_slices")).cast("int").alias("_slice"), "_class", "_ids", "_packed"
        )
        visiting = visits.join(sizes, ["_table", "_key"]).join(sought, "_class").select(
            "_table", "_key", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"), "_class",
            F.lit(None).cast("array<long>").alias("_ids"), "_packed",
        )
        where = ["_table", "_key", "_slice"]
        met = there.unionByName(visiting).withColumn("_last", F.col("_ids").isNull())
        met = met.repartition(*where).sortWithinPartitions(*where, F.length("_packed"), "_last")
        found = met.mapInPandas(_searcher(keep), "_query long, _class long, _ids array<long>, _score double")
        # The rows of one query are at most ``keep`` for each slice it visits; slices are first cut down among themselves.
        best = found.dropDuplicates(["_query", "_class"])
        order = W.partitionBy("_query").orderBy(F.desc("_score"), "_class")
        return best.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= keep).drop("_place")

    index = stored(classes.mapInPandas(buckets, "_class long, _ids array<long>, _packed binary, _table int, _key long"), "index")
    best = stored(searched(index, sought.select("_class", "_packed").mapInPandas(probe, "_class long, _table int, _key long")), "best")
    reached = best.groupBy("_query").agg(F.sum(F.size("_ids")).alias("_n"))
    short = sought.select(F.col("_class").alias("_query")).join(reached, "_query", "left").where(F.coalesce("_n", F.lit(0)) < keep)
    short = stored(short.select(F.col("_query").alias("_class")), "short")
    if not short.isEmpty():
        whole = classes.withColumns({"_table": F.lit(0), "_key": F.lit(0).cast("long")})
        all_rows = searched(whole, short.withColumns({"_table": F.lit(0), "_key": F.lit(0).cast("long")}))
        best = best.join(short.select(F.col("_class").alias("_query")), "_query", "left_anti").unionByName(all_rows)

    each = F.transform("_ids", lambda i: F.struct((-F.col("_score")).alias("far"), i.alias("vec_id")))
    lists = best.groupBy("_query").agg(F.sort_array(F.flatten(F.collect_list(each))).alias("_near"))
    own = asked.join(lists, asked["_class"] == lists["_query"])
    others = F.slice(F.filter("_near", lambda n: n["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("_at", "_n")).select(
        "query_id", (F.col("_at") + 1).alias("rank"), F.col("_n.vec_id").alias("vec_id"), (-F.col("_n.far")).alias("score")
    )
