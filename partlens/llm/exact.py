"""Exact duplicates: a keyed state that never expires, and a check of whole texts on hits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partlens.llm.common import columns_of, stored
from partlens.session import workspace

#: The state is on disk, takes only the disk it fills, and writes changes rather than whole copies.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def located(df: DataFrame) -> DataFrame:
    """The rows of ``df`` in ``_held``, whatever their columns are called, with ``_at_file`` and ``_at_row``: where a row's content is stored.

    A table read from files has that already; any other is written to the shared folder.
    """
    places = [F.col("_metadata.file_path").alias("_at_file"), F.col("_metadata.row_index").alias("_at_row")]
    held = F.struct(*[c.alias(name) for c, name in zip(columns_of(df), df.columns)]).alias("_held")
    if "_metadata" not in {c.lower() for c in df.columns}:
        try:
            return df.select(held, *places)
        except AnalysisException:
            pass
    return stored(df.select(held), "located").select("_held", *places)


def fold(arrivals: DataFrame, state: str):
    """Fold a stream of (_digest, _id, _file, _row) into the state below the folder ``state``.

    The state has one row per digest: the identifier and place of the row that stays, and
    how many rows came. It lives on the executors' disks (RocksDB) with its changes in the
    shared folder, has no watermark and forgets nothing. Called again with the same
    folders it goes on with the files that are new.
    """
    spark = arrivals.sparkSession
    kept = F.max(F.struct("_id", "_file", "_row")).alias("_kept")
    folded = arrivals.groupBy("_digest").agg(kept, F.count(F.lit(1)).alias("_n"))
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        running = (
            folded.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """(_digest, _keep, _n) as the state holds them."""
    found = spark.read.format("statestore").load(state)
    kept, count = found.schema["value"].dataType.names
    return found.select(F.col("key._digest"), F.col(f"value.{kept}").alias("_keep"), F.col(f"value.{count}").alias("_n"))


def copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``df``: its identifier, place, hash, and the row of its group that stays.

    Columns: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, and the places
    ``file``, ``row``, ``keep_file``, ``keep_row``. Of equal texts the row with the largest
    identifier stays.

    Rows arrive as a stream and are folded by digest into a state on disk. A digest that
    came more than once is a hit; the whole texts of hits are compared as bytes by
    grouping on the text itself, combined before the shuffle, so a group of any size is a
    row per task. Different texts with one digest become groups of their own.

    Null text counts as empty, empty texts are equal to each other, and a null identifier
    ranks below all others. Repeated rows (same identifier and text) are told apart by
    their place, so exactly one row of a group stays. An empty table gives no rows. Other
    columns take no part.
    """
    return _copies(located(df), id_col, text_col, digest)


def _copies(places: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    spark = places.sparkSession
    held = F.col("_held")
    text = F.coalesce(held.getField(text_col).cast("string"), F.lit(""))
    rows = places.select(
        held.getField(id_col).alias("_id"), F.col("_at_file").alias("_file"), F.col("_at_row").alias("_row"), text.alias("_text")
    )
    rows = rows.withColumns({"_digest": digest(F.col("_text")), "_sha": sha256(F.col("_text"))})

    arrived = workspace(spark, "arrivals")
    rows.drop("_text").write.parquet(arrived)
    arrivals = spark.read.parquet(arrived)
    state = workspace(spark, "state")
    fold(spark.readStream.schema(arrivals.schema).parquet(arrived), state)
    groups = stored(read_state(spark, state), "groups")

    place = F.struct("_id", "_file", "_row")
    variants = rows.groupBy("_digest", "_text").agg(F.max(place).alias("_top"), F.count(F.lit(1)).alias("_rows"))
    hits = groups.where("_n > 1").select("_digest", "_keep")
    # The text whose last row is the one in the state is the state's; others share the digest only.
    others = stored(variants.join(hits, "_digest").where(F.col("_top") != F.col("_keep")).select("_digest").distinct(), "collided")

    labelled = arrivals.join(groups, "_digest", "left")
    if not others.isEmpty():
        told = variants.join(others, "_digest", "left_semi").select("_digest", "_text", F.col("_top").alias("_keep"), F.col("_rows").alias("_n"))
        apart = rows.join(told, ["_digest", "_text"]).drop("_text")
        labelled = labelled.join(others, "_digest", "left_anti").unionByName(apart)
    return labelled.select(
        F.col("_id").alias(id_col),
        F.col("_keep._id").alias("keep_id"),
        F.col("_n").cast("long").alias("group_size"),
        ((F.col("_keep._file") == F.col("_file")) & (F.col("_keep._row") == F.col("_row"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        F.col("_file").alias("file"),
        F.col("_row").alias("row"),
        F.col("_keep._file").alias("keep_file"),
        F.col("_keep._row").alias("keep_row"),
    )


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with the columns of ``df``."""
    places = located(df)
    stays = _copies(places, id_col, text_col, sha256).where("kept").select(F.col("file").alias("_at_file"), F.col("row").alias("_at_row"))
    left = places.join(stays, ["_at_file", "_at_row"], "left_semi")
    return left.select(*[F.col("_held").getField(c).alias(c) for c in df.columns])
