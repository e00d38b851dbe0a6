"""Session settings and the shared folder that long jobs cut lineage into."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the call site of every column expression costs more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, app: str = "partlens", memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark, which name the shared folder themselves."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` or the context names it.

    Where neither does it is a folder below the session's warehouse, which executors share
    as well.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.partlens"


def workspace(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for a table a job writes.

    All paths of an application are below one folder, which goes when the driver ends.
    """
    top = f"{checkpoint_dir(spark).rstrip('/')}/partlens-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(top)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.mkdirs(folder):
        files.deleteOnExit(folder)
    return f"{top}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "cut", seen: Observation | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder, and read on from there.

    ``seen`` gets what was observed on the way, so that asking whether a round changed
    anything takes no job of its own.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    if seen is not None:
        seen.get
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A few rows the program holds, as a relation whose size the planner knows."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = [dict(zip(fields.names, row, strict=True)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(fields))
    return spark.createDataFrame(table, fields)
