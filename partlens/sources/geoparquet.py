"""Parquet footers as a data source, and a sink that writes GeoParquet."""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from urllib.parse import quote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from partlens.functions.curve import box_key
from partlens.sources import footers

FILES_PER_TASK = 64
ROW_GROUP_ROWS = 100_000
# Row groups times columns of one file; a footer takes about 2 KB of memory for each.
FILE_CHUNKS = 32_768
SIDES = ("xmin", "ymin", "xmax", "ymax")
# The version and names of the GeoParquet metadata, and the geometry kinds of WKB by number.
VERSION = "1.1.0"
KINDS = {
    1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection",
}


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Where a path lies, as the process at hand reaches it."""
    if "://" not in path:
        return pafs.LocalFileSystem(), path.removeprefix("file:")
    uri = path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
    if urlparse(uri).scheme == "file":
        return pafs.LocalFileSystem(), uri.removeprefix("file://")
    return pafs.FileSystem.from_uri(quote(uri, safe=":/="))


def _files(path: str) -> list[str]:
    """The Parquet files below a folder, by name; files and folders that start with a dot or a line are none."""
    filesystem, base = _filesystem(path)
    head = path[: len(path) - len(base)] if path.endswith(base) else ""
    found = filesystem.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
    names = [i.path for i in found if i.type == pafs.FileType.File and i.path.endswith(".parquet")]
    inner = (n[len(base) :].strip("/").split("/") for n in names)
    return sorted(head + n for n, parts in zip(names, inner) if not any(p.startswith((".", "_")) for p in parts))


@dataclass
class _Files(ds.InputPartition):
    paths: tuple[str, ...]


class WholeFooterReader(ds.DataSourceReader):
    """Footers of all files below a folder; Spark itself filters the rows."""

    def __init__(self, schema: StructType, path: str, chunks: bool, files_per_task: int):
        self.schema = to_arrow_schema(schema)
        self.path, self.chunks, self.files_per_task = path, chunks, files_per_task
        self.filters: list = []

    def _keeps(self, column: str, value) -> bool:
        return all(TESTS[type(f)](value, f.value) for f in self.filters if f.attribute == (column,))

    def partitions(self) -> Sequence[ds.InputPartition]:
        kept = [p for p in _files(self.path) if self._keeps("path", p)]
        return [_Files(tuple(kept[i : i + self.files_per_task])) for i in range(0, len(kept), self.files_per_task)] or [_Files(())]

    def read(self, partition: ds.InputPartition) -> Iterator[pa.RecordBatch]:
        of = footers._chunks if self.chunks else footers._facts
        rows = (r for p in partition.paths for r in of(p) if not self.chunks or self._keeps("row_group", r["row_group"]))
        while held := list(islice(rows, 1000)):
            yield pa.RecordBatch.from_pylist(held, schema=self.schema)


class FooterReader(WholeFooterReader):
    """Footers of the files that filters on ``path`` leave, and of these the row groups that filters on ``row_group`` leave.

    Spark refuses a reader that takes filters where ``spark.sql.python.filterPushdown.enabled`` is not set.
    """

    def pushFilters(self, filters: list) -> Iterable:
        columns = {("path",), ("row_group",)} if self.chunks else {("path",)}
        for f in filters:
            if getattr(f, "attribute", None) in columns and type(f) in TESTS:
                self.filters.append(f)
            else:
                yield f


TESTS = {
    ds.EqualTo: lambda a, b: a == b,
    ds.In: lambda a, b: a in b,
    ds.GreaterThan: lambda a, b: a > b,
    ds.GreaterThanOrEqual: lambda a, b: a >= b,
    ds.LessThan: lambda a, b: a < b,
    ds.LessThanOrEqual: lambda a, b: a <= b,
    ds.StringStartsWith: lambda a, b: a.startswith(b),
    ds.StringEndsWith: lambda a, b: a.endswith(b),
    ds.StringContains: lambda a, b: b in a,
}


class FooterSource(ds.DataSource):
    """``spark.read.format("partlens_footers")``: a row per file below a folder, or with ``of`` = ``chunks`` one per column chunk.

    With ``push_filters`` = ``true`` it takes filters, which the session then has to allow.
    """

    @classmethod
    def name(cls) -> str:
        return "partlens_footers"

    def schema(self) -> str:
        return footers.CHUNKS if self.options.get("of") == "chunks" else footers.FACTS

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        size = int(self.options.get("files_per_task", FILES_PER_TASK))
        kind = FooterReader if self.options.get("push_filters") == "true" else WholeFooterReader
        return kind(schema, self.options["path"], self.options.get("of") == "chunks", size)


def box_polygons(boxes: pa.StructArray) -> pa.Array:
    """The outline of every box as a WKB polygon; null where a coordinate is."""
    sides = [pc.struct_field(boxes, s).cast(pa.float64()) for s in SIDES]
    missing = np.logical_or.reduce([s.is_null().to_numpy(zero_copy_only=False) for s in sides])
    x0, y0, x1, y1 = (s.fill_null(0.0).to_numpy(zero_copy_only=False) for s in sides)
    points = np.stack([x0, y0, x1, y0, x1, y1, x0, y1, x0, y0], axis=1).astype("<f8")
    head = np.frombuffer(b"\x01" + np.array([3, 1, 5], "<u4").tobytes(), np.uint8)
    body = np.empty((len(points), len(head) + 80), np.uint8)
    body[:, : len(head)] = head
    body[:, len(head) :] = points.view(np.uint8).reshape(len(points), 80)
    whole = pa.array([bytes(row) for row in body], pa.binary())
    return pc.if_else(pa.array(~missing), whole, pa.scalar(None, pa.binary()))


def _leaves(kind: pa.DataType) -> int:
    """How many Parquet columns a field of this type takes."""
    return sum(_leaves(kind.field(i).type) for i in range(kind.num_fields)) or 1


@dataclass
class _Written(ds.WriterCommitMessage):
    files: tuple[tuple[str, str], ...]


class _OpenFile:
    """A file that a task is writing, and what its footer will tell."""

    def __init__(self, path: str, schema: pa.Schema):
        filesystem, local = _filesystem(path)
        self.stream = filesystem.open_output_stream(local)
        self.writer = pq.ParquetWriter(self.stream, schema)
        self.groups, self.kinds, self.edges = 0, set(), []

    def close(self, told: dict) -> None:
        self.writer.add_key_value_metadata({"geo": json.dumps(told)})
        self.writer.close()
        self.stream.close()


class GeoWriter(ds.DataSourceArrowWriter):
    """Every task writes files aside; all files appear together once all tasks are done.

    A row group holds ``row_group_rows`` rows, however the rows come in; only the last of a task may hold
    fewer. A footer is held whole by who writes or reads it, so a task goes on in another file where one
    has ``file_chunks`` column chunks. A task that is run again writes files of its own, and only those that
    were told of are kept.
    """

    def __init__(self, path: str, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, uuid.uuid4().hex
        self.aside = f"{self.path}/_aside-{self.job}"
        self.geometry = options.get("geometry", "geometry")
        self.bbox = options.get("bbox", "bbox")
        self.group_rows = int(options.get("row_group_rows", ROW_GROUP_ROWS))
        self.file_chunks = int(options.get("file_chunks", FILE_CHUNKS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ds.WriterCommitMessage:
        context = TaskContext.get()
        name, attempt = f"part-{context.partitionId():05d}", context.taskAttemptId()
        filesystem, local = _filesystem(self.aside)
        filesystem.create_dir(local)
        files, current, waiting = [], None, []

        def close() -> None:
            nonlocal current
            current.close(self._told(current.kinds, current.edges))
            current = None

        def flush(rows: int) -> None:
            """The first ``rows`` rows that wait, as row groups."""
            nonlocal current, waiting
            table = pa.Table.from_batches(waiting)
            waiting = table.slice(rows).to_batches()
            table = table.slice(0, rows)
            most = max(1, self.file_chunks // sum(_leaves(f.type) for f in table.schema))
            while table.num_rows:
                if current is None:
                    held = f"{self.aside}/{name}-{attempt}-{len(files):05d}.parquet"
                    files.append((held, f"{self.path}/{name}-{self.job}-{len(files):05d}.parquet"))
                    current = _OpenFile(held, table.schema)
                room = (most - current.groups) * self.group_rows
                some, table = table.slice(0, room), table.slice(room)
                current.writer.write_table(some, row_group_size=self.group_rows)
                current.groups += -(-some.num_rows // self.group_rows)
                for values in some.column(self.geometry).chunks:
                    current.kinds |= {int.from_bytes(v[1:5], "little" if v[0] else "big") % 1000 for v in values.to_pylist() if v}
                current.edges.append([pc.min_max(pc.struct_field(some.column(self.bbox), s)).as_py() for s in SIDES])
                if current.groups >= most:
                    close()

        for batch in iterator:
            waiting.append(self._with_geometry(batch))
            if (held := sum(b.num_rows for b in waiting)) >= self.group_rows:
                flush(held - held % self.group_rows)
        if held := sum(b.num_rows for b in waiting):
            flush(held)
        if current is not None:
            close()
        return _Written(tuple(files))

    def _with_geometry(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        if self.geometry in batch.schema.names:
            return batch
        return batch.append_column(self.geometry, box_polygons(batch.column(self.bbox)))

    def _told(self, kinds: set[int], edges: list) -> dict:
        """What the footer says of the geometry: kinds, the box of the file, and where each row's box is."""
        told: dict = {"encoding": "WKB", "geometry_types": sorted(KINDS.get(k, "Geometry") for k in kinds)}
        low = [[e[i]["min"] for e in edges if e[i]["min"] is not None] for i in (0, 1)]
        high = [[e[i]["max"] for e in edges if e[i]["max"] is not None] for i in (2, 3)]
        if all(low) and all(high):
            told["bbox"] = [min(low[0]), min(low[1]), max(high[0]), max(high[1])]
        told["covering"] = {"bbox": {s: [self.bbox, s] for s in SIDES}}
        return {"version": VERSION, "primary_column": self.geometry, "columns": {self.geometry: told}}

    def commit(self, messages: list) -> None:
        before = _files(self.path) if self.overwrite else []
        for message in messages:
            for held, final in message.files if message is not None else ():
                filesystem, local = _filesystem(held)
                filesystem.move(local, _filesystem(final)[1])
        for old in before:
            filesystem, name = _filesystem(old)
            filesystem.delete_file(name)
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        filesystem, aside = _filesystem(self.aside)
        if filesystem.get_file_info(aside).type == pafs.FileType.Directory:
            filesystem.delete_dir(aside)


class GeoParquetSource(ds.DataSource):
    """``df.write.format("partlens_geoparquet")``: GeoParquet files with a ``geo`` footer that names geometry and covering.

    Rows need a ``bbox`` struct. Without a geometry column each row gets its box's outline.
    """

    @classmethod
    def name(cls) -> str:
        return "partlens_geoparquet"

    def writer(self, schema: StructType, overwrite: bool) -> ds.DataSourceWriter:
        return GeoWriter(self.options["path"], dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make both formats known to a session. The code travels with the job; executors need not have this package."""
    for module in (sys.modules[__name__], footers):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(FooterSource)
    spark.dataSource.register(GeoParquetSource)


def scan_footers(spark: SparkSession, path: str, chunks: bool = False, files_per_task: int = FILES_PER_TASK) -> DataFrame:
    """Footers below a folder. Where ``spark.sql.python.filterPushdown.enabled`` is set, files that a filter on ``path`` rules out stay shut.

    Where it is not, all footers are read and the filters follow.
    """
    register(spark)
    pushed = str(spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).lower()
    source = spark.read.format("partlens_footers").option("files_per_task", files_per_task).option("push_filters", pushed)
    return (source.option("of", "chunks") if chunks else source).load(path)


def in_order(df: DataFrame, files: int, bbox: str = "bbox", bits: int = 16) -> DataFrame:
    """``df`` in ``files`` ranges along the Hilbert curve, each in order; rows without a box come first."""
    key = df.withColumn("_key", box_key(bbox, bits))
    return key.repartitionByRange(files, "_key").sortWithinPartitions("_key").drop("_key")


def write(
    df: DataFrame, path: str, mode: str = "append", row_group_rows: int = ROW_GROUP_ROWS, bbox: str = "bbox", file_chunks: int = FILE_CHUNKS
) -> None:
    """``df`` as GeoParquet, a file per partition, or more where a footer would pass ``file_chunks`` column chunks.

    See :func:`in_order` for the order. The files of a partition follow each other by name.
    """
    register(df.sparkSession)
    writer = df.write.format("partlens_geoparquet").mode(mode)
    writer.option("row_group_rows", row_group_rows).option("bbox", bbox).option("file_chunks", file_chunks).save(path)
