"""The footer source, the GeoParquet sink and the order along the curve."""

import json
import os
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from partlens.functions.curve import box_key, hilbert_key
from partlens.operators import quality
from partlens.sources import footers, geoparquet

BOX = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"


def plain_hilbert(x, y, bits):
    d, size = 0, 1 << (bits - 1)
    while size:
        right, upper = int(bool(x & size)), int(bool(y & size))
        d += size * size * ((3 * right) ^ upper)
        x, y = x & (size - 1), y & (size - 1)
        if not upper:
            if right:
                x, y = size - 1 - x, size - 1 - y
            x, y = y, x
        size >>= 1
    return d


def test_curve(spark):
    cells = spark.range(64 * 64).select((F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"))
    rows = {r.d: (r.x, r.y) for r in cells.withColumn("d", hilbert_key(F.col("x"), F.col("y"), 6)).collect()}
    assert sorted(rows) == list(range(4096))
    assert all(plain_hilbert(x, y, 6) == d for d, (x, y) in rows.items())
    # Each step of the curve goes to a neighbour.
    assert all(abs(rows[d][0] - rows[d + 1][0]) + abs(rows[d][1] - rows[d + 1][1]) == 1 for d in range(4095))


def test_boxes_on_the_curve(frame):
    rows = [(1, None), (2, (0.0, None, 1.0, 1.0)), (3, (-500.0, -500.0, -400.0, -400.0)), (4, (-180.0, -90.0, -180.0, -90.0)), (5, (400.0, -95.0, 500.0, -91.0))]
    got = {r.i: r.k for r in frame(rows, f"i int, bbox {BOX}").select("i", box_key("bbox", 4).alias("k")).collect()}
    assert got == {1: None, 2: None, 3: 0, 4: 0, 5: plain_hilbert(15, 0, 4)}


@pytest.fixture
def boxes(spark):
    x, y = (F.col("id") * 7919) % 3600 / 10 - 180, (F.col("id") * 104_729) % 1800 / 10 - 90
    box = F.struct(x.alias("xmin"), y.alias("ymin"), (x + 1).alias("xmax"), (y + 1).alias("ymax"))
    return spark.range(6000).select("id", F.when(F.col("id") != 17, box).alias("bbox"))


def test_written_files_tell_their_geometry(spark, boxes, tmp_path):
    path = f"{tmp_path}/geo"
    geoparquet.write(geoparquet.in_order(boxes, 3), path, row_group_rows=500)
    assert sorted(os.listdir(path)) == sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(os.listdir(path)) == 3
    read = spark.read.parquet(path)
    assert read.count() == 6000 and read.select("id").distinct().count() == 6000
    row = read.where("id = 1").first()
    b = row.bbox
    points = struct.unpack("<10d", bytes(row.geometry)[13:])
    assert bytes(row.geometry)[:13] == b"\x01" + struct.pack("<III", 3, 1, 5)
    assert points == (b.xmin, b.ymin, b.xmax, b.ymin, b.xmax, b.ymax, b.xmin, b.ymax, b.xmin, b.ymin)
    assert read.where("geometry IS NULL").select("id").collect() == [(17,)]
    for name in os.listdir(path):
        meta = pq.ParquetFile(f"{path}/{name}").metadata
        told = json.loads(meta.metadata[b"geo"])["columns"]["geometry"]
        held = read.where(F.input_file_name().endswith(name)).agg(F.min("bbox.xmin"), F.min("bbox.ymin"), F.max("bbox.xmax"), F.max("bbox.ymax")).first()
        assert told["bbox"] == list(held) and told["geometry_types"] == ["Polygon"] and told["covering"]["bbox"]["xmax"] == ["bbox", "xmax"]
        assert max(meta.row_group(g).num_rows for g in range(meta.num_row_groups)) <= 500
    geoparquet.write(boxes.limit(5).coalesce(1), path)
    assert spark.read.parquet(path).count() == 6005
    geoparquet.write(boxes.limit(7).coalesce(1), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 7 and len(os.listdir(path)) == 1


def group_sizes(folder):
    """The rows of every row group of every file, by file name."""
    metas = {n: pq.ParquetFile(f"{folder}/{n}").metadata for n in sorted(os.listdir(folder))}
    return {n: [m.row_group(g).num_rows for g in range(m.num_row_groups)] for n, m in metas.items()}


def test_no_footer_grows_with_the_rows_of_a_task(spark, boxes, tmp_path):
    path = f"{tmp_path}/geo"
    geoparquet.write(boxes.repartition(1), path, row_group_rows=1)
    # id, four sides and the geometry
    sizes = group_sizes(path)
    assert [len(g) for g in sizes.values()] == [geoparquet.FILE_CHUNKS // 6, 6000 - geoparquet.FILE_CHUNKS // 6]
    assert spark.read.parquet(path).agg(F.count("id"), F.countDistinct("id"), F.sum("id")).first() == (6000, 6000, 5999 * 3000)


def test_files_of_a_task_follow_each_other_and_tell_of_their_own_rows(spark, boxes, tmp_path):
    path = f"{tmp_path}/geo"
    lines = boxes.withColumn("geometry", F.when(F.col("id") == 17, F.expr("X'0101000000'"))).withColumn("place", box_key("bbox"))
    geoparquet.write(geoparquet.in_order(lines, 1), path, row_group_rows=100, file_chunks=7 * 20)
    sizes = group_sizes(path)
    assert [*sizes.values()] == [[100] * 20] * 3
    keys, told = [], []
    for name in sizes:
        table = pq.read_table(f"{path}/{name}", partitioning=None)
        keys += table["place"].to_pylist()
        geo = json.loads(pq.ParquetFile(f"{path}/{name}").metadata.metadata[b"geo"])["columns"]["geometry"]
        told.append(geo["geometry_types"])
        sides = [[b[s] for b in table["bbox"].to_pylist() if b] for s in geoparquet.SIDES]
        assert geo["bbox"] == [min(sides[0]), min(sides[1]), max(sides[2]), max(sides[3])]
    assert keys[0] is None and keys[1:] == sorted(keys[1:]) and len(keys) == 6000
    assert told == [["Point"], [], []]


def test_row_groups_are_full_however_rows_come_in(spark, boxes, tmp_path):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "70")
    try:
        geoparquet.write(boxes.repartition(1).limit(1010), f"{tmp_path}/geo", row_group_rows=200)
    finally:
        spark.conf.set(name, before)
    assert [*group_sizes(f"{tmp_path}/geo").values()] == [[200] * 5 + [10]]


def test_a_failed_write_leaves_nothing(spark, boxes, tmp_path):
    path = f"{tmp_path}/geo"
    bad = boxes.withColumn("id", F.when(F.col("id") < 5990, F.col("id")).otherwise(F.raise_error(F.lit("broken row")).cast("long")))
    with pytest.raises(Exception, match="broken row"):
        geoparquet.write(bad.repartition(3, "id"), path)
    assert not os.path.exists(path) or os.listdir(path) == []


def test_order_brings_the_overlap_below_the_threshold(spark, boxes, tmp_path):
    for name, df in (("given", boxes.coalesce(3)), ("curve", geoparquet.in_order(boxes, 3))):
        geoparquet.write(df, f"{tmp_path}/{name}", row_group_rows=200)
        groups = quality.bbox_groups(footers.row_groups(footers.list_parts(spark, f"{tmp_path}/{name}")))
        worst = quality.spatial_order(groups).agg(F.max("overlap"), F.bool_and("ordered"), F.sum("pairs")).first()
        assert worst[2] > 20 and worst[1] is (name == "curve")
        assert worst[0] < 0.5 if name == "curve" else worst[0] > 0.9


def test_pushed_filters_open_fewer_files(spark, tmp_path, monkeypatch):
    os.makedirs(f"{tmp_path}/t/k=1/_hidden")
    for n in range(6):
        pq.write_table(pa.table({"a": list(range(10))}), f"{tmp_path}/t/k=1/part-{n}.parquet", row_group_size=4)
    pq.write_table(pa.table({"a": [1]}), f"{tmp_path}/t/k=1/_hidden/part-9.parquet")
    opened = []
    monkeypatch.setattr(footers, "_open", lambda uri: opened.append(uri) or pq.ParquetFile(uri))
    reader = geoparquet.FooterReader(StructType.fromDDL(footers.CHUNKS), f"{tmp_path}/t", True, 1)
    left = list(reader.pushFilters([
        ds.StringEndsWith(("path",), "part-3.parquet"), ds.GreaterThan(("row_group",), 0), ds.EqualTo(("column",), "a"), ds.IsNotNull(("path",)),
    ]))
    assert left == [ds.EqualTo(("column",), "a"), ds.IsNotNull(("path",))]
    rows = [r for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist()]
    assert [(r["row_group"], r["num_rows"]) for r in rows] == [(1, 4), (2, 2)]
    assert opened == [f"{tmp_path}/t/k=1/part-3.parquet"]


def test_source_through_spark(spark, tmp_path):
    for n in range(5):
        pq.write_table(pa.table({"a": list(range(n))}), f"{tmp_path}/part-{n}.parquet")
    found = geoparquet.scan_footers(spark, str(tmp_path), files_per_task=2)
    assert found.rdd.getNumPartitions() == 3
    assert found.agg(F.sum("rows")).first()[0] == 10
    some = found.where(F.col("path").endswith("part-4.parquet"))
    assert [r.rows for r in some.collect()] == [4] and some.rdd.getNumPartitions() == 1
    assert geoparquet.scan_footers(spark, f"{tmp_path}/none").collect() == []


def test_source_where_the_session_pushes_no_filters(spark, tmp_path):
    for n in range(5):
        pq.write_table(pa.table({"a": list(range(n))}), f"{tmp_path}/part-{n}.parquet")
    name = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        found = geoparquet.scan_footers(spark, str(tmp_path), files_per_task=2)
        assert found.agg(F.sum("rows")).first()[0] == 10
        assert [r.rows for r in found.where(F.col("path").endswith("part-4.parquet")).collect()] == [4]
        chunks = geoparquet.scan_footers(spark, str(tmp_path), chunks=True).where("column = 'a' AND row_group = 0 AND num_rows > 2")
        assert sorted((r.num_rows, r.max_double) for r in chunks.collect()) == [(3, 2.0), (4, 3.0)]
    finally:
        spark.conf.set(name, before)


def test_null_counts_read_files_without_statistics_only(spark, tmp_path):
    table = pa.table({"a": pa.array([1, None, 3]), "b": ["x", None, None]})
    pq.write_table(table, f"{tmp_path}/part-0.parquet")
    pq.write_table(table, f"{tmp_path}/part-1.parquet", write_statistics=["a"])
    parts = footers.list_parts(spark, str(tmp_path))
    found = footers.null_counts(parts, ["a", "b"], str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [("a", 6, 2), ("b", 6, 4)]
    assert [n for n in (0, 1) if any(f.endswith(f"{tmp_path}/part-{n}.parquet") for f in found.inputFiles())] == [1]
    assert footers.row_count(parts).first().n == 6
