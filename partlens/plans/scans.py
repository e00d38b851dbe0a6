"""SRC and SNK queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partlens.functions.boxes import Box, overlaps
from partlens.operators import manifest, quality
from partlens.operators.release import part_deltas
from partlens.plans.registry import query
from partlens.plans.relations import TABLES, WINDOWS, Data
from partlens.plans.releases import diff
from partlens.session import workspace
from partlens.sources import documents, features, footers, geoparquet, lines, published, sinks


def table_path(data: Data, name: str) -> str:
    return f"{data.folder}/{name}.parquet"


def file_table(path: str = "path") -> F.Column:
    """The given table a file belongs to."""
    return F.regexp_extract(path, r"([A-Za-z]+)\.parquet", 1)


def staged(data: Data, df: DataFrame, name: str, *by: str) -> str:
    """Write ``df`` as a Parquet table in the shared folder."""
    path = workspace(data.spark, name)
    writer = df.write.option("parquet.block.size", 64 * 1024)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return path


@query(
    "src_1_multi_part_scan",
    "SELECT l_returnflag, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY l_returnflag",
)
def multi_part(data):
    table = features.scan_table(data.spark, table_path(data, "lineitem"))
    return table.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines")
    )


@query("src_2_single_part_scan", "SELECT count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders")
def single_part(data):
    part = features.scan_part(data.spark, table_path(data, "orders"))
    return part.agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")
    )


@query(
    "src_3_part_list_scan",
    "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand",
)
def part_list(data):
    listed = footers.list_parts(data.spark, table_path(data, "part")).select("path")
    paths = sorted(r["path"] for r in listed.toLocalIterator())
    return features.scan_parts(data.spark, data.folder, paths).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_4_partition_columns",
    """SELECT status AS type, count(*) AS n, CAST(sum(depth) AS BIGINT) AS depth FROM geo_boxes
       WHERE status <> 'P' GROUP BY status""",
)
def partition_columns(data):
    path = staged(data, data.features.withColumn("theme", F.lit("geo")).withColumn("type", F.col("status")), "typed", "theme", "type")
    table = features.scan_table(data.spark, path)
    return (
        table.where((F.col("theme") == "geo") & (F.col("type") != "P"))
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("depth").alias("depth"))
    )


def item_documents(data: Data) -> DataFrame:
    """(path, raw, doc) of one JSON document per customer; every seventh is cut short."""
    named = data.nation.join(data.region, F.col("n_regionkey") == F.col("r_regionkey"))
    items = data.customer.join(named, F.col("c_nationkey") == F.col("n_nationkey"))
    doc = F.to_json(
        F.struct(
            F.when(F.col("c_custkey") % 5 == 0, "Style").otherwise("Feature").alias("type"),
            F.col("c_name").alias("id"),
            F.array(
                F.struct(F.lit("root").alias("rel"), F.lit("../../../catalog.json").alias("href")),
                F.struct(F.lit("parent").alias("rel"), F.lit("../collection.json").alias("href")),
            ).alias("links"),
            F.create_map(
                F.lit("data"),
                F.struct(F.concat(F.lit("https://data.example.org/"), "c_mktsegment").alias("href")),
            ).alias("assets"),
        )
    )
    path = F.concat_ws("/", "r_name", "n_name", F.lit("items"), F.concat("c_custkey", F.lit(".json")))
    raw = F.when(F.col("c_custkey") % 7 == 0, F.substring(doc, 1, 30)).otherwise(doc)
    return items.select(path.alias("path"), raw.alias("raw")).withColumn("doc", F.try_parse_json("raw"))


ITEM_PATH = "r_name || '/' || n_name || '/items/' || CAST(c_custkey AS STRING) || '.json'"
ITEM_ROWS = "FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(
    "src_5_document_links",
    f"""SELECT {ITEM_PATH} AS path, CAST(0 AS BIGINT) AS position, 'root' AS rel, '../../../catalog.json' AS href {ITEM_ROWS}
        WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0
        UNION ALL SELECT {ITEM_PATH}, 1, 'parent', '../collection.json' {ITEM_ROWS} WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0""",
)
def document_links(data):
    found = documents.links(documents.nodes(item_documents(data)))
    return found.select("path", F.col("position").cast("bigint").alias("position"), "rel", "href")


@query(
    "src_5_document_assets",
    f"""SELECT {ITEM_PATH} AS path, 'data' AS key, 'https://data.example.org/' || c_mktsegment AS href {ITEM_ROWS}
        WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0""",
)
def document_assets(data):
    return documents.assets(documents.nodes(item_documents(data))).select("path", "key", "href")


@query(
    "src_5_malformed_documents",
    f"SELECT 'error' AS severity, 'invalid JSON' AS rule_id, {ITEM_PATH} AS path {ITEM_ROWS} WHERE c_custkey % 7 = 0",
)
def malformed_documents(data):
    return documents.malformed(item_documents(data)).drop("message")


@query(
    "src_5_misshapen_fields",
    """SELECT 'error' AS severity, 'misshapen field' AS rule_id, 's' || CAST(s_suppkey AS STRING) AS path,
              CASE s_suppkey % 4 WHEN 1 THEN 'links' ELSE 'assets' END || ' is not of its form' AS message FROM supplier WHERE s_suppkey % 4 IN (1, 2)""",
)
def misshapen_fields(data):
    kind = F.col("s_suppkey") % 4
    links = F.when(kind == 1, '"none"').when(kind == 3, "null").otherwise('[{"rel": "root", "href": "x", "more": 1}]')
    assets = F.when(kind == 2, "[1]").otherwise('{"data": {"href": "y"}}')
    raw = F.concat(F.lit('{"type": "Catalog", "links": '), links, F.lit(', "assets": '), assets, F.lit("}"))
    docs = data.supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("path"), raw.alias("raw"))
    return documents.misshapen(documents.nodes(docs.withColumn("doc", F.try_parse_json("raw"))))


FOOTER_TABLES = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS row_cnt FROM {t}" for t in TABLES)


@query("src_6_footer_rows", FOOTER_TABLES)
def footer_rows(data):
    facts = footers.part_facts(footers.list_parts(data.spark, data.folder))
    return facts.groupBy(file_table().alias("name")).agg(F.sum("rows").alias("row_cnt"))


@query(
    "src_6_footer_ranges",
    """SELECT 'lineitem' AS name, 'l_orderkey' AS "column", CAST(min(l_orderkey) AS DOUBLE) AS low, CAST(max(l_orderkey) AS DOUBLE) AS high FROM lineitem
       UNION ALL SELECT 'orders', 'o_totalprice', min(o_totalprice), max(o_totalprice) FROM orders
       UNION ALL SELECT 'part', 'p_size', CAST(min(p_size) AS DOUBLE), CAST(max(p_size) AS DOUBLE) FROM part
       UNION ALL SELECT 'events', 'value', min(value), max(value) FROM events""",
)
def footer_ranges(data):
    groups = footers.row_groups(footers.list_parts(data.spark, data.folder))
    wanted = F.concat_ws(".", "name", "column").isin("lineitem.l_orderkey", "orders.o_totalprice", "part.p_size", "events.value")
    return (
        groups.withColumn("name", file_table())
        .where(wanted)
        .groupBy("name", "column")
        .agg(F.min("min_double").alias("low"), F.max("max_double").alias("high"))
    )


@query(
    "src_6_footer_harvest",
    """SELECT status AS type, count(*) AS row_cnt, true AS bounded, CAST(NULL AS STRING) AS geoparquet_version, false AS has_covering_bbox
       FROM geo_boxes GROUP BY status""",
)
def footer_harvest(data):
    path = staged(data, data.features.withColumn("type", F.col("status")), "harvest", "type")
    facts = footers.part_facts(footers.list_parts(data.spark, path))
    held = (F.col("max_row_group_rows") <= F.col("rows")) & (F.col("max_row_group_rows") * F.col("row_groups") >= F.col("rows"))
    return facts.groupBy(F.regexp_extract("path", "type=([^/]*)", 1).alias("type")).agg(
        F.sum("rows").alias("row_cnt"),
        F.bool_and(held & (F.col("row_groups") > 0)).alias("bounded"),
        F.max("geoparquet_version").alias("geoparquet_version"),
        F.bool_or("has_covering_bbox").alias("has_covering_bbox"),
    )


@query(
    "src_6_geo_metadata",
    """SELECT p_partkey AS path, CASE WHEN p_size % 5 <> 0 THEN '1.' || CAST(p_size % 2 AS STRING) || '.0' END AS geoparquet_version,
              CASE WHEN p_size % 5 <> 0 THEN 'shape' END AS geometry_column, CASE WHEN p_size % 5 <> 0 THEN 'WKB' END AS geometry_encoding,
              p_size % 5 <> 0 AND p_size % 3 = 0 AS has_covering_bbox,
              CASE WHEN p_size % 5 <> 0 THEN 'MultiPolygon,Polygon' ELSE '' END AS geometry_types FROM part""",
)
def geo_metadata(data):
    """The text that footers hold under ``geo``, with and without a covering, and none at all."""
    covering = F.when(F.col("p_size") % 3 == 0, F.lit(', "covering": {"bbox": {"xmin": ["bbox", "xmin"]}}')).otherwise("")
    geo = F.concat(
        F.lit('{"version": "1.'), F.col("p_size") % 2, F.lit('.0", "primary_column": "shape", "columns": {"other": {}, "shape": {"encoding": "WKB", '),
        F.lit('"geometry_types": ["Polygon", "MultiPolygon"]'), covering, F.lit("}}}"),
    )
    facts = data.part.select(F.col("p_partkey").alias("path"), F.when(F.col("p_size") % 5 != 0, geo).alias("geo"))
    return footers.geo_facts(facts).withColumn("geometry_types", F.concat_ws(",", "geometry_types"))


@query(
    "src_6_footer_source",
    """SELECT 'lineitem' AS name, count(*) AS row_cnt FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders""",
)
def footer_source(data):
    found = geoparquet.scan_footers(data.spark, data.folder)
    met = found.where(F.col("path").contains("lineitem.parquet") | F.col("path").contains("orders.parquet"))
    return met.groupBy(file_table().alias("name")).agg(F.sum("rows").alias("row_cnt"))


def geo_written(data: Data, row_group_rows: int = 256) -> str:
    """The features as GeoParquet along the Hilbert curve, in small row groups."""
    path = workspace(data.spark, "geoparquet")
    geoparquet.write(geoparquet.in_order(data.features, 4), path, row_group_rows=row_group_rows)
    return path


@query(
    "src_6_geoparquet_harvest",
    """SELECT count(*) AS row_cnt, '1.1.0' AS geoparquet_version, 'geometry' AS geometry_column, 'WKB' AS geometry_encoding,
              true AS has_covering_bbox, 'Polygon' AS geometry_types, true AS capped FROM geo_boxes""",
)
def geoparquet_harvest(data):
    """What the footers of written GeoParquet files say."""
    facts = footers.part_facts(footers.list_parts(data.spark, geo_written(data)))
    kept = ("geoparquet_version", "geometry_column", "geometry_encoding", "has_covering_bbox")
    told = facts.groupBy(*kept, F.concat_ws(",", "geometry_types").alias("geometry_types"))
    return told.agg(F.sum("rows").alias("row_cnt"), F.bool_and(F.col("max_row_group_rows") <= 256).alias("capped"))


@query(
    "src_6_geoparquet_ranges",
    """SELECT 'bbox.xmin' AS "column", min(xmin) AS low, max(xmin) AS high, count(*) AS row_cnt FROM geo_boxes
       UNION ALL SELECT 'bbox.ymax', min(ymax), max(ymax), count(*) FROM geo_boxes""",
)
def geoparquet_ranges(data):
    """The covering column's statistics over all row groups, through the footer source."""
    groups = geoparquet.scan_footers(data.spark, geo_written(data), chunks=True)
    return groups.where(F.col("column").isin("bbox.xmin", "bbox.ymax")).groupBy("column").agg(
        F.min("min_double").alias("low"), F.max("max_double").alias("high"), F.sum("num_rows").alias("row_cnt")
    )


@query(
    "qc_4_hilbert_order",
    """SELECT layout, layout = 'curve' AS ordered, (SELECT count(*) FROM geo_boxes) AS row_cnt FROM (VALUES ('given'), ('curve')) AS l(layout)""",
)
def hilbert_order(data):
    """Whether all files' row groups lie apart, before and after ordering along the curve."""
    given = workspace(data.spark, "given")
    geoparquet.write(data.features.coalesce(4), given, row_group_rows=32)
    groups = footers.row_groups(
        footers.list_parts(data.spark, given).unionByName(footers.list_parts(data.spark, geo_written(data, 32)))
    )
    measured = quality.spatial_order(quality.bbox_groups(groups)).withColumn("layout", F.when(F.col("path").contains("/given-"), "given").otherwise("curve"))
    rows = groups.where("column = 'id'").groupBy("path").agg(F.sum("num_rows").alias("n"))
    return measured.join(rows, "path").groupBy("layout").agg(F.bool_and("ordered").alias("ordered"), F.sum("n").alias("row_cnt"))


@query("agg_1_rows_from_footers", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("lineitem", "orders", "events")))
def rows_from_footers(data):
    counted = [
        footers.row_count(footers.list_parts(data.spark, data.folder, f"{t}*")).select(F.lit(t).alias("name"), "n") for t in ("lineitem", "orders", "events")
    ]
    return reduce(DataFrame.unionByName, counted)


@query(
    "agg_15_nulls_from_footers",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS row_cnt, count(*) - count({c}) AS nulls FROM geo_boxes""" for c in ("sparse", "depth", "subtype")
    ),
)
def nulls_from_footers(data):
    path = staged(data, data.features, "nulls")
    found = footers.null_counts(footers.list_parts(data.spark, path), ["sparse", "depth", "subtype"], path)
    return found.withColumnRenamed("rows", "row_cnt")


@query(
    "src_5_documents_from_files",
    """SELECT n_name AS id, 'Collection' AS type, CAST(k AS BIGINT) AS position, CASE k WHEN 0 THEN 'root' ELSE 'item' END AS rel,
              CASE k WHEN 0 THEN '../catalog.json' ELSE './items/' || CAST(n_nationkey AS STRING) || '.json' END AS href
       FROM nation CROSS JOIN (VALUES (0), (1)) AS l(k)""",
)
def documents_from_files(data):
    """Documents written one to a file and read back as a folder of JSON files."""
    doc = data.nation.select(
        F.lit("Collection").alias("type"),
        F.col("n_name").alias("id"),
        F.array(
            F.struct(F.lit("root").alias("rel"), F.lit("../catalog.json").alias("href")),
            F.struct(F.lit("item").alias("rel"), F.concat(F.lit("./items/"), "n_nationkey", F.lit(".json")).alias("href")),
        ).alias("links"),
    )
    path = workspace(data.spark, "documents")
    doc.write.option("maxRecordsPerFile", 1).json(path)
    found = documents.nodes(documents.read_documents(data.spark, path))
    linked = documents.links(found).select("path", F.col("position").cast("bigint").alias("position"), "rel", "href")
    return found.select("path", "id", "type").join(linked, "path").drop("path")


@query(
    "flt_3_pruned_scan",
    """SELECT status, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM geo_boxes
       WHERE xmin < 12.7 AND xmax > -8.0 AND ymin < 59.0 AND ymax > 38.6 GROUP BY status""",
)
def pruned_scan(data):
    """Parts pruned by the boxes in their own footers, and only the others opened."""
    path = staged(data, data.features.repartitionByRange(8, "bbox.xmin"), "pruned")
    boxes = quality.bbox_groups(footers.row_groups(footers.list_parts(data.spark, path)))
    manifest_rows = boxes.groupBy(F.col("path").alias("href")).agg(
        F.struct(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")).alias("bbox")
    )
    found = features.scan_windows(data.spark, path, manifest_rows, [Box("paris", -8.0, 38.6, 12.7, 59.0)])
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query(
    "snk_2_written_lines",
    """SELECT l_returnflag || '-' || l_linestatus || ' ' || CAST(l_linenumber AS STRING) AS line, count(*) AS n FROM lineitem GROUP BY ALL""",
)
def written_lines(data):
    """A report of one line per row, written and read back."""
    line = F.concat("l_returnflag", F.lit("-"), "l_linestatus", F.lit(" "), "l_linenumber")
    rows = data.lineitem.select(F.lit(0).alias("section"), F.col("l_returnflag").alias("line_key"), line.alias("line"))
    path = workspace(data.spark, "report")
    sinks.write_lines(rows, path)
    return data.spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_7_part_record",
    """SELECT collection, lpad(CAST(part_no AS STRING), 5, '0') AS part_id,
              's3://mirror/release/' || collection || '/part-' || lpad(CAST(part_no AS STRING), 5, '0') || '.parquet' AS s3
       FROM geo_parts""",
)
def part_record(data):
    return manifest.with_object_address(data.parts, "mirror").select("collection", "part_id", "s3")


@query(
    "snk_1_json_documents",
    """SELECT r_name || '/' || n_name AS collection,
              '{"collection":"' || r_name || '/' || n_name || '","customers":' || CAST(count(*) AS STRING) || '}' AS json
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""",
)
def json_documents(data):
    names = data.nation.join(data.region, F.col("n_regionkey") == F.col("r_regionkey"))
    counted = data.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    docs = names.join(counted, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.concat_ws("/", "r_name", "n_name").alias("collection"), "customers"
    )
    path = workspace(data.spark, "json")
    sinks.write_json(docs.withColumn("doc", F.struct("collection", "customers")), "doc", "collection", path, 4)
    return data.spark.read.text(path).select(
        F.get_json_object("value", "$.collection").alias("collection"), F.col("value").alias("json")
    )


@query(
    "snk_2_markdown_report",
    """SELECT 0 AS section, '1' AS line_key, '### `data`' AS line UNION ALL SELECT 0, '2', ''
       UNION ALL SELECT 1, '1', '| Rule | Path | Message |' UNION ALL SELECT 1, '2', '|---|---|---|'
       UNION ALL SELECT 2, rule_id || chr(1) || path || chr(1) || message,
              '| `' || rule_id || '` | `' || path || '` | ' || replace(message, '|', '\\|') || ' |'
       FROM findings WHERE severity = 'error'""",
)
def markdown_report(data):
    errors = data.findings.where(F.col("severity") == "error")
    return sinks.report_lines(errors, "data")


@query(
    "snk_2_delta_report",
    """SELECT 0 AS section, '1' AS line_key, 'Release `old` becomes `new`.' AS line UNION ALL SELECT 0, '2', ''
       UNION ALL SELECT 1, '1', '| Collection | Before | After | Delta |' UNION ALL SELECT 1, '2', '|---|---:|---:|---:|'
       UNION ALL SELECT 2 AS section, o.collection AS line_key,
              '| `' || o.collection || '` | ' || CAST(o.items AS STRING) || ' | ' || CAST(n.items AS STRING) || ' | '
              || CASE WHEN n.items > o.items THEN '+' ELSE '' END || CAST(n.items - o.items AS STRING) || ' |' AS line
       FROM fp_tables o JOIN fp_tables n ON o.collection = n.collection
       WHERE o.release = 'old' AND n.release = 'new' AND o.items <> n.items""",
)
def delta_report(data):
    return sinks.delta_report(part_deltas(diff(data)), "old", "new")


@query(
    "snk_3_tsv_trail",
    "SELECT CAST(s_suppkey AS STRING) AS supplier, s_name AS name, CAST(s_nationkey AS STRING) AS nation FROM supplier",
)
def tsv_trail(data):
    path = workspace(data.spark, "trail")
    rows = data.supplier.select(
        F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    sinks.write_tsv(rows, path, ["supplier"])
    schema = "supplier string, name string, nation string"
    return data.spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


@query(
    "snk_4_incremental_refresh",
    """SELECT o_orderstatus AS type, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS run, count(*) AS n
       FROM orders GROUP BY o_orderstatus""",
)
def incremental_refresh(data):
    path = workspace(data.spark, "refresh")
    rows = data.orders.select("o_orderkey", F.col("o_orderstatus").alias("type"))
    sinks.refresh(rows.withColumn("run", F.lit(1)), path, ["type"])
    sinks.refresh(rows.where(F.col("type") == "F").withColumn("run", F.lit(2)), path, ["type"])
    return data.spark.read.parquet(path).groupBy("type", "run").agg(F.count(F.lit(1)).alias("n"))


@query(
    "snk_5_part_mirror",
    """SELECT 'geo' AS theme, count(*) AS parts, CAST(sum(row_cnt) AS BIGINT) AS row_cnt FROM geo_parts
       WHERE pxmin < 12.7 AND pxmax > -8.0 AND pymin < 59.0 AND pymax > 38.6""",
)
def part_mirror(data):
    path = workspace(data.spark, "mirror")
    sinks.mirror_parts(data.parts.drop("box"), path)
    met = data.spark.read.parquet(path).where(overlaps("bbox", WINDOWS[0]))
    return met.groupBy("theme").agg(F.count(F.lit(1)).alias("parts"), F.sum("rows").alias("row_cnt"))


@query(
    "snk_1_published_changes",
    """WITH was AS (SELECT c_name AS key, c_nationkey AS nation FROM customer WHERE c_custkey % 30 <> 0),
       now AS (SELECT c_name AS key, CASE WHEN c_custkey % 10 = 1 THEN c_nationkey + 100 ELSE c_nationkey END AS nation FROM customer WHERE c_custkey % 40 <> 7)
       SELECT coalesce(was.key, now.key) AS key, 2 AS version,
              CASE WHEN now.key IS NOT NULL THEN '{"name":"' || now.key || '","nation":' || CAST(now.nation AS STRING) || '}' END AS json,
              CASE WHEN was.key IS NULL THEN 'appeared' WHEN now.key IS NULL THEN 'disappeared' WHEN was.nation <> now.nation THEN 'changed' END AS change
       FROM was FULL JOIN now ON was.key = now.key""",
)
def published_changes(data):
    """Two versions and a third of the same documents, which is none."""
    nation = F.when(F.col("c_custkey") % 10 == 1, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    was = data.customer.where(F.col("c_custkey") % 30 != 0).select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    now = data.customer.where(F.col("c_custkey") % 40 != 7).select(F.col("c_name").alias("name"), nation.alias("nation"))
    path = workspace(data.spark, "published")
    for side in (was, now, now):
        version = published.publish(side.select("name", F.struct("name", "nation").alias("doc")), "doc", "name", path)
    found = published.published(data.spark, path)
    return found.join(published.changes(data.spark, path, 1, version), "key", "full_outer").select(
        "key", F.lit(version).alias("version"), "json", "change"
    )


@query(
    "txt_1_split_lines",
    """SELECT row_number() OVER (ORDER BY doc_id, place) AS line_no, line AS text
       FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
             FROM documents WHERE text IS NOT NULL)""",
)
def split_lines(data):
    """All texts as one text in many files, its lines numbered from the splits that are read."""
    each = data.documents.where(F.col("text").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    path = workspace(data.spark, "lines")
    each.orderBy("doc_id", "place").select("line").write.text(path)
    return lines.numbered_lines(data.spark, path, across=True).select("line_no", "text")
