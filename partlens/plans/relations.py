"""Relations derived from the given tables, in SQL that Spark and the checker both run."""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partlens.functions.boxes import Box

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# The city windows widened by ten degrees, so that small data falls into each.
WINDOWS = [
    Box("paris", -8.0, 38.6, 12.7, 59.0),
    Box("philadelphia", -85.4, 29.7, -64.9, 50.1),
    Box("sao_paulo", -56.9, -33.8, -36.4, -13.4),
    Box("lagos", -6.9, -3.7, 13.6, 16.7),
    Box("delhi", 66.9, 18.4, 87.4, 38.8),
    Box("tokyo", 129.5, 25.5, 150.0, 45.9),
    Box("sydney", 140.8, -44.1, 161.4, -23.7),
]

_TICK = "chr(96) || chr(96) || chr(96)"

RELATIONS = {
    "geo_boxes": """
SELECT o_orderkey AS id, o_orderpriority AS subtype, o_orderstatus AS status,
       CAST(o_custkey AS STRING) AS cust,
       CASE WHEN o_orderkey % 20 = 0 THEN 'rare' || CAST(o_orderkey % 3 AS STRING) ELSE 'common' END AS dominant,
       CASE WHEN o_orderkey % 10 = 0 THEN 'm' || CAST(o_orderkey % 40 AS STRING) END AS sparse,
       'b' || CAST(CAST(floor(((o_orderkey * 7919) % 36000) / 3000.0) AS INT) AS STRING) AS band,
       CAST((o_orderkey % 10) * 10 AS INT) AS depth,
       CAST(((o_orderkey * 7919) % 36000) AS DOUBLE) / 100 - 180 AS xmin,
       CAST(((o_orderkey * 7919) % 36000) AS DOUBLE) / 100 - 179.5 AS xmax,
       CAST(((o_orderkey * 104729) % 17900) AS DOUBLE) / 100 - 90 AS ymin,
       CAST(((o_orderkey * 104729) % 17900) AS DOUBLE) / 100 - 89.5 AS ymax
FROM orders""",
    "sample_windows": "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{w.name}', CAST({w.xmin} AS DOUBLE), CAST({w.ymin} AS DOUBLE), "
        f"CAST({w.xmax} AS DOUBLE), CAST({w.ymax} AS DOUBLE))"
        for w in WINDOWS
    )
    + ") AS w(name, wx0, wy0, wx1, wy1)",
    "geo_sample": """
SELECT name AS "window", g.*
FROM geo_boxes g JOIN sample_windows ON xmin < wx1 AND xmax > wx0 AND ymin < wy1 AND ymax > wy0""",
    "geo_parts": """
SELECT 'geo/' || status AS collection,
       CAST(floor((xmin + 180) / 10) AS INT) AS part_no,
       CASE WHEN floor((xmin + 180) / 10) = 0 THEN CAST(-180.00022888183594 AS DOUBLE) ELSE min(xmin) END AS pxmin,
       min(ymin) AS pymin, max(xmax) AS pxmax, max(ymax) AS pymax,
       count(*) AS row_cnt, CAST(1 + count(*) % 4 AS INT) AS row_groups,
       CASE WHEN status = 'F' THEN 'Polygon' WHEN status = 'O' THEN 'LineString' ELSE 'Point' END AS geometry_type
FROM geo_boxes
GROUP BY status, floor((xmin + 180) / 10)""",
    "land_parts": """
SELECT r_name || '/' || lower(replace(n_name, 'NATION', 'land')) AS collection,
       CAST(o_orderkey % (1 + n_nationkey % 4) AS INT) AS part_no,
       count(*) AS row_cnt, max(o_custkey) AS max_group,
       CASE WHEN n_nationkey % 3 = 0 THEN '1.0.0' ELSE '1.1.0' END AS version
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name, n_nationkey, o_orderkey % (1 + n_nationkey % 4)""",
    "lands": """
SELECT r_name || '/' || lower(replace(n_name, 'NATION', 'land')) AS collection,
       CASE WHEN n_nationkey % 3 = 0 THEN 'ODbL-1.0' WHEN n_nationkey % 3 = 1 THEN 'CC0-1.0' ELSE 'CC-BY-4.0' END AS license,
       CASE WHEN n_nationkey % 4 = 0 THEN lower(replace(n_name, 'NATION', 'land'))
            WHEN n_nationkey % 4 = 1 THEN 'Plain ' || n_name
            WHEN n_nationkey % 4 = 2 THEN replace(n_name, 'NATION_', 'Land ') END AS title,
       CASE WHEN n_nationkey % 5 <> 0 THEN 'About ' || n_name END AS description,
       CAST(n_nationkey * 16.0 - 200.5 AS DOUBLE) AS x0, CAST(n_nationkey * 8.0 - 95.25 AS DOUBLE) AS y0,
       CAST(n_nationkey * 16.0 - 150.25 AS DOUBLE) AS x1, CAST(n_nationkey * 8.0 - 60.5 AS DOUBLE) AS y1
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fp_columns": """
SELECT 'old' AS release, p_brand AS collection, p_type AS column_name
FROM part WHERE p_brand <> 'Brand#1' AND (length(p_type) + CAST(substring(p_brand, 7) AS INT)) % 5 <> 0 GROUP BY p_brand, p_type
UNION ALL
SELECT 'new' AS release, p_brand AS collection, p_type AS column_name
FROM part WHERE p_brand <> 'Brand#2' AND (length(p_type) + CAST(substring(p_brand, 7) AS INT)) % 7 <> 0 GROUP BY p_brand, p_type""",
    "fp_tables": """
SELECT 'old' AS release, p_brand AS collection, count(*) AS items,
       CASE WHEN min(p_size) % 2 = 0 THEN 'ODbL-1.0' ELSE 'CC0-1.0' END AS license,
       '1.1.0' AS geoparquet, max(p_size) * 3000 AS max_row_group_rows,
       CAST(150000 AS BIGINT) AS row_group_cap
FROM part WHERE p_brand <> 'Brand#1' AND p_partkey % 7 <> 0 GROUP BY p_brand
UNION ALL
SELECT 'new' AS release, p_brand AS collection, count(*) AS items,
       CASE WHEN min(p_size) % 3 = 0 THEN 'ODbL-1.0' ELSE 'CC0-1.0' END AS license,
       CASE WHEN max(p_size) % 5 = 0 THEN '1.1.0' ELSE '1.0.0' END AS geoparquet,
       max(p_size) * 3001 AS max_row_group_rows,
       CASE WHEN max(p_size) % 7 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(150000 AS BIGINT) END AS row_group_cap
FROM part WHERE p_brand <> 'Brand#2' AND p_partkey % 5 <> 0 GROUP BY p_brand""",
    "md_lines": f"""
SELECT item_id AS file_id, ln AS line_no,
       CASE WHEN ln = 1 THEN 'Guide ' || CAST(item_id AS STRING)
            WHEN ln IN (3, 8) AND (ln = 3 OR item_id % 2 = 0) THEN {_TICK} || 'sql'
            WHEN ln IN (6, 10) AND (ln = 6 OR item_id % 2 = 0) THEN {_TICK}
            WHEN ln IN (4, 5, 9) THEN 'SELECT ' || CAST(item_id * 10 + ln AS STRING)
            ELSE '' END AS text
FROM benchmark JOIN (VALUES (1), (2), (3), (4), (5), (6), (7), (8), (9), (10)) AS l(ln) ON true""",
    "enum_lines": """
SELECT conv_id AS file_id, turn * 5 + k AS line_no,
       CASE WHEN k = 0 THEN '  - v' || CAST(turn % 3 AS STRING) || CASE WHEN turn % 2 = 0 THEN '  #first ' || role ELSE '' END
            WHEN k = 1 THEN CASE WHEN turn % 4 < 3 THEN '      # more ' || CAST(turn AS STRING) ELSE '' END
            WHEN k = 2 THEN ''
            WHEN k = 3 THEN CASE WHEN turn % 5 = 0 THEN '  # after blank' ELSE '' END
            ELSE CASE WHEN turn % 2 = 1 THEN 'type: string' ELSE '' END END AS text
FROM conversations JOIN (VALUES (0), (1), (2), (3), (4)) AS x(k) ON true""",
    "cat_nodes": """
SELECT 'catalog.json' AS path, 'Catalog' AS type
UNION ALL SELECT r_name || '/catalog.json', 'Catalog' FROM region
UNION ALL SELECT r_name || '/' || n_name || '/collection.json', 'Collection'
  FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT r_name || '/' || n_name || '/items/' || CAST(c_custkey AS STRING) || '.json', 'Feature'
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_custkey % 13 <> 0""",
    "cat_links": """
SELECT 'catalog.json' AS path, 'child' AS rel, './' || r_name || '/catalog.json' AS href FROM region
UNION ALL SELECT r_name || '/catalog.json', 'child', './' || n_name || '/collection.json'
  FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT r_name || '/catalog.json', 'root', '../catalog.json' FROM region
UNION ALL SELECT r_name || '/' || n_name || '/collection.json', 'item', './items/' || CAST(c_custkey AS STRING) || '.json'
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT r_name || '/' || n_name || '/items/' || CAST(c_custkey AS STRING) || '.json', 'root', '../../../catalog.json'
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_custkey % 13 <> 0
UNION ALL SELECT r_name || '/catalog.json', 'via', 'https://example.org/' || r_name FROM region""",
    "cat_assets": """
SELECT r_name || '/' || n_name || '/items/' || CAST(c_custkey AS STRING) || '.json' AS path,
       CASE WHEN c_custkey % 4 = 0 THEN 'thumbnail' WHEN c_custkey % 4 = 1 THEN 'visual' ELSE 'data' END AS key,
       CASE WHEN c_custkey % 8 = 0 THEN './thumbnail.png'
            WHEN c_custkey % 8 = 4 THEN './' || CAST(c_custkey AS STRING) || '.json'
            WHEN c_custkey % 4 = 1 THEN 'https://tiles.example.org/' || n_name || '.pmtiles'
            WHEN c_custkey % 4 = 2 THEN 'https://data.example.org/' || CAST(c_custkey % 100 AS STRING) || '.parquet'
            ELSE '../data/' || CAST(c_custkey AS STRING) || '.PARQUET' END AS href
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT r_name || '/' || n_name || '/collection.json', 'data', 'https://data.example.org/' || n_name || '.parquet'
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0""",
    "ref_nodes": """
SELECT p_partkey AS node,
       CASE WHEN p_partkey % 20 <> 0 THEN p_partkey - 1 END AS ref,
       CASE WHEN p_partkey % 20 = 0 OR p_partkey % 6 = 0 THEN p_type END AS description,
       CASE WHEN p_partkey % 20 = 0 THEN p_brand END AS title
FROM part""",
    "ref_members": """
SELECT p_partkey AS node, CAST(k AS INT) AS ordinal, p_partkey * 2 + k AS member
FROM part JOIN (VALUES (1), (2)) AS m(k) ON true WHERE p_partkey % 3 <> 0""",
    "ref_properties": """
SELECT p_partkey AS node, p_type AS name, p_brand || '/' || CAST(p_partkey AS STRING) AS value FROM part
UNION ALL SELECT p_partkey, p_name, CAST(p_size AS STRING) FROM part WHERE p_partkey % 2 = 0""",
    "meanings": """
SELECT p_brand AS collection, p_type AS column_name,
       CASE WHEN min(p_size) % 3 = 0 THEN '' WHEN min(p_size) % 3 = 1 THEN 'From   the  schema: ' || min(p_name) END AS description
FROM part WHERE p_partkey % 3 <> 0 GROUP BY p_brand, p_type""",
    "findings": """
SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'error' WHEN event_type = 'click' THEN 'warning' ELSE 'info' END AS severity,
       'QR-' || CAST(event_id % 9 AS STRING) AS rule_id,
       'u/' || CAST(user_id AS STRING) AS path,
       'host ''h' || CAST(user_id % 3 AS STRING) || ''' | ' || event_type AS message
FROM events""",
    "hrefs": """
SELECT 'doc/' || CAST(l_orderkey AS STRING) AS path,
       'https://h' || CAST(l_suppkey % 5 AS STRING) || '.example.org/p' || CAST(l_partkey AS STRING)
         || CASE WHEN l_linenumber % 2 = 0 THEN '.parquet' ELSE '.PMTILES' END AS href,
       CASE WHEN l_partkey % 17 = 0 THEN 404 WHEN l_partkey % 23 = 0 THEN NULL ELSE 200 END AS status
FROM lineitem""",
    "version_text": """
SELECT p_partkey AS id, p_brand AS package,
       CASE WHEN p_partkey % 11 = 0 THEN 'no version here'
            ELSE 'tool, version ' || CAST(p_size % 2 AS STRING) || '.' || CAST(p_size % 13 AS STRING) || '.' || CAST(p_partkey % 12 AS STRING)
                 || CASE WHEN p_partkey % 9 = 0 THEN 'rc1' ELSE '' END END AS text,
       p_partkey % 4 <> 0 AS yanked
FROM part""",
}


def needed(sql: str) -> list[str]:
    """Derived relations a statement uses, directly or through others, in build order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & RELATIONS.keys() - found:
            found.add(name)
            todo.append(RELATIONS[name])
    return [n for n in RELATIONS if n in found]


def checker_sql(sql: str) -> str:
    """``sql`` with the derived relations it uses put in front."""
    body = sql.strip()
    ctes = [f"{n} AS ({RELATIONS[n].strip()})" for n in needed(body)]
    if body.upper().startswith("WITH "):
        own = body[5:]
        own = own[10:] if own.upper().startswith("RECURSIVE ") else own
        return "WITH RECURSIVE " + ",\n".join([*ctes, own])
    return ("WITH RECURSIVE " + ",\n".join(ctes) + "\n" if ctes else "") + body


def _explode_lists(sql: str) -> str:
    """Spark's form of a join with a literal list: an explode on every row."""

    def form(m: re.Match) -> str:
        values = ", ".join(re.findall(r"\((\d+)\)", m[1]))
        return f"LATERAL VIEW explode(array({values})) {m[2]} AS {m[3]}"

    return re.sub(r"JOIN \(VALUES ((?:\(\d+\)(?:, )?)+)\) AS (\w+)\((\w+)\) ON true", form, sql)


class Data:
    """The given tables of one folder and the relations derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.load = cache(self._load)

    def _load(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        sql = _explode_lists(RELATIONS[name])
        words = set(re.findall(r"\w+", sql))
        inputs = {n: self.load(n) for n in words & {*TABLES, *RELATIONS} if self._reads(sql, n)}
        named = re.sub(
            r"\b(FROM|JOIN)\s+(\w+)\b",
            lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in inputs else m[0],
            sql,
        )
        return self.spark.sql(named, **inputs)

    @staticmethod
    def _reads(sql: str, name: str) -> bool:
        return re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql) is not None

    def __getattr__(self, name: str) -> DataFrame:
        if name in RELATIONS or name in TABLES:
            return self.load(name)
        raise AttributeError(name)

    @property
    def features(self) -> DataFrame:
        """geo_boxes as a feature table: the four leaves folded into a bbox struct."""
        box = F.struct("xmin", "ymin", "xmax", "ymax")
        return self.geo_boxes.withColumn("bbox", box).drop("xmin", "ymin", "xmax", "ymax")

    @property
    def parts(self) -> DataFrame:
        """geo_parts in the shape of a part manifest."""
        part = F.format_string("%05d", "part_no")
        return self.geo_parts.select(
            "collection",
            part.alias("part_id"),
            F.array("pxmin", "pymin", "pxmax", "pymax").alias("bbox"),
            F.struct(
                F.col("pxmin").alias("xmin"), F.col("pymin").alias("ymin"),
                F.col("pxmax").alias("xmax"), F.col("pymax").alias("ymax"),
            ).alias("box"),
            F.concat(
                F.lit("https://bucket.s3.example.amazonaws.com/release/"), "collection", F.lit("/part-"), part, F.lit(".parquet")
            ).alias("href"),
            F.col("row_cnt").alias("rows"),
            "row_groups",
            F.ceil(F.col("row_cnt") / F.col("row_groups")).alias("max_row_group_rows"),
            F.array("geometry_type").alias("geometry_types"),
        )

    @property
    def lands_parts(self) -> DataFrame:
        """land_parts in the shape of a part manifest."""
        return self.land_parts.select(
            "collection",
            F.format_string("%05d", "part_no").alias("part_id"),
            F.col("row_cnt").alias("rows"),
            F.col("max_group").alias("max_row_group_rows"),
            F.col("version").alias("geoparquet_version"),
        )

    @property
    def window_table(self) -> DataFrame:
        """sample_windows with a box struct."""
        w = self.sample_windows
        box = F.struct(
            F.col("wx0").alias("xmin"), F.col("wy0").alias("ymin"), F.col("wx1").alias("xmax"), F.col("wy1").alias("ymax")
        )
        return w.select(F.col("name").alias("window"), box.alias("window_bbox"))
