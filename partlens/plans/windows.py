"""FLT, window-join and set queries over the feature table and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from partlens.functions import paths
from partlens.functions.boxes import Box, corner_within, overlaps
from partlens.operators import graph, manifest, profile, spatial, totals
from partlens.plans.registry import query
from partlens.plans.relations import WINDOWS
from partlens.sources.features import group_count

PARIS = WINDOWS[0]
CORNER = Box("corner", -30.0, 11.2, 40.0, 51.8)


@query(
    "flt_1_window_overlap",
    "SELECT id, subtype, depth FROM geo_boxes WHERE xmin < 12.7 AND xmax > -8.0 AND ymin < 59.0 AND ymax > 38.6",
)
def window_overlap(data):
    return data.features.where(overlaps("bbox", PARIS)).select("id", "subtype", "depth")


@query(
    "flt_2_corner_in_window",
    "SELECT count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM geo_boxes WHERE xmin BETWEEN -30.0 AND 40.0 AND ymin BETWEEN 11.2 AND 51.8",
)
def corner_in_window(data):
    return data.features.where(corner_within("bbox", CORNER)).agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")
    )


@query(
    "flt_3_part_pruning",
    """SELECT collection, count(*) AS parts FROM geo_parts
       WHERE pxmin < 12.7 AND pxmax > -8.0 AND pymin < 59.0 AND pymax > 38.6 GROUP BY collection""",
)
def part_pruning(data):
    return spatial.prune_parts(data.parts, [PARIS], "box").groupBy("collection").agg(F.count(F.lit(1)).alias("parts"))


@query(
    "flt_4_scan_scope",
    """SELECT collection, 'all' AS scope, CAST(sum(row_cnt) AS BIGINT) AS row_cnt, count(*) AS parts, true AS exhaustive
       FROM geo_parts GROUP BY collection""",
)
def scan_scope(data):
    return spatial.scan_scopes(data.parts, (), "box").withColumnRenamed("rows", "row_cnt")


# A window far from every part, so that a scope without parts shows.
NOWHERE = Box("nowhere", 175.0, -89.0, 179.0, -88.0)


@query(
    "flt_4_scan_scope_windowed",
    """WITH size AS (SELECT collection, CAST(sum(row_cnt) AS BIGINT) AS row_cnt FROM geo_parts GROUP BY collection),
       w AS (SELECT name, wx0, wy0, wx1, wy1 FROM sample_windows UNION ALL SELECT 'nowhere', 175.0, -89.0, 179.0, -88.0)
       SELECT s.collection, w.name AS scope, s.row_cnt, count(p.collection) AS parts, false AS exhaustive FROM size s CROSS JOIN w
       LEFT JOIN geo_parts p ON p.collection = s.collection AND pxmin < wx1 AND pxmax > wx0 AND pymin < wy1 AND pymax > wy0
       GROUP BY ALL""",
)
def scan_scope_windowed(data):
    return spatial.scan_scopes(data.parts, [*WINDOWS, NOWHERE], "box").withColumnRenamed("rows", "row_cnt")


@query(
    "flt_5_column_skip",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{k}' AS kind, count({c}) AS present FROM geo_boxes""" for c, k in [
            ("subtype", "text"), ("status", "text"), ("cust", "text"), ("dominant", "text"),
            ("sparse", "text"), ("band", "text"), ("depth", "numeric"),
        ]
    ),
)
def column_skip(data):
    """The columns a profile reads, with what their type allows and how often they hold a value."""
    kinds = profile.column_kinds(data.features)
    shares = profile.null_share(data.features, list(kinds))
    listed = F.create_map(*(F.lit(v) for pair in kinds.items() for v in pair))
    return shares.select("column", listed[F.col("column")].alias("kind"), "present")


@query(
    "flt_6_not_null",
    "SELECT sparse AS value, count(*) AS n FROM geo_boxes WHERE sparse IS NOT NULL GROUP BY sparse",
)
def not_null(data):
    return data.features.where(F.col("sparse").isNotNull()).groupBy(F.col("sparse").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "flt_8_link_filter",
    """SELECT path, href FROM cat_links WHERE rel = 'item'
       UNION ALL SELECT path, href FROM cat_assets WHERE key IN ('data', 'visual')""",
)
def link_filter(data):
    items = graph.links_of(data.cat_links, "item").select("path", "href")
    return items.unionByName(data.cat_assets.where(F.col("key").isin(*graph.REMOTE_ASSETS)).select("path", "href"))


@query(
    "flt_8_latest_child",
    """SELECT r_name || '/catalog.json' AS path, './' || n_name || '/collection.json' AS href
       FROM nation JOIN region ON n_regionkey = r_regionkey
       WHERE n_nationkey IN (SELECT max(n_nationkey) FROM nation GROUP BY n_regionkey)""",
)
def latest_child(data):
    newest = data.nation.groupBy("n_regionkey").agg(F.max("n_nationkey").alias("n_nationkey")).withColumn("latest", F.lit(True))
    listed = data.nation.join(newest, ["n_regionkey", "n_nationkey"], "left").join(
        data.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    links = listed.select(
        F.concat("r_name", F.lit("/catalog.json")).alias("path"),
        F.lit("child").alias("rel"),
        F.concat(F.lit("./"), "n_name", F.lit("/collection.json")).alias("href"),
        "latest",
    )
    return graph.latest_child(links).select("path", "href")


@query(
    "flt_9_remote_href",
    r"""WITH h AS (SELECT DISTINCT href FROM cat_links UNION SELECT DISTINCT href FROM cat_assets
                  UNION SELECT DISTINCT '#' || n_name FROM nation UNION SELECT DISTINCT 'mailto:' || s_name FROM supplier)
       SELECT href, contains(href, '://') OR href LIKE '#%' OR href LIKE 'mailto:%' AS remote,
              href LIKE 'http://%' OR href LIKE 'https://%' AS web FROM h""",
)
def remote_href(data):
    named = [
        data.cat_links.select("href"),
        data.cat_assets.select("href"),
        data.nation.select(F.concat(F.lit("#"), "n_name").alias("href")),
        data.supplier.select(F.concat(F.lit("mailto:"), "s_name").alias("href")),
    ]
    every = named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3]).distinct()
    return every.select("href", paths.is_remote(F.col("href")).alias("remote"), paths.is_web(F.col("href")).alias("web"))


@query(
    "flt_10_data_suffix",
    r"""SELECT path, href, regexp_matches(lower(href),
              '\.(parquet|pmtiles|tif|tiff|copc\.laz|laz|gpkg|zarr|geojsonl|shp|zip)$') AS data_file
       FROM (SELECT DISTINCT path, href FROM cat_assets)""",
)
def data_suffix(data):
    return data.cat_assets.select("path", "href").distinct().withColumn("data_file", paths.is_data_file(F.col("href")))


@query(
    "flt_11_subset",
    """SELECT path, type FROM cat_nodes WHERE path IN ('catalog.json', 'ASIA/catalog.json') OR path LIKE 'ASIA/NATION#_2/%' ESCAPE '#'""",
)
def subset(data):
    return graph.subset(data.cat_nodes, data.cat_links, "ASIA", "NATION_2")


@query(
    "flt_11_subset_links",
    """SELECT path, rel, href FROM cat_links WHERE path LIKE 'ASIA/NATION#_2/%' ESCAPE '#'
       OR (path = 'catalog.json' AND href = './ASIA/catalog.json')
       OR (path = 'ASIA/catalog.json' AND (rel <> 'child' OR href = './NATION_2/collection.json'))""",
)
def subset_links(data):
    return graph.subset_links(data.cat_links, "ASIA", "NATION_2")


@query("flt_12_key_selection", "SELECT collection, license FROM lands WHERE collection IN ('ASIA/land_2', 'EUROPE/land_3')")
def key_selection(data):
    return manifest.select_keys(data.lands, ["ASIA/land_2", "EUROPE/land_3"]).select("collection", "license")


@query(
    "join_3_windows_by_parts",
    """SELECT name AS "window", collection, count(*) AS parts FROM geo_parts
       JOIN sample_windows ON pxmin < wx1 AND pxmax > wx0 AND pymin < wy1 AND pymax > wy0 GROUP BY name, collection""",
)
def windows_by_parts(data):
    met = spatial.overlap_join(data.parts, data.window_table, salt_by=["part_id"], bbox="box")
    return met.groupBy("window", "collection").agg(F.count(F.lit(1)).alias("parts"))


@query("join_4_window_sample", 'SELECT "window", id, subtype, depth FROM geo_sample')
def window_sample(data):
    return spatial.overlap_join(data.features, data.window_table, salt_by=["id"]).select("window", "id", "subtype", "depth")


@query(
    "join_4_window_sample_literal",
    'SELECT "window", count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM geo_sample GROUP BY "window"',
)
def window_sample_literal(data):
    sampled = spatial.sample(data.features, spatial.Scope(False, tuple(WINDOWS)))
    return sampled.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query(
    "join_4_many_windows",
    """WITH w AS (SELECT c_custkey AS window_id, CAST((c_custkey * 37) % 340 - 180 AS DOUBLE) AS wx0, CAST((c_custkey * 53) % 160 - 90 AS DOUBLE) AS wy0 FROM customer)
       SELECT window_id, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM geo_boxes
       JOIN w ON xmin < wx0 + 3 AND xmax > wx0 AND ymin < wy0 + 2 AND ymax > wy0 GROUP BY window_id""",
)
def many_windows(data):
    x = ((F.col("c_custkey") * 37) % 340 - 180).cast("double")
    y = ((F.col("c_custkey") * 53) % 160 - 90).cast("double")
    windows = data.customer.select(
        F.col("c_custkey").alias("window_id"),
        F.struct(x.alias("xmin"), y.alias("ymin"), (x + 3).alias("xmax"), (y + 2).alias("ymax")).alias("window_bbox"),
    )
    met = totals.overlap_totals(data.features, windows, "id")
    return met.groupBy("window_id").agg(F.sum("n").alias("n"), F.sum("total").alias("ids"))


# City blocks, a few countries and, once in a thousand, the whole world, on either side of the join.
_MIXED_SQL = """
    WITH f AS (
        SELECT id, CASE WHEN id % 1000 = 0 THEN -180.0 ELSE xmin END AS x0, CASE WHEN id % 1000 = 0 THEN -90.0 ELSE ymin END AS y0,
               CASE WHEN id % 1000 = 0 THEN 180.0 WHEN id % 50 = 0 THEN xmin + 24 ELSE xmin + 0.004 END AS x1,
               CASE WHEN id % 1000 = 0 THEN 90.0 WHEN id % 50 = 0 THEN ymin + 11 ELSE ymin + 0.002 END AS y1
        FROM geo_boxes),
    w AS (
        SELECT c_custkey AS window_id, CAST((c_custkey * 37) % 340 - 180 AS DOUBLE) AS x0, CAST((c_custkey * 53) % 160 - 90 AS DOUBLE) AS y0,
               CAST(CASE WHEN c_custkey % 100 = 0 THEN 60 WHEN c_custkey % 10 = 0 THEN 4 ELSE 0.03125 END AS DOUBLE) AS wide
        FROM customer)
    SELECT window_id, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM f
    JOIN w ON f.x0 < w.x0 + wide AND f.x1 > w.x0 AND f.y0 < w.y0 + wide AND f.y1 > w.y0 GROUP BY window_id"""


@query("join_4_mixed_extents", _MIXED_SQL)
def mixed_extents(data):
    world, country = F.col("id") % 1000 == 0, F.col("id") % 50 == 0

    def side(low, all_of_it, wide, block):
        return F.when(world, F.lit(all_of_it)).when(country, F.col(low) + wide).otherwise(F.col(low) + block)

    features = data.features.select(
        "id",
        F.struct(
            F.when(world, -180.0).otherwise(F.col("bbox.xmin")).alias("xmin"),
            F.when(world, -90.0).otherwise(F.col("bbox.ymin")).alias("ymin"),
            side("bbox.xmin", 180.0, 24, 0.004).alias("xmax"),
            side("bbox.ymin", 90.0, 11, 0.002).alias("ymax"),
        ).alias("bbox"),
    )
    number = F.col("c_custkey")
    x, y = ((number * 37) % 340 - 180).cast("double"), ((number * 53) % 160 - 90).cast("double")
    wide = F.when(number % 100 == 0, 60.0).when(number % 10 == 0, 4.0).otherwise(0.03125)
    windows = data.customer.select(
        number.alias("window_id"),
        F.struct(x.alias("xmin"), y.alias("ymin"), (x + wide).alias("xmax"), (y + wide).alias("ymax")).alias("window_bbox"),
    )
    met = totals.overlap_totals(features, windows, "id")
    return met.groupBy("window_id").agg(F.sum("n").alias("n"), F.sum("total").alias("ids"))


@query("agg_1_row_count", "SELECT count(*) AS n FROM geo_boxes")
def row_count(data):
    return data.features.agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_1_row_count_in_window",
    "SELECT count(*) AS n FROM geo_boxes WHERE xmin BETWEEN -0.6 AND 10.4 AND ymin BETWEEN 41.2 AND 51.8",
)
def row_count_in_window(data):
    return data.features.where(corner_within("bbox", Box("w", -0.6, 41.2, 10.4, 51.8))).agg(F.count(F.lit(1)).alias("n"))


@query("agg_2_group_count", "SELECT depth, count(*) AS n FROM geo_boxes GROUP BY depth ORDER BY depth LIMIT 5")
def group_counts(data):
    return group_count(data.features, "depth", 5)


@query("set_1_union_of_windows", 'SELECT DISTINCT cust AS value FROM geo_sample')
def union_of_windows(data):
    sampled = spatial.sample(data.features, spatial.Scope(False, tuple(WINDOWS)))
    per_window = sampled.select("window", F.col("cust").alias("value")).distinct()
    return per_window.select("value").distinct()


@query("sort_6_ordered_limit", "SELECT subtype, count(*) AS n FROM geo_boxes GROUP BY subtype ORDER BY subtype LIMIT 3")
def ordered_limit(data):
    return group_count(data.features, "subtype", 3)
