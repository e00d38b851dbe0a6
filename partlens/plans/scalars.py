"""Scalar-function and text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from partlens.functions import boxes, paths
from partlens.functions import text as words
from partlens.operators import blocks, spatial
from partlens.plans.registry import query
from partlens.plans.relations import Data

CIRC = "CAST(40075016.685578488 AS DOUBLE)"
HELD = "greatest(least({v}, 85.05112878), -85.05112878)"
MX = f"({{v}} * {CIRC} / 360.0)"
MY = f"({CIRC} * ln(tan(pi() / 4 + radians({HELD}) / 2)) / (2 * pi()))"
LON = f"({{v}} * 360.0 / {CIRC})"
LAT = f"(degrees(2 * atan(exp({{v}} * 2 * pi() / {CIRC})) - pi() / 2))"


def sql(template: str, value: str) -> str:
    return template.replace("{v}", value)


@query(
    "fn_1_clamp_bbox",
    """SELECT collection, x0 AS before, greatest(least(x0, 180.0), -180.0) AS west, greatest(least(y0, 90.0), -90.0) AS south,
              greatest(least(x1, 180.0), -180.0) AS east, greatest(least(y1, 90.0), -90.0) AS north
       FROM (SELECT collection, x0 * 1.2 AS x0, y0 * 1.3 AS y0, x1 * 1.1 AS x1, y1 * 1.4 AS y1 FROM lands)
       UNION ALL SELECT 'box/' || CAST(id AS STRING), xmin, greatest(least(xmin, 180.0), -180.0), greatest(least(ymin, 90.0), -90.0),
              greatest(least(xmax, 180.0), -180.0), greatest(least(ymax, 90.0), -90.0) FROM geo_boxes""",
)
def clamp_bbox(data):
    land = data.lands.select(
        "collection", F.array(F.col("x0") * 1.2, F.col("y0") * 1.3, F.col("x1") * 1.1, F.col("y1") * 1.4).alias("bbox")
    )
    box = data.geo_boxes.select(
        F.concat(F.lit("box/"), "id").alias("collection"), F.array("xmin", "ymin", "xmax", "ymax").alias("bbox")
    )
    held = land.unionByName(box).withColumn("held", boxes.clamp_bbox(F.col("bbox")))
    side = [F.element_at("held", i + 1).alias(n) for i, n in enumerate(("west", "south", "east", "north"))]
    return held.select("collection", F.element_at("bbox", 1).alias("before"), *side)


@query(
    "qc_9_bbox_audit",
    "WITH b AS (SELECT collection, part_no, pxmin, pymin, pxmax, pymax FROM geo_parts) "
    + " UNION ALL ".join(
        f"""SELECT collection, lpad(CAST(part_no AS STRING), 5, '0') AS part_id, '{axis}' AS axis, CAST({i} AS BIGINT) AS position,
            {c} AS before, CAST(CASE WHEN {c} > 0 THEN {lim} ELSE -{lim} END AS DOUBLE) AS after FROM b WHERE abs({c}) > {lim}"""
        for i, (c, axis, lim) in enumerate(
            [("pxmin", "lon", "180.0"), ("pymin", "lat", "90.0"), ("pxmax", "lon", "180.0"), ("pymax", "lat", "90.0")]
        )
    ),
)
def bbox_audit(data):
    found = spatial.bbox_audit(data.parts.select("collection", "part_id", "bbox"))
    return found.withColumn("position", F.col("position").cast("bigint"))


@query(
    "fn_2_mercator",
    f"""WITH m AS (SELECT id, {sql(MX, 'xmin')} AS x, {sql(MY, 'ymin')} AS y FROM geo_boxes)
        SELECT id, round(x, 2) AS x, round(y, 2) AS y, round({sql(LON, 'x')}, 6) AS lon, round({sql(LAT, 'y')}, 6) AS lat FROM m""",
)
def mercator(data):
    made = data.geo_boxes.select(
        "id", boxes.mercator_x(F.col("xmin")).alias("x"), boxes.mercator_y(F.col("ymin")).alias("y")
    )
    return made.select(
        "id", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"),
        F.round(boxes.longitude(F.col("x")), 6).alias("lon"), F.round(boxes.latitude(F.col("y")), 6).alias("lat"),
    )


def frame_columns(df, *more, lon_places: int = 6):
    places = {"lon0": lon_places, "lat0": 6, "lon1": lon_places, "lat1": 6}
    side = [F.round(F.col(f"frame.{n}"), p).alias(n) for n, p in places.items()]
    return df.select("id", *side, *more)


@query(
    "fn_3_zoom_frame",
    f"""WITH m AS (SELECT id, {sql(MX, 'xmin')} AS x, {sql(MY, 'ymin')} AS y, {CIRC} * 1024 / (256 * pow(2, 3 + id % 12)) AS span FROM geo_boxes)
        SELECT id, round({sql(LON, '(x - span / 2)')}, 10) AS lon0, round({sql(LAT, '(y - span / 3)')}, 6) AS lat0,
               round({sql(LON, '(x + span / 2)')}, 10) AS lon1, round({sql(LAT, '(y + span / 3)')}, 6) AS lat1 FROM m""",
)
def zoom_frame(data):
    placed = data.geo_boxes.withColumn("zoom", F.lit(3) + F.col("id") % 12)
    # Ten places hold these longitudes exactly, so none sits on a rounding edge.
    return frame_columns(boxes.zoom_frame(placed, "xmin", "ymin", "zoom"), lon_places=10)


# Boxes of every shape: points, slivers, wide, tall and world-sized ones.
SHAPES = """SELECT id, xmin AS x0, ymin AS y0,
  CASE id % 5 WHEN 0 THEN xmin WHEN 1 THEN xmin + 0.001 WHEN 2 THEN xmin + 40 WHEN 3 THEN xmin + 2 ELSE least(xmin + 330, 200.0) END AS x1,
  CASE id % 7 WHEN 0 THEN ymin WHEN 1 THEN ymin + 0.002 WHEN 2 THEN least(ymin + 60, 90.0) WHEN 3 THEN ymin + 0.4 ELSE least(ymin + 1, 90.0) END AS y1
  FROM geo_boxes"""


@query(
    "fn_4_fit_frame",
    f"""WITH s AS ({SHAPES}),
a AS (SELECT id, {sql(MX, 'x0')} AS x0, {sql(MY, 'y0')} AS y0, {sql(MX, 'x1')} AS x1, {sql(MY, 'y1')} AS y1 FROM s),
b AS (SELECT *, greatest(x1 - x0, 1000.0) AS dw, greatest(y1 - y0, 1000.0) AS dh FROM a),
c AS (SELECT id, x0 - dw * 0.05 AS x0, x1 + dw * 0.05 AS x1, y0 - dh * 0.05 AS y0, y1 + dh * 0.05 AS y1, dw, dh,
        abs(x1 - x0) < 1 AS flat_x, abs(y1 - y0) < 1 AS flat_y FROM b),
d AS (SELECT *, CASE WHEN (x1 - x0) / (y1 - y0) < 1.5 THEN greatest(least((y1 - y0) * 1.5, dw * 2.5) - (x1 - x0), 0) / 2 ELSE 0 END AS px,
        CASE WHEN (x1 - x0) / (y1 - y0) < 1.5 THEN 0 ELSE greatest(least((x1 - x0) / 1.5, dh * 2.5) - (y1 - y0), 0) / 2 END AS py FROM c),
e AS (SELECT id, dw, dh, flat_x, flat_y, x0 - px AS x0, x1 + px AS x1, y0 - py AS y0, y1 + py AS y1 FROM d),
f AS (SELECT *, (x1 - x0) / (y1 - y0) < 1.5 * (1 - 1e-9) AS cut FROM e),
g AS (SELECT id, dw, dh, flat_x, flat_y, cut, x0, x1, CASE WHEN cut THEN (y0 + y1) / 2 - (x1 - x0) / 3 ELSE y0 END AS y0,
        CASE WHEN cut THEN (y0 + y1) / 2 + (x1 - x0) / 3 ELSE y1 END AS y1 FROM f),
h AS (SELECT *, x1 - x0 > {CIRC} AS wide, y1 - y0 > {CIRC} AS tall, {CIRC} / 2 AS half FROM g),
i AS (SELECT *, NOT wide AND (x0 < -half OR x1 > half) AS off,
        CASE WHEN NOT wide AND x0 < -half THEN -half - x0 WHEN NOT wide AND x1 > half THEN half - x1 ELSE 0 END AS dx FROM h),
j AS (SELECT *, x0 + dx AS fx0, x1 + dx AS fx1, greatest(y0, -half) AS fy0, least(y1, half) AS fy1 FROM i)
SELECT id, round({sql(LON, 'fx0')}, 6) AS lon0, round({sql(LAT, 'fy0')}, 6) AS lat0, round({sql(LON, 'fx1')}, 6) AS lon1, round({sql(LAT, 'fy1')}, 6) AS lat1,
  round((fx1 - fx0) / (fy1 - fy0), 2) AS aspect, round(least(dw / (fx1 - fx0), dh / (fy1 - fy0)), 3) AS fill,
  concat_ws('; ', CASE WHEN flat_x THEN 'no width: widened to 1 km' END, CASE WHEN flat_y THEN 'no height: raised to 1 km' END,
    CASE WHEN cut THEN 'height cut for an aspect of 1.5' END, CASE WHEN wide THEN 'wider than the world' END,
    CASE WHEN tall THEN 'taller than the world' END, CASE WHEN off THEN 'moved sideways into the world' END) AS warnings
FROM j""",
)
def fit_frame(data):
    x0, y0, i = F.col("xmin"), F.col("ymin"), F.col("id")
    x1 = (
        F.when(i % 5 == 0, x0).when(i % 5 == 1, x0 + 0.001).when(i % 5 == 2, x0 + 40).when(i % 5 == 3, x0 + 2)
        .otherwise(F.least(x0 + 330, F.lit(200.0)))
    )
    y1 = (
        F.when(i % 7 == 0, y0).when(i % 7 == 1, y0 + 0.002).when(i % 7 == 2, F.least(y0 + 60, F.lit(90.0)))
        .when(i % 7 == 3, y0 + 0.4).otherwise(F.least(y0 + 1, F.lit(90.0)))
    )
    framed = boxes.fit_frame(data.geo_boxes.select("id", F.array(x0, y0, x1, y1).alias("bbox")), "bbox")
    return frame_columns(framed, "aspect", "fill", F.concat_ws("; ", "warnings").alias("warnings"))


@query(
    "fn_5_human_title",
    """SELECT collection, CASE WHEN title IS NULL OR lower(replace(title, '_', ' ')) = 'land ' || split_part(collection, '_', 2)
         THEN 'Land ' || split_part(collection, '_', 2) ELSE title END AS title FROM lands""",
)
def human_title(data):
    return data.lands.select(
        "collection", words.human_title(F.col("title"), paths.type_of(F.col("collection"))).alias("title")
    )


@query(
    "fn_7_pairs_to_map",
    """SELECT p_partkey AS id, '#' || CAST(p_size AS STRING) AS size, p_brand || ':' || p_type AS brand FROM part""",
)
def pairs_to_map(data):
    # The key that comes twice takes the later value.
    pairs = F.concat(F.lit("size:first brand:"), "p_brand", F.lit(":"), "p_type", F.lit(" size:#"), "p_size")
    made = data.part.select(F.col("p_partkey").alias("id"), words.pairs_to_map(pairs).alias("m"))
    return made.select("id", F.col("m")["size"].alias("size"), F.col("m")["brand"].alias("brand"))


@query(
    "fn_8_release_timestamp",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' AS updated FROM orders",
)
def release_timestamp(data):
    release = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".0"))
    return data.orders.select("o_orderkey", words.release_timestamp(release).alias("updated"))


@query(
    "fn_9_resolve_path",
    r"""WITH r AS (SELECT path, href, list_reduce(string_split(regexp_replace(path, '[^/]*$', '') || href, '/'),
          lambda a, b: CASE WHEN b IN ('', '.') THEN a WHEN b = '..' AND len(a) > 0 AND a[-1] <> '..' THEN a[1:len(a) - 1] ELSE list_append(a, b) END,
          CAST([] AS VARCHAR[])) AS p FROM (SELECT DISTINCT path, href FROM cat_links WHERE href NOT LIKE '%://%'
          UNION SELECT path, '../../../../' || href FROM cat_links WHERE href NOT LIKE '%://%'))
        SELECT path, href, array_to_string(p, '/') AS target FROM r""",
)
def resolve_path(data):
    local = data.cat_links.where(~paths.is_remote(F.col("href"))).select("path", "href")
    climbing = local.withColumn("href", F.concat(F.lit("../../../../"), "href"))
    every = local.unionByName(climbing).distinct()
    return every.withColumn("target", paths.resolve(F.col("path"), F.col("href")))


@query(
    "fn_10_names",
    """SELECT collection, split_part(collection, '/', 1) AS theme, split_part(collection, '/', 2) AS type, replace(collection, '/', '-') AS slug,
              split_part(collection, '/', 2) AS folder FROM lands""",
)
def names(data):
    key = F.col("collection")
    url = F.concat(F.lit("https://example.org/"), key, F.lit("/collection.json"))
    return data.lands.select(
        "collection", paths.theme_of(key).alias("theme"), paths.type_of(key).alias("type"), paths.slug(key).alias("slug"),
        paths.folder_name(url).alias("folder"),
    )


@query(
    "fn_12_number_formats",
    """SELECT o_orderkey, format('{:,}', o_orderkey * 977) AS grouped, format('{:+d}', o_orderkey - 700) AS delta,
              format('{:.1f}%', (o_orderkey % 997) * 100 / 997.0) AS share FROM orders""",
)
def number_formats(data):
    key = F.col("o_orderkey")
    # Over a prime no share is an exact half, which the two engines would round apart.
    return data.orders.select(
        "o_orderkey", words.thousands(key * 977).alias("grouped"), words.signed(key - 700).alias("delta"),
        words.percent((key % 997) / 997.0).alias("share"),
    )


@query(
    "fn_13_pointer_segment",
    """SELECT p_partkey, replace(replace(p_type || '~1' || p_brand || '~01~0', '~1', '/'), '~0', '~') AS segment FROM part""",
)
def pointer_segment(data):
    raw = F.concat("p_type", F.lit("~1"), "p_brand", F.lit("~01~0"))
    return data.part.select("p_partkey", words.pointer_segment(raw).alias("segment"))


@query("fn_14_markdown_cell", r"SELECT replace(message, '|', '\|') AS cell, count(*) AS n FROM findings GROUP BY ALL")
def markdown_cell(data):
    return data.findings.groupBy(words.markdown_cell(F.col("message")).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_15_field_access",
    """SELECT collection, part_no, pxmin AS west, pymax AS north, coalesce(CASE WHEN row_groups > 2 THEN row_groups END, 0) AS groups FROM geo_parts""",
)
def field_access(data):
    facts = F.when(F.col("row_groups") > 2, F.create_map(F.lit("groups"), F.col("row_groups")))
    return data.parts.select(
        "collection",
        F.col("part_id").cast("int").alias("part_no"),
        F.col("box.xmin").alias("west"),
        F.element_at("bbox", 4).alias("north"),
        F.coalesce(facts["groups"], F.lit(0)).alias("groups"),
    )


@query(
    "txt_3_tidy",
    r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS tidy FROM documents",
)
def tidy(data):
    return data.documents.select("doc_id", words.tidy(F.col("text")).alias("tidy"))


TICK = "chr(96) || chr(96) || chr(96)"


@query(
    "txt_1_fenced_blocks",
    f"""SELECT a.file_id, CAST(a.line_no AS BIGINT) AS line_no,
          CASE WHEN a.line_no = 3 THEN b.text || chr(10) || c.text ELSE b.text END AS block
        FROM md_lines a JOIN md_lines b ON b.file_id = a.file_id AND b.line_no = a.line_no + 1
        JOIN md_lines c ON c.file_id = a.file_id AND c.line_no = a.line_no + 2 WHERE a.text = {TICK} || 'sql'""",
)
def fenced_blocks(data):
    return blocks.fenced_blocks(data.md_lines).withColumn("line_no", F.col("line_no").cast("bigint"))


@query(
    "txt_1_fenced_lines",
    """SELECT file_id, CASE WHEN line_no <= 5 THEN 3 ELSE 8 END AS block, line_no, text
       FROM md_lines WHERE line_no IN (4, 5) OR (line_no = 9 AND file_id % 2 = 0)""",
)
def fenced_lines(data):
    return blocks.fenced_lines(data.md_lines)


def guide_texts(data: Data):
    """One guide per document: its text, then a fence with its language and size."""
    fence = "`" * 3
    return data.documents.select(
        F.col("doc_id").alias("file_id"),
        F.concat(
            F.regexp_replace("text", "`", "'"), F.lit(f"\n{fence}sql\nSELECT '"), "lang", F.lit("',\n  "), "n_chars",
            F.lit(f"\n{fence}\ntail\n{fence}sql\nSELECT never closed"),
        ).alias("text"),
    )


@query(
    "txt_1_fenced_blocks_of_documents",
    """SELECT doc_id AS file_id, CAST(length(text) - length(replace(text, chr(10), '')) + 2 AS BIGINT) AS line_no,
              'SELECT ''' || lang || ''',' || chr(10) || '  ' || CAST(n_chars AS STRING) AS block FROM documents""",
)
def document_blocks(data):
    return blocks.document_blocks(guide_texts(data))


@query(
    "qc_11_guides_without_blocks",
    "SELECT doc_id AS file_id FROM documents WHERE lang <> 'en'",
)
def guides_without_blocks(data):
    fence = "`" * 3
    text = F.when(F.col("lang") == "en", F.concat(F.lit(f"{fence}sql\n"), F.regexp_replace("text", "`", "'"), F.lit(f"\n{fence}")))
    guides = data.documents.select(F.col("doc_id").alias("file_id"), F.coalesce(text, F.regexp_replace("text", "`", "'")).alias("text"))
    return blocks.guides_without_blocks(guides.select("file_id"), blocks.document_blocks(guides))
