"""Manifest summaries, published records, the document graph and its meanings."""

from __future__ import annotations

from pyspark.sql import functions as F

from partlens.operators import cycles, graph, manifest, meanings
from partlens.plans.registry import query
from partlens.plans.relations import Data
from partlens.session import literal_rows

MIXED = ("AFRICA", "ASIA")


def lands(data: Data):
    return data.lands.withColumn("bbox", F.array("x0", "y0", "x1", "y1"))


def land_totals(data: Data):
    return data.land_parts.groupBy("collection").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("row_cnt").alias("rows")
    )


@query(
    "agg_7_collection_summary",
    """SELECT collection, count(*) AS parts, CAST(sum(row_cnt) AS BIGINT) AS row_cnt, min(row_groups) AS min_row_groups,
              max(row_groups) AS max_row_groups, CAST(max(ceil(row_cnt / row_groups)) AS BIGINT) AS max_row_group_rows,
              string_agg(DISTINCT geometry_type, ',') AS geometry_types
       FROM geo_parts GROUP BY collection""",
)
def collection_summary(data):
    made = manifest.collection_summary(data.parts).withColumnRenamed("rows", "row_cnt")
    return made.withColumn("geometry_types", F.concat_ws(",", "geometry_types"))


@query(
    "agg_13_theme_rollup",
    """WITH t AS (SELECT collection, count(*) AS parts, sum(row_cnt) AS row_cnt FROM land_parts GROUP BY collection)
       SELECT split_part(collection, '/', 1) AS theme, count(*) AS collections, CAST(sum(parts) AS BIGINT) AS parts,
              CAST(sum(row_cnt) AS BIGINT) AS row_cnt FROM t GROUP BY ROLLUP (split_part(collection, '/', 1))""",
)
def theme_rollup(data):
    return manifest.theme_rollup(land_totals(data)).withColumnRenamed("rows", "row_cnt")


@query(
    "agg_14_licence_groups",
    "SELECT license, collection, count(*) OVER (PARTITION BY license) AS collections FROM lands",
)
def licence_groups(data):
    return manifest.licence_groups(data.lands)


@query(
    "agg_16_geometry_kinds",
    """SELECT o_custkey AS collection, bool_or(o_orderpriority LIKE '1%') OR NOT bool_or(left(o_orderpriority, 1) IN ('1', '2', '3')) AS polygon,
              bool_or(o_orderpriority LIKE '2%') AS line, bool_or(o_orderpriority LIKE '3%') AS point FROM orders GROUP BY o_custkey""",
)
def geometry_kinds(data):
    first = F.substring("o_orderpriority", 1, 1)
    types = (
        F.when(first == "1", F.array(F.lit("MultiPolygon")))
        .when(first == "2", F.array(F.lit("LineString")))
        .when(first == "3", F.array(F.lit("Point")))
        .otherwise(F.array().cast("array<string>"))
    )
    return manifest.geometry_kinds(data.orders.select(F.col("o_custkey").alias("collection"), types.alias("geometry_types")))


PARTS = """
WITH l AS (SELECT path, count(*) AS n FROM cat_links WHERE rel = 'item' GROUP BY path),
nodes AS (SELECT path, type FROM cat_nodes UNION ALL SELECT 'NEW/bare/collection.json', 'Collection' UNION ALL SELECT 'NEW/whole/collection.json', 'Collection'),
c AS (SELECT n.path, replace(n.path, '/collection.json', '') AS collection, coalesce(l.n, 0) AS n,
      n.path = 'NEW/whole/collection.json' OR EXISTS (SELECT 1 FROM cat_assets a WHERE a.path = n.path AND a.key = 'data') AS own
      FROM nodes n LEFT JOIN l ON l.path = n.path WHERE n.type = 'Collection'),
p AS (SELECT collection, CASE WHEN n = 0 AND own THEN 1 ELSE n END AS parts FROM c)"""


def counted_parts(data):
    # Besides the given ones a collection that holds its data itself, and one that holds nothing.
    paths = [(f"NEW/{name}/collection.json",) for name in ("bare", "whole")]
    fresh = literal_rows(data.spark, paths, "path string")
    nodes = data.cat_nodes.select("path", "type").unionByName(fresh.withColumn("type", F.lit("Collection")))
    own = fresh.where(F.col("path").contains("whole")).withColumn("key", F.lit("data"))
    return manifest.parts_per_collection(nodes, data.cat_links, data.cat_assets.select("path", "key").unionByName(own))


@query(
    "agg_10_parts_per_collection",
    PARTS + """ SELECT collection, replace(collection, '/', '-') AS slug, parts,
      CASE WHEN parts = 0 THEN 'no item link and no data asset' END AS error FROM p""",
)
def parts_per_collection(data):
    return counted_parts(data)


@query("sort_4_longest_first", PARTS + " SELECT collection, parts FROM p ORDER BY parts DESC, collection")
def longest_first(data):
    return manifest.longest_first(counted_parts(data).select("collection", "parts"))


@query(
    "sort_5_items_by_id",
    "SELECT collection, lpad(CAST(part_no AS STRING), 5, '0') AS part_id, row_cnt FROM geo_parts ORDER BY 1, 2",
)
def items_by_id(data):
    return data.parts.select("collection", "part_id", F.col("rows").alias("row_cnt")).orderBy("collection", "part_id")


@query(
    "prj_2_collection_record",
    """SELECT collection, split_part(collection, '/', 1) AS theme, split_part(collection, '/', 2) AS type,
              CASE WHEN title IS NULL OR lower(replace(title, '_', ' ')) = replace(split_part(collection, '/', 2), '_', ' ')
                   THEN 'Land ' || split_part(collection, '_', 2) ELSE title END AS title,
              coalesce(description, '') AS description,
              CASE WHEN split_part(collection, '/', 1) IN ('AFRICA', 'ASIA') THEN 'other' ELSE license END AS license,
              greatest(least(x0, 180.0), -180.0) AS x0, greatest(least(y0, 90.0), -90.0) AS y0, greatest(least(x1, 180.0), -180.0) AS x1, greatest(least(y1, 90.0), -90.0) AS y1,
              '2026-11-18T00:00:00Z' AS updated, split_part(collection, '/', 1) IN ('AFRICA', 'ASIA') AS licence_link FROM lands""",
)
def collection_record(data):
    made = manifest.collection_records(lands(data), "2026-11-18.0", MIXED)
    corner = [F.element_at("bbox", i + 1).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return made.select(*(c for c in made.columns if c != "bbox"), *corner)


@query(
    "prj_2_collection_document",
    """WITH p AS (SELECT collection, count(*) AS n, min(part_no) AS part_no FROM land_parts GROUP BY collection)
       SELECT l.collection || '/collection.json' AS path, split_part(l.collection, '/', 2) AS id, license,
              greatest(least(x1, 180.0), -180.0) AS east, '2026-11-18T00:00:00Z' AS since, 'id' AS first, 'Identifier in ' || license AS said, 'bbox' AS second,
              CASE WHEN n = 1 THEN 's3://mirror/' || l.collection || '/' || lpad(CAST(part_no AS STRING), 5, '0') END AS s3, '../catalog.json' AS parent
       FROM lands l LEFT JOIN p ON p.collection = l.collection""",
)
def collection_document(data):
    records = manifest.collection_records(lands(data), "2026-11-18.0")
    columns = data.lands.select(
        "collection",
        F.inline(F.array(
            F.struct(F.lit(1).alias("position"), F.lit("bbox").alias("column"), F.lit(None).cast("string").alias("description")),
            F.struct(F.lit(0).alias("position"), F.lit("id").alias("column"), F.concat(F.lit("Identifier in "), "license").alias("description")),
        )),
    )
    parts = data.lands_parts.select(
        "collection", "part_id", F.concat(F.lit("https://mirror.example.org/"), "collection").alias("href"),
        F.concat_ws("/", F.lit("s3://mirror"), "collection", "part_id").alias("s3"),
    )
    made = manifest.collection_documents(records, columns, parts).select("path", F.to_json("doc").alias("json"))
    field = lambda path: F.get_json_object("json", path)
    return made.select(
        "path",
        field("$.id").alias("id"),
        field("$.license").alias("license"),
        field("$.extent.spatial.bbox[0][2]").cast("double").alias("east"),
        field("$.extent.temporal.interval[0][0]").alias("since"),
        F.get_json_object(F.regexp_replace("json", "table:columns", "columns"), "$.columns[0].name").alias("first"),
        F.get_json_object(F.regexp_replace("json", "table:columns", "columns"), "$.columns[0].description").alias("said"),
        F.get_json_object(F.regexp_replace("json", "table:columns", "columns"), "$.columns[1].name").alias("second"),
        field("$.assets.data.alternate.s3.href").alias("s3"),
        field("$.links[1].href").alias("parent"),
    )


@query(
    "join_11_reference_targets",
    """SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'schemas/' || p_brand || '/main.yaml#/defs/a~1b' WHEN 1 THEN 'schemas/common/y.yaml#/defs/z'
              WHEN 2 THEN NULL ELSE 'schemas/' || p_brand || '/other.yaml#' END AS target FROM part""",
)
def reference_targets(data):
    kind = F.col("p_partkey") % 4
    ref = F.when(kind == 0, "#/defs/a~1b").when(kind == 1, "../common/y.yaml#/defs//z").when(kind == 2, "https://geo.example.org/x.json").otherwise("other.yaml")
    file = F.concat(F.lit("schemas/"), "p_brand", F.lit("/main.yaml"))
    return data.part.select(F.col("p_partkey").alias("id"), meanings.reference_target(file, ref).alias("target"))


@query(
    "prj_3_item_record",
    """SELECT collection, lpad(CAST(part_no AS STRING), 5, '0') AS part_id,
              collection || '/items/' || lpad(CAST(part_no AS STRING), 5, '0') || '.json' AS path,
              greatest(pxmin, -180.0) AS west, pxmax AS corner, 'Polygon' AS shape, 'https://schemas.example.org/alternate/v1.0.0' AS extension,
              row_cnt, substring(collection, 5) AS of,
              's3://mirror/release/' || collection || '/part-' || lpad(CAST(part_no AS STRING), 5, '0') || '.parquet' AS s3
       FROM geo_parts""",
)
def item_record(data):
    parts = manifest.with_object_address(data.parts, "mirror").withColumn("datetime", F.lit("2026-11-18T00:00:00Z"))
    west, south, east, north = (F.element_at("bbox", i) for i in range(1, 5))
    ring = F.array(*(F.array(x, y) for x, y in ((west, south), (east, south), (east, north), (west, north), (west, south))))
    parts = parts.withColumn("geometry", F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    doc = F.to_json("doc")
    field = lambda path: F.get_json_object("json", path)
    made = manifest.item_records(parts, ["https://schemas.example.org/alternate/v1.0.0"]).select("collection", "part_id", "path", doc.alias("json"))
    return made.select(
        "collection",
        "part_id",
        "path",
        field("$.bbox[0]").cast("double").alias("west"),
        field("$.geometry.coordinates[0][2][0]").cast("double").alias("corner"),
        field("$.geometry.type").alias("shape"),
        field("$.stac_extensions[0]").alias("extension"),
        field("$.properties['table:row_count']").cast("bigint").alias("row_cnt"),
        field("$.collection").alias("of"),
        field("$.assets.data.alternate.s3.href").alias("s3"),
    )


@query(
    "prj_4_single_part_rule",
    """WITH c AS (SELECT *, count(*) OVER (PARTITION BY collection) AS parts, lpad(CAST(part_no AS STRING), 5, '0') AS part_id FROM land_parts)
       SELECT collection, part_id, CASE WHEN parts = 1 THEN collection || '/collection.json' ELSE collection || '/items/' || part_id || '.json' END AS path,
              CASE WHEN parts = 1 THEN 'data asset' ELSE 'item' END AS placed_as,
              CASE WHEN parts > 1 THEN 'Part ' || part_id || ', ' || format('{:,}', row_cnt) || ' rows' END AS link_title FROM c""",
)
def single_part_rule(data):
    return manifest.single_part_rule(data.lands_parts)


@query(
    "prj_5_theme_records",
    """SELECT split_part(collection, '/', 1) AS theme, array_to_string(list_transform(string_split(split_part(collection, '/', 1), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
              'Holds ' || CAST(count(*) AS STRING) || ' collection' || CASE WHEN count(*) <> 1 THEN 's' ELSE '' END || '.' AS description,
              '2026-11-18T00:00:00Z' AS updated
       FROM (SELECT DISTINCT collection FROM land_parts UNION SELECT 'ALONE/one')
       GROUP BY split_part(collection, '/', 1)""",
)
def theme_records(data):
    alone = literal_rows(data.spark, [("ALONE/one",)], "collection string")
    return manifest.theme_records(data.land_parts.select("collection").unionByName(alone), "2026-11-18.0")


@query(
    "prj_5_child_links",
    """SELECT split_part(collection, '/', 1) || '/catalog.json' AS path, './' || split_part(collection, '/', 2) || '/collection.json' AS href,
              'Land ' || split_part(collection, '_', 2) AS title FROM lands
       UNION SELECT 'catalog.json', './' || r_name || '/catalog.json', array_to_string(list_transform(string_split(r_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') FROM region""",
)
def child_links(data):
    return manifest.child_links(data.lands)


@query(
    "prj_1_table_columns",
    """WITH t AS (SELECT p_brand AS collection, p_type AS column_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_type DESC) - 1 AS position
                 FROM (SELECT DISTINCT p_brand, p_type FROM part))
       SELECT t.collection, t.position, t.column_name AS "column", CASE WHEN description <> '' THEN description END AS description
       FROM t LEFT JOIN meanings m ON m.collection = t.collection AND m.column_name = t.column_name""",
)
def table_columns(data):
    collections = data.part.groupBy(F.col("p_brand").alias("collection")).agg(
        F.sort_array(F.collect_set("p_type"), asc=False).alias("columns")
    )
    made = meanings.table_columns(collections, meaning_rows(data))
    return made.withColumn("position", F.col("position").cast("bigint"))


def meaning_rows(data: Data):
    return data.meanings.withColumnRenamed("column_name", "column")


@query(
    "join_1_column_meanings",
    """SELECT f.collection, f.column_name AS "column", CASE WHEN description <> '' THEN description END AS description
       FROM fp_columns f LEFT JOIN meanings m ON m.collection = f.collection AND m.column_name = f.column_name WHERE f.release = 'new'""",
)
def column_meanings(data):
    listed = data.fp_columns.where(F.col("release") == "new").groupBy("collection").agg(
        F.sort_array(F.collect_set("column_name")).alias("columns")
    )
    return meanings.table_columns(listed, meaning_rows(data)).drop("position")


@query(
    "join_7_broken_links",
    r"""WITH r AS (SELECT path, rel, href, CASE
          WHEN href LIKE '../../../%' THEN substring(href, 10) WHEN href LIKE '../%' THEN substring(href, 4)
          ELSE regexp_replace(path, '[^/]*$', '') || substring(href, 3) END AS target FROM cat_links WHERE href NOT LIKE '%://%')
       SELECT path, rel, href, target FROM r WHERE target NOT IN (SELECT path FROM cat_nodes)""",
)
def broken_links(data):
    return graph.broken_links(graph.checked_links(data.cat_links), data.cat_nodes)


@query(
    "join_7_broken_assets",
    r"""SELECT path, key, href FROM cat_assets WHERE href NOT LIKE '%://%' AND NOT lower(href) LIKE '%.parquet'
        AND regexp_replace(path, '[^/]*$', '') || substring(href, 3) NOT IN (SELECT path FROM cat_nodes)""",
)
def broken_assets(data):
    checked = graph.checked_links(data.cat_assets, is_asset=True, light=True)
    return graph.broken_links(checked, data.cat_nodes).drop("target")


@query(
    "qc_5_link_report",
    r"""SELECT 'documents' AS what, count(*) AS n FROM cat_nodes
        UNION ALL SELECT 'checked', count(*) FROM cat_assets WHERE href NOT LIKE '%://%' AND NOT lower(href) LIKE '%.parquet'
        UNION ALL SELECT 'skipped', count(*) FROM cat_assets WHERE href NOT LIKE '%://%' AND lower(href) LIKE '%.parquet'
        UNION ALL SELECT 'broken', count(*) FROM cat_assets WHERE href NOT LIKE '%://%' AND NOT lower(href) LIKE '%.parquet'
          AND regexp_replace(path, '[^/]*$', '') || substring(href, 3) NOT IN (SELECT path FROM cat_nodes)""",
)
def link_report(data):
    checked = graph.checked_links(data.cat_assets, is_asset=True, light=True)
    return graph.link_report(checked, graph.broken_links(checked, data.cat_nodes), data.cat_nodes)


@query(
    "join_8_stale_outputs",
    """SELECT r_name || '/' || n_name || '/items/' || CAST(c_custkey AS STRING) || '.json' AS path
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_custkey % 13 = 0""",
)
def stale_outputs(data):
    # The last release wrote every linked item; this one wrote the nodes.
    linked = graph.checked_links(graph.links_of(data.cat_links, "item"))
    return graph.stale(linked.select(F.col("target").alias("path")), data.cat_nodes)


@query(
    "snk_4_stale_styles",
    """WITH s AS (SELECT DISTINCT l_returnflag || '/' || CASE l_linenumber WHEN 1 THEN 'default.json' WHEN 2 THEN 'flat.json' WHEN 3 THEN 'by_' || l_linestatus || '.json' ELSE 'own' || CAST(l_linenumber AS STRING) || '.json' END AS path, l_linenumber FROM lineitem)
       SELECT path FROM s WHERE l_linenumber <= 3 AND path NOT LIKE '%/default.json'""",
)
def stale_styles(data):
    name = (
        F.when(F.col("l_linenumber") == 1, "default.json")
        .when(F.col("l_linenumber") == 2, "flat.json")
        .when(F.col("l_linenumber") == 3, F.concat(F.lit("by_"), "l_linestatus", F.lit(".json")))
        .otherwise(F.concat(F.lit("own"), "l_linenumber", F.lit(".json")))
    )
    existing = data.lineitem.select(F.concat_ws("/", "l_returnflag", name).alias("path")).distinct()
    written = existing.where(F.col("path").endswith("/default.json"))
    return graph.stale(graph.generated_styles(existing), written)


@query(
    "join_12_tree_walk",
    r"""WITH e AS (SELECT path, CASE WHEN path = 'catalog.json' THEN substring(href, 3)
                     ELSE regexp_replace(path, '[^/]*$', '') || substring(href, 3) END AS target FROM cat_links WHERE rel IN ('child', 'item')),
        w AS (SELECT 'catalog.json' AS path, 0 AS depth UNION ALL SELECT target, depth + 1 FROM w JOIN e ON e.path = w.path)
        SELECT path, depth FROM w""",
)
def tree_walk(data):
    return graph.walk(data.cat_links, "catalog.json")


@query(
    "join_11_reference_chase",
    """WITH RECURSIVE c AS (SELECT node, ref, 0 AS depth, description, title FROM ref_nodes
         UNION ALL SELECT c.node, r.ref, depth + 1, r.description, r.title FROM c JOIN ref_nodes r ON r.node = c.ref)
       SELECT node, arg_min(description, depth) FILTER (WHERE description IS NOT NULL) AS description,
              arg_min(title, depth) FILTER (WHERE title IS NOT NULL) AS title FROM c GROUP BY node""",
)
def reference_chase(data):
    return meanings.resolve_references(data.ref_nodes, ["description", "title"])


@query(
    "join_11_container_properties",
    """WITH RECURSIVE d AS (SELECT node, member AS at, [ordinal] AS key, 1 AS depth FROM ref_members
         UNION ALL SELECT d.node, m.member, list_append(d.key, m.ordinal), depth + 1 FROM d JOIN ref_members m ON m.node = d.at),
       f AS (SELECT node, [2147483647] AS key, name, value FROM ref_properties
             UNION ALL SELECT d.node, list_append(d.key, 2147483647), name, value FROM d JOIN ref_properties p ON p.node = d.at)
       SELECT node, name, arg_max(value, key) AS value FROM f GROUP BY node, name""",
)
def container_properties(data):
    return meanings.flatten_properties(data.ref_members, data.ref_properties)


# Some members lead back to their container.
_ROUND = """
    WITH RECURSIVE e AS (SELECT node, ordinal, member FROM ref_members
         UNION ALL SELECT p_partkey * 2 + 1, 5, p_partkey FROM part WHERE p_partkey % 7 = 1 UNION ALL SELECT p_partkey, 0, p_partkey FROM part WHERE p_partkey % 50 = 1),
       far AS (SELECT node, member FROM e UNION SELECT f.node, e.member FROM far f JOIN e ON e.node = f.member),
       g AS (SELECT a.node, min(a.member) AS grp FROM far a JOIN far b ON a.node = b.member AND a.member = b.node GROUP BY a.node)"""


def _round(data):
    number = F.col("p_partkey")
    back = data.part.where(number % 7 == 1).select((number * 2 + 1).alias("node"), F.lit(5).alias("ordinal"), number.alias("member"))
    itself = data.part.where(number % 50 == 1).select(number.alias("node"), F.lit(0).alias("ordinal"), number.alias("member"))
    return data.ref_members.select("node", "ordinal", "member").unionByName(back).unionByName(itself)


@query("join_11_cycle_groups", _ROUND + ' SELECT node, grp AS "group" FROM g')
def cycle_groups(data):
    return cycles.cycle_groups(_round(data), "node", "member")


@query(
    "join_11_containers_in_cycles",
    _ROUND
    + """,
       onward AS (SELECT e.* FROM e LEFT JOIN g x ON x.node = e.node LEFT JOIN g y ON y.node = e.member WHERE x.grp IS NULL OR x.grp IS DISTINCT FROM y.grp),
       c AS (SELECT 'n' || node AS node, ordinal, 'n' || member AS member FROM onward
             UNION ALL SELECT 'a' || node, ordinal, 'n' || member FROM onward JOIN g USING (node)
             UNION ALL SELECT 'n' || node, -1, 'c' || grp FROM g
             UNION ALL SELECT 'c' || grp, row_number() OVER (PARTITION BY grp ORDER BY node), 'a' || node FROM g),
       d AS (SELECT node, member AS at, [ordinal::BIGINT] AS key FROM c UNION ALL SELECT d.node, c.member, list_append(d.key, c.ordinal) FROM d JOIN c ON c.node = d.at),
       o AS (SELECT 'n' || node AS node, name, value FROM ref_properties UNION ALL SELECT 'a' || node, name, value FROM ref_properties JOIN g USING (node)),
       f AS (SELECT node, [2147483647::BIGINT] AS key, name, value FROM o
             UNION ALL SELECT d.node, list_append(d.key, 2147483647), name, value FROM d JOIN o ON o.node = d.at)
       SELECT substr(node, 2)::BIGINT AS node, name, arg_max(value, key) AS value FROM f WHERE node LIKE 'n%' GROUP BY ALL""",
)
def containers_in_cycles(data):
    return meanings.flatten_properties(_round(data), data.ref_properties)


SAID = r"""
WITH RECURSIVE l AS (SELECT *, regexp_matches(text, '^\s*- ([A-Za-z0-9_]+)\s*(#\s?(.*))?$') AS item, regexp_matches(text, '^\s*#') AS note FROM enum_lines),
m AS (SELECT *, item OR (NOT note AND trim(text) <> '') AS mark FROM l),
r AS (SELECT *, max(CASE WHEN mark THEN line_no END) OVER (PARTITION BY file_id ORDER BY line_no) AS run FROM m),
o AS (SELECT r.file_id, r.line_no, r.run, regexp_extract(h.text, '- ([A-Za-z0-9_]+)', 1) AS value,
      CASE WHEN r.item THEN nullif(regexp_extract(r.text, '#\s?(.*)$', 1), '') WHEN r.note THEN regexp_extract(r.text, '#\s?(.*)$', 1) END AS said
      FROM r JOIN r h ON h.file_id = r.file_id AND h.line_no = r.run WHERE h.item),
t AS (SELECT file_id, value, run, trim(string_agg(said, ' ' ORDER BY line_no)) AS comment FROM o WHERE said IS NOT NULL GROUP BY ALL),
comments AS (SELECT file_id, value, arg_max(comment, run) AS comment FROM t GROUP BY ALL HAVING arg_max(comment, run) <> '')"""


@query("txt_2_comment_recovery", SAID + " SELECT * FROM comments")
def comment_recovery(data):
    return meanings.value_comments(data.enum_lines)


@query(
    "txt_2_comment_lines",
    SAID + """, n AS (SELECT file_id, value, max(run) AS run FROM o WHERE said IS NOT NULL GROUP BY ALL)
    SELECT file_id, value, line_no, said FROM o JOIN n USING (file_id, value, run) WHERE said IS NOT NULL""",
)
def comment_lines(data):
    return meanings.comment_lines(data.enum_lines)


# Every turn of a conversation as an item whose comment is what the turn says, line for line.
SAID_IN_TURNS = SAID.replace(
    "FROM enum_lines",
    """FROM (SELECT conv_id AS file_id, turn * 1000000 + k AS line_no, CASE WHEN k = 1 THEN '- t' || turn || ' # ' ELSE '# ' END || lines[k] AS text
       FROM (SELECT conv_id, turn, lines, unnest(range(1, len(lines) + 1)) AS k FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS lines FROM conversations)))""",
)


@query("txt_2_comments_of_conversations", SAID_IN_TURNS + " SELECT * FROM comments")
def comments_of_conversations(data):
    lines = data.conversations.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    head = F.when(F.col("k") == 0, F.concat(F.lit("- t"), F.col("turn").cast("string"), F.lit(" # "))).otherwise("# ")
    text = lines.select(
        F.col("conv_id").alias("file_id"), (F.col("turn") * 1_000_000 + F.col("k") + 1).alias("line_no"), F.concat(head, "line").alias("text")
    )
    return meanings.value_comments(text)


@query(
    "join_10_enum_comments",
    SAID + """, e AS (SELECT c.conv_id AS collection, 'v' || CAST(v.k AS STRING) AS value, c.conv_id % 10 AS theme
         FROM (SELECT DISTINCT conv_id FROM conversations) c JOIN (VALUES (0), (1), (2), (3)) AS v(k) ON true),
     th AS (SELECT file_id % 10 AS theme, value, min(comment) AS comment FROM comments GROUP BY ALL HAVING count(*) % 2 = 1)
     SELECT e.collection, e.theme, e.value, coalesce(th.comment, f.comment) AS description FROM e
     LEFT JOIN comments f ON f.file_id = e.collection AND f.value = e.value LEFT JOIN th ON th.theme = e.theme AND th.value = e.value""",
)
def enum_comments(data):
    comments = meanings.value_comments(data.enum_lines)
    enums = (
        data.conversations.select(F.col("conv_id").alias("collection")).distinct()
        .withColumn("theme", F.col("collection") % 10)
        .withColumn("value", F.explode(F.array(*(F.lit(f"v{k}") for k in range(4)))))
    )
    by_file = comments.withColumnRenamed("file_id", "collection")
    by_theme = (
        comments.groupBy((F.col("file_id") % 10).alias("theme"), "value")
        .agg(F.min("comment").alias("comment"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") % 2 == 1)
    )
    return meanings.enum_descriptions(enums, by_file, by_theme)


DESCRIBED = r"""
WITH c AS (SELECT DISTINCT p_brand AS collection, p_type AS "column" FROM part),
pc AS (SELECT p_brand AS collection, p_type AS "column", 'For ' || p_brand AS description FROM part WHERE p_size % 4 = 0 AND p_type IN ('SMALL', 'LARGE', 'PROMO') GROUP BY ALL),
sh AS (SELECT DISTINCT p_type AS "column", 'Any ' || p_type AS description FROM part WHERE p_type IN ('SMALL', 'ECONOMY')),
d AS (SELECT c.collection, c."column", coalesce(nullif(m.description, ''), pc.description, sh.description) AS raw, nullif(m.description, '') IS NOT NULL AS own
  FROM c LEFT JOIN meanings m ON m.collection = c.collection AND m.column_name = c."column"
  LEFT JOIN pc ON pc.collection = c.collection AND pc."column" = c."column" LEFT JOIN sh ON sh."column" = c."column"),
described AS (SELECT collection, "column", trim(regexp_replace(raw, '\s+', ' ', 'g')) AS description,
  CASE WHEN own THEN 'schema' WHEN raw IS NOT NULL THEN 'authored' END AS source FROM d)"""


def described(data: Data):
    columns = data.part.select(F.col("p_brand").alias("collection"), F.col("p_type").alias("column")).distinct()
    mine = data.part.where((F.col("p_size") % 4 == 0) & F.col("p_type").isin("SMALL", "LARGE", "PROMO")).select(
        F.col("p_brand").alias("collection"), F.col("p_type").alias("column"),
        F.concat(F.lit("For "), "p_brand").alias("description"),
    ).distinct()
    shared = data.part.where(F.col("p_type").isin("SMALL", "ECONOMY")).select(
        F.col("p_type").alias("column"), F.concat(F.lit("Any "), "p_type").alias("description")
    ).distinct()
    return meanings.described_columns(columns, meaning_rows(data), mine, shared)


@query("join_14_description_precedence", DESCRIBED + " SELECT * FROM described")
def description_precedence(data):
    return described(data)


def with_codes(data: Data):
    enum = F.when(F.length("column") == 5, F.array(F.struct(F.lit("a").alias("value")))).otherwise(
        F.array().cast("array<struct<value:string>>")
    )
    return described(data).withColumn("enum", enum)


@query(
    "agg_8_documentation_coverage",
    DESCRIBED + """ SELECT collection, count(*) FILTER (WHERE description <> '') AS described, count(*) AS total,
      count(*) FILTER (WHERE length("column") = 5) AS coded FROM described GROUP BY ROLLUP (collection)""",
)
def documentation_coverage(data):
    return meanings.coverage(with_codes(data))


@query("agg_8_undocumented", DESCRIBED + """ SELECT collection, "column" FROM described WHERE description IS NULL""")
def undocumented(data):
    return meanings.undocumented(described(data))


@query(
    "join_15_known_issues",
    """SELECT collection, CAST(0 AS INT) AS position, 'Licence ' || license AS note FROM lands WHERE license <> 'CC0-1.0'
       UNION ALL SELECT collection, 2147483647, 'The legend comes from a sample.' FROM (SELECT collection, sum(row_cnt) AS n FROM land_parts GROUP BY collection) WHERE n > 600""",
)
def known_issues(data):
    issues = data.lands.where(F.col("license") != "CC0-1.0").select(
        "collection", F.lit(0).alias("position"), F.concat(F.lit("Licence "), "license").alias("note")
    )
    sampled = land_totals(data).where(F.col("rows") > 600)
    return meanings.known_issues(data.lands, issues, sampled, "The legend comes from a sample.")
