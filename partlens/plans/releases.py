"""Release-diff queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partlens.operators import digests, manifest, release
from partlens.plans.registry import query
from partlens.plans.relations import Data
from partlens.session import literal_rows, workspace


def tables(data: Data, which: str) -> DataFrame:
    rows = data.fp_tables.where(F.col("release") == which)
    return rows.withColumn("geoparquet", F.array("geoparquet"))


def columns(data: Data, which: str) -> DataFrame:
    return data.fp_columns.where(F.col("release") == which).select(
        "collection", F.col("column_name").alias("column")
    )


def diff(data: Data) -> DataFrame:
    return release.compare(tables(data, "old"), tables(data, "new"), columns(data, "old"), columns(data, "new"))


SIDES = """
WITH o AS (SELECT * FROM fp_tables WHERE release = 'old'), n AS (SELECT * FROM fp_tables WHERE release = 'new'),
oc AS (SELECT collection, column_name FROM fp_columns WHERE release = 'old'),
nc AS (SELECT collection, column_name FROM fp_columns WHERE release = 'new')"""

COMPARE = SIDES + """
SELECT collection, 'collection disappeared' AS rule, NULL AS subject, NULL AS was, NULL AS now, true AS blocking
FROM o WHERE collection NOT IN (SELECT collection FROM n)
UNION ALL SELECT collection, 'collection appeared', NULL, NULL, NULL, true FROM n WHERE collection NOT IN (SELECT collection FROM o)
UNION ALL SELECT collection, 'column disappeared', column_name, NULL, NULL, true FROM (SELECT * FROM oc EXCEPT SELECT * FROM nc)
  WHERE collection IN (SELECT collection FROM o) AND collection IN (SELECT collection FROM n)
UNION ALL SELECT collection, 'column appeared', column_name, NULL, NULL, true FROM (SELECT * FROM nc EXCEPT SELECT * FROM oc)
  WHERE collection IN (SELECT collection FROM o) AND collection IN (SELECT collection FROM n)
UNION ALL SELECT o.collection, 'licence changed', NULL, o.license, n.license, true FROM o JOIN n ON o.collection = n.collection
  WHERE o.license IS DISTINCT FROM n.license
UNION ALL SELECT o.collection, 'format version changed', NULL, o.geoparquet, n.geoparquet, true FROM o JOIN n ON o.collection = n.collection
  WHERE o.geoparquet <> n.geoparquet
UNION ALL SELECT collection, 'row group above cap', NULL, CAST(CASE WHEN row_group_cap = 0 THEN 150000 ELSE row_group_cap END AS STRING),
  CAST(max_row_group_rows AS STRING), true FROM n WHERE max_row_group_rows > CASE WHEN row_group_cap = 0 THEN 150000 ELSE row_group_cap END
UNION ALL SELECT o.collection, 'part count moved', NULL, CAST(o.items AS STRING), CAST(n.items AS STRING), false
  FROM o JOIN n ON o.collection = n.collection WHERE o.items <> n.items"""


@query("qc_1_release_diff", COMPARE)
def release_diff(data):
    return diff(data)


@query(
    "join_2_column_diff",
    SIDES + """
SELECT coalesce(oc.collection, nc.collection) AS collection, coalesce(oc.column_name, nc.column_name) AS "column",
       CASE WHEN oc.collection IS NULL THEN 'appeared' ELSE 'disappeared' END AS change
FROM oc FULL JOIN nc ON oc.collection = nc.collection AND oc.column_name = nc.column_name
WHERE (oc.collection IS NULL OR nc.collection IS NULL)
  AND coalesce(oc.collection, nc.collection) IN (SELECT collection FROM oc INTERSECT SELECT collection FROM nc)""",
)
def column_diff(data):
    return release.column_changes(columns(data, "old"), columns(data, "new"))


@query(
    "qc_2_row_group_cap",
    """SELECT collection, CAST(max_row_group_rows AS BIGINT) AS max_row_group_rows,
              CASE WHEN row_group_cap = 0 THEN CAST(150000 AS BIGINT) ELSE row_group_cap END AS cap
       FROM fp_tables WHERE release = 'new' AND max_row_group_rows > CASE WHEN row_group_cap = 0 THEN 150000 ELSE row_group_cap END""",
)
def row_group_cap(data):
    return release.over_cap(tables(data, "new")).select(
        "collection", F.col("max_row_group_rows").cast("bigint").alias("max_row_group_rows"), "cap"
    )


@query(
    "set_2_difference",
    SIDES + """
SELECT collection, 'disappeared' AS change FROM (SELECT collection FROM o EXCEPT SELECT collection FROM n)
UNION ALL SELECT collection, 'appeared' FROM (SELECT collection FROM n EXCEPT SELECT collection FROM o)""",
)
def difference(data):
    return release.appeared_or_gone(tables(data, "old"), tables(data, "new"), ["collection"])


@query("set_3_intersection", SIDES + " SELECT collection FROM o INTERSECT SELECT collection FROM n")
def intersection(data):
    return release.in_both(tables(data, "old"), tables(data, "new"), ["collection"])


@query(
    "set_4_list_equality",
    """WITH g AS (SELECT l_orderkey, list_sort(list(l_returnflag)) AS flags, list_sort(list(l_linestatus)) AS states
                 FROM lineitem GROUP BY l_orderkey)
       SELECT l_orderkey, flags = list_sort(list_transform(states, lambda s: CASE WHEN s = 'O' THEN 'N' ELSE s END)) AS same FROM g""",
)
def list_equality(data):
    # An order has at most seven lines, so these lists are short.
    other = F.when(F.col("l_linestatus") == "O", "N").otherwise(F.col("l_linestatus"))
    lists = data.lineitem.groupBy("l_orderkey").agg(
        F.collect_list("l_returnflag").alias("flags"), F.collect_list(other).alias("states")
    )
    return lists.select("l_orderkey", release.same_list(F.col("flags"), F.col("states")).alias("same"))


@query(
    "agg_9_fingerprint",
    """SELECT '2026-01' AS release, l.collection, license, count(p.collection) AS items,
              coalesce(string_agg(DISTINCT version, ','), '') AS geoparquet, CAST(max(max_group) AS BIGINT) AS max_row_group_rows,
              CAST(150000 AS BIGINT) AS row_group_cap
       FROM (SELECT collection, license FROM lands UNION ALL SELECT 'LOST/all_parts', 'CC0-1.0') l
       LEFT JOIN land_parts p ON p.collection = l.collection GROUP BY l.collection, license""",
)
def fingerprint(data):
    lost = literal_rows(data.spark, [("LOST/all_parts", "CC0-1.0")], "collection string, license string")
    known = data.lands.select("collection", "license").unionByName(lost)
    collections = known.withColumn("columns", F.array(F.lit("id"), F.lit("bbox")))
    made = manifest.fingerprint(collections, data.lands_parts, "2026-01").drop("columns")
    return made.withColumn("geoparquet", F.concat_ws(",", "geoparquet"))


# The release after this one: an order in fifty goes, one in seventy comes back under another
# key as well, one supplier's quantities are corrected and returned first lines are given up.
NEXT_LINES = """
was AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS DOUBLE) AS quantity, l_returnflag FROM lineitem),
now AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_suppkey = 3 THEN quantity + 1 ELSE quantity END AS quantity, l_returnflag
        FROM was WHERE l_orderkey % 50 <> 0 AND NOT (l_returnflag = 'R' AND l_linenumber = 1)
        UNION ALL SELECT l_orderkey + 1000000000000, l_linenumber, l_suppkey, quantity, l_returnflag FROM was WHERE l_orderkey % 70 = 0)"""


@query(
    "set_2_digest_diff",
    "WITH" + NEXT_LINES + """,
lost AS (SELECT DISTINCT l_orderkey FROM (SELECT * FROM was EXCEPT ALL SELECT * FROM now)),
won AS (SELECT DISTINCT l_orderkey FROM (SELECT * FROM now EXCEPT ALL SELECT * FROM was)),
sides AS (SELECT l_orderkey, count(*) AS w, 0 AS n FROM was GROUP BY l_orderkey UNION ALL SELECT l_orderkey, 0, count(*) FROM now GROUP BY l_orderkey),
sizes AS (SELECT l_orderkey, CAST(sum(w) AS BIGINT) AS was_rows, CAST(sum(n) AS BIGINT) AS now_rows FROM sides GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN was_rows = 0 THEN 'appeared' WHEN now_rows = 0 THEN 'disappeared' ELSE 'changed' END AS change, was_rows, now_rows
FROM sizes WHERE l_orderkey IN (SELECT * FROM lost UNION SELECT * FROM won)""",
)
def digest_diff(data):
    """Whole lines of two releases, compared below the digests that differ."""
    was = data.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").cast("double").alias("quantity"), "l_returnflag"
    )
    corrected = F.when(F.col("l_suppkey") == 3, F.col("quantity") + 1).otherwise(F.col("quantity"))
    kept = was.where((F.col("l_orderkey") % 50 != 0) & ~((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)))
    again = was.where(F.col("l_orderkey") % 70 == 0).withColumn("l_orderkey", F.col("l_orderkey") + 10**12)
    now = kept.withColumn("quantity", corrected).unionByName(again)
    old, new = (digests.store(r, ["l_orderkey"], workspace(data.spark, "release"), folder_bits=4) for r in (was, now))
    return digests.changed_rows(old, new)
