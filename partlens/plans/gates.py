"""Quality-gate queries over findings, footers, probes and releases."""

from __future__ import annotations

from pyspark.sql import functions as F

from partlens.functions import paths
from partlens.functions import text as words
from partlens.operators import graph, quality
from partlens.plans.registry import query
from partlens.plans.relations import TABLES, Data
from partlens.plans.scans import file_table, staged
from partlens.session import literal_rows
from partlens.sources import footers

CRASH = r"host 'h\d' \| error"


def rules(data: Data, *ids: str):
    return literal_rows(data.spark, [(i,) for i in ids], "rule_id string")


def citations(data: Data):
    return data.hrefs.select("path", "href")


@query(
    "agg_11_href_inventory",
    "SELECT href, count(DISTINCT path) AS documents, min(path) AS example FROM hrefs GROUP BY href",
)
def href_inventory(data):
    return graph.href_inventory(citations(data))


@query(
    "agg_11_remote_citations",
    "SELECT DISTINCT href, path FROM cat_assets WHERE key IN ('data', 'visual') AND href LIKE 'https://%'",
)
def remote_citations(data):
    return graph.remote_citations(data.cat_assets)


@query(
    "agg_12_severity_counts",
    "SELECT severity, rule_id, count(*) AS findings, count(DISTINCT path) AS paths FROM findings GROUP BY severity, rule_id",
)
def severity_counts(data):
    return quality.severity_counts(data.findings)


@query(
    "join_9_rule_differences",
    """WITH f AS (SELECT DISTINCT rule_id FROM findings WHERE severity = 'error'), e AS (SELECT * FROM (VALUES ('QR-1'), ('QR-2'), ('QR-77')) AS t(rule_id))
       SELECT rule_id, 'missing' AS difference FROM e WHERE rule_id NOT IN (SELECT rule_id FROM f)
       UNION ALL SELECT rule_id, 'extra' FROM f WHERE rule_id NOT IN (SELECT rule_id FROM e)""",
)
def rule_differences(data):
    return quality.rule_differences(data.findings, rules(data, "QR-1", "QR-2", "QR-77"))


@query(
    "qc_6_findings_gate",
    """SELECT CASE WHEN rule_id IN ('QR-1', 'QR-2') THEN 'waived' WHEN severity = 'error' THEN 'blocking' ELSE 'note' END AS disposition,
              rule_id, count(*) AS n FROM findings GROUP BY ALL""",
)
def findings_gate(data):
    gated = quality.gate(data.findings, rules(data, "QR-1", "QR-2"))
    return gated.groupBy("disposition", "rule_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "qc_7_expected_exactly",
    """WITH f AS (SELECT * FROM findings WHERE severity = 'error')
       SELECT DISTINCT rule_id, 'unexpected rule' AS problem, true AS fails FROM f WHERE rule_id NOT IN ('QR-1', 'QR-2', 'QR-77')
       UNION ALL SELECT 'QR-77', 'no longer reported', false
       UNION ALL SELECT DISTINCT rule_id, 'names another host: ' || message, true FROM f WHERE NOT contains(message, 'host ''h1''')""",
)
def expected_exactly(data):
    return quality.expected_exactly(data.findings, rules(data, "QR-1", "QR-2", "QR-77"), "h1")


def outcomes(data: Data):
    return data.findings.select(
        "path", "message", (F.col("severity") != "error").alias("valid"), F.col("rule_id").isin("QR-3", "QR-4").alias("reachable")
    )


@query(
    "qc_8_exemption",
    r"""SELECT path, message, CASE WHEN contains(message, 'host ''h1''') AND regexp_matches(message, 'host ''h\d'' \| error') THEN 'exempt' ELSE 'error' END AS outcome
        FROM findings WHERE severity = 'error'""",
)
def exemption(data):
    return quality.exemption(outcomes(data), "host 'h1'", CRASH).select("path", "message", "outcome")


@query(
    "qc_8_exemption_report",
    r"""WITH x AS (SELECT severity = 'error' AND contains(message, 'host ''h1''') AND regexp_matches(message, 'host ''h\d'' \| error') AS exempt, * FROM findings)
        SELECT count(*) AS checked, count(*) FILTER (WHERE rule_id IN ('QR-3', 'QR-4')) AS reachable, count(*) FILTER (WHERE exempt) AS exempt,
               count(*) FILTER (WHERE severity = 'error' AND NOT exempt) AS errors,
               count(*) FILTER (WHERE rule_id IN ('QR-3', 'QR-4')) > 0 AND count(*) FILTER (WHERE exempt) = 0 AS expired,
               false AS ok FROM x""",
)
def exemption_report(data):
    return quality.exemption_report(outcomes(data), "host 'h1'", CRASH)


@query(
    "qc_3_footer_rules",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS name, 'unknown format version' AS rule, CAST(0 AS BIGINT) AS n
            UNION ALL SELECT '{t}', 'row group above cap', count(*) FROM {t} HAVING count(*) > 40"""
        for t in TABLES
    ),
)
def footer_rules(data):
    parts = footers.list_parts(data.spark, data.folder)
    # The given tables are single row groups, so a table's rows are its largest row group.
    found = quality.footer_findings(footers.row_groups(parts), footers.part_facts(parts), 40)
    return found.select(file_table().alias("name"), "rule", "n")


@query(
    "qc_3_rules_both_ways",
    """WITH g AS (SELECT 'f' || CAST(o_custkey % 20 AS STRING) AS path, CAST(o_orderkey % 3 AS INT) AS row_group, o_orderkey % 11 <> 0 OR o_custkey % 20 < 12 AS has_stats,
                  o_custkey % 20 * 10 AS num_rows FROM orders)
       SELECT path, 'row group without statistics' AS rule, count(DISTINCT row_group) AS n FROM g WHERE NOT has_stats GROUP BY path
       UNION ALL SELECT path, 'row group above cap', CAST(max(num_rows) AS BIGINT) FROM g GROUP BY path HAVING max(num_rows) > 100
       UNION ALL SELECT DISTINCT path, 'unknown format version', CAST(0 AS BIGINT) FROM g WHERE num_rows % 40 = 0""",
)
def footer_rules_both_ways(data):
    # Footers as orders would have them: for each rule some files keep it and some do not.
    file = F.col("o_custkey") % 20
    groups = data.orders.select(
        F.concat(F.lit("f"), file.cast("string")).alias("path"),
        (F.col("o_orderkey") % 3).cast("int").alias("row_group"),
        ((F.col("o_orderkey") % 11 != 0) | (file < 12)).alias("has_stats"),
        (file * 10).alias("num_rows"),
    )
    parts = groups.select("path", "num_rows").distinct().select(
        "path", F.when(F.col("num_rows") % 40 != 0, F.when(F.col("num_rows") % 20 == 0, "1.0.0").otherwise("1.1.0")).alias("geoparquet_version")
    )
    return quality.footer_findings(groups, parts, 100)


@query(
    "qc_8_declared_schemas",
    """SELECT p_partkey AS id, p_size % 3 = 0 AS reachable FROM part""",
)
def declared_schemas(data):
    address = F.concat(F.lit("https://schemas.example.org/table/v"), F.col("p_size") % 3, F.lit(".2.0/schema.json"))
    given = F.array(F.lit("https://schemas.example.org/other/v1.0.0/schema.json"), F.concat(address, F.when(F.col("p_partkey") % 2 == 0, "#").otherwise("")))
    wanted = r"https://schemas\.example\.org/table/v0\.\d+\.\d+/schema\.json"
    return data.part.select(F.col("p_partkey").alias("id"), quality.declares(given, wanted).alias("reachable"))


@query(
    "qc_3_staged_statistics",
    """SELECT CAST(0 AS BIGINT) AS without_statistics, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM geo_boxes""",
)
def staged_statistics(data):
    path = staged(data, data.features, "features")
    groups = footers.row_groups(footers.list_parts(data.spark, path))
    missing = F.count_if(~F.col("has_stats")).alias("without_statistics")
    leaf = lambda n: F.col("column") == f"bbox.{n}"
    return groups.agg(
        missing,
        F.min(F.when(leaf("xmin"), F.col("min_double"))).alias("xmin"),
        F.min(F.when(leaf("ymin"), F.col("min_double"))).alias("ymin"),
        F.max(F.when(leaf("xmax"), F.col("max_double"))).alias("xmax"),
        F.max(F.when(leaf("ymax"), F.col("max_double"))).alias("ymax"),
    )


@query(
    "qc_4_spatial_order",
    """WITH g AS (SELECT collection AS path, part_no, CASE WHEN collection <> 'geo/O' OR part_no % 5 <> 2 THEN pxmin END AS pxmin, pymin, pxmax, pymax FROM geo_parts
         UNION ALL SELECT 'one/' || collection, 0, pxmin, pymin, pxmax, pymax FROM geo_parts WHERE part_no = 7),
       p AS (SELECT path, part_no AS row_group, pxmin, pymin, pxmax, pymax, lead(part_no) OVER w AS next,
           lead(pxmin) OVER w AS nx0, lead(pymin) OVER w AS ny0, lead(pxmax) OVER w AS nx1, lead(pymax) OVER w AS ny1
         FROM g WINDOW w AS (PARTITION BY path ORDER BY part_no)),
       r AS (SELECT path, row_group + 1 = next AS pair, CASE WHEN pxmin IS NULL OR nx0 IS NULL OR row_group + 1 IS DISTINCT FROM next THEN NULL ELSE greatest(least(pxmax, nx1) - greatest(pxmin, nx0), 0) * greatest(least(pymax, ny1) - greatest(pymin, ny0), 0)
           / least((pxmax - pxmin) * (pymax - pymin), (nx1 - nx0) * (ny1 - ny0)) END AS ratio FROM p)
       SELECT path, count(*) FILTER (WHERE pair) AS pairs, count(*) FILTER (WHERE pair AND ratio IS NULL) AS unknown, round(avg(ratio), 6) AS overlap,
              CASE WHEN avg(ratio) > 0.02 THEN false WHEN count(*) FILTER (WHERE pair AND ratio IS NULL) = 0 THEN true END AS ordered FROM r GROUP BY path""",
)
def spatial_order(data):
    groups = data.geo_parts.select(
        F.col("collection").alias("path"), F.col("part_no").alias("row_group"), F.col("pxmin").alias("xmin"),
        F.col("pymin").alias("ymin"), F.col("pxmax").alias("xmax"), F.col("pymax").alias("ymax"),
    )
    # Some row groups of one file state nothing, and some files have one row group.
    stated = (F.col("path") != "geo/O") | (F.col("row_group") % 5 != 2)
    single = groups.where("row_group = 7").withColumns({"path": F.concat(F.lit("one/"), "path"), "row_group": F.lit(0)})
    groups = groups.withColumn("xmin", F.when(stated, F.col("xmin"))).unionByName(single)
    return quality.spatial_order(groups, 0.02).withColumn("overlap", F.round("overlap", 6))


@query(
    "qc_10_blob_verdict",
    """WITH p AS (SELECT a.conv_id, a.turn, a.text AS probe, coalesce(b.text, '') AS blank FROM conversations a LEFT JOIN conversations b
                  ON a.conv_id = b.conv_id AND a.turn = b.turn + 1)
       SELECT conv_id, turn, octet_length(encode(probe)) AS probe_bytes, octet_length(encode(blank)) AS blank_bytes,
              CASE WHEN sha256(probe) = sha256(blank) THEN 'FAIL-empty'
                   WHEN octet_length(encode(probe)) < octet_length(encode(blank)) * 1.15 THEN 'WARN-sparse' ELSE 'PASS' END AS verdict FROM p""",
)
def blob_verdict(data):
    before = data.conversations.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("blank"))
    pairs = data.conversations.select("conv_id", "turn", F.col("text").alias("probe")).join(before, ["conv_id", "turn"], "left")
    # A first turn has nothing before it.
    pairs = pairs.withColumn("blank", F.coalesce("blank", F.lit("")))
    judged = quality.blob_verdict(pairs, "probe", "blank")
    size = lambda c: F.col(c).cast("bigint").alias(c)
    return judged.select("conv_id", "turn", size("probe_bytes"), size("blank_bytes"), "verdict")


@query(
    "qc_10_document_blobs",
    """WITH p AS (SELECT item_id, d.text AS probe, b.text AS blank FROM documents d
                  LEFT JOIN benchmark b ON b.item_id = d.doc_id % (SELECT max(item_id) + 1 FROM benchmark))
       SELECT CASE WHEN sha256(probe) = sha256(blank) THEN 'FAIL-empty'
                   WHEN octet_length(encode(probe)) < octet_length(encode(blank)) * 1.15 THEN 'WARN-sparse' ELSE 'PASS' END AS verdict,
              count(*) AS n FROM p GROUP BY ALL""",
)
def document_blobs(data):
    """Every document against one of the benchmark's texts."""
    items = data.benchmark.agg(F.max("item_id") + 1).first()[0]
    blank = data.benchmark.select("item_id", F.col("text").alias("blank"))
    pairs = data.documents.select((F.col("doc_id") % items).alias("item_id"), F.col("text").alias("probe")).join(blank, "item_id", "left")
    return quality.blob_verdict(pairs, "probe", "blank").groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


@query(
    "qc_11_guards",
    """SELECT 'error' AS severity, 'no ' || s.p_size || ' of ' || b.p_brand AS message
       FROM (SELECT DISTINCT p_brand FROM part) b, (SELECT DISTINCT p_size FROM part) s
       WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_brand = b.p_brand AND p.p_size = s.p_size)""",
)
def guards(data):
    """Every size of every brand has to have a part."""
    # Fifty sizes at most.
    every = sorted(r[0] for r in data.part.select("p_size").distinct().collect())
    named = data.part.select("p_brand").distinct().select("p_brand", F.explode(F.array(*[F.lit(n) for n in every])).alias("p_size"))
    counted = data.part.groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"))
    counts = named.join(counted, ["p_brand", "p_size"], "left")
    return quality.guards(counts.select(F.concat(F.col("p_size").cast("string"), F.lit(" of "), "p_brand").alias("what"), "n"))


@query(
    "join_13_dead_links",
    """SELECT href, min(path) AS example, CASE WHEN max(status) IS NULL THEN 'no answer' ELSE 'HTTP ' || CAST(max(status) AS STRING) END AS reason
       FROM hrefs WHERE coalesce(status, 0) NOT BETWEEN 200 AND 299 GROUP BY href""",
)
def dead_links(data):
    statuses = data.hrefs.where(F.col("status").isNotNull()).groupBy("href").agg(F.max("status").alias("status"))
    return quality.liveness(citations(data), statuses)


@query(
    "fn_11_host",
    """SELECT split_part(split_part(href, '://', 2), '/', 1) AS host, count(*) AS n FROM hrefs GROUP BY ALL
       UNION ALL SELECT NULL, count(*) FROM supplier""",
)
def host(data):
    every = data.hrefs.select("href").unionByName(data.supplier.select(F.col("s_name").alias("href")))
    return every.groupBy(paths.host_of(F.col("href")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "txt_4_version_range",
    r"""WITH v AS (SELECT id, nullif(regexp_extract(text, '(\d+)\.(\d+)\.(\d+)', 0), '') AS x FROM version_text),
        p AS (SELECT id, x, CAST(split_part(x, '.', 1) AS BIGINT) AS a, CAST(split_part(x, '.', 2) AS BIGINT) AS b, CAST(split_part(x, '.', 3) AS BIGINT) AS c FROM v)
        SELECT id, a AS major, b AS minor, c AS patch, a * 10000 + b * 100 + c >= 400 AND a * 10000 + b * 100 + c < 500 AS in_range FROM p""",
)
def version_range(data):
    version = words.version_of(F.col("text"))
    return data.version_text.select(
        "id", version["major"].alias("major"), version["minor"].alias("minor"), version["patch"].alias("patch"),
        words.version_within(version, (0, 4, 0), (0, 5, 0)).alias("in_range"),
    )


@query(
    "txt_5_latest_release",
    r"""WITH v AS (SELECT package, replace(text, 'tool, version ', '') AS x, yanked FROM version_text),
        u AS (SELECT package, x FROM v WHERE regexp_matches(x, '^\d+\.\d+\.\d+$') GROUP BY package, x HAVING bool_or(NOT yanked)),
        n AS (SELECT package, max([CAST(split_part(x, '.', 1) AS BIGINT), CAST(split_part(x, '.', 2) AS BIGINT), CAST(split_part(x, '.', 3) AS BIGINT)]) AS v FROM u GROUP BY package)
        SELECT package, CAST(v[1] AS STRING) || '.' || CAST(v[2] AS STRING) || '.' || CAST(v[3] AS STRING) AS version, v > [1, 11, 0] AS due FROM n""",
)
def latest_release(data):
    releases = data.version_text.select(
        "package", F.regexp_replace("text", "^tool, version ", "").alias("version"), "yanked"
    )
    return quality.latest_release(releases, (1, 11, 0))
