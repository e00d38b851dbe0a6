"""Profiling and legend queries over the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from partlens.operators import kept, profile, spatial
from partlens.plans.registry import query
from partlens.plans.relations import WINDOWS, Data
from partlens.session import literal_rows, workspace

WINDOWED = spatial.Scope(False, tuple(WINDOWS))
WHOLE = spatial.Scope(True, ())

# Colours of our own for the example legends.
COLOURS = (
    ("1-URGENT", "#b03a2e"),
    ("2-HIGH", "#d68910"),
    ("3-MEDIUM", "#b7950b"),
    ("4-NOT SPECIFIED", "#85929e"),
    ("5-LOW", "#2e86c1"),
)
PALETTE = ["#f2f7fb", "#d3e3f0", "#b0cde4", "#86b3d6", "#5d98c6", "#3c7db3", "#24639d", "#154b83", "#0c3566", "#072247"]

# Stands for all rows of a sample.
EVERY = "_every_row"
TEXT_COLUMNS = ("subtype", "status", "cust", "dominant", "sparse", "band")
LONG = " UNION ALL ".join(
    [f"""SELECT "window", '{c}' AS "column", 'text' AS kind, {c} AS text, CAST(NULL AS DOUBLE) AS number FROM {{source}} WHERE {c} IS NOT NULL""" for c in TEXT_COLUMNS]
    + ["""SELECT "window", 'depth', 'numeric', NULL, CAST(depth AS DOUBLE) FROM {source}"""]
)
WHOLE_SOURCE = "(SELECT 'all' AS \"window\", * FROM geo_boxes)"


def counts_sql(source: str) -> str:
    return f"""
WITH long AS ({LONG.format(source=source)}),
counts AS (SELECT "window", "column", kind, text, number, count(*) AS n FROM long GROUP BY ALL),
totals AS (SELECT "column", kind, text, number, CAST(sum(n) AS BIGINT) AS n, count(*) AS hits FROM counts GROUP BY ALL)"""


def screen_sql(source: str, scopes: int) -> str:
    need = (scopes + 1) // 2
    return counts_sql(source) + f""",
seen AS (SELECT "column", kind, count(*) AS d, count(*) FILTER (WHERE hits >= {need}) AS r FROM totals GROUP BY ALL),
listed AS (SELECT * FROM (VALUES ('subtype', 0), ('status', 1), ('cust', 2), ('dominant', 3), ('sparse', 4), ('band', 5), ('depth', 6)) AS t("column", ordinal)),
judged AS (SELECT "column", kind, ordinal, CASE WHEN d <= 40 THEN d END AS distinct_seen,
  CASE WHEN d > 40 THEN NULL ELSE CAST(r AS BIGINT) END AS recurring,
  CASE WHEN kind = 'numeric' AND d NOT BETWEEN 3 AND 10 THEN 'no step break'
       WHEN d > 40 THEN 'too many values' WHEN d < 3 THEN 'too few values' WHEN r < 3 THEN 'tracks location'
       ELSE 'candidate' END AS verdict FROM seen JOIN listed USING ("column")),
screened AS (SELECT *, CASE WHEN verdict = 'candidate' THEN row_number() OVER (PARTITION BY kind, verdict ORDER BY
  CASE WHEN distinct_seen <= 10 THEN 0 ELSE 1 END, CASE WHEN distinct_seen <= 10 THEN -distinct_seen ELSE distinct_seen END, ordinal) END AS rank FROM judged)"""


def measure_sql(source: str, scopes: int) -> str:
    return screen_sql(source, scopes) + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, text, number) AS position FROM totals),
total_rows AS (SELECT count(*) AS sampled FROM {source}),
metrics AS (SELECT "column", sum(n) AS total, max(n) / sum(n) AS dominance,
  sum(CASE WHEN position <= 10 THEN n ELSE 0 END) / sum(n) AS coverage,
  sum(CASE WHEN position <= 10 THEN n ELSE 0 END) / sum(n) * (1 - max(n) / sum(n)) AS score,
  sum(n) / (SELECT sampled FROM total_rows) AS populated FROM ranked GROUP BY "column"),
measured AS (SELECT s.*, m.dominance, m.coverage, m.score, m.populated, m.total,
  populated >= 0.5 AS relaxed_ok,
  populated >= 0.5 AND dominance <= 0.9 AND (kind = 'numeric' OR coverage >= 0.8) AS strict_ok
  FROM screened s JOIN metrics m USING ("column") WHERE rank IS NOT NULL),
staged AS (SELECT *, CASE WHEN strict_ok AND kind = 'text' THEN 1 WHEN strict_ok THEN 2 WHEN relaxed_ok AND kind = 'text' THEN 3 WHEN relaxed_ok THEN 4 END AS stage FROM measured),
placed AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN kind = 'text' THEN -score ELSE 0 END, rank) AS place FROM staged
  WHERE stage = (SELECT min(stage) FROM staged)),
chosen AS (SELECT * FROM placed WHERE kind = 'text' OR place = 1),
legend_values AS (SELECT r."column", r.kind, r.text, r.number, r.n, r.position, c.place, c.stage FROM ranked r JOIN chosen c ON c."column" = r."column")"""


def rounded(df, *names, places: int = 6):
    for n in names:
        df = df.withColumn(n, F.round(n, places))
    return df


def run(data: Data, scope=WINDOWED, drop=(), **kw) -> profile.Profile:
    return profile.profile(data.features.drop(*drop), scope, **kw)


@query(
    "agg_3_value_counts",
    counts_sql("geo_sample") + ' SELECT "column", kind, text, number, n FROM totals',
)
def value_counts(data):
    sampled = spatial.sample(data.features, WINDOWED)
    return profile.total_counts(profile.value_counts(sampled, profile.column_kinds(data.features)))


@query("agg_3_value_counts_per_window", counts_sql("geo_sample") + " SELECT * FROM counts")
def value_counts_per_window(data):
    sampled = spatial.sample(data.features, WINDOWED)
    return profile.value_counts(sampled, profile.column_kinds(data.features))


@query(
    "agg_3_long_integers",
    """SELECT 'key' AS "column", 9007199254740992 + o_orderkey % 30 AS value, count(*) AS n FROM orders GROUP BY ALL""",
)
def long_integers(data):
    """Identifiers that a double cannot tell apart."""
    keys = data.orders.select(F.lit("all").alias("window"), (F.lit(2**53) + F.col("o_orderkey") % 30).alias("key"))
    counted = profile.total_counts(profile.value_counts(keys, {"key": profile.NUMERIC}))
    value = F.coalesce(F.col("text").cast("bigint"), F.col("number").cast("bigint"))
    return counted.select("column", value.alias("value"), "n")


@query(
    "agg_4_capped_distinct",
    counts_sql(WHOLE_SOURCE) + """ SELECT "column", count(*) <= 40 AS few, CASE WHEN count(*) <= 40 THEN count(*) END AS distinct_seen FROM totals GROUP BY "column" """,
)
def capped_distinct(data):
    kinds = profile.column_kinds(data.features)
    sampled = spatial.sample(data.features, WHOLE)
    few = profile.survey(sampled, list(kinds), 40).few
    counted = profile.recurrence(profile.value_counts(sampled, kinds, few), 1)
    listed = profile.null_share(data.features, list(kinds)).select("column")
    few = F.coalesce(F.col("n_distinct") <= 40, F.lit(False))
    return listed.join(counted, "column", "left").select(
        "column", few.alias("few"), F.when(few, F.col("n_distinct")).alias("distinct_seen")
    )


@query(
    "agg_5_recurrence",
    counts_sql("geo_sample") + """ SELECT "column", kind, count(*) AS n_distinct, count(*) FILTER (WHERE hits >= 4) AS recurring FROM totals GROUP BY ALL""",
)
def recurrence(data):
    sampled = spatial.sample(data.features, WINDOWED)
    counts = profile.value_counts(sampled, profile.column_kinds(data.features))
    return profile.recurrence(counts, len(WINDOWS))


METRICS = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, text, number) AS position FROM totals),
m AS (SELECT "column", kind, CAST(sum(n) AS BIGINT) AS total, max(n) / sum(n) AS dominance,
      sum(CASE WHEN position <= 10 THEN n ELSE 0 END) / sum(n) AS coverage FROM ranked GROUP BY ALL)
SELECT "column", kind, total, round(dominance, 6) AS dominance, round(coverage, 6) AS coverage,
       round(coverage * (1 - dominance), 6) AS score, round(total / (SELECT count(*) FROM {source}), 6) AS populated FROM m"""


def measured_in_one_pass(data: Data, scope) -> DataFrame:
    """The rows of the sample are the one value of a column more, so that they are counted with the others."""
    sampled = spatial.sample(data.features, scope).withColumn(EVERY, F.lit(EVERY))
    kinds = profile.column_kinds(data.features) | {EVERY: profile.TEXT}
    rows = F.coalesce(F.max(F.when(F.col("column") == EVERY, F.col("total"))).over(W.partitionBy()), F.lit(0))
    measured = profile.metrics(profile.total_counts(profile.value_counts(sampled, kinds)), rows).where(F.col("column") != EVERY)
    return rounded(measured, "dominance", "coverage", "score", "populated")


@query("agg_6_candidate_metrics", counts_sql("geo_sample") + "," + METRICS.format(source="geo_sample"))
def candidate_metrics(data):
    return measured_in_one_pass(data, WINDOWED)


@query("agg_6_candidate_metrics_whole", counts_sql(WHOLE_SOURCE) + "," + METRICS.format(source="geo_boxes"))
def candidate_metrics_whole(data):
    return measured_in_one_pass(data, WHOLE)


@query(
    "agg_15_null_share",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS row_cnt, count({c}) AS present, round(count({c}) / count(*), 6) AS share FROM geo_boxes"""
        for c in (*TEXT_COLUMNS, "depth")
    ),
)
def null_share(data):
    shares = profile.null_share(data.features, [*TEXT_COLUMNS, "depth"])
    return rounded(shares.withColumnRenamed("rows", "row_cnt"), "share")


SCREENED = ' SELECT "column", kind, CAST(ordinal AS BIGINT) AS ordinal, distinct_seen, recurring, verdict, CAST(rank AS BIGINT) AS rank FROM screened'


def long_ranks(df):
    # The sketch is about right, so no SQL can check it.
    return df.drop("distinct_sketch").withColumns({c: F.col(c).cast("bigint") for c in ("rank", "ordinal")})


@query("prof_1_screen", screen_sql("geo_sample", 7) + SCREENED)
def screen(data):
    return long_ranks(run(data).screened)


@query("prof_1_screen_whole", screen_sql(WHOLE_SOURCE, 1) + SCREENED)
def screen_whole(data):
    return long_ranks(run(data, WHOLE).screened)


@query("prof_1_kept_screen", screen_sql(WHOLE_SOURCE, 1) + SCREENED)
def kept_screen(data):
    """The second release has one part of eight anew; the other seven are taken from the store."""
    part = F.format_string("part-%d", F.pmod(F.xxhash64("id"), F.lit(8)))
    second = data.features.withColumn("part", part)
    changed = F.col("part") == "part-3"
    first = second.withColumn("status", F.when(changed, F.col("cust")).otherwise(F.col("status")))
    store = kept.Store(data.spark, workspace(data.spark, "kept"), profile.column_kinds(data.features))
    for run, release in enumerate((first, second)):
        marks = release.select("part", F.when(changed, str(run)).otherwise("0").alias("fingerprint")).distinct()
        names = lambda wanted, release=release: release.where(F.col("part").isin(*wanted))
        prof = kept.kept_profile(store, marks, names)
    return long_ranks(prof.screened)


@query(
    "sort_2_screen_rank",
    screen_sql("geo_sample", 7) + ' SELECT kind, CAST(rank AS BIGINT) AS rank, "column" FROM screened WHERE rank IS NOT NULL',
)
def screen_rank(data):
    return long_ranks(run(data).screened.where(F.col("rank").isNotNull())).select("kind", "rank", "column")


@query(
    "sort_1_top_values",
    counts_sql(WHOLE_SOURCE) + """,
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, text, number) AS position FROM totals)
SELECT "column", text, number, n, position FROM r WHERE position <= 10""",
)
def top_values(data):
    kinds = profile.column_kinds(data.features)
    totals = profile.total_counts(profile.value_counts(spatial.sample(data.features, WHOLE), kinds))
    top = profile.top_values(totals, 10)
    return top.select("column", "text", "number", "n", F.col("position").cast("bigint").alias("position"))


MEASURED = """ SELECT "column", kind, CAST(rank AS BIGINT) AS rank, round(dominance, 6) AS dominance, round(coverage, 6) AS coverage,
round(score, 6) AS score, round(populated, 6) AS populated, strict_ok, relaxed_ok FROM measured"""


def measured_row(prof):
    rows = rounded(prof.measured, "dominance", "coverage", "score", "populated")
    return rows.select(
        "column", "kind", F.col("rank").cast("bigint").alias("rank"), "dominance", "coverage", "score", "populated",
        "strict_ok", "relaxed_ok",
    )


@query("prof_2_measure", measure_sql("geo_sample", 7) + MEASURED + " WHERE kind = 'text'")
def measure(data):
    return measured_row(run(data)).where(F.col("kind") == "text")


@query("prof_2_measure_whole", measure_sql(WHOLE_SOURCE, 1) + MEASURED)
def measure_whole(data):
    return measured_row(run(data, WHOLE))


# The first numeric column in rank order that is usable at all, whether or not a text column is usable too.
NUMERIC_CHOICE = """,
usable AS (SELECT "column", rank, CASE WHEN strict_ok THEN 2 WHEN relaxed_ok THEN 4 END AS stage FROM measured WHERE kind = 'numeric'),
picked AS (SELECT "column", stage, row_number() OVER (ORDER BY rank) AS place FROM usable WHERE stage = (SELECT min(stage) FROM usable))"""


@query(
    "prof_3_measure_numeric",
    measure_sql("geo_sample", 7) + NUMERIC_CHOICE + """ SELECT r."column", r.number AS value, r.n, round(m.dominance, 6) AS dominance, m.strict_ok,
CAST(row_number() OVER (PARTITION BY r."column" ORDER BY r.number) AS BIGINT) AS step, CAST(r.position AS BIGINT) AS position,
round(m.populated, 6) AS populated, m.relaxed_ok, CAST(m.rank AS BIGINT) AS rank, CAST(p.stage AS BIGINT) AS stage, p.stage IS NOT NULL AS chosen
FROM ranked r JOIN measured m ON m."column" = r."column" LEFT JOIN picked p ON p."column" = r."column" AND p.place = 1 WHERE m.kind = 'numeric'""",
)
def measure_numeric(data):
    """Every numeric candidate with its values in order, and which of the candidates is the first usable one."""
    return numeric_choice(run(data))


def numeric_choice(prof: profile.Profile) -> DataFrame:
    numeric = prof.measured.where(F.col("kind") == "numeric")
    best = profile.choose(numeric).select("column", F.col("stage").cast("bigint").alias("stage"))
    facts = rounded(numeric, "populated").select("column", "populated", "relaxed_ok", F.col("rank").cast("bigint").alias("rank"))
    by_value, by_count = W.partitionBy("column").orderBy("number"), W.partitionBy("column").orderBy(F.desc("n"), "text", "number")
    return numeric_values(prof).join(facts, "column").join(best, "column", "left").select(
        "column", F.col("number").alias("value"), "n", "dominance", "strict_ok",
        F.row_number().over(by_value).cast("bigint").alias("step"), F.row_number().over(by_count).cast("bigint").alias("position"),
        "populated", "relaxed_ok", "rank", "stage", F.col("stage").isNotNull().alias("chosen"),
    )


def numeric_values(prof: profile.Profile) -> DataFrame:
    measured = prof.measured.where(F.col("kind") == "numeric").select("column", F.round("dominance", 6).alias("dominance"), "strict_ok")
    totals = profile.total_counts(profile.value_counts(prof.sampled, {c: k for c, k in prof.kinds.items() if k == "numeric"}))
    return totals.join(measured, "column")


CHOSEN = ' SELECT "column", kind, CAST(stage AS BIGINT) AS stage, CAST(place AS BIGINT) AS place, round(score, 6) AS score FROM chosen'


def chosen_row(prof):
    return prof.chosen.select(
        "column", "kind", F.col("stage").cast("bigint").alias("stage"), F.col("place").cast("bigint").alias("place"),
        F.round("score", 6).alias("score"),
    )


@query("prof_4_choose", measure_sql("geo_sample", 7) + CHOSEN)
def choose(data):
    return chosen_row(run(data))


@query("prof_4_choose_whole", measure_sql(WHOLE_SOURCE, 1) + CHOSEN)
def choose_whole(data):
    return chosen_row(run(data, WHOLE))


@query(
    "sort_3_preferred_first",
    measure_sql("geo_sample", 7) + """ SELECT "column", CAST(row_number() OVER (ORDER BY "column" <> 'status', score DESC, rank) AS BIGINT) AS place
FROM chosen WHERE stage = 1""",
)
def preferred_first(data):
    prof = run(data, preferred="status")
    return prof.chosen.select("column", F.col("place").cast("bigint").alias("place"))


@query(
    "prof_5_alternates",
    measure_sql("geo_sample", 7) + """ SELECT c."column", count(*) AS confirmed FROM chosen c JOIN legend_values v ON v."column" = c."column"
WHERE c.place > 1 GROUP BY c."column" HAVING count(*) >= 3""",
)
def alternates(data):
    prof = run(data)
    wanted = {c: prof.kinds[c] for c in ("subtype", "status", "dominant")}
    held = profile.confirm(prof.sampled, wanted, prof.values.where(F.col("place") > 1))
    return held.groupBy("column").agg(F.count(F.lit(1)).alias("confirmed")).where(F.col("confirmed") >= 3)


@query(
    "prof_6_match_legend",
    measure_sql("geo_sample", 7) + """, colours AS (SELECT * FROM (VALUES ('1-URGENT', '#b03a2e'), ('2-HIGH', '#d68910'), ('3-MEDIUM', '#b7950b'), ('4-NOT SPECIFIED', '#85929e'), ('5-LOW', '#2e86c1')) AS c(text, colour))
SELECT v."column", v.position, v.text AS value, colour FROM legend_values v JOIN colours c ON c.text = v.text WHERE v.place = 1
UNION ALL SELECT DISTINCT "column", CAST(NULL AS BIGINT), NULL, '#9e9e9e' FROM legend_values WHERE place = 1""",
)
def match_legend(data):
    return profile.match_legend(run(data).values.where(F.col("place") == 1), colours(data))


def colours(data: Data):
    rows = [("subtype", *pair) for pair in COLOURS]
    return literal_rows(data.spark, rows, "column string, text string, colour string")


@query(
    "join_6_unmapped_values",
    measure_sql("geo_sample", 7) + """ SELECT "column", text FROM legend_values WHERE place = 1 AND text NOT IN ('1-URGENT', '5-LOW')""",
)
def unmapped_values(data):
    known = colours(data).where(F.col("text").isin("1-URGENT", "5-LOW"))
    return profile.unmapped(run(data).values.where(F.col("place") == 1), known).select("column", "text")


STEPS = "(VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(PALETTE)) + ") AS p(i, colour)"


@query(
    "prof_7_step_legend",
    measure_sql("geo_sample", 7) + f""", numbered AS (
  SELECT r."column", r.number, row_number() OVER (PARTITION BY r."column" ORDER BY r.number) - 1 AS step
  FROM ranked r JOIN measured m ON m."column" = r."column" WHERE m.kind = 'numeric' AND m.strict_ok)
SELECT "column", step, CASE WHEN step > 0 THEN number END AS from_value, colour FROM numbered JOIN {STEPS} ON p.i = step % {len(PALETTE)}""",
)
def step_legend(data):
    """The steps of every usable numeric column, whichever column is chosen in the end."""
    return profile.step_legend(numeric_values(run(data)).where("strict_ok"), PALETTE)


NAMES = ", ".join(w.name for w in WINDOWS)


def legend_of(data: Data):
    return profile.legend_row(data.spark, profile.build_legend(run(data), WINDOWED, polygons=True))


@query(
    "prof_8_legend_report",
    measure_sql("geo_sample", 7) + f""" SELECT c."column", 'match' AS expression,
(SELECT string_agg(text, '; ' ORDER BY position) FROM legend_values WHERE place = 1) AS "values",
coalesce((SELECT string_agg("column", '; ' ORDER BY place) FROM chosen WHERE place > 1), '') AS alternates,
false AS exhaustive, '{NAMES}' AS windows, round(dominance, 4) AS dominance, round(coverage, 4) AS coverage, stage > 2 AS thresholds_relaxed, true AS legend,
'Legend values were sampled inside 7 windows ({NAMES}). A value found only outside them is missing.' AS note FROM chosen c WHERE place = 1""",
)
def legend_report(data):
    row = legend_of(data)
    return (
        row.withColumn("values", F.concat_ws("; ", "values"))
        .withColumn("alternates", F.concat_ws("; ", "alternates"))
        .withColumn("windows", F.concat_ws(", ", "windows"))
    )


@query(
    "prof_6_palette_check",
    """SELECT DISTINCT p_brand AS label FROM part WHERE p_size % 32 = 30""",
)
def palette_check(data):
    tone = F.when(F.col("p_size") % 32 == 30, "#9E9E9E").otherwise(F.format_string("#%06x", F.col("p_size") * 4099))
    return profile.palettes_with_fallback(data.part.select(F.col("p_brand").alias("label"), tone.alias("colour")))


@query(
    "prof_8_legend_values",
    measure_sql("geo_sample", 7) + """ SELECT 'match' AS expression, v."column", v.text AS value, v.position, round(c.dominance, 4) AS dominance, round(c.coverage, 4) AS coverage
FROM legend_values v JOIN chosen c ON c."column" = v."column" WHERE c.place = 1""",
)
def legend_values(data):
    row = legend_of(data)
    return row.select("expression", "column", "dominance", "coverage", F.posexplode("values").alias("p", "value")).select(
        "expression", "column", "value", (F.col("p") + 1).cast("bigint").alias("position"), "dominance", "coverage"
    )


@query(
    "prof_9_sampled_tables",
    """SELECT DISTINCT collection FROM geo_parts JOIN geo_boxes ON 'geo/' || status = collection""",
)
def sampled_tables(data):
    scopes = spatial.scan_scopes(data.parts, WINDOWS, "box")
    values = data.features.groupBy(F.concat(F.lit("geo/"), "status").alias("collection")).agg(
        F.collect_set("subtype").alias("values")
    )
    legends = scopes.groupBy("collection").agg(F.bool_and("exhaustive").alias("exhaustive")).join(values, "collection")
    return profile.sampled_tables(legends)


@query(
    "flt_7_confirm",
    measure_sql("geo_sample", 7) + """ SELECT "column", text FROM legend_values WHERE text IN (SELECT subtype FROM geo_sample UNION SELECT dominant FROM geo_sample)
AND place = 1""",
)
def confirm(data):
    prof = run(data)
    invented = literal_rows(data.spark, [("subtype", "9-NEVER", None)], "column string, text string, number double")
    asked = prof.values.where(F.col("place") == 1).select("column", "text", "number").unionByName(invented)
    return profile.confirm(prof.sampled.select("window", "subtype"), {"subtype": "text"}, asked).select("column", "text")


@query(
    "join_5_confirmed_in_order",
    counts_sql("geo_sample") + """, asked AS (SELECT 'cust' AS "column", CAST(c_custkey AS STRING) AS text, c_custkey AS position FROM customer)
SELECT a.text, a.position, EXISTS (SELECT 1 FROM totals t WHERE t."column" = 'cust' AND t.text = a.text) AS confirmed FROM asked a""",
)
def confirmed_in_order(data):
    sampled = spatial.sample(data.features, WINDOWED)
    asked = data.customer.select(
        F.lit("cust").alias("column"), F.col("c_custkey").cast("string").alias("text"),
        F.lit(None).cast("double").alias("number"), F.col("c_custkey").alias("position"),
    )
    held = profile.confirm(sampled.select("window", "cust"), {"cust": "text"}, asked)
    rest = asked.join(held, ["column", "text"], "left_anti")
    return held.select("text", "position", F.lit(True).alias("confirmed")).unionByName(
        rest.select("text", "position", F.lit(False).alias("confirmed"))
    )


@query(
    "prof_10_coded_columns",
    """WITH v AS (SELECT 'parts' AS collection, p_brand AS "column", p_type || '-' || CAST(p_size AS STRING) AS value FROM part GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS i FROM v)
SELECT collection, "column", CAST(i AS INT) AS position, '`' || value || '`' AS rendered FROM r""",
)
def coded_columns(data):
    # A size and a type make at most 300 codes a brand.
    codes = data.part.groupBy(F.lit("parts").alias("collection"), F.col("p_brand").alias("column")).agg(
        F.array_sort(F.collect_set(F.concat_ws("-", "p_type", "p_size"))).alias("codes")
    )
    enum = F.transform("codes", lambda c: F.struct(c.alias("value")))
    return profile.coded_columns(codes.withColumn("enum", enum))
