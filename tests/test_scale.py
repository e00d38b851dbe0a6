"""The skew-safe building blocks against plain models, and the plans they give."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partlens.functions.boxes import Box, overlaps
from partlens.operators import profile, spatial
from partlens.scale import running_last, salted_join, shares


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return df._jdf.queryExecution().toString()


def test_salted_join_equals_plain_join(frame):
    left = frame([(1 if i % 3 else None if i % 7 == 0 else i, i) for i in range(300)], "k int, i int")
    right = frame([(k, f"v{k}") for k in range(0, 300, 2)] + [(1, f"a{n}") for n in range(40)], "k int, v string")
    plain = sorted(map(repr, left.join(right, ["k"]).collect()))
    for hot in (1, 7, 50, 1000):
        assert sorted(map(repr, salted_join(left, right, ["k"], ["i"], ["v"], hot_rows=hot).collect())) == plain


def spread(spark, left, right, hot):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = salted_join(left, right, ["k"], ["i"], ["v"], hot_rows=hot)
        return [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_key_heavy_on_either_side_is_spread(frame, spark):
    few, many = frame([(1, i) for i in range(20)], "k int, i int"), frame([(1, i) for i in range(2000)], "k int, i int")
    of = lambda df: df.withColumnRenamed("i", "v")
    for left, right in ((many, of(few)), (few, of(many)), (many, of(many).where("v < 200"))):
        sizes = spread(spark, left, right, 50)
        assert sum(sizes) == left.count() * right.count()
        assert max(sizes) < 0.5 * sum(sizes)


def test_any_number_of_keys_may_be_heavy(frame):
    rows = frame([(i % 5000,) for i in range(15000)], "k int")
    assert shares(rows, ["k"], "n", hot_rows=2).count() == 5000
    assert shares(rows, ["k"], "n", hot_rows=3).count() == 0
    one = frame([(7,)] * 95 + [(8,)], "k int")
    assert [(r.k, r.n) for r in shares(one, ["k"], "n", hot_rows=10).collect()] == [(7, 10)]


def test_cells_follow_the_windows(frame):
    """Half-degree windows among points meet few candidates that do not overlap."""
    box = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    rng = random.Random(3)
    spots = [(rng.uniform(0, 20), rng.uniform(0, 20)) for _ in range(2000)]
    points = frame([(i, (x, y, x + 0.001, y + 0.001)) for i, (x, y) in enumerate(spots)], f"fi int, bbox {box}")
    windows = frame([(i, (x, y, x + 0.5, y + 0.5)) for i, (x, y) in enumerate(spots[:50])], f"wi int, window_bbox {box}")
    met = spatial.overlap_join(points, windows, salt_by=["fi"])
    want = sum(x < a + 0.5 and x + 0.001 > a and y < b + 0.5 and y + 0.001 > b for x, y in spots for a, b in spots[:50])
    assert met.count() == want


def test_running_last_matches_a_plain_loop(frame):
    rng = random.Random(5)
    rows = [(f, n, rng.random() < 0.1) for f in ("a", "b") for n in range(1, 200)]
    lines = frame(rows, "f string, n int, m boolean")
    for before in (False, True):
        for block in (1, 7, 1000):
            got = running_last(lines, ["f"], "n", F.when(F.col("m"), F.col("n")), "last", before=before, block_rows=block)
            want, last = {}, {}
            for f, n, m in rows:
                if before:
                    want[f, n] = last.get(f)
                if m:
                    last[f] = n
                if not before:
                    want[f, n] = last.get(f)
            assert {(r["f"], r["n"]): r["last"] for r in got.collect()} == want


def boxes():
    number = st.one_of(
        st.integers(-200, 200).map(float),
        st.sampled_from([0.0, 0.5, 0.25, 1e-7, 16.0, 512.0, -512.0, 511.5, 1e9, -1e9, float("inf"), float("-inf")]),
    )
    return st.lists(st.tuples(number, number, number, number), min_size=1, max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(boxes(), boxes(), st.sampled_from([3, 1000]))
def test_overlap_join_finds_each_pair_once(spark, features, windows, hot_rows):
    box = lambda *names: F.struct(*(F.col(n) for n in names))
    schema = "i int, xmin double, ymin double, xmax double, ymax double"
    f = spark.createDataFrame([(i, *b) for i, b in enumerate(features)], schema)
    w = spark.createDataFrame([(i, *b) for i, b in enumerate(windows)], schema)
    sides = ("xmin", "ymin", "xmax", "ymax")
    met = spatial.overlap_join(
        f.select(F.col("i").alias("fi"), box(*sides).alias("bbox")),
        w.select(F.col("i").alias("wi"), box(*sides).alias("window_bbox")),
        salt_by=["fi"],
        hot_rows=hot_rows,
    )
    want = sorted(
        (i, j)
        for i, a in enumerate(features)
        for j, b in enumerate(windows)
        if a[0] < b[2] and a[2] > b[0] and a[1] < b[3] and a[3] > b[1]
    )
    assert sorted((r["fi"], r["wi"]) for r in met.collect()) == want


def test_boxes_of_all_sizes_have_few_cells(spark):
    """City blocks, countries and the whole world: four cells at most on a level, and a coarse cell holds visitors only where it must."""
    x, y = ((F.col("id") * 7919) % 35_999) / 100 - 180, ((F.col("id") * 104_729) % 17_999) / 100 - 90
    wide = F.when(F.col("id") == 0, 360.0).when(F.col("id") % 100 == 0, 25.0).otherwise(0.0007)
    rows = spark.range(5000).select(
        F.col("id").alias("fi"),
        F.when(F.col("id") == 0, F.struct(F.lit(-180.0).alias("xmin"), F.lit(-90.0).alias("ymin"), F.lit(180.0).alias("xmax"), F.lit(90.0).alias("ymax")))
        .otherwise(F.struct(x.alias("xmin"), y.alias("ymin"), (x + wide).alias("xmax"), (y + wide / 2).alias("ymax"))).alias("bbox"),
    )
    complete = spatial._complete(rows, "bbox")
    levels = sorted(r[0] for r in complete.select("_home").distinct().collect())
    assert levels[0] <= 1 and levels[-1] >= 18
    placed = spatial._layered(complete, "bbox", {h: [2 * n for n in levels if n <= h] for h in levels})
    assert placed.groupBy("fi", "_layer").count().agg(F.max("count")).first()[0] <= 4
    windows = rows.select(F.col("fi").alias("wi"), F.col("bbox").alias("window_bbox"))
    met = spatial.overlap_join(rows, windows, salt_by=["fi"])
    plain = rows.crossJoin(windows).where(
        "bbox.xmin < window_bbox.xmax AND bbox.xmax > window_bbox.xmin AND bbox.ymin < window_bbox.ymax AND bbox.ymax > window_bbox.ymin"
    )
    total = F.sum(F.xxhash64("fi", "wi").cast("decimal(38,0)"))
    assert tuple(met.agg(F.count("fi"), total).first()) == tuple(plain.agg(F.count("fi"), total).first())


def test_overlap_join_without_boxes(frame):
    box = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    one = frame([(1, (0.0, 0.0, 1.0, 1.0)), (2, None), (3, (0.0, None, 1.0, 1.0))], f"fi int, bbox {box}")
    none = frame([(1, None)], f"wi int, window_bbox {box}")
    assert spatial.overlap_join(one, none, salt_by=["fi"]).collect() == []
    itself = one.select(F.col("fi").alias("wi"), F.col("bbox").alias("window_bbox"))
    assert [tuple(r) for r in spatial.overlap_join(one, itself, salt_by=["fi"]).select("fi", "wi").collect()] == [(1, 1)]


def test_overlap_join_meets_by_equality(data):
    plan = plan_of(spatial.overlap_join(data.features, data.window_table, salt_by=["id"]))
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


def test_window_and_columns_reach_the_scan(spark, data, tmp_path):
    path = str(tmp_path / "features")
    data.features.withColumn("type", F.col("status")).write.partitionBy("type").parquet(path)
    paris = Box("paris", -8.0, 38.6, 12.7, 59.0)
    found = spark.read.parquet(path).where(overlaps("bbox", paris) & (F.col("type") == "F")).select("depth")
    plan = plan_of(found)
    assert "LessThan(bbox.xmin,12.7)" in plan
    assert "PartitionFilters: [isnotnull(type" in plan
    scan = plan.split("ReadSchema: ")[1]
    assert "cust" not in scan.split(">")[0]


def test_several_windows_reach_the_scan(spark, data, tmp_path):
    path = str(tmp_path / "features")
    data.features.write.parquet(path)
    scope = spatial.Scope(False, (Box("a", 0.0, 0.0, 5.0, 5.0), Box("b", 9.0, 9.0, 12.0, 12.0)))
    plan = plan_of(spatial.sample(spark.read.parquet(path), scope).select("window", "depth"))
    assert "Or(And(And(And(LessThan(bbox.xmin,5.0)" in plan


def test_survey_never_drops_a_small_column(frame):
    for n in (1, 39, 40):
        df = frame([(f"v{i % n}", float(i % n)) for i in range(400)], "t string, d double")
        assert profile.survey(df, ["t", "d"], 40).few == ["t", "d"]
    many = frame([(i, None) for i in range(400)], "t int, e string")
    seen = profile.survey(many, ["t", "e"], 40)
    assert abs(seen.sketched["t"] - 400) < 60 and seen.sketched["e"] <= 1
    assert (seen.rows, seen.few) == (400, ["e"])


def test_top_values_are_cut_before_the_shuffle(data):
    totals = profile.total_counts(
        profile.value_counts(data.features.withColumn("window", F.lit("all")), {"cust": "text"})
    )
    assert "WindowGroupLimit" in plan_of(profile.top_values(totals, 10))
