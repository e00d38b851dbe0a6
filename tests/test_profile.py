"""Thresholds and stages of the profile, at and beside their bounds."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partlens.functions.boxes import Box, corner_within, overlaps
from partlens.operators import profile, spatial

WHOLE = spatial.Scope(True, ())
A, B, C = Box("a", 0.0, 0.0, 10.0, 10.0), Box("b", 20.0, 20.0, 30.0, 30.0), Box("c", 40.0, 40.0, 50.0, 50.0)


def boxed(frame, rows):
    flat = frame(rows, "id int, xmin double, ymin double, xmax double, ymax double")
    return flat.select("id", F.struct("xmin", "ymin", "xmax", "ymax").alias("bbox"))


def test_overlap_is_strict_and_the_corner_test_is_not(frame):
    rows = [(1, 10.0, 0.0, 12.0, 5.0), (2, 9.9, 0.0, 12.0, 5.0), (3, -5.0, -5.0, 0.0, 5.0), (4, 179.0, 1.0, -179.0, 2.0)]
    df = boxed(frame, rows)
    assert [r.id for r in df.where(overlaps("bbox", A)).collect()] == [2]
    assert [r.id for r in df.where(corner_within("bbox", A)).collect()] == [1, 2]


def test_a_part_without_a_box_is_kept(frame):
    parts = boxed(frame, [(1, 1.0, 1.0, 2.0, 2.0), (2, 60.0, 60.0, 61.0, 61.0)]).unionByName(
        frame([(3, None)], "id int, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    )
    assert sorted(r.id for r in spatial.prune_parts(parts, [A]).collect()) == [1, 3]


def test_a_row_in_two_windows_counts_in_both(frame):
    df = boxed(frame, [(1, 5.0, 5.0, 25.0, 25.0)])
    assert spatial.sample(df, spatial.Scope(False, (A, B))).count() == 2


def test_the_caller_says_what_is_read(frame):
    parts = frame([("t", 60, (1.0, 1.0, 2.0, 2.0)), ("t", 40, (21.0, 21.0, 22.0, 22.0))],
                  "collection string, rows bigint, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    assert spatial.plan_scope(parts).exhaustive
    windowed = spatial.plan_scope(parts, [A, B, C])
    # No part meets c, so c is no scope and does not count in the recurrence.
    assert windowed.names == ["a", "b"]
    with pytest.raises(ValueError, match="no part meets"):
        spatial.plan_scope(parts, [C])
    scopes = {r.scope: (r.parts, r.rows) for r in spatial.scan_scopes(parts, [A, B, C]).collect()}
    assert scopes == {"a": (1, 100), "b": (1, 100), "c": (0, 100)}


def counts(frame, rows):
    return frame([(w, c, "text", v, None, 1) for w, c, v in rows],
                 "window string, column string, kind string, text string, number double, n bigint")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sets(st.sampled_from("abcdefg")), min_size=1, max_size=6))
def test_recurrence_equals_a_plain_count(spark, sets):
    rows = [(f"w{i}", "c", "text", v, None, 1) for i, s in enumerate(sets) for v in s]
    schema = "window string, column string, kind string, text string, number double, n bigint"
    got = profile.recurrence(spark.createDataFrame(rows, schema), len(sets)).first()
    values = set().union(*sets)
    half = len(sets) / 2
    want = len(sets[0]) if len(sets) == 1 else sum(sum(v in s for s in sets) >= half for v in values)
    assert (got.recurring if got else 0) == want


def verdicts(frame, sizes):
    rows = [("all", c, f"v{i}") for c, n in sizes.items() for i in range(n)]
    found = profile.screen(counts(frame, rows), dict.fromkeys(sizes, "text"), 1).collect()
    return {r["column"]: (r["verdict"], r["rank"]) for r in found}


def test_screen_bounds_and_rank(frame):
    got = verdicts(frame, {"two": 2, "three": 3, "ten": 10, "eleven": 11, "forty": 40, "more": 41, "none": 0, "again": 10})
    assert got == {
        "two": ("too few values", None),
        "three": ("candidate", 3),
        "ten": ("candidate", 1),
        "again": ("candidate", 2),
        "eleven": ("candidate", 4),
        "forty": ("candidate", 5),
        "more": ("too many values", None),
        "none": ("no comparable value", None),
    }


def test_numeric_screen_wants_three_to_ten(frame):
    rows = [("all", c, "numeric", None, float(i), 1) for c, n in {"d2": 2, "d3": 3, "d10": 10, "d11": 11}.items() for i in range(n)]
    df = frame(rows, "window string, column string, kind string, text string, number double, n bigint")
    found = profile.screen(df, dict.fromkeys(["d2", "d3", "d10", "d11"], "numeric"), 1).collect()
    assert {r["column"]: r["verdict"] for r in found} == {
        "d2": "no step break", "d3": "candidate", "d10": "candidate", "d11": "no step break",
    }


def test_location_columns_are_rejected(frame):
    rows = [(f"w{w}", "country", f"land{w}") for w in range(7)] + [(f"w{w}", "kind", f"k{k}") for w in range(4) for k in range(3)]
    found = profile.screen(counts(frame, rows), {"country": "text", "kind": "text"}, 7).collect()
    assert {r["column"]: r["verdict"] for r in found} == {"country": "tracks location", "kind": "candidate"}


def measured(frame, rows):
    """(column, kind, rank, dominance, coverage, populated) rows through the verdicts."""
    screened = frame([(c, k, i, 5, 5, "candidate", r) for i, (c, k, r, *_) in enumerate(rows)],
                     "column string, kind string, ordinal int, distinct_seen bigint, recurring bigint, verdict string, rank int")
    values = frame([(c, k, 100, d, v, v * (1 - d), p) for c, k, _, d, v, p in rows],
                   "column string, kind string, total bigint, dominance double, coverage double, score double, populated double")
    return profile.measure(screened, values)


def chosen(frame, rows, preferred=None):
    found = profile.choose(measured(frame, rows), preferred).orderBy("place").collect()
    return [(r["column"], r["stage"]) for r in found]


def test_a_threshold_itself_passes(frame):
    rows = [("a", "text", 1, 0.90, 0.80, 0.50), ("b", "text", 2, 0.9001, 0.9, 1.0), ("c", "text", 3, 0.5, 0.7999, 1.0)]
    found = {r["column"]: (r["strict_ok"], r["relaxed_ok"], r["reason"]) for r in measured(frame, rows).collect()}
    assert found == {
        "a": (True, True, None),
        "b": (False, True, "one value dominates"),
        "c": (False, True, "top values cover too little"),
    }


def test_every_candidate_is_measured(frame):
    rows = [(c, "text", i, 0.5, 1.0, 1.0) for i, c in enumerate("abcdefgh", 1)]
    assert {r["column"] for r in measured(frame, rows).collect()} == set("abcdefgh")


def test_every_value_of_the_legend_is_kept(frame):
    rows = [(i, f"k{i % 25:02}") for i in range(500)]
    legend = profile.build_legend(profile.profile(frame(rows, "id int, kind string"), WHOLE), WHOLE, polygons=True)
    assert legend.values == [f"k{i:02}" for i in range(25)]


def test_long_integers_stay_apart(frame):
    rows = [("all", 2**53 + i % 30) for i in range(90)]
    counts = profile.value_counts(frame(rows, "window string, n long"), {"n": "numeric"}).collect()
    assert len(counts) == 30 and {r.n for r in counts} == {3}
    small = profile.value_counts(frame([("all", 2**53), ("all", -5)], "window string, n long"), {"n": "numeric"}).collect()
    assert {r.text for r in small} == {None}


def test_stages_follow_one_another(frame):
    strict, dominant, sparse = (0.5, 1.0, 1.0), (0.95, 1.0, 1.0), (0.5, 1.0, 0.4)
    assert chosen(frame, [("t", "text", 1, *strict), ("n", "numeric", 1, *strict)]) == [("t", 1)]
    assert chosen(frame, [("t", "text", 1, *dominant), ("n", "numeric", 1, *strict), ("m", "numeric", 2, *strict)]) == [("n", 2)]
    assert chosen(frame, [("t", "text", 1, *dominant), ("n", "numeric", 1, *dominant)]) == [("t", 3)]
    assert chosen(frame, [("t", "text", 1, *sparse), ("n", "numeric", 1, *dominant)]) == [("n", 4)]
    assert chosen(frame, [("t", "text", 1, *sparse), ("n", "numeric", 1, *sparse)]) == []


def test_numeric_takes_the_first_column_not_the_best(frame):
    rows = [("worse", "numeric", 1, 0.89, 0.1, 1.0), ("better", "numeric", 2, 0.2, 1.0, 1.0)]
    assert chosen(frame, rows) == [("worse", 2)]


def test_preferred_leads_the_strict_list_only(frame):
    strict = [("a", "text", 1, 0.1, 1.0, 1.0), ("b", "text", 2, 0.5, 1.0, 1.0)]
    assert chosen(frame, strict) == [("a", 1), ("b", 1)]
    assert chosen(frame, strict, "b") == [("b", 1), ("a", 1)]
    loose = [("a", "text", 1, 0.92, 1.0, 1.0), ("b", "text", 2, 0.95, 1.0, 1.0)]
    assert chosen(frame, loose, "b") == [("a", 3), ("b", 3)]


def table(frame, n=200):
    rows = [(i, f"k{i % 4}", float(i % 5), f"id{i}", i % 2 == 0) for i in range(n)]
    return frame(rows, "id int, kind string, band double, code string, flag boolean")


def test_profile_of_a_whole_table(frame, spark):
    legend = profile.build_legend(profile.profile(table(frame), WHOLE), WHOLE, polygons=False)
    assert (legend.column, legend.expression, legend.exhaustive, legend.legend) == ("kind", "match", True, False)
    assert legend.values == ["k0", "k1", "k2", "k3"]
    numeric = profile.profile(table(frame).drop("kind"), WHOLE)
    legend = profile.build_legend(numeric, WHOLE, polygons=True)
    assert (legend.column, legend.expression, legend.values) == ("band", "step", [0.0, 1.0, 2.0, 3.0, 4.0])
    assert [r["values"] for r in profile.legend_row(spark, legend).collect()] == [["0", "1", "2", "3", "4"]]


def test_a_table_without_a_usable_column_is_flat(frame):
    df = table(frame).select("id", "code", "flag")
    prof = profile.profile(df, WHOLE)
    assert {r["column"]: r["verdict"] for r in prof.screened.collect()} == {
        "code": "too many values", "flag": "no comparable value",
    }
    legend = profile.build_legend(prof, WHOLE, polygons=True)
    assert (legend.column, legend.expression, legend.values, legend.legend) == (None, "flat", [], False)


def test_an_empty_table_is_flat(frame):
    prof = profile.profile(table(frame).where(F.lit(False)), WHOLE)
    assert profile.build_legend(prof, WHOLE, polygons=True).expression == "flat"


def test_relaxed_choice_is_recorded(frame):
    rows = [(i, "x" if i < 96 else f"y{i % 2}") for i in range(100)]
    prof = profile.profile(frame(rows, "id int, kind string"), WHOLE)
    legend = profile.build_legend(prof, WHOLE, polygons=True)
    assert (legend.column, legend.thresholds_relaxed, legend.dominance) == ("kind", True, 0.96)


def test_confirm_reads_the_data_again(frame):
    sampled = frame([("all", "a", 1.0), ("all", "b", 2.0)], "window string, t string, d double")
    asked = frame([("t", "a", None), ("t", "z", None), ("d", None, 2.0), ("d", None, 9.0)], "column string, text string, number double")
    held = profile.confirm(sampled, {"t": "text", "d": "numeric"}, asked).collect()
    assert {(r["column"], r["text"], r["number"]) for r in held} == {("t", "a", None), ("d", None, 2.0)}


def test_ties_go_to_the_smaller_value(frame):
    totals = frame([("c", "text", v, None, 5) for v in "zyxwvutsrqpo"], "column string, kind string, text string, number double, n bigint")
    assert sorted(r["text"] for r in profile.top_values(totals, 10).collect()) == sorted("zyxwvutsrqpo")[:10]


def test_a_value_without_a_colour_is_an_error(frame):
    values = frame([("c", "a", 1), ("c", "b", 2)], "column string, text string, position int")
    colours = frame([("c", "a", "#111111")], "column string, text string, colour string")
    with pytest.raises(Exception, match="no colour for c value b"):
        profile.match_legend(values, colours).collect()


def test_first_step_has_no_lower_edge(frame):
    # The ten published depth bands.
    depths = [0.0, 10.0, 50.0, 100.0, 500.0, 1000.0, 1500.0, 2000.0, 2500.0, 3000.0]
    values = frame([("depth", d) for d in reversed(depths)], "column string, number double")
    steps = profile.step_legend(values, [f"#{i}" for i in range(4)]).orderBy("step").collect()
    assert [r["from_value"] for r in steps] == [None, *depths[1:]]
    assert [r["colour"] for r in steps] == ["#0", "#1", "#2", "#3", "#0", "#1", "#2", "#3", "#0", "#1"]


def test_the_first_usable_numeric_column_is_chosen_beside_text(frame):
    from partlens.plans.profiles import numeric_choice

    # "most" has one value in 29 rows of 30, "few" and "more" are usable, and so is the text column.
    rows = [("abc"[i % 3], max(i - 27, 0) * 10, (i * 7) % 4, (i * 7) % 5) for i in range(90)]
    rows = [(t, m if i < 30 else 0, f, n) for i, (t, m, f, n) in enumerate(rows)]
    prof = profile.profile(frame(rows, "kind_of string, most int, few int, more int"), WHOLE)
    found = numeric_choice(prof).orderBy("column", "step").collect()
    assert [r.column for r in prof.chosen.collect()] == ["kind_of"]
    by_column = {}
    for r in found:
        by_column.setdefault(r.column, []).append(r)
    assert {c: (rs[0].strict_ok, rs[0].relaxed_ok, rs[0].chosen, rs[0].stage) for c, rs in by_column.items()} == {
        "most": (False, True, False, None), "few": (True, True, False, None), "more": (True, True, True, 2),
    }
    assert [(r.step, r.value) for r in by_column["more"]] == [(i + 1, float(i)) for i in range(5)]
    assert sorted(r.position for r in by_column["few"]) == [1, 2, 3, 4]
    # Of equal counts the smaller value comes first.
    assert [(r.value, r.n, r.position) for r in by_column["most"]] == [(0.0, 88, 1), (10.0, 1, 2), (20.0, 1, 3)]
