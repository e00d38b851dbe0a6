"""Documents, the graph, releases, gates, footers and sinks."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partlens.operators import graph, manifest, quality, release
from partlens.functions.boxes import Box
from partlens.functions.text import pairs_to_map
from partlens.operators.spatial import Scope
from partlens.sources import documents, features, footers, sinks


def put(root, path, content):
    full = root / path
    full.parent.mkdir(parents=True, exist_ok=True)
    full.write_text(content if isinstance(content, str) else json.dumps(content))


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "catalog"
    link = lambda rel, href, **kw: {"rel": rel, "href": href, **kw}
    put(root, "catalog.json", {"type": "Catalog", "id": "root", "links": [link("child", "./t/catalog.json", latest=True), link("child", "./u/catalog.json")]})
    put(root, "t/catalog.json", {"type": "Catalog", "id": "t", "links": [link("child", "./c/collection.json"), link("root", "../catalog.json")]})
    put(root, "t/c/collection.json", {
        "type": "Collection", "id": "c",
        "links": [link("item", "./items/1.json"), link("item", "./items/2.json"), link("via", "https://x.org/")],
        "assets": {"thumbnail": {"href": "./thumbnail.png", "roles": ["thumbnail"]}, "data": {"href": "./part.PARQUET"}},
    })
    put(root, "t/c/items/1.json", {"type": "Feature", "id": "1", "links": [link("root", "../../../catalog.json"), link("loop", "../collection.json")], "assets": {"data": {"href": "https://d.org/1.parquet"}}})
    put(root, "t/c/items/broken.json", "{not json")
    put(root, "t/c/styles/default.json", {"type": "Catalog"})
    put(root, ".hidden/catalog.json", {"type": "Catalog"})
    put(root, "t/quiet.style.json", {"type": "Catalog"})
    put(root, "t/other.json", {"type": "Style"})
    put(root, "t/list.json", [1, 2])
    put(root, "t/with space+plus.json", {"type": "Style"})
    return str(root)


def test_documents_are_read_and_sorted_out(spark, tree):
    docs = documents.read_documents(spark, tree)
    assert docs.where("path = 't/with space+plus.json'").count() == 1
    assert documents.read_documents(spark, f"file://{tree}/").where("path = 'catalog.json'").count() == 1
    nodes = documents.nodes(docs)
    assert sorted(r["path"] for r in nodes.collect()) == ["catalog.json", "t/c/collection.json", "t/c/items/1.json", "t/catalog.json"]
    assert [r["path"] for r in documents.malformed(docs).collect()] == ["t/c/items/broken.json"]
    links = documents.links(nodes)
    assert [r["href"] for r in graph.latest_child(links).collect()] == ["./t/catalog.json"]
    assets = documents.assets(nodes)
    assert {(r["path"], r["key"]) for r in assets.collect()} == {
        ("t/c/collection.json", "thumbnail"), ("t/c/collection.json", "data"), ("t/c/items/1.json", "data"),
    }
    assert [r["href"] for r in graph.remote_citations(assets).collect()] == ["https://d.org/1.parquet"]


def test_links_of_a_tree(spark, tree):
    nodes = documents.nodes(documents.read_documents(spark, tree))
    links, assets = documents.links(nodes).select("path", "rel", "href"), documents.assets(nodes).select("path", "key", "href")
    broken = graph.broken_links(graph.checked_links(links), nodes)
    assert sorted(r["href"] for r in broken.collect()) == ["./items/2.json", "./u/catalog.json"]
    full = graph.checked_links(assets, is_asset=True)
    light = graph.checked_links(assets, is_asset=True, light=True)
    assert sorted(r["href"] for r in graph.broken_links(full, nodes).collect()) == ["./part.PARQUET", "./thumbnail.png"]
    assert [r["href"] for r in graph.broken_links(light, nodes).collect()] == ["./thumbnail.png"]
    report = {r["what"]: r["n"] for r in graph.link_report(light, graph.broken_links(light, nodes), nodes).collect()}
    assert report == {"documents": 4, "checked": 1, "skipped": 1, "broken": 1}


def test_walk_ends_on_a_loop_and_goes_to_any_depth(frame):
    links = frame([("a.json", "child", "./b.json"), ("b.json", "child", "./a.json"), ("b.json", "item", "./c.json"), ("c.json", "via", "./d.json")],
                  "path string, rel string, href string")
    found = graph.walk(links, "a.json")
    assert {(r["path"], r["depth"]) for r in found.collect()} == {("a.json", 0), ("b.json", 1), ("c.json", 2)}
    assert graph.walk(links.limit(0), "a.json").collect() == [("a.json", 0)]


def test_a_long_chain_is_walked_in_few_rounds(spark, monkeypatch):
    number = F.col("id").cast("string")
    chain = spark.range(10_000).select(
        F.concat(number, F.lit(".json")).alias("path"), F.lit("child").alias("rel"), F.concat(F.lit("./"), (F.col("id") + 1).cast("string"), F.lit(".json")).alias("href")
    )
    rounds = []
    inner = graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df, name, seen=None: rounds.append(name) or inner(df, name, seen))
    found = graph.walk(chain, "0.json")
    assert found.agg(F.count("path"), F.max("depth"), F.sum("depth")).first() == (10_001, 10_000, 50_005_000)
    assert rounds.count("pointers") < 20 and len(rounds) < 24


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=22), st.integers(0, 9))
def test_walk_equals_a_plain_walk(spark, pairs, root):
    rows = [(f"{a}.json", "child" if (a + b) % 2 else "item", f"./{b}.json") for a, b in pairs]
    links = spark.createDataFrame([*rows, ("0.json", "item", None), (None, "item", "./1.json")], "path string, rel string, href string")
    depth, todo = {root: 0}, [root]
    for at in todo:
        for b in sorted(b for a, b in pairs if a == at):
            if b not in depth:
                depth[b] = depth[at] + 1
                todo.append(b)
    found = [(r.path, r.depth) for r in graph.walk(links, f"{root}.json").collect()]
    assert sorted(found) == sorted((f"{n}.json", d) for n, d in depth.items())


def test_subset_needs_its_child_links(frame):
    nodes = frame([("catalog.json",), ("t/catalog.json",), ("t/c/collection.json",), ("t/cc/collection.json",), ("u/catalog.json",)], "path string")
    links = frame([("catalog.json", "child", "./t/catalog.json"), ("t/catalog.json", "child", "./c/collection.json")], "path string, rel string, href string")
    assert sorted(r.path for r in graph.subset(nodes, links, "t", "c").collect()) == ["catalog.json", "t/c/collection.json", "t/catalog.json"]
    with pytest.raises(ValueError, match="no child link './cc/collection.json'"):
        graph.subset(nodes, links, "t", "cc")


def test_a_query_stays_part_of_the_target(frame):
    links = frame([("a.json", "x", "./b.json?v=1"), ("a.json", "x", "./b.json#top"), ("a.json", "x", "#top"), ("a.json", "x", "mailto:x"), ("a.json", "x", "")],
                  "path string, rel string, href string")
    paths = frame([("a.json",), ("b.json",)], "path string")
    assert graph.broken_links(graph.checked_links(links), paths).count() == 2


TABLE = "collection string, items bigint, license string, geoparquet array<string>, max_row_group_rows bigint, row_group_cap bigint"


def diff(frame, old, new, old_columns=(), new_columns=()):
    column = "collection string, column string"
    found = release.compare(frame(old, TABLE), frame(new, TABLE), frame(list(old_columns), column), frame(list(new_columns), column))
    return sorted((r["collection"], r["rule"], r["subject"], r["was"], r["now"], r["blocking"]) for r in found.collect())


def test_an_unchanged_release_is_quiet(frame):
    same = [("a", 2, None, ["1.1.0", "1.0.0"], 150_000, None)]
    turned = [("a", 2, None, ["1.0.0", "1.1.0"], 150_000, 0)]
    assert diff(frame, same, turned, [("a", "x"), ("a", "y")], [("a", "y"), ("a", "x"), ("a", "x")]) == []


def test_repeats_in_a_version_list_count(frame):
    a, b = [("a", 1, "l", ["1", "1"], 1, 10)], [("a", 1, "l", ["1"], 1, 10)]
    assert diff(frame, a, b) == [("a", "format version changed", None, "1, 1", "1", True)]
    assert diff(frame, [("a", 1, "l", None, 1, 10)], [("a", 1, "l", [], 1, 10)]) == []


def test_a_licence_that_goes_missing_is_a_change(frame):
    assert diff(frame, [("a", 1, "l", [], 1, 10)], [("a", 1, None, [], 1, 10)]) == [("a", "licence changed", None, "l", None, True)]


def test_cap_is_strict_and_reads_new_collections(frame):
    new = [("a", 1, "l", [], 150_000, 0), ("b", 1, "l", [], 150_001, None), ("c", 1, "l", [], 11, 10)]
    got = diff(frame, [("a", 1, "l", [], 1, 10)], new)
    assert [g[:2] for g in got if g[1] == "row group above cap"] == [("b", "row group above cap"), ("c", "row group above cap")]


def test_columns_of_a_vanished_collection_are_not_listed(frame):
    got = diff(frame, [("a", 1, "l", [], 1, 10), ("b", 1, "l", [], 1, 10)], [("a", 3, "l", [], 1, 10)], [("a", "x"), ("b", "y")], [("a", "z")])
    assert got == [
        ("a", "column appeared", "z", None, None, True),
        ("a", "column disappeared", "x", None, None, True),
        ("a", "part count moved", None, "1", "3", False),
        ("b", "collection disappeared", None, None, None, True),
    ]


def test_a_collection_keeps_every_column_moved_to_none(frame):
    same = [("a", 1, "l", [], 1, 10)]
    assert diff(frame, same, same, [("a", "x")], []) == [("a", "column disappeared", "x", None, None, True)]


def finding(frame, rows):
    return frame(rows, "severity string, rule_id string, path string, message string")


def test_exact_gate(frame):
    wanted = frame([("A",), ("B",)], "rule_id string")
    clean = finding(frame, [("error", "A", "p", "host 'h'"), ("error", "B", "p", "host 'h'"), ("info", "C", "p", "x")])
    assert quality.expected_exactly(clean, wanted, "h").count() == 0
    fewer = finding(frame, [("error", "A", "p", "host 'h'")])
    assert [(r.rule_id, r.fails) for r in quality.expected_exactly(fewer, wanted, "h").collect()] == [("B", True)]
    moved = finding(frame, [("error", "A", "p", "host 'h'"), ("error", "C", "p", "host 'other'")])
    got = {(r.rule_id, r.problem, r.fails) for r in quality.expected_exactly(moved, wanted, "h").collect()}
    assert got == {("B", "no longer reported", False), ("C", "unexpected rule", True), ("C", "names another host: host 'other'", True)}


def test_exemption_expires(frame):
    schema = "path string, valid boolean, message string, reachable boolean"
    pattern = r"schema/v\d+\.json"
    live = frame([("a", False, "crash at schema/v1.json", True), ("b", False, "crash elsewhere", False), ("c", True, None, True)], schema)
    row = quality.exemption_report(live, "crash", pattern).first()
    assert (row.checked, row.reachable, row.exempt, row.errors, row.expired, row.ok) == (3, 2, 1, 1, False, False)
    fixed = frame([("a", True, None, True)], schema)
    row = quality.exemption_report(fixed, "crash", pattern).first()
    assert (row.expired, row.ok) == (True, False)
    assert [r.outcome for r in quality.exemption(live, "crash", pattern).orderBy("path").collect()] == ["exempt", "error"]


def test_blob_bounds(frame):
    pairs = frame([("x" * 20, "x" * 20), ("y" * 115, "x" * 100), ("y" * 114, "x" * 100), ("", "")], "p string, b string")
    assert [r.verdict for r in quality.blob_verdict(pairs, "p", "b").collect()] == ["FAIL-empty", "PASS", "WARN-sparse", "FAIL-empty"]


def test_latest_release_is_numeric_and_installable(frame):
    rows = [("p", "0.9.0", False), ("p", "0.10.0", False), ("p", "0.11.0", True), ("p", "1.0.0rc1", False), ("q", "0.1.7", False), ("q", "0.1.7", True)]
    got = quality.latest_release(frame(rows, "package string, version string, yanked boolean"), (0, 1, 7)).collect()
    assert {(r.package, r.version, r.due) for r in got} == {("p", "0.10.0", True), ("q", "0.1.7", False)}


def test_liveness_bounds(frame):
    cited = frame([(u, p) for u in ("u1", "u2", "u3", "u4") for p in ("b", "a")], "href string, path string")
    status = frame([("u1", 200), ("u2", 299), ("u3", 300)], "href string, status int")
    got = {(r.href, r.example, r.reason) for r in quality.liveness(cited, status).collect()}
    assert got == {("u3", "a", "HTTP 300"), ("u4", "a", "no answer")}


def test_spatial_order(frame):
    groups = frame(
        [("f", 0, 0.0, 0.0, 1.0, 1.0), ("f", 1, 0.5, 0.0, 1.5, 1.0), ("g", 0, 0.0, 0.0, 1.0, 1.0), ("g", 1, 2.0, 0.0, 3.0, 1.0),
         ("p", 0, 1.0, 1.0, 1.0, 1.0), ("p", 1, 1.0, 1.0, 1.0, 1.0)],
        "path string, row_group int, xmin double, ymin double, xmax double, ymax double",
    )
    got = {r.path: (r.overlap, r.ordered) for r in quality.spatial_order(groups, 0.5).collect()}
    assert got == {"f": (0.5, True), "g": (0.0, True), "p": (1.0, False)}


def test_neighbours_meet_without_a_broadcast(spark):
    groups = spark.range(3).selectExpr("'f' AS path", "CAST(id AS INT) AS row_group", "0D AS xmin", "0D AS ymin", "1D AS xmax", "1D AS ymax")
    measured = quality.spatial_order(groups)
    plan = measured._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [(r.pairs, r.overlap, r.ordered) for r in measured.collect()] == [(2, 1.0, False)]


def test_parts_per_collection_reports_the_empty_one(frame):
    nodes = frame([("t/a/collection.json", "Collection"), ("t/b/collection.json", "Collection"), ("t/c/collection.json", "Collection"), ("t/catalog.json", "Catalog")], "path string, type string")
    links = frame([("t/a/collection.json", "item"), ("t/a/collection.json", "item"), ("t/a/collection.json", "root")], "path string, rel string")
    assets = frame([("t/a/collection.json", "data"), ("t/b/collection.json", "data"), ("t/c/collection.json", "visual")], "path string, key string")
    got = {r["collection"]: (r["slug"], r["parts"], r["error"] is None) for r in manifest.parts_per_collection(nodes, links, assets).collect()}
    assert got == {"t/a": ("t-a", 2, True), "t/b": ("t-b", 1, True), "t/c": ("t-c", 0, False)}


def test_unknown_keys_are_an_error(frame):
    known = frame([("t/a",), ("t/b",)], "collection string")
    assert manifest.select_keys(known, []).count() == 2
    with pytest.raises(ValueError, match="t/x"):
        manifest.select_keys(known, ["t/a", "t/x"])


# Parts and rows of the fifteen published tables.
PUBLISHED = {
    "addresses/address": (64, 475239461),
    "base/bathymetry": (1, 407277),
    "base/infrastructure": (16, 160422524),
    "base/land": (64, 77516732),
    "base/land_cover": (128, 123302114),
    "base/land_use": (32, 56848786),
    "base/water": (32, 67137224),
    "buildings/building": (512, 2544125628),
    "buildings/building_part": (1, 4669725),
    "divisions/division": (1, 4714501),
    "divisions/division_area": (8, 1087919),
    "divisions/division_boundary": (1, 87523),
    "places/place": (16, 90295748),
    "transportation/connector": (32, 425897510),
    "transportation/segment": (128, 354631439),
}


def test_published_totals(frame):
    tables = frame([(k, p, r) for k, (p, r) in PUBLISHED.items()], "collection string, parts bigint, rows bigint")
    total = {r["theme"]: r for r in manifest.theme_rollup(tables).collect()}
    assert (total[None]["collections"], total[None]["parts"], total[None]["rows"]) == (15, 1036, 4386384111)
    assert total["base"]["collections"] == 6
    order = [r["collection"] for r in manifest.longest_first(tables).collect()]
    assert order[:4] == ["buildings/building", "base/land_cover", "transportation/segment", "addresses/address"]


GEO = {"version": "1.1.0", "primary_column": "geometry",
       "columns": {"geometry": {"encoding": "WKB", "geometry_types": ["Polygon", "MultiPolygon"], "covering": {"bbox": {"xmin": ["bbox", "xmin"]}}}}}


def geo_part(path, rows, group, geo=True, stats=True, start=0.0):
    box = [{"xmin": start + i, "ymin": 0.0, "xmax": start + i + 1, "ymax": 1.0} for i in range(rows)]
    table = pa.table({"id": [str(i) for i in range(rows)], "geometry": [b"\x01"] * rows, "bbox": box})
    if geo:
        table = table.replace_schema_metadata({"geo": json.dumps(GEO)})
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(table, path, row_group_size=group, write_statistics=stats)


def test_footers(spark, tmp_path):
    geo_part(f"{tmp_path}/t/type=a b/part-0.parquet", 10, 4)
    geo_part(f"{tmp_path}/t/type=a/part-1.parquet", 3, 3, geo=False, stats=False)
    read = footers.list_parts(spark, f"{tmp_path}/t")
    facts = {r["path"].rsplit("-", 1)[1][0]: r for r in footers.part_facts(read, 2).collect()}
    assert (facts["0"]["rows"], facts["0"]["row_groups"], facts["0"]["max_row_group_rows"]) == (10, 3, 4)
    assert (facts["0"]["geoparquet_version"], facts["0"]["geometry_column"], facts["0"]["geometry_encoding"]) == ("1.1.0", "geometry", "WKB")
    assert (facts["0"]["has_covering_bbox"], facts["0"]["geometry_types"]) == (True, ["MultiPolygon", "Polygon"])
    assert (facts["1"]["geoparquet_version"], facts["1"]["has_covering_bbox"], facts["1"]["geometry_types"]) == (None, False, [])
    groups = footers.row_groups(read, 2)
    found = quality.footer_findings(groups, footers.part_facts(read, 2), 3)
    assert sorted((r["path"].rsplit("-", 1)[1][0], r["rule"], r["n"]) for r in found.collect()) == [
        ("0", "row group above cap", 4), ("1", "row group without statistics", 1), ("1", "unknown format version", 0),
    ]
    boxes = quality.bbox_groups(groups).where(F.col("path").contains("part-0")).orderBy("row_group").collect()
    assert [(r.xmin, r.xmax) for r in boxes] == [(0.0, 4.0), (4.0, 8.0), (8.0, 10.0)]


def test_row_groups_without_statistics_are_unknown(frame):
    schema = "path string, row_group int, xmin double, ymin double, xmax double, ymax double"
    side = lambda path, n, x: (path, n, x, 0.0, None if x is None else x + 1.0, 1.0)
    rows = [side("none", 0, None), side("none", 1, None), side("one", 0, 5.0)]
    rows += [side("apart", n, 2.0 * n) for n in range(3)] + [side("same", n, None if n == 2 else 0.0) for n in range(3)]
    found = {r.path: (r.pairs, r.unknown, r.overlap, r.ordered) for r in quality.spatial_order(frame(rows, schema)).collect()}
    assert found == {"none": (1, 1, None, None), "one": (0, 0, None, True), "apart": (2, 0, 0.0, True), "same": (2, 1, 1.0, False)}


def test_pairs_want_a_colon_and_take_the_last_of_a_key(frame):
    made = frame([("a:1 b:2:3  a:4",), ("",), (None,)], "t string").select(pairs_to_map(F.col("t")).alias("m")).collect()
    assert [r.m for r in made] == [{"a": "4", "b": "2:3"}, {}, None]
    with pytest.raises(Exception, match="no colon in the pair plain"):
        frame([("plain b:2",)], "t string").select(pairs_to_map(F.col("t"))).collect()


def test_a_collection_without_parts_keeps_its_fingerprint(frame):
    parts = frame([("a", "1.1.0", 5)], "collection string, geoparquet_version string, max_row_group_rows bigint")
    known = frame([("a", "L"), ("b", "L")], "collection string, license string").withColumn("columns", F.array())
    assert {r.collection: (r["items"], r.geoparquet) for r in manifest.fingerprint(known, parts, "r").collect()} == {"a": (1, ["1.1.0"]), "b": (0, [])}


def test_only_the_parts_of_a_window_are_opened(spark, frame, tmp_path):
    base = f"{tmp_path}/t"
    geo_part(f"{base}/theme=x/type=a/part-0.parquet", 5, 5)
    geo_part(f"{base}/theme=x/type=a/part-1.parquet", 5, 5, start=100.0)
    box = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    listed = frame([(f"{base}/theme=x/type=a/part-0.parquet", (0.0, 0.0, 5.0, 1.0)), (f"{base}/theme=x/type=a/part-1.parquet", (100.0, 0.0, 105.0, 1.0))],
                   f"href string, bbox {box}")
    found = features.scan_windows(spark, base, listed, [Box("w", 101.0, 0.0, 102.0, 1.0)])
    assert [f.rsplit("-", 1)[1] for f in found.inputFiles()] == ["1.parquet"]
    assert [(r["id"], r["theme"], r["type"]) for r in found.collect()] == [("1", "x", "a")]
    assert features.scan_windows(spark, base, listed, [Box("w", 50.0, 0.0, 60.0, 1.0)]).count() == 0
    assert features.scan_scope(spark, base, listed, Scope(True, ())).count() == 10
    assert features.scan_scope(spark, base, listed, Scope(False, ())).count() == 0


def test_json_is_the_same_on_every_run(spark, frame, tmp_path):
    rows = [(f"k{i}", i, None if i % 2 else "x") for i in range(50)]
    schema = "key string, n int, note string"
    texts = []
    for run, order in enumerate((rows, rows[::-1])):
        path = str(tmp_path / f"run{run}")
        docs = frame(order, schema).repartition(3 + run).withColumn("doc", F.struct("key", "n", "note"))
        sinks.write_json(docs, "doc", "key", path, 4)
        parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
        texts.append([open(os.path.join(path, p)).read() for p in parts])
    assert texts[0] == texts[1]
    assert sum(t.count("\n") for t in texts[0]) == 50


def test_declared_schemas(frame):
    rows = [(["https://x/v1.json#"],), (["https://x/v1.json.bak", "https://y/"],), ([],), (None,)]
    df = frame(rows, "schemas array<string>")
    got = df.select(quality.declares(F.col("schemas"), r"https://x/v\d+\.json").alias("d")).collect()
    assert [r.d for r in got] == [True, False, False, False]


def test_delta_report(frame):
    deltas = frame([("t/b", 3, 1, -2), ("t/a", 1, 2, 1)], "collection string, was bigint, now bigint, delta bigint")
    lines = [r.line for r in sinks.delta_report(deltas, "r1", "r2").orderBy("section", "line_key").collect()]
    assert lines[0] == "Release `r1` becomes `r2`."
    assert lines[-2:] == ["| `t/a` | 1 | 2 | +1 |", "| `t/b` | 3 | 1 | -2 |"]
    none = sinks.delta_report(deltas.where("delta > 9"), "r1", "r2")
    assert none.orderBy("section", "line_key").collect()[-1].line == "No part count moved."


def test_report_without_findings(frame, spark, tmp_path):
    noted = sinks.report_lines(finding(frame, []), "t/c", note="Read in 3 seconds.")
    assert [r.line for r in noted.orderBy("section", "line_key").collect()][2] == "Read in 3 seconds."
    lines = sinks.report_lines(finding(frame, []), "t/c")
    assert [r.line for r in lines.orderBy("section", "line_key").collect()] == ["### `t/c`", "", "No error-severity finding."]
    path = str(tmp_path / "report")
    sinks.write_lines(sinks.report_lines(finding(frame, [("error", "R", "p", "a | b")]), "t/c"), path)
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    text = "".join(open(os.path.join(path, p)).read() for p in parts)
    assert text == "### `t/c`\n\n| Rule | Path | Message |\n|---|---|---|\n| `R` | `p` | a \\| b |\n"


def test_a_line_repeated_often_is_written_in_full(frame, spark, tmp_path):
    path = str(tmp_path / "report")
    lines = frame([(1, "a", "x")] * 2501 + [(0, "b", "head"), (2, "c", "tail")] , "section int, line_key string, line string")
    sinks.write_lines(lines, path)
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    text = "".join(open(os.path.join(path, p)).read() for p in parts)
    assert text == "head\n" + "x\n" * 2501 + "tail\n"


def test_refresh_leaves_other_partitions(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.refresh(frame([("a", 1), ("b", 1)], "type string, n int"), path, ["type"])
    sinks.refresh(frame([("a", 2)], "type string, n int"), path, ["type"])
    assert {(r.type, r.n) for r in spark.read.parquet(path).collect()} == {("a", 2), ("b", 1)}
