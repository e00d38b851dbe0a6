"""Reference chains, containers, comments and fences against plain models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partlens.operators import blocks, cycles, meanings

RELAXED = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
FENCE = "`" * 3


def follow(nodes, start):
    at, seen, met = start, {}, set()
    while at in nodes and at not in met:
        met.add(at)
        ref, own = nodes[at]
        seen = {**{k: v for k, v in own.items() if v is not None}, **seen}
        at = ref
    return seen, at in met


def chase(spark, nodes):
    rows = [(n, ref, own.get("d"), own.get("t")) for n, (ref, own) in nodes.items()]
    df = spark.createDataFrame(rows, "node int, ref int, d string, t string")
    got = meanings.resolve_references(df, ["d", "t"]).collect()
    assert len(got) == len(nodes)
    endless = {r["node"] for r in meanings.reference_cycles(df).collect()}
    return {r["node"]: ({k: r[k] for k in ("d", "t") if r[k] is not None}, r["node"] in endless) for r in got}


def test_a_chain_of_any_length_is_followed(spark):
    nodes = {i: (i + 1, {"d": "far"} if i == 499 else {}) for i in range(500)}
    assert set(map(repr, chase(spark, nodes).values())) == {repr(({"d": "far"}, False))}


@RELAXED
@given(
    st.dictionaries(
        st.integers(0, 12),
        st.tuples(st.integers(0, 15), st.dictionaries(st.sampled_from("dt"), st.sampled_from("xyz"))),
        min_size=1,
    )
)
def test_chase_equals_a_plain_walk(spark, nodes):
    # Loops and targets that are no node are part of the draw.
    assert chase(spark, nodes) == {n: follow(nodes, n) for n in nodes}


def test_no_nodes(frame):
    none = frame([], "node int, ref int, d string")
    assert meanings.resolve_references(none, ["d"]).collect() == []


def reached(members):
    """Every node and all it leads to, itself only over a cycle."""
    far = {n: {m for _, m in ms} for n, ms in members.items()}
    while True:
        more = {n: ms | {k for m in ms for k in far.get(m, ())} for n, ms in far.items()}
        if more == far:
            return far
        far = more


def flat(members, properties, node, far):
    """What a node holds; nodes that hold each other give theirs before all others, the largest last."""

    def cycle(n):
        return {m for m in far.get(n, ()) if n in far.get(m, ())}

    def onward(n):
        found = {}
        for _, m in sorted(members.get(n, [])):
            if m not in cycle(n):
                found.update(flat(members, properties, m, far))
        return {**found, **properties.get(n, {})}

    found = {}
    for peer in sorted(cycle(node)):
        found.update(onward(peer))
    return {**found, **onward(node)}


def compare(spark, edges, props):
    members, properties = {}, {}
    for n, o, m in edges:
        members.setdefault(n, []).append((o, m))
    for (n, name), v in props.items():
        properties.setdefault(n, {})[name] = v
    m = spark.createDataFrame(edges, "node int, ordinal int, member int")
    p = spark.createDataFrame([(n, k, v) for (n, k), v in props.items()], "node int, name string, value string")
    got = {}
    for r in meanings.flatten_properties(m, p).collect():
        got.setdefault(r["node"], {})[r["name"]] = r["value"]
    far = reached(members)
    want = {n: flat(members, properties, n, far) for n in members.keys() | properties.keys()}
    assert got == {n: v for n, v in want.items() if v}
    assert {r.node for r in meanings.container_cycles(m).collect()} == {n for n in far if n in far[n]}
    groups = {r.node: r.group for r in cycles.cycle_groups(m, "node", "member").collect()}
    assert groups == {n: min({n} | {k for k in far[n] if n in far.get(k, ())}) for n in far if n in far[n]}


@settings(RELAXED, max_examples=4)
@given(
    st.dictionaries(st.tuples(st.integers(0, 9), st.integers(0, 2)), st.integers(0, 9), max_size=14),
    st.dictionaries(st.tuples(st.integers(0, 11), st.sampled_from("pq")), st.sampled_from("uvw"), min_size=1),
)
def test_containers_equal_a_plain_walk(spark, edges, props):
    compare(spark, [(n, o, m) for (n, o), m in edges.items()], props)


def test_a_container_of_itself_beside_another(spark):
    compare(spark, [(1, 2, 1), (1, 1, 2)], {(1, "p"): "a", (2, "p"): "b", (2, "q"): "c"})


def test_cycles_that_meet_and_follow(spark):
    edges = [(1, 1, 2), (2, 1, 1), (2, 2, 3), (3, 1, 4), (4, 1, 5), (5, 1, 3), (5, 2, 5), (6, 1, 1), (6, 2, 7), (7, 1, 8), (9, 1, 8), (8, 1, 9)]
    compare(spark, edges, {(n, f"p{n % 4}"): f"v{n}" for n in range(1, 10)})


def test_rounds_over_a_graph_broadcast_nothing(frame, monkeypatch):
    """However small a round's tables are, they do not pass through the driver."""
    plans, cut = [], cycles.cut_lineage

    def noted(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, *rest)

    monkeypatch.setattr(cycles, "cut_lineage", noted)
    edges = frame([(1, 2), (2, 1), (2, 3), (3, 4), (4, 5), (5, 3), (5, 5), (6, 1), (7, 7), (8, 9)], "src int, dst int")
    assert sorted(cycles.cycle_groups(edges).collect()) == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 3), (7, 7)]
    assert sum("SortMergeJoin" in p for p in plans) >= 4
    assert not any("Broadcast" in p for p in plans)


def test_many_ways_to_a_container_are_one_value(frame):
    """Fourteen levels with two ways a step: 16,384 ways from top to bottom, one value a node."""
    rows = [(level, ordinal, level + 1) for level in range(14) for ordinal in (1, 2)]
    members = frame(rows, "node int, ordinal int, member int")
    bottom = frame([(14, "p", "v")], "node int, name string, value string")
    assert sorted((r.node, r.value) for r in meanings.flatten_properties(members, bottom).collect()) == [(n, "v") for n in range(15)]
    assert meanings.container_cycles(members).collect() == []


def test_properties_without_containers(frame):
    members = frame([(None, 1, 2), (2, 1, None)], "node int, ordinal int, member int")
    props = frame([(2, "p", None), (2, "q", "b"), (2, "q", "a"), (None, "p", "x")], "node int, name string, value string")
    assert sorted(map(tuple, meanings.flatten_properties(members, props).collect())) == [(2, "p", None), (2, "q", "b")]
    assert meanings.flatten_properties(members, props.limit(0)).collect() == []


def comments(lines):
    """One pass over the lines of a file, remembering the open value."""
    said, value = {}, None
    texts = []

    def close():
        if value is not None and texts:
            said[value] = " ".join(texts).strip()

    for line in lines:
        bare = line.strip()
        if bare.startswith("- ") and bare[2:].split("#")[0].strip().isidentifier():
            close()
            head, _, tail = bare[2:].partition("#")
            value, texts = head.strip(), [tail.removeprefix(" ")] if tail.removeprefix(" ") else []
        elif bare.startswith("#"):
            if value is not None:
                texts.append(bare[1:].removeprefix(" "))
        elif bare:
            close()
            value, texts = None, []
    close()
    return {k: v for k, v in said.items() if v}


LINES = st.lists(
    st.sampled_from(["  - a", "  - b  # one", "- a #two", "# three", "    #  four", "#", "", "   ", "type: x", "- not an item!"]),
    max_size=14,
)


@RELAXED
@given(LINES, st.sampled_from([2, 5, 1000]))
def test_comments_equal_a_plain_pass(spark, lines, block):
    rows = [(1, i, text) for i, text in enumerate(lines, 1)]
    df = spark.createDataFrame(rows, "file_id int, line_no int, text string")
    got = meanings.value_comments(df, block_rows=block).collect()
    assert {r["value"]: r["comment"] for r in got} == comments(lines)


def fences(lines):
    found, start, body = [], None, []
    for number, line in enumerate(lines, 1):
        if start is None:
            if line.rstrip() == f"{FENCE}sql":
                start, body = number, []
        elif line.rstrip() == FENCE:
            found.append((start, "\n".join(body).strip()))
            start = None
        else:
            body.append(line)
    return found


@RELAXED
@given(
    st.lists(st.sampled_from([f"{FENCE}sql", f"{FENCE}sql  ", FENCE, f"{FENCE} ", f"{FENCE}python", "SELECT 1", "", "  text"]), max_size=14),
    st.sampled_from([1, 4, 1000]),
)
def test_fences_equal_a_plain_pass(spark, lines, block):
    df = spark.createDataFrame([(1, "\n".join(lines))], "file_id int, text string")
    got = blocks.fenced_blocks(blocks.lines_of(df), block_rows=block).collect()
    want = fences("\n".join(lines).split("\n"))
    assert sorted((r["line_no"], r["block"]) for r in got) == want
    assert sorted((r["line_no"], r["block"]) for r in blocks.document_blocks(df).collect()) == want


def test_fences_in_a_long_text(spark):
    # The scan over a long tail without a fence must stay linear.
    text = "x y z\n" * 200_000 + f"{FENCE}sql\nSELECT 1\n{FENCE}\n" + "tail\n" * 200_000
    df = spark.createDataFrame([(1, text)], "file_id int, text string")
    got = blocks.document_blocks(df).collect()
    assert [(r["line_no"], r["block"]) for r in got] == [(200_001, "SELECT 1")]


def test_unicode_white_space_counts(spark):
    from partlens.functions.text import tidy

    df = spark.createDataFrame([(" a \n b ",)], "t string")
    assert df.select(tidy(F.col("t"))).first()[0] == "a b"


def test_a_theme_comment_wins(frame):
    enums = frame([("t", "t/c", "x", 0, "v"), ("t", "t/c", "x", 1, "w"), ("t", "t/c", "x", 2, "z")],
                  "theme string, collection string, column string, position int, value string")
    by_file = frame([("t/c", "v", "file v"), ("t/c", "w", "file w")], "collection string, value string, comment string")
    by_theme = frame([("t", "v", "theme  v")], "theme string, value string, comment string")
    got = meanings.enum_descriptions(enums, by_file, by_theme).collect()
    assert {r["value"]: r["description"] for r in got} == {"v": "theme v", "w": "file w", "z": None}


def test_description_order_and_source(frame):
    cols = frame([("c", x) for x in "abcd"], "collection string, column string")
    text = "collection string, column string, description string"
    got = meanings.described_columns(
        cols,
        frame([("c", "a", "own"), ("c", "b", "")], text),
        frame([("c", "a", "mine"), ("c", "b", "mine")], text),
        frame([("b", "any"), ("c", "any")], "column string, description string"),
    ).collect()
    assert {r["column"]: (r["description"], r["source"]) for r in got} == {
        "a": ("own", "schema"), "b": ("mine", "authored"), "c": ("any", "authored"), "d": (None, None),
    }


def test_an_empty_description_is_left_out(frame):
    tables = frame([("c", ["b", "a"])], "collection string, columns array<string>")
    known = frame([("c", "a", ""), ("c", "z", "not a column")], "collection string, column string, description string")
    got = meanings.table_columns(tables, known).orderBy("position").collect()
    assert [(r["column"], r["description"]) for r in got] == [("b", None), ("a", None)]


def test_settled_values_are_written_once(spark, monkeypatch):
    folders = []
    plain = meanings.workspace
    monkeypatch.setattr(meanings, "workspace", lambda s, name: folders.append((name, plain(s, name))) or folders[-1][1])
    # A chain of five containers over forty leaves, which all settle in the first round.
    members = [(n, 1, n + 1) for n in range(1, 5)] + [(5, k, 100 + k) for k in range(40)]
    own = [(100 + k, f"p{k % 4}", f"v{k}") for k in range(40)] + [(1, "p0", "top")]
    found = meanings.flatten_properties(
        spark.createDataFrame(members, "node long, ordinal int, member long"), spark.createDataFrame(own, "node long, name string, value string")
    ).collect()
    values = {(r.node, r.name): r.value for r in found}
    assert len(found) == 40 + 5 * 4 and values[(2, "p0")] == "v36" and values[(1, "p0")] == "top" and values[(1, "p3")] == "v39"
    (path,) = [p for name, p in folders if name == "values"]
    written = spark.read.parquet(path)
    assert written.where("_open IS NULL").count() == 60
    assert written.where("node.node >= 100").count() == 40
