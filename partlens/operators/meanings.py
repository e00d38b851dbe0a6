"""Column meanings: reference chains, containers, comments and descriptions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from partlens.functions.paths import resolve
from partlens.functions.text import tidy
from partlens.operators.cycles import counted, cycle_groups
from partlens.scale import BLOCK_ROWS, running_last
from partlens.session import cut_lineage, workspace

# A node's own properties are above those of any member.
OWN = 2**31 - 1
NODE, AGAIN, CYCLE = 0, 1, 2


def table_columns(collections: DataFrame, meanings: DataFrame) -> DataFrame:
    """The real columns of every collection in table order, described where a meaning exists."""
    listed = collections.select("collection", F.posexplode("columns").alias("position", "column"))
    known = meanings.select("collection", "column", F.nullif(F.col("description"), F.lit("")).alias("description"))
    return listed.join(known, ["collection", "column"], "left").select(
        "collection", "position", "column", "description"
    )


def reference_target(file: Column, ref: Column) -> Column:
    """The node a reference means, as ``file#/segments``: what :func:`resolve_references` takes.

    The file part is relative to the file that holds the reference, and none means that
    file itself; empty segments of the pointer are left out. References to web addresses
    lead out of the documents and are null.
    """
    part = F.substring_index(ref, "#", 1)
    inside = F.when(ref.contains("#"), F.substring_index(ref, "#", -1)).otherwise("")
    segments = F.filter(F.split(inside, "/"), lambda s: s != "")
    pointer = F.concat(F.lit("#"), F.array_join(F.transform(segments, lambda s: F.concat(F.lit("/"), s)), ""))
    return F.when(~ref.startswith("http"), F.concat(F.when(part == "", file).otherwise(resolve(file, part)), pointer))


def resolve_references(nodes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Follow ``ref`` from every node to the end of its chain, a key set nearer to the node winning.

    ``nodes`` is (node, ref, …fields). A target that is not a node ends a chain. Each round
    doubles the distance a pointer spans, so a chain of a million takes twenty; the rounds
    end when no pointer is left. In a cycle every node has been seen once the distance
    exceeds the number of nodes, and :func:`reference_cycles` names those nodes.
    """
    return _chased(nodes, fields).select("node", *fields)


def reference_cycles(nodes: DataFrame) -> DataFrame:
    """The nodes whose chain of references never ends: those on a cycle or leading into one."""
    return _chased(nodes, []).where(F.col("ptr").isNotNull()).select("node")


def _chased(nodes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(node, ptr, …fields) after the last round; a pointer is left only where a chain never ends."""
    state = nodes.select("node", F.col("ref").alias("ptr"), *fields)
    total = None
    span = 1
    while total is None or span <= total:
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("rows"), F.count("ptr").alias("open")]
        hop = state.select(F.col("node").alias("ptr"), F.col("ptr").alias("_next"), *(F.col(f).alias(f"_{f}") for f in fields))
        # Many nodes may share one target: Spark splits a pointer that is common.
        moved = state.join(hop, ["ptr"], "left").select(
            "node", F.col("_next").alias("ptr"), *(F.coalesce(f, f"_{f}").alias(f) for f in fields)
        )
        state = cut_lineage(moved.observe(seen, *counts), "chase", seen)
        span *= 2
        total = seen.get["rows"]
        if not seen.get["open"]:
            break
    return state


def flatten_properties(members: DataFrame, properties: DataFrame) -> DataFrame:
    """All properties of every node, those of its containers included.

    ``members`` is (node, ordinal, member), ordinals counting the allOf members first
    and the oneOf members after them; ``properties`` is (node, name, value). A later
    member wins over an earlier one and a node's own property over both, at every level.

    Containers that contain each other hold the same properties, each in its own order: what a node
    reaches without going round comes first, then the cycle's nodes give what they hold without going
    round, the largest first. See :func:`container_cycles`.

    A node's value of a name is its own, or what the last member that has the name has. So values rise
    level by level: a node is settled once all its members are, and then its values are written and sent on, once.
    A round handles the values of open nodes alone; the rounds follow the depth of the containers.
    Only values are kept, one for each name of a node, not the ways to them.
    """
    edges, own = _condensed(members, properties)
    spark, folder, names = members.sparkSession, workspace(members.sparkSession, "values"), ["node", "name", "order", "given"]
    waiting, left = counted(edges.select("node", "order", "member"), "members")
    best = own.select(*names)
    for level in count():
        opened = waiting.select("node").distinct().withColumn("_open", F.lit(True))
        path = f"{folder}/level={level}"
        marked = best.join(opened, "node", "left")
        marked.write.parquet(path)
        marked = spark.read.schema(marked.schema).parquet(path)
        if not left:
            break
        settled = marked.where("_open IS NULL").select(F.col("node").alias("member"), "name", "given")
        rest = marked.where("_open").select(*names)
        known = rest.unionByName(settled.join(waiting, "member").select(*names)).groupBy("node", "name")
        best = known.agg(F.max(F.struct("order", "given")).alias("b")).select("node", "name", "b.order", "b.given")
        still = waiting.join(opened.select(F.col("node").alias("member")), "member", "left_semi")
        waiting, after = counted(still.select("node", "order", "member"), "members")
        if after == left:
            raise ValueError("containers lead back to themselves")
        left = after
    found = spark.read.schema(marked.schema).parquet(folder).where("_open IS NULL")
    return found.where(F.col("node.kind") == NODE).select("node.node", "name", "given.value")


def container_cycles(members: DataFrame) -> DataFrame:
    """The nodes that contain themselves, over however many levels."""
    return cycle_groups(members, "node", "member").select("node")


def _condensed(members: DataFrame, properties: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members`` as (node, order, member) without cycles, and the properties as (node, order, name, given).

    A node on a cycle loses its members on the cycle and has the cycle as its first member instead.
    The cycle's members are its nodes once more, each with what it holds without going round.
    """
    groups = cycle_groups(members, "node", "member")

    def at(kind: int, name: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(name).alias("node"))

    def order(ordinal: Column, name: str) -> Column:
        return F.struct(ordinal.cast("int").alias("ordinal"), F.col(name).alias("node"))

    mine = groups.select("node", F.col("group").alias("_mine"))
    theirs = groups.select(F.col("node").alias("member"), F.col("group").alias("_theirs"))
    known = members.where("node IS NOT NULL AND member IS NOT NULL").join(mine, "node", "left").join(theirs, "member", "left")
    onward = known.where(F.coalesce(F.col("_mine") != F.col("_theirs"), F.lit(True)))
    by_order = order(F.col("ordinal"), "member").alias("order")
    edges = onward.select(at(NODE, "node").alias("node"), by_order, at(NODE, "member").alias("member"))
    again = onward.where("_mine IS NOT NULL").select(at(AGAIN, "node").alias("node"), by_order, at(NODE, "member").alias("member"))
    first = groups.select(at(NODE, "node").alias("node"), order(F.lit(-OWN), "group").alias("order"), at(CYCLE, "group").alias("member"))
    inside = groups.select(at(CYCLE, "group").alias("node"), order(F.lit(0), "node").alias("order"), at(AGAIN, "node").alias("member"))
    given = properties.where("node IS NOT NULL").groupBy("node", "name").agg(F.max(F.struct("value")).alias("given"))
    own = given.select(at(NODE, "node").alias("node"), order(F.lit(OWN), "node").alias("order"), "name", "given")
    copied = given.join(groups.select("node"), "node", "left_semi")
    copied = copied.select(at(AGAIN, "node").alias("node"), order(F.lit(OWN), "node").alias("order"), "name", "given")
    return edges.unionByName(again).unionByName(first).unionByName(inside), own.unionByName(copied)


# The forms of a list item and of a comment line.
ITEM_LINE = r"^(?U)\s*- ([A-Za-z0-9_]+)\s*(?:#\s?(.*))?$"
COMMENT_LINE = r"^(?U)\s*#\s?(.*)$"


def value_comments(lines: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Comment text per listed value, from (file_id, line_no, text) lines.

    The text of one run is one value here; :func:`comment_lines` keeps its lines apart. None is
    kept when its text is empty.
    """
    joined = F.concat_ws(
        " ", F.transform(F.array_sort(F.collect_list(F.struct("line_no", "said"))), lambda s: s["said"])
    )
    return (
        comment_lines(lines, block_rows=block_rows)
        .groupBy("file_id", "value")
        .agg(joined.alias("joined"))
        .select("file_id", "value", F.regexp_replace("joined", r"(?U)^\s+|\s+$", "").alias("comment"))
        .where(F.col("comment") != "")
    )


def comment_lines(lines: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(file_id, value, line_no, said): every line of the comment that counts for a value.

    A list item opens a run, comment lines add to it, blank lines leave it open and any
    other line closes it. Of several commented runs of a value the last one counts.
    """
    text = F.col("text")
    item, comment = text.rlike(ITEM_LINE), text.rlike(COMMENT_LINE)
    blank = F.regexp_replace(text, r"(?U)\s+", "") == ""
    name = F.when(item, F.regexp_extract(text, ITEM_LINE, 1))
    mark = F.when(item | (~comment & ~blank), F.struct(F.col("line_no").alias("at"), name.alias("value")))
    runs = running_last(lines, ["file_id"], "line_no", mark, "run", block_rows=block_rows)
    tail = F.regexp_extract(text, ITEM_LINE, 2)
    said = F.when(item, F.when(tail != "", tail)).when(comment, F.regexp_extract(text, COMMENT_LINE, 1))
    spoken = (
        runs.withColumn("said", said)
        .where(F.col("run.value").isNotNull() & F.col("said").isNotNull())
        .select("file_id", "line_no", F.col("run.at").alias("at"), F.col("run.value").alias("value"), "said")
    )
    last = spoken.groupBy("file_id", "value").agg(F.max("at").alias("at"))
    return spoken.join(last, ["file_id", "value", "at"], "left_semi").select("file_id", "value", "line_no", "said")


def enum_descriptions(enums: DataFrame, file_comments: DataFrame, theme_comments: DataFrame) -> DataFrame:
    """Enum values with their comment; a comment of the theme wins over one of the file.

    ``enums`` is (theme, collection, column, position, value).
    """
    by_file = file_comments.select("collection", "value", F.col("comment").alias("_file"))
    by_theme = theme_comments.select("theme", "value", F.col("comment").alias("_theme"))
    filed = enums.join(by_file, ["collection", "value"], "left")
    return (
        filed.join(by_theme, ["theme", "value"], "left")
        .withColumn("description", tidy(F.coalesce("_theme", "_file")))
        .drop("_file", "_theme")
    )


def described_columns(
    columns: DataFrame, schema_text: DataFrame, per_collection: DataFrame, shared: DataFrame
) -> DataFrame:
    """A description per column and where it comes from.

    The schema's own text wins, then text written for the collection, then text written
    for the column name anywhere. An empty text counts as none.
    """
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    own = schema_text.select("collection", "column", filled("description").alias("_schema"))
    mine = per_collection.select("collection", "column", filled("description").alias("_mine"))
    any_ = shared.select("column", filled("description").alias("_shared"))
    here = columns.join(own, ["collection", "column"], "left").join(mine, ["collection", "column"], "left")
    joined = here.join(any_, ["column"], "left")
    text = F.coalesce("_schema", "_mine", "_shared")
    return joined.select(
        *columns.columns,
        tidy(text).alias("description"),
        F.when(F.col("_schema").isNotNull(), "schema").when(text.isNotNull(), "authored").alias("source"),
    )


def coverage(columns: DataFrame) -> DataFrame:
    """Described, total and coded columns per collection, with the grand total (null)."""
    described = F.coalesce(F.col("description"), F.lit("")) != ""
    return columns.rollup("collection").agg(
        F.count_if(described).alias("described"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(F.size("enum"), F.lit(0)) > 0).alias("coded"),
    )


def undocumented(columns: DataFrame) -> DataFrame:
    return columns.where(F.coalesce(F.col("description"), F.lit("")) == "").select("collection", "column")


def known_issues(collections: DataFrame, issues: DataFrame, sampled: DataFrame, sampled_note: str) -> DataFrame:
    """Every note on a collection, one row each: its listed issues, then the sampling note."""
    known = collections.select("collection")
    listed = issues.join(known, ["collection"], "left_semi").select("collection", "position", "note")
    noted = known.join(sampled.select("collection").distinct(), "collection", "left_semi")
    after = F.lit(2**31 - 1).cast("int")
    return listed.unionByName(noted.select("collection", after.alias("position"), F.lit(sampled_note).alias("note")))
