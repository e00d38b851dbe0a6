"""The document graph: links, the tree walk, subsets, broken and stale targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from partlens.functions.paths import is_data_file, is_remote, is_web, resolve
from partlens.session import cut_lineage, literal_rows

REMOTE_ASSETS = ("data", "visual")


def links_of(links: DataFrame, *rels: str) -> DataFrame:
    return links.where(F.col("rel").isin(*rels))


def latest_child(links: DataFrame) -> DataFrame:
    """The child links flagged as the latest release."""
    return links.where((F.col("rel") == "child") & F.coalesce(F.col("latest"), F.lit(False)))


def remote_citations(assets: DataFrame) -> DataFrame:
    """Each (href, path) that cites a web address under a data or visual key, once."""
    return assets.where(F.col("key").isin(*REMOTE_ASSETS) & is_web(F.col("href"))).select("href", "path").distinct()


def href_inventory(citations: DataFrame) -> DataFrame:
    """Distinct targets, how many documents cite each, and the smallest citing path.

    The citing paths themselves stay one row each in ``citations``: a target cited by a
    third of all documents would not fit one list.
    """
    return (
        citations.groupBy("href", "path").agg(F.count(F.lit(1)).alias("times"))
        .groupBy("href")
        .agg(F.count(F.lit(1)).alias("documents"), F.min("path").alias("example"))
    )


def checked_links(links: DataFrame, *, is_asset: bool = False, light: bool = False) -> DataFrame:
    """Relative links with their resolved target and whether they are checked or skipped.

    In a light check, assets that point at data files are skipped, because those bytes
    are kept elsewhere. Queries and fragments stay part of the name.
    """
    href = F.col("href")
    local = links.where((F.coalesce(href, F.lit("")) != "") & ~is_remote(href))
    skipped = is_data_file(href) if is_asset and light else F.lit(False)
    return local.withColumn("target", resolve(F.col("path"), href)).withColumn("skipped", skipped)


def broken_links(checked: DataFrame, paths: DataFrame) -> DataFrame:
    """Checked links whose target is not among ``paths``.

    Targets are made distinct before they meet the paths: most documents link the same
    few targets, such as the root.
    """
    live = checked.where(~F.col("skipped"))
    missing = live.select("target").distinct().join(paths.select(F.col("path").alias("target")), "target", "left_anti")
    return live.join(missing, "target", "left_semi").drop("skipped")


def link_report(checked: DataFrame, broken: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row each: documents read, hrefs checked, hrefs skipped, hrefs broken."""
    seen = checked.agg(F.count_if(~F.col("skipped")).alias("checked"), F.count_if("skipped").alias("skipped"))
    both = seen.select(F.explode(F.array(*(F.struct(F.lit(w).alias("what"), F.col(w).alias("n")) for w in ("checked", "skipped")))).alias("r"))

    def total(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")

    return total(nodes, "documents").unionByName(both.select("r.what", "r.n")).unionByName(total(broken, "broken"))


def walk(links: DataFrame, root: str, rels: tuple[str, ...] = ("child", "item")) -> DataFrame:
    """Every document reachable from ``root`` over relative links, with its depth: the fewest links from there.

    A document that one other alone links is as far from its anchor as that one, and a link more: the
    nearest document above it that is the root, or that several link. Pointers to those double
    their distance each round, so a chain of documents takes rounds by the logarithm of its length.
    Only documents that several link go by rounds from one to the next, over ways that are
    already shortened; a round passes on depths that the one before has lowered. In a
    catalog that is a tree there are none.

    A document that links nothing takes no part in the rounds; it gets its depth from the one that links it
    at the end. One document may link a third of all others: each row looks up one pointer,
    and Spark splits pointers that are common. Loops end, as a pointer that has gone further than there
    are documents comes from no root.
    """
    edges = (
        links.where(F.col("rel").isin(*rels) & ~is_remote(F.col("href")))
        .select("path", resolve(F.col("path"), F.col("href")).alias("target"))
        .where((F.col("path") != F.col("target")) & (F.col("target") != root))
        .distinct()
    )
    above = edges.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("up"))
    linking = edges.select(F.col("path").alias("target")).distinct()
    above = above.join(linking.withColumn("inner", F.lit(True)), "target", "left")
    seen = Observation()
    above = cut_lineage(above.observe(seen, F.count_if(F.col("n") > 1).alias("crossed")), "above", seen)
    single = above.where("n = 1").select(F.col("target").alias("path"), "up", "inner")
    pointers = _anchored(single.where("inner").select("path", "up"))
    anchors = literal_rows(links.sparkSession, [(root, 0)], "path string, depth long")
    if seen.get["crossed"]:
        crossed = above.where("n > 1").select(F.col("target").alias("path"))
        anchors = cut_lineage(_shortest(_ways(edges, pointers, crossed, root), anchors), "anchors")
    inside = pointers.join(anchors.withColumnRenamed("path", "up"), "up").select("path", (F.col("depth") + F.col("span")).alias("depth"))
    known = anchors.unionByName(inside)
    ends = single.where("inner IS NULL").join(known.withColumnRenamed("path", "up"), "up").select("path", (F.col("depth") + 1).alias("depth"))
    return known.unionByName(ends).select("path", F.col("depth").cast("int").alias("depth"))


def _anchored(parents: DataFrame) -> DataFrame:
    """(path, up, span): the nearest document above each that is not among ``parents``, (path, up), and the links between.

    Documents on a loop of such pointers, or below one, end at one that is.
    """
    state = parents.withColumn("span", F.lit(1).cast("long"))
    reach, total = 1, None
    while total is None or reach <= total:
        hop = state.select(F.col("path").alias("up"), F.col("up").alias("_up"), F.col("span").alias("_span"))
        moved = state.join(hop, "up", "left").select(
            "path", F.coalesce("_up", "up").alias("up"), (F.col("span") + F.coalesce("_span", F.lit(0))).alias("span"), F.col("_up").isNotNull().alias("_moved")
        )
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if("_moved").alias("moved")]
        state = cut_lineage(moved.observe(seen, *counts).drop("_moved"), "pointers", seen)
        reach, total = reach * 2, seen.get["rows"]
        if not seen.get["moved"]:
            break
    return state


def _ways(edges: DataFrame, pointers: DataFrame, crossed: DataFrame, root: str) -> DataFrame:
    """(start, path, span): the shortest way without another such document between the root or a document of ``crossed`` and one of these."""
    into = edges.join(crossed.withColumnRenamed("path", "target"), "target", "left_semi")
    into = into.join(pointers.select("path", "up", "span"), "path", "left")
    start, span = F.coalesce("up", "path"), F.coalesce("span", F.lit(0)) + 1
    ways = into.select(start.alias("start"), F.col("target").alias("path"), span.alias("span"))
    ways = ways.groupBy("start", "path").agg(F.min("span").alias("span"))
    starts = crossed.unionByName(literal_rows(edges.sparkSession, [(root,)], "path string")).withColumnRenamed("path", "start")
    return cut_lineage(ways.join(starts, "start", "left_semi"), "ways")


def _shortest(ways: DataFrame, seeds: DataFrame) -> DataFrame:
    """(path, depth): the least depth over ``ways`` of every document that one of the seeds leads to."""
    state = changed = seeds
    while True:
        sent = changed.withColumnRenamed("path", "start").join(ways, "start")
        sent = sent.select("path", (F.col("depth") + F.col("span")).alias("depth"), F.lit(None).cast("long").alias("_old"))
        both = state.select("path", "depth", F.col("depth").alias("_old")).unionByName(sent)
        best = both.groupBy("path").agg(F.min("depth").alias("depth"), F.min("_old").alias("_old"))
        seen = Observation()
        moved = best.select("path", "depth", (~F.col("depth").eqNullSafe(F.col("_old"))).alias("_moved"))
        moved = cut_lineage(moved.observe(seen, F.count_if("_moved").alias("n")), "depths", seen)
        state = moved.drop("_moved")
        if not seen.get["n"]:
            return state
        changed = moved.where("_moved").drop("_moved")


def subset(nodes: DataFrame, links: DataFrame, theme: str, collection: str) -> DataFrame:
    """The ancestors of one collection and everything below it.

    Raises when a child link on the way is missing, so that a renamed collection never
    turns into an empty subset.
    """
    way = [("catalog.json", f"./{theme}/catalog.json"), (f"{theme}/catalog.json", f"./{collection}/collection.json")]
    for path, href in way:
        linked = (F.col("path") == path) & (F.col("rel") == "child") & (F.col("href") == href)
        if links.where(linked).isEmpty():
            raise ValueError(f"{path} has no child link {href!r}")
    keep = F.col("path").isin("catalog.json", f"{theme}/catalog.json")
    return nodes.where(keep | F.col("path").startswith(f"{theme}/{collection}/"))


def subset_links(links: DataFrame, theme: str, collection: str) -> DataFrame:
    """The links of the subset: each ancestor keeps only the child on the way."""
    below = F.col("path").startswith(f"{theme}/{collection}/")
    ancestor = F.col("path").isin("catalog.json", f"{theme}/catalog.json")
    on_way = F.col("href").isin(f"./{theme}/catalog.json", f"./{collection}/collection.json")
    return links.where(below | (ancestor & ((F.col("rel") != "child") | on_way)))


def stale(existing: DataFrame, written: DataFrame) -> DataFrame:
    """Outputs of an earlier run that this run did not write."""
    return existing.join(written.select("path"), "path", "left_anti")


def generated_styles(existing: DataFrame) -> DataFrame:
    """Outputs the legend job owns: three fixed names and every by_<column>."""
    name = F.regexp_replace("path", "^.*/", "")
    return existing.where(
        name.isin("default.json", "flat.json", "zoom.json") | (name.startswith("by_") & name.endswith(".json"))
    )


