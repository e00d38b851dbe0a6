"""Column profiling: value counts, screening, measuring and choosing a legend column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partlens.operators.spatial import Scope, sample
from partlens.session import cut_lineage, literal_rows

# Columns that identify, locate or describe a row in free form.
SKIP = (
    "id",
    "geometry",
    "bbox",
    "names",
    "sources",
    "cartography",
    "version",
    "theme",
    "type",
    "wikidata",
    "division_id",
    "division_ids",
    "parent_division_id",
    "building_id",
    "connector_ids",
    "hierarchies",
    "perspectives",
)

# Fixed value: the colour of everything a legend does not name.
FALLBACK_COLOUR = "#9e9e9e"

TEXT, NUMERIC, OTHER = "text", "numeric", "other"
BITMAP_SLOTS = 32_768
EXACT = 2**53


@dataclass(frozen=True)
class Rules:
    """Thresholds of the profile. Every bound itself passes.

    They decide verdicts only: no candidate, value or count is left out for them, except
    that the values of a column with over ``max_distinct`` of them are not counted.
    """

    min_values: int = 3
    max_values: int = 10
    max_distinct: int = 40
    max_dominance: float = 0.90
    min_coverage: float = 0.80
    min_populated: float = 0.50


RULES = Rules()


def column_kinds(df: DataFrame, skip: Sequence[str] = SKIP) -> dict[str, str]:
    """Columns to profile in table order, with what their type allows.

    Booleans, dates, decimals, binary and nested columns hold no comparable value.
    """
    numbers = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    kinds = {}
    for field in df.schema.fields:
        if field.name in skip:
            continue
        if isinstance(field.dataType, T.StringType):
            kinds[field.name] = TEXT
        elif isinstance(field.dataType, numbers):
            kinds[field.name] = NUMERIC
        else:
            kinds[field.name] = OTHER
    return kinds


def _comparable(kinds: Mapping[str, str]) -> list[str]:
    return [c for c, kind in kinds.items() if kind != OTHER]


@dataclass(frozen=True)
class Survey:
    """Rows of a sample and the columns that may be few-valued."""

    rows: int
    few: list[str]
    sketched: dict[str, int]


def survey(df: DataFrame, columns: Sequence[str], limit: int) -> Survey:
    """Count the rows, and find the columns that may hold at most ``limit`` distinct values.

    One pass. Each value sets one of 32,768 bits. Set bits never outnumber distinct
    values, so a column with more than ``limit`` bits is surely over the limit and need
    not be counted; the columns returned here still are. A sketch says how many values each
    column holds, about. One row comes back, whatever the size of ``df``, and an identifier
    column is never shuffled.
    """
    slot = lambda c: F.when(
        F.col(c).isNotNull(), F.pmod(F.xxhash64(F.col(c)), F.lit(BITMAP_SLOTS))
    )
    seen = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.bitmap_count(F.bitmap_construct_agg(slot(c))).alias(f"b{i}") for i, c in enumerate(columns)),
        *(F.approx_count_distinct(c).alias(f"s{i}") for i, c in enumerate(columns)),
    ).first()
    few = [c for i, c in enumerate(columns) if seen[f"b{i}"] <= limit]
    return Survey(seen["_rows"], few, {c: seen[f"s{i}"] for i, c in enumerate(columns)})


def unpivot(df: DataFrame, keep: Sequence[str], kinds: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """(…keep, slot, text, number) per non-null value, ``slot`` counting ``columns`` from 0.

    A number in place of the column's name keeps the rows that are grouped next narrow. An
    integer that a double cannot hold exactly has its digits in ``text`` as well, so that
    long identifiers stay apart.
    """
    whole = lambda c: isinstance(df.schema[c].dataType, T.LongType)
    digits = lambda c: F.when(~F.col(c).between(-EXACT, EXACT), F.col(c).cast("string"))
    none_text = F.lit(None).cast("string")
    if not columns:
        none = literal_rows(df.sparkSession, [], "slot int, text string, number double")
        return none.select(*(F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keep), "*")
    cells = [
        F.struct(
            F.lit(slot).alias("slot"),
            (F.col(c) if kinds[c] == TEXT else digits(c) if whole(c) and kinds[c] == NUMERIC else none_text).alias("text"),
            (F.col(c).cast("double") if kinds[c] == NUMERIC else F.lit(None).cast("double")).alias("number"),
        )
        for slot, c in enumerate(columns)
    ]
    long = df.select(*keep, F.inline(F.array(*cells)))
    return long.where(F.col("text").isNotNull() | F.col("number").isNotNull())


def name_slots(long: DataFrame, kinds: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Put column and kind in place of ``slot``."""
    nth = lambda values: F.get(F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>"), "slot")
    named = long.withColumn("column", nth(list(columns))).withColumn("kind", nth([kinds[c] for c in columns]))
    first = [c for c in long.columns if c not in ("slot", "text", "number", "n")]
    last = [c for c in ("text", "number", "n") if c in long.columns]
    return named.select(*first, "column", "kind", *last)


def value_counts(sampled: DataFrame, kinds: Mapping[str, str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per (window, column, value). Counts combine before the shuffle, so a value on
    most rows is no hot key."""
    wanted = list(columns) if columns is not None else _comparable(kinds)
    counted = (
        unpivot(sampled, ["window"], kinds, wanted)
        .groupBy("window", "slot", "text", "number")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return name_slots(counted, kinds, wanted)


def total_counts(counts: DataFrame) -> DataFrame:
    """Counts summed over the windows."""
    return counts.groupBy("column", "kind", "text", "number").agg(F.sum("n").alias("n"))


def null_share(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Share of rows that hold a value, per column, in one pass."""
    group = [by] if by else []
    wide = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"), *(F.count(F.col(c)).alias(c) for c in columns)
    )
    return wide.select(
        *group,
        "_rows",
        F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("present")) for c in columns))),
    ).select(
        *group,
        "column",
        F.col("_rows").alias("rows"),
        "present",
        F.when(F.col("_rows") > 0, F.col("present") / F.col("_rows")).alias("share"),
    )


def recurrence(counts: DataFrame, scopes: int) -> DataFrame:
    """Per column: distinct values, and how many occur in at least half of the scopes.

    ``scopes`` counts every scope read, also one that held no value. With one scope
    nothing can recur, and each value counts.
    """
    need = (scopes + 1) // 2 if scopes > 1 else 1
    per_value = counts.groupBy("column", "kind", "text", "number").agg(
        F.countDistinct("window").alias("hits")
    )
    return per_value.groupBy("column", "kind").agg(
        F.count(F.lit(1)).alias("n_distinct"), F.count_if(F.col("hits") >= need).alias("recurring")
    )


def top_values(totals: DataFrame, k: int) -> DataFrame:
    """The k most frequent values per column; ties go to the smaller value.

    The rank filter runs on every task before the shuffle, so at most k rows per
    column and task meet.
    """
    return _ranked(totals).where(F.col("position") <= k)


def _ranked(totals: DataFrame) -> DataFrame:
    """``totals`` with the position of each value in its column, the most frequent first."""
    order = W.partitionBy("column").orderBy(F.desc("n"), "text", "number")
    return totals.withColumn("position", F.row_number().over(order))


def metrics(totals: DataFrame, sampled_rows: int | Column, k: int = RULES.max_values) -> DataFrame:
    """Dominance, coverage, score and populated share per column."""
    ranked = _ranked(totals)
    whole = ranked.groupBy("column", "kind").agg(
        F.sum("n").alias("total"),
        F.max("n").alias("top_n"),
        F.sum(F.when(F.col("position") <= k, F.col("n"))).alias("covered"),
    )
    rows = F.lit(sampled_rows) if isinstance(sampled_rows, int) else sampled_rows
    dominance = F.col("top_n") / F.col("total")
    coverage = F.col("covered") / F.col("total")
    return whole.select(
        "column",
        "kind",
        "total",
        dominance.alias("dominance"),
        coverage.alias("coverage"),
        (coverage * (F.lit(1.0) - dominance)).alias("score"),
        F.when(rows > 0, F.col("total") / rows).otherwise(F.lit(0.0)).alias("populated"),
    )


def screen(
    counts: DataFrame,
    kinds: Mapping[str, str],
    scopes: int,
    rules: Rules = RULES,
    over_limit: Sequence[str] = (),
    sketched: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per column: verdict, and the rank of those that pass.

    ``over_limit`` names columns already known to exceed the limit and left out of
    ``counts``. Their ``distinct_seen`` and ``recurring`` are null; ``distinct_sketch`` says
    about how many values any column holds.
    """
    schema = "column string, kind string, ordinal int, over boolean, distinct_sketch bigint"
    rows = [(c, kind, i, c in over_limit, (sketched or {}).get(c)) for i, (c, kind) in enumerate(kinds.items())]
    listed = literal_rows(counts.sparkSession, rows, schema)
    cap = F.when(F.col("kind") == NUMERIC, rules.max_values).otherwise(rules.max_distinct)
    seen = listed.join(recurrence(counts, scopes).drop("kind"), "column", "left").withColumn(
        "distinct_seen", F.when(~F.col("over"), F.coalesce("n_distinct", F.lit(0)))
    )
    # A column that was not counted holds more than any bound.
    size, again = F.coalesce("distinct_seen", F.lit(2**62)), F.coalesce("recurring", F.lit(0))
    numeric = F.col("kind") == NUMERIC
    verdict = (
        F.when(size == 0, "no comparable value")
        .when(numeric & ~size.between(rules.min_values, rules.max_values), "no step break")
        .when(size > cap, "too many values")
        .when(size < rules.min_values, "too few values")
        .when(again < rules.min_values, "tracks location")
        .otherwise("candidate")
    )
    fits = size <= rules.max_values
    order = W.partitionBy("kind").orderBy(
        F.when(fits, 0).otherwise(1), F.when(fits, -size).otherwise(size), "ordinal"
    )
    judged = seen.withColumn("verdict", verdict)
    ranked = judged.where(F.col("verdict") == "candidate").withColumn("rank", F.row_number().over(order))
    others = judged.where(F.col("verdict") != "candidate").withColumn("rank", F.lit(None).cast("int"))
    return ranked.unionByName(others).select(
        "column",
        "kind",
        "ordinal",
        "distinct_seen",
        "distinct_sketch",
        F.when(F.col("over"), F.lit(None)).otherwise(again).cast("bigint").alias("recurring"),
        "verdict",
        "rank",
    )


def measure(screened: DataFrame, measured: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Metrics of all candidates, with both verdicts.

    The populated share always counts. Dominance and, for text, coverage only decide
    the strict verdict; the relaxed one ignores them.
    """
    populated = F.col("populated") >= rules.min_populated
    even = F.col("dominance") <= rules.max_dominance
    covers = (F.col("kind") == NUMERIC) | (F.col("coverage") >= rules.min_coverage)
    return (
        screened.where(F.col("rank").isNotNull())
        .join(measured.drop("kind"), "column")
        .withColumn("relaxed_ok", populated)
        .withColumn("strict_ok", populated & even & covers)
        .withColumn(
            "reason",
            F.when(~populated, "mostly null")
            .when(~even, "one value dominates")
            .when(~covers, "top values cover too little"),
        )
    )


def choose(measured: DataFrame, preferred: str | None = None) -> DataFrame:
    """The usable candidates of the first stage that has any, best first.

    Stages: strict text, strict numeric, relaxed text, relaxed numeric. Text orders by
    score, and a preferred column leads the strict list only; numeric keeps the rank.
    Every other text candidate of the winning stage is an alternate.
    """
    text = F.col("kind") == TEXT
    stage = (
        F.when(F.col("strict_ok") & text, 1)
        .when(F.col("strict_ok"), 2)
        .when(F.col("relaxed_ok") & text, 3)
        .when(F.col("relaxed_ok"), 4)
    )
    staged = measured.withColumn("stage", stage).where(F.col("stage").isNotNull())
    lead = F.lit(False) if preferred is None else (F.col("column") == preferred) & (F.col("stage") == 1)
    # A row per candidate column.
    best = W.orderBy("stage").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = W.partitionBy("stage").orderBy(
        F.when(lead, 0).otherwise(1), F.when(text, -F.col("score")).otherwise(F.lit(0.0)), "rank"
    )
    return (
        staged.withColumn("_best", F.min("stage").over(best))
        .where(F.col("stage") == F.col("_best"))
        .withColumn("place", F.row_number().over(order))
        .where(text | (F.col("place") == 1))
        .drop("_best")
    )


def confirm(sampled: DataFrame, kinds: Mapping[str, str], values: DataFrame) -> DataFrame:
    """The rows of ``values`` (column, text, number, …) that the data really holds.

    Reads the data again and uses no earlier count. Only columns named in ``kinds`` are
    read, and they reduce to their distinct values before the join.
    """
    columns = _comparable(kinds)
    held = name_slots(unpivot(sampled, [], kinds, columns).distinct(), kinds, columns).drop("kind")
    h = held.alias("h")
    v = values.alias("v")
    same = (
        (F.col("h.column") == F.col("v.column"))
        & F.col("h.text").eqNullSafe(F.col("v.text"))
        & F.col("h.number").eqNullSafe(F.col("v.number"))
    )
    return v.join(h, same, "left_semi")


def match_legend(values: DataFrame, colours: DataFrame, fallback: str = FALLBACK_COLOUR) -> DataFrame:
    """Legend rows in count order plus the fallback row.

    ``colours`` is (column, text, colour). A value without a colour raises, because a
    colour taken from its place would change meaning from release to release.
    """
    coloured = values.join(colours, ["column", "text"], "left").select(
        "column",
        F.col("position").cast("bigint").alias("position"),
        F.col("text").alias("value"),
        F.when(F.col("colour").isNotNull(), F.col("colour"))
        .otherwise(F.raise_error(F.concat(F.lit("no colour for "), "column", F.lit(" value "), "text")))
        .alias("colour"),
    )
    rest = values.select("column").distinct().select(
        "column", F.lit(None).cast("bigint").alias("position"), F.lit(None).cast("string").alias("value"),
        F.lit(fallback).alias("colour"),
    )
    return coloured.unionByName(rest)


def unmapped(values: DataFrame, colours: DataFrame) -> DataFrame:
    """Legend values that no colour is defined for."""
    return values.join(colours, ["column", "text"], "left_anti")


def palettes_with_fallback(palettes: DataFrame, fallback: str = FALLBACK_COLOUR) -> DataFrame:
    """Palettes (label, colour) that use the colour reserved for unmatched values."""
    return palettes.where(F.lower("colour") == fallback.lower()).select("label").distinct()


def step_legend(values: DataFrame, palette: Sequence[str]) -> DataFrame:
    """Ordered breaks of the values of a numeric column.

    The first colour paints everything below the second break, so the first break has
    no lower edge.
    """
    order = W.partitionBy("column").orderBy("number")
    colours = F.array(*(F.lit(c) for c in palette))
    numbered = values.withColumn("step", F.row_number().over(order) - 1)
    return numbered.select(
        "column",
        F.col("step").cast("bigint").alias("step"),
        F.when(F.col("step") > 0, F.col("number")).alias("from_value"),
        F.element_at(colours, F.col("step") % len(palette) + 1).alias("colour"),
    )


@dataclass
class Legend:
    """What the profile of one table settled on. A value list has at most as many values as the
    rules let a candidate hold, the other lists at most a name per column or window."""

    column: str | None
    expression: str
    values: list
    alternates: list[str]
    exhaustive: bool
    windows: list[str]
    dominance: float | None
    coverage: float | None
    thresholds_relaxed: bool
    legend: bool
    note: str

    SCHEMA = (
        "column string, expression string, values array<string>, alternates array<string>, "
        "exhaustive boolean, windows array<string>, dominance double, coverage double, "
        "thresholds_relaxed boolean, legend boolean, note string"
    )


@dataclass
class Profile:
    """The stages of one profile, each open to inspection."""

    sampled: DataFrame
    kinds: dict[str, str]
    counts: DataFrame
    screened: DataFrame
    measured: DataFrame
    chosen: DataFrame
    values: DataFrame


def profile(
    features: DataFrame,
    scope: Scope,
    *,
    skip: Sequence[str] = SKIP,
    rules: Rules = RULES,
    preferred: str | None = None,
    bbox: str = "bbox",
) -> Profile:
    """Screen, measure and choose over one scope.

    Two passes over the sample: one row of bitmaps decides which columns are worth
    counting, then only those are read and counted. All later stages work on those counts.
    """
    kinds = column_kinds(features, skip)
    kinds.pop("window", None)
    sampled = sample(features, scope, bbox)
    comparable = _comparable(kinds)
    seen = survey(sampled, comparable, rules.max_distinct)
    # Everything below reads these rows and not the sample.
    counts = cut_lineage(value_counts(sampled, kinds, seen.few), "counts")
    return settle(sampled, kinds, seen, counts, len(scope.names), rules, preferred)


def settle(
    sampled: DataFrame, kinds: dict[str, str], seen: Survey, counts: DataFrame, scopes: int, rules: Rules, preferred: str | None
) -> Profile:
    """The stages that need counts alone: screen, measure, choose and rank the values."""
    over = [c for c in _comparable(kinds) if c not in seen.few]
    totals = total_counts(counts)
    screened = screen(counts, kinds, scopes, rules, over, seen.sketched)
    measured = measure(screened, metrics(totals, seen.rows, rules.max_values), rules)
    chosen = choose(measured, preferred)
    values = _ranked(totals).join(chosen.select("column", "place", "stage"), "column")
    return Profile(sampled, kinds, counts, screened, measured, chosen, values)


def build_legend(prof: Profile, scope: Scope, polygons: bool, rules: Rules = RULES) -> Legend:
    """The legend of one table, its values confirmed by a second read.

    Brings back the chosen columns and their values, at most ``rules.max_distinct`` each.
    """
    chosen = prof.chosen.orderBy("place").collect()
    note = (
        "Every legend value was read from the whole table."
        if scope.exhaustive
        else f"Legend values were sampled inside {len(scope.names)} windows "
        f"({', '.join(scope.names)}). A value found only outside them is missing."
    )
    if not chosen:
        return Legend(
            None, "flat", [], [], scope.exhaustive, scope.names, None, None, False, False,
            "No column describes the rows of this table.",
        )
    wanted = {r["column"]: prof.kinds[r["column"]] for r in chosen}
    held = confirm(prof.sampled.select("window", *wanted), wanted, prof.values)
    rows = held.orderBy("place", "position").collect()
    by_column: dict[str, list] = {c: [] for c in wanted}
    for r in rows:
        by_column[r["column"]].append(r["text"] if r["kind"] == TEXT else r["number"])
    best = chosen[0]
    values = by_column[best["column"]]
    if best["kind"] == NUMERIC:
        values = sorted(values)
    if len(values) < rules.min_values:
        raise ValueError(f"only {len(values)} values of {best['column']!r} were confirmed")
    relaxed = best["stage"] > 2
    return Legend(
        column=best["column"],
        expression="match" if best["kind"] == TEXT else "step",
        values=values,
        alternates=[
            r["column"] for r in chosen[1:] if len(by_column[r["column"]]) >= rules.min_values
        ],
        exhaustive=scope.exhaustive,
        windows=scope.names,
        dominance=round(best["dominance"], 4),
        coverage=round(best["coverage"], 4),
        thresholds_relaxed=relaxed,
        legend=polygons,
        note=note if not relaxed else f"No column met the thresholds. {note}",
    )


def legend_row(spark, legend: Legend) -> DataFrame:
    """The legend as one row; numeric breaks are written as text."""
    values = [v if isinstance(v, str) else f"{v:g}" for v in legend.values]
    row = {**legend.__dict__, "values": values}
    return literal_rows(spark, [tuple(row.values())], Legend.SCHEMA)


def sampled_tables(legends: DataFrame) -> DataFrame:
    """Tables whose legend names values of a sample, not of every row."""
    return legends.where(~F.col("exhaustive") & (F.size("values") > 0)).select("collection")


def coded_columns(meanings: DataFrame) -> DataFrame:
    """Every value of every coded column, in order, a row each."""
    return meanings.select("collection", "column", F.posexplode("enum").alias("position", "code")).select(
        "collection", "column", "position", F.concat(F.lit("`"), "code.value", F.lit("`")).alias("rendered")
    )
