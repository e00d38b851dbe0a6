"""Gates over findings, footers and probes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partlens.functions.text import is_final_version, version_literal, version_of
from partlens.operators.manifest import ROW_GROUP_CAP

BLANK_TOLERANCE = 1.15


def footer_findings(
    row_groups: DataFrame, parts: DataFrame, cap: int = ROW_GROUP_CAP, versions: tuple[str, ...] = ("1.0.0", "1.1.0")
) -> DataFrame:
    """Byte rules on footers: statistics on every row group, the row cap, a known version."""
    no_stats = row_groups.where(~F.col("has_stats")).groupBy("path").agg(
        F.countDistinct("row_group").alias("n")
    )
    tall = row_groups.groupBy("path").agg(F.max("num_rows").alias("n")).where(F.col("n") > cap)
    unknown = parts.where(~F.coalesce(F.col("geoparquet_version"), F.lit("")).isin(*versions))
    return (
        no_stats.select("path", F.lit("row group without statistics").alias("rule"), "n")
        .unionByName(tall.select("path", F.lit("row group above cap").alias("rule"), "n"))
        .unionByName(unknown.select("path", F.lit("unknown format version").alias("rule"), F.lit(0).cast("bigint").alias("n")))
    )


def bbox_groups(row_groups: DataFrame, bbox: str = "bbox") -> DataFrame:
    """Wide (path, row_group, xmin … ymax) from the footer's per-column statistics."""
    leaf = lambda name, value: F.max(F.when(F.col("column") == f"{bbox}.{name}", F.col(value)))
    return row_groups.where(F.col("column").isin(*(f"{bbox}.{n}" for n in ("xmin", "ymin", "xmax", "ymax")))).groupBy(
        "path", "row_group"
    ).agg(
        leaf("xmin", "min_double").alias("xmin"),
        leaf("ymin", "min_double").alias("ymin"),
        leaf("xmax", "max_double").alias("xmax"),
        leaf("ymax", "max_double").alias("ymax"),
    )


def spatial_order(groups: DataFrame, threshold: float = 0.5) -> DataFrame:
    """How far consecutive row groups of a file overlap, and whether the file counts as ordered.

    Our own definition: for each pair of neighbours the area both boxes share over the
    smaller of the two areas (1 for a box without area that is touched, else 0), averaged
    per file; at or below ``threshold`` the file is ordered. A file with one row group is.
    Pairs without statistics are ``unknown`` and take no part in the average; a file that
    would else be ordered has ``ordered`` null then. Neighbours meet by equality on (file,
    row group), so a file with very many row groups is still spread. They meet in a merge join: Spark would
    broadcast a side by the size of the list of files, and keep to that once the row groups are known.
    """
    after = groups.select(
        "path",
        (F.col("row_group") - 1).alias("row_group"),
        *(F.col(c).alias(f"n_{c}") for c in ("xmin", "ymin", "xmax", "ymax")),
    )
    across = F.least("xmax", "n_xmax") - F.greatest("xmin", "n_xmin")
    up = F.least("ymax", "n_ymax") - F.greatest("ymin", "n_ymin")
    shared = F.greatest(across, F.lit(0.0)) * F.greatest(up, F.lit(0.0))
    area = F.least(
        (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")),
        (F.col("n_xmax") - F.col("n_xmin")) * (F.col("n_ymax") - F.col("n_ymin")),
    )
    sides = [F.col(n + c) for n in ("", "n_") for c in ("xmin", "ymin", "xmax", "ymax")]
    stated = reduce(lambda a, b: a & b, (c.isNotNull() for c in sides))
    ratio = F.when(~stated, None).when(area > 0, shared / area).when((across >= 0) & (up >= 0), 1.0).otherwise(0.0)
    met = groups.join(after.withColumn("_pair", F.lit(True)).hint("merge"), ["path", "row_group"], "left")
    measured = met.groupBy("path").agg(
        F.count("_pair").alias("pairs"),
        F.count_if(F.col("_pair") & ~stated).alias("unknown"),
        F.avg(F.when(F.col("_pair"), ratio)).alias("overlap"),
    )
    within = F.coalesce(F.col("overlap") <= threshold, F.lit(True))
    return measured.withColumn("ordered", F.when(~within, F.lit(False)).when(F.col("unknown") == 0, F.lit(True)))


def gate(findings: DataFrame, accepted: DataFrame) -> DataFrame:
    """Findings with a disposition: waived by an accepted rule, blocking, or a note."""
    rules = accepted.select("rule_id").distinct().withColumn("_accepted", F.lit(True))
    matched = findings.join(rules, "rule_id", "left")
    return matched.withColumn(
        "disposition",
        F.when(F.col("_accepted"), "waived")
        .when(F.col("severity") == "error", "blocking")
        .otherwise("note"),
    ).drop("_accepted")


def severity_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severity", "rule_id").agg(
        F.count(F.lit(1)).alias("findings"), F.countDistinct("path").alias("paths")
    )


def rule_differences(findings: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected rules that no error reports (missing), and reported ones not expected (extra)."""
    found = findings.where(F.col("severity") == "error").select("rule_id").distinct().withColumn("_f", F.lit(True))
    wanted = expected.select("rule_id").distinct().withColumn("_e", F.lit(True))
    return (
        found.join(wanted, "rule_id", "full_outer")
        .where(F.col("_f").isNull() | F.col("_e").isNull())
        .select("rule_id", F.when(F.col("_f").isNull(), "missing").otherwise("extra").alias("difference"))
    )


def names_host(message: Column, host: Column) -> Column:
    return message.contains(F.concat(F.lit("host '"), host, F.lit("'")))


def expected_exactly(findings: DataFrame, expected: DataFrame, host: str) -> DataFrame:
    """What the exact gate reports: missing rules as notes and problems for the rest.

    An extra rule is a problem, so is a missing one when nothing is extra, and so is
    every distinct error that does not name ``host``.
    """
    diff = rule_differences(findings, expected)
    extra = diff.where(F.col("difference") == "extra")
    missing = diff.where(F.col("difference") == "missing")
    any_extra = not extra.isEmpty()
    rules = extra.select("rule_id", F.lit("unexpected rule").alias("problem"), F.lit(True).alias("fails")).unionByName(
        missing.select("rule_id", F.lit("no longer reported").alias("problem"), F.lit(not any_extra).alias("fails"))
    )
    elsewhere = (
        findings.where((F.col("severity") == "error") & ~names_host(F.coalesce("message", F.lit("")), F.lit(host)))
        .select("rule_id", F.concat(F.lit("names another host: "), F.coalesce("message", F.lit(""))).alias("problem"), F.lit(True).alias("fails"))
        .distinct()
    )
    return rules.unionByName(elsewhere)


def declares(schemas: Column, pattern: str) -> Column:
    """Whether a list of schema addresses holds a full match, a trailing # aside."""
    named = F.exists(schemas, lambda uri: F.rtrim(uri, F.lit("#")).rlike(f"^(?:{pattern})$"))
    return F.coalesce(named, F.lit(False))


def exemption(
    outcomes: DataFrame, fixed_text: str, pattern: str
) -> DataFrame:
    """Each invalid object as exempt or error.

    ``outcomes`` is (path, valid, message). Only a message with the fixed text and a
    match of the pattern is exempt.
    """
    known = F.col("message").contains(fixed_text) & F.col("message").rlike(pattern)
    return outcomes.where(~F.col("valid")).withColumn(
        "outcome", F.when(F.coalesce(known, F.lit(False)), "exempt").otherwise("error")
    )


def exemption_report(outcomes: DataFrame, fixed_text: str, pattern: str) -> DataFrame:
    """One row: objects checked, reachable, exempt and wrong, and whether the exemption expired.

    It expires when objects it could reach exist and none needed it. ``reachable`` marks
    objects that declare the schema the exemption is about.
    """
    known = F.col("message").contains(fixed_text) & F.col("message").rlike(pattern)
    exempt = ~F.col("valid") & F.coalesce(known, F.lit(False))
    counted = outcomes.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if("reachable").alias("reachable"),
        F.count_if(exempt).alias("exempt"),
        F.count_if(~F.col("valid") & ~exempt).alias("errors"),
    )
    expired = (F.col("reachable") > 0) & (F.col("exempt") == 0)
    return counted.withColumn("expired", expired).withColumn("ok", ~expired & (F.col("errors") == 0))


def blob_verdict(pairs: DataFrame, probe: str, blank: str, tolerance: float = BLANK_TOLERANCE) -> DataFrame:
    """FAIL-empty when probe and blank are the same bytes, WARN-sparse when hardly larger, else PASS."""
    as_bytes = lambda c: F.col(c).cast("binary")
    probe_size = F.octet_length(as_bytes(probe))
    blank_size = F.octet_length(as_bytes(blank))
    same = F.sha2(as_bytes(probe), 256) == F.sha2(as_bytes(blank), 256)
    return pairs.withColumn("probe_bytes", probe_size).withColumn("blank_bytes", blank_size).withColumn(
        "verdict",
        F.when(same, "FAIL-empty").when(probe_size < blank_size * F.lit(tolerance), "WARN-sparse").otherwise("PASS"),
    )


def liveness(citations: DataFrame, statuses: DataFrame) -> DataFrame:
    """Distinct targets that did not answer 2xx, each with one citing path.

    ``statuses`` is (href, status), one row per probed target; a target without a status
    did not answer.
    """
    named = citations.groupBy("href").agg(F.min("path").alias("example"))
    status = F.col("status")
    alive = F.coalesce(status.between(200, 299), F.lit(False))
    return (
        named.join(statuses, "href", "left")
        .where(~alive)
        .select(
            "href",
            "example",
            F.when(status.isNull(), "no answer").otherwise(F.concat(F.lit("HTTP "), status.cast("string"))).alias("reason"),
        )
    )


def guards(counts: DataFrame) -> DataFrame:
    """Inputs (what, n) that must not be empty but are. An empty check is a failure."""
    return counts.where(F.coalesce(F.col("n"), F.lit(0)) == 0).select(
        F.lit("error").alias("severity"), F.concat(F.lit("no "), "what").alias("message")
    )


def latest_release(releases: DataFrame, floor: tuple[int, int, int]) -> DataFrame:
    """The highest final version per package with a file that was not withdrawn.

    ``releases`` is (package, version, yanked) with one row per file. ``due`` says
    whether it lies above ``floor``.
    """
    final = releases.where(is_final_version(F.col("version")))
    usable = final.groupBy("package", "version").agg(
        F.bool_or(~F.coalesce(F.col("yanked"), F.lit(False))).alias("usable")
    ).where("usable")
    newest = usable.groupBy("package").agg(F.max(version_of(F.col("version"))).alias("v"))
    return newest.select(
        "package",
        F.concat_ws(".", "v.major", "v.minor", "v.patch").alias("version"),
        (F.col("v") > version_literal(*floor)).alias("due"),
    )
