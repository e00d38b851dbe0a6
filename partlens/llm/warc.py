"""Web archive records: which full response a not-modified revisit stands for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from partlens.llm.common import stored

# The headers that a 304 answer may bring anew (RFC 9110, 15.4.5) and Last-Modified,
# and query parameters that name the way to a page, not the page.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|sessionid|sid)(=|$)"
# Records in a range, which one task sorts.
RANGE_ROWS = 100_000


def url_key(url: Column) -> Column:
    """A canonical form: no scheme, user, ``www``, default port, fragment, tracking parameters or
    last slash; host in lower case and parameters in order. Null stays null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^([A-Za-z][A-Za-z0-9+.-]*:)?//([^/?@]*@)?", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www[0-9]*\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    given = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    asked = F.array_join(F.sort_array(F.filter(given, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(F.lit("")))


def parse_headers(block: Column) -> Column:
    """The header lines of a record as a map: names in lower case, values of one name joined by commas."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: x.rlike(r"^[^\s:]+:"))
    pairs = F.transform(
        lines,
        lambda x: F.struct(
            F.lower(F.regexp_extract(x, r"^([^\s:]+):", 1)).alias("name"), F.trim(F.regexp_extract(x, r"^[^:]+:(.*)$", 1)).alias("value")
        ),
    )
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    joined = F.transform(
        names,
        lambda n: F.struct(n, F.array_join(F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]), ", ")),
    )
    return F.map_from_entries(joined)


def header_text(headers: Column) -> Column:
    """A map of headers as lines in the order of their names."""
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def _tag(headers: Column) -> Column:
    """An entity tag for weak comparison: the tag itself, strong or weak."""
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id``, ``url_key``, ``at``, ``state``, ``refers_to``, ``headers`` and ``payload``.

    ``records`` has ``record_id``, ``url``, ``at`` (any ordered type), ``kind`` (response or
    revisit), ``headers`` (a map with names in lower case) and ``payload`` (what tells the
    body, such as its digest). A revisit stands for the latest full response with its
    canonical url and a smaller ``at``; of responses at one time, that with the largest
    ``record_id``. If both have an entity tag it must match (weakly), else if both have a
    modification time that must; then the response's headers hold, renewed by those that
    a 304 may bring.

    ``state`` is ``resolved``, ``validator differs``, ``no validator`` (nothing to compare) or ``no earlier
    response``; only resolved revisits have ``refers_to``, ``payload`` and merged headers, others keep
    their own. Null urls are one url of their own, apart from empty ones, and ``url_key`` stays
    null for them; a null time precedes all; null headers
    are none. Other kinds of records and other columns take no part. Repeated revisits
    come out each. An empty table gives no rows.

    Records are sorted over ranges of (url, time), so one url may fill many tasks. Each
    range finds the last response within itself, and a row per url and range carries it
    to the ranges that follow. There is a range for every ``RANGE_ROWS`` records, and no fewer
    than the session has slots, so a task sorts as many rows at any size.
    """
    none = F.create_map().cast("map<string,string>")
    events = records.where(F.col("kind").isin("response", "revisit")).select(
        url_key(F.col("url")).alias("url_key"),
        "at",
        (F.col("kind") == "response").alias("_full"),
        F.col("record_id"),
        F.coalesce("headers", none).alias("headers"),
        "payload",
    )
    order = ["url_key", "at", "_full", "record_id"]
    # The ranges are written with the rows: a task run again must not deal them anew.
    spark = records.sparkSession
    ranges = max(spark.sparkContext.defaultParallelism, -(-events.select(F.count(F.lit(1))).first()[0] // RANGE_ROWS))
    ranged = stored(events.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    full = F.when(F.col("_full"), F.struct("record_id", "headers", "payload"))
    inside = W.partitionBy("_range", "url_key").orderBy("at", "_full", "record_id").rowsBetween(W.unboundedPreceding, -1)
    own = ranged.withColumn("_here", F.last(full, ignorenulls=True).over(inside)).where(~F.col("_full"))
    latest = ranged.where("_full").groupBy("_range", "url_key").agg(
        F.max_by(F.struct("record_id", "headers", "payload"), F.struct("at", "record_id")).alias("_last")
    )
    same = lambda a, b: (a["_range"] == b["_range"]) & a["url_key"].eqNullSafe(b["url_key"])
    urls = ranged.select("_range", "url_key").distinct()
    met = urls.join(latest, same(urls, latest), "left").select(urls["_range"], urls["url_key"], "_last")
    earlier = W.partitionBy("url_key").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = met.select("_range", "url_key", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    found = own.join(carried, same(own, carried)).drop(carried["_range"], carried["url_key"]).withColumn("_from", F.coalesce("_here", "_carried"))

    theirs = F.col("_from.headers")
    mine = F.col("headers")
    tags = _tag(mine).isNotNull() & _tag(theirs).isNotNull()
    times = mine["last-modified"].isNotNull() & theirs["last-modified"].isNotNull()
    agrees = F.when(tags, _tag(mine) == _tag(theirs)).when(times, mine["last-modified"] == theirs["last-modified"])
    state = (
        F.when(F.col("_from").isNull(), "no earlier response")
        .when(agrees.isNull(), "no validator")
        .when(agrees, "resolved")
        .otherwise("validator differs")
    )
    renewed = F.map_filter(mine, lambda name, _: name.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda name, _: ~F.array_contains(F.map_keys(renewed), name)), renewed)
    resolved = F.col("state") == "resolved"
    return found.withColumn("state", state).select(
        "record_id",
        "url_key",
        "at",
        "state",
        F.when(resolved, F.col("_from.record_id")).alias("refers_to"),
        F.when(resolved, merged).otherwise(mine).alias("headers"),
        F.when(resolved, F.col("_from.payload")).alias("payload"),
    )


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Two crawls of every page as records: a full response, and a day later a revisit.

    Each revisit comes by another form of the url. A seventh of them bring another entity
    tag, an eleventh only the modification time, a thirteenth no validator, and a
    seventeenth were made before the first crawl.
    """
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(-1))
    mark = F.abs(number)
    body = F.coalesce(F.col(html_col), F.lit(""))
    tag = F.concat(F.lit('"'), F.md5(body), F.lit('"'))
    day = F.lit(86_400)
    made = number * 60 + 1_000_000
    modified = F.concat(F.lit("Last-Modified: "), (made - mark % 1000).cast("string"))
    response = F.concat_ws(
        "\r\n",
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
        F.concat(F.lit("ETag: "), tag),
        modified,
        F.concat(F.lit("Date: "), made.cast("string")),
        F.lit("Cache-Control: max-age=60"),
    )
    later = F.when(mark % 17 == 0, made - day * 10_000).otherwise(made + day)
    own_tag = F.when((mark % 11 == 0) | (mark % 13 == 0), None).when(mark % 7 == 0, F.concat(F.lit("ETag: W/"), F.reverse(tag))).otherwise(
        F.concat(F.lit("ETag: W/"), tag)
    )
    revisit = F.concat_ws(
        "\r\n",
        own_tag,
        F.when(mark % 13 != 0, modified),
        F.concat(F.lit("Date: "), later.cast("string")),
        F.lit("Cache-Control: max-age=3600"),
        F.lit("Content-Type: text/plain"),
        F.lit("Expires: never"),
    )
    again = F.concat(F.regexp_replace(F.col(url_col), r"#.*$", ""), F.when(F.col(url_col).contains("?"), "&utm_medium=crawl#x").otherwise("?utm_medium=crawl"))
    kinds = F.array(
        F.struct(
            F.concat(F.lit("r"), number.cast("string")).alias("record_id"), F.col(url_col).alias("url"), made.alias("at"),
            F.lit("response").alias("kind"), response.alias("block"), F.sha2(body, 256).alias("payload"),
        ),
        F.struct(
            F.concat(F.lit("v"), number.cast("string")).alias("record_id"), again.alias("url"), later.alias("at"),
            F.lit("revisit").alias("kind"), revisit.alias("block"), F.lit(None).cast("string").alias("payload"),
        ),
    )
    rows = pages.select(F.explode(kinds).alias("r")).select("r.*")
    return rows.withColumn("headers", parse_headers(F.col("block"))).drop("block")
