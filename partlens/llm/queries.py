"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partlens.llm import bpe, exact, mainhtml, mixing, nearest, packing, quality, runs, scoring, simhash, substrings, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_quality_classifier")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query(
    "op4_substring_dedup",
    r"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    windows AS (
        SELECT doc_id, s, md5(array_to_string(list_slice(words, s, s + 49), ' ')) AS h
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM texts)),
    firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h HAVING count(DISTINCT doc_id) > 1),
    gone AS (
        SELECT DISTINCT doc_id, s + k AS pos
        FROM windows JOIN firsts USING (h), (SELECT unnest(range(50)) AS k) WHERE doc_id > first),
    placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM texts),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS line, count(*) AS n
        FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (doc_id)
    """,
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.without_repeats(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query("op5_simhash_near_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


@_query("op6_bpe_round_trip")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = bpe.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query(
    "op8_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.copies(_table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query("op9_main_text")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = mainhtml.main_text(_table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@_query("op10_lm_score")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.scores(_table(spark, folder, "documents"))


@_query("op7_nearest_vectors")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@_query("op2_length_buckets")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return packing.batches(_table(spark, folder, "documents"))


_URL_KEY = r"""
    regexp_replace(lower(regexp_extract({bare}, '^[^/?]*')), '^www[0-9]*\.|:(80|443)$', '', 'g')
    || regexp_replace(regexp_extract({bare}, '^[^/?]*([^?]*)', 1), '/+$', '')
    || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract({bare}, '\?(.*)$', 1), '&'),
         lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z]+|fbclid|gclid|sessionid|sid)(=|$)'))), '&'), ''), '')
"""


# Headers are spelt out: what a revisit brings anew is put over the response's.
_REVISITS = rf"""
    WITH crawled AS (
        SELECT page_id AS n, page_id * 60 + 1000000 AS made, coalesce(html, '') AS body,
               regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*:)?//([^/?@]*@)?', '') AS bare
        FROM pages),
    r AS (
        SELECT n, made, {_URL_KEY.format(bare="bare")} AS url_key, '"' || md5(body) || '"' AS tag, sha256(body) AS payload,
               octet_length(encode(body)) AS size, made - n % 1000 AS modified
        FROM crawled),
    v AS (
        SELECT n, url_key, CASE WHEN n % 17 = 0 THEN made - 864000000 ELSE made + 86400 END AS t,
               CASE WHEN n % 11 = 0 OR n % 13 = 0 THEN NULL WHEN n % 7 = 0 THEN reverse(tag) ELSE tag END AS tag,
               CASE WHEN n % 13 <> 0 THEN modified END AS modified
        FROM r),
    met AS (
        SELECT v.*, r.n AS rn, r.tag AS rtag, r.modified AS rmodified, r.size, r.payload AS rpayload,
               CASE WHEN r.n IS NULL THEN 'no earlier response' WHEN v.tag = r.tag THEN 'resolved'
                    WHEN v.tag IS NOT NULL THEN 'validator differs' WHEN v.modified IS NULL THEN 'no validator'
                    WHEN v.modified = r.modified THEN 'resolved' ELSE 'validator differs' END AS state
        FROM v ASOF LEFT JOIN r ON v.url_key = r.url_key AND v.t > r.made)
    SELECT 'v' || n AS record_id, url_key, t AS "at", state,
           CASE WHEN state = 'resolved' THEN 'r' || rn END AS refers_to,
           concat_ws(chr(10), 'cache-control: max-age=3600',
               CASE WHEN state = 'resolved' THEN 'content-length: ' || size END,
               CASE WHEN state = 'resolved' THEN 'content-type: text/html' ELSE 'content-type: text/plain' END,
               'date: ' || t,
               CASE WHEN tag IS NOT NULL THEN 'etag: W/' || tag WHEN state = 'resolved' THEN 'etag: ' || rtag END,
               'expires: never',
               'last-modified: ' || CASE WHEN state = 'resolved' THEN rmodified ELSE modified END) AS headers,
           CASE WHEN state = 'resolved' THEN rpayload END AS payload
    FROM met
"""


@_query("op3_warc_revisits", _REVISITS)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve_revisits(warc.captures(_table(spark, folder, "pages")))
    return found.withColumn("headers", warc.header_text(F.col("headers")))


def _crc32(text: str) -> str:
    """crc32 of a short ASCII text, bit by bit: a step -1 shifts, any other takes in a byte."""
    return f"""
        xor(4294967295, list_reduce(flatten(list_transform(range(1, length({text}) + 1),
            lambda k: list_concat([ascii(substr({text}, k, 1))::BIGINT], list_transform(range(8), lambda b: -1::BIGINT)))),
            lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END, 4294967295::BIGINT))
    """


_RUNS = rf"""
    WITH given AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, {_crc32("doc_id::VARCHAR")} AS h FROM documents),
    sized AS (SELECT *, len(words) AS n, h // 10 AS g FROM given),
    begun AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM sized),
    replayed AS (
        SELECT doc_id, n, CASE WHEN h % 10 <> 0 OR n = 0 THEN words
               ELSE list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS words
        FROM begun),
    placed AS (SELECT doc_id, n, unnest(words) AS word, unnest(range(n)) AS i FROM replayed),
    equal AS (
        SELECT x.doc_id, y.i - x.i AS q, x.i AS i,
               x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS stretch
        FROM placed x JOIN placed y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 2),
    stretches AS (
        SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM equal GROUP BY doc_id, q, stretch
        HAVING count(*) >= greatest(q, 12 - q)),
    runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS line FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
    told AS (
        SELECT doc_id, count(*) AS n_runs, min((-length, start, period)) AS top,
               string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
        FROM runs GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top[2] AS start, -top[1] AS length, top[3] AS period,
           1000 * -top[1] // top[3] AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
           sha256(coalesce(line, '')) AS collapsed_sha256
    FROM replayed LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@_query("op11_periodic_runs", _RUNS)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.collapsed(runs.replayed(_table(spark, folder, "documents")))
    # The longest run, of those the first, of those the one of smallest period.
    top = F.expr("""
        aggregate(runs, CAST(null AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
                  (best, r) -> CASE WHEN best IS NULL OR r.length > best.length THEN r ELSE best END)
    """)
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("_top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "_top.start",
        "_top.length",
        "_top.period",
        F.expr("1000 * _top.length DIV _top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


_MIX = r"""
    WITH given AS (
        SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               md5('mix' || chr(10) || coalesce(doc_id::VARCHAR, '') || chr(10) || md5(coalesce(text, ''))) AS chance
        FROM documents),
    drawn AS (
        SELECT doc_id, source, len(words) AS size,
               -ln((('0x' || substr(chance, 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE)
               / CASE WHEN len(words) > 0 THEN 0.5::DOUBLE + len(list_distinct(words))::DOUBLE / len(words) ELSE 1.5::DOUBLE END AS key
        FROM given),
    sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM drawn GROUP BY source),
    weighed AS (
        SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sizes),
    stops AS (
        SELECT *, row_number() OVER least AS n, sum(3 * source_size) OVER least - 3 * source_size AS stopped,
               sum(weight) OVER () - sum(weight) OVER least + weight AS free, sum(source_size) OVER () AS total
        FROM weighed WINDOW least AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
    worths AS (
        SELECT min_by((total - stopped)::DOUBLE / free::DOUBLE, n) AS worth FROM stops
        WHERE 3 * source_size >= (total - stopped)::DOUBLE / free::DOUBLE * weight),
    wanted AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, worth * weight) AS target FROM weighed, worths),
    budgets AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs,
               floor(target + 0.5)::BIGINT AS budget FROM wanted),
    placed AS (
        SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM drawn)
    SELECT doc_id, p.source, size, source_size, target, epochs,
           (epochs * size + greatest(least(budget - epochs * source_size - before, size), 0))::BIGINT AS taken
    FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
"""


@_query("op13_source_mix", _MIX)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(_table(spark, folder, "documents"))


_TRIE = rf"""
    WITH turned AS (
        SELECT conv_id, list({{'k': md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')),
                              'size': octet_length(encode(coalesce(text, '')))}} ORDER BY turn NULLS FIRST) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    hashed AS (SELECT *, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM turned),
    rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(list_slice(o.turns, 1, h), []), list_slice(c.turns, h + 1, len(c.turns))) AS turns
        FROM hashed c LEFT JOIN turned o ON o.conv_id = c.conv_id - c.conv_id % 5),
    prefixes AS (
        SELECT conv_id, d, len(turns) = d AS ended, turns[d].size AS size,
               array_to_string(list_transform(list_slice(turns, 1, d), lambda t: t.k), '') AS path
        FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
    nodes AS (
        SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(any_value(size), 0) AS saved,
               string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended) AS ends
        FROM prefixes GROUP BY path, d),
    childed AS (SELECT left(path, 32 * (d - 1)) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
    told AS (SELECT *, coalesce(n_children, 0) AS n FROM nodes LEFT JOIN childed USING (path)),
    below AS (
        SELECT left(path, 32 * up) AS path, sum((n = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
        FROM (SELECT *, unnest(range(d + 1)) AS up FROM told) GROUP BY ALL)
    SELECT t.conv_id, t.d AS depth, p.conv_id AS parent_conv_id, t.n_convs, t.n AS n_children, n_leaves::BIGINT AS n_leaves,
           saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(t.ends, '')) AS ends_sha256
    FROM told t JOIN below b ON t.path = b.path LEFT JOIN nodes p ON t.d > 0 AND p.path = left(t.path, 32 * (t.d - 1))
"""


@_query("op12_prefix_trie", _TRIE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(trie.turn_lists(_table(spark, folder, "conversations"))))
