"""Not-modified revisits of a web archive resolved to full responses.

A revisit record holds no payload: the server said the page had not changed.
It is resolved by an as-of join: among the full responses of the same canonical
URL, the latest one strictly earlier.  The validators decide whether that is
the page meant: equal entity tags (compared weakly) or, without a tag on the
revisit, equal modification dates.  A resolved record takes the payload and
headers of the response; of its own headers it may replace those that a
not-modified answer is allowed to carry.

The as-of join is a window per URL and slice of time; slices are cut at
quantiles of the capture times.  A slice without an earlier response of its own
takes over the last one of the slices before, from a table of one row per URL
and slice.  A URL with any share of the rows is thus spread over the slices.

``status`` of a revisit is ``resolved``, ``mismatch`` (validators differ or
are missing) or ``missing`` (no earlier response, or no URL).  A response
without payload or with a status other than 200 is no full response.  Of
responses at one instant the one with the greater record id counts, of those with one id
too the one with the greater payload, then headers.  Ids may repeat: a record is
known by its id, URL and time.  Null headers are no headers; repeated rows give repeated results; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.session import cut_lineage

SLICES = 256  # slices of time

# fixed values: headers that a 304 answer may update
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "set-cookie",
             "vary", "warning")


def canonical_url(url: Column) -> Column:
    """Without scheme, www, default port, fragment, utm parameters and trailing
    slash; host in lower case.  Null or empty: null."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^[A-Za-z]+://", "")
    host = F.lower(F.regexp_extract(u, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), ":(80|443)$", "")
    rest = F.regexp_extract(u, "^[^/?]*(.*)$", 1)
    path = F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/+$", "")
    query = F.regexp_replace(F.regexp_extract(rest, "\\?(.*)$", 1), "(^|&)utm_[a-z]+=[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    out = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(host != "", out)


def _header(headers: str, name: str) -> Column:
    return F.col(headers).getItem(name)


def _opaque(tag: Column) -> Column:
    """An entity tag without its mark of weakness."""
    return F.regexp_replace(tag, "^W/", "")


def same_version(revisit: str, response: str) -> Column:
    tag, date = _header(revisit, "etag"), _header(revisit, "last-modified")
    by_tag = F.coalesce(_opaque(tag) == _opaque(_header(response, "etag")), F.lit(False))
    by_date = F.coalesce(date == _header(response, "last-modified"), F.lit(False))
    return F.when(tag.isNotNull(), by_tag).otherwise(by_date)


def merged_headers(revisit: str, response: str) -> Column:
    """The response's headers, with the permitted ones of the revisit in place."""
    new = F.map_filter(F.coalesce(F.col(revisit), F.create_map().cast("map<string,string>")),
                       lambda k, v: k.isin(*PERMITTED))
    old = F.map_filter(F.coalesce(F.col(response), F.create_map().cast("map<string,string>")),
                       lambda k, v: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(old, new)


def resolve(records: DataFrame) -> DataFrame:
    """``records``: record_id long, kind ('response' or 'revisit'), url, time
    long, http_status int, headers map<string,string> with lower-case names,
    payload string.  One row per revisit: record_id, url, canonical_url, time,
    refers_to, status, headers, payload."""
    named = records.withColumn("canonical_url", canonical_url(F.col("url")))
    full = (F.col("kind") == "response") & (F.col("http_status") == 200) & F.col("payload").isNotNull()
    light = cut_lineage(named.filter(F.col("canonical_url").isNotNull()).select(
        "canonical_url", "time", "record_id", full.alias("full"), (F.col("kind") == "revisit").alias("revisit"))
        .filter("full or revisit"), "warc-times")
    cuts = light.select(F.percentile_approx("time", [i / SLICES for i in range(1, SLICES)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    cut_points = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    sliced = light.withColumn("slice", F.size(F.filter(cut_points, lambda c: c < F.col("time"))))
    answer = F.when(F.col("full"), F.struct("time", "record_id"))

    last = sliced.filter("full").groupBy("canonical_url", "slice").agg(F.max(F.struct("time", "record_id")).alias("own"))
    present = sliced.filter("revisit").select("canonical_url", "slice").distinct()
    before = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (present.join(last, ["canonical_url", "slice"], "full")  # at most SLICES rows a URL
               .withColumn("carried", F.last("own", True).over(before))
               .select("canonical_url", "slice", "carried"))
    earlier = Window.partitionBy("canonical_url", "slice").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    within = sliced.withColumn("found", F.max(answer).over(earlier)).filter("revisit").drop("full", "revisit")
    # a record is named by its id, URL and time: ids may repeat
    found = (within.join(carried, ["canonical_url", "slice"], "left")
             .select("record_id", "canonical_url", "time", F.coalesce("found", "carried").alias("to")).distinct()
             .select(F.col("record_id").alias("of_id"), F.col("canonical_url").alias("of_url"), F.col("time").alias("of_time"),
                     F.col("to.record_id").alias("refers_to"), F.col("to.time").alias("to_time")))
    body = F.struct("payload", F.array_sort(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>")))).alias("headers"))
    responses = (named.filter(full & F.col("canonical_url").isNotNull())
                 .groupBy(F.col("record_id").alias("r_id"), F.col("canonical_url").alias("r_url"), F.col("time").alias("r_time"))
                 .agg(F.max(body).alias("page"))
                 .select("r_id", "r_url", "r_time", F.map_from_entries("page.headers").alias("old"), F.col("page.payload").alias("body")))
    revisits = named.filter(F.col("kind") == "revisit").select(
        "record_id", "url", "canonical_url", "time", F.col("headers").alias("new"))
    out = (revisits.join(found, F.col("record_id").eqNullSafe(F.col("of_id")) & (F.col("canonical_url") == F.col("of_url"))
                         & F.col("time").eqNullSafe(F.col("of_time")), "left")
           .join(responses, F.col("refers_to").eqNullSafe(F.col("r_id")) & (F.col("of_url") == F.col("r_url"))
                 & (F.col("to_time") == F.col("r_time")), "left"))
    good = F.col("to_time").isNotNull() & same_version("new", "old")
    return out.select(
        "record_id", "url", "canonical_url", "time", "refers_to",
        F.when(good, "resolved").when(F.col("to_time").isNotNull(), "mismatch").otherwise("missing").alias("status"),
        F.when(good, merged_headers("new", "old")).otherwise(F.col("new")).alias("headers"),
        F.when(good, F.col("body")).alias("payload"))


AGAIN = 500  # a page is asked for again so long after its capture


def records_of(pages: DataFrame) -> DataFrame:
    """Archive records of a table of pages: each page as a response captured at
    the time of its key, and a later answer that it was not modified.  Every
    seventh page has a modification date instead of a tag, every fifth tag is
    weak the second time."""
    key = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5(F.col("html")), F.lit('"'))
    dated = key % 7 == 0
    date = F.concat(F.lit("day "), F.length("html").cast("string"))
    validators = [F.lit("etag"), F.when(~dated, tag), F.lit("last-modified"), F.when(dated, date)]
    first = pages.select(
        (2 * key).alias("record_id"), F.lit("response").alias("kind"), "url", key.alias("time"),
        F.lit(200).alias("http_status"),
        F.map_filter(F.create_map(*validators, F.lit("content-length"), F.length("html").cast("string"),
                                  F.lit("date"), key.cast("string")), lambda k, v: v.isNotNull()).alias("headers"),
        F.col("html").alias("payload"))
    weak = F.when(key % 5 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)
    validators[1] = F.when(~dated, weak)
    again = pages.select(
        (2 * key + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", (key + AGAIN).alias("time"),
        F.lit(304).alias("http_status"),
        F.map_filter(F.create_map(*validators, F.lit("content-length"), F.lit("0"), F.lit("date"),
                                  (key + AGAIN).cast("string")), lambda k, v: v.isNotNull()).alias("headers"),
        F.lit(None).cast("string").alias("payload"))
    return first.unionByName(again)


def resolved_pages(pages: DataFrame) -> DataFrame:
    """One row per page: how its later not-modified answer resolves."""
    out = resolve(records_of(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                                          F.col("html").cast("string"))))
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.select(
        F.floor(F.col("record_id") / 2).cast("long").alias("page_id"), "canonical_url",
        F.floor(F.col("refers_to") / 2).cast("long").alias("refers_to"), "status",
        F.length("payload").cast("long").alias("n_payload"), F.md5("payload").alias("payload_md5"),
        F.array_join(pairs, ";").alias("headers"))


ORACLE = """
WITH cleaned AS (
  SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z]+://', '') AS u FROM pages
), split AS (
  SELECT page_id, html,
    regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^www\\.', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    regexp_replace(regexp_replace(regexp_extract(u, '\\?(.*)$', 1), '(^|&)utm_[a-z]+=[^&]*', '', 'g'), '^&', '') AS q
  FROM cleaned
), page AS (
  SELECT page_id, html, CASE WHEN host <> '' THEN host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS c,
    CASE WHEN page_id % 7 <> 0 THEN '"' || md5(html) || '"' END AS tag,
    CASE WHEN page_id % 7 = 0 THEN 'day ' || length(html) END AS day
  FROM split
), met AS (
  SELECT v.*, r.page_id AS r_id, r.html AS r_html, r.tag AS r_tag, r.day AS r_day
  FROM page v ASOF LEFT JOIN (SELECT * FROM page WHERE html IS NOT NULL AND c IS NOT NULL) r
    ON v.c = r.c AND v.page_id + 500 > r.page_id
), judged AS (
  SELECT *, r_id IS NOT NULL AND
    CASE WHEN tag IS NOT NULL THEN coalesce(tag = r_tag, false) ELSE coalesce(day = r_day, false) END AS good
  FROM met
)
SELECT page_id, c AS canonical_url, r_id AS refers_to,
  CASE WHEN good THEN 'resolved' WHEN r_id IS NOT NULL THEN 'mismatch' ELSE 'missing' END AS status,
  CASE WHEN good THEN length(r_html) END AS n_payload, CASE WHEN good THEN md5(r_html) END AS payload_md5,
  'content-length=' || CASE WHEN good THEN length(r_html) ELSE 0 END || ';date=' || (page_id + 500)
  || coalesce(';etag=' || CASE WHEN page_id % 5 = 0 THEN 'W/' || tag ELSE tag END, '')
  || coalesce(';last-modified=' || day, '') AS headers
FROM judged
"""
