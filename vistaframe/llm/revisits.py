"""WARC revisits: a not-modified capture takes its body from the latest earlier full response of the same canonical URL.

The as-of join is two windows. Inside a slice of time of one URL, each revisit sees the last full response before it. The
last response of each slice is then carried over the URL's slices, one row a slice, so a URL with a third of all captures is
spread over its slices and no window holds a body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistaframe.llm.common import table

# The headers that a 304 response may change in a stored one.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that name no other page.
TRACKING = "^(utm_.*|ref)$"
#: Seconds in a slice.
SLICE = 86_400


def canonical_url(url: Column) -> Column:
    """Host in lower case without www., default port, scheme, fragment and last slash; other parameters in order, tracking ones gone."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    parameters = F.filter(F.split(F.regexp_extract(bare, "[?](.*)$", 1), "&"), lambda p: (p != "") & ~F.regexp_extract(p, "^[^=]*", 0).rlike(TRACKING))
    query = F.array_join(F.array_sort(parameters), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def resolve_revisits(captures: DataFrame, slice_seconds: int = SLICE) -> DataFrame:
    """A row for each revisit of captures: capture_id, url_key, state, response_id, digest, headers.

    captures: capture_id, url, captured_at (seconds), kind ("response" or "revisit"), headers (map, names in lower case) and
    digest. The response is the latest one strictly before the revisit; of several at one time, the one with the largest
    capture_id. state is "resolved" if the validators fit: equal etags where both have one, else equal last-modified where
    both have one; "unverified" if neither can be compared; "mismatch" if they differ; "missing" without an earlier
    response. Only "resolved" and "unverified" have a digest and headers: the response's, with the permitted ones of the
    revisit in their place. Captures without url or time are left out as responses and "missing" as revisits. Repeated
    rows are resolved each; other columns are not read.
    """
    rows = captures.select("capture_id", canonical_url(F.col("url")).alias("url_key"), "captured_at", "kind", "headers", "digest")
    rows = rows.withColumn("slice", F.floor(F.col("captured_at") / slice_seconds))
    dated = rows.where("url_key IS NOT NULL AND captured_at IS NOT NULL")
    full = F.when(F.col("kind") == "response", F.struct("capture_id", "headers", "digest"))
    before = Window.partitionBy("url_key", "slice").orderBy("captured_at", F.col("kind").desc(), "capture_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = dated.withColumn("_inside", F.last(full, ignorenulls=True).over(before)).where("kind = 'revisit'")
    responses = dated.where("kind = 'response'")
    latest = F.max_by(F.struct("capture_id", "headers", "digest"), F.struct("captured_at", "capture_id"))
    needed = dated.groupBy("url_key", "slice").agg(F.max(F.col("kind") == "revisit").alias("_asks"))
    carried = needed.join(responses.groupBy("url_key", "slice").agg(latest.alias("_latest")), ["url_key", "slice"], "left")
    slices = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.withColumn("_earlier", F.last("_latest", ignorenulls=True).over(slices)).where("_asks").select("url_key", "slice", "_earlier")
    found = inside.join(carried, ["url_key", "slice"]).withColumn("_response", F.coalesce("_inside", "_earlier"))
    lost = rows.where("kind = 'revisit' AND (url_key IS NULL OR captured_at IS NULL)").withColumn("_response", F.lit(None).cast(found.schema["_response"].dataType))
    both = found.select("capture_id", "url_key", "headers", "_response").unionByName(lost.select("capture_id", "url_key", "headers", "_response"))

    def fits(name: str) -> Column:
        return F.try_element_at("headers", F.lit(name)) == F.try_element_at("_response.headers", F.lit(name))

    fit = F.coalesce(fits("etag"), fits("last-modified"))
    state = F.when(F.col("_response").isNull(), "missing").when(fit.isNull(), "unverified").when(fit, "resolved").otherwise("mismatch")
    changed = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter("_response.headers", lambda k, v: ~F.map_contains_key(changed, k))
    taken = F.col("state").isin("resolved", "unverified")
    return both.withColumn("state", state).select(
        "capture_id", "url_key", "state", F.col("_response.capture_id").alias("response_id"), F.when(taken, F.col("_response.digest")).alias("digest"),
        F.when(taken, F.map_concat(kept, changed)).alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl record of pages: each page is a full response, an hour after the one before, and is asked for again later.

    Of the later requests, every seventh comes from another server state (its etag differs), every fifth page has no etag,
    and every eleventh request comes before its page.
    """
    at = F.col("page_id") * 3600
    tag = F.when(F.col("page_id") % 5 == 0, F.lit(None)).otherwise(F.md5("html"))
    modified = F.concat(F.lit("m"), F.floor(F.col("page_id") / 2).cast("string"))

    def headers(date: Column, etag: Column, control: str, kind: str | None) -> Column:
        entries = [F.struct(F.lit("date").alias("k"), date.cast("string").alias("v")), F.struct(F.lit("etag").alias("k"), etag.alias("v")), F.struct(F.lit("last-modified").alias("k"), modified.alias("v")), F.struct(F.lit("cache-control").alias("k"), F.lit(control).alias("v")), F.struct(F.lit("content-type").alias("k"), F.lit(kind).alias("v"))]
        return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["v"].isNotNull()))

    again = at + F.when(F.col("page_id") % 11 == 0, -1800).otherwise(1800 + (F.col("page_id") % 3) * 43_200)
    other = F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("x"), tag)).otherwise(tag)
    response = pages.select((F.col("page_id") * 2).alias("capture_id"), "url", at.alias("captured_at"), F.lit("response").alias("kind"), headers(at, tag, "max-age=60", "text/html").alias("headers"), F.md5("html").alias("digest"))
    revisit = pages.select((F.col("page_id") * 2 + 1).alias("capture_id"), "url", again.alias("captured_at"), F.lit("revisit").alias("kind"), headers(again, other, "max-age=600", None).alias("headers"), F.lit(None).cast("string").alias("digest"))
    return response.unionByName(revisit)


def op1_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolves the revisits of all pages; headers as text in order of their names."""
    found = resolve_revisits(captures_of(table(spark, sf_dir, "pages")))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.withColumn("headers", text)


QUERIES = {"op1_revisit_resolution": op1_revisit_resolution}
ORACLES = {
    "op1_revisit_resolution": r"""
WITH bare AS (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM pages),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(b, '^[^/?]*')), '^www[.]', ''), ':(80|443)$', '') || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '[?](.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(regexp_extract(p, '^[^=]*'), '^(utm_.*|ref)$'))), '&') AS query
  FROM bare
),
keyed AS (
  SELECT page_id, CASE WHEN query <> '' THEN place || '?' || query ELSE place END AS url_key, md5(html) AS digest, page_id * 3600 AS at,
    CASE WHEN page_id % 5 <> 0 THEN md5(html) END AS etag, 'm' || (page_id // 2)::VARCHAR AS modified,
    page_id * 3600 + CASE WHEN page_id % 11 = 0 THEN -1800 ELSE 1800 + (page_id % 3) * 43200 END AS again
  FROM parts
),
asked AS (SELECT *, CASE WHEN page_id % 7 = 0 THEN 'x' || etag ELSE etag END AS asked_etag FROM keyed),
found AS (
  SELECT a.page_id, a.url_key, a.again, a.asked_etag, a.modified AS asked_modified, r.page_id AS r_id, r.digest, r.etag, r.modified
  FROM asked a LEFT JOIN keyed r ON a.url_key = r.url_key AND r.at < a.again
  QUALIFY row_number() OVER (PARTITION BY a.page_id ORDER BY r.at DESC NULLS LAST, r.page_id DESC) = 1
),
judged AS (
  SELECT *, CASE WHEN r_id IS NULL THEN 'missing' WHEN coalesce(asked_etag = etag, asked_modified = modified) THEN 'resolved' ELSE 'mismatch' END AS state FROM found
)
SELECT page_id * 2 + 1 AS capture_id, url_key, state, r_id * 2 AS response_id, CASE WHEN state = 'resolved' THEN digest END AS digest,
  CASE WHEN state = 'resolved' THEN 'cache-control=max-age=600;content-type=text/html;date=' || again::VARCHAR
    || coalesce(';etag=' || coalesce(asked_etag, etag), '') || ';last-modified=' || modified END AS headers
FROM judged"""
}
