"""Resolution of not-modified revisit records against the latest earlier full response.

Records are rows (record_id, url, ts, kind 'response' or 'revisit', etag, last_modified, headers). A
revisit finds, by canonical URL, the full response with the greatest ts below its own (of equal ts the
greatest record_id). Its validators must agree: the entity tag if it has one (weak comparison), else the
modification date; without either it is not accepted. The merged record has the response's headers, and of
the revisit's those that a not-modified answer may renew.

The as-of join works by time buckets, so that a URL with a third of all records is not one task's work:
inside a bucket by a window, across buckets by the last response of each (URL, bucket), of which a URL has
one row per bucket.

Defined cases: a null URL or ts resolves nothing (status no_earlier_response); null headers count as none;
of repeated records each revisit gives a row; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Records in a time bucket, about.
BUCKET_ROWS = 20_000
#: Fixed by the HTTP caching rules: headers that describe the body and are never renewed by a 304.
KEPT_HEADERS = ("content-length", "content-type", "content-encoding", "content-range", "transfer-encoding")


def canonical_url(url: F.Column) -> F.Column:
    """Host in lower case without 'www.' or default port; no scheme, fragment, tracking parameters or final slash."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, "^[^/?]*", 0)), "^www[.]", ""), ":(80|443)$", "")
    rest = F.regexp_replace(F.regexp_extract(u, "^[^/?]*(.*)$", 1), "([?&])(utm_[a-z]+|ref)=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, "([?&])&+", "$1"), "[?&/]+$", "")
    return F.concat(host, rest)


def bucket_width(records: DataFrame) -> int:
    """Span of ts that holds about BUCKET_ROWS records."""
    r = records.agg(F.count("ts").alias("n"), (F.max("ts") - F.min("ts")).alias("span")).first()
    return max(1, int((r["span"] or 0) * BUCKET_ROWS / max(r["n"], 1)))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, canon, status (resolved, validator_mismatch, no_earlier_response),
    response_id and the merged headers (of a resolved record)."""
    width = bucket_width(records)
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("canon"), F.col("ts").cast("long").alias("ts"),
        "kind", "etag", "last_modified", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"))
    rows = rows.withColumn("bucket", F.floor(F.col("ts") / width))
    place = F.when(F.col("kind") == "response", F.struct("ts", "record_id"))
    known = rows.where("canon IS NOT NULL AND ts IS NOT NULL").select("record_id", "canon", "ts", "kind", "bucket", place.alias("full"))
    inside = Window.partitionBy("canon", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    near = known.withColumn("near", F.max("full").over(inside)).where("kind = 'revisit'")
    lasts = known.groupBy("canon", "bucket").agg(F.max("full").alias("last"))
    earlier = Window.partitionBy("canon").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("canon", "bucket", F.max("last").over(earlier).alias("carried"))
    found = (near.join(carried, ["canon", "bucket"])
             .select("record_id", "canon", "ts", F.coalesce("near", "carried").alias("full")).where("full IS NOT NULL").distinct()
             .select("record_id", "canon", "ts", F.col("full.record_id").alias("response_id"), F.col("full.ts").alias("r_ts")))
    revisits = rows.where("kind = 'revisit'").select("record_id", "canon", "ts", "etag", "last_modified", "headers")
    # a response is named by its id, URL and time together, as ids may repeat
    full = (rows.where("kind = 'response'").dropDuplicates(["record_id", "canon", "ts"])
            .select(F.col("record_id").alias("f_id"), F.col("canon").alias("f_canon"), F.col("ts").alias("f_ts"), F.col("etag").alias("r_etag"),
                    F.col("last_modified").alias("r_modified"), F.col("headers").alias("r_headers")))
    # found first, so that the unresolved do not meet under one null key
    resolved = found.join(full, F.col("response_id").eqNullSafe(F.col("f_id")) & (F.col("canon") == F.col("f_canon")) & (F.col("r_ts") == F.col("f_ts"))).select(
        F.col("record_id").alias("w_id"), F.col("canon").alias("w_canon"), F.col("ts").alias("w_ts"), F.lit(True).alias("has_full"),
        "response_id", "r_etag", "r_modified", "r_headers")
    joined = revisits.join(resolved, F.col("record_id").eqNullSafe(F.col("w_id")) & (F.col("canon") == F.col("w_canon")) & (F.col("ts") == F.col("w_ts")), "left")
    weak = lambda c: F.regexp_replace(F.trim(c), "^W/", "")
    agrees = F.when(F.col("etag").isNotNull(), F.coalesce(weak(F.col("etag")) == weak(F.col("r_etag")), F.lit(False))) \
        .otherwise(F.coalesce(F.col("last_modified") == F.col("r_modified"), F.lit(False)))
    status = F.when(F.col("has_full").isNull(), "no_earlier_response").when(agrees, "resolved").otherwise("validator_mismatch")
    lowered = lambda c: F.transform_keys(c, lambda k, _: F.lower(k))
    renewed = F.map_filter(lowered(F.col("headers")), lambda k, _: ~k.isin(*KEPT_HEADERS))
    old = F.map_filter(lowered(F.col("r_headers")), lambda k, _: ~F.map_contains_key(renewed, k))
    return joined.withColumn("status", status).select(
        "record_id", "canon", "status", "response_id", F.when(F.col("status") == "resolved", F.map_concat(old, renewed)).alias("headers"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Captures made from a page table: for each page its response, and a later not-modified answer with
    the page's entity tag or date, in part stale or too early, under the same URL."""
    p = F.col("page_id")
    tag, size = F.concat(F.lit('"'), F.md5("html"), F.lit('"')), F.octet_length("html").cast("string")
    date = F.concat(F.lit("day "), (p % 365).cast("string"))
    response = pages.select(
        (p * 2).alias("record_id"), "url", (p * 2).alias("ts"), F.lit("response").alias("kind"), tag.alias("etag"), date.alias("last_modified"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), size, F.lit("ETag"), tag,
                     F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"))
    revisit = pages.select(
        (p * 2 + 1).alias("record_id"), "url", F.when(p % 11 == 0, p * 2 - 1).otherwise(p * 2 + 5001).alias("ts"), F.lit("revisit").alias("kind"),
        F.when(p % 5 == 0, F.lit(None).cast("string")).when(p % 7 == 0, F.lit('"stale"')).otherwise(F.concat(F.lit("W/"), tag)).alias("etag"),
        F.when(p % 5 == 0, date).alias("last_modified"),
        F.create_map(F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.lit("max-age=120")).alias("headers"))
    return response.unionByName(revisit)


QUERY_COLUMNS = ("content-type", "content-length", "etag", "cache-control")


def resolved_pages(pages: DataFrame) -> DataFrame:
    """The resolved records of a page table with their merged headers as columns (response_id -1: none)."""
    out = resolve_revisits(records_of_pages(pages))
    return out.select("record_id", "canon", "status", F.coalesce("response_id", F.lit(-1)).alias("response_id"),
                      *(F.col("headers")[h].alias(h.replace("-", "_")) for h in QUERY_COLUMNS))


RESOLVED_PAGES_SQL = r"""
WITH u AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
h AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*', 0)), '^www[.]', ''), ':(80|443)$', '') AS host,
        regexp_replace(regexp_extract(bare, '^[^/?]*(.*)$', 1), '([?&])(utm_[a-z]+|ref)=[^&]*', '\1', 'g') AS tail FROM u),
c AS (SELECT page_id, host || regexp_replace(regexp_replace(tail, '([?&])&+', '\1', 'g'), '[?&/]+$', '') AS canon,
        '"' || md5(html) || '"' AS tag, CAST(strlen(html) AS VARCHAR) AS size, 'day ' || CAST(page_id % 365 AS VARCHAR) AS date FROM h),
r AS (SELECT page_id * 2 AS response_id, page_id * 2 AS ts, canon, tag AS r_etag, date AS r_date, size FROM c),
v AS (SELECT page_id * 2 + 1 AS record_id, canon, CASE WHEN page_id % 11 = 0 THEN page_id * 2 - 1 ELSE page_id * 2 + 5001 END AS ts,
        CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"stale"' ELSE tag END AS etag,
        CASE WHEN page_id % 5 = 0 THEN date END AS last_modified FROM c),
j AS (SELECT v.*, r.response_id, r_etag, r_date, size FROM v ASOF LEFT JOIN r ON v.canon = r.canon AND v.ts > r.ts),
s AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_earlier_response'
        WHEN CASE WHEN etag IS NOT NULL THEN etag = r_etag ELSE coalesce(last_modified = r_date, false) END THEN 'resolved'
        ELSE 'validator_mismatch' END AS status FROM j)
SELECT record_id, canon, status, coalesce(response_id, -1) AS response_id, CASE WHEN status = 'resolved' THEN 'text/html' END AS content_type,
  CASE WHEN status = 'resolved' THEN size END AS content_length, CASE WHEN status = 'resolved' THEN r_etag END AS etag,
  CASE WHEN status = 'resolved' THEN 'max-age=120' END AS cache_control
FROM s
"""
