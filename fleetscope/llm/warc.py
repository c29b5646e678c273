"""Resolution of WARC not-modified revisits: an as-of join by canonical URL to the latest earlier full response.

Every revisit record (an answer 304) is looked up among the full responses of its canonical URL: the one with the latest
time that is not later than the revisit's counts (of several at that time, the one with the largest record id). Its
validators must agree: the entity tags by weak comparison if the revisit has one, else the times of last modification.
Where they do, the headers that a 304 may update replace those of the stored response; all other headers of the revisit
are ignored.

The join sorts responses and revisits together by range partitions of (URL, time), so that a URL with a third of all
records lies in many partitions. In a partition a window carries the last response forward; from partition to partition
it is carried by one row for each URL and partition. No pairs are formed and no URL is read by one task.

Defined results: status ``resolved``, ``mismatch`` (the validators differ), ``no_validator`` (the revisit has none, or the
response lacks the one to compare), ``no_response`` (nothing earlier, or a null URL or time); records of other kinds are
left out; null headers count as none; repeated revisits are each resolved; an empty table gives an empty table; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetscope.llm.common import table, written

# Header fields that an answer 304 may carry for the stored response (RFC 9110, 15.4.5; RFC 9111, 3.2).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# Query parameters that only track.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|msclkid|mc_cid|mc_eid|sessionid"


def canonical_url(url: Column) -> Column:
    """Without scheme, fragment, user, default port, ``www.`` or ``m.``, tracking parameters, ``index.html`` and a
    closing slash; the host in lower case and the other parameters sorted."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(?:80|443)$", ""), r"^(?:www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/index\.html?$", "/")
    path = F.regexp_replace(path, "/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"(?i)^(?:{TRACKING})(?:=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _lower(headers: Column) -> Column:
    """Header names in lower case; of several spellings of a name, the value that sorts last."""
    entries = F.array_sort(F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
                                       lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    last = F.filter(entries, lambda e, i: F.coalesce(F.get(entries, i + 1)["key"] != e["key"], F.lit(True)))
    return F.map_from_entries(last)


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, url_key, status, response_id, headers) of every revisit of ``records``: record_id, url, ts, kind
    (``response`` or ``revisit``) and headers map<string,string>."""
    known = records.filter(F.col("kind").isin("response", "revisit")).select(
        "record_id", canonical_url(F.col("url")).alias("key"), "ts", (F.col("kind") == "revisit").alias("asks"),
        _lower(F.col("headers")).alias("headers"))
    # responses go before revisits of the same time; a record without URL or time is neither found nor resolved
    order = ["ts", "asks", "record_id"]
    placed = written(known.filter("key is not null and ts is not null").repartitionByRange("key", *order)
                     .withColumn("part", F.spark_partition_id()), "warc-placed")
    answer = F.when(~F.col("asks"), F.struct(F.col("record_id").alias("id"), F.col("headers").alias("headers")))
    within = W.partitionBy("key", "part").orderBy(*order)
    rows = placed.withColumn("found", F.last(answer, ignorenulls=True).over(within)).filter("asks")
    lasts = placed.filter(~F.col("asks")).groupBy("key", "part").agg(F.max_by(
        F.struct(F.col("record_id").alias("id"), F.col("headers").alias("headers")), F.struct(*order)).alias("last"))
    spans = placed.select("key", "part").distinct().join(lasts, ["key", "part"], "left")
    before = W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = written(spans.select("key", "part", F.last("last", ignorenulls=True).over(before).alias("carried")), "warc-carried")
    rows = written(rows, "warc-rows").join(carried, ["key", "part"]).select(
        "record_id", "key", "headers", F.coalesce("found", "carried").alias("found"))
    lost = known.filter("asks and (key is null or ts is null)")
    rows = rows.unionByName(lost.select("record_id", "key", "headers", F.lit(None).cast(rows.schema["found"].dataType).alias("found")))

    own, stored = F.col("headers"), F.col("found.headers")
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    agree = F.when(tag(own).isNotNull(), tag(own) == tag(stored)).otherwise(own["last-modified"] == stored["last-modified"])
    status = (F.when(F.col("found").isNull(), "no_response").when(agree.isNull(), "no_validator")
              .when(agree, "resolved").otherwise("mismatch"))
    update = F.map_filter(own, lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(update), k)), update)
    return rows.withColumn("status", status).select(
        "record_id", F.col("key").alias("url_key"), "status",
        F.when(F.col("status") == "resolved", F.col("found.id")).alias("response_id"),
        F.when(F.col("status") == "resolved", merged).alias("headers"))


# -- the query -----------------------------------------------------------------------------------------------------

#: Seconds between two captures, and until a page is asked for again.
EVERY, AGAIN = 60, 7 * 86_400


def records_of(pages: DataFrame) -> DataFrame:
    """WARC records made from ``pages``: a full response for each page, captured in the order of the ids, and AGAIN
    seconds later a revisit of its URL with the entity tag of that page."""
    tag = F.md5("html")
    at = F.col("page_id") * EVERY
    headers = lambda kind, date: F.create_map(
        F.lit("ETag"), F.concat(F.lit("W/") if kind == "revisit" else F.lit(""), F.lit('"'), tag, F.lit('"')),
        F.lit("Date"), date.cast("string"), F.lit("Content-Length"),
        F.lit("0") if kind == "revisit" else F.octet_length("html").cast("string"))
    one = lambda kind, date: F.struct(
        F.concat(F.lit(f"{kind}-"), F.col("page_id").cast("string")).alias("record_id"), "url", date.alias("ts"),
        F.lit(kind).alias("kind"), headers(kind, date).alias("headers"))
    return pages.select(F.explode(F.array(one("response", at), one("revisit", at + AGAIN))).alias("r")).select("r.*")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve(records_of(table(spark, sf_dir, "pages")))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("headers")),
                                    lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return found.select("record_id", "url_key", "status", "response_id", text.alias("headers"))


ORACLE_SQL = r"""
WITH rest AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS r
  FROM pages),
parts AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(r, '^[^/?]*')), '^.*@', ''), ':(80|443)$', ''),
                        '^(www|m)\.', '') AS host,
         regexp_replace(regexp_replace(regexp_extract(r, '^[^/?]*([^?]*)', 1), '/index\.html?$', '/'), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(r, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(
           p, '^(?i:utm_[a-z]+|ref|fbclid|gclid|msclkid|mc_cid|mc_eid|sessionid)(=|$)'))) AS kept
  FROM rest),
keyed AS (
  SELECT page_id, md5(html) AS tag, strlen(html) AS bytes,
         host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url_key
  FROM parts),
found AS (
  SELECT q.page_id, q.url_key, q.tag, arg_max(struct_pack(id := p.page_id, tag := p.tag, bytes := p.bytes),
         struct_pack(ts := p.page_id * 60, id := 'response-' || p.page_id)) AS f
  FROM keyed q LEFT JOIN keyed p ON p.url_key = q.url_key AND p.page_id * 60 <= q.page_id * 60 + 604800
  GROUP BY ALL)
SELECT 'revisit-' || page_id AS record_id, url_key,
       CASE WHEN f IS NULL THEN 'no_response' WHEN f.tag = tag THEN 'resolved' ELSE 'mismatch' END AS status,
       CASE WHEN f.tag = tag THEN 'response-' || f.id END AS response_id,
       CASE WHEN f.tag = tag THEN 'content-length=' || f.bytes || ';date=' || (page_id * 60 + 604800)
            || ';etag=W/"' || tag || '"' END AS headers
FROM found
"""
