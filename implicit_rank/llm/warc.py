"""Not-modified revisit resolution of web captures.

Every revisit record is joined to the latest earlier full response of the same
canonical URL (an as-of join), its validators are checked against that
response, and the response's headers are updated with those that a
not-modified answer may change.

The as-of join is a sort and a fill, not a per-URL group: records are range
partitioned by (URL, time), the last response is filled forward inside each
partition, and one row per partition carries the open response of a URL that
goes on in the next. So a URL that holds a third of all records is as many
partitions as it needs. Page bodies are not part of the records and never move.

Records have the columns record_id (long), url, ts (long), kind (``response``
or ``revisit``), http_status, etag, last_modified, headers (map).

Defined cases: a response without URL, time or status 200 is nobody's
response; a revisit without URL or time finds none; of responses of one URL
and time the largest record_id counts, and a response at a revisit's own time
is not earlier; repeated rows are resolved one by one; null headers are an empty
map; other kinds are left out; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from implicit_rank.llm import common

# Header fields that a not-modified answer may update.
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning"]


def canonical(url) -> Column:
    """Scheme, ``www.``, default port, fragment, tracking parameters and closing slashes go; host in lower case."""
    url = F.regexp_replace(F.trim(url), r"#.*$", "")
    url = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[^/?]*", 0)), r"^www\.", "")
    rest = F.regexp_replace(url, r"^[^/?]*", "")
    rest = F.regexp_replace(rest, r"([?&])(utm_[a-z]+|ref)=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, r"&&+", "&"), r"\?&", "?")
    rest = F.regexp_replace(rest, r"[?&/]+$", "")
    return F.concat(F.regexp_replace(host, r":(80|443)$", ""), rest)


def _tag(etag: Column) -> Column:
    """An entity tag without the weak mark (validators are compared weakly)."""
    return F.regexp_replace(F.trim(etag), r"^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit.

    record_id, url_key, response_id, outcome, headers. outcome: ``resolved``
    (a validator agrees), ``unchecked`` (no validator on both sides),
    ``etag_differs``, ``modified_differs`` (no link is made then), or
    ``no_response``. An entity tag on both sides decides before the dates.
    headers: the response's with the permitted ones of the revisit, names in
    lower case; null if no link is made.
    """
    lower = F.transform_keys(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: F.lower(k))
    revisit = F.col("kind") == "revisit"
    full = (F.col("kind") == "response") & (F.col("http_status") == 200) & F.col("ts").isNotNull() & F.col("url").isNotNull()
    rows = (records.filter(F.col("kind").isin("response", "revisit"))
            .select(canonical(F.col("url")).alias("url_key"), F.col("ts").cast("long").alias("ts"),
                    F.when(revisit, 0).otherwise(1).alias("side"), F.col("record_id").cast("long").alias("record_id"),
                    "etag", "last_modified", lower.alias("headers"), full.alias("is_full"))
            .withColumn("full", F.when(F.col("is_full"), F.struct("record_id", "etag", "last_modified", "headers")))
            .drop("is_full"))
    order = ["url_key", "ts", "side", "record_id"]
    placed = common.save(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "warc-sorted")

    inside = Window.partitionBy("part", "url_key").orderBy("ts", "side", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    filled = placed.withColumn("local", F.last("full", ignorenulls=True).over(inside))
    # one row per partition: its first and last URL and the last response of the latter
    has = F.col("full").isNotNull()
    latest = placed.groupBy("part").agg(
        F.min("url_key").alias("first_url"), F.max("url_key").alias("last_url"),
        F.max(F.when(has, F.col("url_key"))).alias("full_url"),
        F.max_by("full", F.when(has, F.struct("url_key", "ts", "record_id"))).alias("full"))
    opened = latest.select("part", F.col("last_url").alias("url_key"), F.lit(1).alias("step"),
                           F.when(F.col("full_url") == F.col("last_url"), F.col("full")).alias("full"))
    asked = latest.select("part", F.col("first_url").alias("url_key"), F.lit(0).alias("step"),
                          F.lit(None).cast(placed.schema["full"].dataType).alias("full"))
    before = Window.partitionBy("url_key").orderBy("part", "step").rowsBetween(Window.unboundedPreceding, -1)
    carried = (opened.unionByName(asked).withColumn("carried", F.last("full", ignorenulls=True).over(before))
               .filter((F.col("step") == 0) & F.col("carried").isNotNull())
               .select(F.col("part").alias("c_part"), F.col("url_key").alias("c_url"), "carried"))
    joined = (filled.filter("side = 0")
              .join(F.broadcast(carried), (F.col("part") == F.col("c_part")) & (F.col("url_key") == F.col("c_url")), "left")
              .withColumn("found", F.when(F.col("ts").isNotNull() & F.col("url_key").isNotNull(), F.coalesce("local", "carried"))))
    return joined.select("record_id", "url_key", *_checked())


def _checked() -> list[Column]:
    found = F.col("found")
    tags = F.col("etag").isNotNull() & found["etag"].isNotNull()
    dates = F.col("last_modified").isNotNull() & found["last_modified"].isNotNull()
    outcome = (F.when(found.isNull(), "no_response")
               .when(tags, F.when(_tag(F.col("etag")) == _tag(found["etag"]), "resolved").otherwise("etag_differs"))
               .when(dates, F.when(F.col("last_modified") == found["last_modified"], "resolved").otherwise("modified_differs"))
               .otherwise("unchecked"))
    linked = outcome.isin("resolved", "unchecked")
    allowed = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(found["headers"], lambda k, v: ~F.map_contains_key(allowed, k))
    return [F.when(linked, found["record_id"]).alias("response_id"), outcome.alias("outcome"),
            F.when(linked, F.map_concat(kept, allowed)).alias("headers")]


def captures(pages: DataFrame) -> DataFrame:
    """Capture records derived from a table of pages (page_id, url, html).

    Of every page: a full response and a later revisit of a variant of its URL.
    Every third page is captured anew before a second revisit that still names
    the first validator; one in four is revisited before its first response;
    every fifth response has no entity tag.
    """
    page, digest = F.col("page_id"), F.md5(F.coalesce("html", F.lit("")))
    tag = F.when(page % 5 != 0, F.concat(F.lit('"'), digest, F.lit('"')))
    day = (page % 28).cast("string")

    def record(number, ts, kind, etag, modified, url):
        headers = F.create_map(
            F.lit("Content-Type"), F.when(F.lit(kind == "response"), F.lit("text/html")).otherwise("text/plain"),
            F.lit("Cache-Control"), F.concat(F.lit("max-age="), F.lit(number).cast("string")),
            F.lit("Date"), ts.cast("string"))
        return F.struct((page * 8 + number).alias("record_id"), url.alias("url"), ts.cast("long").alias("ts"),
                        F.lit(kind).alias("kind"), F.lit(200 if kind == "response" else 304).alias("http_status"),
                        etag.alias("etag"), modified.alias("last_modified"), headers.alias("headers"))

    url, t = F.col("url"), page * 100
    variant = F.concat("url", F.lit("#again"))
    every = [
        F.when(page % 4 == 1, record(0, t - 7, "revisit", tag, day, url)),
        record(1, t, "response", tag, day, url),
        record(2, t + 5, "revisit", F.concat(F.lit("W/"), tag), day, variant),
        F.when(page % 3 == 0, record(3, t + 10, "response", F.concat(F.lit('"2'), digest, F.lit('"')), F.lit("again"), variant)),
        F.when(page % 3 == 0, record(4, t + 15, "revisit", tag, day, url)),
    ]
    return pages.select(F.explode(F.filter(F.array(*every), lambda x: x.isNotNull())).alias("r")).select("r.*")
