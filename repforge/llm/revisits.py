"""Not-modified revisits of a crawl, resolved to the response they confirm.

A revisit record (status 304) has no body: the server said that what was
captured before still holds. Each one is joined, as of its time, with the
latest earlier full response (status 200) of the same canonical URL. Its
validators must agree with that response's; then the response's headers,
updated with the headers that a 304 may carry, are the revisit's.

The as-of join is a window over the distinct times of each URL, cut into
time buckets for URLs with many records; the last response of each bucket is
carried into the next ones. No pairs of records are formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repforge.llm.common import Scratch, join_owners

# Headers that a 304 response may update (lower case).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that name no other document.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref|sessionid)(=|$)"

#: Distinct times of one URL that one window sorts, on average.
BUCKET_ROWS = 10_000

RECORDS = ("record_id long, url string, ts long, status int, headers map<string, string>, digest string")


def canonical_url(url: Column) -> Column:
    """Host (lower case, without ``www.`` and default port), path (without a
    last slash) and the query's other than tracking parameters, sorted.
    Scheme and fragment are dropped. Null for a text that is no URL."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, r"^[^/?#]*//[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(
        F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))))


def _named(headers: Column) -> Column:
    """Lower-case names; of names that differ in case only the last counts."""
    entries = F.coalesce(F.map_entries(headers), F.expr("array()").cast("array<struct<key:string,value:string>>"))
    lower = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.aggregate(lower, F.expr("map()").cast("map<string,string>"), lambda m, e: F.map_concat(
        F.map_filter(m, lambda k, _: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers, updated with those a 304 may carry."""
    new = F.map_filter(revisit, lambda k, _: k.isin(*PERMITTED))
    return F.map_concat(F.map_filter(response, lambda k, _: ~F.map_contains_key(new, k)), new)


def validators(response: Column, revisit: Column) -> Column:
    """'resolved', 'mismatch' or 'unverified': entity tags (weak comparison)
    decide where both have one, else the dates of last modification."""
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    date = lambda h: h["last-modified"]
    said = lambda same: F.when(same, "resolved").otherwise("mismatch")
    return (F.when(tag(response).isNotNull() & tag(revisit).isNotNull(), said(tag(response) == tag(revisit)))
            .when(date(response).isNotNull() & date(revisit).isNotNull(), said(date(response) == date(revisit)))
            .otherwise("unverified"))


def latest_before(times: DataFrame, sources: DataFrame) -> DataFrame:
    """(key, ts, source_id) for the distinct (key, ts) of ``times``: the id of
    the latest source (key, ts, source_id) of the key before that time, or
    null. Keys with many times are cut into buckets of about BUCKET_ROWS."""
    line = (times.select("key", "ts", F.lit(None).cast("long").alias("source_id"), F.lit(0).alias("order"))
            .unionByName(sources.select("key", "ts", "source_id", F.lit(1).alias("order"))))
    # subtract and divide as decimals: times may span the whole range of long
    wide = "decimal(20,0)"
    crowded = (line.groupBy("key").agg(F.count("*").alias("n"), F.min("ts").cast(wide).alias("low"),
                                       F.max("ts").cast(wide).alias("high"))
               .filter(F.col("n") > BUCKET_ROWS)
               .select("key", "low", F.expr(f"ceil((high - low + 1) / ceil(n / {BUCKET_ROWS}))").alias("width")))
    cut = line.join(crowded, "key", "left").select(
        "key", "ts", "source_id", "order",
        F.coalesce(F.floor((F.col("ts").cast(wide) - F.col("low")) / F.col("width")).cast("long"),
                   F.lit(0).cast("long")).alias("bucket"))
    so_far = (Window.partitionBy("key", "bucket").orderBy("ts", "order")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = (cut.withColumn("found", F.last("source_id", ignorenulls=True).over(so_far))
              .filter("order = 0").select("key", "bucket", "ts", "found"))
    last = (cut.groupBy("key", "bucket").agg(
        F.max_by("source_id", F.when(F.col("order") == 1, F.col("ts"))).alias("last")))
    before = (Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    carried = last.select("key", "bucket", F.last("last", ignorenulls=True).over(before).alias("carried"))
    return (inside.join(carried, ["key", "bucket"])
            .select("key", "ts", F.coalesce("found", "carried").alias("source_id")))


def resolved(records: DataFrame) -> DataFrame:
    """Per revisit (status 304): record_id, url_key, ts, source_id, outcome,
    headers, digest.

    ``outcome`` is 'no_earlier' (then source_id is null), 'mismatch',
    'unverified' (no validator in common) or 'resolved'; only a resolved
    revisit gets the response's digest and merged headers, others keep their
    own headers. The latest earlier response is strictly earlier; of several
    at one time the largest record id counts. A record without a usable url
    or time meets nothing. Repeated rows repeat, null headers are empty,
    records of other statuses are ignored, so are extra columns; an empty
    table gives an empty result. Record ids of responses must be unique
    (of rows that repeat one, any one counts) and not null."""
    scratch = Scratch(records.sparkSession)
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("key"),
        F.col("ts").cast("long").alias("ts"), F.col("status"), F.col("headers"), F.col("digest"))
    usable = F.col("key").isNotNull() & F.col("ts").isNotNull()
    full = rows.filter((F.col("status") == 200) & usable & F.col("record_id").isNotNull())
    revisits = rows.filter(F.col("status") == 304)
    sources = full.groupBy("key", "ts").agg(F.max("record_id").alias("source_id"))
    times = revisits.filter(usable).select("key", "ts").distinct()
    found = scratch.save(latest_before(times, sources).filter(F.col("source_id").isNotNull()), "asof")
    # sources in use, with the number of their revisits
    placed = scratch.save(
        revisits.select("record_id", "key", "ts", _named(F.col("headers")).alias("own"))
        .join(found, ["key", "ts"], "left"), "placed")
    used = placed.groupBy("source_id").agg(F.count("*").alias("rows")).filter("source_id is not null")
    owners = scratch.save(
        used.join(full.select(F.col("record_id").alias("source_id"), _named(F.col("headers")).alias("theirs"),
                              "digest"), "source_id").dropDuplicates(["source_id"]), "sources")
    met = join_owners(placed.filter("source_id is not null"), owners, "source_id", "rows").select(
        "record_id", "key", "ts", "source_id", validators(F.col("theirs"), F.col("own")).alias("outcome"),
        "own", "theirs", "digest")
    sure = F.col("outcome") == "resolved"
    met = met.select("record_id", F.col("key").alias("url_key"), "ts", "source_id", "outcome",
                     F.when(sure, merged_headers(F.col("theirs"), F.col("own"))).otherwise(F.col("own")).alias("headers"),
                     F.when(sure, F.col("digest")).alias("digest"))
    alone = placed.filter("source_id is null").select(
        "record_id", F.col("key").alias("url_key"), "ts", "source_id", F.lit("no_earlier").alias("outcome"),
        F.col("own").alias("headers"), F.lit(None).cast("string").alias("digest"))
    return met.unionByName(alone)


def header_lines(headers: Column) -> Column:
    """Sorted 'name: value' lines."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(
        e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))), "\n")


# --- a crawl derived from the pages table ----------------------------------------

def crawl_of(pages: DataFrame) -> DataFrame:
    """Records of a crawl that visited every page four times, 10^9 apart:
    first a response (every 13th page: none); then a revisit, with the page's
    entity tag (every 5th: another one; every 7th: a weak one; every 11th:
    the date only); then, for every 3rd page a changed response, else a
    revisit; then a revisit by another spelling of the URL."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                     F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"))
    p = p.filter(F.col("page_id").isNotNull()).withColumn("visit", F.explode(F.sequence(F.lit(0), F.lit(3))))
    every = lambda n: F.col("page_id") % n == 0
    visit = F.col("visit")
    changed = F.concat(F.lit("c"), F.col("digest"))
    full = (visit == 0) | ((visit == 2) & every(3))
    now = F.when((visit >= 2) & every(3), changed).otherwise(F.col("digest"))
    tag = (F.when((visit == 1) & every(5), F.lit('"other"'))
           .when((visit == 1) & every(7), F.concat(F.lit('W/"'), now, F.lit('"')))
           .when(~((visit == 1) & every(11)), F.concat(F.lit('"'), now, F.lit('"'))))
    spelled = F.when(visit == 3, F.concat(F.lit("HTTP://WWW."), F.regexp_replace(
        "url", r"^[a-z]+://(www\.)?", ""), F.lit(""))).otherwise(F.col("url"))
    ts = F.col("page_id") + visit.cast("long") * 10**9
    headers = F.map_filter(F.create_map(
        F.lit("ETag"), tag, F.lit("Last-Modified"), F.concat(F.lit("day "), F.col("page_id").cast("string")),
        F.lit("Date"), ts.cast("string"), F.lit("Content-Type"),
        F.when(full, F.lit("text/html")).otherwise(F.lit("text/plain")),
        F.lit("Cache-Control"), F.when(visit == 3, F.lit("max-age=60"))), lambda _, v: v.isNotNull())
    return (p.filter(~((visit == 0) & every(13)))
            .select((F.col("page_id") * 4 + visit).alias("record_id"), spelled.alias("url"), ts.alias("ts"),
                    F.when(full, 200).otherwise(304).alias("status"), headers.alias("headers"),
                    F.when(full, now).alias("digest")))
