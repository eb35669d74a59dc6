"""Not-modified revisits resolved to the captures they stand for.

A revisit (a capture that came back "not modified") takes its content from the latest
earlier full response of the same canonical URL: an as-of join. Moments of a URL are
reduced to one row each, then the join runs in two levels: within time slices of equal
depth, and from slice to slice by each slice's last response, so a URL with a third of all
captures is many small windows. Only headers and ids travel, never payloads.

The revisit's validators are checked against that response: entity tags first (weak ones
compare without their mark), else modification dates. If they agree, the headers a
not-modified answer may renew are taken from it, all others from the response.

Defined results, as ``status``: ``resolved``; ``mismatch`` (validators differ);
``unverified`` (no validator both sides have); ``no_response`` (nothing earlier, or no time).
Of responses of one moment the one with the greatest record_id counts; "earlier" is strict.
A NULL URL is a URL like another. NULL headers are none; header names are compared in lower
case, of names alike the last wins. Repeated rows are answered each. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import stage

PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)="
SLICES = 256
URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)(:[0-9]+)?([^?#]*)(?:\?([^#]*))?"


def canonical(url: Column) -> Column:
    """Host in lower case without ``www.``, path without its last slash, query parameters
    sorted, without trackers; no scheme, default port, user or fragment."""
    part = lambda n: F.regexp_extract(F.coalesce(url, F.lit("")), URL, n)
    host = F.regexp_replace(F.lower(part(1)), r"^www\.", "")
    port = F.regexp_replace(part(2), r"^:(80|443)$", "")
    asked = F.array_join(F.sort_array(F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~F.regexp_like(p, F.lit(TRACKING)))), "&")
    clean = F.concat(host, port, F.regexp_replace(part(3), "/$", ""), F.when(asked == "", "").otherwise(F.concat(F.lit("?"), asked)))
    return F.when(host == "", F.coalesce(url, F.lit(""))).otherwise(clean)


def lower_names(headers: Column) -> Column:
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e.key)))
    last = lambda name: F.element_at(F.filter(entries, lambda e: F.lower(e.key) == name), -1).value
    return F.map_from_arrays(names, F.transform(names, last))


def latest_before(records: DataFrame) -> DataFrame:
    """(url, time, found) for every moment of a revisit: the last response before it.
    ``records``: url, time, revisit (boolean), record_id, headers."""
    answer = F.struct("record_id", "headers")
    moments = records.where("time IS NOT NULL").groupBy("url", "time").agg(
        F.max_by(F.when(~F.col("revisit"), answer), F.when(~F.col("revisit"), F.col("record_id"))).alias("response"), F.max("revisit").alias("asked")
    )
    moments = stage(moments, "moments")
    cuts = moments.agg(F.percentile_approx("time", [k / SLICES for k in range(1, SLICES)], 10_000)).first()[0] or []
    borders = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<bigint>")
    sliced = moments.withColumn("slice", F.size(F.filter(borders, lambda b: b < F.col("time"))))
    inside = Window.partitionBy("url", "slice").orderBy("time").rowsBetween(Window.unboundedPreceding, -1)
    own = sliced.withColumn("own", F.last("response", ignorenulls=True).over(inside)).where("asked")
    ends = sliced.where("response IS NOT NULL").groupBy("url", "slice").agg(F.max_by("response", "time").alias("last"))
    slots = sliced.select("url", "slice").distinct().join(ends, ["url", "slice"], "left")
    across = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("url", "slice", F.last("last", ignorenulls=True).over(across).alias("carried"))
    return own.join(carried, ["url", "slice"]).select("url", "time", F.coalesce("own", "carried").alias("found"))


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url (canonical), time, status, response_id, and the
    merged ``headers`` of resolved ones. ``records``: record_id, url, time (long), kind
    (``response`` or ``revisit``), headers (map of strings); other kinds are left out."""
    clean = records.where(F.col("kind").isin("response", "revisit")).select(
        F.col("record_id").cast("long").alias("record_id"), canonical(F.col("url")).alias("url"), F.col("time").cast("long").alias("time"),
        (F.col("kind") == "revisit").alias("revisit"), lower_names(F.col("headers")).alias("headers"),
    )
    found = latest_before(clean)
    joined = clean.where("revisit").join(found, ["url", "time"], "left")
    mine, theirs = F.col("headers"), F.col("found.headers")
    tag = lambda h: F.regexp_replace(F.element_at(h, "etag"), "^W/", "")
    day = lambda h: F.element_at(h, "last-modified")
    agree = F.coalesce(tag(mine) == tag(theirs), day(mine) == day(theirs))
    status = F.when(F.col("found").isNull(), "no_response").when(agree.isNull(), "unverified").when(agree, "resolved").otherwise("mismatch")
    renewed = F.map_filter(mine, lambda name, _: name.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda name, _: ~F.array_contains(F.map_keys(renewed), name)), renewed)
    return joined.withColumn("status", status).select("record_id", "url", "time", "status", F.col("found.record_id").alias("response_id"), F.when(F.col("status") == "resolved", merged).alias("headers"))


def header_lines(headers: Column) -> Column:
    """Headers as sorted ``name: value`` lines."""
    return F.array_join(F.sort_array(F.transform(F.map_entries(headers), lambda e: F.concat(e.key, F.lit(": "), e.value))), "\n")


def captures(pages: DataFrame) -> DataFrame:
    """Capture records of a table of pages: every page is a full response at its own moment,
    and comes back not modified later (every eleventh: asked before it was seen), under its
    URL with a fragment. Entity tags are digests of the page; of every seventh the tag had
    changed, and every fifth carries a date only."""
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    n, text = F.col("page_id"), lambda c: c.cast("string")
    response = F.map_from_arrays(
        F.array(*map(F.lit, ("Content-Type", "ETag", "Last-Modified", "Cache-Control", "Content-Length", "Date"))),
        F.array(F.lit("text/html"), tag, F.concat(F.lit("day "), text(n % 1000)), F.lit("max-age=60"), text(F.length(F.coalesce("html", F.lit("")))), F.concat(F.lit("moment "), text(2 * n))),
    )
    back = F.when(n % 11 == 0, 2 * n - 1).otherwise(2 * n + 4001)
    tagged = F.when(n % 7 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag))
    revisit = F.map_from_arrays(
        F.array(F.lit("Date"), F.lit("Content-Length"), F.lit("Cache-Control"), F.when(n % 5 == 0, "Last-Modified").otherwise("etag")),
        F.array(F.concat(F.lit("moment "), text(back)), F.lit("0"), F.concat(F.lit("max-age="), text(n % 100)), F.when(n % 5 == 0, F.concat(F.lit("day "), text(n % 1000))).otherwise(tagged)),
    )
    first = pages.select((2 * n).alias("record_id"), "url", (2 * n).alias("time"), F.lit("response").alias("kind"), response.alias("headers"))
    again = pages.select((2 * n + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"), back.alias("time"), F.lit("revisit").alias("kind"), revisit.alias("headers"))
    return first.unionByName(again)
