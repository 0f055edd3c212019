"""WARC: not-modified revisits, resolved to the full response that they confirm.

A revisit record says that a page had not changed. It is resolved to the latest earlier full response of the same
canonical URL, by an as-of join; its validators (entity tag, else modification date) must agree with the response's, and
the headers that a 304 answer may renew are merged over the stored ones.

The as-of join is two small windows: within blocks of time of about equal size, and over the blocks' last responses. A
URL that a third of all captures share is thereby spread over BLOCKS tasks, and only times go through the windows; the
records come by plain joins afterwards, which Spark can split.

Defined results: a revisit without an earlier response, or without URL or time, is `no_response`; without validators of
its own or of the response it is `unvalidated`, with other ones `mismatch`, and neither gets a payload; of several
responses with one URL and time the one with the largest record_id counts; a response at the revisit's own time is not
earlier; null headers are none; records without a record_id are left out; repeated revisits are resolved each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivena.llm._common import scratch
from scrivena.operators.ranks import range_of

BLOCKS = 256
#: Headers that a 304 answer may renew. Fixed values.
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't name a page. Fixed pattern.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Without scheme, fragment, www., standard ports, closing slashes and tracking parameters; host in lower case,
    parameters sorted."""
    u = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, "^([^/?]*)", 1)), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(u, "[?](.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _tag(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """records: record_id long, kind ('response' or 'revisit'), url, ts timestamp or long, headers map<string,string>
    (names in lower case), payload string.

    Returns a row for each revisit: record_id, canonical_url, ts, status, response_id, headers, payload.
    """
    rec = records.select("record_id", "kind", canonical_url(F.col("url")).alias("canonical_url"), "ts", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "payload").where("record_id is not null")
    cuts = rec.select(F.percentile_approx(F.col("ts").cast("double"), [i / BLOCKS for i in range(1, BLOCKS)], 20 * BLOCKS)).first()[0] or []
    block = range_of(F.col("ts").cast("double"), sorted(set(cuts)))

    is_response = F.col("kind") == "response"
    placed = rec.where("canonical_url is not null and ts is not null and kind in ('response', 'revisit')")
    # One row for each URL, time and kind, by partial aggregation: which response counts, and which times ask for one.
    times = placed.groupBy("canonical_url", "ts").agg(F.max(F.when(is_response, F.col("record_id"))).alias("response_id"), F.max((~is_response).cast("int")).alias("asks"))
    times = scratch(times.withColumn("block", block), "times")
    stored = F.when(F.col("response_id").isNotNull(), F.struct("ts", "response_id"))
    inside = Window.partitionBy("canonical_url", "block").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    found = times.withColumn("near", F.last(stored, ignorenulls=True).over(inside))
    last = times.groupBy("canonical_url", "block").agg(F.max(stored).alias("last"))
    over = Window.partitionBy("canonical_url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("canonical_url", "block", F.max("last").over(over).alias("before"))  # BLOCKS rows a URL at most
    found = found.where("asks = 1").join(last, ["canonical_url", "block"]).select("canonical_url", "ts", F.coalesce("near", "before").alias("r"))
    found = scratch(found.select("canonical_url", "ts", "r.response_id"), "asof")
    asks = rec.where("kind = 'revisit'").drop("payload", "kind").join(found, ["canonical_url", "ts"], "left")
    full = rec.where("kind = 'response'").select(F.col("record_id").alias("response_id"), F.col("headers").alias("stored"), "payload").dropDuplicates(["response_id"])
    out = asks.join(full, "response_id", "left")
    own, old = (lambda n: _tag(F.col("headers")[n])), (lambda n: _tag(F.col("stored")[n]))
    tags, dates = own("etag").isNotNull() & old("etag").isNotNull(), own("last-modified").isNotNull() & old("last-modified").isNotNull()
    agree = F.when(tags, own("etag") == old("etag")).when(dates, own("last-modified") == old("last-modified"))
    status = F.when(F.col("response_id").isNull(), "no_response").when(agree.isNull(), "unvalidated").when(agree, "resolved").otherwise("mismatch")
    renew = F.map_filter("headers", lambda k, _: k.isin(*RENEWED))
    kept = F.map_filter("stored", lambda k, _: ~F.array_contains(F.map_keys(renew), k))
    out = out.withColumn("status", status)
    good = F.col("status") == "resolved"
    return out.select("record_id", "canonical_url", "ts", "status", "response_id", F.when(good, F.map_concat(kept, renew)).alias("headers"), F.when(good, F.col("payload")).alias("payload"))


def captures(pages: DataFrame) -> DataFrame:
    """WARC records for a table of pages (page_id, url, html): of each page a response, two later revisits, one of which
    tells of another version for every fifth page, and a modification date instead of an entity tag for every fourth.
    Every seventh page has revisits only."""
    p = pages.select(F.col("page_id").cast("long").alias("p"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).where("p is not null")
    tag, stamp = F.md5(F.coalesce("html", F.lit(""))), F.concat(F.lit("day "), (F.col("p") % 365).cast("string"))
    ts = F.col("p") * 7919 % 100000

    def record(k: int, kind: str, at: Column, headers: dict, payload: Column) -> Column:
        entries = F.map_filter(F.create_map(*[x for n, v in headers.items() for x in (F.lit(n), v)]), lambda _, v: v.isNotNull())
        return F.struct((F.col("p") * 3 + k).alias("record_id"), F.lit(kind).alias("kind"), at.alias("ts"), entries.alias("headers"), payload.alias("payload"))

    date = lambda at: F.concat(F.lit("t "), at.cast("string"))
    by_tag = F.col("p") % 4 != 0
    none = F.lit(None).cast("string")
    response = record(0, "response", ts, {"content-type": F.lit("text/html"), "content-length": F.coalesce(F.octet_length("html"), F.lit(0)).cast("string"), "date": date(ts), "etag": F.when(by_tag, tag), "last-modified": stamp, "cache-control": F.lit("max-age=60")}, F.col("html"))
    at1, at2 = ts + 10 + F.col("p") % 50, ts + 5000 + F.col("p") % 3000
    first = record(1, "revisit", at1, {"date": date(at1), "etag": F.when(by_tag, F.concat(F.lit("W/"), tag)), "last-modified": F.when(~by_tag, stamp), "content-length": F.lit("0"), "cache-control": F.lit("max-age=120")}, none)
    second = record(2, "revisit", at2, {"date": date(at2), "etag": F.when(F.col("p") % 5 == 0, F.lit("other")).when(by_tag, tag), "content-length": F.lit("0"), "expires": date(at2 + 60)}, none)
    all_ = F.when(F.col("p") % 7 == 0, F.array(first, second)).otherwise(F.array(response, first, second))
    return p.select("url", F.explode(all_).alias("r")).select("url", "r.*")
