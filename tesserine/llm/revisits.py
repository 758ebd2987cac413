"""WARC records: not-modified revisits resolved to the latest earlier full response of the same URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserine.llm.common import HOT_SHARE, LOWER, UPPER, discard, join_hot, materialize

#: Headers that a not-modified answer may carry and that replace those of the stored response (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """The lookup key of a URL: no scheme, no www., no default port, no fragment, no tracking fields, query fields in
    order, no slash at the end; host lower-cased. Null stays null."""
    bare = F.regexp_replace(F.substring_index(url, "#", 1), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    query = F.when(bare.contains("?"), F.regexp_extract(bare, r"(?s)\?(.*)$", 1)).otherwise(F.lit(""))
    fields = F.array_sort(F.filter(F.split(query, "&"), lambda f: (f != "") & ~F.lower(f).rlike("^(utm_[a-z]*|gclid|fbclid|ref)(=|$)")))
    place = F.substring_index(bare, "?", 1)
    host = F.regexp_replace(F.regexp_replace(F.translate(F.substring_index(place, "/", 1), UPPER, LOWER), r":(80|443)$", ""), r"^www\d*\.", "")
    path = F.regexp_replace(F.regexp_extract(place, "(?s)^[^/]*(.*)$", 1), "/+$", "")
    joined = F.array_join(fields, "&")
    return F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(F.lit("")))


_PIECES = 1024  # of a hot URL's bucket


def resolve_revisits(records: DataFrame, *, bucket_s: int = 86_400) -> DataFrame:
    """One row a revisit: record_id, key, ts, status, refers_to, refers_ts, etag, headers, payload_digest.

    records: record_id, url, ts (seconds as any number, or a timestamp), type ("response" or "revisit"), http_status, etag,
    last_modified, headers map<string,string>, payload_digest. A revisit refers to the latest full response (type response, status
    200) of its canonical URL with an earlier ts, by however little (of equal ts, that with the largest record_id). status is
    "resolved" if a validator that both carry agrees (etag without W/ first, else last_modified), "changed" if it differs,
    "unchecked" if they share none, "missing" without an earlier response. A resolved or unchecked record gets the
    response's headers, permitted ones replaced by the revisit's, and its payload digest; others keep their own headers
    and have no digest. Of header names that differ in case only, the first in byte order (capitals first) stands for all
    where headers are merged. Null url or ts: missing. Repeated records are resolved each; extra columns are ignored; an
    empty table gives an empty result.

    The as-of join runs on distinct (URL, ts), so that copies of a record cost one row, and in two steps: these are dealt by URL
    and time bucket, and what a bucket needs from earlier ones is the last response of each. A URL's bucket with more
    than a thousandth of them is cut in pieces of time; there are at most a thousand such. Responses and their revisits come back
    by join_hot, as one of them may have any share of the rows.
    """
    base = records.withColumn("key", canonical_url("url"))
    base = base.withColumn("_full", (F.col("type") == "response") & (F.col("http_status") == 200))
    usable = base.where(F.col("key").isNotNull() & F.col("ts").isNotNull() & (F.col("_full") | (F.col("type") == "revisit")))
    times = usable.groupBy("key", "ts").agg(F.max(F.when(F.col("_full"), F.struct("record_id"))).alias("_here"), F.count_if(F.col("type") == "revisit").alias("_n"))
    seconds = (F.col("ts") if isinstance(records.schema["ts"].dataType, T.NumericType) else F.col("ts").cast("timestamp")).cast("double")
    times = materialize(times.withColumn("_s", seconds).withColumn("_bucket", F.floor(F.col("_s") / bucket_s)), "times")
    total = times.count()
    hot = times.groupBy("key", "_bucket").agg(F.count("*").alias("_c"), F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
    hot = hot.where(F.col("_c") > max(1, total // HOT_SHARE)).drop("_c")
    piece = F.coalesce(F.floor(_PIECES * (F.col("_s") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))), F.lit(0))
    cell = ["key", "_bucket", "_piece"]
    dealt = times.join(F.broadcast(hot), ["key", "_bucket"], "left").select(*cell[:2], piece.alias("_piece"), "ts", "_here", "_n")
    name = F.when(F.col("_here").isNotNull(), F.struct("ts", F.col("_here.record_id").alias("record_id")))
    # the last response before each cell, for all cells that hold a record
    lasts = dealt.groupBy(*cell).agg(F.max(name).alias("_last"))
    earlier = Window.partitionBy("key").orderBy("_bucket", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select(*cell, F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    # inside a cell the latest earlier response is the largest by (ts, record_id)
    within = Window.partitionBy(*cell).orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    asked = dealt.withColumn("_inside", F.max(name).over(within)).where("_n > 0").join(carry, cell, "left")
    asked = materialize(asked.select("key", "ts", "_n", F.coalesce("_inside", "_carry").alias("_ref")), "asked")
    discard(times)
    # the response's own columns come back by its (key, ts, record_id)
    stored = F.struct("ts", "record_id", "etag", "last_modified", "headers", "payload_digest")
    of = asked.where(F.col("_ref").isNotNull()).groupBy("key", "_ref").agg(F.count("*").alias("_m"))
    responses = usable.where(F.col("_full")).groupBy("key", F.struct("ts", "record_id").alias("_ref")).agg(F.max_by(stored, F.coalesce("payload_digest", F.lit(""))).alias("_response"))
    found = join_hot(asked, responses.join(of, ["key", "_ref"]), ["key", "_ref"], "_m", asked.count(), how="left").select("key", "ts", "_n", "_response")
    cols = ["record_id", "key", "ts", "etag", "last_modified", "headers"]
    revisits = usable.where(F.col("type") == "revisit").select(*cols)
    joined = join_hot(revisits, found, ["key", "ts"], "_n", revisits.count(), how="left")
    missing = base.where((F.col("type") == "revisit") & (F.col("key").isNull() | F.col("ts").isNull()))
    missing = missing.withColumn("_response", F.lit(None).cast(joined.schema["_response"].dataType))
    return _merged(joined.select(*cols, "_response").unionByName(missing.select(*cols, "_response")))


def _merged(rows: DataFrame) -> DataFrame:
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    r = F.col("_response")
    same_tag = weak(F.col("etag")) == weak(r["etag"])
    same_date = F.col("last_modified") == r["last_modified"]
    agrees = F.coalesce(same_tag, same_date)
    status = (
        F.when(r.isNull(), "missing").when(agrees.isNull(), "unchecked").when(agrees, "resolved").otherwise("changed")
    )
    own = F.coalesce("headers", F.create_map().cast("map<string,string>"))

    def names(m: Column) -> Column:
        """m with lower-case names; the first in byte order of those that become one."""
        each = F.transform(F.array_sort(F.map_entries(m)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
        keys = F.transform(each, lambda e: e["key"])
        return F.map_from_entries(F.filter(each, lambda e, i: F.array_position(keys, e["key"]) == i + 1))

    permitted = F.map_filter(names(own), lambda k, _: k.isin(*PERMITTED))
    stored = names(F.coalesce(r["headers"], F.create_map().cast("map<string,string>")))
    merged = F.map_concat(F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(permitted), k)), permitted)
    good = F.col("status").isin("resolved", "unchecked")
    return rows.withColumn("status", status).select(
        "record_id",
        "key",
        "ts",
        "status",
        r["record_id"].alias("refers_to"),
        r["ts"].alias("refers_ts"),
        F.when(good, F.coalesce("etag", r["etag"])).otherwise(F.col("etag")).alias("etag"),
        F.when(good, merged).otherwise(own).alias("headers"),
        F.when(good, r["payload_digest"]).alias("payload_digest"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """WARC records that pages stand for: each page is captured four times, a full response when its content changes.

    The capture times, and which captures answered "not modified", follow from the page's id and digest alone.
    """
    digest = F.md5(F.coalesce("html", F.lit("")))
    rows = pages.select("page_id", "url", digest.alias("digest"), F.explode(F.array(*[F.lit(k) for k in range(4)])).alias("k"))
    ts = (F.col("page_id") * 7919 + F.col("k") * 350_003) % 31_536_000
    full = (F.col("k") == 0) | ((F.col("k") == 2) & (F.col("page_id") % 5 == 0))
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 12), F.when((F.col("page_id") % 7 == 0) & (F.col("k") == 3), F.lit("x")).otherwise(F.lit("")), F.lit('"'))
    return rows.select(
        (F.col("page_id") * 4 + F.col("k")).alias("record_id"),
        "url",
        ts.alias("ts"),
        F.when(full, "response").otherwise("revisit").alias("type"),
        F.when(full & (F.col("page_id") % 11 == 3), 503).when(full, 200).otherwise(304).alias("http_status"),
        F.when(F.col("page_id") % 3 != 1, F.when(full, tag).otherwise(F.concat(F.lit("W/"), tag))).alias("etag"),
        F.when(F.col("page_id") % 2 == 0, (F.col("page_id") % 1000).cast("string")).alias("last_modified"),
        F.create_map(F.lit("Date"), ts.cast("string"), F.lit("Content-Length"), F.lit("0"), F.when(full, "Content-Type").otherwise("Expires"), F.col("k").cast("string")).alias("headers"),
        F.when(full, F.col("digest")).alias("payload_digest"),
    )
