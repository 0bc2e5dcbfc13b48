"""Not-modified revisits of a web archive, resolved to the response they stand for.

A revisit (304) belongs to the latest earlier full response (200) of the same canonical URL. Its
validators have to agree with that response's; then the response's headers are merged with those a
304 may update. The as-of join is a window over slots of time: within a slot the latest response is
found by a window over (URL, slot), across slots it is carried by a window over one row a slot, so a
URL with a third of all records is spread over its slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a slot.
SLOT = 3600
#: Headers of a 304 that replace the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that don't tell resources apart.
IGNORED = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid|phpsessid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without a default port, path without index file and closing slashes, the
    other parameters sorted; no scheme, user or fragment. NULL and text without a host give NULL."""
    part = lambda k: F.regexp_extract(url, r"^\s*([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?", k)
    host = F.regexp_replace(F.regexp_replace(F.lower(part(2)), r"^.*@", ""), r":(80|443)?$", "")
    path = F.regexp_replace(F.regexp_replace(part(3), r"/index\.(html?|php)$", "/"), r"/+$", "")
    kept = F.array_sort(F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~F.lower(p).rlike(IGNORED)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, query))


def _headers(column: str) -> Column:
    """Header names in lower case; of names that differ in case only the least counts.
    Headers without a value aren't there; NULL is no headers."""
    entries = F.filter(F.array_sort(F.map_entries(column)), lambda e: e["value"].isNotNull())
    first = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, F.lit(1), i), lambda x: F.lower(x["key"]) == F.lower(e["key"])))
    lowered = F.transform(first, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.coalesce(F.map_from_entries(lowered), F.create_map().cast("map<string,string>"))


def _agree(own: str, stored: str) -> Column:
    """Whether the strongest validator that both have is the same; NULL if they have none in common."""
    tag = lambda m: F.regexp_replace(F.col(f"{m}.headers")["etag"], "^W/", "")
    modified = lambda m: F.col(f"{m}.headers")["last-modified"]
    return F.coalesce(tag(own) == tag(stored), modified(own) == modified(stored), F.col(f"{own}.digest") == F.col(f"{stored}.digest"))


def resolve_revisits(records: DataFrame, slot: int = SLOT) -> DataFrame:
    """One row for each revisit of `records` (record_id, url, ts, status, digest, headers): (record_id, url,
    url_key, ts, verdict, refers_to, response_ts, digest, headers).

    ts is a number of seconds. Records of status 304 are revisits, those of status 200 full responses,
    others take no part. verdict is `resolved`, `mismatch` (the latest earlier response has another
    validator), `unverified` (no validator in common) or `missing` (no earlier response; also if url or
    ts is NULL). refers_to and response_ts name the response for every verdict but `missing`; digest and
    headers are the merged ones if resolved, else the revisit's own. Of responses of the same second the
    one of the greatest record_id counts; NULL ids come first. Repeated rows are resolved each; an empty
    table gives no rows; other columns are ignored."""
    rows = records.where("status IN (200, 304)").select(
        F.col("record_id").cast("long").alias("record_id"), "url", F.col("ts").cast("long").alias("ts"), "status", F.col("digest").cast("string").alias("digest"), _headers("headers").alias("headers")
    )
    rows = rows.withColumn("url_key", canonical_url(F.col("url"))).withColumn("slot", F.floor(F.col("ts") / slot))
    own = F.struct("record_id", "ts", "digest", "headers")
    rows = rows.select("url", "url_key", "slot", "status", "ts", own.alias("own")).where("status = 304 OR (url_key IS NOT NULL AND ts IS NOT NULL)")
    # records without a URL or time have nothing to be joined with, and would all meet in one group
    apart = "url_key IS NULL OR ts IS NULL"
    full = F.when(F.col("status") == 200, F.col("own"))
    order = F.when(F.col("status") == 200, F.struct(F.col("own.ts"), F.col("own.record_id")))
    placed = rows.where(f"NOT ({apart})")
    last = placed.groupBy("url_key", "slot").agg(F.max_by(full, order).alias("last"))
    earlier = Window.partitionBy("url_key").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("url_key", "slot", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    within = Window.partitionBy("url_key", "slot").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    near = placed.withColumn("near", F.max_by(full, order).over(within)).where("status = 304")
    found = near.join(carried, ["url_key", "slot"]).withColumn("stored", F.coalesce("near", "carried")).select("url", "url_key", "own", "stored")
    lost = rows.where(f"status = 304 AND ({apart})").select("url", "url_key", "own", F.lit(None).cast(found.schema["stored"].dataType).alias("stored"))
    found = found.unionByName(lost).withColumn("agree", _agree("own", "stored"))
    verdict = F.when(F.col("stored").isNull(), "missing").when(F.col("agree"), "resolved").when(~F.col("agree"), "mismatch").otherwise("unverified")
    allowed = F.map_filter("own.headers", lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter("stored.headers", lambda k, _: ~F.array_contains(F.map_keys(allowed), k))
    resolved = F.col("verdict") == "resolved"
    return found.withColumn("verdict", verdict).select(
        "own.record_id",
        "url",
        "url_key",
        "own.ts",
        "verdict",
        F.col("stored.record_id").alias("refers_to"),
        F.col("stored.ts").alias("response_ts"),
        F.when(resolved, F.coalesce("stored.digest", "own.digest")).otherwise(F.col("own.digest")).alias("digest"),
        F.when(resolved, F.map_concat(kept, allowed)).otherwise(F.col("own.headers")).alias("headers"),
    )


def with_payload(resolved: DataFrame, records: DataFrame, payload: str) -> DataFrame:
    """`resolved` and the payload of the response that each resolved revisit refers to, else NULL."""
    bodies = records.where("status = 200").select(F.col("record_id").cast("long").alias("refers_to"), F.col(payload).alias("__payload")).dropDuplicates(["refers_to"])
    joined = resolved.join(bodies, "refers_to", "left")
    return joined.select(*resolved.columns, F.when(F.col("verdict") == "resolved", F.col("__payload")).alias(payload))


def crawl_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records that a crawl of `pages` (page_id, url, html) would give: a full response and a
    revisit of every page. Every tenth page has changed by the revisit, every eleventh is revisited before
    its first response, every seventh's server sends no entity tag."""
    page, tag = F.col("page_id"), F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    start = F.lit(1_700_000_000) + page * 60
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    tagged = page % 7 != 0
    response = F.struct(
        (page * 2).alias("record_id"),
        start.alias("ts"),
        F.lit(200).alias("status"),
        tag.alias("digest"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Date"), start.cast("string"), F.lit("ETag"), F.when(tagged, quoted(F.substring(tag, 1, 16)))).alias("headers"),
    )
    again = start + F.when(page % 11 == 0, -600).otherwise(86_400 + (page % 5) * 1800)
    changed = page % 10 == 0
    revisit = F.struct(
        (page * 2 + 1).alias("record_id"),
        again.alias("ts"),
        F.lit(304).alias("status"),
        F.when(changed, F.lit("changed")).otherwise(tag).alias("digest"),
        F.create_map(F.lit("cache-control"), F.lit("max-age=600"), F.lit("date"), again.cast("string"), F.lit("server"), F.lit("edge"), F.lit("etag"), F.when(tagged, F.when(changed, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), quoted(F.substring(tag, 1, 16)))))).alias("headers"),
    )
    return pages.select("url", F.explode(F.array(response, revisit)).alias("r")).select("r.record_id", "url", "r.ts", "r.status", "r.digest", "r.headers")
