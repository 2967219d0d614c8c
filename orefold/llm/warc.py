"""WARC: not-modified revisits get back the response that they stand for.

A revisit record (the server said 304) has no payload. It is resolved to the latest earlier full response of the same canonical
URL, if the validators agree: entity tags where both have one (weak ones compare without their mark), else dates of last
modification. The outcome is ``resolved``, ``unchecked`` (nothing to compare), ``changed`` (they differ) or ``missing`` (no
earlier response); ``changed`` and ``missing`` get no payload. The headers are the stored response's, with those replaced
that a 304 answer may update (``PERMITTED``); names are lower case.

The as-of join carries no payloads. Of a URL's responses at one time only the last counts, and revisits at one time ask the same, so the
window goes over the different times of a URL, in (canonical URL, span of time). Spans are cut at quantiles of these times,
one for ``SPAN_ROWS`` of them and ``SPANS`` at least, so one URL with a third of all records is spread over many tasks; what goes from
one span to the next is the last response of each. Answers go back to the revisits, and payloads to the answers, by joins on keys that
are never null, which Spark splits where a key is hot. All of it is DataFrame code without Python in the tasks.

Cases: a null URL never resolves, and a response without an id gives nothing; a record without a time comes before all others of its URL; records of one time are ordered by id,
responses before revisits; of several responses with one id the latest (then the one with the greatest hash) gives the payload; names of
headers that differ in case only are one, its values joined by a comma in the order of the names as given; null headers are none; repeated records each
give a row; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# FIXED values: header fields that a 304 answer may update in a stored response.
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# FIXED values: query parameters that only track.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid"
SPANS, MOST_SPANS, SPAN_ROWS = 64, 1024, 1_000_000


def canonical_url(url: Column) -> Column:
    """Host in lower case without www., m. and default ports, path without a last slash, sorted query without tracking."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^(?i)https?://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, "^([^/?]*)", 1)), "^(www|m)\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(u, "\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _etag(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), '^W/', "")


def lower_names(headers: Column) -> Column:
    """Names in lower case, the values of what becomes one name joined."""
    entries = F.array_sort(F.filter(F.map_entries(F.coalesce(headers, F.expr("cast(map() as map<string,string>)"))), lambda e: e["value"].isNotNull()))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    values = lambda n: F.array_join(F.transform(F.filter(entries, lambda e: F.lower(e["key"]) == n), lambda e: e["value"]), ", ")
    return F.map_from_arrays(names, F.transform(names, values))


def resolve(records: DataFrame) -> DataFrame:
    """Per revisit: record_id, canonical_url, source_id, outcome, headers, body.

    records: record_id, url, captured_at, kind (``response`` or ``revisit``), headers (map of text), body.
    """
    rows = records.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), "captured_at", "kind", lower_names(F.col("headers")).alias("headers"))
    revisits = rows.where("kind = 'revisit'")
    asked = revisits.where("canonical_url is not null")
    full = rows.where("kind = 'response' and record_id is not null and canonical_url is not null").withColumn("full", F.struct(F.col("record_id").alias("id"), "headers"))
    nothing = F.lit(None).cast(full.schema["full"].dataType)
    points = (
        full.select("canonical_url", "captured_at", "full", F.lit(False).alias("asked"))
        .unionByName(asked.select("canonical_url", "captured_at", nothing.alias("full"), F.lit(True).alias("asked")))
        .groupBy("canonical_url", "captured_at")
        .agg(F.max_by("full", "full.id").alias("full"), F.max("asked").alias("asked"))
    )
    spans = min(MOST_SPANS, max(SPANS, -(-rows.count() // SPAN_ROWS)))
    cuts = rows.agg(F.percentile_approx("captured_at", [i / spans for i in range(1, spans)], 10_000).alias("cuts")).first().cuts
    span = F.size(F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts or []))]), lambda c: c < F.col("captured_at"))) if cuts else F.lit(0)
    points = points.withColumn("span", F.when(F.col("captured_at").isNull(), 0).otherwise(span))
    inside = Window.partitionBy("canonical_url", "span").orderBy(F.col("captured_at").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    near = points.withColumn("near", F.last("full", ignorenulls=True).over(inside))
    lasts = points.groupBy("canonical_url", "span").agg(F.max_by("full", F.when(F.col("full").isNotNull(), F.struct(F.col("captured_at").isNotNull(), "captured_at"))).alias("last"))
    before = Window.partitionBy("canonical_url").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.withColumn("carried", F.last("last", ignorenulls=True).over(before)).select("canonical_url", "span", "carried")
    answers = near.where("asked").join(carried, ["canonical_url", "span"]).select(F.col("canonical_url").alias("__url"), F.col("captured_at").alias("__at"), F.coalesce("near", "carried").alias("from"))
    found = asked.join(answers, (F.col("canonical_url") == F.col("__url")) & F.col("captured_at").eqNullSafe(F.col("__at"))).drop("__url", "__at")
    mine, theirs = F.col("headers"), F.col("from.headers")
    tags = _etag(mine["etag"]) == _etag(theirs["etag"])
    dates = F.trim(mine["last-modified"]) == F.trim(theirs["last-modified"])
    agree = F.coalesce(tags, dates)
    outcome = F.when(F.col("from").isNull(), "missing").when(agree.isNull(), "unchecked").when(agree, "resolved").otherwise("changed")
    update = F.map_filter(mine, lambda k, _: k.isin(PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda k, _: ~F.array_contains(F.map_keys(update), k)), update)
    judged = found.withColumn("outcome", outcome).withColumn("good", F.col("outcome").isin("resolved", "unchecked"))
    judged = judged.select("record_id", "canonical_url", F.when(F.col("good"), F.col("from.id")).alias("source_id"), "outcome", F.when(F.col("good"), merged).otherwise(mine).alias("headers"), "good")
    no_id, no_body = F.lit(None).cast(records.schema["record_id"].dataType), F.lit(None).cast(records.schema["body"].dataType)
    lost = revisits.where("canonical_url is null").select("record_id", "canonical_url", no_id.alias("source_id"), F.lit("missing").alias("outcome"), "headers", no_body.alias("body"))
    empty = judged.where("not good").drop("good").withColumn("body", no_body)
    latest = F.max_by("body", F.struct("captured_at", F.xxhash64("body"))).alias("body")
    bodies = records.where("kind = 'response' and record_id is not null").groupBy(F.col("record_id").alias("source_id")).agg(latest)
    given = judged.where("good").drop("good").join(bodies, "source_id", "left")
    names = ["record_id", "canonical_url", "source_id", "outcome", "headers", "body"]
    return given.select(*names).unionByName(empty.select(*names)).unionByName(lost.select(*names))


def digest(resolved: DataFrame) -> DataFrame:
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return resolved.select("record_id", "canonical_url", F.col("source_id").cast("string").alias("source_id"), "outcome", F.array_join(pairs, "\n").alias("header_text"), F.md5("body").alias("body_md5"))


def captures(pages: DataFrame) -> DataFrame:
    """A capture log of the pages table: each page's full response, a revisit by another spelling of its URL soon after
    (every seventh with another entity tag, every eleventh without validators), and of every thirteenth one before it."""
    p, md5 = F.col("page_id"), F.md5("html")
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    stored = F.array(pair("ETag", md5), pair("Content-Type", F.lit("text/html")), pair("Date", (p * 10).cast("string")), pair("Content-Length", F.octet_length("html").cast("string")))
    fresh = F.array(pair("Date", (p * 10 + 5).cast("string")), pair("Cache-Control", F.lit("max-age=60")), pair("Content-Length", F.lit("0")))
    tag = F.array(pair("etag", F.when(p % 7 == 0, F.lit("other")).otherwise(F.concat(F.lit("W/"), md5))))
    respelled = F.concat(F.regexp_replace("url", "^https?://(www\\.|m\\.)?", "HTTP://www."), F.lit("#again"))
    kinds = F.array(
        F.struct((p * 3).alias("record_id"), F.col("url").alias("url"), (p * 10).alias("captured_at"), F.lit("response").alias("kind"), stored.alias("h"), F.col("html").alias("body")),
        F.struct((p * 3 + 1).alias("record_id"), respelled.alias("url"), (p * 10 + 5).alias("captured_at"), F.lit("revisit").alias("kind"), F.when(p % 11 == 0, fresh).otherwise(F.concat(fresh, tag)).alias("h"), F.lit(None).cast("string").alias("body")),
        F.struct((p * 3 + 2).alias("record_id"), F.col("url").alias("url"), (p * 10 - 5).alias("captured_at"), F.lit("revisit").alias("kind"), F.concat(fresh, tag).alias("h"), F.lit(None).cast("string").alias("body")),
    )
    each = pages.select(F.explode(F.when(p % 13 == 0, kinds).otherwise(F.slice(kinds, 1, 2))).alias("r")).select("r.*")
    return each.withColumn("headers", F.map_from_entries("h")).drop("h")
