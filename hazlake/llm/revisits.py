"""Not-modified captures resolved to the response they stand for.

A capture with status 304 takes the payload of the latest earlier capture with status 200 of the same canonical url, if
its validators agree, and that response's headers updated by those a 304 may update. The as-of join is a window
over (url, time slice) plus the last full response before each slice, carried over the slices of a url; rows are narrow, and a url
with a third of all captures spreads over its slices. Headers and payload are fetched by record id afterwards.

Defined cases: a revisit whose url or date is null or unreadable has the outcome ``no_place``; one without an earlier full
response ``no_earlier``; one whose entity tag or modification date differs ``changed``; one without a validator, where the response
has one, ``unconfirmed``; else ``resolved``. Equal dates are not earlier; of full responses of one date the one with the greatest
record id counts. Header names ignore case, and of names that differ in case alone the last in byte order counts; null headers are none. Repeated revisits are resolved one by one, of
repeated responses one is taken; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE_SECONDS = 86_400

# Fields that a 304 does not update in a stored response (about the message, not the content).
NOT_UPDATED = (
    "connection content-encoding content-length content-range content-type keep-alive proxy-authenticate "
    "proxy-authentication-info proxy-authorization proxy-connection te trailer transfer-encoding upgrade"
).split()

# Query parameters that name a campaign and not a page.
CAMPAIGN = r"^(utm_[a-z]+|gclid|fbclid|ref)(=|$)"


def canonical(url: Column) -> Column:
    """Host without www. and default port, path without a closing slash, sorted parameters; null if it is no web address."""
    parts = r"^\s*https?://(?:[^/?#@]*@)?([^/?#:]+)(?::(\d*))?([^?#\s]*)(?:\?([^#\s]*))?"
    def part(k: int) -> Column:
        return F.regexp_extract(url, "(?i)" + parts, k)

    host = F.regexp_replace(F.lower(part(1)), r"^www\.", "")
    port = F.when(part(2).isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), part(2)))
    kept = F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~F.lower(p).rlike(CAMPAIGN))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise("")
    return F.when(host != "", F.concat(host, port, F.regexp_replace(part(3), "/+$", ""), F.lit("/"), query))


def fields(headers: Column) -> Column:
    """Headers with lower-case names, the last of those that become equal."""
    lowered = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    names = F.transform(lowered, lambda e: e["key"])
    last = F.filter(lowered, lambda e, i: F.array_position(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), e["key"]) == 0)
    return F.coalesce(F.map_from_entries(last), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def merged(stored: Column, new: Column) -> Column:
    """Stored headers updated by the permitted ones of a 304."""
    allowed = F.map_filter(new, lambda k, v: ~k.isin(NOT_UPDATED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False))), allowed)


def _agrees(stored: Column, new: Column) -> Column:
    """resolved, changed or unconfirmed."""
    def get(headers: Column, name: str) -> Column:
        return F.try_element_at(headers, F.lit(name))

    def weak(tag: Column) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    tag, old = get(new, "etag"), get(stored, "etag")
    same_tag = F.when(tag.startswith("W/") | old.startswith("W/"), weak(tag) == weak(old)).otherwise(tag == old)
    same_date = get(new, "last-modified") == get(stored, "last-modified")
    return (
        F.when(tag.isNotNull(), F.when(F.coalesce(same_tag, F.lit(False)), "resolved").otherwise("changed"))
        .when(get(new, "last-modified").isNotNull(), F.when(F.coalesce(same_date, F.lit(False)), "resolved").otherwise("changed"))
        .when(old.isNull() & get(stored, "last-modified").isNull(), "resolved").otherwise("unconfirmed")
    )


def as_of(captures: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """(record_id, place, source_id) of every 304 in (record_id, url, at, status); ``place`` is the canonical url."""
    rows = captures.filter("status IN (200, 304)").select(
        "record_id", canonical(F.col("url")).alias("place"), F.col("at").cast("timestamp").alias("at"), (F.col("status") == 200).alias("full"),
    )
    placed = rows.filter("place IS NOT NULL AND at IS NOT NULL")
    placed = placed.withColumn("slice", F.floor(F.unix_seconds("at") / slice_seconds))
    # At one moment 304s stand before responses, so that only earlier ones are found.
    moment = Window.partitionBy("place", "slice").orderBy("at", "full", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumn("within", F.last(F.when(F.col("full"), F.col("record_id")), ignorenulls=True).over(moment)).filter(~F.col("full"))
    newest = F.max(F.when(F.col("full"), F.struct("at", "record_id")))["record_id"]
    slices = placed.groupBy("place", "slice").agg(newest.alias("newest"))
    earlier = Window.partitionBy("place").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("place", "slice", F.last("newest", ignorenulls=True).over(earlier).alias("carried"))
    found = inside.join(carried, ["place", "slice"]).select("record_id", "place", F.coalesce("within", "carried").alias("source_id"))
    nowhere = rows.filter("(place IS NULL OR at IS NULL) AND NOT full").select("record_id", F.lit(None).cast("string").alias("place"))
    return found.unionByName(nowhere, allowMissingColumns=True)


def resolve(captures: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """(record_id, place, source_id, outcome, headers, payload) of every 304.

    ``captures``: record_id, url, at, status, headers (map of strings), payload (any type); ids are distinct but for repeated
    rows. ``headers`` is merged and ``payload`` filled where the outcome is resolved, else they are the revisit's own.
    """
    found = as_of(captures, slice_seconds).distinct()
    full = captures.filter("status = 200").groupBy(F.col("record_id").alias("source_id")).agg(
        F.first(F.struct(fields(F.col("headers")).alias("headers"), "payload")).alias("stored"),
    )
    revisits = captures.filter("status = 304").select("record_id", fields(F.col("headers")).alias("own"), F.col("payload").alias("own_payload"))
    rows = revisits.join(found, revisits["record_id"].eqNullSafe(found["record_id"]), "left").drop(found["record_id"]).join(full, "source_id", "left")
    outcome = (
        F.when(F.col("place").isNull(), "no_place").when(F.col("stored").isNull(), "no_earlier")
        .otherwise(_agrees(F.col("stored.headers"), F.col("own")))
    )
    done = F.col("outcome") == "resolved"
    return rows.withColumn("outcome", outcome).select(
        "record_id", "place", "source_id", "outcome",
        F.when(done, merged(F.col("stored.headers"), F.col("own"))).otherwise(F.col("own")).alias("headers"),
        F.when(done, F.col("stored.payload")).otherwise(F.col("own_payload")).alias("payload"),
    )
