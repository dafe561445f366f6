"""Not-modified revisits of a web archive, resolved to the full responses that they stand for.

A revisit record holds no content, only validators and headers. Its content is that of the latest earlier full response
with the same canonical URL, provided that the validators agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified response may replace in the stored one; any other it carries is ignored.
UPDATABLE = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Seconds of one time step of the as-of join.
STEP = 86_400
CAPTURE = ["record_id", "kind", "url", "at", "etag", "last_modified", "headers"]


def canonical_url(url: Column) -> Column:
    """Without scheme, user, default port, a leading ``www.``, fragment, tracking parameters and a trailing slash; the
    host in lower case, the other parameters sorted. Null stays null."""
    rest = F.regexp_replace(F.regexp_replace(url, r"#[\s\S]*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^([^/?]*)", 1)
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    kept = F.filter(F.split(F.regexp_extract(rest, r"\?([\s\S]*)$", 1), "&"),
                    lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]*|ref|fbclid|gclid)(=|$)"))
    host = F.regexp_replace(F.lower(host), r"^[\s\S]*@", "")
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers with the permitted ones of the revisit put over them; names in lower case.

    Of names that differ in case only, the first counts.
    """
    def lower(m: Column) -> Column:
        pairs = F.transform(F.map_entries(m), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
        names = F.transform(pairs, lambda e: e["key"])
        once = F.map_from_entries(F.filter(pairs, lambda e, i: F.array_position(names, e["key"]) == i + 1))
        return F.coalesce(once, F.create_map().cast("map<string,string>"))

    allowed = F.map_filter(lower(fresh), lambda k, v: k.isin(*UPDATABLE) & v.isNotNull())
    return F.map_concat(F.map_filter(lower(stored), lambda k, _: ~F.map_contains_key(allowed, k)), allowed)


def resolve(captures: DataFrame, step: int = STEP) -> DataFrame:
    """One row per revisit: ``record_id``, ``url``, ``canonical_url``, ``at``, ``response_id``, ``response_at``, ``status``,
    ``headers``.

    ``captures`` has ``record_id``, ``kind`` ('response' or 'revisit'; others are ignored), ``url``, ``at`` (seconds, long), ``etag``,
    ``last_modified``, ``headers`` (map); more columns are left out. A response at the revisit's own second isn't earlier.
    Of several at one second the greatest id counts. ``status``: 'resolved'; 'changed' if a validator that both have differs;
    'unchecked' if they share none; 'missing' without an earlier response or if the url or time is null. A changed
    or missing one has the revisit's own permitted headers only; a missing one has no response. Repeated revisits each give a row; an empty table gives none.

    The as-of join goes in two steps, so that a URL with a third of all captures is no single task: time is cut into
    steps, a window inside each (url, step) finds responses of the same step, and for the rest the last response of each
    step is carried to later ones. No content goes through the windows.
    """
    rows = captures.select(*CAPTURE).where(F.col("kind").isin("response", "revisit")).withColumn(
        "canonical_url", canonical_url(F.col("url"))).withColumn("_step", F.floor(F.col("at") / step))
    # Captures without a URL or time are alone.
    rows = rows.withColumn("_lone", F.when(F.col("canonical_url").isNull() | F.col("at").isNull(), F.xxhash64("record_id")))
    response = F.struct(F.col("at").alias("at"), F.col("record_id").alias("id"), F.col("etag").alias("etag"),
                        F.col("last_modified").alias("last_modified"), F.col("headers").alias("headers"))
    usable = (F.col("kind") == "response") & F.col("canonical_url").isNotNull() & F.col("at").isNotNull()
    key = F.struct(F.col("at").alias("at"), F.col("record_id").alias("id"))
    rows = rows.withColumn("_key", F.when(usable, key))
    # By range over the time itself, rows of one second are left out of each other's past.
    earlier = Window.partitionBy("canonical_url", "_step", "_lone").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("_near", F.max("_key").over(earlier)).where("kind = 'revisit'")
    per_step = rows.where(F.col("_key").isNotNull()).groupBy("canonical_url", "_step").agg(F.max("_key").alias("_last"))
    asked = inside.where("_near is null and canonical_url is not null and at is not null").select(
        "canonical_url", "_step").distinct().withColumn("_asked", F.lit(True))
    steps = per_step.join(asked, ["canonical_url", "_step"], "full_outer")
    before = Window.partitionBy("canonical_url").orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    far = steps.withColumn("_far", F.max("_last").over(before)).where("_asked").select("canonical_url", "_step", "_far")
    found = inside.join(far, ["canonical_url", "_step"], "left").withColumn(
        "_found", F.coalesce("_near", "_far")).withColumn("response_id", F.col("_found.id"))
    full = rows.where(F.col("_key").isNotNull()).select(
        F.col("canonical_url").alias("_url"), F.col("at").alias("_at"), F.col("record_id").alias("_id"), response.alias("_r"))
    full = full.groupBy("_url", "_at", "_id").agg(F.max_by("_r", F.xxhash64("_r.etag", "_r.last_modified")).alias("_r"))
    joined = found.join(full, (F.col("canonical_url") == F.col("_url")) & (F.col("_found.at") == F.col("_at"))
                        & F.col("response_id").eqNullSafe(F.col("_id")), "left")
    differs = lambda name: F.coalesce(F.col(name) != F.col(f"_r.{name}"), F.lit(False))
    shares = lambda name: F.col(name).isNotNull() & F.col(f"_r.{name}").isNotNull()
    status = (F.when(F.col("_found").isNull(), "missing")
              .when(differs("etag") | (~shares("etag") & differs("last_modified")), "changed")
              .when(shares("etag") | shares("last_modified"), "resolved").otherwise("unchecked"))
    base = F.when(status.isin("resolved", "unchecked"), F.col("_r.headers"))
    return joined.select("record_id", "url", "canonical_url", "at", "response_id",
                         F.col("_found.at").alias("response_at"), status.alias("status"),
                         merged_headers(base, F.col("headers")).alias("headers"))
