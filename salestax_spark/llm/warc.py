"""Not-modified revisits of web archives, resolved against the latest earlier full response of the same URL.

An as-of join by canonical URL and capture time. URLs that own a large share of all captures are cut by time: inside a
slice of ``slice_width`` the latest earlier response comes from a running maximum, and one row per URL and slice
carries the latest response of all earlier slices over. Validators are then compared and the headers that a 304 answer may update
are laid over those of the response.

Records: record_id, url, captured_at (long), record_type (``response`` or ``revisit``), etag, last_modified,
payload_digest, headers (map). Outcomes of a revisit:

* ``resolved``: the entity tags agree (weak comparison); without a tag in the revisit the Last-Modified dates, and
  without both the payload digests;
* ``mismatch``: the first of these that the revisit has does not agree; no headers are merged;
* ``unverified``: the revisit has no validator at all; it is attached, its headers are not merged;
* ``no_response``: nothing earlier under that URL, or the URL or capture time is NULL.

Of responses at the same time the highest record id counts; a response at the revisit's own time is not earlier. Equal
rows each get their row. Records of other types are ignored. Empty tables give an empty result, extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salestax_spark.llm.common import table

#: Header fields of a 304 answer that update the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")

SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*)://"
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
REST = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, ``/`` for an empty path."""
    scheme = F.lower(F.regexp_extract(url, SCHEME, 1))
    host = F.lower(F.regexp_extract(url, AUTHORITY, 1))
    port = F.when(scheme == "http", ":80").when(scheme == "https", ":443")
    host = F.when(F.endswith(host, port), F.substring(host, F.lit(1), F.length(host) - F.length(port))).otherwise(host)
    rest = F.regexp_extract(url, REST, 1)
    rest = F.when(rest == "", "/").when(F.startswith(rest, F.lit("?")), F.concat(F.lit("/"), rest)).otherwise(rest)
    plain = F.regexp_extract(url, "^([^#]*)", 1)
    return F.when(scheme == "", plain).otherwise(F.concat(scheme, F.lit("://"), host, rest))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame, slice_width: int = 86_400) -> DataFrame:
    """One row per revisit: record_id, canonical_url, captured_at, outcome, response_id, payload_digest, headers."""
    response = F.struct(
        F.col("captured_at").alias("at"),
        F.col("record_id").alias("id"),
        "etag",
        "last_modified",
        "payload_digest",
        F.array_sort(F.map_entries("headers")).alias("headers"),
    )
    events = records.where(F.col("record_type").isin("response", "revisit")).select(
        "record_id",
        canonical_url(F.col("url")).alias("canonical_url"),
        "captured_at",
        F.floor(F.col("captured_at") / slice_width).alias("_slice"),
        F.struct("etag", "last_modified", "payload_digest", "headers").alias("_own"),
        (F.col("record_type") == "revisit").alias("_revisit"),
        F.when(F.col("record_type") == "response", response).alias("_response"),
    )
    known = F.col("canonical_url").isNotNull() & F.col("captured_at").isNotNull()
    earlier = Window.partitionBy("canonical_url", "_slice").orderBy("captured_at").rangeBetween(Window.unboundedPreceding, -1)
    inside = events.where(known).withColumn("_inside", F.max("_response").over(earlier)).where("_revisit")
    slices = events.where(known).groupBy("canonical_url", "_slice").agg(F.max("_response").alias("_latest"))
    carried = slices.withColumn(
        "_carried",
        F.max("_latest").over(Window.partitionBy("canonical_url").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
    ).select("canonical_url", "_slice", "_carried")
    found = inside.join(carried, ["canonical_url", "_slice"], "left").withColumn("_found", F.coalesce("_inside", "_carried"))
    lost = events.where(~known & F.col("_revisit")).withColumn("_found", F.lit(None).cast(found.schema["_found"].dataType))
    columns = ["record_id", "canonical_url", "captured_at", "_own", "_found"]
    both = found.select(*columns).unionByName(lost.select(*columns))
    own, base = F.col("_own"), F.col("_found")
    agrees = (
        F.when(own["etag"].isNotNull(), F.coalesce(_weak(own["etag"]) == _weak(base["etag"]), F.lit(False)))
        .when(own["last_modified"].isNotNull(), F.coalesce(own["last_modified"] == base["last_modified"], F.lit(False)))
        .when(own["payload_digest"].isNotNull(), F.coalesce(own["payload_digest"] == base["payload_digest"], F.lit(False)))
    )
    outcome = (
        F.when(base.isNull(), "no_response").when(agrees, "resolved").when(agrees.isNull(), "unverified").otherwise("mismatch")
    )
    allowed = F.map_filter(F.coalesce(own["headers"], F.create_map().cast("map<string,string>")), lambda k, v: F.lower(k).isin(*PERMITTED))
    stored = F.map_from_entries(F.coalesce(base["headers"], F.array().cast("array<struct<key:string,value:string>>")))
    names = F.transform(F.map_keys(allowed), lambda k: F.lower(k))
    untouched = F.map_filter(stored, lambda k, v: ~F.array_contains(names, F.lower(k)))
    headers = F.when(F.col("outcome") == "resolved", F.map_concat(untouched, allowed)).when(base.isNotNull(), stored)
    attached = F.col("outcome").isin("resolved", "unverified")
    return both.withColumn("outcome", outcome).select(
        "record_id",
        "canonical_url",
        "captured_at",
        "outcome",
        base["id"].alias("response_id"),
        F.when(attached, base["payload_digest"]).alias("payload_digest"),
        headers.alias("headers"),
    )


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of ``pages``: two full responses of each page, the second changed on every third page, and three revisits
    with spellings of the URL that mean the same, of which some are too early and some name an outdated tag."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.md5(F.col("html")).alias("digest"), F.length("html").alias("size")
    )
    k = F.col("k")
    captures = pages.select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    changed = (F.pmod("page_id", F.lit(3)) == 0) & (k >= 3)
    digest = F.when(changed, F.md5(F.concat("digest", F.lit("+")))).otherwise(F.col("digest"))
    stale = (k == 4) & (F.pmod("page_id", F.lit(7)) == 0)
    etag = F.concat(F.lit('"'), F.when(stale, F.md5(F.lit("stale"))).otherwise(digest), F.lit('"'))
    shown = F.when(k == 2, F.concat("url", F.lit("#again"))).otherwise(F.col("url"))
    at = F.col("page_id") * 10 + F.element_at(F.array(*[F.lit(x) for x in (100_000, 50_000, 200_000, 300_000, 400_000)]), k + 1)
    is_response = k.isin(0, 3)
    return captures.select(
        (F.col("page_id") * 5 + k).alias("record_id"),
        shown.alias("url"),
        at.cast("long").alias("captured_at"),
        F.when(is_response, "response").otherwise("revisit").alias("record_type"),
        F.when(is_response | (k != 2), etag).alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        digest.alias("payload_digest"),
        F.create_map(
            F.lit("date"), at.cast("string"), F.lit("etag"), etag,
            F.lit("content-length"), F.when(is_response, F.col("size")).otherwise(0).cast("string"),
            F.lit("server"), F.when(is_response, "origin").otherwise("cache"),
        ).alias("headers"),
    )


def flat_headers(headers: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")
