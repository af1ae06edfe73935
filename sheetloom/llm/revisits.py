"""Not-modified revisits of web captures, resolved against the latest earlier full response.

Records (record_id, url, ts, kind, headers, digest) are full responses or revisits. A revisit is joined as
of its time to the latest earlier full response with the same canonical URL. Its validators are checked: an
entity tag is compared without regard to weakness, else a modification date must be equal. A confirmed
revisit gets the response's payload digest and its headers, updated by those headers of the revisit that a
not-modified answer may update.

Scale: records are range partitioned by canonical URL, time and id, so a hot URL is cut by time and no
URL's captures must fit into one task. A window fills responses forward within a partition's part of a
URL; what reaches in from earlier partitions is one row per partition. The partition numbers are written
once, so that a repeated task cannot cut them differently.

Defined results: a revisit whose URL or time is null, or without an earlier response, is ``unresolved``;
of responses at one time the larger id is later; a revisit at the very time of a response does not see
it; a revisit without validators, or whose response has none of the same kind, is ``unverified`` and is
filled like a confirmed one; a contradicted one is ``changed`` and keeps its own headers and no payload;
repeated rows stay; header names are compared in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.session import written

# Headers that describe a stored message's own body or connection.
KEPT_HEADERS = ["connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
                "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade"]
RESPONSE, REVISIT = "response", "revisit"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, at least a slash as path."""
    bare = F.regexp_replace(F.trim(url), "#[\\s\\S]*$", "")
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?]*)", 1))
    rest = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*([\s\S]*)$", 1)
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(scheme == "", bare).otherwise(F.concat(scheme, F.lit("://"), host, path))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def verdict(stored: Column, sent: Column) -> Column:
    """confirmed, changed or unverified, by the validators in two header maps."""
    tags = stored["etag"].isNotNull() & sent["etag"].isNotNull()
    dates = stored["last-modified"].isNotNull() & sent["last-modified"].isNotNull()
    return (F.when(tags, F.when(_strong(stored["etag"]) == _strong(sent["etag"]), "confirmed").otherwise("changed"))
            .when(dates, F.when(stored["last-modified"] == sent["last-modified"], "confirmed").otherwise("changed")).otherwise("unverified"))


def merged_headers(stored: Column, sent: Column) -> Column:
    """Stored headers, updated by the sent ones that may update them."""
    updates = F.map_filter(sent, lambda k, v: ~k.isin(KEPT_HEADERS))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(updates), k)), updates)


def resolve(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Revisits (record_id, url, ts, canonical_url, outcome, response_id, response_ts, digest, headers)."""
    spark = records.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lower = F.map_from_entries(F.transform(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>"))),
                                           lambda e: F.struct(F.lower(e.key).alias("key"), e.value.alias("value"))))
    rows = records.select("record_id", "url", "ts", F.col("kind"), lower.alias("headers"), "digest", canonical_url(F.col("url")).alias("canonical_url"))
    # revisits come before responses of the same time, so they do not see them
    rows = rows.withColumn("place", F.when(F.col("kind") == RESPONSE, 1).otherwise(0))
    rows = rows.repartitionByRange(n, "canonical_url", "ts", "place", "record_id").withColumn("part", F.spark_partition_id())
    rows = written(rows, "captures")
    usable = (F.col("kind") == RESPONSE) & F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()
    full = F.when(usable, F.struct("canonical_url", F.col("record_id").alias("id"), "ts", "digest", "headers"))

    at = F.struct("canonical_url", "ts", "place", "record_id")
    ends = rows.where(usable).groupBy("part").agg(F.max_by(full, at).alias("end"))
    parts = spark.range(n).select(F.col("id").cast("int").alias("part")).join(ends, "part", "left")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    carried = parts.select("part", F.last("end", ignorenulls=True).over(earlier).alias("carried"))

    sweep = Window.partitionBy("part").orderBy("canonical_url", "ts", "place", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("own", F.last(full, ignorenulls=True).over(sweep)).where(F.col("kind") == REVISIT)
    near = F.coalesce("own", "carried")
    found = seen.join(carried, "part", "left").withColumn(
        "found", F.when((near["canonical_url"] == F.col("canonical_url")) & F.col("ts").isNotNull(), near))
    outcome = F.when(F.col("found").isNull(), "unresolved").otherwise(verdict(F.col("found.headers"), F.col("headers")))
    judged = found.withColumn("outcome", outcome)
    fills = F.col("outcome").isin("confirmed", "unverified")
    return judged.select("record_id", "url", "ts", "canonical_url", "outcome", F.col("found.id").alias("response_id"), F.col("found.ts").alias("response_ts"),
                         F.when(fills, F.col("found.digest")).alias("digest"),
                         F.when(fills, merged_headers(F.col("found.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"))
