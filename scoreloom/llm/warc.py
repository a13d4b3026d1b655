"""WARC captures: not-modified revisits resolved to the full response they stand for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.llm.scratch import scratch_table

RESPONSE, REVISIT = "response", "revisit"
BUCKET_SECONDS = 3_600
RESOLVED, MISMATCH, MISSING = "resolved", "validator_mismatch", "no_response"

# Headers of a 304 that do not replace stored ones: framing, representation data and hop-by-hop fields.
KEPT_HEADERS = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
)
TRACKING = "utm_"


def canonical_url(url: Column) -> Column:
    """Key under which captures of one resource meet.

    Scheme, user info, a default port, a fragment and ``utm_`` parameters go; the
    host is lower-cased, the parameters sorted, and an empty path is ``/``. Null
    and what is no http url stay as they are.
    """
    rest = F.regexp_extract(url, r"(?is)\A\s*https?://(?:[^/?#]*@)?([^#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, r"\A[^/?]*", 0), r":(?:80|443)?\z", ""))
    path = F.regexp_extract(rest, r"\A[^/?]*([^?]*)", 1)
    query = F.regexp_extract(rest, r"(?s)\A[^?]*\?(.*)\z", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.startswith(F.lower(p), F.lit(TRACKING))))
    return F.when(rest == "", url).otherwise(
        F.concat(host, F.when(path == "", "/").otherwise(path), F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(""))
    )


def header_map(block: Column) -> Column:
    """Header lines (``name: value`` after a status line, if any) as a map; names lower-cased.

    Repeated fields are joined by commas, in order.
    """
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda l: F.instr(l, ":") > 1)
    fields = F.transform(
        lines,
        lambda l: F.struct(
            F.lower(F.trim(F.substring_index(l, ":", 1))).alias("name"),
            F.trim(F.substring(l, F.instr(l, ":") + 1, F.length(l))).alias("value"),
        ),
    )
    names = F.array_distinct(F.transform(fields, lambda f: f["name"]))
    values = F.transform(
        names,
        lambda n: F.array_join(F.transform(F.filter(fields, lambda f: f["name"] == n), lambda f: f["value"]), ", "),
    )
    return F.map_from_arrays(names, values)


def _opaque(tag: Column) -> Column:
    """Entity tag without the mark of weakness."""
    return F.regexp_replace(F.trim(tag), r"\AW/", "")


def latest_before(points: DataFrame, key: Sequence[str], bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """As-of join in one table: the last response before each revisit of a key.

    ``points`` has the key columns, ``at`` (seconds), ``id`` and ``full``. Adds
    ``found`` and ``found_at``: id and time of the latest full one strictly earlier, of
    equal times the largest id. Windows hold one key and time bucket, of equal times the full ones
    last, so that what precedes is earlier by any fraction of a second; a second
    one carries the last response of each bucket on, so that a key of many captures
    is no single task.
    """
    key = list(key)
    cut = points.withColumn("bucket", F.floor(F.col("at") / bucket_seconds))
    full = F.when(F.col("full"), F.struct("at", "id"))
    order = W.partitionBy(*key, "bucket").orderBy("at", "full").rowsBetween(W.unboundedPreceding, -1)
    within = cut.withColumn("inside", F.max(full).over(order))
    last = cut.where("full").groupBy(*key, "bucket").agg(F.max(F.struct("at", "id")).alias("last"))
    buckets = cut.select(*key, "bucket").distinct().join(last, [*key, "bucket"], "left")
    earlier = W.partitionBy(*key).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = buckets.withColumn("before", F.max("last").over(earlier)).select(*key, "bucket", "before")
    met = F.coalesce("inside", "before")
    return within.where("not full").join(carried, [*key, "bucket"], "left").withColumns(
        {"found": met["id"], "found_at": met["at"]}
    ).drop("bucket", "inside", "before")


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``(record_id, canonical, response_id, status, headers, digest)`` of every revisit.

    ``records`` has ``record_id``, ``kind`` (``response`` or ``revisit``), ``url``,
    ``at`` (seconds since 1970), ``http_status``, ``headers`` (text lines) and
    ``digest`` (of the payload). A revisit that says "not modified" (304) stands for
    the latest earlier 200 response of its canonical url. Its validators must
    agree: an entity tag, compared without the mark of weakness, or else the time
    of last modification; a revisit without validators agrees. Then the response's
    headers hold, replaced by those of the revisit except ``KEPT_HEADERS``, and
    the digest of its payload. Otherwise ``status`` is ``validator_mismatch`` or
    ``no_response``, and the revisit's own headers stay.

    Null or unparsable urls meet by their own text, null urls with nothing; a null
    time finds nothing. Ids may repeat: a response is meant by its url, time and id,
    of several with all three equal the one of the least digest (nulls last); each
    revisit row gives one row. Other kinds are ignored.
    """
    held = records.select(
        "record_id", "kind", canonical_url(F.col("url")).alias("canonical"), F.col("at").cast("double").alias("at"),
        "http_status", header_map(F.col("headers")).alias("fields"), "digest",
    ).where(
        (F.col("kind") == REVISIT) & F.coalesce(F.col("http_status") == 304, F.lit(True))
        | (F.col("kind") == RESPONSE) & (F.col("http_status") == 200)
    )
    held = scratch_table(held, "warc-records")
    points = held.select("canonical", "at", F.col("record_id").alias("id"), (F.col("kind") == RESPONSE).alias("full"))
    points = points.where("canonical is not null and at is not null")
    found = latest_before(points, ["canonical"], bucket_seconds).select("canonical", "at", F.col("id").alias("record_id"), "found", "found_at").distinct()
    revisits = held.where(F.col("kind") == REVISIT).join(found, ["canonical", "at", "record_id"], "left")
    responses = (
        held.where(F.col("kind") == RESPONSE)
        .groupBy("canonical", F.col("at").alias("found_at"), F.col("record_id").alias("found"))
        .agg(F.min(F.struct(F.col("digest").isNull().alias("unknown"), "digest", F.to_json("fields").alias("json"))).alias("least"))
        .select("canonical", "found_at", "found", F.from_json("least.json", "map<string, string>").alias("stored"), F.col("least.digest").alias("payload"))
    )
    joined = revisits.drop("digest").join(responses, ["canonical", "found_at", "found"], "left")
    tag, stored_tag = F.col("fields")["etag"], F.col("stored")["etag"]
    agrees = (
        F.when(tag.isNotNull(), _opaque(tag) == _opaque(stored_tag))
        .when(F.col("fields")["last-modified"].isNotNull(), F.col("fields")["last-modified"] == F.col("stored")["last-modified"])
        .otherwise(True)
    )
    agrees = F.coalesce(agrees, F.lit(False))
    status = F.when(F.col("found").isNull(), MISSING).when(agrees, RESOLVED).otherwise(MISMATCH)
    fresh = F.map_filter("fields", lambda k, _: ~k.isin(*KEPT_HEADERS))
    merged = F.map_concat(F.map_filter("stored", lambda k, _: ~F.map_contains_key(fresh, k)), fresh)
    headers = F.when(status == RESOLVED, merged).otherwise(F.col("fields"))
    lines = F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return joined.select(
        "record_id", "canonical",
        F.when(status == RESOLVED, F.col("found")).alias("response_id"),
        status.alias("status"),
        F.array_join(lines, "\n").alias("headers"),
        F.when(status == RESOLVED, F.col("payload")).alias("digest"),
    )


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl derived from ``pages``: a full response of each page, and a later revisit of its url.

    Pages are captured one second after the other. Half an hour to a day later the
    same url is asked again; most revisits repeat the entity tag, some as a weak
    one, some have only the time of last modification, some another tag.
    """
    digest = F.md5(F.coalesce("html", F.lit("")))
    turn = F.pmod(F.crc32(F.coalesce("url", F.lit("")).cast("binary")), F.lit(10))
    modified = F.concat(F.lit("day "), F.pmod("page_id", F.lit(28)).cast("string"))
    response = pages.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit(RESPONSE).alias("kind"), "url", F.col("page_id").alias("at"),
        F.lit(200).alias("http_status"),
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: "), F.length(F.coalesce("html", F.lit(""))).cast("string"),
            F.lit('\r\nETag: "'), digest, F.lit('"\r\nLast-Modified: '), modified, F.lit("\r\nCache-Control: max-age=60\r\n\r\n"),
        ).alias("headers"),
        digest.alias("digest"),
    )
    validator = (
        F.when(turn < 6, F.concat(F.lit('ETag: "'), digest, F.lit('"\r\n')))
        .when(turn < 7, F.concat(F.lit('ETag: W/"'), digest, F.lit('"\r\n')))
        .when(turn < 8, F.concat(F.lit("Last-Modified: "), modified, F.lit("\r\n")))
        .when(turn < 9, F.lit('ETag: "other"\r\n'))
        .otherwise("")
    )
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit(REVISIT).alias("kind"), "url",
        (F.col("page_id") + 1800 + (turn + 1) * 8000).alias("at"),
        F.lit(304).alias("http_status"),
        F.concat(F.lit("HTTP/1.1 304 Not Modified\r\n"), validator, F.lit("Content-Length: 0\r\nCache-Control: max-age=90\r\n\r\n")).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return response.union(revisit)
