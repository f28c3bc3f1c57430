"""WARC records, and revisit records resolved to what they stand for.

A revisit record says that a server answered 304 Not Modified; its payload is that
of the last full response of the same canonical URL before it. The join is as of
each revisit's time. Validators are checked: a revisit whose ETag or Last-Modified
contradicts the response is not resolved. A resolved revisit has the response's
payload and headers, updated by those that a 304 may update.

The as-of join does not sort all captures of a URL, of which one may hold most
rows. Captures fall into slices of ``SLICE_SECONDS``: only a slice is sorted, and
what enters it is the last response of the earlier ones, found from one row per
URL and slice. Only ids and validators are sorted; headers and payloads are joined
afterwards to the revisits that need them.

A full response is one whose status a 304 can stand for, 200 or 203, and which the
crawler did not cut off; parts, errors and redirects in between are passed over.

Defined results: of records that share an id, the first by date, type and URL
counts. Records without an id are told apart by what they hold, and equal ones
come back as often as they are there. Captures at the same time are ordered by
record id. A date or a length that cannot be read counts as absent: without a date
a record has no place in time, without a length a payload goes to the record's end.
A response without a status line is no full one. A revisit without
date or URL, or without an earlier full response, is ``missing``; with a
contradicting validator ``mismatch``; with none to compare ``unverified``, without
payload like the former. Records that are neither are ignored. Null payloads and
headers are empty. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbsync.llm.text import let

# Fixed values of the formats.
CRLF = "\r\n"
#: Headers of a 304 that describe a message and not the stored response.
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"

#: Statuses of a stored response that a server answers 304 for.
FULL_STATUSES = (200, 203)
#: A record id starts with its scheme, so none is like a key that begins with this.
_NO_ID = "\0"

SLICE_SECONDS = 3600


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment and last slash dropped, host in lower case, query sorted."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    ordered = F.array_join(F.array_sort(F.split(query, "&", -1)), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), ordered)).otherwise(""))


def render(kind: Column, record_id: Column, uri: Column, date: Column, http_head: Column, payload: Column) -> Column:
    """A WARC/1.1 record of an HTTP message as text."""
    block = F.concat(http_head, F.lit(CRLF + CRLF), payload)
    profile = F.when(kind == "revisit", f"WARC-Profile: {REVISIT_PROFILE}{CRLF}").otherwise("")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), kind, F.lit(f"{CRLF}WARC-Record-ID: <"), record_id,
        F.lit(f">{CRLF}WARC-Target-URI: "), uri, F.lit(f"{CRLF}WARC-Date: "), date, F.lit(CRLF), profile,
        F.lit("Content-Type: application/http;msgtype=response" + CRLF + "Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block, F.lit(CRLF + CRLF),
    )


def _headers(block: Column) -> Column:
    """Header lines as a map with names in lower case; the last line of a name counts."""
    lines = F.filter(F.split(block, CRLF, -1), lambda line: line.contains(":"))
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.lower(F.trim(F.substring_index(line, ":", 1))).alias("key"),
            F.trim(F.regexp_replace(line, r"^[^:]*:", "")).alias("value"),
        ),
    )
    # The lines are taken apart once, not again for each of them.
    return F.map_from_entries(let(pairs, _last_of_each))


def _last_of_each(pairs: Column) -> Column:
    return F.filter(
        pairs, lambda pair, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["key"] == pair["key"])
    )


def parse(records: DataFrame, raw: str = "raw") -> DataFrame:
    """Record texts as ``record_id``, ``type``, ``uri``, ``date``, ``headers`` (of HTTP), ``payload`` and ``full``.

    The payload ends where the record's Content-Length says, so blank lines within it stay.
    """
    gap = F.lit(CRLF + CRLF)
    whole = F.col(raw)
    head = F.substring_index(whole, gap_text := CRLF + CRLF, 1)
    warc = _headers(F.regexp_replace(head, r"^WARC/[0-9.]+\r\n", ""))
    parts = records.select(head.alias("head"), warc.alias("warc"), whole.alias("whole"))
    block = F.expr("substring(whole, char_length(head) + 5)")
    parts = parts.select("warc", block.alias("block")).withColumn("http", F.substring_index("block", gap_text, 1))
    rest = F.expr("substring(block, char_length(http) + 5)").cast("binary")
    stated = F.try_element_at("warc", F.lit("content-length")).try_cast("bigint") - F.octet_length("http") - 4
    size = F.least(F.greatest(F.coalesce(stated, F.octet_length(rest) - 4), F.lit(0)), F.octet_length(rest)).cast("int")
    status = F.regexp_extract("http", r"^HTTP/\S+ +(\d{3})(?!\d)", 1).try_cast("int")
    return parts.select(
        F.regexp_replace(F.try_element_at("warc", F.lit("warc-record-id")), "[<>]", "").alias("record_id"),
        F.try_element_at("warc", F.lit("warc-type")).alias("type"),
        F.try_element_at("warc", F.lit("warc-target-uri")).alias("uri"),
        F.try_to_timestamp(F.try_element_at("warc", F.lit("warc-date"))).alias("date"),
        _headers(F.col("http")).alias("headers"),
        F.substring(rest, F.lit(1), size).cast("string").alias("payload"),
        (status.isin(*FULL_STATUSES) & ~F.map_contains_key("warc", F.lit("warc-truncated"))).alias("full"),
    )


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def _status() -> Column:
    tags = _strong(F.col("etag")) == _strong(F.col("full.etag"))
    times = F.col("modified") == F.col("full.modified")
    return (
        F.when(F.col("full.record_id").isNull(), "missing")
        .when(~F.coalesce(tags, F.lit(True)) | ~F.coalesce(times, F.lit(True)), "mismatch")
        .when(tags.isNull() & times.isNull(), "unverified")
        .otherwise("resolved")
    )


def as_of(captures: DataFrame) -> DataFrame:
    """Each revisit with the response it refers to, as ``full``, and its ``status``; ``copies`` of one without an id."""
    first = F.struct("date", "type", "uri", "etag", "modified", "is_full")
    copies = F.when(F.col("record_id").startswith(_NO_ID), F.count(F.lit(1))).otherwise(1).alias("copies")
    one_each = captures.filter(F.col("type").isin("response", "revisit")).groupBy("record_id").agg(F.min(first).alias("c"), copies)
    light = one_each.select("record_id", "copies", "c.*").withColumn("url", canonical_url(F.col("uri")))
    full = F.when((F.col("type") == "response") & F.col("is_full"), F.struct("record_id", "etag", "modified"))
    light = light.withColumn("slice", F.floor(F.unix_timestamp("date") / SLICE_SECONDS)).withColumn("own", full)
    dated = light.filter(F.col("date").isNotNull() & F.col("url").isNotNull())
    last = dated.filter("own IS NOT NULL").groupBy("url", "slice").agg(
        F.max(F.struct("date", "record_id", "own")).alias("last")
    )
    slices = dated.select("url", "slice").distinct().join(last, ["url", "slice"], "left")
    before = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("url", "slice", F.last("last.own", ignorenulls=True).over(before).alias("carried"))
    within = Window.partitionBy("url", "slice").orderBy("date", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = dated.withColumn("inside", F.last("own", ignorenulls=True).over(within)).filter("type = 'revisit'")
    joined = inside.join(carried, ["url", "slice"]).withColumn("full", F.coalesce("inside", "carried"))
    undated = light.filter("type = 'revisit' AND (date IS NULL OR url IS NULL)").withColumn(
        "full", F.lit(None).cast(joined.schema["full"].dataType)
    )
    columns = ["record_id", "copies", "uri", "date", "etag", "modified", "full"]
    found = joined.select(*columns).unionByName(undated.select(*columns))
    return found.withColumn("status", _status())


def _merged(stored: Column, update: Column) -> Column:
    allowed = F.map_filter(update, lambda name, _: ~name.isin(*NOT_MERGED))
    kept = F.map_filter(stored, lambda name, _: ~F.map_contains_key(allowed, name))
    return F.map_concat(kept, allowed)


def keyed(records: DataFrame) -> DataFrame:
    """``records`` with a key of what they hold in place of an id that is missing."""
    held = F.to_json(F.struct("type", "uri", "date", "headers", "payload"))
    key = F.coalesce("record_id", F.concat(F.lit(_NO_ID), F.md5(held.cast("binary"))))
    return records.withColumn("record_id", key)


def resolve(records: DataFrame, has_keys: bool = False) -> DataFrame:
    """Every revisit as ``record_id``, ``uri``, ``date``, ``status``, ``refers_to``, ``headers`` and ``payload``.

    ``records`` are those of ``parse``; without its ``full`` every response counts as a full one. Where they are a
    table that ``keyed`` was written to (``has_keys``), ids are read without the payloads.
    """
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    known = (records if has_keys else keyed(records)).select(
        "record_id", "type", "uri", "date",
        F.coalesce("headers", none).alias("headers"), F.coalesce("payload", F.lit("")).alias("payload"),
        F.coalesce("full" if "full" in records.columns else F.lit(True), F.lit(False)).alias("is_full"),
    )
    light = known.select(
        "record_id", "type", "uri", "date", "is_full",
        F.try_element_at("headers", F.lit("etag")).alias("etag"),
        F.try_element_at("headers", F.lit("last-modified")).alias("modified"),
    )
    found = as_of(light)
    referred = F.when(F.col("status") == "resolved", F.col("full.record_id"))
    found = found.select("record_id", "copies", "uri", "date", "status", referred.alias("refers_to"))
    own = known.filter("type = 'revisit'").select(
        F.col("record_id").alias("own_id"), F.col("headers").alias("update"), F.struct("date", "uri").alias("order")
    )
    own = own.groupBy("own_id").agg(F.min_by("update", "order").alias("update"))
    stored = known.filter("type = 'response'").groupBy(F.col("record_id").alias("stored_id"))
    # A payload is in the order and what is wanted: it goes through the exchange once.
    stored = stored.agg(F.min(F.struct("date", "uri", "payload", F.map_entries("headers").alias("lines"))).alias("s"))
    stored = stored.select("stored_id", F.map_from_entries("s.lines").alias("stored"), F.col("s.payload").alias("body"))
    joined = found.join(own, F.col("record_id") == F.col("own_id"), "left").join(
        stored, F.col("refers_to") == F.col("stored_id"), "left"
    )
    update = F.coalesce("update", none)
    # Equal records without an id are one row until here.
    joined = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies").cast("bigint"))))

    def named(key: str) -> Column:
        return F.when(~F.col(key).startswith(_NO_ID), F.col(key)).alias(key)

    return joined.select(
        named("record_id"), "uri", "date", "status", named("refers_to"),
        F.when(F.col("stored").isNull(), update).otherwise(_merged(F.col("stored"), update)).alias("headers"),
        F.col("body").alias("payload"),
    )
