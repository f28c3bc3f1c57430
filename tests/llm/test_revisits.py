"""Records as crawls write them: malformed, without ids, cut off, errors, and several captures of one URL."""

from __future__ import annotations

from ebbsync.llm import warc
from ebbsync.session import written


def record(kind, number, day, status, *headers, body="", uri="http://a.test/x", length=None, warc_headers=()):
    """A record's text; ``day`` may be any text."""
    block = "\r\n".join([f"HTTP/1.1 {status}" if status else "nonsense", *headers]) + "\r\n\r\n" + body
    date = f"2024-01-{day:02d}T00:00:00Z" if isinstance(day, int) else day
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Target-URI: {uri}", f"WARC-Date: {date}", *warc_headers]
    if number is not None:
        lines.append(f"WARC-Record-ID: <{number}>")
    lines.append(f"Content-Length: {len(block.encode()) if length is None else length}")
    return "\r\n".join(lines) + "\r\n\r\n" + block + "\r\n\r\n"


def resolved(spark, *records):
    found = warc.resolve(warc.parse(spark.createDataFrame([(r,) for r in records], "raw STRING")))
    return sorted(((r.record_id or "", r.status, r.refers_to, r.payload) for r in found.collect()), key=repr)


def test_malformed_records_do_not_stop_the_others(spark):
    good = record("response", "r", 1, "200 OK", "ETag: e", body="GOOD")
    got = resolved(
        spark, good, record("revisit", "v", 2, "304 Not Modified", "ETag: e"),
        record("revisit", "no-date", "yesterday", "304 Not Modified", "ETag: e"),
        record("response", "odd", "2024-13-77T99:00:00Z", "200 OK", "ETag: e", body="x"),
        record("revisit", "odd-length", 3, "304 Not Modified", "ETag: e", length="12x"),
        record("response", "long", 4, "200 OK", "ETag: l", body="LONG", uri="http://a.test/l", length=9_999_999_999),
        record("response", "none", 4, "200 OK", "ETag: n", body="NONE", uri="http://a.test/n", length="12x"),
        record("revisit", "of-long", 5, "304 Not Modified", "ETag: l", uri="http://a.test/l"),
        record("revisit", "of-none", 5, "304 Not Modified", "ETag: n", uri="http://a.test/n"),
        "", "no record at all", None,
    )
    assert got == [
        ("no-date", "missing", None, None), ("odd-length", "resolved", "r", "GOOD"), ("of-long", "resolved", "long", "LONG\r\n\r\n"),
        ("of-none", "resolved", "none", "NONE"), ("v", "resolved", "r", "GOOD"),
    ]


def test_only_full_responses_stand_for_a_revisit(spark):
    got = resolved(
        spark,
        record("response", "r1", 1, "200 OK", "ETag: e", body="OLD"),
        record("response", "r2", 2, "200 OK", "ETag: e", body="GOOD"),
        record("response", "part", 3, "206 Partial Content", "ETag: e", body="GO"),
        record("response", "error", 4, "503 Service Unavailable", body="busy"),
        record("response", "lost", 4, "404 Not Found", "ETag: e", body="no"),
        record("response", "cut", 5, "200 OK", "ETag: e", body="GO", warc_headers=("WARC-Truncated: length",)),
        record("response", "raw", 5, None, "ETag: e", body="?"),
        record("revisit", "v", 6, "304 Not Modified", "ETag: e"),
        record("response", "r3", 7, "200 OK", "Last-Modified: Mon", body="NEW"),
        record("revisit", "same", 8, "304 Not Modified", "Last-Modified: Mon"),
        record("revisit", "other", 8, "304 Not Modified", "Last-Modified: Tue"),
        record("revisit", "neither", 8, "304 Not Modified"),
    )
    assert got == [
        ("neither", "unverified", None, None), ("other", "mismatch", None, None),
        ("same", "resolved", "r3", "NEW"), ("v", "resolved", "r2", "GOOD"),
    ]


def test_records_without_an_id_are_records_of_their_own(spark):
    twice = record("revisit", None, 4, "304 Not Modified", "ETag: e", "Age: 1")
    got = resolved(
        spark, record("response", None, 1, "200 OK", "ETag: e", body="ONE"), record("response", None, 2, "200 OK", "ETag: e", body="TWO"),
        record("revisit", None, 3, "304 Not Modified", "ETag: e"), twice, twice,
        record("revisit", None, 1, "304 Not Modified", "ETag: e", uri="http://b.test/"),
    )
    assert got == [("", "missing", None, None)] + [("", "resolved", None, "TWO")] * 3


def test_a_hot_address_with_many_captures(spark):
    """Every third capture is an error, each revisit is of the last full one."""
    records, expected = [], []
    for n in range(300):
        date = f"2024-01-{1 + n // 24:02d}T{n % 24:02d}:00:00Z"
        if n % 3 == 0:
            records.append(record("response", f"r{n:03d}", date, "200 OK", f"ETag: e{n}", body=f"body {n}"))
        elif n % 3 == 1:
            records.append(record("response", f"x{n:03d}", date, "500 Oops", f"ETag: e{n}", body="no"))
        else:
            records.append(record("revisit", f"v{n:03d}", date, "304 Not Modified", f"ETag: W/e{n - 2}"))
            expected.append((f"v{n:03d}", "resolved", f"r{n - 2:03d}", f"body {n - 2}"))
    assert resolved(spark, *records) == expected


def test_headers_are_taken_apart_once(spark):
    """Each line against the later ones must not take all lines apart again."""
    parsed = warc.parse(spark.range(1).selectExpr("string(id) AS raw"))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    # Split at line ends for the WARC headers, and for those of HTTP.
    assert plan.count("split(") == 2


def test_payloads_are_exchanged_once_and_ids_read_without_them(spark, folder):
    records = [
        record("response", "r", 1, "200 OK", "ETag: e", "A: 1", "a: 2", body="GOOD"),
        record("response", None, 1, "200 OK", "ETag: n", body="NONE", uri="http://a.test/n"),
        record("revisit", "v", 2, "304 Not Modified", "ETag: e"),
        record("revisit", None, 3, "304 Not Modified", "ETag: n", uri="http://a.test/n"),
    ]
    parsed = warc.parse(spark.createDataFrame([(r,) for r in records], "raw STRING"))
    found = warc.resolve(written(warc.keyed(parsed), folder), has_keys=True)
    plain = warc.resolve(parsed)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))
    assert {r.record_id: (r.payload, r.headers.get("a")) for r in found.collect()} == {"v": ("GOOD", "2"), None: ("NONE", None)}
    scans = [s for s in found._jdf.queryExecution().sparkPlan().toString().split("\n") if "FileScan" in s]
    assert len(scans) > 1
    assert sum("payload" in s.split("ReadSchema")[1] for s in scans) == 1
