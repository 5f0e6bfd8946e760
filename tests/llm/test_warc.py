import base64
import gzip
import hashlib
import io
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from onefold.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, _row int, warc_type string"
ROWS = [
    (5, "http://a/1", "<p>one</p>"), (3, "http://a/2", "<p>one</p>"), (9, None, "<p>one</p>"), (1, "http://a/\r\nX: y", None),
    (2, "http://a/é", ""), (7, "http://b/7", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"), (8, "http://b/8", "😀" * 300_000),
    (4, "http://b/4", "same"), (4, "http://b/4", "same"), (None, "http://n", "same"), (None, "http://n", "alone"), (6, "", "\x00\x1f\x8b\n"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


def brute(rows, least=0):
    groups, out = {}, Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        groups.setdefault(data if len(data) >= least else (data, len(out), id(page), len(groups)), []).append(page)
    for data, ids in groups.items():
        data = data if isinstance(data, bytes) else data[0]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids.sort(key=lambda i: (i is None, i or 0))
        for nth, page in enumerate(ids):
            out[page, len(data), digest, "revisit" if nth else "response", ids[0] if nth else None] += 1
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip_equals_brute_force(spark, least):
    got = warc.round_trip(pages(spark), least_bytes=least).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(ROWS, least)
    payloads = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response" and r.page_id is not None}
    assert all(payloads[i] == (h or "").encode() for i, _, h in ROWS if i in payloads)
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_empty_table(spark):
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "archive")
    warc.archive_pages(pages(spark), path, date="2024-05-06T07:08:09Z")
    return path


def test_predicates_are_taken_over(spark, archive):
    full = {r.record_id: r for r in warc.read_warc(spark, archive).collect()}
    assert len(full) == len(ROWS)
    tests = [
        F.col("warc_type") == "revisit", F.col("warc_type") != "revisit", F.col("target_uri").startswith("http://b"),
        F.col("target_uri").isNull(), F.col("target_uri").isNotNull(), ~F.col("target_uri").contains("a"), F.col("content_length") > 200,
        F.col("refers_to").isin("<urn:page:3:1>", "x"), ~F.col("warc_type").isin("revisit"), F.col("target_uri").eqNullSafe(None),
        F.col("warc_date") <= "2024-05-06T07:08:09Z", F.col("target_uri").endswith("4") & (F.col("warc_type") == "response"),
    ]
    everything = spark.createDataFrame(list(full.values()), warc.SCHEMA).select(*[t.alias(f"t{i}") for i, t in enumerate(tests)], "record_id")
    everything = everything.collect()
    for nth, test in enumerate(tests):
        want = {r.record_id for r in everything if r[f"t{nth}"]}
        for payload in (True, False) if nth < 3 else (False,):
            got = warc.read_warc(spark, archive, payload=payload).filter(test).collect()
            assert {r.record_id for r in got} == want and len(got) == len(want)
            assert all(r.payload == (full[r.record_id].payload if payload else None) for r in got)
    plan = warc.read_warc(spark, archive).filter(F.col("warc_type") == "revisit")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")  # Spark has nothing left to test


def test_headers_and_record_fields(spark, archive):
    rows = {r.record_id: r for r in warc.read_warc(spark, archive).collect()}
    one = next(r for r in rows.values() if r.target_uri == "http://a/%0D%0AX: y")
    assert one.headers["warc-date"] == "2024-05-06T07:08:09Z" and "x" not in one.headers
    again = next(r for r in rows.values() if r.warc_type == "revisit")
    assert again.headers["warc-profile"] == warc.REVISIT_PROFILE and rows[again.refers_to].warc_type == "response"


def record(kind, uri, block, extra=b""):
    head = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Target-URI: %s\r\n%sContent-Length: %d\r\n\r\n" % (kind, uri, extra, len(block))
    return head + block + b"\r\n\r\n"


RECORDS = [
    record(b"warcinfo", b"x", b"software: y\r\n", b"Content-Type: application/warc-fields\r\n"),
    record(b"response", b"http://a", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\r\n\r\nWARC/1.0\r\n", b"Content-Type:application/http; msgtype=response\r\nX-Long: one\r\n  two\r\n"),
    record(b"resource", b"http://b", b"z" * 200_000, b"Content-Type: text/plain\r\n"),
    record(b"response", b"http://c", b"HTTP/1.1 200 OK\r\n\r\n", b"content-type: application/http\r\n"),
]


@pytest.mark.parametrize("made", ["plain", "one_member", "members", "told_members"])
@pytest.mark.parametrize("wanted", [None, "response", "resource"])
@pytest.mark.parametrize("payload", [True, False])
def test_foreign_archives(made, wanted, payload):
    packed = {
        "plain": b"".join(RECORDS),
        "one_member": gzip.compress(b"".join(RECORDS)),
        "members": b"".join(gzip.compress(r) for r in RECORDS),
        "told_members": b"".join(warc.gzip_member([r]) for r in RECORDS),
    }[made]
    assert made != "told_members" or gzip.decompress(packed) == b"".join(RECORDS)
    stream = warc.Stream(pa.PythonFile(io.BytesIO(packed), mode="r"))
    got = list(warc.read_records(stream, lambda r: wanted in (None, r.value("warc_type")), payload))
    assert [r.value("target_uri") for r in got] == [u for u, k in (("x", "warcinfo"), ("http://a", "response"), ("http://b", "resource"), ("http://c", "response")) if wanted in (None, k)]
    bodies = {"x": b"software: y\r\n", "http://a": b"body\r\n\r\nWARC/1.0\r\n", "http://b": b"z" * 200_000, "http://c": b""}
    assert all(r.payload == (bodies[r.value("target_uri")] if payload else None) for r in got)
    assert all(r.headers["x-long"] == "one two" for r in got if r.value("target_uri") == "http://a")


def test_unwanted_records_are_not_inflated():
    big = [record(b"resource", b"u%d" % i, hashlib.sha512(b"%d" % i).digest() * 40_000) for i in range(20)]
    stream = warc.Stream(pa.PythonFile(io.BytesIO(b"".join(warc.gzip_member([r]) for r in big)), mode="r"))
    assert not list(warc.read_records(stream, lambda r: False, True))
    assert stream.inflated < 100_000 < sum(map(len, big))


def test_damaged_archives_are_refused():
    whole = b"".join(RECORDS)
    for data in (whole[:-100], gzip.compress(whole)[:-100], b"no record\r\n\r\n", b"x" * 100):
        with pytest.raises((EOFError, ValueError)):
            list(warc.read_records(warc.Stream(pa.PythonFile(io.BytesIO(data), mode="r")), lambda r: True, True))


def test_files_are_planned(tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * 10)
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "6.warc").write_bytes(b"x")
    planned = [p.value for p in warc.plan_files(str(tmp_path), 25)]
    assert [len(p) for p in planned] == [2, 2, 1] and not any("_temporary" in x for p in planned for x in p)
    assert [len(p.value) for p in warc.plan_files(str(tmp_path), 1)] == [1] * 5
    with pytest.raises(FileNotFoundError):
        warc.plan_files(str(tmp_path / "none"), 1)
