import gzip
import hashlib
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfline.llm import warc
from shelfline.llm.queries import op4_warc
from shelfline.llm.warc import archived, page_of, read_warc, salvaged, write_warc

SCHEMA = "page_id long, url string, html string"
LONG = "é" * 700


def record(payload, digest=None, extra=""):
    digest = digest or hashlib.sha1(payload).hexdigest()
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:{digest}\r\n{extra}Content-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def found(data):
    rows = list(salvaged(data))
    return [r.payload for r in rows if r.gap is None], [(r.start, r.end, r.gap) for r in rows if r.gap]


def test_plain_archives_are_salvaged():
    a, b, c = record(b"one"), record(b"two WARC/1.0\r\n inside\r\n\r\n"), record(b"")
    assert found(a + b + c) == ([b"one", b"two WARC/1.0\r\n inside\r\n\r\n", b""], [])
    assert found(b"") == ([], []) and found(b"junk") == ([], [(0, 4, "no version line")])
    broken = bytearray(a)
    broken[-6] ^= 1
    assert found(bytes(broken) + b) == ([b"two WARC/1.0\r\n inside\r\n\r\n"], [(0, len(a), "digest")])
    assert found(a + a[:-5] + b) == ([b"one", b"two WARC/1.0\r\n inside\r\n\r\n"], [(len(a), 2 * len(a) - 5, "length")])
    assert found(a + b"xx" + b[:-3]) == ([b"one"], [(len(a), len(a) + 2 + len(b) - 3, "length")])
    assert found(a.replace(b"Length: 3", b"Length: -1") + c)[1][0][2] == "headers"


def test_members_are_salvaged():
    parts = [record(f"page {i} ".encode() * 50) for i in range(5)]
    members = [gzip.compress(p) for p in parts]
    assert found(b"".join(members))[1] == [] and len(found(b"".join(members))[0]) == 5
    hurt = bytearray(b"".join(members))
    at = len(members[0]) + len(members[1]) + 30
    hurt[at] ^= 255
    payloads, gaps = found(bytes(hurt))
    assert len(payloads) == 4 and [(s, e) for s, e, _ in gaps] == [(len(members[0] + members[1]), len(members[0] + members[1] + members[2]))]
    # Plain records among members, junk, and a member cut off at the end.
    data = members[0] + parts[1] + members[2] + b"junk" + members[3] + members[4][:-5]
    payloads, gaps = found(data)
    assert len(payloads) == 4 and [e - s for s, e, _ in gaps] == [4, len(members[4]) - 5]


def test_payloads_that_look_like_archives():
    for payload in (gzip.compress(record(b"inner")), record(b"inner"), b"WARC/1.0\r\n" * 50):
        assert found(record(payload) + record(b"next")) == ([payload, b"next"], [])


def test_random_damage_loses_only_damaged_records():
    draw = random.Random(3)
    for pack in (bytes, gzip.compress):
        for _ in range(60):
            payloads = [bytes(draw.choices(b"abc \r\n", k=draw.randrange(400))) for _ in range(8)]
            parts = [pack(record(p)) for p in payloads]
            data, hit = bytearray(b"".join(parts)), draw.randrange(8)
            start = sum(map(len, parts[:hit]))
            for _ in range(3):
                data[start + draw.randrange(len(parts[hit]))] ^= draw.randrange(1, 256)
            kept = Counter(found(bytes(data))[0])
            assert not Counter(payloads[:hit] + payloads[hit + 1 :]) - kept


def rows_of(spark, tmp_path, rows, schema=SCHEMA):
    folder = str(tmp_path / "archive")
    read = archived(spark.createDataFrame(rows, schema).repartition(3), folder)
    return folder, read.select(page_of(read.record_id).alias("p"), "payload_bytes", "payload_digest", "record_type", page_of(read.refers_to).alias("r"), "gap", "target_uri").collect()


def test_round_trip(spark, tmp_path):
    html = {1: LONG, 2: LONG, 9: LONG, 3: "short", 4: "short", 5: None, 6: "", 7: "WARC/1.1\r\n\r\n\r\n" * 9, 8: "x" * 3_000_000}
    rows = [(k, f"http://a/{k}", v) for k, v in html.items()] + [(None, "http://b\r\nc", LONG), (3, None, "short")]
    folder, read = rows_of(spark, tmp_path, [(*r, 1) for r in rows], SCHEMA + ", payload int")
    expected = Counter()
    for k, _, v in rows:
        data = (v or "").encode()
        again = k in (1, 2)
        expected[k, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 9 if again else None] += 1
    assert Counter((r.p, r.payload_bytes, r.payload_digest, r.record_type, r.r) for r in read) == expected
    assert all(r.gap is None for r in read) and {r.target_uri for r in read if r.p is None} == {"http://b%0D%0Ac"}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    full = read_warc(files)
    payloads = {page: bytes(p) for page, p in full.select(page_of(full.record_id), "payload").collect()}
    assert payloads[8] == b"x" * 3_000_000 and payloads[9] == LONG.encode() and payloads[1] == b""


def test_empty_table(spark, tmp_path):
    write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    archives = spark.createDataFrame([("a", None), ("b", bytearray())], "path string, content binary")
    assert read_warc(archives).collect() == []
    assert rows_of(spark, tmp_path, [])[1] == []


def test_query_on_the_samples(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    read = {r.page_id: r for r in op4_warc(spark, "/root/testdata/sf0.001").collect()}
    assert len(read) == len(pages)
    for p in pages:
        assert read[p.page_id].payload_digest == hashlib.sha1((p.html or "").encode()).hexdigest()


def test_urls_of_any_length_come_back(spark, tmp_path):
    rows = [(1, "http://a/" + "x" * 3_000_000, "short"), (2, "http://a/" + "y" * (1 << 20), LONG), (3, "http://b", LONG), (4, "u", "z" * 2_000_000)]
    _, read = rows_of(spark, tmp_path, rows)
    assert {r.p: (len(r.target_uri), r.gap) for r in read} == {k: (len(u), None) for k, u, _ in rows}
    assert {r.p: r.r for r in read} == {1: None, 2: 3, 3: None, 4: None}


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVES", ((100, 20), (1000, 4), (None, 1)))
    rows = [(i, "u", "a" * (10 if i % 3 else 500 if i % 2 else 5000)) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert archived(df, str(tmp_path / "w")).count() == 90
    records = [f.read_bytes().count(b"WARC/1.1") for f in (tmp_path / "w").glob("*.txt")]
    assert sorted(records) == [1] * 15 + [3] + [4] * 3 + [20] * 3


def test_a_gap_in_own_archives_fails_the_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "_record", lambda kind, key, *rest: F.concat(F.lit("WARC/1.1\r\nno header"), key.cast("string")))
    with pytest.raises(Exception, match="gap in .*headers"):
        archived(spark.createDataFrame([(1, "u", "text")], SCHEMA), str(tmp_path / "w")).count()


def test_older_versions():
    for version in (b"0.9", b"0.17", b"0.18", b"1.0", b"1.1"):
        data = record(b"one").replace(b"WARC/1.0", b"WARC/" + version)
        assert found(b"junk" + data + data) == ([b"one", b"one"], [(0, 4, "no version line")])


def test_time_to_salvage_grows_with_the_archive_alone():
    def seconds(data):
        start = time.perf_counter()
        assert found(data)[0] == [b"last"] * data.endswith(b"last\r\n\r\n")
        return time.perf_counter() - start

    # Version lines without an end of headers, and with one far behind them.
    for make in (lambda n: b"WARC/1.0\r\nA: b\r\n" * n, lambda n: b"WARC/1.0\r\nA: b\r\n" * n + record(b"last"), lambda n: b"WARC/1.0\r\n" * n + b"x"):
        assert seconds(make(40_000)) < 20 * max(0.02, seconds(make(10_000)))
