import gzip
import hashlib
import io
import random

import pytest

from silvertide.llm import warc
from silvertide.llm.oracle import OP8


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def fixture():
    rng = random.Random(1)
    say = lambda n: "".join(rng.choice("abcdé<>\n ") for _ in range(n))
    same, short = say(400), "s" * 99
    rows = [(i, f"http://h{i}.example.com/a b", rng.choice([same, short, say(500), "", None, "x" * 100])) for i in range(200)]
    return rows + [(900, None, same), (3, "http://again/", rows[3][2]), (None, "http://none/", same), (901, "u", say(300_000))]


def test_round_trip_equals_sql(spark):
    import duckdb

    rows = fixture()
    got = sorted(tuple("" if x is None else str(x) for x in r) for r in warc.round_trip(pages(spark, rows)).drop("url").collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = sorted(tuple("" if x is None else str(x) for x in r) for r in con.execute(OP8).fetchall())
    assert got == want
    assert warc.round_trip(pages(spark, [])).count() == 0


@pytest.mark.parametrize("split", [37, 1000, 8 << 20])
def test_every_split_reads_each_record_once(spark, tmp_path, split):
    rows = [(i, f"u{i}", (f"<p>{i}</p>" * (i * 37 % 50))) for i in range(60)]
    files = warc.write_archives(warc.classified(pages(spark, rows).repartition(3)), f"file://{tmp_path}/{split}")
    got = warc.read_archives(spark, files, split_bytes=split, with_payload=True).collect()
    bodies = {i: h for i, _, h in rows}
    assert sorted(r.page_id for r in got) == list(range(60))
    for r in got:
        assert r.payload_digest == hashlib.sha256(bodies[r.page_id].encode()).hexdigest() and r.payload_bytes == len(bodies[r.page_id])
        assert r.payload == (bodies[r.page_id].encode() if r.record_type == "response" else b"")


def test_files_are_plain_gzip(spark, tmp_path):
    files = warc.write_archives(warc.classified(pages(spark, [(1, "u", "hello"), (2, "v", "h" * 200), (3, "w", "h" * 200)])), f"file://{tmp_path}/x")
    text = b"".join(gzip.decompress(open(r.path.removeprefix("file://"), "rb").read()) for r in files.collect())
    assert text.count(b"WARC/1.1\r\n") == 3 and text.count(b"WARC-Type: revisit") == 1
    assert b"WARC-Refers-To: <urn:page:2>" in text and b"hello" in text


def test_false_magic_is_passed_over():
    good = [warc.record("response", str(i), "u", "d", 3, b"abc", None) for i in range(3)]
    noise = warc.MAGIC + b"\x00junk" + warc.MAGIC + gzip.compress(b"not a record at all")
    blob = noise + good[0] + noise + good[1] + good[2] + warc.MAGIC
    for split in (5, 50, len(blob)):
        found = [m for s in range(0, len(blob), split) for m in warc.members(io.BytesIO(blob), len(blob), s, min(s + split, len(blob)))]
        assert [warc.parse(m)[0]["warc-record-id"] for m in found] == [f"<urn:page:{i}>" for i in range(3)]


def test_ranges_are_read_by_as_many_tasks(spark, tmp_path, monkeypatch):
    files = warc.write_archives(warc.classified(pages(spark, [(i, f"u{i}", f"<p>{i}</p>" * 90) for i in range(80)])), f"file://{tmp_path}/x")
    ranges = sum(-(-r.bytes // 500) for r in files.collect())
    assert ranges > 10
    for most, wanted in ((1000, ranges), (7, 7)):
        monkeypatch.setattr(warc, "READ_TASKS", most)
        found = warc.read_archives(spark, files, split_bytes=500)
        assert found.rdd.getNumPartitions() == wanted and found.count() == 80
