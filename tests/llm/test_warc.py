import gzip
import io
import random
import zlib

import pytest

from tests.llm.util import same_as_sql
from tillroll.llm import warc
from tillroll.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_query_equals_its_sql(spark, tables):
    same_as_sql(QUERIES["op4_warc"](spark, SF), tables, ORACLE_SQL["op4_warc"])


@pytest.fixture(scope="module")
def pages(spark):
    body = "<p>" + "é漢\U0001f600\r\n\r\nWARC/1.0\r\n" * 20 + "</p>"
    return spark.createDataFrame(
        [(5, "http://a/\r\nX: y", body, 1), (2, "http://b/", body, 2), (9, None, body, 3), (2, "http://b/", body, 2), (1, "u", None, 4),
         (3, "u", "", 5), (4, "u", "short", 6), (6, "u", "short", 7), (7, "u", "x" * 3_000_000, 8), (None, "u", body, 9)],
        "page_id long, url string, html string, offset long",
    )


def test_round_trip_returns_every_payload(spark, pages):
    got = warc.round_trip(pages, payloads=True).collect()
    assert len(got) == 10
    want = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    for r in got:
        if r["record_type"] == "response":
            assert r["payload"] == want[r["page_id"]] and r["payload_bytes"] == len(want[r["page_id"]].encode())
        else:
            assert r["payload"] is None and r["refers_to"] == 2 and r["page_id"] in (5, 9) and r["payload_bytes"] == len(want[5].encode())
    assert sorted(r["page_id"] for r in got if r["record_type"] == "revisit") == [5, 9]


def test_normalised_archives_are_members_at_the_indexed_offsets(spark, pages, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    warc.write_archives(warc.record_types(pages).coalesce(2), raw)
    for f in (tmp_path / "raw").glob("*.gz"):
        d = zlib.decompressobj(31)
        d.decompress(f.read_bytes())
        assert d.eof and not d.unused_data  # one stream
    done = warc.normalise(spark, raw, out).collect()
    assert sum(r["records"] for r in done) == 10
    index = warc.read_index(spark, out).collect()
    for name in {r["archive"] for r in index}:
        data = (tmp_path / "out" / name).read_bytes()
        own = sorted((r["offset"], r["length"]) for r in index if r["archive"] == name)
        assert own[0][0] == 0 and own[-1][0] + own[-1][1] == len(data)
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        for a, n in own:
            record = zlib.decompress(data[a : a + n], 31)
            assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n")
        whole = next((tmp_path / "raw").glob(name.split(".")[0] + "*.gz"))
        assert gzip.decompress(data) == gzip.decompress(whole.read_bytes())
    # a repeated task gives the same bytes
    before = {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")}
    warc.normalise(spark, raw, out)
    assert before == {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")}


def test_normalise_accepts_records_in_separate_members(tmp_path):
    rng = random.Random(1)
    records = []
    for i in range(20):
        block = bytes(rng.randrange(256) for _ in range(rng.randint(0, 3000)))
        records.append(f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <r{i}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
    source = tmp_path / "a.warc.gz"
    source.write_bytes(b"".join(gzip.compress(b"".join(records[i : i + 7])) for i in range(0, 20, 7)))
    assert warc.normalise_file(f"file://{source}", str(tmp_path / "n")) == 20
    data, members = (tmp_path / "n" / "a.warc.gz").read_bytes(), []
    while data:
        d = zlib.decompressobj(31)
        members.append(d.decompress(data))
        data = d.unused_data
    assert members == records


def test_broken_archives_raise():
    with pytest.raises(ValueError):
        warc.read_headers(io.BytesIO(b"GET / HTTP/1.1\r\n\r\n"))
    with pytest.raises(ValueError):
        warc.read_headers(io.BytesIO(b"WARC/1.0\r\nWARC-Type: response\r\n"))
    block = b"HTTP/1.1 200 OK\r\n\r\nother"
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: %d\r\n\r\n" % len(block)
    with pytest.raises(ValueError):
        warc.parse_member(gzip.compress(head + block + b"\r\n\r\n"))


def test_empty_table(spark, pages):
    assert warc.round_trip(pages.limit(0)).count() == 0
