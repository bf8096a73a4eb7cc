import gzip
import hashlib
import io

import duckdb
import pytest

from wardenlake.llm import warc
from wardenlake.llm.catalog import ORACLE, op10_warc


def archive(*pages):
    return b"".join(warc.record(i, url, body, hashlib.sha256(body).hexdigest(), refers) for i, url, body, refers in pages)


def read(raw, **options):
    return list(warc.records(io.BytesIO(raw), "test", **options))


def test_records_round_trip():
    body = b"<p>\r\n\r\nWARC/1.1\r\n</p>" * 9000
    raw = archive((1, "http://a/\r\nx%", body, None), (2, None, body, 1), (None, "u", b"", None))
    one, two, three = read(raw, keep_payload=True)
    assert one["payload"] == body and one["record_type"] == "response" and one["payload_bytes"] == len(body)
    assert (two["record_type"], two["refers_to"], two["payload_bytes"]) == ("revisit", 1, len(body))
    assert two["payload_digest"] == hashlib.sha256(body).hexdigest() and two["payload"] is None
    assert three["page_id"] is None and three["payload_bytes"] == 0
    assert gzip.decompress(raw).count(b"WARC-Type") == 3


@pytest.mark.parametrize("damage", ["cut", "digest", "length", "junk"])
def test_damage_is_found(damage):
    raw = archive((1, "u", b"hello" * 50, None))
    if damage == "cut":
        raw = raw[:-10]
    elif damage == "junk":
        raw += b"\0\0"
    else:
        plain = gzip.decompress(raw)
        plain = plain.replace(b"hello", b"jello", 1) if damage == "digest" else plain + b"more"
        raw = gzip.compress(plain)
    with pytest.raises(warc.ArchiveError):
        read(raw)


ROWS = [
    (5, "a", "x" * 100), (3, "b", "x" * 100), (9, "c", "x" * 100), (4, "d", "x" * 99), (8, None, "x" * 99), (2, "f", None),
    (1, "g", ""), (None, "h", "x" * 100), (7, "i", "é" * 50), (6, "j", "é" * 50), (3, "k", "x" * 100), (None, "l", "z" * 200),
    (10, "m", "long " * 100_000),
]


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(*r, 0) for r in ROWS]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to int")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    key = lambda r: tuple(map(str, r))
    got = op10_warc(spark, str(tmp_path))
    want = con.execute(ORACLE["op10_warc"])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_small_archives_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i}" * 500) for i in range(40)], "page_id long, url string, html string")
    manifest = warc.write_archives(pages.coalesce(1), str(tmp_path / "a"), size=1000)
    assert manifest.count() > 3 and manifest.agg({"records": "sum"}).first()[0] == 40
    back = {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(manifest, keep_payload=True).collect()}
    assert back == {i: f"{i}".encode() * 500 for i in range(40)}
    assert warc.archived_pages(pages.limit(0)).collect() == []
