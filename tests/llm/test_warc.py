import gzip
import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import warc as w
from tests.llm.helpers import clashing

PAGES = "page_id long, url string, html string"
LONG = "<p>é\U0001f600 body</p>\r\n\r\nWARC/1.1\r\n" * 700


def pages(spark):
    rows = [
        (1, "http://a.example/ü?q=a b\r\nX: y", "short"), (2, None, None), (3, "http://b.example", ""), (4, "u", "short"),
        (5, "u", "x" * 999), (6, "u", "x" * 999), (7, "u", "y" * 1000), (8, "u", "y" * 1000), (9, "u", "é" * 600), (10, "u", LONG),
        (11, "u", LONG), (12, "u", LONG + "!"), (None, "u", "z" * 2000), (None, "u", "short"), (20, "u", LONG * 3), (20, "u", LONG * 3),
    ]
    return spark.createDataFrame(rows, PAGES)


def expected(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        keeper = max(same, default=None) if len(payload) >= 1000 else page_id
        kind = "response" if page_id == keeper else "revisit"
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), kind, keeper if kind == "revisit" else None, None))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment, archive", [(64, 2_000), (4096, 8 << 20), (1 << 20, 1)])
def test_round_trip(spark, tmp_path, segment, archive):
    df = clashing(pages(spark), "digest", "keeper", "repeated", "payload")
    w.write_archives(df.repartition(3), str(tmp_path / "a"), segment, archive)
    back = w.read_archives(spark, str(tmp_path / "a"), keep_payload=True)
    rows = back.collect()
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["problem"]) for r in rows]
    assert sorted(found, key=str) == expected([tuple(r) for r in pages(spark).collect()])
    for r in rows:
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
    assert {r["url"] for r in rows if r["page_id"] == 1} == {"http://a.example/%C3%BC?q=a%20b%0D%0AX:%20y"}


def test_archives_are_plain_warc(spark, tmp_path):
    w.write_archives(pages(spark).coalesce(1), str(tmp_path / "a"), 1000)
    (path,) = (tmp_path / "a").glob("part-*.gz")
    data = gzip.decompress(path.read_bytes())
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(w.END)
    headers = [h for h, _ in w.records(data)]
    first = next(h for h in headers if h.get("warc-segment-number") == "1" and h.get("x-page-id") == "12")
    parts = [h for h in headers if h.get("warc-segment-origin-id") == first["warc-record-id"]]
    assert [int(h["warc-segment-number"]) for h in parts] == list(range(2, len(parts) + 2))
    assert [h["warc-type"] for h in parts] == ["continuation"] * len(parts)
    assert "warc-segment-total-length" in parts[-1] and "warc-segment-total-length" not in parts[0]


def test_lost_and_damaged_segments_are_told(spark, tmp_path):
    records = list(w.page_records(1, "u", b"a" * 5000, None, False, 1000))
    assert len(records) > 3
    other = list(w.page_records(2, "u", b"b" * 5000, None, False, 1000))
    third = list(w.page_records(3, "u", b"c" * 5000, None, False, 1000))
    fourth = list(w.page_records(4, "u", b"d" * 5000, None, False, 1000))
    fifth = list(w.page_records(5, "u", b"e" * 50, None, False, 1000))
    revisit = list(w.page_records(6, "u", b"f" * 5000, 99, True, 1000))
    fourth[2] = fourth[2].replace(b"dddd", b"dxdd", 1)
    kept = [*records[::-1], *other[:1], *other[2:], *third[:-1], *fourth, *fifth, *revisit]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.gz").write_bytes(gzip.compress(w.END.join([*kept, b""])))
    found = {r["page_id"]: (r["payload_bytes"], r["problem"]) for r in w.read_archives(spark, str(tmp_path / "a")).collect()}
    assert found == {
        1: (5000, None), 2: (None, "segment is missing"), 3: (None, "segment is missing"),
        4: (None, "digest differs"), 5: (50, None), 6: (None, "revisited record is missing"),
    }


def test_length_is_verified():
    parts = [{"segment": 1, "total": None, "block": b"abc"}, {"segment": 2, "total": 7, "block": b"def"}]
    assert list(w.joined_segments(parts)) == [(None, "length is 6 of 7")]
    parts[1]["total"] = 6
    assert list(w.joined_segments(parts[::-1])) == [(b"abcdef", None)]
    assert list(w.joined_segments(parts * 2)) == [(b"abcdef", None)] * 2
    assert list(w.joined_segments([*parts, parts[0]])) == [(None, "copies of segments differ")] * 2


@given(st.binary(max_size=400), st.integers(1, 50))
def test_chunked_framing(payload, size):
    body = w.chunked(payload, size)
    assert w.unchunked(body) == payload
    assert w.payload_of(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n" + body) == payload
    assert w.payload_of(b"HTTP/1.1 200 OK\r\n\r\n" + body) == body
    with pytest.raises(ValueError):
        w.unchunked(body[:-5])


def test_empty_table(spark, tmp_path):
    w.write_archives(pages(spark).limit(0), str(tmp_path / "a"))
    assert w.read_archives(spark, str(tmp_path / "a")).count() == 0


def test_many_equal_payloads(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("q" * 1500).alias("html"))
    w.write_archives(df, str(tmp_path / "a"))
    back = w.read_archives(spark, str(tmp_path / "a"))
    assert {tuple(r) for r in back.groupBy("record_type", "refers_to", "payload_bytes").count().collect()} == {
        ("response", None, 1500, 1), ("revisit", 499, 1500, 499),
    }
