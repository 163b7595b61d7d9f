import base64
import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from typeferry.llm import warc
from typeferry.llm.common import fresh_folder
from typeferry.llm.queries import op5_warc

SF_DIR = "/root/testdata/sf0.01"


def test_query_against_the_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    first = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        first.setdefault(p.html or "", p.page_id)
    expected = set()
    for p in pages:
        payload = (p.html or "").encode()
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        to = first[p.html or ""]
        kind = "response" if to == p.page_id else "revisit"
        expected.add((p.page_id, len(payload), own, kind, None if to == p.page_id else to))
    got = op5_warc(spark, SF_DIR)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert {tuple(r) for r in got.collect()} == expected


def archive(*records, dictionary=b"", packed=False):
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    body = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
    frame = zstandard.ZstdCompressor(dict_data=held)
    head = warc.SKIPPABLE + len(body).to_bytes(4, "little") + body
    return head + b"".join(map(frame.compress, records))


def read(raw):
    return [warc.parse(content, f"at {at}") for at, content in warc.frames(raw)]


def trained():
    pages = [f"<html><body>page {i} of the site {i * i}</body></html>".encode() for i in range(900)]
    return zstandard.train_dictionary(2048, pages).as_bytes()


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_frame(packed):
    payload = b"<p>text</p>" * 5_000
    records = [warc.record(1, "http://a/?b=\r\nc", payload, None), warc.record(2, None, payload, 1)]
    raw = archive(*records, dictionary=trained(), packed=packed)
    (one, body), (two, none) = read(raw)
    assert body == payload and none is None
    assert one["url"] == "http://a/?b=%0D%0Ac" and two["url"] is None
    assert two["refers_to"] == 1 and two["payload_bytes"] == len(payload)
    assert one["payload_digest"] == two["payload_digest"] == warc.digest(payload)
    with pytest.raises(warc.WarcError):  # without its dictionary
        size = int.from_bytes(raw[4:8], "little")
        read(raw[8 + size :])


def test_wrong_archives():
    good = warc.record(1, "http://a/", b"payload", None)
    assert len(read(archive(good))) == 1
    assert read(b"") == []
    wrong = [
        good.replace(b"WARC/1.1", b"WARX/1.1"),
        good.replace(b"WARC-Date", b"WARC-Dat"),
        good.replace(b"payload\r\n", b"payl0ad\r\n"),
        good.replace(b"payload\r\n", b"payloads\r\n"),
        good[:-2],
        good.replace(b"WARC-Type: response", b"WARC-Type: unknown"),
        good.replace(b"Content-Length: 7", b"Content-Length: 8"),
        good.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
        good.replace(b"WARC-Type: response", b"no field"),
        b"",
    ]
    for record in wrong:
        with pytest.raises(warc.WarcError):
            read(archive(record))
    raw = archive(good)
    for cut in (raw[:-3], raw[:5], raw + b"tail"):
        with pytest.raises(warc.WarcError):
            read(cut)


def test_odd_rows(spark):
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "x"), (3, "u", "x"), (5, "u", "x"),
        (None, "u", "x"), (None, "u", "only"), (None, "u", "only"), (8, "é ü", "y" * 3_000_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select(
        "*", F.lit(1).alias("payload"), F.lit("s").alias("sha"), F.lit(2).alias("own")
    )
    folder = fresh_folder(spark, "test")
    warc.write_archives(pages, folder, archive_bytes=400)
    found = warc.read_archives(spark, folder).collect()
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in found)
    assert got == sorted([
        ("1", "response", "None"), ("2", "revisit", "1"), ("3", "response", "None"),
        ("3", "response", "None"), ("5", "revisit", "3"), ("None", "revisit", "3"),
        ("None", "response", "None"), ("None", "response", "None"), ("8", "response", "None"),
    ])
    assert {len(r.payload) for r in found if r.page_id == 8} == {3_000_000}
    larger = warc.with_responses(pages, least_bytes=2).where("refers_to is not null")
    assert larger.count() == 0
    empty = fresh_folder(spark, "test")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0
