"""WARC archives under Zstandard: one frame for each record, a dictionary at the head.

An archive begins with a skippable frame that holds the dictionary, as it is or compressed;
every record is a frame of its own, so a reader may start at any record. Pages with equal
payloads share one ``response`` record, that of the smallest id; the others are ``revisit``
records that name it and keep the HTTP head, whose Content-Length tells the payload's size.
Which is which comes from a grouped minimum over payload digests, joined back: a payload that
a third of all pages share is pre-aggregated, and its join is left to the adaptive skew join.

The reader checks every frame and record: dictionary, frame end, version line, header lines,
required fields, Content-Length against the bytes that are there, the closing line ends, and
for responses the HTTP head's length and the payload digest against the payload.

Nulls and the like: null html is an empty payload, the same as empty html; a null url is
written as the record's own name and read back as null; rows with a null ``page_id`` have
records without a number, never name a response, and are responses only if no page with an id
has their payload; rows that repeat the id of a response are all responses; an empty table
gives no archives; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typeferry.llm.common import PLACES, place, ship, thinned
from typeferry.llm.files import NewFile, read_file

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D.to_bytes(4, "little")
FRAME = 0xFD2FB528.to_bytes(4, "little")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

NAME = "urn:x-page:"
DATE = "1970-01-01T00:00:00Z"  # the pages carry no date, and archives should not differ by run
FIELDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string"
)
FEED = 1 << 14


class WarcError(ValueError):
    """An archive that breaks the format, with the place where it does."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The bytes of a record: a response, or a revisit of ``refers_to``."""
    name = f"{NAME}{'' if page_id is None else page_id}"
    target = name if url is None else quote(url, safe="".join(map(chr, range(33, 127))))
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{NAME}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def frames(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """The place and content of each frame of an archive, in order."""
    view, at, dictionary = memoryview(raw), 0, None
    while at < len(raw):
        magic = raw[at : at + 4]
        if 0x50 <= magic[0] <= 0x5F and magic[1:] == SKIPPABLE[1:]:
            size = int.from_bytes(raw[at + 4 : at + 8], "little")
            body = raw[at + 8 : at + 8 + size]
            if len(body) < size or len(raw) < at + 8:
                raise WarcError(f"skippable frame at {at} is cut off")
            if magic == SKIPPABLE and at == 0 and body:
                if body[:4] == FRAME:
                    body = zstandard.ZstdDecompressor().decompress(body)
                dictionary = zstandard.ZstdCompressionDict(body)
            at += 8 + size
            continue
        if magic != FRAME:
            raise WarcError(f"no frame at {at}")
        decoder = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        parts, start = [], at
        while not decoder.eof:
            fed = view[at : at + FEED]
            if not fed:
                raise WarcError(f"frame at {start} is cut off")
            try:
                parts.append(decoder.decompress(fed))
            except zstandard.ZstdError as error:
                raise WarcError(f"frame at {start}: {error}") from error
            at += len(fed) - len(decoder.unused_data)
        yield start, b"".join(parts)


def head_lines(raw: bytes, what: str) -> tuple[str, dict[str, str], bytes]:
    """First line, fields by lower-case name, and what follows the empty line."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found:
        raise WarcError(f"{what}: the head does not end")
    first, *lines = head.decode("utf-8").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise WarcError(f"{what}: not a field: {line!r}")
        if fields.setdefault(name.strip().lower(), value.strip()) != value.strip():
            raise WarcError(f"{what}: {name} is given twice")
    return first, fields, rest


def number(fields: dict[str, str], name: str, what: str) -> int:
    value = fields.get(name, "")
    if not value.isdigit():
        raise WarcError(f"{what}: {name} is not a number: {value!r}")
    return int(value)


def page_of(name: str, what: str) -> int | None:
    if not name.startswith(f"<{NAME}") or not name.endswith(">"):
        raise WarcError(f"{what}: not a page's name: {name!r}")
    return int(name[len(NAME) + 1 : -1]) if len(name) > len(NAME) + 2 else None


def parse(raw: bytes, what: str) -> tuple[dict, bytes | None]:
    """A record's ``FIELDS`` and its payload, None for a revisit; ``WarcError`` if it is wrong."""
    version, fields, rest = head_lines(raw, what)
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"{what}: version {version!r}")
    for name in REQUIRED:
        if name not in fields:
            raise WarcError(f"{what}: {name} is missing")
    length, kind = number(fields, "content-length", what), fields["warc-type"]
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"{what}: {len(rest) - 4} bytes where Content-Length says {length}")
    if kind not in ("response", "revisit"):
        raise WarcError(f"{what}: record type {kind!r}")
    status, http, payload = head_lines(rest[:length], what)
    if not status.startswith("HTTP/"):
        raise WarcError(f"{what}: no HTTP head")
    size = number(http, "content-length", what)
    given = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != size:
            raise WarcError(f"{what}: payload of {len(payload)} bytes, the HTTP head says {size}")
        if digest(payload) != given:
            raise WarcError(f"{what}: the payload does not have its digest")
    elif payload:
        raise WarcError(f"{what}: a revisit with a payload")
    elif "warc-refers-to" not in fields:
        raise WarcError(f"{what}: a revisit of nothing")
    name, url = fields["warc-record-id"], fields.get("warc-target-uri")
    row = {
        "page_id": page_of(name, what),
        "url": None if url is None or f"<{url}>" == name else url,
        "record_type": kind,
        "refers_to": page_of(fields["warc-refers-to"], what) if kind == "revisit" else None,
        "payload_bytes": size,
        "payload_digest": given,
    }
    return row, payload if kind == "response" else None


def train(pages: DataFrame, rows: int = 2_000, sample_bytes: int = 8 << 20, size: int = 64 << 10) -> bytes:
    """A compression dictionary from ``rows`` pages in expectation, by the hash of their id,
    and of each no more than its share of ``sample_bytes``. Where they are too few to train one,
    it is their own text; empty only if all are."""
    upto = int(PLACES * min(1.0, rows / max(pages.count(), 1)))
    low = thinned(pages.where(place(F.col("page_id")) < upto), rows).select(
        F.substring(F.col("html").cast("string"), 1, sample_bytes // rows).alias("html")
    )
    samples = sorted(r["html"].encode() for r in low.where("html <> ''").collect())
    try:
        wanted = min(size, sum(map(len, samples)) // 10)
        return zstandard.train_dictionary(wanted, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def with_responses(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``refers_to``: null for what is a response."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    shared = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy(F.col("sha").alias("own"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("own", "first")
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return rows.join(shared, F.col("sha") == F.col("own"), "left").select(
        "page_id", "url", "payload", F.when(later, F.col("first")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    archive_bytes: int = 64 << 20,
    dictionary: bytes | None = None,
) -> DataFrame:
    """Write a record for each page into archives under ``folder``; returns the list of them.

    ``archives``, a table beside the files, names those of finished tasks. A task starts a
    new file when one has ``archive_bytes``.
    """
    spark = pages.sparkSession
    ship(spark)
    trained = train(pages) if dictionary is None else dictionary

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zstandard.ZstdCompressionDict(trained) if trained else None
        compressor = zstandard.ZstdCompressor(level=3, dict_data=held, write_checksum=True)
        file, count = None, 0

        def done() -> pa.RecordBatch:
            file.close()
            return pa.RecordBatch.from_pylist(
                [{"file": file.name, "records": count, "bytes": file.size}]
            )

        for batch in batches:
            for at in range(batch.num_rows):
                row = [batch.column(k)[at].as_py() for k in range(4)]
                if file is None:
                    file, count = NewFile(folder, ".warc.zst"), 0
                    file.write(SKIPPABLE + len(trained).to_bytes(4, "little") + trained)
                file.write(compressor.compress(record(*row)))
                count += 1
                if file.size >= archive_bytes:
                    yield done()
                    file = None
        if file is not None:
            yield done()

    rows = with_responses(pages, least_bytes).mapInArrow(
        write, "file string, records long, bytes long"
    )
    rows.write.parquet(f"{folder}/archives")
    return archives(spark, folder)


def archives(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/archives")


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row of ``FIELDS`` for each record, and ``payload`` (null for revisits) if wanted."""
    ship(spark)
    schema = pa.schema(
        [(c, pa.string() if t == "string" else pa.int64())
         for c, t in (x.split() for x in FIELDS.split(", "))]
        + [("payload", pa.binary())] * with_payload
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.to_pylist():
                rows, held, seen = [], 0, 0
                for at, raw in frames(read_file(folder, archive["file"])):
                    row, payload = parse(raw, f"{archive['file']} at {at}")
                    rows.append(row | {"payload": payload} if with_payload else row)
                    held += len(payload or b"") if with_payload else 0
                    seen += 1
                    if held > 16 << 20 or len(rows) >= 5_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                if seen != archive["records"]:
                    raise WarcError(f"{archive['file']}: {seen} records of {archive['records']}")

    files = archives(spark, folder).select("file", "records")
    files = files.repartition(max(1, min(files.count(), 100_000)))
    return files.mapInArrow(read, FIELDS + ", payload binary" * with_payload)


def oracle() -> str:
    """What the archives say of ``pages`` in DuckDB's SQL: base 32 is put together by bits."""
    nibble = "strpos('0123456789abcdef', substr(sha, (5 * i + j) // 4 + 1, 1)) - 1"
    five = f"list_sum([((({nibble}) >> (3 - (5 * i + j) % 4)) & 1) << (4 - j) for j in range(5)])"
    return f"""with p as (select page_id, coalesce(html, '') as payload from pages),
    d as (select *, octet_length(encode(payload)) as size, sha1(payload) as sha,
        min(page_id) over (partition by payload) as first from p),
    r as (select *, page_id is null or page_id > first as later from d)
    select page_id, size::bigint as payload_bytes,
        array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ({five})::int, 1)
            for i in range(32)], '') as payload_digest,
        case when coalesce(later and first is not null, false) then 'revisit' else 'response' end
            as record_type,
        case when later then first end as refers_to
    from r"""
