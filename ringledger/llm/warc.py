"""WARC archives: write, read back, and resolve repeated payloads to revisit records.

Archives are gzip files of WARC/1.1 records, written by Spark's text writer: a record is
text, since a page is, and the two line breaks that end each record are the writer's line
separator. Reading unpacks a file piece by piece and goes by Content-Length, so payloads
may hold anything. A task holds one packed archive (``ARCHIVE_RECORDS`` bounds its records)
and the record at hand.

To resolve repeats, only headers are shuffled: the originals are found by an aggregate over
payload digests, which Spark combines before the shuffle, and joined to the records of
digests that occur more than once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.llm.storage import shared_path, written

#: Fixed values of the format: WARC/1.1 (ISO 28500) and base32 (RFC 4648).
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

MIN_PAYLOAD_BYTES = 0
ARCHIVE_RECORDS = 20_000
CAPTURE_DATE = "2024-01-01T00:00:00Z"
_HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_END = "\r\n\r\n"

_HEADERS = {
    "record_type": ("WARC-Type", pa.string()),
    "record_id": ("WARC-Record-ID", pa.string()),
    "date": ("WARC-Date", pa.string()),
    "url": ("WARC-Target-URI", pa.string()),
    "payload_digest": ("WARC-Payload-Digest", pa.string()),
    "refers_to_id": ("WARC-Refers-To", pa.string()),
    # Fields of our own; the standard allows them.
    "page_id": ("Page-ID", pa.int64()),
    "payload_bytes": ("Payload-Length", pa.int64()),
    "refers_to": ("Refers-To-Page-ID", pa.int64()),
}
_SCHEMA = (
    "record_type string, record_id string, date string, url string, payload_digest string,"
    " refers_to_id string, page_id long, payload_bytes long, refers_to long,"
    " archive string, number long"
)


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text's UTF-8."""
    digits = F.sha1(text)
    letters = []
    for i in range(0, 40, 5):  # five hex digits are 20 bits, which are four letters
        bits = F.conv(F.substring(digits, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*letters)


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(key: Column) -> Column:
    """A record id that follows from ``key``, as a version 5 UUID."""
    h = F.sha1(key)
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
             F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(head: list[Column], content_type: str, block: Column) -> Column:
    """A whole record but for the line breaks at its end."""
    length = F.octet_length(block).cast("string")
    lines = [*head, _header("Content-Type", F.lit(content_type)), _header("Content-Length", length)]
    return F.concat(F.lit(f"{VERSION}\r\n"), *lines, F.lit("\r\n"), block)


def _write(records: DataFrame, label: str) -> str:
    path = shared_path(records.sparkSession, label)
    (
        records.write.option("lineSep", _END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ARCHIVE_RECORDS)
        .option("zlib.compress.level", "BEST_SPEED")
        .text(path)
    )
    return path


def write_pages(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> str:
    """Write a response record per row; returns the folder of the archives.

    A null html is an empty payload. Control characters and blanks in a url become %20, so
    that it stays one header line; a null url becomes ``about:blank``. A null id writes no
    id header and reads back as null.
    """
    payload = F.coalesce(pages[html_column].cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce(pages[url_column], F.lit("about:blank")), r"[\x00-\x20\x7f]", "%20")
    page = pages[id_column].cast("string")
    key = F.concat_ws("\n", F.coalesce(page, F.lit("")), url, base32_sha1(payload))
    head = [
        _header("WARC-Type", F.lit("response")),
        _header("WARC-Record-ID", _urn(key)),
        _header("WARC-Date", F.lit(CAPTURE_DATE)),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(payload))),
        _header("Page-ID", page),
        _header("Payload-Length", F.octet_length(payload).cast("string")),
    ]
    block = F.concat(F.lit(_HTTP_HEAD), payload)
    record = _record(head, "application/http;msgtype=response", block)
    return _write(pages.select(record.alias("value")), "warc")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row per record: its headers, its archive and number there, and its payload if asked."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                yield from _rows(name.as_py(), content.as_buffer(), payloads)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(tasks, _SCHEMA + (", payload string" if payloads else ""))


def _rows(name: str, content: pa.Buffer, payloads: bool) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    size = 0
    for number, (head, payload) in enumerate(parse(content)):
        held.append(_row(head) | {"archive": name, "number": number})
        if payloads:
            held[-1]["payload"] = payload
            size += len(payload)
        if len(held) == 1000 or size > 4 << 20:
            yield _batch(held, payloads)
            held, size = [], 0
    if held:
        yield _batch(held, payloads)


def _batch(rows: list[dict], payloads: bool) -> pa.RecordBatch:
    fields = [(name, kind) for name, (_, kind) in _HEADERS.items()]
    fields += [("archive", pa.string()), ("number", pa.int64())]
    if payloads:
        fields.append(("payload", pa.string()))
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))


def _row(head: dict[str, str]) -> dict:
    row = {}
    for name, (header, kind) in _HEADERS.items():
        value = head.get(header)
        row[name] = int(value) if value is not None and kind == pa.int64() else value
    row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:")
    return row


def parse(content: bytes | pa.Buffer) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of each record of a packed archive."""
    pieces = _Pieces(content)
    while pieces.more():
        lines = pieces.until(b"\r\n\r\n").decode().split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        block = pieces.take(int(head["Content-Length"]))
        pieces.take(len(_END))
        payload = block.partition(b"\r\n\r\n")[2] if head["WARC-Type"] == "response" else b""
        yield head, payload


class _Pieces:
    """Unpacks a gzip file by pieces, also one of several members."""

    def __init__(self, content: bytes | pa.Buffer) -> None:
        self.packed, self.at = memoryview(content), 0
        self.unpacker, self.held = zlib.decompressobj(31), bytearray()

    def _grow(self) -> bool:
        while True:
            if self.unpacker.eof:
                rest = self.unpacker.unused_data
                self.at -= len(rest)
                self.unpacker = zlib.decompressobj(31)
            if self.at >= len(self.packed):
                return False
            piece = self.packed[self.at : self.at + (1 << 18)]
            self.at += len(piece)
            plain = self.unpacker.decompress(piece)
            if plain:
                self.held += plain
                return True

    def more(self) -> bool:
        return bool(self.held) or self._grow()

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (end := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self._grow():
                raise ValueError("an archive ends inside a record")
        found = bytes(self.held[:end])
        del self.held[: end + len(mark)]
        return found

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self._grow():
                raise ValueError("an archive ends inside a record")
        found = bytes(self.held[:size])
        del self.held[:size]
        return found


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_PAYLOAD_BYTES) -> DataFrame:
    """``archive, number`` of each record to become a revisit, with its original's headers.

    Of records with equal payloads of ``min_bytes`` or more, the one with the largest page
    id is the original (a null id comes last, and the place in the archives decides
    between equal ids). Equal means equal digest and length.
    """
    place = F.struct(
        F.coalesce("page_id", F.lit(-(1 << 63))).alias("order"),
        "archive", "number", "page_id", "record_id", "url", "date",
    )
    large = headers.where(F.col("payload_bytes") >= min_bytes)
    originals = (
        large.groupBy("payload_digest", "payload_bytes")
        .agg(F.max(place).alias("original"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    keys = ["payload_digest", "payload_bytes"]
    found = large.select("archive", "number", *keys).join(originals, keys)
    own = (F.col("archive") == F.col("original.archive")) & (F.col("number") == F.col("original.number"))
    return found.where(~own).select("archive", "number", "original")


def deduplicate(spark: SparkSession, path: str, min_bytes: int = MIN_PAYLOAD_BYTES) -> str:
    """Write the archives of ``path`` anew, with revisits for repeats; returns the new folder."""
    headers = written(read_archives(spark, path), "headers")
    revisits = resolve_revisits(headers, min_bytes)
    whole = read_archives(spark, path, payloads=True)
    joined = whole.join(revisits, ["archive", "number"], "left")
    again = F.col("original").isNotNull()
    both = [
        _header("WARC-Record-ID", F.col("record_id")),
        _header("WARC-Date", F.col("date")),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("Page-ID", F.col("page_id").cast("string")),
        _header("Payload-Length", F.col("payload_bytes").cast("string")),
    ]
    response = _record(
        [_header("WARC-Type", F.lit("response")), *both],
        "application/http;msgtype=response",
        F.concat(F.lit(_HTTP_HEAD), F.col("payload")),
    )
    original = F.col("original")
    revisit = _record(
        [
            _header("WARC-Type", F.lit("revisit")),
            *both,
            _header("WARC-Profile", F.lit(REVISIT_PROFILE)),
            _header("WARC-Refers-To", original["record_id"]),
            _header("WARC-Refers-To-Target-URI", original["url"]),
            _header("WARC-Refers-To-Date", original["date"]),
            _header("Refers-To-Page-ID", original["page_id"].cast("string")),
        ],
        "application/http;msgtype=response",
        F.lit(_HTTP_HEAD),
    )
    return _write(joined.select(F.when(again, revisit).otherwise(response).alias("value")), "warc")


def deduplicated_pages(pages: DataFrame, min_bytes: int = MIN_PAYLOAD_BYTES) -> DataFrame:
    """Archive ``pages``, deduplicate the archives, and return the headers of the result.

    A row per row of ``pages``, also where ids or rows repeat; see ``write_pages`` for
    nulls and ``resolve_revisits`` for ties. An empty table gives no rows. Only the three
    named columns are read, so other columns may have any names.
    """
    spark = pages.sparkSession
    return read_archives(spark, deduplicate(spark, write_pages(pages), min_bytes))
