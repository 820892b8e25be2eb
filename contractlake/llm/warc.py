"""WARC archives: writing captures, reading records, and joining the records of a transaction."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from contractlake.llm.common import drop_staged, map_batches, staged, utf8

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "2000-01-01T00:00:00Z"

RECORD = (
    "record_id string, record_type string, target_uri string, concurrent_to string, "
    "refers_to_id string, payload_digest string, payload_bytes long, headers map<string,string>, "
    "http_head string, payload binary, error string"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, name: str, uri: str, block: str, size: int, **more: str | None) -> str:
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in more.items())
    return (
        f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Date: {EPOCH}\r\n"
        f"WARC-Target-URI: {uri}\r\n{head}Content-Length: {size}\r\n\r\n{block}"
    )


def _record_id(*parts: object) -> str:
    """An id made of what identifies a record, so that a task that runs again writes the same."""
    return str(uuid.UUID(bytes=hashlib.sha1(repr(parts).encode()).digest()[:16], version=5))


def _one_line(text: str | None) -> str:
    """A header value: line breaks would end the header."""
    text = text or ""
    return text if text.isprintable() else "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in text)


# Rows that a task turns into text at once.
SLICE = 256


def _write_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, len(batch), SLICE):
            rows = batch.slice(start, SLICE).to_pylist()
            yield {"value": [text for row in rows for text in _capture(row)]}


def _capture(row: dict) -> tuple[str, str, str]:
    """Main record, request and metadata of a capture."""
    html = row["payload"] or ""
    payload = html.encode()
    digest = sha1_base32(payload)
    uri = _one_line(row["url"])
    name = _record_id(row["key"], digest, row["row"])
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    common = {"Content_Type": "application/http;msgtype=response", "WARC_Payload_Digest": f"sha1:{digest}"}
    if row["same_as"] is None:
        main = _record("response", name, uri, http + html, len(http) + len(payload), **common)
    else:
        first = f"<urn:uuid:{_record_id(row['same_as']['key'], digest, row['same_as']['row'])}>"
        main = _record(
            "revisit", name, uri, http, len(http), **common, WARC_Profile=PROFILE, WARC_Refers_To=first
        )
    request = f"GET {uri} HTTP/1.1\r\n\r\n"
    fields = f"capture-key: {_one_line(str(row['key']))}\r\n"
    concurrent = {"WARC_Concurrent_To": f"<urn:uuid:{name}>"}
    return (
        main,
        _record("request", _record_id(name, "request"), uri, request, len(request.encode()), **concurrent,
                Content_Type="application/http;msgtype=request"),
        _record("metadata", _record_id(name, "metadata"), uri, fields, len(fields.encode()), **concurrent,
                Content_Type="application/warc-fields"),
    )


# Bytes of a file before it is packed, about: one task reads a file, and holds it packed.
FILE_BYTES = 1 << 26


def write_warc(
    captures: DataFrame, path: str, min_payload: int = 0, records_per_file: int = 6_000
) -> None:
    """Write columns ``key``, ``url``, ``payload`` (text) as gzipped WARC files of bounded size: at
    most ``records_per_file`` records, and fewer where payloads are large on average.

    Every row becomes a response or revisit record with its request and metadata record, under ids
    of its own: null and repeated keys, and rows that are equal in all columns, stay as many records
    as they are rows. Of rows with equal payloads of at least ``min_payload`` bytes, the one with
    the largest key (null is the least) holds the payload and the others refer to it; others with
    that same key, if not null, hold it as well. Null payloads are empty, null URLs an empty target.
    The rows are written to the shared folder with a number each, so that numbers do not change
    between the pass that finds the owners and the one that writes. A payload's owner is an
    aggregate by digest, so a payload that a third of all rows share is one row per task.
    """
    made: list[str] = []
    rows = staged(
        captures.select(
            "key", "url", "payload", F.monotonically_increasing_id().alias("row"),
            F.sha1(utf8(F.col("payload"))).alias("_sha1"),
            F.octet_length(utf8(F.col("payload"))).alias("_bytes"),
        ),
        "captures",
        made,
    )
    shared = (
        rows.where(F.col("_bytes") >= min_payload)
        .groupBy("_sha1")
        .agg(F.max(F.struct("key", "row")).alias("_owner"), F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .select("_sha1", "_owner")
    )
    shared = staged(shared, "payloads", made)  # of known size when it is joined
    holds = (F.col("_owner.row") == F.col("row")) | F.coalesce(F.col("_owner.key") == F.col("key"), F.lit(False))
    marked = rows.join(shared, "_sha1", "left").select(
        "key", "url", "payload", "row",
        F.when((F.col("_bytes") >= min_payload) & ~holds, F.col("_owner")).alias("same_as"),
    )
    payloads = rows.agg(F.avg("_bytes")).first()[0] or 0
    records_per_file = max(3, min(records_per_file, int(3 * FILE_BYTES / (payloads + 1_500))))
    writer = map_batches(marked, _write_rows, "value string").write
    writer.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file
    ).text(path)
    drop_staged(captures.sparkSession, made)


def _plain(content: bytes) -> Iterator[bytes]:
    """Unpacked pieces: plain files, one gzip member, or a member per record."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:
        unzip = zlib.decompressobj(31)
        piece = unzip.decompress(content, 1 << 22)
        yield piece
        while unzip.unconsumed_tail:
            yield unzip.decompress(unzip.unconsumed_tail, 1 << 22)
        yield unzip.flush()
        if not unzip.eof:
            raise ValueError("gzip member ends early")
        content = unzip.unused_data


class _Buffer:
    """Bytes that come in pieces, read from the front without copying what is left."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.data, self.at = pieces, b"", 0

    def has(self, n: int) -> bool:
        """Whether ``n`` more bytes are there, after reading on as needed."""
        size = len(self.data) - self.at
        if size >= n:
            return True
        parts = [self.data[self.at :]]
        for piece in self.pieces:
            parts.append(piece)
            size += len(piece)
            if size >= n:
                break
        self.data, self.at = b"".join(parts), 0
        return size >= n

    def find(self, mark: bytes) -> int:
        """Place of the mark from the front, -1 where it does not come."""
        found = self.data.find(mark, self.at)
        while found < 0 and self.has(len(self.data) - self.at + 1):
            found = self.data.find(mark, self.at)
        return found - self.at if found >= 0 else -1

    def take(self, n: int) -> bytes:
        self.at += n
        return self.data[self.at - n : self.at]


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-cased names, block) of each record, cut by ``Content-Length``."""
    buffer = _Buffer(_plain(content))
    while True:
        while buffer.has(1) and buffer.data[buffer.at] in b"\r\n":
            buffer.at += 1
        if not buffer.has(1):
            return
        end = buffer.find(b"\r\n\r\n")
        if end < 0:
            raise ValueError("record head ends early")
        lines = buffer.take(end + 4)[:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts with {lines[0][:40]!r}")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers.get("content-length", "0"))
        if not buffer.has(length):
            raise ValueError("record block ends early")
        yield headers, buffer.take(length)


# Headers that have columns of their own.
OWN_HEADERS = {
    "warc-record-id", "warc-type", "warc-target-uri", "warc-concurrent-to", "warc-refers-to", "warc-payload-digest",
}


def _read_rows(
    batches: Iterator[pa.RecordBatch], payloads: bool, kinds: Sequence[str] | None
) -> Iterator[dict]:
    names = [field.split()[0] for field in RECORD.split(", ")]
    for batch in batches:
        for place, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows: list[tuple] = []
            size = 0
            try:
                for headers, block in parse_records(content.as_py()):
                    http, payload = "", block
                    if headers.get("content-type", "").startswith("application/http"):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        http = head.decode("utf-8", "replace")
                    kind = headers.get("warc-type")
                    if kinds is not None and kind not in kinds:
                        continue
                    stored = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    digest = sha1_base32(payload) if kind == "response" else stored
                    error = "payload digest differs" if stored and digest != stored else None
                    rows.append((
                        headers.get("warc-record-id"), kind, headers.get("warc-target-uri"),
                        headers.get("warc-concurrent-to"), headers.get("warc-refers-to"), digest,
                        len(payload), [h for h in headers.items() if h[0] not in OWN_HEADERS], http,
                        payload if payloads or kind == "metadata" else None, error,
                    ))
                    size += len(block)
                    if size > 1 << 22 or len(rows) > 1_000:
                        yield dict(zip(names, map(list, zip(*rows))))
                        rows, size = [], 0
            except (ValueError, zlib.error) as broken:
                rows.append((*[None] * (len(names) - 1), f"{place}: {broken}"))
            if rows:
                yield dict(zip(names, map(list, zip(*rows))))


def read_warc(
    spark: SparkSession, path: str, payloads: bool = True, kinds: Sequence[str] | None = None
) -> DataFrame:
    """One row per record (of some ``kinds``, if given) of the WARC files (plain or gzipped) below ``path``.
    ``headers`` are those that have no column of their own.

    A file is read by one task, record by record; a file that breaks off gives the records before
    that and one row with ``error`` and no id. Without ``payloads`` only their sizes and digests
    are returned.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.where(~F.col("path").rlike(r"/_[^/]*$")).select("path", "content")
    return map_batches(files, lambda batches: _read_rows(batches, payloads, kinds), RECORD)


# Record types that are a capture's main record.
MAIN = ("response", "revisit")


def assemble(records: DataFrame, strict: bool = False, mains: DataFrame | None = None) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``main``, ``request``, ``metadata``, ``original``.

    ``main`` is a response or revisit record, with its payload. A request or metadata record belongs
    to the capture it names in its concurrent-to, a request also to the one whose main record names the request,
    and a metadata record to the capture of the request it names. ``original`` is the response a
    revisit refers to, without payload and headers, which are in that response's own row. Records with
    the same id are one record; of several requests or metadata
    records of a capture the one with the least id is taken; records that name no capture that is
    there are left out. So are rows without an id, which tell of archives that break off; they and
    other records with an ``error`` are an error with ``strict``. Missing parts are null, and no
    record gives no row. All joins are on ids.

    The records are written to the shared folder once. ``mains``, if given, are the same main
    records again with the payloads, which ``records`` can then do without: they are moved once, to the
    other parts of their captures, and not written before.
    """
    all_records = staged(records, "records")
    if strict:
        wrong = [row.error for row in all_records.where("error IS NOT NULL").select("error").limit(5).collect()]
        if wrong:
            raise ValueError(f"archives that cannot be read whole: {'; '.join(wrong)}")
    known = all_records.where(F.col("record_id").isNotNull())
    names = [n for n in records.columns if n not in ("record_id", "concurrent_to")]
    light = [n for n in names if n not in ("payload", "headers", "http_head")]
    ids = known.where(F.col("record_type").isin(*MAIN)).select(
        F.col("record_id").alias("capture_id"), F.col("concurrent_to").alias("names"), "refers_to_id"
    )

    def part(kind: str) -> DataFrame:
        return known.where(F.col("record_type") == kind).select(
            F.col("record_id").alias("part_id"), F.col("concurrent_to").alias("capture_id"),
            F.struct("record_id", *names).alias("part"),
        )

    def via(parts: DataFrame, links: DataFrame) -> DataFrame:
        """Parts that belong to a capture by links ``(capture_id, part_id)``."""
        return parts.drop("capture_id").join(links.distinct(), "part_id").select("part_id", "capture_id", "part")

    requests, metadata = part("request"), part("metadata")
    named = ids.where(F.col("names").isNotNull()).select("capture_id", F.col("names").alias("part_id"))
    by_main = not named.isEmpty()
    if by_main:
        requests = requests.unionByName(via(requests, named))
    # Metadata of a request, where there is any that names no main record.
    loose = metadata.select("part_id", "capture_id").join(ids.select("capture_id"), "capture_id", "left_anti")
    if not loose.isEmpty():
        owners = requests.select(F.col("part_id").alias("request_id"), "capture_id")
        links = loose.select("part_id", F.col("capture_id").alias("request_id")).join(owners, "request_id")
        metadata = metadata.unionByName(via(metadata, links.select("capture_id", "part_id")))
    originals = known.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.struct("record_id", *light).alias("original")
    )
    revisits = ids.where(F.col("refers_to_id").isNotNull()).select("capture_id", "refers_to_id")
    found = revisits.join(originals, "refers_to_id").select("capture_id", "original")
    mains = (known if mains is None else mains).where(F.col("record_type").isin(*MAIN) & F.col("record_id").isNotNull())
    whole = mains.select(F.col("record_id").alias("capture_id"), F.struct("record_id", *names).alias("main"))
    # Every side is dealt by capture, where the least or any one is taken: nothing is dealt twice.
    for name, parts in (("request", requests), ("metadata", metadata)):
        parts = parts.where(F.col("capture_id").isNotNull())
        one = parts.groupBy("capture_id").agg(F.min_by("part", "part_id").alias(name))
        whole = whole.join(one, "capture_id", "left")
    whole = whole.join(found.dropDuplicates(["capture_id"]), "capture_id", "left").dropDuplicates(["capture_id"])
    return whole.select("capture_id", "main", "request", "metadata", "original")
