"""WARC archives: one gzip member per record, written and read by tasks in the shared folder.

Pages with equal payloads of at least `least` bytes share one `response` record, that of the smallest page_id; the
others are `revisit` records that hold no payload but name its digest and the page they repeat. All
other pages are `response` records. A null html is an empty payload. Rows that repeat the smallest page_id are
responses as well. Rows without a page_id are revisits if some row of their payload has one, and else responses.

The reader takes an archive as a stream: chunks of compressed bytes go through one zlib decompressor per
member, a record is framed by its Content-Length, and block and payload digests are recomputed. A wrong
length, digest or a torn member is an error that names the file and the offset.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wardenlake.functions.storage import new_folder
from wardenlake.llm import binary_files

LEAST_REVISITED = 100
READ_BYTES = 1 << 16
ARCHIVE_BYTES = 64 << 20
STAMP = "1970-01-01T00:00:00Z"  # archives of the same pages are the same bytes
LEVEL = 4


# ---------------------------------------------------------------------------------------------
# records


def _block(pairs: dict[str, object], first: str) -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in pairs.items()), "", ""]).encode()


def _token(value: object) -> str:
    """A header value on one line: percent-escapes for what would end it."""
    return "".join(c if c.isprintable() and c not in "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in str(value))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member."""
    revisit = refers_to is not None
    http = _block({"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)}, "HTTP/1.1 200 OK")
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": STAMP,
        "WARC-Target-URI": _token(url or ""),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Payload-Digest": f"sha256:{digest}",
    }
    if revisit:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
    head["Content-Length"] = len(block)
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(_block(head, "WARC/1.1") + block + b"\r\n\r\n") + packer.flush()


class ArchiveError(ValueError):
    pass


def members(stream, name: str) -> Iterator[Iterator[bytes]]:
    """The decompressed chunks of each gzip member; one must be used up before the next is asked for."""
    rest, offset = b"", 0

    def chunks() -> Iterator[bytes]:
        nonlocal rest, offset
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            if not rest and not (rest := stream.read(READ_BYTES)):
                raise ArchiveError(f"{name}: a member that begins before byte {offset} is cut off")
            try:
                out = unpack.decompress(rest, READ_BYTES)
            except zlib.error as e:
                raise ArchiveError(f"{name}: byte {offset}: {e}") from e
            left = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            offset += len(rest) - len(left)
            rest = left
            if out:
                yield out

    while rest or (rest := stream.read(READ_BYTES)):
        yield chunks()


def _headers(text: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = text.decode().split("\r\n")
    pairs = (line.split(":", 1) for line in lines if line)
    return first, {k.strip().lower(): v.strip() for k, v in pairs}


def records(stream, name: str, keep_payload: bool = False) -> Iterator[dict]:
    """The records of an archive, checked. Holds the headers, and the payload only if it is asked for."""
    for member in members(stream, name):
        held = b""
        for chunk in member:
            held += chunk
            if b"\r\n\r\n" in held:
                break
        head, found, body = held.partition(b"\r\n\r\n")
        version, fields = _headers(head)
        if not found or not version.startswith("WARC/") or not fields.get("content-length", "").isdigit():
            raise ArchiveError(f"{name}: a record has no WARC headers")
        left = int(fields["content-length"])
        whole, payload, http, kept, size = hashlib.sha256(), hashlib.sha256(), b"", [], 0
        in_payload = False

        def take(part: bytes) -> None:
            nonlocal in_payload, http, size
            whole.update(part)
            if not in_payload:
                http += part
                http_head, found, part = http.partition(b"\r\n\r\n")
                if not found:
                    return
                http, in_payload = http_head, True
            payload.update(part)
            size += len(part)
            if keep_payload:
                kept.append(part)

        tail = b""
        while True:
            part, body = body[:left], body[left:]
            left -= len(part)
            if part:
                take(part)
            tail += body
            if (body := next(member, None)) is None:
                break
        if left or tail != b"\r\n\r\n":
            raise ArchiveError(f"{name}: {fields.get('warc-record-id')}: its length isn't its Content-Length")
        if fields.get("warc-block-digest") != f"sha256:{whole.hexdigest()}":
            raise ArchiveError(f"{name}: {fields.get('warc-record-id')}: wrong block digest")
        revisit = fields["warc-type"] == "revisit"
        stated = int(_headers(http)[1].get("content-length", size))
        if not revisit and (fields["warc-payload-digest"] != f"sha256:{payload.hexdigest()}" or stated != size):
            raise ArchiveError(f"{name}: {fields.get('warc-record-id')}: wrong payload digest")
        yield {
            "page_id": _page(fields["warc-record-id"]),
            "url": fields["warc-target-uri"],
            "payload_bytes": stated,
            "payload_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
            "record_type": fields["warc-type"],
            "refers_to": _page(fields["warc-refers-to"]) if revisit else None,
            "payload": b"".join(kept) if keep_payload and not revisit else None,
        }


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


# ---------------------------------------------------------------------------------------------
# archives


def with_revisits(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """page_id, url, payload, digest, refers_to. Only ids and digests are grouped, with map-side minima."""
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    all_pages = pages.select("page_id", "url", raw.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= least
    repeated = (
        all_pages.where(long_enough)
        .groupBy("digest")
        .agg(F.count("*").alias("copies"), F.min("page_id").alias("response_page"))
        .where("copies > 1 AND response_page IS NOT NULL")
        .drop("copies")
    )
    found = all_pages.join(repeated, "digest", "left")  # a digest with very many pages: AQE splits their side
    first = F.col("response_page")
    return found.select(
        "page_id", "url", "payload", "digest", F.when(first.isNotNull() & ~F.col("page_id").eqNullSafe(first), first).alias("refers_to")
    )


def _archive(rows: Iterator[pa.RecordBatch], folder: str, size: int) -> Iterator[pa.RecordBatch]:
    part, number, source = TaskContext.get().partitionId(), 0, (
        row for batch in rows for some in _slices(batch) for row in zip(*(c.to_pylist() for c in some.columns))
    )
    row = next(source, None)
    while row is not None:
        path, written, count = f"{folder}/part-{part:06d}-{number:04d}.warc.gz", 0, 0
        with binary_files.publish(path) as out:
            while row is not None and written < size:
                written += out.write(member := record(*row)) or len(member)
                count += 1
                row = next(source, None)
        yield pa.RecordBatch.from_pydict({"path": [path], "records": [count], "bytes": [written]})
        number += 1


def _slices(batch: pa.RecordBatch, rows: int = 64) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def write_archives(pages: DataFrame, folder: str, size: int = ARCHIVE_BYTES, least: int = LEAST_REVISITED) -> DataFrame:
    """Write a record for every row into archives of about `size` bytes; one row per archive: path, records, bytes."""
    marked = with_revisits(pages, least)
    archives = marked.mapInArrow(lambda rows: _archive(rows, folder, size), "path string, records long, bytes long")
    archives.write.parquet(f"{folder}/manifest.parquet")
    return pages.sparkSession.read.parquet(f"{folder}/manifest.parquet")


def read_archives(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """The records of all archives, checked: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )
    types = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with binary_files.sequential(path) as stream:
                    waiting, held = [], 0
                    for found in records(stream, path, keep_payload):
                        waiting.append(found)
                        held += len(found["payload"] or b"")
                        if len(waiting) == 1000 or held > READ_BYTES * 64:
                            yield pa.RecordBatch.from_pylist(waiting, types)
                            waiting, held = [], 0
                    if waiting:
                        yield pa.RecordBatch.from_pylist(waiting, types)

    paths = manifest.select("path")
    return paths.repartition(max(1, manifest.count()), "path").mapInArrow(read, schema)


def archived_pages(pages: DataFrame) -> DataFrame:
    manifest = write_archives(pages, f"{new_folder(pages.sparkSession)}/warc")
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
