"""WARC archives of pages, with an index of byte ranges written beside them and read first.

Writing gives one gzip member per record and an index row with its file, offset, length, URL and
payload digest.  Reading starts from index rows: the chosen ones are sorted by file and offset,
ranges that lie close together become one read, and the records are cut out of it.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.common import shared_folder, stored

# An archive is closed, and the next one begun, beyond this size.
FILE_BYTES = 512 * 1024 * 1024
# Ranges at most this far apart are read at once, up to READ_BYTES.
GAP_BYTES = 64 * 1024
READ_BYTES = 8 * 1024 * 1024
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "page_id long, url string, file string, offset long, length long, "
    "payload_digest string, payload_bytes long, record_type string, refers_to long"
)
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return None if number in ("", "none") else int(number)


def encode_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str
) -> bytes:
    """One WARC/1.1 record; a revisit keeps the response's headers, and their length, but no payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = urllib.parse.quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def decode_record(record: bytes) -> tuple[dict[str, str], int, bytes | None]:
    """WARC headers (names in lower case), length of the full payload, and the payload (None: revisit)."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record begins here")
    headers = {}
    for line in lines:
        name, _, value = line.partition(":")
        headers[name.lower()] = value.strip()
    block = rest[: int(headers["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    length = int(fields["Content-Length"])
    if headers["warc-type"] == "revisit":
        return headers, length, None
    if len(payload) != length:
        raise ValueError("the payload is cut short")
    return headers, length, payload


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def _writer(folder: str, date: str, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        store.create_dir(base, recursive=True)
        name = out = None
        offset = 0
        for batch in batches:
            index = []
            for row in batch.to_pylist():
                if out is None:
                    # A name of its own for every attempt: a task that runs again never touches
                    # what another attempt wrote, and the index names the files that count.
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = (row["payload"] or "").encode()
                digest = base32_sha1(payload)
                revisit = row["record_type"] == "revisit"
                record = encode_record(
                    row["page_id"], row["url"], payload, digest, row["refers_to"], revisit, date
                )
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed = member.compress(record) + member.flush()
                out.write(packed)
                index.append(
                    {
                        "page_id": row["page_id"],
                        "url": row["url"],
                        "file": name,
                        "offset": offset,
                        "length": len(packed),
                        "payload_digest": digest,
                        "payload_bytes": len(payload),
                        "record_type": row["record_type"],
                        "refers_to": row["refers_to"],
                    }
                )
                offset += len(packed)
                if offset >= file_bytes:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pylist(index, schema=_INDEX_SCHEMA)
        if out is not None:
            out.close()

    return write


_INDEX_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def planned(pages: DataFrame, page_id: str, url: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, record_type, refers_to``: of equal payloads of at least
    ``least_bytes``, the largest id is the response and the others revisit it.

    Only digests and ids are grouped; equal payloads, however many, join a row per digest, and a
    digest that many pages share is split by the adaptive join.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.col(f"`{payload}`").cast("string").alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1(F.coalesce("payload", F.lit("")).cast("binary"))))
    shared = (
        rows.where(F.octet_length(F.coalesce("payload", F.lit(""))) >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    if least_bytes:
        revisit = revisit & (F.octet_length(F.coalesce("payload", F.lit(""))) >= least_bytes)
    return rows.join(shared, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
) -> tuple[str, DataFrame]:
    """Write a record per row below ``folder`` (default: the shared checkpoint folder); give the folder and the index.

    ``folder`` must be reachable from every executor.  A null payload counts as empty; a null URL is
    written as ``about:blank`` and stays null in the index.  Rows that repeat an id and a payload are
    each a response, so every record stays readable; a null id ranks below all others.  Columns other
    than the three named are not read.  Without rows there is no archive and an empty index.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc"
    plan = planned(pages, page_id, url, payload, least_bytes)
    return folder, stored(plan.mapInArrow(_writer(folder, date, file_bytes), INDEX))


def _reader(folder: str, gap_bytes: int, read_bytes: int, payloads: bool):
    schema = [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ] + ([("payload", pa.binary())] if payloads else [])

    def runs(rows: list[dict]) -> Iterator[list[dict]]:
        run: list[dict] = []
        for row in rows:
            if run and (
                row["file"] != run[0]["file"]
                or row["offset"] > run[-1]["offset"] + run[-1]["length"] + gap_bytes
                or row["offset"] + row["length"] > run[0]["offset"] + read_bytes
            ):
                yield run
                run = []
            run.append(row)
        if run:
            yield run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        for batch in batches:
            for run in runs(batch.to_pylist()):
                first = run[0]["offset"]
                with store.open_input_file(f"{base}/{run[0]['file']}") as archive:
                    data = archive.read_at(run[-1]["offset"] + run[-1]["length"] - first, first)
                found = []
                for row in run:
                    at = row["offset"] - first
                    headers, length, payload = decode_record(
                        zlib.decompress(data[at : at + row["length"]], 31)
                    )
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if payload is not None and base32_sha1(payload) != digest or digest != row["payload_digest"]:
                        raise ValueError(f"{row['file']} at {row['offset']}: the payload is not what was written")
                    record = {
                        "page_id": _page_of(headers["warc-record-id"]),
                        "url": row["url"],
                        "record_type": headers["warc-type"],
                        "refers_to": _page_of(headers.get("warc-refers-to")),
                        "payload_bytes": length,
                        "payload_digest": digest,
                    }
                    found.append(record | ({"payload": payload} if payloads else {}))
                yield pa.RecordBatch.from_pylist(found, schema=pa.schema(schema))

    return read


def read_records(
    folder: str,
    index: DataFrame,
    where: Column | None = None,
    payloads: bool = True,
    gap_bytes: int = GAP_BYTES,
    read_bytes: int = READ_BYTES,
) -> DataFrame:
    """Records of the index rows that fit ``where``, checked against their digests.

    Index rows are dealt by file and part of a file, so one large archive is read by many tasks; in
    a task they are sorted, and neighbours come with one read.  ``payload`` is null in a revisit:
    it is that of the record ``refers_to``.
    """
    chosen = index if where is None else index.where(where)
    placed = (
        chosen.select("file", "offset", "length", "url", "payload_digest")
        .withColumn("part", F.floor(F.col("offset") / read_bytes))
        .repartition("file", "part")
        .sortWithinPartitions("file", "offset")
    )
    return placed.mapInArrow(
        _reader(folder, gap_bytes, read_bytes, payloads), RECORD + (", payload binary" if payloads else "")
    )
