"""WARC archives: one gzip member per record, written by tasks, read back by byte ranges.

The reader gives each task a range of a file. It looks for the bytes that begin a gzip member, takes
a candidate for a record only if it inflates to a whole WARC header, and owns the records that start
inside its range, reading past the end to finish the last. UTF-8 text cannot hold those bytes, so
neither can a payload that deflate stores as it is.

A task writes files of its own under names never used before, and only the names that finished tasks
return are read; a task that ran twice leaves a file nobody reads. Files lie in the shared folder.

Defined results: a null html is an empty payload; a null id gives a null id back; of equal payloads
of at least ``min_revisit`` bytes the rows with the smallest id are responses (all of them, if that
id repeats), the others revisit it; a null url is recorded as about:blank; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import written
from tablesync.session import new_path

MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 16
BROADCAST_DIGESTS = 200_000  # of 64 characters and a number each: some 30 MB
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")

FILES = "path string, size long, records long"
RECORDS = (
    "path string, at long, page_id long, url string, record_type string, refers_to long, "
    "digest string, full_bytes long, payload binary"
)


def records_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 100) -> DataFrame:
    """Pages with payload, digest, and the id of the response they revisit, or null.

    Payloads stay where they are read: only digests and ids are counted by shuffle, and up to
    ``BROADCAST_DIGESTS`` digests seen more than once are broadcast to the pages. Where there are more,
    the same join shuffles; a hot digest is pre-aggregated on one side, and the other side may be split."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    pages = pages.withColumns({"digest": F.sha2("payload", 256), "full_bytes": F.octet_length("payload").cast("long")})
    first = pages.where(F.col("full_bytes") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = written(first.where("n > 1").drop("n"), "warc-digests")
    few = repeated.count() <= BROADCAST_DIGESTS
    joined = pages.join(F.broadcast(repeated) if few else repeated.hint("shuffle_merge"), "digest", "left")
    return joined.select(
        "page_id", "url", "payload", "digest", "full_bytes",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP header only."""
    url = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"
    revisit = refers_to is not None
    head = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _name(page_id), "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha256:{digest}", "X-Payload-Length": str(len(payload)),
    }
    if revisit:
        head["WARC-Refers-To"] = _name(refers_to)
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    block = _HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _header(data: bytes) -> tuple[dict[str, str], int] | None:
    """Fields of a WARC header and where its block begins; None if ``data`` does not begin with a whole one."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or end < 0:
        return None
    fields = dict(line.split(": ", 1) for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    return (fields, end + 4) if fields.get("Content-Length", "").isdigit() and "WARC-Type" in fields else None


def write_archives(records: DataFrame, folder: str, file_bytes: int = 128 << 20) -> DataFrame:
    """Writes the records into ``folder``; a row per file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name, out, size, count = "", None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = encode_record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [size], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [size], "records": [count]})

    return records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(write, FILES)


def _members(file, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, header and block of the records that start in [start, end)."""
    data, base = b"", start  # bytes of the file from ``base`` on

    def more() -> bool:
        nonlocal data
        file.seek(base + len(data))
        got = file.read(_CHUNK)
        data += got
        return bool(got)

    while base < end:
        at = data.find(MAGIC)
        if at < 0:  # the last two bytes may begin the next sign
            keep = min(2, len(data))
            base, data = base + len(data) - keep, data[len(data) - keep :]
            if not more():
                return
            continue
        base, data = base + at, data[at:]
        if base >= end:
            return
        inflate, fed, parts, known = zlib.decompressobj(31), 0, [], None
        try:
            while not inflate.eof:
                if fed == len(data) and not more():
                    raise zlib.error("the file ends inside a member")
                parts.append(inflate.decompress(data[fed:]))
                fed = len(data)
                if known is None:
                    parts = [b"".join(parts)]
                    known = _header(parts[0])
                    if known is None and (inflate.eof or not parts[0].startswith(b"WARC/1."[: len(parts[0])])):  # a header is read to its end, however long
                        raise zlib.error("not a record")
        except zlib.error:
            base, data = base + 1, data[1:]
            continue
        fields, begin = known
        yield base, fields, b"".join(parts)[begin : begin + int(fields["Content-Length"])]
        used = fed - len(inflate.unused_data)
        base, data = base + used, data[used:]


def _page(name: str | None) -> int | None:
    number = (name or "")[len("<urn:page:") : -1]
    return int(number) if number else None


def read_archives(files: DataFrame, range_bytes: int = 8 << 20, batch_bytes: int = 8 << 20) -> DataFrame:
    """The records of the files (``path``, ``size``), in ranges of about ``range_bytes``; revisits have no payload."""
    ranges = files.where("size > 0").select("path", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(range_bytes))).alias("start"), "size")
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, F.col("size")).alias("end"))
    fields = [f.split(" ")[0] for f in RECORDS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([pa.field(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split(" ")[1]]) for n, f in zip(fields, RECORDS.split(", "), strict=True)])
        rows, held = [], 0
        for batch in batches:
            for part in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(part["path"])
                with store.open_input_file(path) as file:
                    for at, head, block in _members(file, part["start"], part["end"]):
                        body = block.find(b"\r\n\r\n") + 4
                        revisit = head["WARC-Type"] == "revisit"
                        rows.append({
                            "path": part["path"], "at": at, "page_id": _page(head.get("WARC-Record-ID")), "url": head.get("WARC-Target-URI"),
                            "record_type": head["WARC-Type"], "refers_to": _page(head.get("WARC-Refers-To")),
                            "digest": head.get("WARC-Payload-Digest", "").removeprefix("sha256:"),
                            "full_bytes": int(head.get("X-Payload-Length", 0)), "payload": None if revisit else block[body:],
                        })
                        held += len(block)
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    # a task for each range: the rows are few and small, but what they name is not
    tasks = files.agg(F.sum(F.ceil(F.col("size") / range_bytes))).first()[0]
    return ranges.repartition(int(tasks or 1)).mapInArrow(read, RECORDS)


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes pages as archives in the shared folder and reads them back: a row per record."""
    folder = re.sub(r"^file:/(?!/)", "file:///", new_path(spark, "warc"))
    return read_archives(files_of(pages, folder))


def files_of(pages: DataFrame, folder: str) -> DataFrame:
    """The archives written: path, size, records."""
    return written(write_archives(records_of(pages), folder), "warc-files")


def archived_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """What the archives say of each page; length and digest of responses are taken from what was read.

    Fails where not as many records come back as were written."""
    files = files_of(pages, re.sub(r"^file:/(?!/)", "file:///", new_path(spark, "warc")))
    read = read_archives(files)
    response = F.col("payload").isNotNull()
    found = read.select(
        "page_id",
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("full_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", "refers_to")
    found = written(found, "warc-pages")
    put, got = files.agg(F.sum("records")).first()[0] or 0, found.count()
    if put != got:
        raise RuntimeError(f"{put} records were written, {got} were read")
    return found
