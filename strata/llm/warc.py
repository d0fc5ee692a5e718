"""WARC archives: a writer of record-wise gzip members and a splittable reader.

**Writer.** A page is a ``response`` record with an HTTP block, or a ``revisit`` record that refers to the response with
the same payload and the smallest page_id. Every task writes files of its own to a folder that all executors reach and
reports them; only files of tasks that Spark committed are listed in the result, so repeated attempts do no harm.

**Reader.** A file is cut into byte ranges, whatever its records. A task looks for the gzip magic in its range and
decodes the beginning of each candidate: it is a member if the gzip header is valid and what it holds starts with WARC
header lines. The task owns the records whose members start inside its range and reads past its end to finish the last.
Bytes inside an accepted member are not searched. Compressed data may contain the magic by chance, hence the decoding;
only a whole WARC member kept byte for byte inside another record's stored deflate block could pass for a record, which
text payloads cannot contain.

Defined results: a null html is an empty payload; a null url leaves out the target URI; a null page_id is left out and
is never referred to while its group has another id. Rows that repeat the smallest page_id are all responses. Null-only
groups are all responses. An empty table gives no files and no rows. Records that are neither response nor revisit are
skipped. Files are opened with pyarrow.fs: local and shared folders, hdfs, s3 and gs; payloads are held one at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from strata.llm.common import written
from strata.session import scratch_dir

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES = 512 << 20
SPLIT_BYTES = 32 << 20
STEP = 1 << 16
#: Tasks that read ranges, at most; beyond it a task takes several.
MOST_TASKS = 20_000
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FILES = "path string, size long, records long"
_RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
            "intact boolean, payload binary")


def digest_of(payload: bytes) -> str:
    """Base32 SHA-1, without a prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{name}: {value}" for name, value in fields if value is not None), f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _uri(url: str | None) -> str | None:
    """The url with what a header line cannot hold percent-encoded."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def _record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def _page_record(page_id, url, payload: bytes, refers_to, revisit: bool, date: str) -> bytes:
    digest = digest_of(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Record-ID", _record_id("revisit", page_id, url, digest) if revisit else _record_id("response", page_id, digest)),
        ("WARC-Date", date), ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-Id", None if page_id is None else str(page_id)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if not revisit:
        return _record("response", fields, head + payload)
    fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id("response", refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to)), ("X-Payload-Bytes", str(len(payload)))]
    return _record("revisit", fields, head)


def write_warc(pages: DataFrame, folder: str | None = None, revisit_bytes: int = 0, date: str = DATE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write (page_id, url, html) rows as archives; returns (path, size, records) of the files.

    Payloads of ``revisit_bytes`` and more are written once.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("same", F.sha2("payload", 256))
    # One row per task and payload is shuffled here, however many copies there are; most payloads occur once and are dropped.
    repeated = rows.groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    judged = rows.join(repeated.select("same", "first"), "same", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= revisit_bytes)
    ready = judged.select("page_id", "url", "payload", "first", revisit.alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = pa.fs.FileSystem.from_uri(folder)
        name = f"{base}/part-{task.partitionId():05d}-{task.taskAttemptId()}"
        out, path, done = None, "", []

        def close():
            size = out.tell()
            out.close()
            done.append((path, size, count))

        for batch in batches:
            for row in range(batch.num_rows):
                values = [batch.column(i)[row].as_py() for i in range(5)]
                if out is None:
                    store.create_dir(base, recursive=True)
                    path, count = f"{name}-{len(done)}.warc.gz", 0
                    out = store.open_output_stream(path, compression=None)
                    out.write(_record("warcinfo", [("WARC-Record-ID", _record_id("info", path)), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"software: strata\r\n"))
                out.write(_page_record(*values, date))
                count += 1
                if out.tell() >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "size", "records"])

    listed = written(ready.mapInArrow(write, _FILES), "warc-files")
    return listed.withColumn("path", F.concat(F.lit(folder.rstrip("/") + "/"), F.substring_index("path", "/", -1)))


def files_in(spark: SparkSession, path: str) -> DataFrame:
    """(path, size) of the files below a path or pattern, as Spark lists them; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"))


class _Window:
    """A file's bytes from ``start`` on, read as far as needed."""

    def __init__(self, file, start: int, stop: int, size: int):
        self.file, self.start, self.size = file, start, size
        file.seek(start)
        self.data = file.read(min(stop, size) - start)

    def at(self, begin: int, n: int) -> bytes:
        """Up to ``n`` bytes from a place; what lies past the range is read piece by piece and not kept."""
        end = min(begin + n, self.size)
        if end <= self.start + len(self.data):
            return self.data[begin - self.start:end - self.start]
        self.file.seek(begin)
        return self.file.read(end - begin)


def _member(window: _Window, at: int, limit: int | None = None) -> tuple[bytes, int] | None:
    """Decompressed bytes (about ``limit`` at most) and end of the gzip member at a place; None if there is none."""
    head = window.at(at, 4)
    if len(head) < 4 or head[:3] != MAGIC or head[3] & 0xE0:
        return None
    unpack, out, size = zlib.decompressobj(31), [], 0
    try:
        while not unpack.eof:
            piece = window.at(at, STEP if limit is None else 1024)
            if not piece:
                return None
            out.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
            size += len(out[-1])
            if limit is not None and size >= limit:
                break
    except zlib.error:
        return None
    return b"".join(out), at


def _fields(head: bytes) -> dict[str, str] | None:
    if not head.startswith(b"WARC/1."):
        return None
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, colon, value in (line.partition(":") for line in lines) if colon}


def _header(window: _Window, at: int) -> bool:
    """True if a member at this place begins with the header lines of a record, however long they are.

    A member that begins like a record but has no whole header is an error, as its record would be lost.
    """
    limit = 16
    while (found := _member(window, at, limit)) is not None:
        start, _ = found
        if not start.startswith(b"WARC/1."[:len(start)]):
            return False
        if b"\r\n\r\n" in start:
            fields = _fields(start.split(b"\r\n\r\n", 1)[0])
            return bool(fields) and "warc-type" in fields and fields.get("content-length", "").isdigit()
        if len(start) < limit:
            if len(start) < len(b"WARC/1."):
                return False
            break
        limit = max(limit * 8, len(start) + 1)
    if limit == 16 and found is None:
        return False
    raise ValueError(f"the record at byte {at} is cut off or damaged")


def records_in(file, start: int, stop: int, size: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, fields, block) of the records whose members start in [start, stop)."""
    window = _Window(file, start, stop + len(MAGIC) - 1, size)
    at = start
    while (found := window.data.find(MAGIC, at - start) if at < stop else -1) >= 0:
        at = start + found
        if at >= stop:
            return
        if not _header(window, at):
            at += 1
            continue
        whole = _member(window, at)
        if whole is None:
            raise ValueError(f"the record at byte {at} is cut off or damaged")
        content, end = whole
        head, _, rest = content.partition(b"\r\n\r\n")
        fields = _fields(head)
        yield at, fields, rest[:int(fields["content-length"])]
        at = end


def _parsed(fields: dict[str, str], block: bytes, keep: bool) -> dict | None:
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:").upper() or None
    payload = block.partition(b"\r\n\r\n")[2] if "application/http" in fields.get("content-type", "") else block
    number = lambda name: int(fields[name]) if fields.get(name, "").lstrip("-").isdigit() else None
    row = {"page_id": number("x-page-id"), "url": fields.get("warc-target-uri"), "record_type": kind, "refers_to": number("x-refers-to-page-id"), "payload": None}
    if kind == "revisit":
        return row | {"payload_bytes": number("x-payload-bytes"), "payload_digest": digest, "intact": True}
    found = digest_of(payload)
    return row | {"payload_bytes": len(payload), "payload_digest": found, "intact": digest in (None, found), "payload": payload if keep else None}


def read_warc(files: DataFrame, payload: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Response and revisit records of (path, size) archives.

    Columns: page_id, url, record_type, payload_bytes, payload_digest, refers_to, intact (a response's digest is the
    stated one) and payload (null for revisits and without ``payload``).
    """
    kind = to_arrow_type(_parse_datatype_string(_RECORDS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size in zip(*(c.to_pylist() for c in batch.columns)):
                store, name = pa.fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    for _, fields, block in records_in(file, start, start + split_bytes, size):
                        if (row := _parsed(fields, block, payload)) is not None:
                            rows.append(row)
                            held += 200 + len(row["payload"] or b"")
                            if held > 4 << 20:
                                yield pa.RecordBatch.from_struct_array(pa.array(rows, kind))
                                rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_struct_array(pa.array(rows, kind))

    ranges = files.where("size > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"), "size")
    # Counted, as adaptive execution would merge the few bytes of a listing into one task.
    count = files.where("size > 0").agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 1
    spread = ranges.repartition(min(int(count), MOST_TASKS))
    return spread.select("path", "start", "size").mapInArrow(read, _RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    found = read_warc(write_warc(pages.select("page_id", "url", "html")), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
with p as (select page_id, coalesce(html, '') as payload from pages),
g as (select payload, min(page_id) as first, count(*) as n from p group by payload)
select page_id, cast(strlen(payload) as bigint) as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         cast(((cast('0x' || substr(sha1(payload), 1 + 5 * cast(j // 4 as int), 5) as bigint) >> cast(15 - 5 * (j % 4) as bigint)) & 31) + 1 as int), 1)), '')
         as payload_digest,
       case when n > 1 and first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
       case when n > 1 and first is not null and page_id is distinct from first then first end as refers_to
from p join g using (payload)
"""
