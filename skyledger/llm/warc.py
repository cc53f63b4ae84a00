"""WARC archives: a writer of one gzip member per record, and a salvage reader.

Tasks write and read archive files in a folder that all executors share. What a
task has written counts only through the manifest that Spark commits, so files of
a lost or repeated attempt are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.llm.common import materialize, scratch_path

#: Payloads below this size are always written in full.
REVISIT_BYTES = 1000
#: A task begins a new archive file beyond this size.
ROLL_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the formats.
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
END = b"\r\n\r\n"


# ---- records ----


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``sha1``, ``refers_to`` for every row of ``pages``.

    Of equal payloads of at least ``REVISIT_BYTES``, that with the largest ``page_id``
    is a response and the others refer to it. NULL ``html`` is an empty payload. Rows
    that repeat the largest id are responses too; a payload that has only NULL ids is
    never referred to. Only digests that occur twice are joined, and they are counted
    before the shuffle.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    large = rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
    keepers = large.groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    keepers = keepers.filter("n > 1 and keeper is not null").select(
        F.col("sha1").alias("same"), "keeper"
    )
    joined = rows.join(keepers, F.col("sha1") == F.col("same"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return joined.select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))


def record(page_id, url: str | None, payload: bytes, sha1: str, refers_to) -> bytes:
    """A response, or a revisit of the page ``refers_to``, as an uncompressed record."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": DATE,
    }
    if url is not None:
        fields["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    if refers_to is not None:
        fields |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": PROFILE}
    fields |= {
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode(),
        "WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + END


def member(data: bytes) -> bytes:
    """``data`` as one gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the rows of ``plan_records`` to ``folder``; ``file``, ``bytes``, ``records`` of each archive.

    A task holds one record at a time. An input without rows makes no file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, size, count = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict(
                {"file": [name], "bytes": [size], "records": [count]}
            )

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                data = member(record(*(value.as_py() for value in row)))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ROLL_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    rows = records.select("page_id", "url", "payload", "sha1", "refers_to")
    written = rows.mapInArrow(run, "file string, bytes long, records long")
    return materialize(
        written.select(F.concat(F.lit(folder.rstrip("/") + "/"), "file").alias("file"), "bytes", "records"),
        "manifest",
    )


# ---- salvage ----


class Damaged(ValueError):
    """What stands here is no whole, valid record."""


class Source:
    """A stream of bytes, of which only what lies after ``at`` is held."""

    CHUNK = 1 << 20

    def __init__(self, stream):
        self.stream, self.data, self.base, self.at, self.over = stream, b"", 0, 0, False

    @property
    def place(self) -> int:
        return self.base + self.at

    def fill(self, n: int) -> int:
        """Tries to hold ``n`` bytes after ``at``; how many there are."""
        while len(self.data) - self.at < n and not self.over:
            more = self.stream.read(max(self.CHUNK, n - len(self.data) + self.at))
            self.over = not more
            self.data, self.base, self.at = self.data[self.at :] + more, self.place, 0
        return len(self.data) - self.at


def _from_member(source: Source) -> tuple[bytes, int]:
    """The content of the gzip member at ``source`` and the member's size."""
    unpacker, parts, fed = zlib.decompressobj(31), [], 0
    while not unpacker.eof:
        if source.fill(fed + 1) <= fed:
            raise Damaged("truncated member")
        piece = source.data[source.at + fed : source.at + fed + (1 << 16)]
        try:
            parts.append(unpacker.decompress(piece))
        except zlib.error as error:
            raise Damaged("invalid member") from error
        fed += len(piece)
    return b"".join(parts), fed - len(unpacker.unused_data)


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Fields (names in lower case), block and size of the record that ``data`` begins with."""
    head = data.find(END)
    if not data.startswith(VERSION) or head < 0:
        raise Damaged("no record header")
    try:
        lines = data[:head].decode().split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(fields["content-length"])
    except (UnicodeDecodeError, KeyError, ValueError) as error:
        raise Damaged("invalid record header") from error
    start = head + len(END)
    block = data[start : start + length]
    if length < 0 or data[start + length : start + length + len(END)] != END:
        raise Damaged("wrong record length")
    kind, _, wanted = fields.get("warc-block-digest", "").partition(":")
    if kind == "sha1" and base64.b32encode(hashlib.sha1(block).digest()).decode() != wanted:
        raise Damaged("wrong block digest")
    return fields, block, start + length + len(END)


def _here(source: Source) -> tuple[dict[str, str], bytes, int]:
    """The valid record at ``source``, compressed or not, and its size in the file."""
    source.fill(8)
    begins = source.data[source.at : source.at + 8]
    if begins.startswith(GZIP):
        data, size = _from_member(source)
        fields, block, used = parse(data)
        if used != len(data):
            raise Damaged("more than a record in a member")
        return fields, block, size
    if not begins.startswith(VERSION):
        raise Damaged("no member and no version line")
    seen = 0
    while (head := source.data.find(END, source.at + max(0, seen - 3))) < 0:
        before, seen = seen, source.fill(seen + Source.CHUNK)
        if seen == before:
            break
    if head >= 0:
        # The length decides how much more to read; parse() checks everything again.
        low = source.data[source.at : head].lower()
        digits = low.partition(b"\r\ncontent-length:")[2].partition(b"\r\n")[0].strip()
        if digits.isdigit() and len(digits) < 16:
            source.fill(head - source.at + int(digits) + 2 * len(END))
    return parse(source.data[source.at :] if head < 0 else _record_bytes(source, head))


def _record_bytes(source: Source, head: int) -> bytes:
    """No more than the record at ``source`` whose header ends at ``head`` can need."""
    low = source.data[source.at : head].lower()
    digits = low.partition(b"\r\ncontent-length:")[2].partition(b"\r\n")[0].strip()
    length = int(digits) if digits.isdigit() and len(digits) < 16 else 0
    return source.data[source.at : head + length + 2 * len(END)]


def _seek(source: Source) -> bool:
    """Moves ``source`` to the next magic number or version line; False at the end."""
    source.at += 1
    while True:
        source.fill(Source.CHUNK)
        found = [source.data.find(mark, source.at) for mark in (GZIP, VERSION)]
        found = [place for place in found if place >= 0]
        if found:
            source.at = min(found)
            return True
        source.at = max(source.at, len(source.data) - len(VERSION) + 1)
        if source.over:
            source.at = len(source.data)
            return False


def salvage(stream) -> Iterator[tuple[int, int, dict[str, str], bytes, str | None]]:
    """Start, end, fields and block of each valid record; gaps have no fields but a reason.

    After a failed check the bytes up to the next valid record are one gap.
    """
    source, gap, reason = Source(stream), None, None
    while source.fill(1):
        try:
            fields, block, size = _here(source)
        except Damaged as error:
            if gap is None:
                gap, reason = source.place, str(error)
            if not _seek(source):
                break
            continue
        if gap is not None:
            yield gap, source.place, {}, b"", reason
            gap = None
        yield source.place, source.place + size, fields, block, None
        source.at += size
    if gap is not None:
        yield gap, source.place, {}, b"", reason


def _row(file: str, found, with_payload: bool) -> dict:
    start, end, fields, block, reason = found
    row = {"file": file, "start": start, "end": end, "gap": reason}
    if reason is not None:
        return row
    http, _, payload = block.partition(END)
    revisit = fields.get("warc-type") == "revisit"
    row |= {
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "refers_to_id": fields.get("warc-refers-to"),
        "url": fields.get("warc-target-uri"),
    }
    if revisit:
        kind, _, value = fields.get("warc-payload-digest", "").partition(":")
        lengths = [x[15:] for x in http.lower().split(b"\r\n") if x.startswith(b"content-length:")]
        row["payload_digest"] = base64.b32decode(value).hex() if kind == "sha1" else None
        row["payload_bytes"] = int(lengths[0]) if lengths else None
    else:
        row["payload_digest"] = hashlib.sha1(payload).hexdigest()
        row["payload_bytes"] = len(payload)
        row["payload"] = payload if with_payload else None
    return row


ROW = (
    "file string, start long, end long, gap string, record_type string, record_id string, "
    "refers_to_id string, url string, payload_digest string, payload_bytes long, payload binary"
)


def read_archives(files: DataFrame, payload: bool = True) -> DataFrame:
    """A row for each record and each gap of the archives in the column ``file`` of ``files``.

    Gaps have ``gap``, the failed check, and the bytes ``start`` to ``end`` that are
    quarantined; everything else of them is NULL. Archives may be plain, one member
    per record, or both. The digest of a response is taken of the bytes that were
    read, that of a revisit from its header. A task holds one record, not an archive.
    """
    names = [x.split()[0] for x in ROW.split(", ")]
    schema = to_arrow_schema(T._parse_datatype_string(ROW))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(file)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for found in salvage(stream):
                        rows.append(_row(file, found, payload))
                        held += len(found[3])
                        if held > 1 << 23:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return files.select("file").mapInArrow(run, ROW).select(*names)


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written to archives in the shared folder, and read back."""
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(plan_records(pages), folder)
    spread = manifest.select("file").repartition(max(1, manifest.count()))
    return read_archives(spread, payload=False)


def page_of(record_id: Column) -> Column:
    """The page's id in a record id, NULL for a page without one."""
    number = F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1)
    return F.when(number != "", number).cast("long")
