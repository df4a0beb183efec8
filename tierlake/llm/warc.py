"""WARC archives: a writer with one gzip member per record, and a reader that salvages damaged archives.

Writing. A page is a response record, or a revisit of the page with the smallest id among those with an equal
payload of at least `revisit_bytes`. Only digests and ids are shuffled to find it (partial minimum per digest,
so a payload that a third of the pages share does not gather). Spark's text writer puts the members into files:
a member ends with the byte zero, which is handed to the writer as line separator (a record of 16 MiB or more
is followed by an empty member, which ends so).

Reading. Each archive is read by Spark as one binary row, so archives are to be rolled by size; those written
here are as large as a write task's input. A member that fails its check (magic, inflate, CRC, length) or a
record that fails its own (version line, header, block length, closing line feeds, payload digest) is
quarantined: the reader looks for the next valid member or version line, goes on there, and logs the byte gap
with its reason. Version lines are looked for inside a member's content too, so a member of many records loses only
those that are hurt; a member that is cut off or fails its check gives the records inflated before the fault, each
beside the member's fault (member_error). inner_offset and inner_length are places in a member's content.

Defined cases: a null payload counts as empty; a null id is written as an empty id and comes back null, and is
never a revisit's target; pages with equal smallest ids are all responses; a null URL is left out; repeated rows
give repeated records; an empty table gives no archive records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.0\r\n"
MAGIC = b"\x1f\x8b\x08"
NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.\d\r\n")
LINE = re.compile(rb"WARC/1\.\d\r\n")
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def member(record: bytes) -> bytes:
    """A gzip member that ends with a zero byte, followed by an empty one where its own last byte is another."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(record) + packer.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """The bytes of a response, or of a revisit if it refers to a page."""
    block = b"" if refers_to is not None else HTTP + payload
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if refers_to is None:
        lines.append("Content-Type: application/http; msgtype=response")
    else:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, path: str, revisit_bytes: int = 100, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """A record for each page (page_id, url, html), in files under the path, which must be new."""
    base = pages.select(
        F.col("page_id").alias("page"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= revisit_bytes
    first = (
        base.where(long_enough).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1 AND first IS NOT NULL").select(F.col("digest").alias("shared"), "first")
    )
    rows = (
        base.join(first, F.when(long_enough, F.col("digest")) == F.col("shared"), "left")
        .select("page", "url", "payload", "digest", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("first"))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                columns = [c.to_pylist() for c in batch.slice(at, 256).columns]
                made = [member(record(*row, date))[:-1] for row in zip(*columns)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["member"])

    packed = rows.mapInArrow(pack, "member binary")
    packed.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


class Damaged(Exception):
    """Why bytes cannot be read as a record."""


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(header, block, offset after it) of the record at an offset."""
    if not data.startswith(b"WARC/1.", at):
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("header not closed")
    header = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        field = name.strip().lower().decode("latin-1")
        if field in header and field != "warc-concurrent-to":
            raise Damaged("header field twice")  # a cut header runs into the next one
        header[field] = value.strip().decode("utf-8", "replace")
    length = header.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damaged("no block length")
    start = stop + 4
    end = start + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("block does not end where its length says")
    block = data[start:end]
    if header.get("warc-type") == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        want = header.get("warc-payload-digest", "")
        if want.startswith("sha256:") and hashlib.sha256(payload).hexdigest() != want[7:]:
            raise Damaged("payload digest differs")
    return header, block, end + 4


def inflate(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """(content, offset after it, fault) of the gzip member at an offset; at a fault, what was inflated before it."""
    unpacker = zlib.decompressobj(31)
    view, out, pos, step = memoryview(data), [], at, 65536
    while not unpacker.eof:
        if pos >= len(data):
            return b"".join(out), len(data), "member is cut off"
        before = unpacker.copy()
        try:
            out.append(unpacker.decompress(view[pos : pos + step]))
            pos += step
        except zlib.error as error:
            if step == 1:
                return b"".join(out), pos, f"member: {error}"
            unpacker, step = before, step // 16  # up to the very byte of the fault
    return b"".join(out), min(pos, len(data)) - len(unpacker.unused_data), None


def packed_end(data: bytes, at: int, size: int) -> int:
    """The offset up to which the member at an offset is read for so many bytes of its content."""
    unpacker = zlib.decompressobj(31)
    view, pos, step = memoryview(data), at, 65536
    while size:
        part, before = view[pos : pos + step], unpacker.copy()
        try:
            size -= len(unpacker.decompress(part, size))
            pos += len(part) - len(unpacker.unconsumed_tail)
        except zlib.error:
            unpacker, step = before, step // 16  # the fault comes right behind
    return pos


def unpacked(content: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str | None]]:
    """Records and gaps of a member's content, as salvage() gives them, by places in the content."""
    at, lost, reason = 0, None, None
    while at < len(content):
        try:
            header, block, end = parse(content, at)
        except Damaged as error:
            if lost is None:
                lost, reason = at, str(error)
            hit = LINE.search(content, at + 1)
            at = hit.start() if hit else len(content)
            continue
        if lost is not None:
            yield lost, at, None, b"", reason
            lost = None
        yield at, end, header, block, None
        at = end
    if lost is not None:
        yield lost, len(content), None, b"", reason


Found = tuple[int, int, dict[str, str] | None, bytes, str | None, tuple[int, int] | None, str | None]


def salvage(data: bytes) -> Iterator[Found]:
    """(offset, end, header, block, reason, inner, fault): records, with no reason, and gaps, with no header.

    inner: the (offset, end) of what lies in a member, in its content; several rows then share the member's offsets.
    fault: of a record, what is wrong with its member. Such a member's rows end where its last record does, and a gap
    follows.
    """
    at, lost, reason = 0, None, None
    while at < len(data):
        fault = None
        try:
            if data.startswith(MAGIC[:2], at):
                content, end, fault = inflate(data, at)
                found = unpacked(content)
                if fault is not None:
                    found = list(found)
                    while found and found[-1][2] is None:
                        found.pop()
                    if not found:
                        raise Damaged(fault)
                    end = packed_end(data, at, found[-1][1])
                rows = ((at, end, *row[2:], row[:2], fault) for row in found)
            else:
                header, block, end = parse(data, at)
                rows = [(at, end, header, block, None, None, None)]
        except Damaged as error:
            if lost is None:
                lost, reason = at, str(error)
            hit = NEXT.search(data, at + 1)
            at = hit.start() if hit else len(data)
            continue
        if lost is not None:
            yield lost, at, None, b"", reason, None, None
            lost = None
        yield from rows
        at = end
        if fault is not None:
            lost, reason = end, fault
            hit = NEXT.search(data, end)
            at = hit.start() if hit else len(data)
    if lost is not None:
        yield lost, len(data), None, b"", reason, None, None


SCHEMA = (
    "archive string, offset bigint, length bigint, inner_offset bigint, inner_length bigint, member_error string, "
    "gap string, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary"
)
PAGE = re.compile(r"<urn:page:(-?\d+)>")


def _rows(archive: str, data: bytes, with_payload: bool) -> Iterator[tuple]:
    for at, end, header, block, reason, inner, fault in salvage(data):
        place = archive, at, end - at, *((inner[0], inner[1] - inner[0]) if inner else (None, None)), fault
        if header is None:
            yield *place, reason, None, None, None, None, None, None, None
            continue
        kind = header.get("warc-type")
        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else b""
        page, target = (PAGE.fullmatch(header.get(k, "")) for k in ("warc-record-id", "warc-refers-to"))
        if kind == "revisit":
            length = header.get("x-payload-length", "")
            size = int(length) if length.isdigit() else None
            digest = header.get("warc-payload-digest", "").removeprefix("sha256:") or None
        else:
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        yield (
            *place, None, int(page[1]) if page else None, header.get("warc-target-uri"), kind,
            int(target[1]) if target else None, size, digest, payload if with_payload and kind == "response" else None,
        )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row per record, and one per quarantined gap (its reason in gap, the columns of a record null)."""
    fields = [f.split() for f in SCHEMA.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                held, weight = [], 0
                for row in _rows(archive, data, with_payload):
                    held.append(row)
                    weight += len(row[-1] or b"") + 200
                    if weight > 1 << 22:
                        yield _batch(held)
                        held, weight = [], 0
                if held:
                    yield _batch(held)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kinds[kind]) for column, (_, kind) in zip(zip(*rows), fields)],
            names=[name for name, _ in fields],
        )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)
