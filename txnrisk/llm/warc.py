"""WARC archives: a writer with revisit records and a salvage reader.

Archives hold one gzip member per record. The reader also takes plain WARC
files. Where a member or record fails a check (inflation, CRC, version line,
header, length, block digest), the reader searches on for the next place that
holds a whole valid member or a record's version line, goes on from there, and
reports the bytes in between as a quarantined gap. A member may hold many
records: one that fails is a gap among the others, and of a member that does
not inflate to its end, the records before the damage are kept if their block
digests vouch for them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm.binary_files import read_files, write_chunks
from txnrisk.llm.common import ready, slices

#: Fixed values of the public formats.
GZIP = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_HEADER_END = re.compile(rb"\r\n(?:\r\n|(?=" + VERSION.pattern + rb"))")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: A gzip member ends in the high byte of its content's length: zero below 16 MB. An
#: empty member is put behind longer ones, so that all chunks end in this byte.
LAST = b"\x00"
_EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000030300") + bytes(8)

_PAGE = "urn:x-page:"


def digest(payload: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(content: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(content) + packer.flush()
    return packed if packed.endswith(LAST) else packed + _EMPTY_MEMBER


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
           date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One response record, or a revisit of page ``refers_to``, without gzip.

    A revisit keeps the HTTP head, whose length is the payload's, and not the payload.
    """
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if refers_to is not None else head + payload
    name = f"{_PAGE}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:  # characters that a header line cannot hold are percent-encoded
        fields.insert(3, ("WARC-Target-URI", urllib.parse.quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{_PAGE}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Found:
    """A record, or a gap if ``fields`` is None, and the bytes of the file that it takes."""

    offset: int
    length: int
    fields: dict[str, str] | None = None
    block: bytes | None = None
    reason: str | None = None

    @property
    def payload(self) -> bytes:
        """The block, without the HTTP head where it has one."""
        if "application/http" in self.fields.get("content-type", ""):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block

    @property
    def http_length(self) -> int | None:
        """Length of the payload by its HTTP head."""
        found = _HTTP_LENGTH.search(self.block.partition(b"\r\n\r\n")[0])
        return int(found[1]) if found else None


_CUT_OFF = "member is cut off"
_HTTP_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*([0-9]{1,18})")


def _parse(content: bytes | memoryview, at: int = 0, vouched: bool = True) -> tuple[dict[str, str], bytes, int] | str:
    """Fields, block and end of the record that begins at ``at``, or what is wrong with it.

    Without ``vouched`` a record needs a block digest.
    """
    content = memoryview(content)
    if not VERSION.match(content, at):
        return "no version line"
    last = _HEADER_END.search(content, at)
    if not last or last.end() - last.start() < 4:  # another record begins before it ends
        return "header does not end"
    end = last.start() - at
    lines = bytes(content[at:at + end]).decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, colon, v in (line.partition(":") for line in lines) if colon}
    if not all(name in fields for name in MANDATORY):
        return "mandatory field is missing"
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", ""), re.ASCII):
        return "no content length"
    start = at + end + 4
    stop = start + int(fields["content-length"])
    if bytes(content[stop:stop + 4]) != b"\r\n\r\n":
        return "record does not end where its length says"
    block = bytes(content[start:stop])
    claimed = fields.get("warc-block-digest", "")
    if claimed.lower().startswith("sha1:"):
        if claimed[5:].upper() != digest(block):
            return "block digest differs"
    elif not vouched:
        return "no block digest in a broken member"
    return fields, block, stop + 4


def _inflate(content: memoryview, at: int) -> tuple[bytes, int] | str:
    """Content and end of the gzip member at ``at``, or what is wrong with it."""
    worker = zlib.decompressobj(31)
    parts, step = [], 1 << 16
    try:
        while not worker.eof:
            if at >= len(content):
                return _CUT_OFF
            parts.append(worker.decompress(content[at:at + step]))
            at += step
        return b"".join(parts), min(at, len(content)) - len(worker.unused_data)
    except zlib.error as error:
        return str(error)


def _inflate_broken(content: memoryview, at: int) -> bytes:
    """What inflates of a broken member, up to the byte that fails."""
    worker = zlib.decompressobj(31)
    parts, step = [], 1 << 16
    while at < len(content):
        before = worker.copy()
        try:
            parts.append(worker.decompress(content[at:at + step]))
            at += step
        except zlib.error:
            if step == 1:
                break
            worker, step = before, 1
    return b"".join(parts)


def _records(inner: bytes, vouched: bool) -> Iterator[tuple[int, int, dict[str, str] | None, bytes | str]]:
    """(begin, end, fields, block) of the records of inflated bytes; of the gaps, no fields and the reason."""
    place, gap, reason = 0, None, ""
    while place < len(inner):
        parsed = _parse(inner, place, vouched)
        if isinstance(parsed, str):
            if gap is None:
                gap, reason = place, parsed
            following = VERSION.search(inner, place + 1)
            place = following.start() if following else len(inner)
            continue
        if gap is not None:
            yield gap, place, None, reason
            gap = None
        yield place, parsed[2], *parsed[:2]
        place = parsed[2]
    if gap is not None:
        yield gap, len(inner), None, reason


def salvage(content: bytes | memoryview) -> Iterator[Found]:
    """Records and gaps of a file, in order; together they cover all its bytes but empty members and padding.

    What a member holds takes the member's bytes, gaps inside it as well. The
    records kept of a broken member take the bytes of the gap that follows them.
    """
    content = memoryview(content)
    view = content.obj if isinstance(content.obj, bytes) and len(content.obj) == len(content) else content
    candidate = re.compile(re.escape(GZIP) + rb"|" + VERSION.pattern)
    at, gap, reason = 0, None, None
    kept: list[tuple[dict[str, str], bytes]] = []  # of the broken member at ``gap``

    def closed(end: int) -> Iterator[Found]:
        nonlocal gap
        if gap is not None:
            yield from (Found(gap, end - gap, *record) for record in kept)
            kept.clear()
            yield Found(gap, end - gap, reason=reason)
            gap = None

    while at < len(content):
        skip = 1
        if bytes(content[at:at + 3]) == GZIP:
            inflated = _inflate(content, at)
            if isinstance(inflated, str):
                problem = inflated
                inner = _inflate_broken(content, at)
                sound = [found for found in _records(inner, False) if found[2] is not None]
                if sound and problem == _CUT_OFF and sound[-1][1] == len(inner):
                    sound.pop()  # the cut may be in it
                if sound:
                    yield from closed(at)
                    kept += [found[2:] for found in sound]
                    # Stored, not deflated, records would be found again in the bytes behind.
                    worker = zlib.decompressobj(31)
                    worker.decompress(content[at:], sound[-1][1] - 1)
                    skip = max(1, len(content) - at - len(worker.unconsumed_tail) - len(worker.unused_data))
            else:
                inner, end = inflated
                pieces = list(_records(inner, True))
                if not pieces or any(piece[2] is not None for piece in pieces):
                    yield from closed(at)
                    for begin, stop, fields, block in pieces:
                        yield Found(at, end - at, fields, block) if fields is not None else Found(
                            at, end - at, reason=f"{block} (bytes {begin} to {stop} of the member's content)")
                elif gap is None:
                    gap, reason = at, pieces[0][3]
                at = end
                continue
        else:
            parsed = _parse(content, at)
            if not isinstance(parsed, str):
                yield from closed(at)
                yield Found(at, parsed[2] - at, *parsed[:2])
                at = parsed[2]
                continue
            problem = parsed
        if gap is None:
            gap, reason = at, problem
        following = candidate.search(view, at + skip)
        at = following.start() if following else len(content)
    yield from closed(len(content))


def write_archives(pages: DataFrame, path: str, revisit_from: int = 0, id_column: str = "page_id",
                   url_column: str = "url", payload_column: str = "html") -> None:
    """Write one record per row; equal payloads of ``revisit_from`` bytes or more are revisits of the smallest id's.

    The payload is the text in UTF-8, null an empty one. Rows that repeat the
    smallest id are responses as well, as is a row without id. Other columns are
    ignored. An empty table writes no records.
    """
    ready(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(payload_column), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload")
                        ).withColumn("sha1", F.sha1("payload"))
    first = (rows.where(F.octet_length("payload") >= revisit_from).groupBy("sha1")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    marked = rows.join(first, "sha1", "left").withColumn(
        "refers_to", F.when((F.col("page_id") != F.col("first")) & (F.octet_length("payload") >= revisit_from), F.col("first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "payload"):
            chunks = [_member(record(*row))[:-1] for row in zip(*(
                batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")))]
            yield pa.record_batch([pa.array(chunks, pa.binary())], ["chunk"])

    write_chunks(marked.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "chunk binary"), path, LAST)


_SCHEMA = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap_reason", pa.string()),
    ("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("refers_to", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

def _row(name: str, found: Found, keep_payload: bool) -> tuple:
    if found.fields is None:
        return (name, found.offset, found.length, found.reason, *[None] * 7)
    fields, kind = found.fields, found.fields.get("warc-type")
    bare = [fields[k].strip("<>") if k in fields else None for k in ("warc-record-id", "warc-target-uri", "warc-refers-to")]
    if kind == "revisit":  # of the payload it refers to
        claimed = fields.get("warc-payload-digest", "").partition(":")[2] or None
        return (name, found.offset, found.length, None, kind, *bare, claimed, found.http_length, None)
    payload = found.payload
    return (name, found.offset, found.length, None, kind, *bare, digest(payload), len(payload),
            payload if keep_payload else None)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all files below ``path``, whatever their names, in subfolders too.

    Only what Spark takes for hidden is left out: names that begin with ``_`` or ``.``.
    A record has gap_reason null; record_id, url and refers_to are bare. Digest
    (base32 SHA-1) and size are computed from the payload; those of a revisit
    are what it says of the payload it stands for, and its payload is null. A
    gap has its reason, offset and length, and nothing else.
    ``payloads=False`` leaves the payload column null.
    """
    ready(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, held = [], 0
                for found in salvage(content.as_py()):
                    rows.append(_row(name, found, payloads))
                    held += len(found.block or b"")
                    if held > 8 << 20 or len(rows) == 4096:
                        yield pa.record_batch(list(map(pa.array, zip(*rows), _SCHEMA.types)), schema=_SCHEMA)
                        rows, held = [], 0
                if rows:
                    yield pa.record_batch(list(map(pa.array, zip(*rows), _SCHEMA.types)), schema=_SCHEMA)

    return read_files(spark, path, "*").mapInArrow(
        run, "path string, offset long, length long, gap_reason string, record_type string, record_id string, "
             "url string, refers_to string, payload_digest string, payload_bytes long, payload binary")


def page_number(name):
    """The page id in a record's name; null for other names."""
    return F.regexp_extract(name, f"^{_PAGE}(-?[0-9]+)$", 1).try_cast("long")
