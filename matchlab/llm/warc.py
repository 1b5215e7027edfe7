"""WARC archives: a writer, and a reader that salvages what damaged files still hold."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlab.llm.storage import filesystem, put, shared_folder, store
from matchlab.session import bounded_broadcast

#: Bytes fetched from a file at a time, and looked at at a time; a header fits the latter.
CHUNK, PIECE = 4 << 20, 64 << 10
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
GZIP_MAGIC = b"\x1f\x8b\x08"
#: Bytes to which a gzip member may inflate; a reader holds one member.
MEMBER_LIMIT = 1 << 30
#: Equal payloads whose responses may be broadcast; beyond that they are joined, and skewed digests split at run time.
MAX_SHARED = 1_000_000


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed record; a revisit has an empty block and names the record that holds its payload."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join((url or "").splitlines())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


class Bad(Exception):
    """A check failed at this place of the file."""


def parse(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Header, block and length of the record at the start of raw; Bad if a check fails."""
    if not raw.startswith(b"WARC/1."):
        raise Bad("no version line")
    stop = raw.find(b"\r\n\r\n")
    if stop < 0:
        raise Bad("header without end")
    head = {}
    for line in raw[:stop].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Bad("header line without colon")
        head[name.strip().lower()] = value.strip()
    if not head.get("content-length", "").isdigit():
        raise Bad("no content length")
    begin, size = stop + 4, int(head["content-length"])
    block = raw[begin : begin + size]
    if len(block) < size or raw[begin + size : begin + size + 4] != b"\r\n\r\n":
        raise Bad("block length")
    if (want := head.get("warc-block-digest", "")).startswith("sha1:") and want[5:] != base32_sha1(block):
        raise Bad("block digest")
    return head, block, begin + size + 4


class _Ahead:
    """Reads of a file through a block that is fetched ahead, since records are small and are looked at more than once."""

    def __init__(self, f, size: int):
        self.f, self.size, self.base, self.data = f, size, 0, b""

    def read_at(self, n: int, at: int) -> bytes:
        n = min(n, self.size - at)
        if at < self.base or at + n > self.base + len(self.data):
            self.base, self.data = at, bytes(memoryview(self.f.read_at(max(n, min(CHUNK, self.size - at)), at)))
        return self.data[at - self.base : at - self.base + n]


def _inflated(f, pos: int, size: int, limit: int) -> tuple[bytes, int]:
    """Content of the gzip member at pos, its checksum verified, and the place after it."""
    z, out, at = zlib.decompressobj(31), bytearray(), pos
    try:
        while not z.eof:
            chunk = z.unconsumed_tail
            if not chunk:
                chunk = f.read_at(PIECE, at) if at < size else b""
                if not chunk:
                    raise Bad("member without end")
                at += len(chunk)
            out += z.decompress(chunk, limit + 1 - len(out))
            if len(out) > limit:
                raise Bad("member inflates beyond the limit")
    except zlib.error as e:
        raise Bad("gzip check") from e
    return bytes(out), at - len(z.unused_data)


def _member_at(f, pos: int, size: int, limit: int) -> tuple[list[tuple[str, dict[str, str], bytes]], int]:
    """Records and lost stretches of the member at pos, in order, and the place after it; Bad if it holds no sound record."""
    raw, end = _inflated(f, pos, size, limit)
    found, at, lost, why = [], 0, None, ""
    while at < len(raw):
        try:
            head, block, used = parse(raw[at:] if at else raw)
        except Bad as e:
            if lost is None:
                lost, why = at, str(e)
            at = raw.find(b"WARC/1.", at + 1)
            at = len(raw) if at < 0 else at
            continue
        if lost is not None:
            found.append(("gap", {"reason": why, "member-start": str(lost), "member-end": str(at)}, b""))
            lost = None
        found.append(("record", head, block))
        at += used
    if not any(kind == "record" for kind, _, _ in found):
        raise Bad(why or "empty member")
    if lost is not None:
        found.append(("gap", {"reason": why, "member-start": str(lost), "member-end": str(len(raw))}, b""))
    return found, end


def _plain_at(f, pos: int, size: int) -> tuple[dict[str, str], bytes, int]:
    """The uncompressed record at pos; only what its header announces is read."""
    raw = f.read_at(PIECE, pos)
    stop = raw.find(b"\r\n\r\n")
    if stop < 0 or not raw.startswith(b"WARC/1."):
        parse(raw[: stop + 4] if stop >= 0 else raw)
        raise Bad("header without end")
    length = re.search(rb"(?im)^content-length[ \t]*:[ \t]*(\d{1,18})[ \t]*\r?$", raw[: stop + 2])
    want = stop + 8 + int(length[1]) if length else len(raw)
    if pos + want > size:
        raise Bad("block length")
    if want > len(raw):
        raw = f.read_at(want, pos)
    head, block, used = parse(raw)
    return head, block, pos + used


def _find(f, needle: bytes, pos: int, size: int) -> int:
    """The next place of needle at or after pos, or size."""
    while pos < size:
        chunk = f.read_at(PIECE, pos)
        if (at := chunk.find(needle)) >= 0:
            return pos + at
        if pos + len(chunk) >= size:
            break
        pos += len(chunk) - len(needle) + 1
    return size


def salvage(f, size: int, limit: int = MEMBER_LIMIT) -> Iterator[tuple[str, int, int, dict[str, str], bytes]]:
    """("record" or "gap", start, end, header, block) from a file, in order and without overlap.

    A record counts if its gzip member, version line, lengths and block digest are right. After a failed check
    the next gzip member or version line that passes all checks goes on; the bytes between are one gap,
    whose header holds the reason. The next place of either marker is remembered, so each byte is searched once for each.

    A member may hold several records: all but its last entry are at start = end = the member's place, the last one spans it. What
    is lost between sound records of a member is a gap whose header names the stretch of the inflated bytes. A
    member that inflates beyond `limit` bytes, or a header beyond 64 KB, is a gap.
    """
    f, pos, bad, why = _Ahead(f, size), 0, None, ""
    marks = {GZIP_MAGIC: -1, b"WARC/1.": -1}
    while pos < size:
        try:
            if f.read_at(min(3, size - pos), pos) == GZIP_MAGIC:
                entries, end = _member_at(f, pos, size, limit)
            else:
                head, block, end = _plain_at(f, pos, size)
                entries = [("record", head, block)]
        except Bad as e:
            if bad is None:
                bad, why = pos, str(e)
            for needle, at in marks.items():
                if at <= pos:
                    marks[needle] = _find(f, needle, pos + 1, size)
            pos = min(marks.values())
            continue
        if bad is not None:
            yield "gap", bad, pos, {"reason": why}, b""
            bad = None
        for kind, head, block in entries[:-1]:
            yield kind, pos, pos, head, block
        kind, head, block = entries[-1]
        yield kind, pos, end, head, block
        pos = end
    if bad is not None:
        yield "gap", bad, size, {"reason": why}, b""


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write a record per page into gzip archives of the shared folder; returns their paths and sizes (a stored table).

    Of equal payloads of at least min_bytes bytes the one with the largest id is a response and the others
    are revisits that name it. Null html is an empty payload, a null url an empty one; a null id is written
    as an empty one and is never named by others. Rows that repeat an id and payload are all written; the
    one response per payload is the row with the largest id, and equal ids share its kind. Extra columns are ignored.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    own = own.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    shared = (
        own.where(F.octet_length("html") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("leader"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "leader")
    )
    shared = bounded_broadcast(store(shared, "shared-payloads"), MAX_SHARED)  # so that no text is shuffled
    rows = own.join(shared, "digest", "left").select("id", "url", "html", F.when(F.col("id") != F.col("leader"), F.col("leader")).alias("refers_to"))

    def write(batches):
        name, count, size, out = f"{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for b in batches:
            for i, url, html, refers in zip(*(c.to_pylist() for c in b.columns)):
                payload = html.encode()
                raw = member(record(i, url, payload, base32_sha1(payload), refers))
                out = out or put(folder, name)
                out.write(raw)
                count, size = count + 1, size + len(raw)
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [count], "bytes": [size]})

    return store(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-files")


def read_archives(files: DataFrame, path_col: str = "path", blocks: bool = True) -> DataFrame:
    """Records and gaps of the archives, one row each: path, kind, start, end, reason, header (map), block, block_bytes, block_sha1.

    Each file is one task's work and is read in chunks; one member is held at a time. Without `blocks` the blocks are checked and
    measured but not returned. No files give no rows.
    """

    def read(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, path = filesystem(uri)
                rows, held = [], 0
                with fs.open_input_file(path) as f:
                    for kind, start, end, head, block in salvage(f, f.size()):
                        rows.append((uri, kind, start, end, head.get("reason") if kind == "gap" else None, list(head.items()), block if blocks else None, len(block), base32_sha1(block)))
                        held += len(block) if blocks else 0
                        if held > 8 << 20 or len(rows) >= 2000:
                            yield _rows(rows)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows)

    kinds = pa.schema(
        [("path", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()), ("header", pa.map_(pa.string(), pa.string())), ("block", pa.binary()), ("block_bytes", pa.int64()), ("block_sha1", pa.string())]
    )

    def _rows(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    spread = files.select(path_col).repartition(max(1, files.count()))  # a fixed number is not merged into fewer tasks
    return spread.mapInArrow(read, "path string, kind string, start long, end long, reason string, header map<string,string>, block binary, block_bytes long, block_sha1 string")


def quarantine(records: DataFrame) -> DataFrame:
    """The log of what could not be read: path, start, end, reason, and where a gap lies within a member, its inflated stretch."""
    inside = lambda c: F.col("header")[c].cast("long")
    return records.where("kind = 'gap'").select("path", "start", "end", "reason", inside("member-start").alias("member_start"), inside("member-end").alias("member_end"))


def page_rows(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records that were read back.

    For responses, length and digest are those of the block that was read.
    """
    h = F.col("header")
    number = lambda c: F.nullif(F.regexp_extract(c, r"<urn:page:(-?\d*)>", 1), F.lit("")).cast("long")
    full = h["warc-type"] == "response"
    return records.where("kind = 'record'").select(
        number(h["warc-record-id"]).alias("page_id"),
        F.when(full, F.col("block_bytes")).otherwise(h["warc-payload-length"].cast("long")).alias("payload_bytes"),
        F.when(full, F.col("block_sha1")).otherwise(F.substring(h["warc-payload-digest"], 6, 32)).alias("payload_digest"),
        h["warc-type"].alias("record_type"),
        number(h["warc-refers-to"]).alias("refers_to"),
    )
