r"""Operator 8: a WARC reader that salvages damaged archives.

An archive is read record by record: a gzip member (checked by its CRC and length) or a plain record. A record is good if
its version line, headers, Content-Length, closing line breaks and, if given, WARC-Block-Digest hold. Where a check fails,
the reader looks for the next gzip magic or version line from which a good record can be read, goes on there, and logs
the bytes between as a quarantined gap with the check that failed. A member that holds several records is read the same
way inside, wherever its first version line is. If such a member fails its own check, the records inflated before stay and the
rest is a gap: after wrong data or a wrong CRC those whose digest holds, in a member cut short all good ones. A member that gives
one record and nothing else is good by its own check only.

Archives come as rows (shard, content), from read_archives() or write_archives(), or as files of any size, which read_files() streams through windows; each
archive is read on its own, so archives spread over all tasks. Records leave a task as they are read. The time taken is in proportion to an archive's size.

Defined results: a record is one row with begin and end (bytes in the archive), inner (bytes inside a member that holds several, else 0), its
type, target, page id and payload; a gap is one row with its begin, end and reason. A NULL content has no rows, an empty one neither; repeated
archives are read each; records without an HTTP or page header have NULLs there; a record cut short at the end is a gap to the end.
An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "kind string, shard string, begin long, end long, inner_begin long, warc_type string, target_uri string, page_id long, payload string, reason string"
SHARD_RECORDS = 256
_GZIP = b"\x1f\x8b\x08"
_START = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]|WARC/(?:0\.1[78]|1\.[01])\r\n")
_VERSION = re.compile(rb"WARC/(?:0\.1[78]|1\.[01])\r\n")
_BLANK = b"\r\n\r\n"
_CUT = "gzip: cut short"
_PIECE = 4096


class Damaged(Exception):
    """A check that failed; found holds the records and gaps of a failed member of several, resume where their bytes end."""

    def __init__(self, reason: str, found: list[Record | Gap] | None = None, resume: int = 0) -> None:
        super().__init__(reason)
        self.found, self.resume = found or [], resume


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    begin: int
    end: int
    inner: int = 0


@dataclass
class Gap:
    begin: int
    end: int
    reason: str
    inner: int = 0


def plain_record(data: bytes, at: int) -> Record:
    """The record at a version line; raises Damaged."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    stop = data.find(_BLANK, version.end() - 2)
    if stop < 0:
        raise Damaged("headers without end")
    headers: dict[str, str] = {}
    for line in data[version.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without colon")
        headers[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    begin = stop + 4
    end = begin + int(length)
    if end + 4 > len(data):
        raise Damaged("cut short")
    if data[end : end + 4] != _BLANK:
        raise Damaged("wrong content length")
    block = data[begin:end]
    digest = headers.get("warc-block-digest", "")
    if digest.lower().startswith("sha1:") and base64.b32encode(hashlib.sha1(block, usedforsecurity=False).digest()).decode() != digest[5:].strip().upper():
        raise Damaged("wrong digest")
    return Record(headers, block, at, end + 4)


def member(data: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at a place; raises Damaged. It is read in pieces: zlib copies what lies behind a member's end."""
    inflate, view, out, lo, size = zlib.decompressobj(31), memoryview(data), [], at, _PIECE
    while lo < len(data):
        piece = view[lo : lo + size]
        try:
            out.append(inflate.decompress(piece))
        except zlib.error as e:
            raise Damaged(f"gzip: {str(e).rpartition(': ')[2]}") from None
        lo += len(piece)
        if inflate.eof:
            return b"".join(out), lo - len(inflate.unused_data)
        size = min(2 * size, 1 << 20)
    raise Damaged(_CUT)


def inflated(data: bytes, at: int) -> bytes:
    """What a failed member gives before the place of its failure."""
    inflate, out = zlib.decompressobj(31), []
    for lo in range(at, len(data), _PIECE):
        before = inflate.copy()
        try:
            out.append(inflate.decompress(data[lo : lo + _PIECE]))
        except zlib.error:  # all bytes up to the one that fails
            try:
                for i in range(lo, lo + _PIECE):
                    out.append(before.decompress(data[i : i + 1]))
            except zlib.error:
                break
        if inflate.eof:
            break
    return b"".join(out)


def consumed(data: bytes, at: int, size: int) -> int:
    """The place up to which a member must be read for so many bytes of content."""
    inflate, got = zlib.decompressobj(31), 0
    for lo in range(at, len(data), _PIECE):
        before = inflate.copy()
        try:
            more = len(inflate.decompress(data[lo : lo + _PIECE]))
        except zlib.error:
            more = size
        if got + more >= size:
            for i in range(lo, lo + _PIECE):
                got += len(before.decompress(data[i : i + 1]))
                if got >= size:
                    return i + 1
        got += more
    return len(data)


def rescued(data: bytes, at: int, failed: Damaged) -> Damaged:
    """The failed check with what can be read of a member of several records."""
    content = inflated(data, at)
    inside = list(salvage(content)) if _VERSION.search(content) else []
    if len(inside) < 2:
        return failed
    cut = str(failed) == _CUT
    found = [x if isinstance(x, Gap) or cut or x.headers.get("warc-block-digest", "").lower().startswith("sha1:") else Gap(x.begin, x.end, str(failed)) for x in inside]
    while found and isinstance(found[-1], Gap):
        found.pop()
    if not found:
        return failed
    stop = found[-1].end
    return Damaged(str(failed), [*found, Gap(stop, len(content), str(failed))], consumed(data, at, stop))


def records_at(data: bytes, at: int) -> tuple[list[Record | Gap], int]:
    """What the member or record at a place holds, and its end; raises Damaged if nothing good begins there."""
    if data.startswith(_GZIP, at):
        try:
            content, end = member(data, at)
        except Damaged as e:
            raise rescued(data, at, e) from None
        inside = list(salvage(content)) if _VERSION.search(content) else []
        if not any(isinstance(x, Record) for x in inside):
            raise Damaged("member without a record" if not inside else inside[0].reason)
        placed(inside, at, end)
        return inside, end
    record = plain_record(data, at)
    return [record], record.end


def placed(inside: list[Record | Gap], at: int, end: int) -> None:
    """Records and gaps of a member get the member's place."""
    several = len(inside) > 1
    for x in inside:
        x.inner = x.begin if several else 0
        x.begin, x.end = at, end


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records and gaps in order; together they cover the data, but for line breaks between records."""
    at, size = 0, len(data)
    while at < size:
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        try:
            found, end = records_at(data, at)
        except Damaged as e:
            begin, failed, found, end, stop = at, e, [], size, size
            for m in _START.finditer(data, max(at + 1, e.resume)):
                try:
                    found, end = records_at(data, m.start())
                except Damaged as other:
                    if not other.found:
                        continue
                    end = m.start()  # a failed member with records: its own turn comes next
                stop = m.start()
                break
            if failed.found:
                placed(failed.found, begin, stop)
                yield from failed.found
            else:
                yield Gap(begin, stop, str(failed))
        yield from found
        at = end


#: Failures that more bytes could mend.
_OPEN = {_CUT, "cut short", "headers without end", "member without a record"}
WINDOW = 64 << 20
MOST = 1 << 30


def salvage_stream(more: Callable[[int], bytes], window: int = WINDOW, most: int = MOST) -> Iterator[Record | Gap]:
    """salvage() of an archive of any size, of which more(n) gives the next bytes, none at the end. What could still change with the bytes to come is read again with
    them; but a failure stands once ``most`` bytes behind its begin are there, so a record or member of more than that is a gap."""
    base, data, over = 0, b"", False
    while not over:
        added = more(max(window, len(data)))  # a long record is read in doubling steps
        over = not added
        data += added
        done = 0
        for begin, group in itertools.groupby(salvage(data), key=lambda x: x.begin):
            found = list(group)
            gaps = [x for x in found if isinstance(x, Gap)]
            end = found[-1].end
            if gaps and not over and len(data) - begin < most and (end >= len(data) or any(x.reason in _OPEN for x in gaps)):
                break
            done = end
            for x in found:
                x.begin, x.end = x.begin + base, x.end + base
                yield x
        base, data = base + done, data[done:]


def page_bytes(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """One response record."""
    block = (html or "").encode("utf-8", "surrogatepass")
    headers = ["WARC/1.1", "WARC-Type: response" if html is not None else "WARC-Type: metadata", f"Content-Length: {len(block)}"]
    headers.append(f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block, usedforsecurity=False).digest()).decode()}")
    if url is not None:
        headers.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        headers.append(f"X-Page-Id: {page_id}")
    return "\r\n".join(headers).encode() + _BLANK + block + _BLANK


def damage(raw: bytes, page_id: int | None, packed: bool, every: int) -> bytes:
    """For tests of the reader: the record of every so many-th page is hit, in turn by a changed byte, a lost end, or bytes put before it."""
    if not every or page_id is None or page_id % every != every - 1:
        return raw
    kind = page_id // every % 3
    if kind == 0:
        middle = len(raw) // 2
        return raw[:middle] + bytes([raw[middle] ^ 0x55]) + raw[middle + 1 :]
    if kind == 1:
        return raw[: len(raw) * 2 // 3]
    return b"\x1f\x8b\x08\x00 torn" + raw if packed else b"WARC/1.0\r\ntorn" + raw


def write_archives(pages: DataFrame, records: int = SHARD_RECORDS, damage_every: int = 0) -> DataFrame:
    """(shard, content): archives of up to ``records`` pages each, by turns of gzip members and of plain records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, records):
                part = batch.slice(lo, records)
                packed = number % 2 == 0
                out = []
                for page_id, url, html in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                    raw = page_bytes(page_id, url, html)
                    if packed:
                        z = zlib.compressobj(1, zlib.DEFLATED, 31)
                        raw = z.compress(raw) + z.flush()
                    out.append(damage(raw, page_id, packed, damage_every))
                yield pa.RecordBatch.from_arrays([pa.array([f"{partition:06d}-{number:06d}.warc{'.gz' * packed}"]), pa.array([b"".join(out)], pa.binary())], names=["shard", "content"])
                number += 1

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(write, "shard string, content binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(shard, content) of the files of a path, of up to 2 GB each; read_files() has no such bound."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("shard"), "content")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of the archives of a path, as read() gives them. A task streams its files through windows, so an archive may be larger than a row can be."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                system, place = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", shard).replace(" ", "%20"))
                with system.open_input_file(place) as f:
                    yield from _batches(shard, salvage_stream(f.read))

    return files.mapInArrow(run, SCHEMA)


def _row(shard: str, x: Record | Gap) -> tuple:
    if isinstance(x, Gap):
        return "gap", shard, x.begin, x.end, x.inner, None, None, None, None, x.reason
    page = x.headers.get("x-page-id", "")
    kind = x.headers.get("warc-type")
    payload = None if kind == "metadata" and not x.block else x.block.decode("utf-8", "replace")
    return "record", shard, x.begin, x.end, x.inner, kind, x.headers.get("warc-target-uri"), int(page) if re.fullmatch(r"-?\d{1,18}", page) else None, payload, None


_TYPES = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
BATCH_BYTES = 16 << 20


def _batches(shard: str, found: Iterator[Record | Gap]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    rows, size = [], 0
    for x in found:
        rows.append(_row(shard, x))
        size += 256 + (len(x.block) if isinstance(x, Record) else 0)
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)


def read(archives: DataFrame) -> DataFrame:
    """Records and gaps of all archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                yield from _batches(shard, salvage(content.as_py() or b""))

    return archives.select("shard", "content").mapInArrow(run, SCHEMA)
