"""WARC archives and their two-level capture index.

Pages become gzip members of WARC files in the shared folder, one member a record,
so that any record can be read alone. Of equal payloads the one with the smallest
page id is stored, the others are revisits that refer to it. The capture index has
two levels: lines sorted by reversed-host key, packed into compressed blocks, and a
sparse directory with the first and last key of each block. A lookup searches the
directory, reads the block, searches in it and reads the record by its byte range.

A task writes files under names of its own and the rows that it returns say what
they hold. Those rows are written as a table before anything is read, so a lost or
repeated attempt leaves files that no row names.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import urllib.parse
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.llm.common import cut_lineage, shared_path, ship_package

BLOCK_LINES = 2_000
FILE_BYTES = 256 << 20
#: Records nearer than this in one file are fetched by one read.
READ_GAP = 64 << 10
MOST_IN_ONE_READ = 16 << 20
KEPT_BLOCKS = 8
#: The rows that ask are small beside what they fetch, so their size says nothing about a task's work.
LOOKUPS_A_TASK = 20_000

_NO_ID = -(1 << 63)
_CAPTURE = "key string, page_id long, file string, offset long, length long"


def reversed_host_key(url: Column | str) -> Column:
    """``com,example,www)/path?query``: host labels reversed and lowered, without scheme, user, port and fragment.

    What has no scheme and host is its own key; a null url has the empty key.
    """
    column = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    whole = r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)(?::[0-9]*)?([^#]*).*$"
    host = F.lower(F.regexp_extract(column, whole, 1))
    return F.when(column.rlike(whole), F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"),
                                                F.regexp_extract(column, whole, 2))).otherwise(column)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def base32_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    name = record_id.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, first: int | None, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    revisit = page_id != first
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {urllib.parse.quote(url, safe=_URI)}")
    if revisit:
        lines += [f"WARC-Refers-To: {_record_id(first)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{base32_digest(sha1)}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


_URI = "".join(chr(c) for c in range(0x21, 0x7F))


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """(WARC headers, payload, payload length told by the HTTP header) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    http, _, payload = rest[:int(headers["Content-Length"])].partition(b"\r\n\r\n")
    told = next((int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")), len(payload))
    return headers, payload, told


def _write_records(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    system, root = _open(folder)
    sink, name, at = None, "", 0
    for batch in batches:
        rows = []
        for key, page_id, url, html, sha1, first in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "url", "html", "sha1", "first"))):
            if sink is None or at > FILE_BYTES:
                if sink is not None:
                    sink.close()
                name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                sink = system.open_output_stream(f"{root}/{name}", compression=None)
            member = gzip.compress(record(page_id, url, (html or "").encode(), bytes.fromhex(sha1), first, date), 6, mtime=0)
            sink.write(member)
            rows.append((key, page_id, name, at, len(member)))
            at += len(member)
        if sink is not None:
            sink.flush()
        yield _table(rows, [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()], ["key", "page_id", "file", "offset", "length"])
    if sink is not None:
        sink.close()


def _table(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record for every row of ``pages(page_id, url, html)``; (key, page_id, file, offset, length) of each.

    Null html has the empty payload. Equal payloads are told by SHA-1. Rows that repeat
    the smallest id of a payload are responses all; a null id is a revisit unless no
    row with that payload has an id. The date of every record is a parameter.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    rows = rows.withColumns({"key": reversed_host_key("url"), "sha1": F.sha1(F.coalesce("html", F.lit("")).cast("binary"))})
    firsts = rows.groupBy("sha1").agg(F.min("page_id").alias("first"))
    return cut_lineage(rows.join(firsts, "sha1").mapInArrow(lambda it: _write_records(it, folder, date), _CAPTURE))


def _line(row: tuple) -> bytes:
    key, page_id, file, offset, length = row
    return "\t".join([urllib.parse.quote(key), "" if page_id is None else str(page_id), file, str(offset), str(length)]).encode()


def _capture(line: bytes) -> tuple:
    key, page_id, file, offset, length = line.decode().split("\t")
    return urllib.parse.unquote(key), int(page_id) if page_id else _NO_ID, file, int(offset), int(length)


def _write_blocks(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, root = _open(folder)
    sink, name, at, held = None, "", 0, []

    def flush() -> pa.RecordBatch:
        nonlocal sink, name, at
        if sink is None:
            name = f"captures-{uuid.uuid4().hex}.cdx.z"
            sink = system.open_output_stream(f"{root}/{name}", compression=None)
        packed = zlib.compress(b"\n".join(map(_line, held)))
        sink.write(packed)
        ends = [(row[0], _NO_ID if row[1] is None else row[1]) for row in (held[0], held[-1])]
        row = (*ends[0], *ends[1], name, at, len(packed))
        at += len(packed)
        held.clear()
        return _table([row], [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()],
                      ["first_key", "first_page", "last_key", "last_page", "file", "offset", "length"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            held.append(row)
            if len(held) == BLOCK_LINES:
                yield flush()
    if held:
        yield flush()
    if sink is not None:
        sink.close()


def build_index(captures: DataFrame, folder: str) -> str:
    """Sort the captures into compressed blocks and write the block directory, a row a block; its path."""
    directory = f"{folder}/directory-{uuid.uuid4().hex}"
    (captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
     .mapInArrow(lambda it: _write_blocks(it, folder),
                 "first_key string, first_page long, last_key string, last_page long, file string, offset long, length long")
     .write.parquet(directory))
    return directory


class CaptureIndex:
    """What a task reads of the index: the part of the directory that its keys fall in, and a few blocks."""

    def __init__(self, folder: str, directory: str):
        self.system, self.root = _open(folder)
        self.directory = ds.dataset(_open(directory)[1], filesystem=self.system, format="parquet", ignore_prefixes=["_", "."])
        self.blocks: OrderedDict[tuple, list[tuple]] = OrderedDict()

    def captures(self, wanted: list[tuple[str, int]]) -> list[tuple]:
        """Captures with one of the given (key, page id), which come sorted, repeats once each."""
        if not wanted:
            return []
        part = self.directory.to_table(filter=(ds.field("last_key") >= wanted[0][0]) & (ds.field("first_key") <= wanted[-1][0])).to_pylist()
        part.sort(key=lambda r: (r["first_key"], r["first_page"], r["last_key"], r["last_page"]))
        firsts = [(r["first_key"], r["first_page"]) for r in part]
        lasts = [(r["last_key"], r["last_page"]) for r in part]
        found = []
        for own in wanted:
            for block in part[bisect.bisect_left(lasts, own):bisect.bisect_right(firsts, own)]:
                lines = self._block(block)
                at = bisect.bisect_left(lines, own)
                while at < len(lines) and lines[at][:2] == own:
                    found.append(lines[at])
                    at += 1
        return found

    def _block(self, row: dict) -> list[tuple]:
        name = (row["file"], row["offset"])
        if name not in self.blocks:
            with self.system.open_input_file(f"{self.root}/{row['file']}") as file:
                packed = file.read_at(row["length"], row["offset"])
            self.blocks[name] = [_capture(line) for line in zlib.decompress(packed).split(b"\n")]
            while len(self.blocks) > KEPT_BLOCKS:
                self.blocks.popitem(last=False)
        return self.blocks[name]

    def records(self, captures: list[tuple]) -> Iterator[bytes]:
        """Records of the captures in order of file and offset; near ones share a read of bounded size."""
        ordered = sorted(captures, key=lambda c: c[2:4])
        begin = 0
        while begin < len(ordered):
            end = begin + 1
            low, high = ordered[begin][3], ordered[begin][3] + ordered[begin][4]
            while (end < len(ordered) and ordered[end][2] == ordered[begin][2] and ordered[end][3] - high <= READ_GAP
                   and ordered[end][3] + ordered[end][4] - low <= MOST_IN_ONE_READ):
                high = max(high, ordered[end][3] + ordered[end][4])
                end += 1
            with self.system.open_input_file(f"{self.root}/{ordered[begin][2]}") as file:
                raw = file.read_at(high - low, low)
            for _, _, _, offset, length in ordered[begin:end]:
                yield gzip.decompress(raw[offset - low:offset - low + length])
            begin = end


def _read_back(batches: Iterator[pa.RecordBatch], folder: str, directory: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    index = CaptureIndex(folder, directory)
    for batch in batches:
        wanted = [(k, _NO_ID if p is None else p) for k, p in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist())]
        captures = index.captures(wanted)
        for i in range(0, max(1, len(captures)), 1_000):
            rows = []
            for raw in index.records(captures[i:i + 1_000]):
                headers, payload, told = parse_record(raw)
                revisit = headers["WARC-Type"] == "revisit"
                digest = headers["WARC-Payload-Digest"].partition(":")[2] if revisit else base32_digest(hashlib.sha1(payload).digest())
                uri = headers.get("WARC-Target-URI")
                rows.append((_page_of(headers["WARC-Record-ID"]), urllib.parse.unquote(uri) if uri is not None else None,
                             told if revisit else len(payload), digest, headers["WARC-Type"],
                             _page_of(headers["WARC-Refers-To"]) if revisit else None, payload if payloads and not revisit else None))
            yield _table(rows, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()],
                         ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def look_up(wanted: DataFrame, folder: str, directory: str, payloads: bool = True) -> DataFrame:
    """Records of the captures ``wanted(key, page_id)``, read through the index; a capture that is not there gives no row.

    Wanted rows are brought into the order of the index, so each task searches one
    stretch of the directory and reads each block once. A revisit has the length and
    digest of the payload it refers to and no ``payload``; a response's digest is taken anew from what was read.
    """
    ship_package(wanted.sparkSession)
    keys = cut_lineage(wanted.select("key", F.col("page_id").cast("long").alias("page_id")).distinct())
    tasks = max(int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")), keys.count() // LOOKUPS_A_TASK)
    return (keys.repartitionByRange(tasks, "key", "page_id").sortWithinPartitions("key", "page_id")
            .mapInArrow(lambda it: _read_back(it, folder, directory, payloads),
                        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"))


def new_folder(spark: SparkSession) -> str:
    """A folder for archives in the shared folder, with a name of its own."""
    folder = shared_path(spark, f"warc-{uuid.uuid4().hex}")
    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    return folder


def archive_and_read_back(pages: DataFrame) -> DataFrame:
    """Archive ``pages``, index the captures and read every page's record through the index."""
    folder = new_folder(pages.sparkSession)
    captures = write_archives(pages, folder)
    directory = build_index(captures, folder)
    wanted = pages.select(reversed_host_key(F.col("url").cast("string")).alias("key"), "page_id")
    return look_up(wanted, folder, directory, payloads=False).drop("payload")
