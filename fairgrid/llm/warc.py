"""WARC archives with a two-level capture index, written to and read from the cluster's shared folder."""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_dir

#: Payloads below this size are never revisits.
MIN_REVISIT_BYTES = 1000
#: Captures in a compressed index block, and blocks a reader keeps open.
BLOCK_LINES, BLOCKS_KEPT = 512, 16
#: Compressed bytes after which a task begins its next file.
FILE_BYTES = 1 << 30
#: Digests of repeated payloads up to which they are broadcast, so that payloads stay where they are; beyond that rows meet them in a join.
BROADCAST_DIGESTS = 200_000
#: The file with the top level of an archive's index: its index files in key order, and the record files that count.
MANIFEST = "archive.json"
#: Record ids are UUIDs of this name space; a revisit can so name its response.
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:fairgrid:captures")
#: Target of pages without URL; the page's own is then in X-Page-Url.
NO_URL = "about:invalid"
NOT_IN_URI = re.compile(r"[^!#$%&'()*+,/:;=?@\[\]A-Za-z0-9_.~-]")

# Fixed values of WARC 1.1.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_BLOCK, FIELDS_BLOCK = "application/http; msgtype=response", "application/warc-fields"


def reversed_host_key(url: str | None) -> str:
    """The sort key of a URL: host labels reversed, then path and query; scheme, ``www.``, port and fragment left out."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return f"){url}"
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def target_uri(url: str | None) -> str:
    """``url`` as a header can hold it: bytes that no URI has are percent-coded."""
    return NOT_IN_URI.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "replace")), url) if url else NO_URL


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id} {digest}')}>"


def _record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in {"WARC-Type": kind, **headers, "Content-Length": str(len(block))}.items())
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + member.flush()


def _file_record(name: str, date: str) -> bytes:
    """The warcinfo record that begins a file."""
    headers = {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date, "WARC-Filename": name, "Content-Type": FIELDS_BLOCK}
    return _record("warcinfo", headers, b"software: fairgrid\r\nformat: WARC File Format 1.1\r\n")


def _capture_record(row: dict, date: str) -> bytes:
    """The response or revisit record of one page; a revisit keeps the HTTP head, which tells the payload's length."""
    payload, digest = row["payload"].encode(), row["payload_digest"]
    uri, again = target_uri(row["url"]), row["refers_to"] is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = {
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>" if again else record_id(row["page_id"], digest),
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type": HTTP_BLOCK,
        "X-Page-Id": json.dumps(row["page_id"]),
    }
    if uri != row["url"]:
        headers["X-Page-Url"] = json.dumps(row["url"])
    if again:
        headers |= {
            "WARC-Profile": REVISIT_PROFILE,
            "WARC-Refers-To": record_id(row["refers_to"], digest),
            "WARC-Refers-To-Target-URI": target_uri(row["refers_url"]),
            "WARC-Refers-To-Date": date,
            "X-Refers-To-Page-Id": str(row["refers_to"]),
        }
    return _record("revisit" if again else "response", headers, head if again else head + payload)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one compressed record."""
    plain = zlib.decompress(raw, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def parse_capture(raw: bytes) -> tuple:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, html) of a response or revisit record."""
    headers, block = parse_record(raw)
    again, (http, _, body) = headers["WARC-Type"] == "revisit", block.partition(b"\r\n\r\n")
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    n_bytes = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
    if not again and (hashlib.sha1(body).hexdigest() != digest or len(body) != n_bytes):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload does not match its digest")
    url = json.loads(headers["X-Page-Url"]) if "X-Page-Url" in headers else headers["WARC-Target-URI"]
    refers = int(headers["X-Refers-To-Page-Id"]) if again else None
    return json.loads(headers["X-Page-Id"]), url, headers["WARC-Type"], n_bytes, digest, refers, None if again else body.decode()


@dataclass(frozen=True)
class Archive:
    """Where an archive lies, and the index files with the first key of each, in key order."""

    folder: str
    index_files: list[tuple[str, str]]

    def file(self, name: str) -> tuple[pafs.FileSystem, str]:
        fs, path = pafs.FileSystem.from_uri(self.folder)
        return fs, f"{path}/{name}"

    def store(self, record_files: list[str]) -> None:
        """Write the top level of the index, with the names of the record files that count, and remove what tasks that ran twice have left beside them."""
        fs, target = self.file(MANIFEST)
        with fs.open_output_stream(target, compression=None) as out:
            out.write(json.dumps({"record_files": sorted(record_files), "index_files": self.index_files}).encode())
        known = {*record_files, *(name for _, name in self.index_files), MANIFEST}
        for found in fs.get_file_info(pafs.FileSelector(target.rsplit("/", 1)[0])):
            if found.is_file and found.base_name not in known:
                fs.delete_file(found.path)

    @staticmethod
    def open(folder: str) -> Archive:
        """The archive in ``folder``, by what ``store`` wrote there."""
        fs, target = Archive(folder, []).file(MANIFEST)
        with fs.open_input_stream(target, compression=None) as stream:
            return Archive(folder, [tuple(x) for x in json.loads(stream.read())["index_files"]])


def resolve_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to, refers_url): of equal payloads the largest page_id is the response.

    Payloads are equal where SHA-1 and length agree. Only ids and digests are grouped,
    combined before the shuffle, and those that repeat are written and counted: up to BROADCAST_DIGESTS they are broadcast, so that no payload moves;
    beyond that rows meet them in a join that AQE can split where a payload is very frequent.
    A null page_id refers to the response, too, and is never one that others refer to.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"),
    )
    keys = ["payload_digest", "payload_bytes"]
    shared = rows.where(F.col("payload_bytes") >= min_bytes).groupBy(*keys).agg(F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("r"), F.count("*").alias("n"))
    shared = cut(shared.where("n > 1 and r is not null").select(*keys, F.col("r.page_id").alias("response"), F.col("r.url").alias("response_url")))
    met = rows.join(F.broadcast(shared) if shared.count() <= BROADCAST_DIGESTS else shared, keys, "left")
    again = F.col("page_id").isNull() | (F.col("page_id") < F.col("response"))
    return met.select("page_id", "url", "payload", *keys, F.when(again, F.col("response")).alias("refers_to"), F.when(again, F.col("response_url")).alias("refers_url"))


def write_archive(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES, date: datetime | None = None) -> tuple[Archive, DataFrame]:
    """Write a WARC 1.1 record for each row of ``pages`` (page_id, url, html); returns the archive and its capture keys.

    Each task writes files of gzip members, a warcinfo record first, beginning a new one after ``file_bytes``, under names of its own, so a task that
    runs again leaves no half-written file in use: the captures (key, file, offset,
    length) of the tasks that ended are checkpointed, sorted by reversed-host key over range partitions
    and stored as index files: compressed blocks of lines, then a sparse directory of
    the blocks' first keys. The list of index files with their first keys is stored beside them (``Archive.open``), and files of tasks that ran twice are removed. A key ends with the capture's number in the scan, so
    equal URLs, even a third of all rows, stay apart and in order.

    Responses hold an HTTP head and the payload, revisits the head alone and the response's id, URI and date. All records have one ``date`` (default: now),
    since pages carry none. Null html is an empty payload; null urls, and what no URI can hold, are kept in an extension field; very long pages are
    one record each. Null and repeated page_ids are records like others; rows that repeat page_id and payload have one record id. Other columns are left out.
    An empty table gives an archive without records.
    """
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    place, stamp = Archive(folder, []), (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, name, task, n_files = None, 0, "", uuid.uuid4().hex, 0
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                if out is not None and at >= file_bytes:
                    out.close()
                    out = None
                if out is None:
                    name, n_files = f"part-{task}-{n_files:05d}.warc.gz", n_files + 1
                    own, target = place.file(name)
                    out = own.open_output_stream(target, compression=None)
                    first = _file_record(name, stamp)
                    out.write(first)
                    at = len(first)
                raw = _capture_record(row, stamp)
                out.write(raw)
                made.append((f"{reversed_host_key(row['url'])} {row['capture']:020d}", name, at, len(raw)))
                at += len(raw)
            keys, names, offsets, lengths = zip(*made, strict=True) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["key", "file", "offset", "length"])
        if out is not None:
            out.close()

    rows = resolve_revisits(pages, min_revisit_bytes).withColumn("capture", F.monotonically_increasing_id())
    captures = cut(rows.mapInArrow(write, "key string, file string, offset long, length long"))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(n_parts, "key").sortWithinPartitions("key")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, name, lines, directory = None, 0, f"index-{uuid.uuid4().hex}.cdx", [], []

        def flush() -> None:
            nonlocal at, lines
            block = zlib.compress("\n".join(line for _, line in lines).encode())
            directory.append((lines[0][0], at, len(block)))
            out.write(block)
            at, lines = at + len(block), []

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    own, target = place.file(name)
                    out = own.open_output_stream(target, compression=None)
                lines.append((row["key"], json.dumps([row["key"], row["file"], row["offset"], row["length"]])))
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            tail = zlib.compress(json.dumps(directory).encode())
            out.write(tail + struct.pack("<QQ", at, len(tail)))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([name])], ["first_key", "name"])

    files = sorted(tuple(r) for r in cut(ordered.mapInArrow(index, "first_key string, name string")).collect())
    archive = Archive(folder, files)
    archive.store([r.file for r in captures.select("file").distinct().toLocalIterator()])
    return archive, captures.select("key")


class IndexReader:
    """Finds captures: binary search over index files, then over a file's block directory, then one range read of a block."""

    def __init__(self, archive: Archive):
        self.archive, self.firsts = archive, [k for k, _ in archive.index_files]
        self.blocks: OrderedDict = OrderedDict()
        self.name, self.stream, self.directory = None, None, []

    def _open(self, name: str) -> None:
        if name != self.name:
            fs, path = self.archive.file(name)
            self.stream = fs.open_input_file(path)
            size = self.stream.size()
            at, length = struct.unpack("<QQ", self.stream.read_at(16, size - 16))
            self.directory = json.loads(zlib.decompress(self.stream.read_at(length, at)))
            self.firsts_in_file, self.name = [d[0] for d in self.directory], name

    def find(self, key: str) -> tuple[str, int, int] | None:
        """(file, offset, length) of a capture key, or None."""
        i = bisect.bisect_right(self.firsts, key) - 1
        if i < 0:
            return None
        self._open(self.archive.index_files[i][1])
        j = bisect.bisect_right(self.firsts_in_file, key) - 1
        if (self.name, j) not in self.blocks:
            _, at, length = self.directory[j]
            lines = [json.loads(x) for x in zlib.decompress(self.stream.read_at(length, at)).decode().split("\n")]
            self.blocks[self.name, j] = ([x[0] for x in lines], lines)
            if len(self.blocks) > BLOCKS_KEPT:
                self.blocks.popitem(last=False)
        keys, lines = self.blocks[self.name, j]
        k = bisect.bisect_left(keys, key)
        return tuple(lines[k][1:]) if k < len(keys) and keys[k] == key else None


def read_captures(spark: SparkSession, archive: Archive, keys: DataFrame) -> DataFrame:
    """The records behind ``keys`` (key): page_id, url, record_type, payload_bytes, payload_digest, refers_to and html (null for revisits).

    Keys are sorted over range partitions, so that a task meets each index block
    once; a task holds one directory and a few blocks. Each record is a range read
    of its file. A response whose payload does not match its digest stops the job. Keys that the
    index lacks, and null keys, give no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, streams = IndexReader(archive), OrderedDict()
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                place = reader.find(key)
                if place is None:
                    continue
                name, at, length = place
                if name not in streams:
                    fs, path = archive.file(name)
                    streams[name] = fs.open_input_file(path)
                    if len(streams) > 64:
                        streams.popitem(last=False)[1].close()
                out.append(parse_capture(streams[name].read_at(length, at)))
            cols = list(zip(*out, strict=True)) or [()] * 7
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "html"])

    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.where("key is not null").select("key").repartitionByRange(n_parts, "key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, html string")
