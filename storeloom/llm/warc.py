"""WARC archives with a two-level capture index.

``write`` stores one record per page, each its own gzip member, in archives of the shared folder;
a task names its files anew, and only those of the attempt that succeeds are ever referred to. A
page whose payload of at least ``least`` bytes equals that of a larger id is a revisit without
payload.

``index`` sorts the captures by their reversed-host URL key into compressed blocks of
``BLOCK_LINES`` lines. Each index file ends with the directory of its blocks, sparse by that
factor, and one row per index file tells where that directory is. ``lookup`` finds a key by
binary search in the rows, the directory and the block, reads the record's byte range, and
follows a revisit to its response by the same way.

Nulls: a null html is an empty payload, a null url has the empty key, a null page_id sorts before
all others. Rows that repeat a page_id are captures of their own; of equal payloads all rows with
the largest id are responses. A revisit is followed to a response of the payload it states, as rows
of one id and url may differ in theirs. Other columns are not read; an empty table gives no rows. Control
characters in a URL are written as %XX.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import bound_batches, map_batches, stored
from storeloom.session import scratch_path

ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 512
# Bytes of records that a task reads back.
TASK_BYTES = 64 << 20
INDEX_FILE_ROWS = 1 << 20
KEPT = 256
NO_ID = -(1 << 63)
# Fixed value: records bear the page id in their name.
RECORD = "<urn:storeloom:page:{}>"
CAPTURE = "key string, page bigint, archive string, place bigint, size bigint"
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, " \
       "refers_to bigint"  # fmt: skip


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: http://a.b.org/x -> org,b,a)/x"""
    clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    parts = re.match(r"(?i)[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)([^#]*)", clean)
    if not parts:
        return clean
    host, _, port = parts[1].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts[2] or "/")


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    system, path = pafs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return system, path


# --- records -----------------------------------------------------------------------------------


def record(page: int | None, url: str, payload: bytes, digest: str, refers_to: tuple | None) -> bytes:
    """One gzip member. ``refers_to`` is (page, url) of the response for a revisit."""
    name = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if refers_to else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: {RECORD.format('' if page is None else page)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{name}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {RECORD.format(refers_to[0])}",
            f"WARC-Refers-To-Target-URI: {refers_to[1]}",
        ]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, 1, mtime=0)


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and HTTP payload of a record."""
    whole = gzip.decompress(data)
    head, _, rest = whole.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _page_of(name: str) -> int | None:
    number = name.rsplit(":", 1)[1].rstrip(">")
    return int(number) if number else None


# --- writing -----------------------------------------------------------------------------------


def write(pages: DataFrame, folder: str, least: int = 1000) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html) below ``folder``; gives the captures."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    read = pages.select("page_id", "url", payload.alias("payload"))
    read = read.withColumns({"digest": F.sha1("payload"), "bytes": F.length("payload")})
    large = read.where(F.col("bytes") >= least)
    # Only payloads that may be revisits are moved. The largest id of each comes with its url;
    # rebalanced, so that Spark can split a hot one.
    last = large.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("last"))
    last = last.hint("rebalance")
    revisit = (F.col("bytes") >= least) & (F.col("page_id") < F.col("last.page_id")) | (
        F.col("page_id").isNull() & F.col("last.page_id").isNotNull()
    )
    names = ("page_id", "url", "digest", "to_page", "to_url", "payload")
    rows = large.join(last, "digest", "left").select(
        "page_id", "url", "digest",
        F.when(revisit, F.col("last.page_id")).alias("to_page"),
        F.when(revisit, F.col("last.url")).alias("to_url"),
        "payload",
    )
    none = F.lit(None).cast("string")
    small = read.where(F.col("bytes") < least).withColumns({"to_page": none, "to_url": none})
    bound_batches(pages.sparkSession)

    def run(batches):
        system, path = _files(folder)
        stream, name = None, ""
        for batch in batches:
            out = {n: [] for n in ("key", "page", "archive", "place", "size")}
            for page, url, digest, to_page, to_url, body in zip(
                *(batch[c] for c in names)
            ):
                if stream is None or stream.tell() >= ARCHIVE_BYTES:
                    if stream:
                        stream.close()
                    name = f"{path}/{uuid.uuid4().hex}.warc.gz"
                    stream = system.open_output_stream(name, compression=None)
                to = None if to_page is None else (to_page, _header(to_url))
                data = record(page, _header(url), body, digest, to)
                values = (url_key(url), NO_ID if page is None else page, name, stream.tell(), len(data))
                for column, value in zip(out.values(), values):
                    column.append(value)
                stream.write(data)
            yield out
        if stream:
            stream.close()

    # Each in a job of its own: beside others, Spark would not split a payload that many pages have.
    parts = [stored(map_batches(r.select(*names), run, CAPTURE), "captures") for r in (rows, small)]
    return parts[0].union(parts[1])


def _header(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


# --- the index ---------------------------------------------------------------------------------


def index(captures: DataFrame, folder: str) -> list[tuple]:
    """Index files below ``folder``; a row (first key, first page, file, directory's place and
    size) for each, in order. Their number is that of the captures by INDEX_FILE_ROWS."""
    files = -(-captures.count() // INDEX_FILE_ROWS) or 1
    parts = max(files, int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = captures.repartitionByRange(parts, "key", "page").sortWithinPartitions("key", "page")

    def run(batches):
        lines, directory, stream, name = [], [], None, ""

        def flush():
            block = "\n".join("\t".join(map(str, line)) for line in lines).encode()
            data = zlib.compress(block)
            directory.append((lines[0][0], lines[0][1], stream.tell(), len(data)))
            stream.write(data)
            lines.clear()

        for batch in batches:
            rows = zip(*(batch[c] for c in ("key", "page", "archive", "place", "size")))
            for row in rows:
                if stream is None:
                    system, path = _files(folder)
                    name = f"{path}/{uuid.uuid4().hex}.index"
                    stream = system.open_output_stream(name, compression=None)
                lines.append(row)
                if len(lines) == BLOCK_LINES:
                    flush()
        if stream:
            if lines:
                flush()
            data = zlib.compress("\n".join("\t".join(map(str, d)) for d in directory).encode())
            yield {
                "key": [directory[0][0]], "page": [directory[0][1]], "archive": [name],
                "place": [stream.tell()], "size": [len(data)],
            }
            stream.write(data)
            stream.close()

    rows = stored(map_batches(ordered, run, CAPTURE), "index").collect()
    return sorted((r.key.encode(), r.page, r.archive, r.place, r.size) for r in rows)


class Reader:
    """Range reads by way of the index, with the last blocks and files kept open."""

    def __init__(self, folder: str, tops: list[tuple]):
        self.system, _ = pafs.FileSystem.from_uri(folder)
        self.tops = tops
        self.starts = [(t[0], t[1]) for t in tops]
        self.files: OrderedDict = OrderedDict()
        self.blocks: OrderedDict = OrderedDict()
        self.payloads: OrderedDict = OrderedDict()

    @staticmethod
    def _keep(kept: OrderedDict, key, make):
        if key in kept:
            kept.move_to_end(key)
        else:
            kept[key] = make()
            if len(kept) > KEPT:
                kept.popitem(last=False)
        return kept[key]

    def bytes_at(self, name: str, place: int, size: int) -> bytes:
        file = self._keep(self.files, name, lambda: self.system.open_input_file(name))
        file.seek(place)
        return file.read(size)

    def _lines(self, name: str, place: int, size: int) -> list[tuple]:
        def make():
            text = zlib.decompress(self.bytes_at(name, place, size)).decode()
            lines = [line.split("\t") for line in text.split("\n")]
            return [(n[0].encode(), int(n[1]), *n[2:]) for n in lines]

        return self._keep(self.blocks, (name, place), make)

    def captures(self, key: bytes, page: int) -> Iterator[tuple[str, int, int]]:
        """(archive, place, size) of all captures of a key and page."""
        wanted = (key, page)
        at = max(0, bisect_left(self.starts, wanted) - 1)
        while at < len(self.tops) and self.starts[at] <= wanted:
            name = self.tops[at][2]
            directory = self._lines(name, *self.tops[at][3:])
            starts = [d[:2] for d in directory]
            block = max(0, bisect_left(starts, wanted) - 1)
            for _, _, place, size in directory[block : bisect_right(starts, wanted)]:
                lines = self._lines(name, int(place), int(size))
                first = bisect_left(lines, wanted)
                while first < len(lines) and lines[first][:2] == wanted:
                    yield lines[first][2], int(lines[first][3]), int(lines[first][4])
                    first += 1
            at += 1

    def full_payload(self, key: bytes, page: int, stated: str) -> tuple[int, str]:
        """Size and digest of the payload of the response whose record states this digest."""

        def make():
            for capture in self.captures(key, page):
                headers, payload = parsed(self.bytes_at(*capture))
                if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] == stated:
                    return len(payload), hashlib.sha1(payload).hexdigest()
            raise KeyError(f"no response for page {page} with payload {stated}")

        return self._keep(self.payloads, (key, page, stated), make)


def lookup(wanted: DataFrame, folder: str, tops: list[tuple]) -> DataFrame:
    """All captures of the distinct (key, page) of ``wanted``, read by way of the index."""
    spark = wanted.sparkSession
    shared = spark.sparkContext.broadcast(tops)
    # The keys are small, so the number of tasks follows the records that they point to.
    size = wanted.agg(F.sum("size")).first()[0] or 0
    tasks = max(-(-size // TASK_BYTES), spark.sparkContext.defaultParallelism)
    asked = wanted.select("key", "page").distinct()
    near = asked.repartitionByRange(tasks, "key", "page").sortWithinPartitions("key", "page")

    def run(batches):
        reader = Reader(folder, shared.value)
        for batch in batches:
            out = {n: [] for n in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for key, page in zip(batch["key"], batch["page"]):
                for capture in reader.captures(key.encode(), page):
                    headers, payload = parsed(reader.bytes_at(*capture))
                    to, stated = None, headers["WARC-Payload-Digest"]
                    if headers["WARC-Type"] == "revisit":
                        to = _page_of(headers["WARC-Refers-To"])
                        to_key = url_key(headers["WARC-Refers-To-Target-URI"]).encode()
                        size, digest = reader.full_payload(to_key, to, stated)
                    else:
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    if base64.b32encode(bytes.fromhex(digest)).decode() != stated.removeprefix("sha1:"):
                        raise ValueError(f"payload of page {page} is damaged")
                    values = (_page_of(headers["WARC-Record-ID"]), size, digest, headers["WARC-Type"], to)
                    for column, value in zip(out.values(), values):
                        column.append(value)
            yield out

    return map_batches(near, run, READ)


def archived(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Writes ``pages`` to new archives, indexes them, and reads every capture back."""
    folder = scratch_path(pages.sparkSession, "warc")
    captures = write(pages, folder, least)
    return lookup(captures, folder, index(captures, folder))
