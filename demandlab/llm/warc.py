"""Web archives with a two-level capture index.

Records are written as gzip members of ``.warc.gz`` files in the shared folder.
The index has two levels: capture lines sorted by reversed-host URL key and packed
into compressed blocks, and a sparse directory with the first key of each block.
A lookup binary-searches the directory, range-reads one block, binary-searches
that, and range-reads the records. The round trip looks up the URLs of its own pages;
``read_index`` walks directory and blocks instead. No archive is ever listed or read as a whole.
Keys are escaped before they are sorted, so the order of the index is that of the keys in it.

Archive and index files are written by tasks under names of their own and become
part of the result only through a table that Spark commits: a task that is run
again leaves an unused file and nothing else. The folder may be on any storage
that ``pyarrow.fs`` opens.

Defined cases: null payload is empty; null URL has the empty key; null or repeated
page_id is allowed (all rows that repeat the smallest page_id of a payload are
responses; a null page_id is a response only if no copy has one); more columns in the
input are left out; an empty table gives an empty index and no rows.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as storage
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm.common import settle, table
from demandlab.session import scratch_path

ARCHIVE_BYTES = 64 << 20
BLOCK_LINES = 1000
LOOKUP_ROWS = 10_000
READ_BYTES = 4 << 20
TASK_BYTES = 32 << 20
WARC_DATE = "2024-01-01T00:00:00Z"
MANIFEST = ("key string, page_id long, archive string, offset long, length long, digest string, kind string")
SHARDS = "first_key string, last_key string, blocks string, directory string, n_blocks long, n_rows long"
RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long, payload string")


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.a.example/p?q=1`` becomes ``example,a)/p?q=1``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url.lower()
    if host.startswith("www."):
        host = host[4:]
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{key}){(parts.path or '/').lower()}" + (f"?{parts.query.lower()}" if parts.query else "")


def _record(page_id, url, payload: bytes, digest: str, first) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    revisit = first is not None and first != page_id
    block = http + (b"\r\n" if revisit else f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {WARC_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{first}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _pack(data: bytes, level: int = 4) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _unpack(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def _open(folder: str):
    files, path = storage.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    return files, path


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per page; the table of captures has a row per record.

    Payloads cross the network once, to meet the smallest page_id of their copies;
    those are written first, so that Spark can split the join where a payload is hot.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    firsts = settle(rows.groupBy("sha").agg(F.min("page_id").alias("first")), "warc-firsts")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        out, name, at = None, "", 0
        for batch in batches:
            made = {k: [] for k in ("key", "page_id", "archive", "offset", "length", "digest", "kind")}
            for page_id, url, html, sha, first in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html", "sha", "first")), strict=True):
                if out is None:
                    name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                packed = _pack(_record(page_id, url, html.encode(), digest, first))
                out.write(packed)
                kind = "revisit" if first is not None and first != page_id else "response"
                for k, v in zip(made, (_escape(url_key(url)), page_id, name, at, len(packed), digest, kind), strict=True):
                    made[k].append(v)
                at += len(packed)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pydict(made, schema=MANIFEST_ARROW)
        if out is not None:
            out.close()

    return settle(rows.join(firsts, "sha").mapInArrow(write, MANIFEST), "warc-captures")


MANIFEST_ARROW = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()),
                            ("offset", pa.int64()), ("length", pa.int64()), ("digest", pa.string()),
                            ("kind", pa.string())])
SHARDS_ARROW = pa.schema([("first_key", pa.string()), ("last_key", pa.string()), ("blocks", pa.string()),
                          ("directory", pa.string()), ("n_blocks", pa.int64()), ("n_rows", pa.int64())])
ASKED_ARROW = pa.schema([(n, pa.string()) for n in ("key", "blocks", "directory")])
RECORDS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                           ("refers_to", pa.int64()), ("payload", pa.string())])


def _escape(key: str) -> str:
    return key.replace("%", "%25").replace("\t", "%09").replace("\n", "%0A").replace("\r", "%0D")


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sorts captures by key into blocks of ``block_lines`` lines; a row per index shard.

    Shards are ranges of (key, archive, offset), so a host or a URL with very many
    captures is spread over shards.
    """
    ordered = captures.repartitionByRange("key", "archive", "offset").sortWithinPartitions(
        F.encode("key", "utf-8"), "archive", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base, name, blocks, at = None, "", "", None, 0
        directory: list[str] = []
        lines: list[str] = []
        first = last = None
        rows = 0

        def flush():
            nonlocal at
            packed = _pack("\n".join(lines).encode())
            blocks.write(packed)
            directory.append(f"{lines[0].split(chr(9), 1)[0]}\t{at}\t{len(packed)}")
            at += len(packed)
            lines.clear()

        for batch in batches:
            for key, page_id, archive, offset, length, digest, kind in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if blocks is None:
                    files, base = _open(folder)
                    name = f"shard-{uuid.uuid4().hex}"
                    blocks = files.open_output_stream(f"{base}/{name}.idx.gz", compression=None)
                first, last, rows = first if rows else key, key, rows + 1
                lines.append(f"{key}\t{'' if page_id is None else page_id}\t{archive}\t{offset}\t{length}\t{digest}\t{kind}")
                if len(lines) >= block_lines:
                    flush()
        if blocks is not None:
            if lines:
                flush()
            blocks.close()
            with files.open_output_stream(f"{base}/{name}.dir", compression=None) as out:
                out.write("\n".join(directory).encode())
            yield pa.RecordBatch.from_pylist([{
                "first_key": first, "last_key": last, "blocks": f"{name}.idx.gz", "directory": f"{name}.dir",
                "n_blocks": len(directory), "n_rows": rows}], schema=SHARDS_ARROW)

    return settle(ordered.mapInArrow(write, SHARDS), "warc-shards")


def _directory(files, path: str) -> list[tuple[str, int, int]]:
    with files.open_input_file(path) as data:
        lines = data.read().decode().split("\n")
    return [(k, int(o), int(n)) for k, o, n in (line.split("\t") for line in lines)]


def _block(data, offset: int, length: int) -> list[list[str]]:
    data.seek(offset)
    return [line.split("\t") for line in _unpack(data.read(length)).decode().split("\n")]


def _capture_rows(found: list[list[str]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [()] * 7
    return pa.RecordBatch.from_pydict({
        "key": list(columns[0]), "page_id": [int(x) if x else None for x in columns[1]], "archive": list(columns[2]),
        "offset": [int(x) for x in columns[3]], "length": [int(x) for x in columns[4]],
        "digest": list(columns[5]), "kind": list(columns[6])}, schema=MANIFEST_ARROW)


def read_index(shards: DataFrame, folder: str) -> DataFrame:
    """Every capture, block by block along the directories."""
    blocks = shards.select("blocks", "directory")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = storage.FileSystem.from_uri(folder)
        for batch in batches:
            for name, directory in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with files.open_input_file(f"{base}/{name}") as data:
                    for _, offset, length in _directory(files, f"{base}/{directory}"):
                        yield _capture_rows(_block(data, offset, length))

    return blocks.mapInArrow(read, MANIFEST)


class _Shard:
    """One index shard: its directory is binary-searched, then a block, of which the last one stays unpacked."""

    def __init__(self, files, base: str, blocks: str, directory: str):
        self.data = files.open_input_file(f"{base}/{blocks}")
        self.directory = _directory(files, f"{base}/{directory}")
        self.firsts = [first.encode() for first, _, _ in self.directory]
        self.held: tuple[int, list, list] = (-1, [], [])

    def block(self, at: int) -> tuple[list, list]:
        if self.held[0] != at:
            lines = _block(self.data, *self.directory[at][1:])
            self.held = at, lines, [line[0].encode() for line in lines]
        return self.held[1:]

    def find(self, key: bytes) -> Iterator[list]:
        """The capture lines of a key, which may go on over many blocks."""
        at = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while at < len(self.firsts) and self.firsts[at] <= key:
            lines, keys = self.block(at)
            yield from lines[bisect.bisect_left(keys, key):bisect.bisect_right(keys, key)]
            at += 1


def lookup(urls: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """Captures of the given ``url`` values, each capture once however often its URL or another of its key is asked for.

    A key is binary-searched among the shards' bounds, then in the directory of each shard that can hold it and in
    the blocks there. Keys meet a shard in order, so a block is read once. Equal URLs are merged before they move.
    """
    # One row per index shard: as many at most as build_index had shuffle partitions.
    bounds = sorted((r.first_key.encode(), r.last_key.encode(), r.blocks, r.directory) for r in shards.select(
        "first_key", "last_key", "blocks", "directory").collect())
    lasts = [last for _, last, _, _ in bounds]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = []
            for key in {_escape(url_key(url)) for url in batch.column(0).to_pylist()}:
                name = key.encode()
                at = bisect.bisect_left(lasts, name)
                while at < len(bounds) and bounds[at][0] <= name:
                    asked.append({"key": key, "blocks": bounds[at][2], "directory": bounds[at][3]})
                    at += 1
            yield pa.RecordBatch.from_pylist(asked, schema=ASKED_ARROW)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = storage.FileSystem.from_uri(folder)
        shard, name, before, found = None, "", None, []
        for batch in batches:
            for key, blocks, directory in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if blocks != name:
                    shard, name, before = _Shard(files, base, blocks, directory), blocks, None
                if key == before:
                    continue
                before = key
                for line in shard.find(key.encode()):
                    found.append(line)
                    if len(found) >= LOOKUP_ROWS:
                        yield _capture_rows(found)
                        found = []
        if found:
            yield _capture_rows(found)

    asked = urls.select(F.col("url").cast("string")).distinct().mapInArrow(place, "key string, blocks string, directory string")
    return asked.repartition("blocks").sortWithinPartitions("blocks", "key").mapInArrow(read, MANIFEST)


def _parse(data: bytes) -> dict:
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    _, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
    refers = fields.get("WARC-Refers-To", "").removeprefix("<urn:page:").removesuffix(">")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"record of page {page} is damaged: its payload does not have the digest it names")
    return {"page_id": int(page) if page else None, "url": fields.get("WARC-Target-URI"),
            "record_type": fields["WARC-Type"], "payload_bytes": None if revisit else len(payload),
            "payload_digest": digest, "refers_to": int(refers) if refers else None,
            "payload": None if revisit else payload.decode()}


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """The records of ``captures``: neighbouring ranges of an archive are read at once.

    Rows that name a range are small, so tasks are numbered by the bytes that they will read.
    """
    total = captures.agg(F.sum("length")).first()[0] or 0
    placed = captures.select("archive", "offset", "length").repartition(
        int(total // TASK_BYTES) + 1, "archive", F.floor(F.col("offset") / (2 * READ_BYTES))).sortWithinPartitions(
        "archive", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = storage.FileSystem.from_uri(folder)
        for batch in batches:
            spans = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            at = 0
            while at < len(spans):
                archive, low, length = spans[at]
                end, high = at + 1, low + length
                while end < len(spans) and spans[end][0] == archive and spans[end][1] <= high \
                        and spans[end][1] + spans[end][2] - low <= READ_BYTES:
                    high = max(high, spans[end][1] + spans[end][2])
                    end += 1
                with files.open_input_file(f"{base}/{archive}") as data:
                    data.seek(low)
                    piece = data.read(high - low)
                yield pa.RecordBatch.from_pylist(
                    [_parse(_unpack(piece[o - low:o - low + n])) for _, o, n in spans[at:end]], schema=RECORDS_ARROW)
                at = end

    return placed.mapInArrow(read, RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """Gives revisits the payload size of the response that they refer to."""
    sizes = settle(records.where("record_type = 'response' AND page_id IS NOT NULL").groupBy(
        F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("full_bytes")),
        "warc-sizes")
    return records.join(sizes, ["refers_to", "payload_digest"], "left").withColumn(
        "payload_bytes", F.coalesce("payload_bytes", "full_bytes")).drop("full_bytes")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes and indexes ``pages``, looks their URLs up and reads the records found; a row per record."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    captures = write_archives(pages, f"{folder}/archives")
    shards = build_index(captures, f"{folder}/index")
    found = lookup(pages.select("url"), shards, f"{folder}/index")
    read = read_records(settle(found, "warc-found"), f"{folder}/archives").drop("payload")
    return resolve(settle(read, "warc-records"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
    ((CAST('0x' || substr(h, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT)
      // CAST(power(32, 3 - i % 4) AS BIGINT)) % 32) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN NULL ELSE first END AS refers_to
FROM f
"""
