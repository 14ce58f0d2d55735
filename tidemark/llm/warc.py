"""WARC archives with a two-level capture index.

Every task writes one archive, a gzip member per record, to the shared folder
and reports where each record lies. The records' keys - host labels reversed,
then path and query - are sorted by range into index shards of compressed blocks
of ``BLOCK`` lines; a sparse directory holds the first key and the byte range of
every block. A look-up binary-searches the directory, reads one block by range,
binary-searches its lines and reads one record by range.

Of equal payloads (from ``least`` bytes on) the smallest page_id is written as a
response and the others as revisits of it. Files of failed attempts are never
referred to, as only the committed tables name files.

Edge cases: null html is an empty payload; a null or odd url is archived under
``urn:page:<id>`` or its escaped form; rows that share the smallest page_id of a
payload are all responses; of rows that share a page_id each is judged by its own
payload, and rows that share url and page_id are each read back; a null page_id is archived as a response of its own; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from functools import lru_cache
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, shared_dir

BLOCK = 3000
SHARD_ROWS, READ_ROWS = 500_000, 20_000  # of an index shard; read back by a task
BROADCAST_ROWS = 500_000
DIRECTORY_ROWS = 500_000  # directory rows that are sent to the tasks at once
DATE = "2024-01-01T00:00:00Z"
_LINE_END = "\r\n"


def filesystem(url: str):
    """File system and path of a folder; also for folders not on local disks."""
    return pafs.FileSystem.from_uri(url if re.match(r"\w+:/", url) else f"file://{url}")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean_url(url: str | None, page_id) -> str:
    return quote(url, safe="".join(map(chr, range(33, 127)))) if url else f"urn:page:{page_id}"


def key_of(url: str) -> str:
    """Sort key: reversed host labels, port unless the default, path, query."""
    m = re.match(r"([a-zA-Z][a-zA-Z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^#]*)", url)
    if not m:
        return url
    scheme, host, port, rest = m.groups()
    port = "" if port in (None, "", {"http": "80", "https": "443"}.get(scheme.lower())) else f":{port}"
    return ",".join(reversed(host.lower().split("."))) + port + ")" + (rest if rest.startswith("/") else "/" + rest)


def record(page_id, url: str, payload: bytes, own_digest: str, refers_to) -> bytes:
    """One uncompressed record; a revisit keeps the HTTP head only."""
    http = f"HTTP/1.1 200 OK{_LINE_END}Content-Type: text/html; charset=utf-8{_LINE_END}Content-Length: {len(payload)}{_LINE_END * 2}".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{own_digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return _LINE_END.join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP head and payload of a record; raises on a damaged one."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split(_LINE_END)
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record of a wrong length")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def _archive(folder: str):
    def run(batches):
        fs, root = filesystem(folder)
        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
        at, out = 0, None
        for b in batches:
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            keys, ids, offs, sizes = [], [], [], []
            for i, u, t, ref in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                payload = (t.as_py() or "").encode()
                url = clean_url(u, i)
                z = zlib.compressobj(4, zlib.DEFLATED, 31)
                raw = z.compress(record(i, url, payload, digest(payload), ref)) + z.flush()
                out.write(raw)
                keys.append(key_of(url))
                ids.append(i)
                offs.append(at)
                sizes.append(len(raw))
                at += len(raw)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ids, pa.int64()), pa.array([name] * len(ids), pa.string()), pa.array(offs, pa.int64()), pa.array(sizes, pa.int64())], ["key", "page_id", "file", "off", "size"])
        if out is not None:
            out.close()

    return run


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Writes a record per row and returns key, page_id, file, off, size."""
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.when(F.octet_length(body) >= least, F.sha1(body.cast("binary"))).alias("digest"))
    seen = saved(rows.where("digest IS NOT NULL AND page_id IS NOT NULL").select("page_id", "digest"), "digests")
    firsts = seen.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("most")).where("first < most")
    again = saved(seen.join(firsts, "digest").where("page_id > first").select("page_id", "digest", F.col("first").alias("refers_to")).distinct(), "revisits")
    few = again.count() <= BROADCAST_ROWS
    told = rows.join(F.broadcast(again) if few else again, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
    return saved(told.mapInArrow(_archive(folder), "key string, page_id long, file string, off long, size long"), "records")


def _shards(folder: str, block: int):
    def run(batches):
        fs, root = filesystem(folder)
        ctx = TaskContext.get()
        name = f"index-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}.gz"
        out, at, lines, rows = None, 0, [], []

        def flush():
            nonlocal out, at, lines
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            raw = gzip.compress("\n".join("\t".join(x) for x in lines).encode(), 6, mtime=0)
            out.write(raw)
            rows.append((lines[0][0], lines[0][1], name, at, len(raw), len(lines)))
            at, lines = at + len(raw), []

        for b in batches:
            for k, i, f, o, s in zip(*(c.to_pylist() for c in b.columns)):
                lines.append((k, sort_id(i), f, str(o), str(s)))
                if len(lines) == block:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
        cols = list(zip(*rows)) if rows else [[]] * 6
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["key", "id", "file", "off", "size", "n"])

    return run


def sort_id(i) -> str:
    """Text of an id that sorts as the id does; null first."""
    return "" if i is None else f"{i + (1 << 63):020d}"


def _parts(spark, rows: int, each: int) -> int:
    """Tasks for so many rows; a number that is named is not made smaller."""
    return max(-(-rows // each), min(rows, 2 * spark.sparkContext.defaultParallelism), 1)


def write_index(records: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Sorts the records' keys into shards of compressed blocks; returns the
    directory: first key and id of each block, its file and byte range."""
    # Binary order of key and id; equal keys spread over several shards.
    keyed = records.select("key", "page_id", "file", "off", "size")
    ordered = keyed.repartitionByRange(_parts(keyed.sparkSession, records.count(), SHARD_ROWS), "key", "page_id").sortWithinPartitions("key", F.col("page_id").asc_nulls_first(), "file", "off")
    return saved(ordered.mapInArrow(_shards(folder, block), "key string, id string, file string, off long, size long, n long"), "directory")


class Reader:
    """Range reads of blocks and records, with the last ones kept."""

    def __init__(self, folder: str, directory: list[tuple]):
        self.fs, self.root = filesystem(folder)
        self.directory = sorted(directory)
        self.firsts = [(r[0].encode(), r[1]) for r in self.directory]
        self.block = lru_cache(4)(self._block)
        self.open = lru_cache(64)(lambda f: self.fs.open_input_file(f"{self.root}/{f}"))

    def bytes(self, file: str, off: int, size: int) -> bytes:
        return self.open(file).read_at(size, off)

    def _block(self, k: int):
        _, _, file, off, size, _ = self.directory[k]
        lines = [x.split("\t") for x in gzip.decompress(self.bytes(file, off, size)).decode().split("\n")]
        return [(x[0].encode(), x[1]) for x in lines], lines

    def find(self, key: str, ident: str) -> list[tuple[str, int, int]]:
        """Places of the records of a key and id: binary search in the directory,
        then in the block; runs that go on in the next block are followed."""
        want = (key.encode(), ident)
        k = max(bisect_left(self.firsts, want) - 1, 0)
        out = []
        while k < len(self.firsts) and self.firsts[k] <= want:
            keys, lines = self.block(k)
            for x in lines[bisect_left(keys, want) : bisect_right(keys, want)]:
                out.append((x[2], int(x[3]), int(x[4])))
            k += 1
        return out

    def record(self, file: str, off: int, size: int):
        return parse(gzip.decompress(self.bytes(file, off, size)))


def _captures(folder: str, directory):
    def run(batches):
        reader = Reader(folder, directory.value)
        for b in batches:
            rows = []
            for i, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for place in reader.find(key_of(clean_url(u, i)), sort_id(i)):
                    fields, http, payload = reader.record(*place)
                    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                    kind = fields["WARC-Type"]
                    if kind == "response" and (len(payload) != size or digest(payload) != told):
                        raise ValueError(f"record of page {i} is damaged")
                    ref = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get("WARC-Refers-To", ""))
                    rows.append((i, size, told, kind, int(ref[1]) if ref else None))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return run


def read_captures(pages: DataFrame, folder: str, directory: DataFrame) -> DataFrame:
    """Looks every (page_id, url) up in the index and reads its records. The
    directory is read in parts of at most DIRECTORY_ROWS rows, one pass each."""
    spark = pages.sparkSession
    wanted = pages.select(F.col("page_id").cast("long").alias("page_id"), "url").distinct()
    n, records = directory.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = _parts(spark, records, READ_ROWS)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    out = None
    for k in range(max(1, -(-n // DIRECTORY_ROWS))):
        parts = max(1, -(-n // DIRECTORY_ROWS))
        own = directory if parts == 1 else directory.where(F.pmod(F.xxhash64("file"), F.lit(parts)) == k)
        sent = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])
        # Sorted queries meet each block once.
        near = wanted.repartitionByRange(tasks, F.substring_index(F.regexp_replace("url", r"^\w+://", ""), "/", 1), "url", "page_id").sortWithinPartitions("url", "page_id")
        found = near.mapInArrow(_captures(folder, sent), schema)
        out = found if out is None else out.unionByName(found)
    return out


def capture(pages: DataFrame, least: int = 0, block: int = BLOCK) -> DataFrame:
    """Archives pages, indexes them and reads every capture back."""
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    records = write_archives(pages, folder, least)
    return read_captures(pages, folder, write_index(records, folder, block))
