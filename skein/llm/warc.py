"""WARC archives with a two-level capture index.

Writing. Pages are range-partitioned and sorted by their reversed-host URL key
(``org,example,www)/path?query``) and page id. A task writes one archive of
gzip-per-record WARC/1.1 records and, beside it, that archive's capture index:
the sorted entries in compressed blocks of ``BLOCK_LINES``, then a sparse
directory with the first key and place of every block. Files have names no other
attempt uses, and only the manifest rows of successful attempts are committed.

Payloads. Of records with equal payloads of at least ``min_revisit`` bytes the
one with the largest page id is the response; the others are revisits that name
it and hold its headers only.

Reading. A key is looked up by binary search for its archive (one row of the
manifest per archive, the upper level), then for its block in that archive's
directory, and then in the block; the records found are range reads, joined where
they lie close together. Looked-up keys are sorted first, so blocks and archives
are read in order.

Scale. A URL that many pages share is split by page id; a payload that many
pages share is found by a pre-aggregated maximum, and joined back as a plain table
that Spark can broadcast if it is small and whose hot keys it can split if not.
Of the directory, only one row per archive reaches every task.

Defined results: a null html is an empty payload; a null url has the empty key;
null page ids sort first and are never referred to while an id is there; rows
that tie for the largest id are all responses; repeated rows are separate
records; an empty table makes no archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import (materialize, new_file, open_input, open_output, pick, read_table,
                              to_batch)
from skein.llm.url_filter import host_and_path
from skein.session import scratch_path

MIN_REVISIT = 1000
BLOCK_LINES = 300
DIRECTORY = struct.Struct("<QQ8s")      # the directory's place, size, magic
MAGIC = b"SKCDX001"
READ_GAP, READ_MOST = 64 << 10, 4 << 20   # records this close are one range read
DATE = "2024-01-01T00:00:00Z"           # pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url):
    """Reversed host, then ``)`` and the rest of the URL; empty for a null url."""
    host, _ = host_and_path(url)
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + 3 + F.length(host), F.length(url))).otherwise(url)
    back = F.concat_ws(",", F.reverse(F.split(host, r"\.")))
    return F.coalesce(F.concat(F.when(host != "", F.concat(back, F.lit(")"))).otherwise(""), rest),
                      F.lit(""))


# ---- records -----------------------------------------------------------------

def _line(value: str) -> bytes:
    return value.replace("\r", "%0D").replace("\n", "%0A").encode()


def record(page_id: int | None, url: str | None, size: int, digest: str, payload: bytes | None,
           refers_to: int | None, refers_url: str | None) -> bytes:
    """One compressed record; a null payload makes a revisit."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % size)
    block = http + (payload or b"")
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if payload is None else b"response"),
            b"WARC-Record-ID: <urn:page:%s>" % str(page_id).encode(),
            b"WARC-Date: " + DATE.encode(), b"WARC-Target-URI: " + _line(url or ""),
            b"WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest))]
    if payload is None:
        head += [b"WARC-Profile: " + PROFILE.encode(),
                 b"WARC-Refers-To: <urn:page:%d>" % refers_to,
                 b"WARC-Refers-To-Target-URI: " + _line(refers_url or ""),
                 b"WARC-Refers-To-Date: " + DATE.encode()]
    head += [b"Content-Type: application/http; msgtype=response",
             b"Content-Length: %d" % len(block)]
    raw = b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse(raw: bytes) -> dict:
    """Headers (lower-case names), http headers and payload of one compressed record."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(b": ", 1) for x in lines[1:])
    fields = {k.decode().lower(): v.decode() for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields | {"http": http, "payload": payload}


def facts(raw: bytes) -> tuple:
    """(page_id, payload bytes, digest, type, refers_to) as a record says; the
    payload of a response is checked against its digest."""
    import hashlib
    r = parse(raw)

    def urn(value):
        name = value.removeprefix("<urn:page:").removesuffix(">")
        return None if name == "None" else int(name)

    digest = base64.b32decode(r["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(next(x for x in r["http"].split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    if r["warc-type"] == "response":
        if len(r["payload"]) != size or hashlib.sha1(r["payload"]).hexdigest() != digest:
            raise ValueError(f"{r['warc-record-id']}: the payload does not match its digest")
        refers = None
    else:
        refers = urn(r["warc-refers-to"])
    return urn(r["warc-record-id"]), size, digest, r["warc-type"], refers


# ---- writing -----------------------------------------------------------------

class Archive:
    """One archive and its capture index, written in key order."""

    def __init__(self, folder: str, shard: int):
        self.path = new_file(folder, f"pages-{shard:06d}", ".warc.gz")
        self.index_path = self.path.removesuffix(".warc.gz") + ".cdx"
        self.out, self.index = open_output(self.path), open_output(self.index_path)
        self.at = self.index_at = self.records = 0
        self.first = None
        self.lines: list[tuple] = []
        self.directory: list[tuple] = []

    def add(self, key: str, page_id: int | None, raw: bytes) -> None:
        if self.first is None:
            self.first = (key, page_id)
        self.lines.append((key, page_id, self.at, len(raw)))
        self.out.write(raw)
        self.at += len(raw)
        self.records += 1
        if len(self.lines) == BLOCK_LINES:
            self._flush()

    def _flush(self) -> None:
        block = zlib.compress("\n".join(map(json.dumps, self.lines)).encode())
        self.directory.append((*self.lines[0][:2], self.index_at, len(block)))
        self.index.write(block)
        self.index_at += len(block)
        self.lines = []

    def close(self) -> None:
        if self.lines:
            self._flush()
        top = zlib.compress(json.dumps(self.directory).encode())
        self.index.write(top + DIRECTORY.pack(self.index_at, len(top), MAGIC))
        self.out.close()
        self.index.close()


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write all pages; returns the manifest, one row per archive in key order."""
    folder = scratch_path(pages.sparkSession, "warc")
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col)
    rows = rows.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("size"),
                       F.sha1(F.col("html").cast("binary")).alias("digest"))
    last = materialize(
        rows.where(F.col("size") >= min_revisit).groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("last"))
        .where("n > 1 AND last.page_id IS NOT NULL")
        .select(F.col("digest").alias("l_digest"), F.col("last.page_id").alias("last_id"),
                F.col("last.url").alias("last_url")), "shared-payloads")
    revisit = F.coalesce(F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id")),
                         F.lit(False))
    told = (rows.join(last, F.col("digest") == F.col("l_digest"), "left")
            .select(url_key(F.col("url")).alias("key"), "page_id", "url", "size", "digest",
                    F.when(~revisit, F.col("html")).alias("html"),
                    F.when(revisit, F.col("last_id")).alias("refers_to"),
                    F.when(revisit, F.col("last_url")).alias("refers_url")))
    order = ["key", "page_id"]
    ordered = told.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("index_path", pa.string()),
                        ("first_key", pa.string()), ("first_id", pa.int64()),
                        ("records", pa.int64()), ("n_bytes", pa.int64())])

    def write(batches):
        archive, shard = None, TaskContext.get().partitionId()
        for b in batches:
            for key, page_id, url, size, digest, html, refers_to, refers_url in zip(
                    *[c.to_pylist() if b.schema.names[i] != "html" else c
                      for i, c in enumerate(b.columns)]):
                archive = archive or Archive(folder, shard)
                payload = html.as_py()
                archive.add(key, page_id, record(
                    page_id, url, size, digest, payload if payload is None else payload.encode(),
                    refers_to, refers_url))
        if archive:
            archive.close()
            yield to_batch(schema, [[shard], [archive.path], [archive.index_path],
                                    [archive.first[0]], [archive.first[1]], [archive.records],
                                    [archive.at]])

    return materialize(ordered.mapInArrow(
        write, "shard int, path string, index_path string, first_key string, first_id long, "
               "records long, n_bytes long"), "warc-manifest")


# ---- reading -----------------------------------------------------------------

def _order(key: str, page_id: int | None) -> tuple:
    return key.encode(), page_id is not None, page_id or 0


class CaptureIndex:
    """Looks up captures over all archives; keeps the last archive and block open."""

    def __init__(self, archives: list[tuple[str, str, str, int | None]]):
        """``archives``: (path, index path, first key, first id) in key order."""
        self.archives = archives
        self.firsts = [_order(*a[2:]) for a in archives]
        self.shard = self.block_no = None

    def _open(self, shard: int) -> None:
        if shard == self.shard:
            return
        self.file = open_input(self.archives[shard][1])
        size = self.file.size()
        at, n, magic = DIRECTORY.unpack(self.file.read_at(DIRECTORY.size, size - DIRECTORY.size))
        if magic != MAGIC:
            raise ValueError(f"{self.archives[shard][1]} is not a capture index")
        self.directory = json.loads(zlib.decompress(self.file.read_at(n, at)))
        self.block_firsts = [_order(*d[:2]) for d in self.directory]
        self.warc = open_input(self.archives[shard][0])
        self.shard, self.block_no = shard, None

    def _block(self, number: int) -> None:
        if number != self.block_no:
            _, _, at, n = self.directory[number]
            text = zlib.decompress(self.file.read_at(n, at)).decode()
            self.entries = [json.loads(x) for x in text.split("\n")]
            self.keys = [_order(*e[:2]) for e in self.entries]
            self.block_no = number

    def find(self, key: str, page_id: int | None) -> Iterator[tuple[int, int, int]]:
        """(archive, offset, length) of every capture of the key by that page."""
        wanted = _order(key, page_id)
        shard = bisect.bisect_right(self.firsts, wanted) - 1
        if shard < 0:
            return
        self._open(shard)
        number = max(0, bisect.bisect_left(self.block_firsts, wanted) - 1)
        while number < len(self.directory):
            self._block(number)
            at = bisect.bisect_left(self.keys, wanted)
            while at < len(self.keys) and self.keys[at] == wanted:
                yield shard, *self.entries[at][2:]
                at += 1
            if at < len(self.keys):
                return
            number += 1

    def read(self, places: list[tuple[int, int, int]]) -> Iterator[bytes]:
        """The compressed records, by range reads over places in reading order."""
        lo = 0
        while lo < len(places):
            shard, start, n = places[lo]
            hi, end = lo + 1, start + n
            while (hi < len(places) and places[hi][0] == shard and end <= places[hi][1] <= end + READ_GAP
                   and places[hi][1] + places[hi][2] - start <= READ_MOST):
                end = places[hi][1] + places[hi][2]
                hi += 1
            self._open(shard)
            raw = self.warc.read_at(end - start, start)
            for _, at, size in places[lo:hi]:
                yield raw[at - start:at - start + size]
            lo = hi


def look_up(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """Read back the captures of ``wanted`` (page_id, url): page_id,
    payload_bytes, payload_digest, record_type, refers_to of each record found.
    A pair that is asked for more than once is looked up once."""
    archives = [(r["path"], r["index_path"], r["first_key"], r["first_id"])
                for r in manifest.orderBy("shard").collect()]     # one row per archive
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64())])

    def read(batches):
        index, last = CaptureIndex(archives), None
        for b in batches:
            asked = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            for lo in range(0, len(asked), 1000):
                places = []
                for q in asked[lo:lo + 1000]:
                    if q != last:
                        places += index.find(*q)
                    last = q
                found = [facts(raw) for raw in index.read(places)]
                if found:
                    yield to_batch(schema, zip(*found))

    keys = wanted.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("long"))
    return (keys.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
            .mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, "
                              "record_type string, refers_to long"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page and read every capture back through the index."""
    pages = read_table(spark, sf_dir, "pages")
    return look_up(write_archives(pages), pick(pages, page_id="page_id", url="url"))


OP4_SQL = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS digest
  FROM pages),
lasts AS (
  SELECT digest, max(page_id) AS last_id FROM digests WHERE size >= 1000 GROUP BY digest)
SELECT page_id, size AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last_id THEN last_id END AS refers_to
FROM digests d LEFT JOIN lasts l ON d.digest = l.digest AND size >= 1000
"""
