"""Token-ID output: Simple-8b word-aligned files of the ids of whole documents.

Coding. Ids are cut into blocks of ``BLOCK`` ids. A block is a run of 64-bit
little-endian words; the upper four bits of a word select how many ids of how
many bits the lower sixty hold (60x1 ... 1x60). Selector 0 is an escape: the
following word holds one id as it is (ids of more than 60 bits). The last word
of a block may hold more places than the block has ids left.

File. ``magic, words of all blocks, directory, footer``. The directory has the
word offset of every block and, per document, its id, whether the id is null,
and where its token ids start. The footer says where the sections are, so a
reader needs the file's end and then only the blocks it wants.

Spark. Documents are range-partitioned and sorted by id (null ids first, ties by
text hash); each task encodes its documents and writes one file under a name no
other attempt uses, and returns the file's row of the manifest. Only rows of
successful attempts are committed, so retries and lost executors leave orphans
at worst, never wrong files. Files are read back one per task, a bounded number
of blocks at a time.

Defined results: null and empty texts are documents with the end id alone; a
null doc_id is kept and sorts first; repeated rows are separate documents; an
empty table makes no files and no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import (materialize, new_file, open_input, open_output, pick, read_table,
                              slices, to_batch)
from skein.llm.tokens import IDS, TEXT_BYTES, encoder
from skein.session import scratch_path

BLOCK = 256                 # ids per block
CHUNK = 4096                # blocks encoded or decoded together
MAGIC = b"SKS8B001"
FOOTER = struct.Struct("<QQQQQ8s")   # ids, blocks, documents, words, directory's offset, magic

# Selector s (1..14) packs COUNT[s] values of WIDTH[s] bits; 0 is the escape.
COUNT = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTH = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
_PAD = 60


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of ``ids``, and the number of words of each block."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    width = BLOCK + _PAD
    values = np.zeros((blocks, width), dtype=np.uint64)
    flat = np.zeros(blocks * BLOCK, dtype=np.uint64)
    flat[:n] = ids
    values[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    # a float's exponent can only round the width up, which is still right
    bits = np.maximum(np.frexp(values.astype(np.float64))[1], 1).astype(np.uint8)
    choice = np.where(bits[:, :BLOCK] <= 60, 14, 0).astype(np.uint8)
    most, reach = bits, 1
    for s in range(13, 0, -1):              # ever more ids of ever fewer bits
        while reach < COUNT[s]:
            most = np.maximum(most[:, :-1], bits[:, reach:])
            reach += 1
        fits = most[:, :BLOCK] <= WIDTH[s]
        if not fits.any():
            break
        choice[fits[:, :BLOCK]] = s
    # all blocks take their next word in step
    left = np.full(blocks, BLOCK, dtype=np.int64)
    if blocks:
        left[-1] = n - (blocks - 1) * BLOCK
    row = np.arange(blocks)
    pos, slot = np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)
    rows, places, picks, slots = [], [], [], []
    while len(row):
        p = pos[row]
        s = choice[row, p]
        rows.append(row), places.append(p), picks.append(s), slots.append(slot[row])
        pos[row] = p + COUNT[s]
        slot[row] += 1 + (s == 0)
        row = row[pos[row] < left[row]]
    words = np.zeros(int(slot.sum()), dtype="<u8")
    if not blocks:
        return words, slot
    rows, places = np.concatenate(rows), np.concatenate(places)
    picks, slots = np.concatenate(picks), np.concatenate(slots)
    at = (np.cumsum(slot) - slot)[rows] + slots
    source = rows * width + places
    values = values.reshape(-1)
    for s in np.unique(picks):
        mine = picks == s
        src, dst = source[mine], at[mine]
        if s == 0:
            words[dst + 1] = values[src]
            continue
        word = np.full(len(src), int(s) << 60, dtype=np.uint64)
        for k in range(COUNT[s]):
            word |= values[src + k] << np.uint64(k * WIDTH[s])
        words[dst] = word
    return words, slot


def unpack(words: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ids of blocks whose words end at ``ends`` and which hold ``sizes`` ids."""
    words = words.astype(np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    for i in np.flatnonzero(selector == 0):     # the word after an escape is no selector
        if not raw[i] and i + 1 < len(words):
            raw[i + 1] = True
    coded = ~raw
    count = np.where(coded, COUNT[np.minimum(selector, 14)], 0)
    sums = np.concatenate([[0], np.cumsum(count)])
    starts = np.concatenate([[0], ends[:-1]])
    over = sums[ends] - sums[starts] - sizes    # empty places of a block's last word
    last = ends - 1
    last = np.where(raw[last], last - 1, last)
    count[last] -= over
    total = int(count.sum())
    within = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(np.arange(len(words)), count)
    s = selector[at]
    out = words[at] >> (within * np.where(s, WIDTH[np.minimum(s, 14)], 0)).astype(np.uint64)
    out &= (np.uint64(1) << np.minimum(WIDTH[np.minimum(s, 14)], 60).astype(np.uint64)) - np.uint64(1)
    escaped = s == 0
    if escaped.any():
        out[escaped] = words[at[escaped] + 1]
    return out


class Writer:
    """Streams documents into one file."""

    def __init__(self, uri: str):
        self.out = open_output(uri)
        self.out.write(MAGIC)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_words = 0
        self.block_words: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.doc_starts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.doc_starts.append(self.n_ids)
        self.held.append(ids)
        self.n_ids += len(ids)
        self.n_held += len(ids)
        if self.n_held >= CHUNK * BLOCK:
            self._flush(self.n_held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, IDS)
        for lo in range(0, n, CHUNK * BLOCK):
            words, counts = pack(ids[lo:min(n, lo + CHUNK * BLOCK)])
            self.out.write(words.tobytes())
            self.block_words.append(counts)
            self.n_words += len(words)
        self.held = [ids[n:]]
        self.n_held = len(ids) - n

    def close(self) -> int:
        self._flush(self.n_held)
        counts = np.concatenate(self.block_words) if self.block_words else np.zeros(0, np.int64)
        at = len(MAGIC) + 8 * self.n_words
        known = np.array([d is not None for d in self.doc_ids], dtype="u1")
        ids = np.array([d or 0 for d in self.doc_ids], dtype="<i8")
        for part in (np.cumsum(counts).astype("<u8"), ids, known,
                     np.array(self.doc_starts, dtype="<u8")):
            self.out.write(part.tobytes())
        self.out.write(FOOTER.pack(self.n_ids, len(counts), len(ids), self.n_words, at, MAGIC))
        size = self.out.tell()
        self.out.close()
        return size


class Reader:
    """The documents of one file; blocks are read a bounded number at a time."""

    def __init__(self, uri: str):
        self.file = open_input(uri)
        size = self.file.size()
        foot = self.file.read_at(FOOTER.size, size - FOOTER.size)
        self.n_ids, blocks, docs, self.n_words, at, magic = FOOTER.unpack(foot)
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        raw = self.file.read_at(size - FOOTER.size - at, at)
        self.ends = np.frombuffer(raw, "<u8", blocks).astype(np.int64)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 8 * blocks)
        self.known = np.frombuffer(raw, "u1", docs, 8 * (blocks + docs)).astype(bool)
        self.starts = np.append(np.frombuffer(raw, "<u8", docs, 8 * (blocks + docs) + docs)
                                .astype(np.int64), self.n_ids)

    def blocks(self, lo: int, hi: int) -> np.ndarray:
        """Ids of the blocks lo..hi, by one range read."""
        first = int(self.ends[lo - 1]) if lo else 0
        n = int(self.ends[hi - 1]) - first
        words = np.frombuffer(self.file.read_at(8 * n, len(MAGIC) + 8 * first), "<u8")
        sizes = np.full(hi - lo, BLOCK, dtype=np.int64)
        if hi == len(self.ends):
            sizes[-1] = self.n_ids - (hi - 1) * BLOCK
        return unpack(words, self.ends[lo:hi] - first, sizes).astype(IDS)

    def chunks(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place of the first id, ids), in order."""
        for lo in range(0, len(self.ends), CHUNK):
            yield lo * BLOCK, self.blocks(lo, min(lo + CHUNK, len(self.ends)))

    def document(self, i: int) -> np.ndarray:
        """The ids of one document, from its own blocks alone."""
        a, b = int(self.starts[i]), int(self.starts[i + 1])
        if a == b:
            return np.zeros(0, IDS)
        lo = a // BLOCK
        return self.blocks(lo, -(-b // BLOCK))[a - lo * BLOCK:b - lo * BLOCK]

    def checksums(self) -> np.ndarray:
        """crc32 of every document's ids as little-endian 32-bit integers."""
        out = np.zeros(len(self.doc_ids), dtype=np.int64)
        d = 0
        for at, ids in self.chunks():
            raw, end = memoryview(ids.tobytes()), at + len(ids)
            while d < len(out):
                a, b = max(int(self.starts[d]), at), min(int(self.starts[d + 1]), end)
                out[d] = zlib.crc32(raw[4 * (a - at):4 * max(a - at, b - at)], int(out[d]))
                if self.starts[d + 1] > end:
                    break
                d += 1
        return out


MANIFEST = "shard int, path string, n_docs long, n_ids long, n_bytes long"


def write_token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the ids of all documents in ascending id order; returns the
    manifest, one row per file. ``shard`` numbers the files in id order."""
    folder = scratch_path(docs.sparkSession, "token-files")
    schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                        ("n_ids", pa.int64()), ("n_bytes", pa.int64())])

    def write(batches):
        enc, writer, uri = encoder(vocabulary), None, None
        shard = TaskContext.get().partitionId()
        end = np.array([end_id], dtype=IDS)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                if writer is None:
                    uri = new_file(folder, f"tokens-{shard:06d}", ".s8b")
                    writer = Writer(uri)
                names = part.column(0).to_pylist()
                for doc_id, ids in zip(names, enc.column(part.column(1))):
                    writer.add(doc_id, np.concatenate([ids, end]))
        if writer:
            size = writer.close()
            yield to_batch(schema, [[shard], [uri], [len(writer.doc_ids)], [writer.n_ids], [size]])

    rows = pick(docs, id=id_col, text=text_col)
    rows = rows.select(F.col("id").cast("long"), F.col("text").cast("string"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("id").asc(), tie).sortWithinPartitions("id", tie)
    return materialize(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: id, the number of ids of all
    documents before it, its number of ids, and their crc32."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def read(batches):
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                r = Reader(path)
                yield to_batch(schema, [
                    pa.array(r.doc_ids, mask=~r.known), before + r.starts[:-1],
                    np.diff(r.starts), r.checksums()])

    # one row per file: a running sum over them is small whatever the corpus
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).alias("before"))
    return (files.repartition(max(1, manifest.count()))
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into Simple-8b files, and what the files read back say."""
    return read_token_files(write_token_files(read_table(spark, sf_dir, "documents")))
