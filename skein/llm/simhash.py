"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints. Each word shingle is hashed with XXH64 (seed 42); a bit of the
64-bit fingerprint is 1 if more than half of the shingles' hashes have it.

Index. Different fingerprints are sorted by Gray rank (the place of a bit
pattern in the reflected Gray code), so that neighbours differ in few bits, and
cut into segments. Inside a segment groups of ``LEAF`` neighbours are leaves and
groups of ``FAN`` nodes form upper nodes; each node keeps the mask of the bits
that all below it share, and their pattern.

Search. Two trees are walked together from the top: the differences of two nodes
on the bits that both share bound the distance of everything below them, so a
pair of nodes that has accumulated more than ``max_bits`` differences is pruned
with all it holds. The same test on the segments' own patterns picks the pairs
of segments to walk at all. Only leaves that survive are compared bit by bit, so
the links are exact.

Scale. Copies collapse to one fingerprint before anything else. A pair of
segments is one bounded piece of work and returns at most one link per
fingerprint (to the smallest of its group within the piece), not all pairs; the
rest is a components job. The driver sees one pattern per segment only.

Defined results: null and empty texts have fingerprint zero, linked like any
other; repeated rows and null ids are kept; a group's id is the smallest doc_id
that is not null (null if there is none); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import materialize, pick, read_table, spread, to_batch
from skein.llm.components import connected_components, merge_links

SHINGLE = 4
MAX_BITS = 4
SEGMENT = 1 << 15       # fingerprints of a segment
LEAF, FAN = 8, 8
PAIRS = 1 << 17         # node pairs looked at together
SHINGLES = 1 << 20      # shingles hashed together, of a very long text


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest
    words = (text or "").encode().lower().split()    # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, SHINGLES):
        hi = min(n, lo + SHINGLES)
        hashes = np.array([xxh64_intdigest(line[a:b - 1], 42)
                           for a, b in zip(starts[lo:hi], last[lo:hi])], dtype="<u8")
        bits = np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every row, written to the shared folder."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def prints(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64)
            yield to_batch(schema, [b.column(0), b.column(1), fps.view(np.int64)])

    rows = pick(docs, id=id_col, text=text_col)
    rows = rows.select(F.col("id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return materialize(rows.mapInArrow(prints, "doc_id long, text_hash long, fp long"),
                       "fingerprints")


def gray_rank(fp):
    """Place in the reflected Gray code, as a long that sorts like the unsigned value."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp.bitwiseXOR(F.lit(-1 << 63))


def shared(fps: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits that each run of ``fps`` agrees on, and the pattern there."""
    at = np.cumsum(sizes) - sizes
    low, high = np.bitwise_and.reduceat(fps, at), np.bitwise_or.reduceat(fps, at)
    mask = ~(low ^ high)
    return mask, low & mask


class Tree:
    """Levels of nodes over a segment's sorted fingerprints, leaves first."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        self.levels = []
        size = LEAF
        while True:
            n = -(-len(fps) // size)
            sizes = np.full(n, size)
            sizes[-1] = len(fps) - (n - 1) * size
            self.levels.append(shared(fps, sizes))
            if n == 1:
                return
            size *= FAN

    def level(self, k: int):
        return self.levels[min(k, len(self.levels) - 1)]


def linked(a: Tree, b: Tree, same: bool, max_bits: int, emit) -> None:
    """Call ``emit(i, j)`` with the places of all fingerprints of a and b that
    differ in at most ``max_bits`` bits (each pair once if a is b)."""

    def survivors(level, i, j):
        (am, ap), (bm, bp) = a.level(level), b.level(level)
        keep = np.bitwise_count((ap[i] ^ bp[j]) & am[i] & bm[j]) <= max_bits
        return i[keep], j[keep]

    def children(i, j, fan, n_i, n_j, split_i, split_j):
        step_i = np.arange(fan if split_i else 1)
        step_j = np.arange(fan if split_j else 1)
        ci = (i * len(step_i))[:, None, None] + step_i[:, None]
        cj = (j * len(step_j))[:, None, None] + step_j
        ci, cj = (x.reshape(-1) for x in np.broadcast_arrays(ci, cj))
        keep = (ci < n_i) & (cj < n_j)
        if same:
            keep &= ci <= cj
        return ci[keep], cj[keep]

    def down(level, i, j):
        for lo in range(0, len(i), PAIRS):
            x, y = survivors(level, i[lo:lo + PAIRS], j[lo:lo + PAIRS])
            if not len(x):
                continue
            if level:
                down(level - 1, *children(
                    x, y, FAN, len(a.level(level - 1)[0]), len(b.level(level - 1)[0]),
                    level < len(a.levels), level < len(b.levels)))
            else:
                for at in range(0, len(x), PAIRS // 8):
                    p, q = children(x[at:at + PAIRS // 8], y[at:at + PAIRS // 8], LEAF,
                                    len(a.fps), len(b.fps), True, True)
                    near = np.bitwise_count(a.fps[p] ^ b.fps[q]) <= max_bits
                    if same:
                        near &= p < q
                    if near.any():
                        emit(p[near], q[near])

    top = np.zeros(1, dtype=np.int64)
    down(max(len(a.levels), len(b.levels)) - 1, top, top)


def segment_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that join every group of the different fingerprints ``fp``."""
    rows = pa.schema([("seg", pa.int64()), ("fps", pa.binary()), ("mask", pa.int64()),
                      ("pattern", pa.int64())])

    def cut(batches):
        part, k, held = TaskContext.get().partitionId(), 0, np.zeros(0, np.int64)

        def row(fps):
            mask, pattern = shared(fps.view(np.uint64), np.array([len(fps)]))
            return to_batch(rows, [[part << 24 | k], [fps.astype("<i8").tobytes()],
                                   mask.view(np.int64), pattern.view(np.int64)])

        for b in batches:
            held = np.concatenate([held, b.column(0).to_numpy()])
            while len(held) >= SEGMENT:
                yield row(held[:SEGMENT])
                held, k = held[SEGMENT:], k + 1
        if len(held):
            yield row(held)

    ranked = fps.select("fp", gray_rank(F.col("fp")).alias("rank"))
    segments = materialize(
        ranked.repartitionByRange("rank").sortWithinPartitions("rank").select("fp")
        .mapInArrow(cut, "seg long, fps binary, mask long, pattern long"), "gray-segments")
    # one pattern per segment: the top of the index
    top = segments.select("seg", "mask", "pattern").orderBy("seg").toPandas()
    seg = top["seg"].to_numpy(np.int64)
    mask, pattern = (top[c].to_numpy(np.int64).view(np.uint64) for c in ("mask", "pattern"))
    pair_schema = pa.schema([("i", pa.int64()), ("j", pa.int64())])

    def meet(batches):
        for b in batches:
            for s in b.column(0).to_pylist():
                at = int(np.searchsorted(seg, s))
                other = np.arange(at, len(seg))
                differ = np.bitwise_count((pattern[at] ^ pattern[other]) & mask[at] & mask[other])
                yield to_batch(pair_schema, [np.full(int((differ <= max_bits).sum()), s),
                                             seg[other[differ <= max_bits]]])

    pairs = materialize(segments.select("seg").mapInArrow(meet, "i long, j long"), "segment-pairs")
    left = segments.select(F.col("seg").alias("i"), F.col("fps").alias("x"))
    right = segments.select(F.col("seg").alias("j"), F.col("fps").alias("y"))
    link_schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def walk(batches):
        for batch in batches:
            for i, j, x, y in zip(*[batch.column(c).to_pylist() for c in ("i", "j", "x", "y")]):
                x, y = (np.frombuffer(v, "<i8") for v in (x, y))
                both = x if i == j else np.concatenate([x, y])
                label = np.arange(len(both))
                shift = 0 if i == j else len(x)
                linked(Tree(x.view(np.uint64)), Tree(y.view(np.uint64)), i == j, max_bits,
                       lambda p, q: merge_links(label, p, q + shift))
                moved = np.flatnonzero(label != np.arange(len(label)))
                yield to_batch(link_schema, [both[moved], both[label[moved]]])

    n = pairs.count()
    work = pairs.join(left, "i").join(right, "j").select("i", "j", "x", "y")
    return work.repartition(max(1, min(n, 8 * spread(fps)))).mapInArrow(walk, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row: ``root`` is the
    group's smallest fingerprint, ``component_id`` its smallest doc_id."""
    prints = fingerprints(docs, id_col, text_col, shingle)
    different = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "different")
    links = connected_components(segment_links(different, max_bits))
    rooted = different.join(links.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    least = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    groups = materialize(rooted.select("fp", "root").join(least, "root"), "groups")
    return prints.join(groups, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate groups of all documents."""
    groups = simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         "component_id")
