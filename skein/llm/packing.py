"""Best-fit packing of token documents into sequences of a fixed capacity.

Vector best-fit. A piece of a document is a vector (tokens, one document,
attention cost = tokens squared); a sequence has a capacity in each dimension.
A sequence is filled by taking, again and again, the piece that fits under every
residual capacity and scores best: the largest weighted dot product with the
residual vector, or the smallest weighted norm of what would remain.

At scale the vector of a piece depends on its length alone, and lengths are at
most the capacity, so the choice is made on the histogram of lengths: a pattern
of lengths is filled once and repeated as often as the counts allow. Only the
histogram (at most ``capacity`` rows) reaches the driver. Pieces get their place
by their rank among the pieces of the same length: tasks count ranks within
their own partition while they tokenize, and a prefix sum over (length,
partition) counts turns these into global ranks without moving the pieces of a
length into one task.

Defined results: null and empty texts are documents with the end id alone; a
null doc_id is kept; repeated rows are separate documents; an empty table gives
no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import materialize, pick, read_table, slices, to_batch
from skein.llm.tokens import IDS, TEXT_BYTES, encoder

CAPACITY = 2048


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, vocabulary: str | None = None,
                 end_id: int = 0) -> DataFrame:
    """Pieces of all documents, written to the shared folder: ids plus the end
    id, documents over the capacity cut so that only the first piece is short.
    ``rank`` counts pieces of the same length within the writing partition."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()),
                        ("rank", pa.int64())])

    def cut(batches):
        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([end_id], dtype=IDS)
        for batch in batches:
            for some in slices(batch, "text", TEXT_BYTES):
                rows = []
                for doc_id, ids in zip(some.column(0).to_pylist(), enc.column(some.column(1))):
                    ids = np.concatenate([ids, end])
                    stop, piece, start = len(ids) % capacity or capacity, 0, 0
                    while start < len(ids):
                        n = stop - start
                        rows.append((doc_id, piece, start, n,
                                     zlib.crc32(ids[start:stop].tobytes()), part, int(seen[n])))
                        seen[n] += 1
                        start, stop, piece = stop, stop + capacity, piece + 1
                yield to_batch(schema, zip(*rows))

    rows = pick(docs, id=id_col, text=text_col)
    rows = rows.select(F.col("id").cast("long"), F.col("text").cast("string"))
    return materialize(rows.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, "
             "rank long"), "token-pieces")


class Plan:
    """Which sequence and offset the r-th piece of a length gets: slots sorted
    by (length, first rank), each serving ``m`` ranks in ``m`` sequences."""

    def __init__(self, slots: list[tuple[int, int, int, int]], sequences: int):
        rows = np.array(slots, dtype=np.int64).reshape(-1, 4)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        self.length, self.rank, self.sequence, self.offset = rows.T
        self.key = (self.length << 48) | self.rank
        self.sequences = sequences

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 48) | rank, side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def vector_best_fit(histogram: dict[int, int], capacity: int = CAPACITY,
                    max_docs: int | None = None, max_attention: float | None = None,
                    weights: tuple[float, float, float] = (1.0, 0.0, 1.0),
                    rule: str = "dot") -> Plan:
    """Fill sequences from the histogram of piece lengths.

    ``max_docs`` and ``max_attention`` default to bounds that every sequence of
    ``capacity`` tokens meets. A piece that alone breaks a bound is an error.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    caps = np.array([capacity, max_docs or capacity, max_attention or float(capacity) ** 2])
    sizes = np.stack([lengths, np.ones_like(lengths), lengths ** 2], axis=1) / caps
    if len(lengths) and (sizes > 1 + 1e-12).any():
        raise ValueError("a piece exceeds a capacity on its own")
    w = np.array(weights)
    used = np.zeros_like(counts)
    slots, sequences = [], 0
    while (counts > 0).any():
        left, residual, pattern = counts.copy(), np.ones(3), []
        while True:
            fits = np.flatnonzero((left > 0) & (sizes <= residual + 1e-12).all(axis=1))
            if not len(fits):
                break
            if rule == "dot":
                best = fits[np.argmax(sizes[fits] @ (w * residual))]
            else:
                best = fits[np.argmin(((residual - sizes[fits]) ** 2) @ w)]
            # several of one length at once, while it stays the best
            pattern.append(int(best))
            left[best] -= 1
            residual = residual - sizes[best]
        types, times = np.unique(pattern, return_counts=True)
        m = int((counts[types] // times).min())
        offset = 0
        for t in pattern:
            slots.append((int(lengths[t]), int(used[t]), sequences, offset))
            used[t] += m
            counts[t] -= m
            offset += int(lengths[t])
        sequences += m
    return Plan(slots, sequences)


def pack(pieces: DataFrame, capacity: int = CAPACITY, max_docs: int | None = None,
         max_attention: float | None = None, rule: str = "dot") -> DataFrame:
    """Give every piece a sequence and an offset in it."""
    counts = materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")),
                         "piece-counts")
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(
        vector_best_fit(histogram, capacity, max_docs, max_attention, rule=rule))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = counts.select("length", "part",
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            sequence, offset = plan.value.place(length, rank)
            yield to_batch(schema, [*[b.column(c) for c in
                                      ("doc_id", "piece", "start", "length", "ids_crc32")],
                                    sequence, offset])

    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.col("rank")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, "
                                    "ids_crc32 long, sequence_id long, offset long")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(token_pieces(read_table(spark, sf_dir, "documents")))
