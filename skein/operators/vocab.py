"""Vocabulary and integer encoding.

Index = order of first occurrence (record position, then token position), as
the Python encoder assigns it while streaming. Counting is a partial + final
aggregate, so frequent words never concentrate before the combine; the dense
index is range-partitioned (see ``indexing``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from skein.operators.indexing import dense_index
from skein.operators.rows import as_col, explode_rows

def token_rows(df: DataFrame, tokens, order: str = "pos") -> DataFrame:
    """(pos, i, word) for every token of every record."""
    return explode_rows(df.select(F.col(order).alias("pos"), as_col(tokens).alias("_t")),
                        "_t", "i", "word")


def first_seen_key(tokens: DataFrame, pos: str = "pos", i: str = "i") -> Column:
    """(record position, token index) as one ordered value. For an integer
    position an exact number, pos * 2^31 + i (an array index is below 2^31):
    DECIMAL(38,0) is a fixed-size buffer, so the aggregate stays a hash aggregate
    with a map-side combine. Any other position stays a pair."""
    if isinstance(tokens.schema[pos].dataType, IntegralType):
        return F.col(pos).cast("decimal(38,0)") * F.lit(1 << 31) + F.col(i)
    return F.struct(pos, i)


def build_vocab(df: DataFrame, tokens, order: str = "pos", min_count: int = 1) -> DataFrame:
    """word, index, count (V1); with ``min_count`` > 1 rare words are dropped
    and the rest re-indexed in first-seen order (V7)."""
    rows = token_rows(df, tokens, order)
    counted = rows.groupBy("word").agg(F.count(F.lit(1)).alias("count"),
                                       F.min(first_seen_key(rows)).alias("_first"))
    if min_count > 1:
        counted = counted.where(F.col("count") >= min_count)
    return dense_index(counted, "_first", "index").select("word", "index", "count")


def encode(df: DataFrame, tokens, vocab: DataFrame, order: str = "pos",
           name: str = "codes") -> DataFrame:
    """Integer codes of every record's tokens, in token order: (order, codes) (V2).

    Records are dealt out by their key once, as they are; ``tokens`` (a column or an
    expression) is worked out behind that exchange. Each part's distinct words, not its
    tokens, go to the vocabulary and come back with their indexes, a dictionary as
    large as the part's own words; tokens are then coded in place, a part at a time.
    However often a word occurs, it is one row for each part. A word that is not in
    the vocabulary has a null code, and a record without tokens an empty list.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(F.col(order)), F.lit(n)).cast("int")
    recs = df.withColumn("_part", part).repartition(n, "_part").select(
        "_part", F.col(order).alias("pos"), as_col(tokens).alias("_t"))
    words = recs.select("_part", F.explode_outer(F.array_distinct("_t")).alias("word")).where(
        F.col("word").isNotNull()).distinct()
    known = words.join(vocab.select("word", "index"), "word").select(
        F.col("_part").alias("_of"), "word", "index")

    def code(records: pa.Table, dictionary: pa.Table) -> pa.Table:
        tokens = records["_t"].combine_chunks()
        lens = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        at = pc.index_in(tokens.flatten(), value_set=dictionary["word"].combine_chunks())
        codes = dictionary["index"].combine_chunks().take(at)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32())
        return pa.table({order: records["pos"], name: pa.ListArray.from_arrays(offsets, codes)})

    kind = recs.schema["pos"].dataType.simpleString()
    return recs.groupBy("_part").cogroup(known.groupBy("_of")).applyInArrow(
        code, f"`{order}` {kind}, `{name}` array<bigint>")


def vocab_ordered(vocab: DataFrame, by: str | None = None, reverse: bool = False) -> DataFrame:
    """The listing (V3) by count, index or word (no choice means by word), sorted,
    with each line's place in ``rank``. Ties stay in index order, also when
    reversed (a stable sort)."""
    key = {"count": "count", "index": "index"}.get(by or "word", "word")
    primary = F.col(key).desc() if reverse else F.col(key).asc()
    return dense_index(vocab, [primary, F.col("index").asc()], "rank").orderBy("rank")


def vocab_brief(vocab: DataFrame) -> DataFrame:
    """Vocabulary size and total word count (V4)."""
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"),
                     F.sum("count").cast("bigint").alias("total_words"))


def lookup(vocab: DataFrame, keys: DataFrame, by: str = "word") -> DataFrame:
    """Look words (or indexes) up in the vocabulary (V5); unknown keys get nulls."""
    return keys.join(vocab, by, "left")
