"""Sinks: pair TSV, processed records, ordered text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_lines(pairs: DataFrame, first: str = "parent_body", second: str = "reply_body") -> DataFrame:
    """``parent<TAB>reply`` per pair (A6). Safe as TSV because the default
    preprocessing collapses tabs and newlines inside bodies."""
    return pairs.select("pos", F.concat_ws("\t", first, second).alias("line"))


def write_pairs_tsv(pairs: DataFrame, path: str, mode: str = "error") -> None:
    """Write pair lines in stream order (A6): a range-partitioned sort, so part
    files concatenated in name order are the original line order."""
    pair_lines(pairs).orderBy("pos").select("line").write.mode(mode).text(path)


def write_records(df: DataFrame, path: str, fmt: str = "json", mode: str = "error") -> None:
    """Emit processed records for later use (A7): JSON lines or parquet."""
    df.write.mode(mode).format(fmt).save(path)


def write_ordered_text(pieces: DataFrame, path: str, mode: str = "error") -> None:
    """Write ordered (index, piece) rows (``ordered.to_string``) as text whose
    part files, concatenated in order, give the joined string; no task holds
    more than its own range."""
    (pieces.orderBy("index").select(F.col("piece").alias("value"))
     .write.mode(mode).option("lineSep", "").text(path))
