"""Adapters from the supplied parquet tables to the library's data model.

No comment dump is supplied, so ``comments`` is derived from ``conversations``:
every conversation becomes a binary reply tree (turn t answers turn (t-1)//2),
turn 0 answers a post that is not in the data, and about one row in eleven is
deleted. ``pos`` is the stream order (conversation, then turn). As in a real dump
some rows are odd: a few repeat the id of the row before, have no id or no parent,
answer the row after them, or belong to a group without an id or with a new name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import table

ID_WIDTH = 12  # zero-padded width of derived comment ids


def _cid(n) -> F.Column:
    return F.concat(F.lit("c"), F.lpad(n.cast("string"), ID_WIDTH, "0"))


def comments_from_conversations(conv: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> comments with ``pos``."""
    conv_id, turn = F.col("conv_id"), F.col("turn")
    pos = conv_id * 100 + turn
    parent_pos = conv_id * 100 + F.floor((turn - 1) / 2).cast("bigint")
    group = (conv_id % 7).cast("string")
    return conv.select(
        pos.alias("pos"),
        F.when((conv_id * 5 + turn) % 97 == 3, F.lit(None))
         .when((turn > 0) & ((conv_id * 13 + turn) % 29 == 0), _cid(pos - 1))
         .otherwise(_cid(pos)).alias("id"),
        F.when((conv_id * 11 + turn) % 89 == 4, F.lit(None))
         .when((conv_id * 3 + turn) % 31 == 7, F.concat(F.lit("t1_"), _cid(pos + 1)))
         .when(turn == 0, F.concat(F.lit("t3_p"), conv_id.cast("string")))
         .otherwise(F.concat(F.lit("t1_"), _cid(parent_pos))).alias("parent_id"),
        F.when(conv_id % 37 == 11, F.lit(None)).when(conv_id % 10 == 9, F.concat(F.lit("n"), group))
         .otherwise(F.concat(F.lit("s"), group)).alias("subreddit"),
        F.when(conv_id % 41 == 5, F.lit(None)).otherwise(F.concat(F.lit("t5_"), group)).alias("subreddit_id"),
        F.col("role").alias("author"),
        F.when((conv_id * 7 + turn) % 11 == 0, F.lit("[deleted]"))
         .otherwise(F.col("text")).alias("body"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments_from_conversations(table(spark, sf_dir, "conversations"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with ``pos`` = event_id (the table's natural order)."""
    return table(spark, sf_dir, "events").withColumn("pos", F.col("event_id"))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sentences (index, Sentence), labelled or not."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("index"), F.col("text").alias("Sentence"))


def labelled_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled sentences (index, Sentence, Class) from documents + labels.quality.

    ``index`` is the document id, which is the table's input order.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("index"),
        F.col("text").alias("Sentence"),
        F.col("quality").cast("int").alias("Class"),
    )
