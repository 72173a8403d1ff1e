"""Structured Streaming forms of the operators whose state makes sense unbounded.

The original consumes records as they are produced but keeps every parent it
has ever seen; here the pairing state is bounded by an event-time horizon that the
caller gives, and a watermark (a documented deviation: a reply later than the
horizon does not pair). Aggregates run in update mode; ``run`` drives a query to
completion with ``trigger(availableNow=True)`` and returns the result as a batch
DataFrame.

``run`` and ``run_vocab`` take the folder that holds the sink and the streaming
checkpoint. Called again with the same folder, after a stop or a lost driver, they
go on from the last committed batch; without one they start anew in a scratch
folder.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skein.functions.predicates import not_deleted
from skein.functions.text import DELETED, tokenize, trim_whitespace
from skein.operators.pairs import parent_key
from skein.session import scratch_path
from skein.streaming.pairing import exact_pair_stream

EPOCH_BASE = 1_704_067_200  # 2024-01-01T00:00:00Z: staged event times start here


def with_event_time(df: DataFrame, pos: str = "pos", unit_ms: int = 1) -> DataFrame:
    """Event time for tables without one: the base instant plus ``pos`` units.
    (Times near epoch 0 would be dropped as late by the initial watermark.)"""
    return df.withColumn("ts", F.timestamp_millis(F.lit(EPOCH_BASE * 1000) + F.col(pos) * unit_ms))


def stage_json(df: DataFrame, name: str, late: Column | None = None) -> str:
    """Write ``df`` as JSON-lines files in ``pos`` ranges, as a producer would
    drop them into a landing folder; returns the folder. Spark's shuffle settings
    say how many files. ``late`` moves rows to where that much later ones are."""
    spark = df.sparkSession
    path = scratch_path(spark, f"landing-{name}")
    arrives = F.col("pos") if late is None else F.col("pos") + late
    (df.withColumn("_arrives", arrives).repartitionByRange("_arrives").sortWithinPartitions("_arrives")
     .drop("_arrives").write.json(path))
    _order_files(spark, path)
    return path


def _order_files(spark: SparkSession, path: str) -> None:
    """Give the part files increasing modification times in name (= pos range)
    order, so the file source consumes them in stream order."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((st.getPath() for st in fs.listStatus(hp) if st.getPath().getName().startswith("part-")),
                   key=lambda p: p.getName())
    base = int(fs.getFileStatus(hp).getModificationTime())
    for i, p in enumerate(parts):
        fs.setTimes(p, base + 1000 * (i + 1), -1)


def source(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """JSON directory source (R1 / A8); all new files make a micro-batch, or as
    many as given."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


# ------------------------------------------------------------------ operators

def clean_stream(comments: DataFrame) -> DataFrame:
    """Stateless clean + filter (R1): no deleted comments, whitespace collapsed."""
    return (comments.where(not_deleted("body"))
            .select("pos", "id", trim_whitespace("body").alias("body")))


def pair_stream(comments: DataFrame, horizon: str, delay: str) -> DataFrame:
    """Replies with the earlier versions of their parents (R2): pos, id,
    parent_id, parent_pos, parent_body, reply_body.

    A stream-stream join finds the versions seen at an earlier position and at
    most ``horizon`` (event time) before the reply; records may arrive ``delay``
    late, and the watermark frees both sides. ``run`` with ``PAIR_KEYS`` and
    ``latest_by="parent_pos"`` keeps the latest version of each reply.
    """
    c = comments.where(not_deleted("body")).withColumn("body", trim_whitespace("body"))
    c = c.withColumn("parent_id", parent_key("parent_id"))
    parents = c.select(F.col("id").alias("p_id"), F.col("pos").alias("parent_pos"),
                       F.col("ts").alias("p_ts"), F.col("body").alias("parent_body")).withWatermark("p_ts", delay)
    replies = c.select("pos", "id", "parent_id", "ts", F.col("body").alias("reply_body")).withWatermark("ts", delay)
    cond = F.expr(f"""parent_id = p_id AND parent_pos < pos
                      AND ts >= p_ts AND ts <= p_ts + INTERVAL {horizon}""")
    return replies.join(parents, cond, "inner").select("pos", "id", "parent_id", "parent_pos", "parent_body",
                                                       "reply_body")


PAIR_KEYS = ["pos", "id", "parent_id"]


def pair_line_stream(comments: DataFrame, horizon: str, delay: str) -> DataFrame:
    """The pair dump as lines of text (R7), a column ``line``: one for each reply that
    has a parent, also if versions of that arrive late (``pairing``)."""
    return exact_pair_stream(comments, horizon, delay).select(
        F.concat_ws("\t", "parent_body", "reply_body").alias("line"))


def distinct_stream(df: DataFrame, cols: Sequence[str], ts: str, within: str) -> DataFrame:
    """Distinct values (R3). A value is remembered for ``within`` (event time)
    after it was seen, and counts as new if it comes again later than that."""
    return df.select(*cols, ts).withWatermark(ts, within).dropDuplicatesWithinWatermark(list(cols)).select(*cols)


def running_totals(comments: DataFrame) -> DataFrame:
    """Running summary (R4), for update mode: comments, deleted, on posts, reply
    pairs. (The number of groups is the number of rows of ``running_counts``.)"""
    is_pair = F.coalesce(parent_key("parent_id").startswith("c"), F.lit(False))
    return comments.groupBy(F.lit(0).alias("all")).agg(
        F.count(F.lit(1)).alias("comments"),
        F.count_if(F.coalesce(F.col("body") == F.lit(DELETED), F.lit(False))).alias("deleted"),
        F.count_if(~is_pair).alias("posts"), F.count_if(is_pair).alias("pairs"))


def running_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Running per-key counts (R4), for update mode."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def running_word_counts(df: DataFrame, text: str = "body") -> DataFrame:
    """Running word counts (R5), for update mode."""
    words = df.select(F.explode_outer(tokenize(text)).alias("word")).where(F.col("word").isNotNull())
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def running_field_counts(records: DataFrame, json_col: str = "value") -> DataFrame:
    """Running field counts of JSON-text records (R6), for update mode."""
    keys = records.select(F.explode_outer(F.json_object_keys(json_col)).alias("field")) \
        .where(F.col("field").isNotNull())
    return keys.groupBy("field").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ running

def _exists(spark: SparkSession, path: str) -> bool:
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run(stream: DataFrame, name: str, keys: Sequence[str] | None = None, folder: str | None = None,
        latest_by: str | None = None, text: str | None = None) -> DataFrame:
    """Run ``stream`` over everything available and return its result so far.

    Without ``keys``: append mode into a parquet sink, or one of lines of text if
    ``text`` names their column. With ``keys`` (an
    aggregate): update mode; each micro-batch's changed rows are written to a
    partition named by the batch id, and the result keeps the latest row per key
    (an upsert log compacted by a partial aggregate, never collected). With
    ``latest_by`` as well: append mode; of the rows of a key the one with the
    greatest ``latest_by`` is kept, in each micro-batch before it is written and
    over all of them in the result. ``folder`` holds sink and checkpoint.
    """
    spark = stream.sparkSession
    folder = folder or scratch_path(spark, f"stream-{name}")
    out = f"{folder}/sink"
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    if keys is None:
        sink, rows = ("parquet", stream) if text is None else ("text", stream.select(F.col(text).alias("value")))
        if text is not None:
            writer = rows.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
        _finish(writer.format(sink).outputMode("append").start(out))
        found = spark.read.schema(rows.schema).format(sink).load(out)
        return found if text is None else found.withColumnRenamed("value", text)
    values = [c for c in stream.columns if c not in keys]

    def latest(rows: DataFrame, by: str) -> DataFrame:
        kept = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), by).alias("_v"))
        return kept.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # one partition per batch id, overwritten: a re-run batch is idempotent
        rows = latest(batch, latest_by) if latest_by else batch
        rows.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")

    _finish(writer.outputMode("append" if latest_by else "update").foreachBatch(upsert).start())
    if not _exists(spark, out):     # no micro-batch has run
        return spark.createDataFrame([], stream.schema)
    result = spark.read.schema(StructType([*stream.schema.fields, StructField("_batch", LongType())])).parquet(out)
    return latest(result, latest_by or "_batch")


def run_vocab(stream: DataFrame, tokens: str, name: str, folder: str | None = None) -> DataFrame:
    """Running vocabulary with a stable index (R5): each micro-batch gives the
    words it sees first an index after the current maximum, in first-occurrence
    order; counts accumulate. Per-batch outputs are written to their own
    partition and only earlier batches count as known, so a re-run batch
    rewrites the same rows. Returns (word, index, count); ``folder`` as in ``run``."""
    from skein.operators.indexing import dense_index
    from skein.operators.vocab import first_seen_key, token_rows

    spark = stream.sparkSession
    folder = folder or scratch_path(spark, f"stream-vocab-{name}")
    index_dir, count_dir = f"{folder}/index", f"{folder}/counts"
    index_schema, count_schema = "word string, index bigint, batch bigint", "word string, count bigint, batch bigint"

    def known_index() -> DataFrame:
        if not _exists(spark, index_dir):
            return spark.createDataFrame([], index_schema)
        return spark.read.schema(index_schema).parquet(index_dir)

    def update(batch: DataFrame, batch_id: int) -> None:
        rows = token_rows(batch, tokens)
        words = rows.groupBy("word").agg(F.count(F.lit(1)).alias("count"),
                                         F.min(first_seen_key(rows)).alias("_first"))
        words.select("word", "count").write.mode("overwrite").parquet(f"{count_dir}/batch={batch_id}")
        known = known_index().where(F.col("batch") < batch_id)
        base = known.agg(F.coalesce(F.max("index") + 1, F.lit(0))).first()[0]
        new = words.join(known.select("word"), "word", "left_anti")
        dense_index(new, "_first", "_i").select("word", (F.col("_i") + base).alias("index")) \
            .write.mode("overwrite").parquet(f"{index_dir}/batch={batch_id}")

    _finish(stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
            .foreachBatch(update).start())
    index = known_index().select("word", "index")
    if not _exists(spark, count_dir):
        return spark.createDataFrame([], "word string, index bigint, count bigint")
    counts = spark.read.schema(count_schema).parquet(count_dir).groupBy("word").agg(F.sum("count").alias("count"))
    return index.join(counts, "word")
