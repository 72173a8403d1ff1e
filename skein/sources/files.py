"""File sources: JSON-lines records, text lines and labelled sentences.

Plain and ``.bz2`` files are read by Spark's built-in codecs (bzip2 is
splittable, so one large dump is decompressed by many tasks). The order of the
caller's file list, then the order inside each file, is kept as ``pos``:

    pos = (file's place in the list, start of the split in the file, row in it)

The place in the list is needed because Spark packs splits by size, not by list
order; inside one split rows are read sequentially, so the row number increases.
``pos`` is attached right at the scan, before anything can shuffle, as one exact
number (DECIMAL(38,0)). ``dense_pos=True`` replaces it by a 0..n-1 BIGINT: rows are
counted per split, the counts of earlier splits are added to the row number, and no
row is shuffled, sorted or written. The input is read twice, the first time without
its columns.

``first=n`` reads hardly more than it needs. The leading files are counted, one, then
two, four, ... at a time, until n rows are there, and only the last of these is cut. Of
its splits, a few rows (``FEW``) are taken one split after the other; more are counted
and read by a task for each split that stops after n rows, which reads in vain what it
has sent to its Python worker by then, some MB at most.

A path may be a file, a folder or a glob pattern; folders and patterns stand for
their files in name order, and a path without any file is an error. A file that
is listed twice is read as two sources.
"""

from __future__ import annotations

import re
from collections import Counter
from decimal import Decimal
from functools import reduce
from typing import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skein.operators.indexing import dense_index

# Comment fields of the dump (all nullable); ``edited`` is false, true or an
# epoch float, so it stays schema-less (VARIANT).
COMMENT_SCHEMA = (
    "id string, parent_id string, link_id string, subreddit string, subreddit_id string, "
    "author string, body string, author_flair_text string, author_flair_css_class string, "
    "distinguished string, created_utc bigint, retrieved_on bigint, score bigint, ups bigint, "
    "gilded bigint, controversiality bigint, stickied boolean, edited variant"
)
LABELLED_SCHEMA = "Sentence string, Class int"
_ROW_BITS, _BLOCK_BITS = 33, 50     # of a position; the rest is the file's place
_WAVE = 32                          # files that are counted at a time at most
FEW = 100_000                       # rows that one task may read
_ROW = (1 << _ROW_BITS) - 1


def list_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The files behind files, folders and patterns, as URIs, in order."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        found = [fs.getFileStatus(hp)] if fs.exists(hp) else list(fs.globStatus(hp) or [])
        files = []
        for st in found:
            files += list(fs.listStatus(st.getPath())) if st.isDirectory() else [st]
        files = sorted(st.getPath().toUri().toString() for st in files
                       if not st.isDirectory() and st.getPath().getName()[0] not in "._")
        if not files:
            raise FileNotFoundError(f"no file at {p}")
        # file:/a and file:///a are the same
        out += [re.sub("^file:/+", "file:/", f) for f in files]
    return out


def _readable(spark: SparkSession, uris: Sequence[str]) -> list[str]:
    """Paths for the reader, which would take special characters for a pattern."""
    jvm = spark.sparkContext._jvm
    plain = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(u)).toString() for u in dict.fromkeys(uris)]
    return ["".join(f"\\{c}" if c in "*?[]{}\\," else c for c in p) for p in plain]


def _tagged(df: DataFrame) -> DataFrame:
    """The start of each row's split and its number in its task, given at the scan."""
    return df.select("*", F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)).alias("_row"))


def _exact_pos(file, block, row) -> F.Column:
    """(file, split, row) as one number."""
    def exact(c, bits: int) -> F.Column:
        return c.cast("decimal(38,0)") * F.lit(Decimal(1 << bits))

    return (exact(file, _ROW_BITS + _BLOCK_BITS) + exact(block, _ROW_BITS)
            + row.cast("decimal(38,0)")).cast("decimal(38,0)")


def _with_pos(spark: SparkSession, df: DataFrame, uris: Sequence[str], dense_pos: bool) -> DataFrame:
    names = spark.createDataFrame(list(enumerate(uris)), "_file int, _path string")     # the list itself
    tagged = _tagged(df.select("*", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("_from")))
    placed = tagged.join(F.broadcast(names), F.col("_from") == F.col("_path"), "left")
    number = F.when(F.col("_file").isNull(), F.raise_error(F.concat(F.lit("not a listed file: "), "_from"))
                    .cast("int")).otherwise(F.col("_file"))
    placed = placed.withColumn("_file", number)
    pos = _row_number(spark, placed) if dense_pos else _exact_pos(F.col("_file"), F.col("_block"), F.col("_row"))
    if dense_pos:
        placed, pos = pos
    return placed.withColumn("pos", pos).drop("_file", "_path", "_from", "_block", "_row")


def _row_number(spark: SparkSession, placed: DataFrame) -> tuple[DataFrame, F.Column]:
    """``placed`` with what a row's number in its task lacks to the number among all
    rows, and the sum: a count per split, of which earlier splits are added up. The
    table has one row a split (a few MB for 100,000 of them) and is broadcast."""
    # both reads must cut the files alike, also if the number of cores has changed
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    splits = placed.groupBy(F.col("_file").alias("_f"), F.col("_block").alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_least"))
    earlier = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_f", "_b", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_least"))
                           .alias("_lack"))
    joined = placed.join(F.broadcast(splits), (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")),
                         "left").drop("_f", "_b")
    lack = F.when(F.col("_lack").isNull(), F.raise_error(F.lit("the input's splits have changed")).cast("bigint")) \
        .otherwise(F.col("_lack"))
    return joined.withColumn("_lack", lack), F.col("_row") + F.col("_lack")


# ---- the first rows ------------------------------------------------------------------

def _one_file(spark: SparkSession, uri: str, filled: bool) -> DataFrame:
    """(value, _block, _row) of one file; each task has one split of it, as Spark puts
    splits together only if they are smaller than a full one. ``filled``: lines that
    are not blank."""
    df = spark.read.text(_readable(spark, [uri])).select("value", F.col("_metadata.file_block_start").alias("_block"))
    df = df.where(F.col("value").rlike("\\S")) if filled else df
    return df.select("*", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)).alias("_row"))


def _leading(spark: SparkSession, uris: list[str], first: int, filled: bool) -> tuple[int, dict[int, int]]:
    """How many files are needed whole, and how many rows of which splits of the next."""
    def count(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            for block, n in zip(*(c.to_pylist() for c in batch.column(0).value_counts().flatten())):
                seen[block] = seen.get(block, 0) + n
            if max(seen.values(), default=0) >= first:
                break           # the task ends here; the rest of its split is not read
        if seen:
            yield pa.RecordBatch.from_pydict({"block": list(seen), "n": [min(n, first) for n in seen.values()]})

    left, k, wave = first, 0, 1
    while k < len(uris) and left > 0:
        files = [_one_file(spark, uri, filled).select("_block") for uri in uris[k:k + wave]]
        if left <= FEW:         # Spark goes through the splits in order until it has enough
            rows = reduce(DataFrame.union, [f.select(F.lit(k + i), "_block") for i, f in enumerate(files)])
            found = Counter(tuple(r) for r in rows.limit(left).collect())
        else:
            counted = reduce(DataFrame.union, [f.mapInArrow(count, "block long, n long").withColumn("file", F.lit(k + i))
                                               for i, f in enumerate(files)])
            found = {(r["file"], r["block"]): r["n"] for r in counted.collect()}
        for file in range(k, k + len(files)):
            quota = {}
            for block in sorted(b for f, b in found if f == file):
                quota[block] = min(found[file, block], left)
                left -= quota[block]
                if not left:
                    return file, quota
        k, wave = k + len(files), min(2 * wave, _WAVE)
    return (k, {}) if left else (0, {})


def _first_lines(spark: SparkSession, uris: list[str], first: int, filled: bool) -> DataFrame:
    """(value, pos) of the first rows."""
    whole, quota = _leading(spark, uris, max(first, 0), filled)
    parts = []
    if whole:
        lines = _with_pos(spark, spark.read.text(_readable(spark, uris[:whole])), uris[:whole], False)
        parts.append(lines.where(F.col("value").rlike("\\S")) if filled else lines)
    if quota:
        def head(batches):
            given: dict[int, int] = {}
            for batch in batches:
                blocks = batch.column(1).to_pylist()
                keep = []
                for i, block in enumerate(blocks):
                    if given.get(block, 0) < quota.get(block, 0):
                        given[block] = given.get(block, 0) + 1
                        keep.append(i)
                yield batch.take(pa.array(keep, pa.int64()))
                if blocks and given.get(blocks[-1], 0) >= quota.get(blocks[-1], 0):
                    break           # the rest of the split is not read

        some, n = _one_file(spark, uris[whole], filled), sum(quota.values())
        if n <= FEW:            # one task reads from the start of the file and stops
            wanted = [(F.col("_block") == block) & (F.col("_row") < q) for block, q in quota.items()]
            some = some.where(reduce(lambda a, b: a | b, wanted)).coalesce(1).limit(n)
        else:
            some = some.mapInArrow(head, some.schema)
        parts.append(some.select("value", _exact_pos(F.lit(whole), F.col("_block"), F.col("_row")).alias("pos")))
    if not parts:
        return spark.createDataFrame([], "value string, pos decimal(38,0)")
    return reduce(DataFrame.unionByName, parts)


def read_lines(spark: SparkSession, *paths: str, dense_pos: bool = False,
               first: int | None = None) -> DataFrame:
    """Text lines of several files as one ordered stream: (value, pos) (A2, A3).
    ``first``: only the first lines are wanted, and hardly more are read."""
    uris = list_files(spark, paths)
    if first is None:
        return _with_pos(spark, spark.read.text(_readable(spark, uris)), uris, dense_pos)
    return _numbered(_first_lines(spark, uris, first, False), dense_pos)


def _numbered(df: DataFrame, dense_pos: bool) -> DataFrame:
    """The first rows of a stream by number, if wanted: they are as many as were
    asked for, and ranked among themselves."""
    if not dense_pos:
        return df
    return dense_index(df, "pos", "_dense").drop("pos").withColumnRenamed("_dense", "pos")


def read_records(spark: SparkSession, *paths: str, schema: str | StructType | None = None,
                 dense_pos: bool = False, first: int | None = None) -> DataFrame:
    """JSON-lines records (A1).

    With a schema: typed columns plus ``pos``; a malformed line fails the job
    (FAILFAST, as the original raises); only the fields that a plan uses are kept.
    Without: ``(value, pos)`` with the raw JSON text, for schema-less field
    statistics (``stats.record_fields``). Blank lines are skipped (the original
    raises on them).
    """
    uris = list_files(spark, paths)
    st = schema if schema is None or isinstance(schema, StructType) else StructType.fromDDL(schema)
    if first is not None:
        lines = _numbered(_first_lines(spark, uris, first, True), dense_pos)
        if st is None:
            return lines
        return lines.select(F.from_json("value", st, {"mode": "FAILFAST"}).alias("_r"), "pos").select("_r.*", "pos")
    if st is None:
        lines = spark.read.text(_readable(spark, uris))
        if not dense_pos:
            return _with_pos(spark, lines, uris, False).where(F.col("value").rlike("\\S"))
        # blank lines have no number, so rows are numbered after them
        return _with_pos(spark, lines.where(F.col("value").rlike("\\S")), uris, True)
    read = spark.read.schema(st).option("mode", "FAILFAST").json(_readable(spark, uris))
    return _with_pos(spark, read, uris, dense_pos)


def read_comments(spark: SparkSession, *paths: str, dense_pos: bool = False,
                  first: int | None = None) -> DataFrame:
    """Comment dump files (plain or .bz2) with the comment schema."""
    return read_records(spark, *paths, schema=COMMENT_SCHEMA, dense_pos=dense_pos, first=first)


def read_labelled(spark: SparkSession, *paths: str) -> DataFrame:
    """Tab-separated labelled sentences without header: (index, Sentence, Class) (A4, A5).

    ``index`` is the 0-based row number in input order. A field may be quoted; a
    quote inside it is doubled.
    """
    uris = list_files(spark, paths)
    df = (spark.read.schema(LABELLED_SCHEMA).option("sep", "\t").option("quote", '"').option("escape", '"')
          .csv(_readable(spark, uris)))
    return _with_pos(spark, df, uris, True).select(F.col("pos").alias("index"), "Sentence", "Class")
