"""Helpers the pipeline operators share: written tables in the shared folder,
file access from tasks, and column picking that is safe against name clashes."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import scratch_path


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, in
    case it was put on the driver's path only."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's shared checkpoint folder and
    read it back. Cuts the lineage, survives lost executors, and gives later
    joins real file sizes to plan with."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    make_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, renamed to the operator's own names, so that no
    other column of the input can clash with them."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in columns.items()])


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A row by what it holds: equal for repeated rows only."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`")))


def without(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``docs`` but the rows whose ``row_key`` is in the one column of ``keys``,
    which is written first: Spark then knows its size and broadcasts it if small."""
    name = f"key_{uuid.uuid4().hex}"
    dropped = materialize(keys.toDF(name).distinct(), "dropped-rows")
    return docs.join(dropped, row_key(id_col, text_col) == dropped[name], "left_anti")


def spread(df: DataFrame) -> int:
    """Partitions of a shuffle as the session sets them."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that one slice holds about ``max_bytes`` of ``column``
    (always at least one row). Memory that a slice needed goes back before the
    next one."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > max_bytes:
            yield batch.slice(start, i - start)
            pa.default_memory_pool().release_unused()
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()


def file_system(uri: str):
    """(file system, path) of a URI or plain path, for use inside tasks."""
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return fs.LocalFileSystem(), uri


def new_file(folder: str, stem: str, suffix: str) -> str:
    """A name no other task attempt uses. A file counts only once the row that
    names it has been committed by Spark, so a lost or repeated attempt leaves
    an orphan at worst."""
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    system, path = file_system(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    system, path = file_system(uri)
    return system.open_input_file(path)


def to_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema)], schema=schema)
