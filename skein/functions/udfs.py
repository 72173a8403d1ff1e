"""User functions for the stream API's callables.

Built-in Column functions are always preferred; these are the fallbacks when a
caller hands over plain Python. All of them move data in Arrow batches.
"""

from __future__ import annotations

from typing import Callable, Iterable

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


FAN = 16        # neighbouring partials that are folded together
ELEMENTS = 1 << 16      # of a flat map that leave a task together


def scalar(f: Callable, return_type: str) -> Callable[..., Column]:
    """Per-value Python function as an Arrow-batched pandas UDF (U1): the
    map/filter/wrap callable of the original, applied to whole batches."""
    @pandas_udf(return_type)
    def run(s: pd.Series) -> pd.Series:
        return s.map(f)
    return run


def vectorized(f: Callable[[pd.Series], pd.Series], return_type: str) -> Callable[..., Column]:
    """A function that already works on a whole pandas Series (U1, fast path)."""
    return pandas_udf(f, return_type)


def table_function(f: Callable[..., Iterable], element_type: str = "bigint"):
    """Python flat_map callable as an Arrow UDTF (U2): one output row per produced
    element, with its index; use with ``df.lateralJoin(tf(col.outer()))``."""
    @udtf(returnType=f"elem int, value {element_type}", useArrow=True)
    class _FlatMap:
        def eval(self, x):
            for i, v in enumerate(f(x)):
                yield i, v
    return _FlatMap


def flat_map_rows(df: DataFrame, f: Callable[..., Iterable], column: str, element_type: str = "bigint") -> DataFrame:
    """Python flat_map callable over a column, a batch of rows at a time (U2): the
    columns of ``df`` with one row for each element, and its index (``elem``, ``value``).
    A table function is called, and its rows are joined, once for each row; this calls
    ``f`` alone. Elements go on ``ELEMENTS`` at a time, however many a row has."""
    kind = to_arrow_schema(StructType.fromDDL(f"value {element_type}")).field(0).type

    def run(batches):
        for batch in batches:
            at, elem, values = [], [], []

            def made():
                kept = batch.take(pa.array(at, pa.int64()))
                return pa.RecordBatch.from_arrays([*kept.columns, pa.array(elem, pa.int32()), pa.array(values, kind)],
                                                  names=[*batch.schema.names, "elem", "value"])

            for row, x in enumerate(batch.column(batch.schema.names.index(column)).to_pylist()):
                for i, v in enumerate(f(x)):
                    at.append(row)
                    elem.append(i)
                    values.append(v)
                    if len(at) == ELEMENTS:
                        yield made()
                        at, elem, values = [], [], []
            if at:
                yield made()

    return df.mapInArrow(run, StructType([*df.schema.fields, *StructType.fromDDL(f"elem int, value {element_type}").fields]))


def _fold_runs(df: DataFrame, keys: list[str], value: str, f: Callable, schema: str,
               extra: Callable[[], dict]) -> DataFrame:
    """Fold each run of equal keys of a partition, in row order and a batch at a
    time, to one row; ``extra`` gives further columns of the partial."""
    def fold(batches):
        key = acc = None
        for batch in batches:
            columns = [batch.column(batch.schema.names.index(k)).to_pylist() for k in keys]
            for k, v in zip(zip(*columns) if keys else [()] * batch.num_rows,
                            batch.column(batch.schema.names.index(value)).to_pylist()):
                if key is not None and k == key[0]:
                    acc = f(acc, v)
                    continue
                if key is not None:
                    yield row(key[0], acc)
                key, acc = (k,), v
        if key is not None:
            yield row(key[0], acc)

    def row(k, acc):
        return pa.RecordBatch.from_pylist([dict(zip(keys, k)) | extra() | {value: acc}], schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(fold, schema)


def ordered_reduce(df: DataFrame, value: str, f: Callable, order: str, return_type: str,
                   keys: Iterable[str] = (), name: str = "result") -> DataFrame:
    """Fold with an associative Python function in row order, per key (E10, U3);
    the function need not be commutative.

    Rows are range-partitioned by (keys, order), so a key with very many rows is
    cut into consecutive stretches; a task folds its stretches as they stream by.
    The partials (one per key and task) are then folded in order, ``FAN`` neighbours
    at a time, level by level, so no task folds more than ``FAN`` partials of a key.
    Without keys the whole input is one key. No rows give no result for a key, and no
    row at all without keys.
    """
    keys = list(keys)
    typed = df.select(*keys, F.col(order).alias("_order"), F.col(value).cast(return_type).alias("_value"))
    key_types = "".join(f"`{k}` {typed.schema[k].dataType.simpleString()}, " for k in keys)

    def part() -> dict:
        return {"_part": TaskContext.get().partitionId()}

    # a row without an order comes first, as in a sort
    stretches = _fold_runs(typed.repartitionByRange(*keys, "_order").sortWithinPartitions(*keys, "_order"),
                           keys, "_value", f, f"{key_types}_part int, _value {return_type}", part)
    level, parts = stretches, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while parts > 1:
        parts = -(-parts // FAN)
        near = level.withColumn("_group", F.floor(F.col("_part") / FAN).cast("int"))
        level = _fold_runs(near.repartition(*keys, "_group").sortWithinPartitions(*keys, "_group", "_part"),
                           [*keys, "_group"], "_value", f, f"{key_types}_group int, _value {return_type}", dict)
        level = level.withColumnRenamed("_group", "_part")
    return level.drop("_part").withColumnRenamed("_value", name)


def grouped_reduce(df: DataFrame, keys: list[str], value: str, f: Callable, return_type: str,
                   name: str = "result") -> DataFrame:
    """Associative and commutative user reduction per key (U3): each task folds its
    rows to one partial per key it holds (at most one per distinct key of a
    batch at a time), and the partials are folded per key."""
    typed = df.select(*keys, F.col(value).cast(return_type).alias("_value"))
    key_types = "".join(f"`{k}` {typed.schema[k].dataType.simpleString()}, " for k in keys)
    schema = f"{key_types}_value {return_type}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def combine(batches):
        for batch in batches:       # a batch is bounded, and so are its keys
            acc: dict = {}
            for *k, v in zip(*[c.to_pylist() for c in batch.columns]):
                k = tuple(k)
                acc[k] = f(acc[k], v) if k in acc else v
            yield pa.RecordBatch.from_pylist([dict(zip(keys, k)) | {"_value": v} for k, v in acc.items()],
                                             schema=arrow)

    partial = typed.mapInArrow(combine, schema)
    together = partial.repartition(*keys).sortWithinPartitions(*keys)
    return _fold_runs(together, keys, "_value", f, schema, dict).withColumnRenamed("_value", name)
