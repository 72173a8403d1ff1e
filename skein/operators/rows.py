"""Row-wise operators: map, flat_map, filter, wrap, compose, field selection, taps.

Every operator is DataFrame -> DataFrame (or Column -> Column); none leaves the JVM
unless the caller passes a Python function, which then runs as an Arrow-batched
pandas UDF (see ``skein.functions.udfs``).
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_rows(df: DataFrame, **exprs) -> DataFrame:
    """``Stream.map``: replace or add columns with Column expressions (B1)."""
    return df.withColumns({k: as_col(v) for k, v in exprs.items()})


def filter_rows(df: DataFrame, predicate) -> DataFrame:
    """``Stream.filter``; a null predicate drops the row, as a false one does.
    (WHERE already treats null as false; wrapping it in coalesce would stop
    the predicate from reaching the scan.)"""
    return df.where(as_col(predicate))


def flat_map(df: DataFrame, array_expr, name: str = "value", keep: Iterable[str] = (),
             index_name: str = "elem") -> DataFrame:
    """``Stream.flat_map``: one output row per element of ``array_expr``, in element
    order (B2). The element index is kept so that order survives later shuffles."""
    return explode_rows(df.select(*[as_col(k) for k in keep], as_col(array_expr).alias("_arr")),
                        "_arr", index_name, name)


def explode_rows(df: DataFrame, array_col: str, index_name: str, name: str) -> DataFrame:
    """posexplode that keeps the array expression evaluated once.

    A plain ``posexplode`` makes the optimizer infer ``size(arr) > 0`` and push
    it below the projection, which evaluates the whole array expression (for
    text: every regex) twice. The outer form has no inferred filter; empty
    arrays give one row with a null index, which is dropped here.
    """
    keep = [c for c in df.columns if c != array_col]
    return (df.select(*keep, F.posexplode_outer(array_col).alias(index_name, name))
            .where(F.col(index_name).isNotNull()))


def range_array(n) -> Column:
    """``range(n)`` as an array; empty for n <= 0 (Spark's sequence would count down)."""
    n = as_col(n)
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1)) \
        .otherwise(F.array().cast("array<bigint>"))


def wrap(f: Callable[[Column], Column], key: str = "body") -> Callable[[DataFrame], DataFrame]:
    """Apply a Column function to one field and keep the rest."""
    return lambda df: df.withColumn(key, f(F.col(key)))


def compose(*fs: Callable) -> Callable:
    """Left-to-right composition, ``compose(f, g)(x) == g(f(x))``; empty = identity.
    Works for DataFrame -> DataFrame and Column -> Column functions alike."""
    return lambda x: reduce(lambda acc, f: f(acc), fs, x)


def with_computed(df: DataFrame, expr, name: str = "computed", record: str = "record") -> DataFrame:
    """Pair every row with a computed value: (row, f(row))."""
    return df.select(F.struct(*[F.col(c) for c in df.columns]).alias(record), as_col(expr).alias(name))


def strip_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Drop the named fields; unknown names are ignored."""
    return df.drop(*[f for f in fields if f in df.columns])


def keep_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Keep only the named fields, in the frame's own column order."""
    wanted = set(fields)
    return df.select(*[c for c in df.columns if c in wanted])


def peek(df: DataFrame, name: str = "peek", **metrics) -> tuple[DataFrame, Observation]:
    """Side-effect tap re-aimed as named metrics collected while rows pass.

    Rows are unchanged; ``observation.get`` holds the metrics after the first
    action on the returned frame. Default metric: the row count.
    """
    obs = Observation(name)
    aggs = [as_col(v).alias(k) for k, v in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *aggs), obs


def foreach_partition(df: DataFrame, f: Callable) -> None:
    """Per-row consumer action, run inside the executors as rows arrive."""
    def consume(rows):
        for r in rows:
            f(r)
    df.foreachPartition(consume)
