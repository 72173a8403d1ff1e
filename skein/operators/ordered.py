"""Ordered stream operators over a DataFrame with an explicit order column.

The Python original is a pull-based iterator with an implicit order; here the
order is a column (``pos``) and each operator is expressed without a global sort
wherever the semantics allow: take/drop select the n-th key by counting and filter
the rows by it, take_while/drop_while need one scalar aggregate, folds are partial
aggregates.
"""

from __future__ import annotations

from functools import reduce as _reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators.indexing import dense_index
from skein.operators.rows import as_col
from skein.operators.selection import equals, nth_key, precedes

_TIE = "_tie"
_STRETCH = 100_000      # copies of one row that a task makes


def split_at(df: DataFrame, n: int, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(the first n rows, the others) in the ascending order of ``keys``, null first.
    The n-th key is selected (see ``selection``) and the rows are filtered by it; of
    rows with that very key, which must be the same throughout, as many as are left
    go to either side."""
    n = max(int(n), 0)
    if n == 0:
        return df.limit(0), df
    cut = nth_key(df.select(*keys), n)
    if cut is None:
        return df, df.limit(0)
    columns = [F.col(f"`{k}`") for k in keys]
    before, here = precedes(columns, cut.key), equals(columns, cut.key)
    ours = n - cut.before
    if ours == cut.same:
        return df.where(before | here), df.where(~before & ~here)
    same = df.where(here)
    return (df.where(before).unionByName(_copies(same, ours)),
            df.where(~before & ~here).unionByName(_copies(same, cut.same - ours)))


def _copies(rows: DataFrame, n: int) -> DataFrame:
    """``n`` of ``rows``, which are all the same: one of them, multiplied in stretches
    that are dealt out, so no task holds them all."""
    last = (n - 1) // _STRETCH
    size = F.when(F.col(_TIE) == last, n - last * _STRETCH).otherwise(_STRETCH).cast("int")
    one = rows.limit(1).withColumn(_TIE + "s", F.explode(F.sequence(F.lit(0), F.lit(last))))
    one = one.drop(_TIE).withColumnRenamed(_TIE + "s", _TIE).repartition(F.col(_TIE))
    return one.withColumn(_TIE, F.explode(F.array_repeat(F.lit(0).cast("long"), size)))


def _parts(df: DataFrame, n: int, order: str) -> tuple[DataFrame, DataFrame]:
    """(the first n rows, the others) in the order of (position, what the row
    holds), null positions first: the same way for every n."""
    tied = df.withColumn(_TIE, F.xxhash64(*[F.col(c) for c in df.columns]))
    first, rest = split_at(tied, n, [order, _TIE])
    return first.drop(_TIE), rest.drop(_TIE)


def take(df: DataFrame, n: int, order: str = "pos") -> DataFrame:
    """First n rows in stream order (L1); n <= 0 gives no rows."""
    return _parts(df, n, order)[0]


def drop(df: DataFrame, n: int, order: str = "pos") -> DataFrame:
    """All but the first n rows (L2)."""
    return _parts(df, n, order)[1]


def _stop(df: DataFrame, predicate, order: str) -> Column:
    """Position of the first row where the predicate does not hold (null = not)."""
    fails = ~F.coalesce(as_col(predicate), F.lit(False))
    return df.where(fails).agg(F.min(order)).scalar()


def take_while(df: DataFrame, predicate, order: str = "pos") -> DataFrame:
    """Longest prefix on which the predicate holds (L3)."""
    stop = _stop(df, predicate, order)
    return df.where(stop.isNull() | (F.col(order) < stop))


def drop_while(df: DataFrame, predicate, order: str = "pos", as_coded: bool = False) -> DataFrame:
    """Skip the prefix on which the predicate holds (L4). ``as_coded=True`` gives the
    original's effect, which drops every matching row, not only the prefix."""
    if as_coded:
        return df.where(~F.coalesce(as_col(predicate), F.lit(False)))
    stop = _stop(df, predicate, order)
    return df.where(F.col(order) >= stop)


def concat(*dfs: DataFrame, source: str = "src") -> DataFrame:
    """Streams one after another, duplicates kept (S1): the source ordinal is
    the leading order key, ahead of each stream's own ``pos``."""
    tagged = [d.withColumn(source, F.lit(i)) for i, d in enumerate(dfs)]
    return _reduce(lambda a, b: a.unionByName(b), tagged)


def distinct_first(df: DataFrame, cols: Sequence[str], order: str = "pos") -> DataFrame:
    """Distinct values with the position of their first occurrence."""
    return df.groupBy(*cols).agg(F.min(order).alias("first_pos"))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


_ASSOC = {
    "sum": F.sum, "min": F.min, "max": F.max, "count": F.count,
    "product": F.product, "any": F.bool_or, "all": F.bool_and,
}


def reduce(df: DataFrame, value, op: str = "sum", seed=None,
           keys: Sequence[str] = (), name: str = "result") -> DataFrame:
    """Fold with an associative operator, optional seed.

    Runs as a partial + final aggregate. Without a seed an empty input gives
    NULL (the original raises); with a seed the seed is folded in first.
    """
    agg = _ASSOC[op](as_col(value))
    if seed is not None:
        seed_c = F.lit(seed)
        if op == "sum":
            agg = seed_c + F.coalesce(agg, F.lit(0))
        elif op == "product":
            agg = seed_c * F.coalesce(agg, F.lit(1))
        elif op in ("min", "max"):
            agg = (F.least if op == "min" else F.greatest)(seed_c, agg)
        else:
            raise ValueError(f"seed unsupported for {op}")
    return df.groupBy(*keys).agg(agg.alias(name))


def to_dict_last(df: DataFrame, key, value, order: str = "pos") -> DataFrame:
    """Key -> value of the latest row with that key (E11), a partial aggregate."""
    return df.groupBy(as_col(key).alias("key")).agg(F.max_by(as_col(value), F.col(order)).alias("value"))


def to_dict_merge(df: DataFrame, key, value, merge: str = "sum", order: str = "pos") -> DataFrame:
    """Key -> fold of its values with an associative merge (E12); 'first' and
    'last' keep the earliest / latest value."""
    v = as_col(value)
    if merge == "first":
        agg = F.min_by(v, F.col(order))
    elif merge == "last":
        agg = F.max_by(v, F.col(order))
    else:
        agg = _ASSOC[merge](v)
    return df.groupBy(as_col(key).alias("key")).agg(agg.alias("value"))


def to_set(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct elements; the result stays distributed."""
    return df.select(*cols).distinct()


def to_list(df: DataFrame, value, order: str = "pos", name: str = "value") -> DataFrame:
    """Ordered list as (index, value) rows with a dense index."""
    return dense_index(df.select(F.col(order), as_col(value).alias(name)), order, "index") \
        .select("index", name)


def to_string(df: DataFrame, value, sep: str = "", order: str = "pos") -> DataFrame:
    """Joined text as ordered (index, piece) rows (E15): concatenating the
    pieces in index order gives ``sep.join(map(str, values))``. Writing them
    with :func:`skein.sources.sinks.write_ordered_text` produces the text
    without any single task holding it."""
    listed = to_list(df, as_col(value).cast("string"), order, "value")
    last = listed.agg(F.max("index")).scalar()
    return listed.select("index", F.when(F.col("index") < last, F.concat(F.col("value"), F.lit(sep)))
                         .otherwise(F.col("value")).alias("piece"))
