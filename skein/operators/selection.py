"""The n-th key of a stream without ranking or shuffling its keys.

A bracket of keys that holds the n-th is narrowed round by round: a sample of the
keys inside it gives two candidates on either side of the wanted rank, one aggregate
counts the rows before, at and between them, and the part that holds the rank is
the next bracket. Once a bracket has no more than ``SAMPLE`` keys they are all read and
the n-th is known exactly. A key that very many rows share ends up as a candidate and
is settled by its count alone.

Nothing is shuffled but one row of counts a task; about ``SAMPLE`` keys a round reach
the driver, whatever n is. Every round narrows the bracket some fifty times and runs
two jobs over the key columns: up to ``SAMPLE`` rows take one round (and the count of
all rows), three million two, 10^12 five.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 50_000
MAX_ROUNDS = 60


class Cut(NamedTuple):
    key: tuple          # values of the key columns
    before: int         # rows before it
    same: int           # rows that have it


def precedes(columns: list[Column], key: tuple) -> Column:
    """Whether a row's key is strictly before ``key``; null comes first in every
    column, as in an ascending sort."""
    out = F.lit(False)
    for c, v in zip(reversed(columns), reversed(key)):
        less = F.lit(False) if v is None else c.isNull() | F.coalesce(c < F.lit(v), F.lit(False))
        out = less | (c.eqNullSafe(F.lit(v)) & out)
    return out


def equals(columns: list[Column], key: tuple) -> Column:
    out = F.lit(True)
    for c, v in zip(columns, key):
        out = out & c.eqNullSafe(F.lit(v))
    return out


def _in_order(key: tuple) -> tuple:
    """Sorts as Spark does: null first, not-a-number last."""
    return tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in key)


def nth_key(keys: DataFrame, n: int) -> Cut | None:
    """The n-th row's key (from 1) in the ascending order of all columns of ``keys``;
    None if there are fewer rows."""
    columns = [F.col(f"`{c}`") for c in keys.columns]
    low = high = None               # the bracket lies strictly between them
    before, inside = 0, keys.count()
    if not 1 <= n <= inside:
        return None
    for attempt in range(MAX_ROUNDS):
        within = F.lit(True)
        if low is not None:
            within = within & ~precedes(columns, low) & ~equals(columns, low)
        if high is not None:
            within = within & precedes(columns, high)
        every = inside <= SAMPLE
        some = keys.where(within if every else within & (F.rand(attempt) < SAMPLE / inside))
        got = sorted((tuple(r) for r in some.collect()), key=_in_order)
        if every:
            key = got[n - before - 1]
            order = [_in_order(k) for k in got]
            first, last = order.index(_in_order(key)), len(order) - order[::-1].index(_in_order(key))
            return Cut(key, before + first, last - first)
        if not got:
            continue
        wanted = (n - before) / inside * len(got)
        slack = 4 * math.sqrt(max(1.0, wanted * (1 - wanted / len(got)))) + 1
        a = got[max(0, math.floor(wanted - slack))]
        b = got[min(len(got) - 1, math.ceil(wanted + slack))]
        one = _in_order(a) == _in_order(b)
        less, at_a, upto, at_b = keys.agg(
            F.count_if(precedes(columns, a)), F.count_if(equals(columns, a)),
            F.count_if(precedes(columns, b)), F.count_if(equals(columns, b))).first()
        if n <= less:
            high, inside = a, less - before
        elif n <= less + at_a:
            return Cut(a, less, at_a)
        elif not one and n <= upto:
            low, high, before, inside = a, b, less + at_a, upto - less - at_a
        elif n <= upto + at_b:
            return Cut(b, upto, at_b)
        else:
            end = before + inside
            low, before = b, upto + at_b
            inside = end - before
    raise RuntimeError(f"no {n}-th key after {MAX_ROUNDS} rounds")
