"""Row predicates of the comment explorer (null-safe like the Python original)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.text import DELETED
from skein.operators.rows import as_col

def not_deleted(body="body") -> Column:
    """body != '[deleted]'; a null body is kept, as Python's None != '[deleted]' (P3)."""
    return ~as_col(body).eqNullSafe(F.lit(DELETED))


def on_comment(parent_id="parent_id") -> Column:
    """Reply to a comment: '_c' occurs anywhere in parent_id."""
    return F.coalesce(F.instr(as_col(parent_id), "_c") > 0, F.lit(False))


def _measure(text, tokens: bool) -> Column:
    return F.size(as_col(text)) if tokens else F.length(as_col(text))


def min_text_length(n: int, text="body", tokens: bool = False) -> Column:
    """Minimum length: code points of a string, or words once tokenized."""
    return _measure(text, tokens) >= F.lit(n)


def max_text_length(n: int | None, text="body", tokens: bool = False) -> Column:
    """``--max-length``: 0 or None switches the filter off (truthiness test)."""
    if not n:
        return F.lit(True)
    return _measure(text, tokens) <= F.lit(n)


def _listed(values: Iterable[str | None], col: str) -> Column:
    """Whether ``col`` is in the list, as Python's ``in`` says it: never null, and
    a null is listed only if None is."""
    values = list(dict.fromkeys(values))
    known = [v for v in values if v is not None]
    hit = F.col(col).isNotNull() & F.col(col).isin(known) if known else F.lit(False)
    return hit | F.col(col).isNull() if None in values else hit


def keep_groups(df: DataFrame, values: Iterable[str | None], col: str = "subreddit") -> DataFrame:
    """Keep rows whose ``col`` is listed; None in the list keeps nulls (P1). The
    list is part of the plan, of any length, and is pushed to the scan."""
    return df.where(_listed(values, col))


def strip_groups(df: DataFrame, values: Iterable[str | None], col: str = "subreddit") -> DataFrame:
    """Remove rows whose ``col`` is listed; nulls go only if None is listed."""
    return df.where(~_listed(values, col))
