"""Reply pairing: four different pair semantics, each a shuffle on a key.

The Python original pairs by holding every comment seen so far in a dict; here a
reply finds the position of its parent's latest version on (key, position) rows
(``asof``), where hot parents are split by position, and the texts then meet by
position.
"""

from __future__ import annotations

from typing import Callable, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.predicates import not_deleted, on_comment
from skein.functions.text import trim_whitespace
from skein.operators.asof import asof_join, earlier_version, join_versions, placed_by
from skein.operators.rows import as_col
from skein.session import staged


def parent_key(parent_id="parent_id", strict: bool = False) -> Column:
    """Text after the first '_' of parent_id (J1). Without '_': the whole value,
    or a runtime error when ``strict`` (the original raises there)."""
    p = as_col(parent_id)
    at = F.instr(p, "_")
    key = F.substr(p, at + 1)
    if strict:
        return F.when(at == 0, F.raise_error(F.concat(F.lit("parent_id without '_': "), p))) \
            .otherwise(key)
    return key


def modify_parent_id(df: DataFrame, strict: bool = False) -> DataFrame:
    """Overwrite parent_id with the parent key."""
    return df.withColumn("parent_id", parent_key("parent_id", strict))


def list_pairs(df: DataFrame, keep_parent: bool = False) -> DataFrame:
    """(id, parent) for every reply to a comment; the parent need not exist."""
    parent = F.col("parent_id") if keep_parent else parent_key("parent_id")
    return df.where(on_comment("parent_id")).select("pos", "id", parent.alias("parent_id"))


def verified_pairs(df: DataFrame) -> DataFrame:
    """(id, parent_id) when the parent id occurred at a strictly earlier position.

    ``df`` carries parent keys in ``parent_id`` (see :func:`modify_parent_id`).
    One row per child row even if the parent id repeats: each child asks for the
    latest strictly earlier position of its parent key.
    """
    asked = staged(df.select("pos", "id", "parent_id"), "asked")
    at = earlier_version(asked)
    return asked.join(at.where("_rpos IS NOT NULL"), F.col("pos") == F.col("_lpos"), "left_semi")


def paired_ids(pairs: DataFrame) -> DataFrame:
    """Distinct ids that occur on either side of a pair."""
    return pairs.select(F.explode(F.array("id", "parent_id")).alias("id")).distinct()


def body_pairs(df: DataFrame, payload: str = "body") -> DataFrame:
    """(parent body, reply body): the parent is the latest row with that id at a
    position <= the reply's, the reply row itself included (J7)."""
    out = asof_join(df.select("pos", "id", "parent_id", payload), df.select("pos", payload))
    return _pair_columns(out, payload)


def _pair_columns(out: DataFrame, payload: str) -> DataFrame:
    return out.select(
        F.col("pos"), F.col("id"), F.col("parent_id"), F.col("p_pos").alias("parent_pos"),
        F.col(f"p_{payload}").alias(f"parent_{payload}"), F.col(payload).alias(f"reply_{payload}"))


def preprocess(df: DataFrame,
               pre_filter: Optional[Callable[[], Column]] = None,
               transform: Optional[Callable[[DataFrame], DataFrame]] = None,
               post_filter: Optional[Callable[[], Column]] = None) -> DataFrame:
    """The pair extractor's hooks: filter -> transform -> filter.

    Defaults: drop deleted comments, collapse whitespace in the body, keep all.
    """
    pre = pre_filter() if pre_filter else not_deleted("body")
    out = df.where(pre)
    out = transform(out) if transform else out.withColumn("body", trim_whitespace("body"))
    if post_filter is not None:
        out = out.where(post_filter())
    return out


def extract_pairs(raw: DataFrame, **hooks) -> DataFrame:
    """Two-phase training-pair extraction.

    Phase 1 finds every id that takes part in a verified pair, phase 2 pairs the
    bodies of the comments with these ids. All versions of an id are kept or
    dropped together, and the parent of a verified child is always kept; so phase 2
    finds the parents that the whole input has, and one search serves both phases:
    a child is verified if its parent has a strictly earlier version, and pairs
    with that version or, if it is its own parent, with itself. ``dump_pairs`` writes
    the preprocessed rows first, which spares a text source all but one read.
    """
    return pair_prepared(preprocess(modify_parent_id(raw), **hooks))


def pair_prepared(prep: DataFrame) -> DataFrame:
    """Both phases on preprocessed rows (pos, id, parent_id, body)."""
    keys = staged(prep.select("pos", "id", "parent_id"), "pair-keys")
    placed = placed_by(keys, keys)
    ids = paired_ids(placed.where("_strict IS NOT NULL")).withColumnRenamed("id", "_paired")
    # a child without an id is paired by what it lacks, as None is in a set
    kept = placed.join(ids, F.col("id").eqNullSafe(F.col("_paired")), "left_semi")
    texts = prep.select("pos", "body")
    replies = kept.join(texts.withColumnRenamed("pos", "_own"), F.col("pos") == F.col("_own")).drop("_own")
    return _pair_columns(join_versions(replies, texts), "body")


def record_pairs(df: DataFrame, cols=("id", "parent_id", "author", "body")) -> DataFrame:
    """(child, parent) full records where both are replies to comments.

    The reply filter comes first, so a top-level comment is never a parent;
    the latest earlier-or-same version of the parent wins.
    """
    replies = df.where(on_comment("parent_id")).withColumn("_key", parent_key("parent_id"))
    keep = ["pos", *[c for c in cols if c in df.columns]]
    out = asof_join(replies.select(*keep, "_key"), replies.select(*keep), key="_key")
    return out.select(*keep, *[f"p_{c}" for c in keep])


def count_reply_pairs(df: DataFrame) -> DataFrame:
    """Number of full-record reply pairs among non-deleted comments."""
    return record_pairs(df.where(not_deleted("body"))).agg(F.count(F.lit(1)).alias("n_pairs"))


def direct_replies(df: DataFrame) -> DataFrame:
    """Direct replies of each comment, by parent-key equality."""
    parents = df.select(F.col("id"), F.col("pos"))
    replies = df.select(parent_key("parent_id").alias("_key"), F.col("id").alias("reply_id"),
                        F.col("pos").alias("reply_pos"))
    return parents.join(replies, F.col("id") == F.col("_key")).drop("_key")
