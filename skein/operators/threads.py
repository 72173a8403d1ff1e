"""Thread reconstruction without the quadratic list scan.

Display rule (a depth-first print): conversations start in stream order; a
comment's conversation root is the ancestor-or-self with the smallest position
(on sorted input, the comment whose parent is absent; a reply seen before its
parent starts its own conversation; a cycle is entered at its earliest member);
replies follow depth-first, siblings in stream order. Rows are told apart by
position: of rows that share an id, replies answer the first.

All steps double pointers, so the number of Spark rounds grows with the logarithm
of the conversation size, and every state has a fixed width:

1. parents: each row's parent key becomes the position of that parent (hot parents
   are split, ``skew``).
2. roots: every node keeps (jump target, best ancestor so far); each round joins
   the nodes that still jump with their targets, keeps the smaller best, and
   doubles the jump, until no jump is left or a round changes nothing (a fixpoint,
   which also ends cycles).
3. order: edges above roots are cut, which leaves trees. A walk around a tree
   enters and leaves each node once; entering counts 1 towards the rank and 1
   towards the level, leaving -1 towards the level. Each step knows its next step;
   doubling those pointers gives every step's sums to the end of the walk, and so
   rank and level, without any list of ancestors.

Each round is written to the shared folder, so the lineage stays short and a lost
executor costs one round. Steps that are done leave the rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from skein.functions.text import trim_whitespace
from skein.operators.pairs import parent_key
from skein.operators.skew import join_facts, next_in_key
from skein.session import staged

MAX_ROUNDS = 64  # 2**64 exceeds any size; reaching it means a bug, not deep data


def _parents(df: DataFrame) -> DataFrame:
    """(pos, up): the position of the first row with the parent's id, or null."""
    keys = staged(df.select("pos", "id", parent_key("parent_id").alias("_k")), "thread-keys")
    first = keys.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("_id")).agg(F.min("pos").alias("up"))
    return join_facts(keys.select("pos", "_k"), first, "_k", "_id").select("pos", "up")


def _doubled(state: DataFrame, name: str, step, active: str) -> DataFrame:
    """Apply ``step(moving, targets)`` to the rows where ``active`` holds until
    none is left; the others are kept as they are. ``step`` returns the moved rows
    and a column ``_changed``; a round in which none changed ends the work."""
    done: list[DataFrame] = []
    active_col = F.expr(active)

    def written(rows: DataFrame) -> tuple[DataFrame, dict]:
        """The round's rows, counted while they are written."""
        seen = Observation()
        out = staged(rows.observe(seen, F.count_if(active_col).alias("left"),
                                  F.count_if("_changed").alias("changed")), name)
        return out, seen.get

    moving, seen = written(state.withColumn("_changed", F.lit(True)))
    for _ in range(MAX_ROUNDS):
        rows = moving.drop("_changed")
        if not seen["left"] or not seen["changed"]:
            return reduce(DataFrame.unionByName, [*done, rows])
        done.append(rows.where(~active_col))
        going = rows.where(active_col)
        moving, seen = written(step(going, reduce(DataFrame.unionByName, [*done, going])))
    raise RuntimeError(f"{name}: not settled after {MAX_ROUNDS} rounds")


def _roots(parents: DataFrame) -> DataFrame:
    """(pos, up, best): ``best`` is the smallest position of the row and its ancestors."""

    def step(going, targets):
        t = targets.select(F.col("pos").alias("_t"), F.col("jump").alias("_tj"), F.col("best").alias("_tb"))
        # a self-parent or a cycle jumps on for ever: it ends when nothing changes
        return going.join(t, F.col("jump") == F.col("_t")).select(
            "pos", "up", F.col("_tj").alias("jump"), F.least("best", "_tb").alias("best"),
            (F.col("_tj").isNull() | (F.col("_tb") < F.col("best"))).alias("_changed"))

    state = parents.select("pos", "up", F.col("up").alias("jump"), F.col("pos").alias("best"))
    return _doubled(state, "thread-roots", step, "jump IS NOT NULL").select("pos", "up", "best")


def _walk(rooted: DataFrame) -> DataFrame:
    """(pos, root_pos, rank, level) by ranking the walk around every tree."""
    tree = staged(rooted.select("pos", F.col("best").alias("root_pos"),
                                F.when(F.col("best") != F.col("pos"), F.col("up")).alias("up")), "thread-tree")
    kids = tree.where("up IS NOT NULL")
    first = kids.groupBy(F.col("up").alias("_of")).agg(F.min("pos").alias("kid"))
    sibling = next_in_key(kids.select("pos", "up"), "up", "pos", "after").select(F.col("pos").alias("_s"), "after")
    # a step: 2 * pos enters the node, 2 * pos + 1 leaves it
    into = tree.join(first, F.col("pos") == F.col("_of"), "left").select(
        "root_pos", (F.col("pos") * 2).alias("step"),
        F.coalesce(F.col("kid") * 2, F.col("pos") * 2 + 1).alias("next"),
        F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("up"))
    out = tree.join(sibling, F.col("pos") == F.col("_s"), "left").select(
        "root_pos", (F.col("pos") * 2 + 1).alias("step"),
        F.coalesce(F.col("after") * 2, F.col("up") * 2 + 1).alias("next"),
        F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("up"))

    def jump(going, targets):
        t = targets.select(F.col("step").alias("_t"), F.col("next").alias("_tn"), F.col("n").alias("_tc"),
                           F.col("up").alias("_tu"))
        return going.join(t, F.col("next") == F.col("_t")).select(
            "root_pos", "step", F.col("_tn").alias("next"), (F.col("n") + F.col("_tc")).alias("n"),
            (F.col("up") + F.col("_tu")).alias("up"), F.lit(True).alias("_changed"))

    sums = _doubled(into.unionByName(out), "thread-walk", jump, "next IS NOT NULL")
    # sums run from a step to the end of the walk; all levels of a walk cancel out
    entered = sums.where("step % 2 = 0").select((F.col("step") / 2).cast("long").alias("pos"), "root_pos", "n", "up")
    size = entered.where("pos = root_pos").select(F.col("root_pos").alias("_r"), F.col("n").alias("_size"))
    return join_facts(entered, size, "root_pos", "_r", "inner").select(
        "pos", "root_pos", (F.col("_size") - F.col("n")).alias("rank"), (-F.col("up")).alias("level"))


def threads(df: DataFrame) -> DataFrame:
    """Every comment with its conversation root, level and depth-first rank in the
    conversation (T2); as many rows as ``df``.

    Output: root_id, root_pos, id, pos, level, rank, author, body;
    ``orderBy('root_pos', 'rank')`` is the display order. ``pos`` is a unique
    BIGINT under 2^62.
    """
    keep = [c for c in ("id", "author", "body") if c in df.columns]
    placed = staged(_walk(_roots(_parents(df))), "threads")
    roots = df.select(F.col("pos").alias("_rp"), F.col("id").alias("root_id"))
    rows = df.select(F.col("pos").alias("_pos"), *keep)
    named = placed.join(rows, F.col("pos") == F.col("_pos"))
    # the roots by a plain join, whose hot side Spark can split
    return named.join(roots, F.col("root_pos") == F.col("_rp")).select("root_id", "root_pos", "pos", "level", "rank",
                                                                       *keep)


def limit_conversations(thr: DataFrame, limit: int) -> DataFrame:
    """Only the first ``limit`` conversations in stream order (T3); limit <= 0 = all.
    A top-k over roots (bounded by ``limit``) and a semi-join."""
    if limit <= 0:
        return thr
    roots = (thr.where(F.col("pos") == F.col("root_pos")).select("root_pos")
             .orderBy("root_pos").limit(limit))
    return thr.join(roots, "root_pos", "left_semi")


def transcript(thr: DataFrame, show_header: bool = True, clean: bool = True) -> DataFrame:
    """Display text of every comment (T4/T5): 4 spaces per level, '- ', then
    optionally 'id, author:' and a line break with the indentation, then the body."""
    indent = F.repeat(F.lit("    "), F.col("level").cast("int"))
    if isinstance(thr.schema["body"].dataType, ArrayType):
        # a tokenized body prints as a Python list does
        body = F.when(F.size("body") == 0, F.lit("[]")).otherwise(
            F.concat(F.lit("['"), F.array_join("body", "', '"), F.lit("']")))
    else:
        body = trim_whitespace("body") if clean else F.col("body")
    head = F.concat(indent, F.lit("- "))
    if show_header:
        head = F.concat(head, F.coalesce("id", F.lit("None")), F.lit(", "), F.coalesce("author", F.lit("None")),
                        F.lit(":\n  "), indent)
    line = F.concat(head, F.coalesce(body.cast("string"), F.lit("None")))
    return thr.select("root_id", "root_pos", "rank", line.alias("line"))


def group_by_parent(df: DataFrame) -> DataFrame:
    """Comments grouped by parent_id (T1), as member rows with the group's size
    and first position; members are ordered by ``pos``. Rows without a parent_id
    are a group as well. No group is collected into one row or task."""
    rows = staged(df.select("parent_id", "pos", "id"), "members")
    groups = rows.groupBy(F.col("parent_id").alias("_g")).agg(F.count(F.lit(1)).alias("n"),
                                                              F.min("pos").alias("first_pos"))
    return join_facts(rows, groups, "parent_id", "_g").drop("_g")
