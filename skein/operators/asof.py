"""As-of pairing inside one frame: for each row, the latest row whose id is this
row's key, at an earlier position.

First the position of that version is found on (key, position) rows alone, read from
the input once and written: every
row gives one entry as a version (its id) and one as a question (its key), a running
maximum of the version positions answers the questions, and hot keys of either
kind are split by position (``skew``). The payloads then meet in an equi-join on the
position, between two plain shuffles, where AQE can split a version that very many
rows share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.skew import before_in_key
from skein.session import staged


def earlier_version(df: DataFrame, key: str = "parent_id", id_col: str = "id", pos: str = "pos") -> DataFrame:
    """(_lpos, _rpos) for each row with a key: its position and that of the latest
    strictly earlier row whose id is the key (null if there is none). Null ids and
    keys match nothing; positions are unique. The search goes over ``df`` several
    times, so it had better be written (see ``with_version``)."""
    entries = F.array(F.struct(F.col(id_col).alias("k"), F.lit(False).alias("asks")),
                      F.struct(F.col(key).alias("k"), F.lit(True).alias("asks")))
    both = df.select(F.col(pos).alias("_p"), F.explode(entries).alias("_e")).select(
        "_p", F.col("_e.k").alias("_k"), F.col("_e.asks").alias("_asks")).where("_k IS NOT NULL")
    # of one row the question comes before the version
    seen = before_in_key(both, "_k", F.when(~F.col("_asks"), F.col("_p")), "_p", (~F.col("_asks")).cast("int"),
                         name="_rpos")
    return seen.where("_asks").select(F.col("_p").alias("_lpos"), "_rpos")


def asof_join(df: DataFrame, right: DataFrame, key: str = "parent_id", id_col: str = "id", pos: str = "pos",
              inclusive: bool = True, prefix: str = "p_") -> DataFrame:
    """Each row of ``df`` with the columns (under ``prefix``) of its latest version
    in ``right``, the same rows with the columns wanted; rows without one are left
    out. ``inclusive`` lets a row whose id is its own key match itself, as the
    latest version there is."""
    return join_versions(with_version(df, key, id_col, pos, inclusive), right, pos, prefix)


def with_version(df: DataFrame, key: str = "parent_id", id_col: str = "id", pos: str = "pos",
                 inclusive: bool = True) -> DataFrame:
    """``df`` with ``_strict`` (the strictly earlier version's position) and ``_at``
    (the position to pair with; rows without one are left out). Keys and positions
    alone are written for the search."""
    keys = staged(df.select(pos, id_col, key), "pair-keys")
    return placed_by(df, keys, key, id_col, pos, inclusive)


def placed_by(df: DataFrame, keys: DataFrame, key: str = "parent_id", id_col: str = "id", pos: str = "pos",
              inclusive: bool = True) -> DataFrame:
    """``with_version`` of ``df`` by a search in its written ``keys``."""
    placed = df.join(earlier_version(keys, key, id_col, pos).where("_rpos IS NOT NULL"),
                     F.col(pos) == F.col("_lpos"), "left").drop("_lpos").withColumnRenamed("_rpos", "_strict")
    own = F.when(F.col(id_col) == F.col(key), F.col(pos))
    at = F.coalesce(own, F.col("_strict")) if inclusive else F.col("_strict")
    return placed.withColumn("_at", at).where("_at IS NOT NULL")


def join_versions(placed: DataFrame, right: DataFrame, pos: str = "pos", prefix: str = "p_") -> DataFrame:
    versions = right.select(*[F.col(c).alias(f"{prefix}{c}") for c in right.columns])
    return placed.join(versions, F.col("_at") == F.col(f"{prefix}{pos}")).drop("_at", "_strict")
