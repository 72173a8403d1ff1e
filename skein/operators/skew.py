"""Splitting hot keys by position, in proportion to their share.

A key that holds a large share of the rows would put them into one task wherever
rows meet by key and AQE cannot split them (windows, joins with an aggregate).
Here a key is hot if it has at least 1/P of all rows, P being the session's
shuffle partitions; there are at most P such keys. A key with the share s of the rows
gets ceil(s * P) buckets or places, so all hot keys together get at most 2P: that
bounds the only tables that are broadcast, rows of a few numbers each, and the rows
that are repeated. Other keys have the single bucket -1. Everything is part of the
plan: no job runs while it is built, and there is no list of keys and no threshold to
set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"
SAMPLE = 20         # positions a bucket that its bounds are taken from


def partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_table(rows: DataFrame, key: str) -> DataFrame:
    """(_hot_key, _places): keys with at least 1/P of the rows, at most P of them, and
    ceil(share * P) for each; null is a key like any other."""
    p = partitions(rows)
    total = rows.agg(F.count(F.lit(1))).scalar()
    counts = rows.groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where((F.col("_n") * p >= total) & (F.col("_n") > 1)).select(
        "_hot_key", F.ceil(F.col("_n") * p / total).cast("int").alias("_places"))


def _mark(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    return rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot_key")), "left").drop("_hot_key")


def bucketed(rows: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """``rows`` with the position bucket of its hot keys: as many buckets of about
    equally many rows as the key has places. Their bounds come from a sample of about
    ``SAMPLE`` positions a place, taken by hash, so that a plan that is computed again
    finds the same ones; there are at most 2P bounds in all."""
    p = partitions(rows)
    if p == 1:
        return rows.withColumn(BUCKET, F.lit(-1))
    total = rows.agg(F.count(F.lit(1))).scalar()
    taken = F.pmod(F.xxhash64(pos), F.lit(1 << 30)) < F.lit(float(SAMPLE * p << 30)) / total
    hot = hot_table(rows, key).where("_places > 1")
    sampled = _mark(rows.where(F.col(pos).isNotNull() & taken).select(key, pos), hot, key).where("_places > 1")
    sampled = sampled.groupBy(F.col(key).alias("_hot_key"), "_places").agg(F.sort_array(F.collect_list(pos)).alias("_s"))
    bounds = F.transform(F.sequence(F.lit(1), F.col("_places") - 1),
                         lambda i: F.get("_s", F.floor(i * F.size("_s") / F.col("_places")).cast("int")))
    marked = _mark(rows, sampled.select("_hot_key", bounds.alias("_bounds")), key)
    place = F.when(F.col("_bounds").isNotNull() & F.col(pos).isNotNull(), _rank("_bounds", pos, p))
    return marked.withColumn(BUCKET, F.coalesce(place, F.lit(-1))).drop("_bounds")


def _rank(bounds: str, pos: str, most: int) -> Column:
    """How many of the ascending ``bounds`` are below ``pos``, by halving: one look-up
    for each power of two up to ``most``."""
    steps, width = [], 1
    while width <= most:
        steps.append(width)
        width *= 2
    steps = F.array(*[F.lit(w) for w in reversed(steps)])

    def advance(at, width):
        return F.when((at + width <= F.size(bounds)) & (F.get(bounds, at + width - 1) < F.col(pos)), at + width) \
            .otherwise(at)

    return F.aggregate(steps, F.lit(0), advance)


def before_in_key(rows: DataFrame, key: str, value: Column, pos: str, *order: Column,
                  name: str) -> DataFrame:
    """Greatest ``value`` at or before each row, in (``pos``, ``order``), among the
    rows of its key; nulls are passed over. A running maximum inside the buckets,
    and the maximum of the key's earlier buckets."""
    tagged = bucketed(rows.withColumn("_value", value), key, pos)
    run = Window.partitionBy(key, BUCKET).orderBy(pos, *order).rowsBetween(Window.unboundedPreceding, 0)
    inside = tagged.withColumn("_inside", F.max("_value").over(run))
    return _with_other_buckets(inside, tagged, key, F.max("_value"), Window.unboundedPreceding, -1, F.max,
                               lambda other: F.greatest("_inside", other), name)


def next_in_key(rows: DataFrame, key: str, pos: str, name: str) -> DataFrame:
    """Position of the next row of the same key (null for the last)."""
    tagged = bucketed(rows, key, pos)
    inside = tagged.withColumn("_inside", F.lead(pos).over(Window.partitionBy(key, BUCKET).orderBy(pos)))
    return _with_other_buckets(inside, tagged, key, F.min(pos), 1, Window.unboundedFollowing, F.min,
                               lambda other: F.coalesce("_inside", other), name)


def _with_other_buckets(inside, tagged, key, of_bucket, start, end, merge, combine, name):
    """Join what a hot key's buckets before or after say: 2P rows at most."""
    facts = (tagged.where(F.col(BUCKET) >= 0).groupBy(F.col(key).alias("_key"), F.col(BUCKET).alias("_b"))
             .agg(of_bucket.alias("_v")))
    others = facts.withColumn("_other", merge("_v").over(
        Window.partitionBy("_key").orderBy("_b").rowsBetween(start, end)))
    others = others.select("_key", "_b", "_other").where("_other IS NOT NULL")
    out = inside.join(others, F.col(key).eqNullSafe(F.col("_key")) & (F.col(BUCKET) == F.col("_b")), "left")
    return out.withColumn(name, combine(F.col("_other"))).drop(
        "_key", "_b", "_other", "_inside", "_value", BUCKET)


def join_facts(rows: DataFrame, facts: DataFrame, key: str, fact_key: str, how: str = "left") -> DataFrame:
    """Join one row of ``facts`` per key to every row (null keys meet as well). The rows
    of a hot key are dealt out over as many places as its share of P asks for, and its
    single fact is repeated there: 2P rows more at most."""
    hot = hot_table(rows, key)
    place = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.col("_places").cast("long")).cast("int")
    salted = _mark(rows, hot, key).withColumn("_salt", F.coalesce(place, F.lit(0))).drop("_places")
    places = F.when(F.col("_places").isNotNull(), F.sequence(F.lit(0), F.col("_places") - 1)) \
        .otherwise(F.array(F.lit(0)))
    repeated = _mark(facts, hot, fact_key).withColumn("_place", F.explode(places)).drop("_places")
    return salted.join(repeated, F.col(key).eqNullSafe(F.col(fact_key)) &
                       (F.col("_salt") == F.col("_place")), how).drop("_salt", "_place")
