"""Hot keys: what is repeated and broadcast follows their share, and results stay exact."""

import random

import pytest
from pyspark.sql import functions as F

from skein.operators import skew as K


@pytest.fixture
def many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda p: spark.conf.set("spark.sql.shuffle.partitions", str(p))
    spark.conf.set("spark.sql.shuffle.partitions", old)


def rows_of(n, hot_keys, rng):
    """Half of the rows are shared out among the hot keys, and one more has a third."""
    out = []
    for pos in range(n):
        x = rng.random()
        key = "third" if x < 0.33 else f"h{rng.randrange(hot_keys)}" if x < 0.8 else None if x < 0.85 else f"c{pos}"
        out.append((pos, key, rng.randrange(1000)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("p", [16, 2000])
def test_repeats_and_bounds_follow_the_share(spark, many_partitions, p):
    many_partitions(p)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8")
    try:
        rng = random.Random(p)
        rows = rows_of(20_000, max(1, p // 4), rng)
        df = spark.createDataFrame(rows, "pos long, k string, v int").coalesce(4)
        places = {r["_hot_key"]: r["_places"] for r in K.hot_table(df, "k").collect()}
        assert len(places) <= p and sum(places.values()) <= 2 * p
        assert abs(places["third"] - 0.33 * p) <= 0.02 * p + 1
        tagged = K.bucketed(df, "k")
        sizes = {(r["k"], r["_bucket"]): r["n"] for r in
                 tagged.groupBy("k", "_bucket").agg(F.count("*").alias("n")).collect()}
        third = [n for (k, b), n in sizes.items() if k == "third"]
        assert sum(b >= 0 for _, b in sizes) <= 2 * p
        # about equal buckets, and in order of position
        assert len(third) >= 0.9 * places["third"] and max(third) <= 4 * 20_000 / p + 10
        got = sorted((r["pos"], r["_bucket"]) for r in tagged.where("k = 'third'").collect())
        assert [b for _, b in got] == sorted(b for _, b in got)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@pytest.mark.parametrize("p", [1, 5, 64])
def test_search_and_facts_are_exact(spark, many_partitions, p):
    many_partitions(p)
    rng = random.Random(p)
    rows = rows_of(3000, 3, rng)
    df = spark.createDataFrame(rows, "pos long, k string, v int")
    seen, least, follow, best = {}, {}, {}, {}
    for pos, k, v in sorted(rows):
        if k in follow:
            seen[follow[k]] = pos
        follow[k] = pos
        best[k] = max(best.get(k, -1), v if v % 3 else -1)
        least[pos] = best[k] if best[k] >= 0 else None
    up = K.before_in_key(df, "k", F.when(F.col("v") % 3 != 0, F.col("v")), "pos", name="best")
    assert {r["pos"]: r["best"] for r in up.collect()} == least
    after = K.next_in_key(df.select("pos", "k"), "k", "pos", "after")
    assert {r["pos"]: r["after"] for r in after.collect()} == {pos: seen.get(pos) for pos, _, _ in rows}
    facts = df.groupBy(F.col("k").alias("g")).agg(F.count("*").alias("n"))
    size = {}
    for _, k, _ in rows:
        size[k] = size.get(k, 0) + 1
    joined = K.join_facts(df, facts, "k", "g").collect()
    assert len(joined) == len(rows) and all(r["n"] == size[r["k"]] for r in joined)
