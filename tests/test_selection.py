"""The n-th key by counting, against a sort; and what it moves."""

import math
import os
import random
import sys
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame

from skein.operators import ordered as O
from skein.operators import selection as S
sys.path.insert(0, os.path.dirname(__file__))
from plan_check import watch  # noqa: E402


def sort_key(row):
    return tuple((v is not None, isinstance(v, float) and math.isnan(v), 0 if v is None or v != v else v) for v in row)


def rows_of(kind, n, rng):
    if kind == "hot":           # one key holds a third, two more a tenth each
        return [(5 if rng.random() < 0.33 else rng.choice([2, 9]) if rng.random() < 0.3 else rng.randrange(10_000),
                 rng.randrange(3)) for _ in range(n)]
    if kind == "null":
        return [(rng.choice([None, None, rng.randrange(500)]), rng.randrange(1000)) for _ in range(n)]
    if kind == "text":
        return [(rng.choice(["", "a", "ß", "z", "\U0001F600", None]) if rng.random() < 0.2 else f"k{rng.randrange(3000)}",
                 rng.randrange(4)) for _ in range(n)]
    if kind == "decimal":
        return [(Decimal(rng.randrange(10**30)), 0) for _ in range(n)]
    return [(rng.choice([float("nan"), float("inf"), rng.gauss(0, 1), rng.gauss(0, 1)]), rng.randrange(5))
            for _ in range(n)]


TYPES = {"hot": "bigint", "null": "int", "text": "string", "decimal": "decimal(38,0)", "float": "double"}


@pytest.mark.parametrize("kind", sorted(TYPES))
def test_nth_key_equals_the_sort(spark, monkeypatch, kind):
    monkeypatch.setattr(S, "SAMPLE", 60)
    rng = random.Random(kind)
    rows = rows_of(kind, 4000, rng)
    df = spark.createDataFrame(rows, f"k {TYPES[kind]}, t int").repartition(3).cache()
    want = sorted(rows, key=sort_key)
    same = Counter(map(sort_key, rows))
    places = {1, 2, len(rows), len(rows) - 1, len(rows) // 2, len(rows) // 3, rng.randrange(1, len(rows))}
    if kind == "hot":       # both ends of the key that holds a third
        ours = [i for i, r in enumerate(want, 1) if r[0] == 5]
        places |= {ours[0], ours[0] - 1, ours[-1], ours[-1] + 1}
    for n in places:
        cut = S.nth_key(df, n)
        key = sort_key(want[n - 1])
        assert sort_key(cut.key) == key
        assert cut.before == sum(c for k, c in same.items() if k < key) and cut.same == same[key]
    assert S.nth_key(df, 0) is None and S.nth_key(df, len(rows) + 1) is None
    df.unpersist()


@pytest.mark.parametrize("n", [0, 1, 37, 400, 999, 1000, 1001, 5000])
def test_take_and_drop_share_the_rows(spark, monkeypatch, n):
    monkeypatch.setattr(S, "SAMPLE", 50)
    monkeypatch.setattr(O, "_STRETCH", 7)
    rows = [(None if i % 50 == 0 else i // 4, "same" if i % 4 else f"x{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "pos int, v string")
    first, rest = O.take(df, n), O.drop(df, n)
    assert first.columns == rest.columns == df.columns
    a, b = [tuple(r) for r in first.collect()], [tuple(r) for r in rest.collect()]
    assert len(a) == min(n, len(rows)) and Counter(a) + Counter(b) == Counter(rows)
    if a and b:
        assert max(map(sort_key, [r[:1] for r in a])) <= min(map(sort_key, [r[:1] for r in b]))


def test_rows_that_are_all_the_same(spark, monkeypatch):
    monkeypatch.setattr(O, "_STRETCH", 100)
    df = spark.createDataFrame([(1, "x")] * 1234 + [(0, "y"), (2, "z")], "pos int, v string")
    assert Counter(map(tuple, O.take(df, 700).collect())) == {(0, "y"): 1, (1, "x"): 699}
    assert Counter(map(tuple, O.drop(df, 700).collect())) == {(1, "x"): 535, (2, "z"): 1}


def test_keys_are_not_shuffled_and_few_are_read(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLE", 500)
    seen = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(collect(self)) or seen[-1])
    df = spark.range(0, 300_000, 1, 8).selectExpr("(id * 7919) % 300007 AS pos", "id")
    part, plans = watch(spark, lambda: [O.take(df, n).agg({"pos": "max"}).first()[0] for n in (100, 150_000)])
    want = sorted((i * 7919) % 300007 for i in range(300_000))
    assert part == [want[99], want[149_999]]
    for plan in plans:      # one row of counts a task, and nothing else, goes through an exchange
        assert "rangepartitioning" not in plan and "hashpartitioning" not in plan
        assert "Sort " not in plan and "InMemory" not in plan and "LogicalRDD" not in plan
    assert sum(map(len, seen)) < 12 * 500       # of 600,000 keys


def test_no_round_reads_more_than_its_sample(spark, monkeypatch):
    """A bracket is closed on both sides: what lies behind it is not read."""
    monkeypatch.setattr(S, "SAMPLE", 2000)
    seen = []
    df = spark.range(0, 100_000, 1, 4).selectExpr("(id * 7919) % 100003 AS pos")
    kind = type(df)         # the class that holds collect
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: seen.append(collect(self)) or seen[-1])
    want = sorted((i * 7919) % 100003 for i in range(100_000))
    for n in (1000, 50_000):
        assert S.nth_key(df, n) == ((want[n - 1],), n - 1, 1)
    assert seen and max(map(len, seen)) < 1.25 * 2000


def test_a_stretch_of_a_stream_split(spark):
    from skein.operators.features import train_val_split
    df = spark.range(1, 1004).withColumnRenamed("id", "index")
    got = Counter(r["split"] for r in train_val_split(df, seed=3).collect())
    assert got == {"validation": 101, "train": 902}
