"""The reference's stream and utility test vectors, on DataFrames with ``pos``."""

from pyspark.sql import functions as F

from skein.operators import ordered as O
from skein.operators import rows as R


def ints(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "pos long, v long")


def col(df, c="v", order="pos"):
    return [r[0] for r in df.orderBy(order).select(c).collect()]


def test_map_chain(spark):
    df = ints(spark, range(4))
    assert col(R.map_rows(df, v=(F.col("v") + 3) * 2)) == [6, 8, 10, 12]


def test_compose(spark):
    f = R.compose(lambda c: c + 2, lambda c: c * 3)
    df = ints(spark, range(4))
    assert col(df.select("pos", f(F.col("v")).alias("v"))) == [6, 9, 12, 15]
    assert R.compose()(5) == 5


def test_flat_map_range(spark):
    df = ints(spark, [1, 2, 3])
    out = R.flat_map(df, R.range_array("v"), name="x", keep=["pos"])
    assert [r.x for r in out.orderBy("pos", "elem").collect()] == [0, 0, 1, 0, 1, 2]
    df2 = ints(spark, [2, 5, 0, -1])
    out2 = R.flat_map(df2, R.range_array("v"), name="x", keep=["pos"])
    assert [r.x for r in out2.orderBy("pos", "elem").collect()] == [0, 1, 0, 1, 2, 3, 4]


def test_filter(spark):
    df = ints(spark, range(10))
    assert col(R.filter_rows(df, F.col("v") % 2 == 0)) == [0, 2, 4, 6, 8]


def test_wrap(spark):
    df = spark.createDataFrame([("hello", "c123")], "body string, id string")
    out = R.wrap(F.upper)(df)
    out = R.wrap(lambda c: F.substr(c, F.lit(2)).cast("int"), key="id")(out)
    r = out.first()
    assert (r.body, r.id) == ("HELLO", 123)


def test_peek_and_foreach(spark):
    df = ints(spark, range(10))
    tapped, obs = R.peek(df, n=F.count(F.lit(1)), s=F.sum("v"))
    assert sorted(r.v for r in tapped.collect()) == list(range(10))
    assert obs.get == {"n": 10, "s": 45}


def test_concat(spark):
    out = O.concat(ints(spark, range(2)), ints(spark, range(3)))
    assert [r.v for r in out.orderBy("src", "pos").collect()] == [0, 1, 0, 1, 2]


def test_take(spark):
    assert col(O.take(ints(spark, range(2, 6)), 3)) == [2, 3, 4]
    assert col(O.take(ints(spark, range(10)), 0)) == []
    assert col(O.take(ints(spark, range(3)), 3)) == [0, 1, 2]
    assert col(O.take(ints(spark, range(3)), 4)) == [0, 1, 2]


def test_drop(spark):
    assert col(O.drop(ints(spark, range(10)), 5)) == [5, 6, 7, 8, 9]
    assert col(O.drop(ints(spark, range(3)), 0)) == [0, 1, 2]
    assert col(O.drop(ints(spark, [1, 2, 3]), 3)) == []
    assert col(O.drop(ints(spark, [1, 2, 3]), 4)) == []


def test_take_while_drop_while(spark):
    df = ints(spark, range(10))
    assert col(O.take_while(df, F.col("v") < 5)) == [0, 1, 2, 3, 4]
    assert col(O.drop_while(df, F.col("v") < 3)) == [3, 4, 5, 6, 7, 8, 9]
    # a predicate that turns true again separates the prefix from a filter
    df2 = ints(spark, [1, 2, 9, 1, 2])
    assert col(O.take_while(df2, F.col("v") < 5)) == [1, 2]
    assert col(O.drop_while(df2, F.col("v") < 5)) == [9, 1, 2]
    assert col(O.drop_while(df2, F.col("v") < 5, as_coded=True)) == [9]
    assert col(O.take_while(df2, F.col("v") < 100)) == [1, 2, 9, 1, 2]
    assert col(O.drop_while(df2, F.col("v") < 100)) == []


def test_take_and_drop_with_ties_and_nulls(spark):
    """Every n splits the rows the same way: nulls first, ties by what rows hold."""
    rows = [(0, 1), (0, 2), (1, 3), (None, 4), (None, 5), (0, 1), (0, 1)]
    df = spark.createDataFrame(rows, "pos long, v long")
    order = None
    for n in range(9):
        first, rest = ([(r.pos, r.v) for r in f(df, n).collect()] for f in (O.take, O.drop))
        assert len(first) == min(n, 7) and sorted(map(str, first + rest)) == sorted(map(str, rows))
        if order is not None:       # one row more than before
            assert len([x for x in first if first.count(x) > order.count(x)]) <= 3
            assert all(order.count(x) <= first.count(x) for x in order)
        order = first
        key = lambda p: -1 if p is None else p
        assert not first or not rest or max(key(p) for p, _ in first) <= min(key(p) for p, _ in rest)


def test_listed_groups_with_none(spark):
    from skein.functions import predicates as P
    df = spark.createDataFrame([("a",), ("b",), (None,)], "g string")
    for many in ([], [f"x{i}" for i in range(3000)]):
        for values in ([], ["a"], [None], ["a", None]):
            for f, keep in ((P.keep_groups, True), (P.strip_groups, False)):
                got = sorted(str(r.g) for r in f(df, values + many, "g").collect())
                assert got == sorted(str(g) for g in ("a", "b", None) if (g in values) == keep)


def test_ordered_reduce(spark):
    from skein.functions.udfs import grouped_reduce, ordered_reduce
    df = spark.range(5000).selectExpr("id AS pos", "if(id % 7 < 6, 'hot', concat('k', id % 50)) AS k",
                                      "cast(id % 10 AS string) AS v").repartition(5)
    rows = sorted(df.collect(), key=lambda r: r.pos)
    want = {}
    for r in rows:
        want[r.k] = want.get(r.k, "") + r.v
    got = ordered_reduce(df, "v", lambda a, b: a + b, "pos", "string", keys=["k"])
    assert {r.k: r.result for r in got.collect()} == want
    assert ordered_reduce(df, "v", lambda a, b: a + b, "pos", "string").first().result == "".join(r.v for r in rows)
    assert ordered_reduce(df.where("false"), "v", lambda a, b: a + b, "pos", "string").count() == 0
    top = grouped_reduce(df, ["k"], "pos", max, "long")
    assert {r.k: r.result for r in top.collect()} == {k: max(r.pos for r in rows if r.k == k) for k in want}


def test_to_string_count_reduce(spark):
    pieces = O.to_string(ints(spark, range(3)), "v", sep=":")
    assert "".join(r.piece for r in pieces.orderBy("index").collect()) == "0:1:2"
    assert O.count_rows(ints(spark, [2, 3, 4])).first().n == 3
    assert O.reduce(ints(spark, range(3)), "v", "sum").first().result == 3
    assert O.reduce(ints(spark, range(3)), "v", "sum", seed=4).first().result == 7
    empty = ints(spark, range(3)).where("v < 0")
    assert O.reduce(empty, "v", "sum").first().result is None


def test_distinct_first_and_dicts(spark):
    df = ints(spark, [3, 1, 3, 2, 1])
    got = {r.v: r.first_pos for r in O.distinct_first(df, ["v"]).collect()}
    assert got == {3: 0, 1: 1, 2: 3}
    kv = spark.createDataFrame([(0, "a", 1), (1, "b", 2), (2, "a", 3)], "pos long, k string, v long")
    assert {r.key: r.value for r in O.to_dict_last(kv, "k", "v").collect()} == {"a": 3, "b": 2}
    assert {r.key: r.value for r in O.to_dict_merge(kv, "k", "v", "sum").collect()} == {"a": 4, "b": 2}
    assert {r.key: r.value for r in O.to_dict_merge(kv, "k", "v", "first").collect()} == {"a": 1, "b": 2}


def test_dense_index_many_partitions(spark):
    from skein.operators.indexing import dense_index
    df = spark.range(0, 5000).selectExpr("id * 7 % 5003 AS k")
    out = dense_index(df, "k", "i", num_partitions=7)
    got = [r.i for r in out.orderBy("k").collect()]
    assert got == list(range(5000))


def test_foreach_sees_every_element_once(spark):
    acc = spark.sparkContext.accumulator(0)
    seen = spark.sparkContext.accumulator(0)

    def consume(row):
        acc.add(row.v)
        seen.add(1)

    R.foreach_partition(ints(spark, range(10)), consume)
    assert (acc.value, seen.value) == (45, 10)
