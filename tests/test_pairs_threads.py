"""Pairing and thread reconstruction against the Python models."""

import os
import random
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

import models as M
from skein.operators import pairs as PR
from skein.operators import stats as ST
from skein.operators import threads as TH
sys.path.insert(0, os.path.dirname(__file__))
from plan_check import rows_scanned  # noqa: E402

SCHEMA = "pos long, id string, parent_id string, author string, body string"


def frame(spark, rows):
    return spark.createDataFrame([(r["pos"], r["id"], r["parent_id"], r.get("author", "a"), r["body"])
                                  for r in rows], SCHEMA)


def comment(pos, cid, parent, body=None):
    return {"pos": pos, "id": cid, "parent_id": parent, "body": body or f"b{pos}", "author": "a"}


def random_forest(seed, n=40, dup=False, unsorted=True):
    rnd = random.Random(seed)
    ids = [f"c{i}" for i in range(n)]
    rows = []
    for pos in range(n):
        cid = ids[rnd.randrange(n)] if dup and rnd.random() < 0.15 else ids[pos]
        r = rnd.random()
        if r < 0.25:
            parent = f"t3_p{rnd.randrange(5)}"
        elif r < 0.3:
            parent = "t1_" + cid  # self-parent
        else:
            lim = n if unsorted else max(pos, 1)
            parent = "t1_" + ids[rnd.randrange(lim)]
        rows.append(comment(pos, cid if rnd.random() > .05 else None, parent if rnd.random() > .05 else None))
    return rows


def test_reference_tree(spark):
    # post 1 (absent); comments 2, 3 on it; 4 on 2
    rows = [comment(0, "c2", "t3_1"), comment(1, "c3", "t3_1"), comment(2, "c4", "t1_c2")]
    df = frame(spark, rows)
    assert [(r.id, r.parent_id) for r in PR.list_pairs(df).collect()] == [("c4", "c2")]
    assert PR.record_pairs(df).count() == 0  # c2 is not itself a reply


def test_key_and_strict(spark):
    df = spark.createDataFrame([("t3_x_cy",), ("t3_c1",), ("noscore",)], "p string")
    got = [r.k for r in df.select(PR.parent_key("p").alias("k")).collect()]
    assert got == ["x_cy", "c1", "noscore"]
    with pytest.raises(Exception):
        df.select(PR.parent_key("p", strict=True)).collect()


@pytest.mark.parametrize("seed,dup", [(1, False), (2, True), (3, True), (4, False)])
def test_pairs_match_models(spark, seed, dup):
    rows = random_forest(seed, dup=dup)
    df = frame(spark, rows)
    assert Counter(M.list_pairs(rows)) == Counter((r.id, r.parent_id) for r in PR.list_pairs(df).collect())
    assert Counter(M.record_pairs(rows)) == Counter(
        (r.pos, r.p_pos) for r in PR.record_pairs(df).collect())
    keyed = [dict(r, parent_id=M.key(r["parent_id"])) for r in rows]
    kdf = PR.modify_parent_id(df)
    assert Counter(M.verified_pairs(keyed)) == Counter(
        (r.id, r.parent_id) for r in PR.verified_pairs(kdf).collect())
    assert Counter(M.body_pairs(keyed)) == Counter(
        (r.parent_body, r.reply_body) for r in PR.body_pairs(kdf).collect())
    got = PR.extract_pairs(df, pre_filter=lambda: F.lit(True), transform=lambda d: d)
    assert Counter(M.two_phase(keyed)) == Counter((r.parent_body, r.reply_body) for r in got.collect())


def test_duplicate_parent_versions(spark):
    # parent c1 at 1 and 5, children at 3 and 7: bodies of version 1, then 5
    rows = [comment(1, "c1", "t3_p", "v1"), comment(3, "c2", "t1_c1", "r3"),
            comment(5, "c1", "t3_p", "v5"), comment(7, "c3", "t1_c1", "r7")]
    kdf = PR.modify_parent_id(frame(spark, rows))
    got = sorted((r.pos, r.parent_body) for r in PR.body_pairs(kdf).collect())
    assert got == [(3, "v1"), (7, "v5")]
    assert PR.verified_pairs(kdf).count() == 2


def display(thr):
    return [(r.pos, r.root_pos, r.level) for r in thr.orderBy("root_pos", "rank").collect()]


@pytest.mark.parametrize("seed,dup", [(11, False), (12, True), (13, True)])
def test_threads_match_display(spark, seed, dup):
    rows = random_forest(seed, n=40, dup=dup, unsorted=True)
    got = TH.threads(frame(spark, rows)).collect()
    got.sort(key=lambda r: (r.root_pos, r.rank))
    assert [(r.pos, r.root_pos, r.level) for r in got] == M.conversations(rows)
    for k, n in Counter(r.root_pos for r in got).items():
        assert [r.rank for r in got if r.root_pos == k] == list(range(n))


def test_repeated_ids_do_not_multiply(spark):
    rows = [comment(i, f"c{i % 3}", f"t1_c{(i + 1) % 3}") for i in range(12)]
    thr = TH.threads(frame(spark, rows))
    assert display(thr) == M.conversations(rows) and thr.count() == 12


def test_thread_cycle_and_transcript(spark):
    rows = [comment(0, "c5", "t1_c6", "x"), comment(1, "c6", "t1_c5", "  y  z ")]
    thr = TH.threads(frame(spark, rows))
    assert [(r.id, r.level, r.root_id) for r in thr.orderBy("rank").collect()] == \
        [("c5", 0, "c5"), ("c6", 1, "c5")]
    lines = [r.line for r in TH.transcript(thr).orderBy("rank").collect()]
    assert lines == ["- c5, a:\n  x", "    - c6, a:\n      y z"]
    assert TH.limit_conversations(thr, 1).count() == 2


def test_deep_and_wide_threads(spark):
    """A chain of 100,000 replies, and a comment with 20,000 direct replies."""
    deep, wide = 100_000, 20_000
    chain = spark.range(deep).selectExpr("id AS pos", "concat('c', id) AS id",
                                         "if(id = 0, 't3_p', concat('t1_c', id - 1)) AS parent_id")
    star = spark.range(wide).selectExpr("id + 1000000 AS pos", "concat('d', id) AS id",
                                        "if(id = 0, 't3_p', 't1_d0') AS parent_id")
    thr = TH.threads(chain.union(star))
    assert thr.count() == deep + wide
    wrong = thr.where("""(root_pos = 0 AND (rank != pos OR level != pos)) OR
                         (root_pos = 1000000 AND (rank != pos - 1000000 OR level != if(pos = 1000000, 0, 1)))""")
    assert wrong.count() == 0 and {r.root_pos for r in thr.select("root_pos").distinct().collect()} == {0, 1000000}


def test_group_by_parent_keeps_rows_without_one(spark):
    rows = [comment(0, "c1", None), comment(1, "c2", None), comment(2, "c3", "t3_p")]
    got = sorted((r.pos, r.n, r.first_pos) for r in TH.group_by_parent(frame(spark, rows)).collect())
    assert got == [(0, 2, 0), (1, 2, 0), (2, 1, 2)]


def hot_rows(spark, n=3000):
    """Two thirds of the replies are to one parent, which has many versions."""
    return spark.range(n).selectExpr(
        "id AS pos", "if(id % 5 = 0, 'c0', concat('c', id)) AS id",
        "if(id % 3 < 2, 't1_c0', concat('t1_c', id div 7 * 5)) AS parent_id", "'a' AS author",
        "concat('b', id) AS body", "if(id % 3 < 2, 'g', concat('g', id)) AS subreddit_id",
        "if(id = 1500, 'renamed', 'name') AS subreddit")


def biggest_share(df, *keys):
    n = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return n[0] / n[1]


def test_hot_keys_are_split_everywhere(spark):
    from skein.operators import skew
    from skein.operators.stats import inconsistent_names
    df = hot_rows(spark)
    rows = [r.asDict() for r in df.collect()]
    kdf = PR.modify_parent_id(df)
    keyed = [dict(r, parent_id=M.key(r["parent_id"])) for r in rows]
    p = skew.partitions(df)
    # the parts that windows and joins see: none holds much more than 1/P of the rows
    assert biggest_share(kdf, "parent_id") > 0.6
    assert biggest_share(skew.bucketed(kdf, "parent_id"), "parent_id", skew.BUCKET) < 1.3 / p
    versions = {}
    for r in keyed:
        versions.setdefault(r["id"], []).append(r["pos"])

    def latest(cid, pos, inclusive):
        return max((v for v in versions.get(cid, []) if v < pos or inclusive and v == pos), default=None)

    got = {r.pos: r.parent_pos for r in PR.body_pairs(kdf).collect()}
    want = {r["pos"]: latest(r["parent_id"], r["pos"], True) for r in keyed}
    assert got == {k: v for k, v in want.items() if v is not None}
    assert sorted(r.pos for r in PR.verified_pairs(kdf).collect()) == \
        sorted(r["pos"] for r in keyed if latest(r["parent_id"], r["pos"], False) is not None)
    n = Counter(r["parent_id"] for r in rows)
    assert all(r.n == n[r.parent_id] for r in TH.group_by_parent(df).collect())
    assert [r.pos for r in inconsistent_names(df).collect()] == [1500]
    assert display(TH.threads(df)) == M.conversations(rows)


def test_next_in_key(spark):
    from skein.operators.skew import next_in_key
    df = hot_rows(spark, 900).select("pos", "parent_id")
    got = {r.pos: r.after for r in next_in_key(df, "parent_id", "pos", "after").collect()}
    by = {}
    for r in df.orderBy("pos").collect():
        by.setdefault(r.parent_id, []).append(r.pos)
    assert got == {a: b for v in by.values() for a, b in zip(v, v[1:] + [None])}


@pytest.mark.parametrize("name,most", [("extract", 3), ("body", 3), ("record", 3), ("verified", 1), ("group", 1),
                                       ("names", 1), ("threads", 3)])
def test_reads_of_the_input(spark, tmp_path, name, most):
    """The search reads the keys once (while the pairs are planned); texts are read once
    for either side of a pair."""
    rows = hot_rows(spark)
    rows.write.json(str(tmp_path / "in"))
    df = spark.read.schema(rows.schema).json(str(tmp_path / "in"))
    work = {"extract": lambda: PR.extract_pairs(df), "body": lambda: PR.body_pairs(PR.modify_parent_id(df)),
            "record": lambda: PR.record_pairs(df), "verified": lambda: PR.verified_pairs(PR.modify_parent_id(df)),
            "group": lambda: TH.group_by_parent(df), "names": lambda: ST.inconsistent_names(df),
            "threads": lambda: TH.threads(df)}[name]
    n, read = rows_scanned(spark, lambda: work().count(), "json")
    assert read <= most * rows.count() and n > 0
