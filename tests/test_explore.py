"""The explorer plan: stage order and reports."""

import json
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

from skein.operators import stats
from skein.plans.explore import ExploreOptions, explore
from skein.sources.files import read_records
sys.path.insert(0, os.path.dirname(__file__))
from plan_check import rows_scanned  # noqa: E402

SCHEMA = "pos long, id string, parent_id string, subreddit string, subreddit_id string, author string, body string"


def corpus(spark):
    rows = [
        (0, "c1", "t3_p", "a", "t5_a", "u", "Hello  World 42"),
        (1, "c2", "t1_c1", "a", "t5_a", "v", "[deleted]"),
        (2, "c3", "t1_c1", "b", "t5_b", "w", "hello again, world!"),
        (3, "c4", "t1_c3", "A", "t5_a", "u", "x"),
        (4, "c5", "t3_q", "b", "t5_b", "v", "world of words"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_caps_do_not_commute_with_filters(spark):
    o = ExploreOptions(ignore_deleted=True, process_max=2, show_records=True)
    got = [r.id for r in explore(corpus(spark), o)["records"].orderBy("pos").collect()]
    assert got == ["c1", "c3"]  # deleted c2 removed before the cap
    o = ExploreOptions(read_max=2, ignore_deleted=True, show_records=True)
    got = [r.id for r in explore(corpus(spark), o)["records"].orderBy("pos").collect()]
    assert got == ["c1"]  # the read cap comes first


def test_reports(spark):
    o = ExploreOptions(summary=True, count_fields=True, strip_specials=True, strip_digits=True,
                       trim_whitespace=True, to_lower=True, tokenize=True, min_length=2,
                       vocab=True, vocab_order="index", pairs=True, conversations=True)
    out = explore(corpus(spark), o)
    s = out["summary"].first()
    assert (s.comments, s.deleted, s.posts, s.pairs, s.subreddits) == (5, 1, 2, 3, 2)
    groups = [(r.subreddit_id, r.n, r.subreddit) for r in out["summary_groups"].collect()]
    assert groups == [("t5_b", 2, "b"), ("t5_a", 3, "a")]
    assert {r.field: r.n for r in out["fields"].collect()}["body"] == 5
    vocab = [(r.word, r["index"], r["count"]) for r in out["vocab"].collect()]
    assert vocab[:3] == [("hello", 0, 2), ("world", 1, 3), ("again", 2, 1)]  # "[deleted]" is one token: too short
    assert sorted(r.id for r in out["pairs"].collect()) == ["c3"]  # c2 and c4 are too short now
    lines = [r.line for r in out["conversations"].collect()]
    assert lines[:2] == ["- c1, u:\n  ['hello', 'world']", "    - c3, w:\n      ['hello', 'again', 'world']"]
    assert out["count"].first().n == 3  # c1, c3, c5


DUMP = [
    {"id": "c1", "parent_id": "t3_p", "subreddit": "a", "subreddit_id": "t5_a", "author": "u", "body": "Hello  World",
     "distinguished": None, "edited": False, "stickied": False, "new_field": 1},
    {"id": "c2", "parent_id": "t1_c1", "subreddit": "b", "subreddit_id": "t5_a", "author": "v", "body": "[deleted]",
     "distinguished": None, "edited": 1.5, "stickied": True},
    {"id": "c3", "parent_id": "t1_c1", "subreddit": "a", "subreddit_id": "t5_a", "author": "v", "body": "hello again",
     "edited": True, "nested": {"k": [1, 2]}},
    {"other": 1},
]


def dump(spark, tmp_path):
    import bz2
    import json
    from skein.sources.files import read_records
    path = tmp_path / "RC_2006-01.bz2"
    with bz2.open(path, "wt") as f:
        f.write("".join(json.dumps(r) + "\n" for r in DUMP))
    return read_records(spark, str(path))


def test_readme_commands_on_a_dump(spark, tmp_path):
    records = dump(spark, tmp_path)
    fields = {r.field: r.n for r in explore(records, ExploreOptions(count_fields=True))["fields"].collect()}
    assert fields == {f: sum(f in r for r in DUMP) for f in {f for r in DUMP for f in r}}
    out = explore(records, ExploreOptions(list_fields=True, count_field_values=True,
                                          keep_fields=["stickied", "edited"]))
    assert {r.field for r in out["fields"].collect()} == {"stickied", "edited"}
    values = {(r.field, r.value): r.n for r in out["field_values"].collect()}
    assert values == {("stickied", "false"): 1, ("stickied", "true"): 1, ("edited", "false"): 1,
                      ("edited", "1.5"): 1, ("edited", "true"): 1}
    assert out["count"].first().n == 3          # the record with neither field is gone
    out = explore(records, ExploreOptions(keep_fields=["subreddit"], show_records=True))
    assert [r.subreddit for r in out["records"].orderBy("pos").collect()] == ["a", "b", "a"]
    out = explore(records, ExploreOptions(strip_fields=["body"], show_records=True))
    assert "body" not in out["records"].columns and out["count"].first().n == 4
    out = explore(records, ExploreOptions(keep_fields=["id", "subreddit"], show_records=True))
    assert [(r.id, r.subreddit) for r in out["records"].orderBy("pos").collect()] == \
        [("c1", "a"), ("c2", "b"), ("c3", "a")]
    out = explore(records, ExploreOptions(strip_fields=["other"]))
    assert out["count"].first().n == 3
    with pytest.raises(ValueError):
        explore(records, ExploreOptions(strip_fields=["body"], min_length=3))
    typed = explore(corpus(spark), ExploreOptions(keep_fields=["id", "subreddit"], show_records=True))["records"]
    assert typed.columns == ["pos", "id", "subreddit"]


def test_reports_on_a_dump_share_one_read(spark, tmp_path):
    records = dump(spark, tmp_path)
    out = explore(records, ExploreOptions(ignore_deleted=True, summary=True, count_fields=True, to_lower=True,
                                          trim_whitespace=True, tokenize=True, vocab=True, vocab_order="index",
                                          conversations=True, pairs=True, min_length=1))
    s = out["summary"].first()
    assert (s.comments, s.deleted, s.posts, s.pairs, s.subreddits) == (3, 0, 2, 1, 2)
    assert [(r.word, r["count"]) for r in out["vocab"].collect()] == [("hello", 2), ("world", 1), ("again", 1)]
    assert [r.line for r in out["conversations"].collect()] == \
        ["- c1, u:\n  ['hello', 'world']", "    - c3, v:\n      ['hello', 'again']"]
    for name in ("summary", "summary_groups", "fields", "vocab", "pairs", "count"):
        plan = out[name]._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan, name


def test_all_taps_in_one_pass(spark, tmp_path):
    """Seven reports read each row once, write no rows, and agree with the reports by
    themselves."""
    rng = random.Random(3)
    lines = [json.dumps({"id": f"c{i}", "parent_id": rng.choice(["t3_p", f"t1_c{rng.randrange(300)}", None]),
                         "subreddit": rng.choice(["a", "b", None]), "subreddit_id": rng.choice(["t5_1", "t5_2", None]),
                         "author": "u", "body": rng.choice(["One two  two", "[deleted]", "x", "a b c d"]),
                         "edited": rng.choice([False, True, 1.0, 5, None, [1], {"k": 1}]),
                         **({"score": rng.randrange(4)} if i % 3 else {})}) for i in range(300)]
    (tmp_path / "dump").write_text("\n".join(lines))
    records = read_records(spark, str(tmp_path / "dump"))
    wanted = dict(summary=True, count_fields=True, count_field_values=True, vocab=True, pairs=True)
    text = dict(to_lower=True, trim_whitespace=True, tokenize=True, min_length=2)
    out, read = rows_scanned(spark, lambda: explore(records, ExploreOptions(**wanted, **text)), "text")
    assert read == 300
    reports = {name: sorted(map(repr, df.collect())) for name, df in out.items()}
    _, again = rows_scanned(spark, lambda: [df.collect() for df in out.values()], "text")
    assert again == 0
    assert {*reports} == {"summary", "summary_groups", "fields", "field_values", "vocab", "pairs", "count"}
    for option in wanted:
        alone = explore(records, ExploreOptions(**{option: True}, **text))
        for name, df in alone.items():
            assert sorted(map(repr, df.collect())) == reports[name], name
    # and with the operators that take one report each
    c = records.select("pos", F.from_json("value", "id string, parent_id string, subreddit string, subreddit_id string, "
                                          "body string").alias("r")).select("pos", "r.*")
    assert tuple(out["summary"].first()) == tuple(stats.summary_totals(c).first())
    assert reports["summary_groups"] == sorted(map(repr, stats.summary_groups(c).select(
        "subreddit_id", "n", "subreddit", "first_pos").collect()))
    by_field = stats.record_fields(records)
    assert reports["fields"] == sorted(map(repr, stats.field_counts(by_field).collect()))
    assert reports["field_values"] == sorted(map(repr, stats.field_value_counts(by_field).collect()))


def test_empty_source(spark):
    rows = spark.createDataFrame([], "pos long, id string, parent_id string, subreddit string, subreddit_id string, "
                                     "author string, body string")
    out = explore(rows, ExploreOptions(summary=True, count_fields=True, count_field_values=True, vocab=True, pairs=True,
                                       tokenize=True))
    assert tuple(out["count"].first()) == (0,) and out["vocab"].count() == out["pairs"].count() == 0
    assert tuple(out["summary"].first())[:4] == (0, 0, 0, 0)
