"""File sources, vocabulary and TF-IDF against small hand-checked models."""

import bz2
import json
import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skein.operators import features as FE
from skein.operators import stats as ST
from skein.operators import vocab as V
from skein.sources import files

import models as M

DATA = os.path.join(os.path.dirname(__file__), "data")


def test_multi_file_order_with_bz2(spark, tmp_path):
    second = tmp_path / "testfile2.bz2"
    with bz2.open(second, "wt") as f:
        f.write("testfile 2, line 1\ntestfile 2, line 2\n")
    big = tmp_path / "big.txt"
    big.write_text("".join(f"big {i}\n" for i in range(3000)))
    df = files.read_lines(spark, str(big), os.path.join(DATA, "testfile1"), str(second))
    lines = [r.value for r in df.orderBy("pos").collect()]
    assert lines[:3000] == [f"big {i}" for i in range(3000)]
    assert lines[3000:] == ["testfile 1, line 1", "testfile 1, line 2",
                            "testfile 2, line 1", "testfile 2, line 2"]
    dense = files.read_lines(spark, os.path.join(DATA, "testfile1"), str(second), dense_pos=True)
    assert [(r.pos, r.value) for r in dense.orderBy("pos").collect()][-1] == (3, "testfile 2, line 2")


def test_json_records_and_field_stats(spark, tmp_path):
    recs = [{"id": "c1", "body": "x", "edited": False}, {"id": "c2", "body": None, "edited": 1.0},
            {"id": "c3", "edited": True, "nested": {"a": 1}}, {"id": "c4", "edited": 1}]
    p = tmp_path / "r.json"
    p.write_text("\n".join(json.dumps(r) for r in recs) + "\n\n")
    raw = files.read_records(spark, str(p))
    counts = {r.field: r.n for r in ST.count_fields(raw).collect()}
    assert counts == {"id": 4, "body": 2, "edited": 4, "nested": 1}
    vals = {(r.value_type, r.value): r.n for r in ST.count_field_values(raw).collect()
            if r.field == "edited"}
    # false, true, 1.0 and 1 stay apart (Python's dict would merge True, 1 and 1.0)
    assert vals == {("BOOLEAN", "false"): 1, ("BOOLEAN", "true"): 1,
                    ("DECIMAL(1,0)", "1"): 1, ("BIGINT", "1"): 1}
    typed = files.read_records(spark, str(p), schema="id string, body string, edited variant")
    got = {r.id: r.body for r in typed.collect()}
    assert got == {"c1": "x", "c2": None, "c3": None, "c4": None}


def test_labelled_tsv(spark, tmp_path):
    p = tmp_path / "l.txt"
    p.write_text('Great phone, works!\t1\nmail me@x.com at 1.2.3.4\t0\n"He said ""no""\tagain."\t0\n')
    df = files.read_labelled(spark, str(p))
    assert [(r["index"], r.Class) for r in df.orderBy("index").collect()] == [(0, 1), (1, 0), (2, 0)]
    assert df.orderBy("index").collect()[2].Sentence == 'He said "no"\tagain.'


def test_folders_patterns_repeats_and_odd_names(spark, tmp_path):
    folder = tmp_path / "RC 2006 %41[x]"
    folder.mkdir()
    for name, text in (("b, {1}", "b1\nb2\n"), ("a*", "a1\n"), ("_hidden", "no\n")):
        (folder / name).write_text(text)
    for i in range(3):
        (tmp_path / f"RC_2006-0{i}").write_text(f"p{i}\n")

    def lines(*paths, **more):
        return [r.value for r in files.read_lines(spark, *map(str, paths), **more).orderBy("pos").collect()]

    assert lines(folder) == ["a1", "b1", "b2"]
    assert lines(tmp_path / "RC_2006*", folder / "a*", tmp_path / "RC_2006-01") == ["p0", "p1", "p2", "a1", "p1"]
    assert lines(tmp_path / "RC_2006-02", tmp_path / "RC_2006-02", tmp_path / "RC_2006-00") == ["p2", "p2", "p0"]
    assert lines(tmp_path / "RC_2006*", folder, first=2) == ["p0", "p1"]
    with pytest.raises(FileNotFoundError):
        files.read_lines(spark, str(tmp_path / "RC_2007*"))


def test_first_lines_open_no_later_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "c1"}\n{"id": "c2"}\n')
    (tmp_path / "b.json").write_text("this is no JSON\n")
    got = files.read_records(spark, str(tmp_path / "a.json"), str(tmp_path / "b.json"), schema="id string", first=2)
    assert [r.id for r in got.orderBy("pos").collect()] == ["c1", "c2"]


def test_vocabulary_over_a_dump(spark, tmp_path):
    """The reader's own positions serve the vocabulary."""
    p = tmp_path / "r.json"
    p.write_text("".join(json.dumps({"id": f"c{i}", "body": b}) + "\n" for i, b in enumerate(["b a", "a c"])))
    df = files.read_comments(spark, str(p)).withColumn("t", F.split("body", " "))
    assert {r.word: (r["index"], r["count"]) for r in V.build_vocab(df, "t").collect()} == \
        {"b": (0, 1), "a": (1, 2), "c": (2, 1)}


def test_vocab_and_encode(spark):
    sents = [["b", "a", "b"], [], ["c", "a"], ["a", "d", "d", "b"]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sents)], "pos long, t array<string>")
    v = V.build_vocab(df, "t")
    known = M.first_positions(sents)
    assert {r.word: (r["index"], r["count"]) for r in v.collect()} == known
    enc = V.encode(df, "t", v)
    assert [r.codes for r in enc.orderBy("pos").collect()] == [[known[w][0] for w in s] for s in sents]
    pruned = V.build_vocab(df, "t", min_count=2)
    assert [r.word for r in pruned.orderBy("index").collect()] == ["b", "a", "d"]
    order = [r.word for r in V.vocab_ordered(v, "count", reverse=True).collect()]
    assert order == ["b", "a", "d", "c"]  # ties (b, a: 3) stay in index order
    assert [(r.word, r.rank) for r in V.vocab_ordered(v, "word", reverse=True).collect()] == \
        [("d", 0), ("c", 1), ("b", 2), ("a", 3)]
    keys = spark.createDataFrame([(0,), (3,), (9,)], "index long")
    assert {r["index"]: (r.word, r["count"]) for r in V.lookup(v, keys, "index").collect()} == \
        {0: ("b", 3), 3: ("d", 2), 9: (None, None)}


def tfidf_model(docs, vocab_terms):
    n = len(docs)
    df = Counter(t for d in docs for t in set(d))
    out = {}
    for i, d in enumerate(docs):
        tf = Counter(t for t in d if t in vocab_terms)
        w = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in tf.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t, x in w.items():
            out[(i, t)] = round(x / norm, 9)
    return out


def test_tfidf_formula(spark):
    texts = ["red apple red", "green apple", "blue sky", "red sky blue sky"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "index long, s string")
    counts = FE.term_counts(df, "s", "index", n_max=1)
    vocab = FE.fit_vocabulary(counts, len(texts), max_df=1.0)
    w = FE.tfidf_weights(counts, vocab, F.lit(len(texts)))
    got = {(r["index"], r.term): round(r.weight, 9) for r in w.collect()}
    docs = [t.split() for t in texts]
    assert got == tfidf_model(docs, {t for d in docs for t in d})
    capped = FE.fit_vocabulary(counts, len(texts), max_df=0.5, max_features=2)
    # df > 0.5*4 removes nothing with df 2; top-2 by frequency, ties by term
    assert [r.term for r in capped.orderBy("term_index").collect()] == ["red", "sky"]


def test_split_sizes(spark):
    df = spark.range(0, 101).withColumnRenamed("id", "index")
    s = FE.train_val_split(df, "index")
    c = Counter(r.split for r in s.collect())
    assert c == {"validation": 11, "train": 90}


def test_terms_are_counted_in_their_row(spark):
    """Rows that share a key, or have none, are one document each; the terms of the others
    pass no aggregate."""
    rows = [(1, "b b a b"), (2, None), (3, ""), (4, "xx yy xx"), (4, "yy zz"), (None, "aa bb"), (None, "aa"),
            (5, "xx"), (6, "aa bb aa bb aa"), (6, None)]
    df = spark.createDataFrame(rows, "index long, s string")
    counts = FE.term_counts(df, F.regexp_replace("s", "b a", "bb aa"), "index", n_max=2)
    want = Counter()
    for k, s in rows:
        t = [w for w in (s or "").replace("b a", "bb aa").split() if len(w) > 1]
        want.update((k, g) for g in t + [" ".join(x) for x in zip(t, t[1:])])
    got = [tuple(r) for r in counts.collect()]
    assert len(got) == len(want) and {(k, g): n for k, g, n in got} == want
    parts = counts._jdf.queryExecution().optimizedPlan().children()
    assert "Aggregate" not in parts.head().toString() and "Aggregate" in parts.last().toString()
