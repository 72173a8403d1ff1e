"""End-to-end jobs on files: pair dump (bz2 JSON -> TSV), featurizer (TSV),
and input order across many bz2 splits."""

import bz2
import glob
import json
import os
import random

import models as M
from skein.plans.programs import dump_pairs, featurize_file
from skein.sources import files


def write_dump(path, rows):
    with bz2.open(path, "wt") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_dump_pairs_from_bz2(spark, tmp_path):
    rnd = random.Random(5)
    rows = []
    for i in range(200):
        parent = "t3_p" if i % 5 == 0 else f"t1_c{rnd.randrange(max(i, 1))}"
        body = "[deleted]" if i % 13 == 0 else f"body  {i}\twith\ttabs "
        rows.append({"id": f"c{i}", "parent_id": parent, "body": body, "subreddit": "s",
                     "edited": bool(i % 2) if i % 3 else 1.5})
    first, second = tmp_path / "RC_a.bz2", tmp_path / "RC_b.bz2"
    write_dump(first, rows[:120])
    write_dump(second, rows[120:])
    out = str(tmp_path / "pairs")
    dump_pairs(spark, out, str(first), str(second))
    lines = []
    for part in sorted(glob.glob(os.path.join(out, "part-*"))):
        with open(part) as f:
            lines += f.read().splitlines()
    import re
    prep = [dict(pos=i, id=r["id"], parent_id=M.key(r["parent_id"]), body=re.sub(r"\s+", " ", r["body"].strip()))
            for i, r in enumerate(rows) if r["body"] != "[deleted]"]
    expected = [f"{a}\t{b}" for a, b in M.two_phase(prep)]
    assert lines == expected  # same lines, same order


def test_dump_pairs_reads_the_text_once(spark, tmp_path, monkeypatch):
    from skein.plans import programs
    write_dump(tmp_path / "a.bz2", [{"id": f"c{i}", "parent_id": f"t1_c{i - 1}", "body": f"b{i}"} for i in range(9)])
    seen = []
    monkeypatch.setattr(programs, "write_pairs_tsv", lambda pairs, path: seen.append(pairs))
    programs.dump_pairs(spark, str(tmp_path / "out"), str(tmp_path / "a.bz2"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan json" not in plan and "FileScan text" not in plan and "FileScan parquet" in plan
    assert seen[0].count() == 8


def test_featurize_file(spark, tmp_path):
    p = tmp_path / "labelled.txt"
    sents = ["Great phone and great battery", "Terrible screen, broke in 2 days",
             "I love the sound", "Worst purchase ever", "The battery lasts long",
             "Screen is great", "Do not buy this phone", "Sound quality is poor",
             "Excellent value", "Battery died quickly", "Love it"]
    p.write_text("".join(f"{s}\t{i % 2}\n" for i, s in enumerate(sents)))
    out = featurize_file(spark, str(p))
    rows = out.collect()
    assert {r.split for r in rows} == {"train", "validation"}
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["index"], 0.0)
        by_doc[r["index"]] += r.weight ** 2
    assert all(abs(v - 1.0) < 1e-9 for v in by_doc.values())  # L2-normalized rows


def test_order_across_bz2_splits(spark, tmp_path):
    p = tmp_path / "big.bz2"
    rnd = random.Random(1)
    lines = [f"{i} " + "".join(rnd.choice("abcdefgh") for _ in range(60)) for i in range(60000)]
    with bz2.open(p, "wt") as f:
        f.write("\n".join(lines) + "\n")
    small = tmp_path / "small.txt"
    small.write_text("tail 1\ntail 2\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        df = files.read_lines(spark, str(p), str(small))
        assert df.rdd.getNumPartitions() > 2
        got = [r.value for r in df.orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == lines + ["tail 1", "tail 2"]
