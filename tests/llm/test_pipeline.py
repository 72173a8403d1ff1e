"""The pipeline's decisions against the operators' brute-force models."""

import random
import zlib

import numpy as np

import corpus_pipeline as C
from skein.llm.tokens import IDS, encoder
from test_decontaminate import model as leaks
from test_secrets import model as base_spans
from test_simhash import model_fp, roots

WORDS = {"en": "the of and to in that with was for on quick brown".split(),
         "de": "der die und das mit nicht eine zu von auf ist sich".split()}


def corpus():
    rng = random.Random(9)
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        text = " ".join(rng.choice(WORDS[lang]) + rng.choice("abcdefg") for _ in range(rng.randint(30, 120)))
        rows.append([i, text, lang, f"src{i % 5}", len(text)])
    passage = "a benchmark passage of exactly eleven words stands in this text"
    for i in range(5, 60, 9):
        rows[i][1] += " " + passage
    for i in range(3, 60, 11):
        rows[i][1] += " password=abcdefgh" + str(i)
    rows += [[200 + i, rows[i][1], *rows[i][2:]] for i in range(0, 40, 2)]       # copies
    rows += [[300, None, "en", "src1", 0], [301, "", "en", "src1", 0], [302, "12 -- 34", None, None, 8],
             [7, rows[7][1], "en", "src1", 5], [7, rows[7][1], "en", "src1", 5], [8, rows[60][1][::-1], "en", None, 1],
             [None, rows[61][1] + " tail", "de", "src2", 3]]
    return [tuple(r) for r in rows], [(1, passage), (2, None), (3, "never said anywhere at all")]


def expected(rows, items):
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    fps = [model_fp(r[1]) for r in rows]
    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i)
                             if (fps[i] ^ fps[j]).bit_count() <= 4])
    best = {}
    for i, r in enumerate(root):
        if r not in best or (rows[i][0] is None, rows[i][0] or 0) < (rows[best[r]][0] is None, rows[best[r]][0] or 0):
            best[r] = i
    rows = [rows[i] for i in best.values()]
    rows = [r for r in rows if not leaks(r[1], items, 10, 2)[4]]
    out = []
    for r in rows:
        text, at, parts = r[1], 0, []
        for s, _, e in base_spans(text):
            if s >= at:
                parts += [text[at:s], "[SECRET]"]
            at = max(at, e)
        new = "".join(parts) + text[at:]
        out.append((r[0], new, r[2], r[3], len(new) if new != text else r[4]))
    return out


def test_stages(spark, tmp_path):
    rows, items = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in C.STAGES] == ["language_id", "simhash_dedup", "decontaminate", "secrets", "packing"]
    stage = docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, f in C.STAGES[:-1]:
        stage = f(spark, stage, str(tmp_path))
        assert stage.dtypes == docs.dtypes, name
    want = expected(rows, [(str(i), t) for i, t in items])
    assert sorted(map(repr, map(tuple, stage.collect()))) == sorted(map(repr, want))
    assert 60 < len(want) < 120
    pieces = C.run(spark, str(tmp_path)).collect()
    tokens = {}
    for r in want:
        ids = np.append(encoder().whole(r[1]), 0).astype(IDS)
        tokens[r[0]] = (len(ids), zlib.crc32(ids.tobytes()))
    assert {p.doc_id: (p.length, p.ids_crc32) for p in pieces} == tokens and len(pieces) == len(want)
    assert len({p.sequence_id for p in pieces}) <= 1 + -(-sum(p.length for p in pieces) // 2048)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
