"""Importance resampling against its formulas, word by word."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from skein.llm import resample as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n_features string, rank int"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text, low, high):
    w = words(text)
    return [" ".join(w[i:i + k]) for k in range(low, high + 1) for i in range(len(w) - k + 1)]


def model(docs, target, low, high, buckets, share, min_words, seed):
    def count(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, low, high))
    s, t = count(x for _, x in docs), count(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        found = [zlib.crc32(f.encode()) % buckets for f in features(text, low, high)]
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
                 for b in found]
        weight = math.floor(sum(gains) / len(gains)) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= min_words),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:share * len(able) // 100], 1):
        r[4] = k
    return rows


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = ["the", "A", "Über", "x1", "zeta", "É", "of", "kappa", "ß9", "rho", "中文"]
    docs = [(i, rng.choice([" ", ", ", "-"]).join(rng.choice(vocab) for _ in range(rng.randint(0, 40))))
            for i in range(n)]
    docs += [(500, None), (501, ""), (502, " .,! "), (None, "the x1 " * 30), (503, "of\x00zeta  The" * 20)]
    docs += [(3, docs[3][1])] * 4 + [(4, docs[9][1] + " x1")]
    return docs, [" ".join(rng.choice(vocab[:6]) for _ in range(20)) for _ in range(5)] + [None, ""]


def run(spark, docs, target, **more):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA)
    b = spark.createDataFrame([(1, t) for t in target], "weight int, text string")
    out = R.importance_resample(d, b, **more)
    assert out.columns == ["id", "n_words", "n_features", "weight", "score", "rank"]
    return [tuple(r) for r in out.collect()]


@pytest.mark.parametrize("low,high,buckets,min_words", [(1, 1, 10_000, 20), (1, 3, 97, 5), (2, 2, 70_000, 0)])
def test_equals_the_formulas(spark, low, high, buckets, min_words):
    docs, target = corpus(low * 10 + high)
    got = run(spark, docs, target, low=low, high=high, buckets=buckets, min_words=min_words, share=30, seed=7)
    want = model(docs, target, low, high, buckets, 30, min_words, 7)

    def told(rows):     # of rows with the same id and score any may have the lower rank
        return sorted(((r[0], r[1], r[2], r[3], r[4]) for r in rows),
                      key=lambda r: tuple((x is None, x or 0) for x in r))
    assert told((i, f, w, s, k) for i, _, f, w, s, k in got) == told(r[:5] for r in want)
    assert sorted(((r[0], r[1]) for r in got), key=lambda r: (r[0] is None, r)) == \
        sorted(((r[0], r[5]) for r in want), key=lambda r: (r[0] is None, r))


def test_long_text_is_split_between_words(spark, monkeypatch):
    split = R.splitter()
    text = "Ab, cd" + "é" * 300 + " ".join(f"w{i}" for i in range(5000)) + "x" * 400_000 + " end"
    whole = R.words_of(text, split)
    assert [w for w, _ in whole] == words(text)
    monkeypatch.setattr(R, "STRETCH", 64)
    assert R.words_of(text, split) == whole
    low = text.lower()
    assert all(low[a:b] == w for w, (a, b) in whole)
    got = run(spark, [(1, text), (2, "w1 w2")], ["w1"], low=1, high=2)
    want = model([(1, text), (2, "w1 w2")], ["w1"], 1, 2, R.BUCKETS, R.SHARE, R.MIN_WORDS, R.SEED)
    assert sorted((i, f, w, s) for i, _, f, w, s, _ in got) == sorted(tuple(r[:4]) for r in want)


def test_empty_tables(spark):
    assert run(spark, [], ["a b"]) == []
    got = run(spark, [(1, "a b c"), (2, None)], [], share=100, min_words=0)
    assert sorted(r[0] for r in got) == [1, 2] and sorted(r[5] for r in got) == [1, 2]


def test_a_third_of_all_rows_alike(spark):
    docs = [(1, "the same words " * 10)] * 100 + [(i, f"w{i} " * 25) for i in range(2, 200)]
    got = run(spark, docs, ["w5 w6"], share=50)
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 149 + 1))
    assert sorted(r[:5] for r in got) == sorted(
        (i, n, f, w, s) for i, f, w, s, _, n in model(docs, ["w5 w6"], 1, 1, R.BUCKETS, 50, 20, R.SEED))
