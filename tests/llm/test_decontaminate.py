"""Phrase and proximity search against a scan of every place."""

import hashlib
import random
import re

import pytest

from skein.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def model(text, items, window, slack):
    have = words(text)
    covered, found, near = set(), set(), set()
    for item_id, item in items:
        ws = words(item)
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            w = ws[i:i + window]
            for s in range(len(have) - len(w) + 1):
                if have[s:s + len(w)] == w:
                    covered.update(range(s, s + len(w)))
                    found.add(item_id)
            at = [[p for p, x in enumerate(have) if x == y] for y in w]
            if all(at) and any(all(any(abs(p - s - j) <= slack for p in at[j]) for j in range(len(w)))
                               for s in range(-slack, len(have) + slack)):
                near.add(item_id)
    return (len(have), len(covered), len(found),
            hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(covered), near)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["the", "a", "Über", "x1", "zeta", "é", "of", "kappa", "rho", "the"]
    items = [(str(i), " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 4, 5, 7]))))
             for i in range(12)]
    items += [("3", "twice named item of many words here"), ("", None), ("e", ""), ("p", "-- !!"),
              ("same", items[0][1])]
    texts = [None, "", "...", "!the! A, of.", "twice named item of many words here " * 300]
    for _ in range(n):
        t = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if rng.random() < .5:
            t[5:5] = (rng.choice(items)[1] or "").split()
        texts.append(rng.choice([" ", "  ", "-", "\n"]).join(t))
    return items, texts


@pytest.mark.parametrize("seed,blocks", [(1, False), (2, True)])
def test_against_scan(spark, monkeypatch, seed, blocks):
    items, texts = corpus(seed)
    if blocks:      # many blocks of items, small steps
        monkeypatch.setattr(D, "BLOCK_BYTES", 60)
    monkeypatch.setattr(D, "SEGMENT_BYTES", 2000)
    monkeypatch.setattr(D, "CANDIDATES", 50)
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(None, texts[7], "z"), (4, texts[4], "z")],
                                 "doc_id long, text string, terms string").repartition(2)
    test = spark.createDataFrame([(i or None, t, 1) for i, t in items], "item_id string, text string, doc_id int")
    got = D.contamination(docs, test, window=5).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[4]) == 2 and len(by[None]) == 1
    for i, text in [*enumerate(texts), (None, texts[7])]:
        n, hit, n_items, sha, bad, near = model(text, items, 5, D.SLACK)
        for r in by[i]:
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) \
                == (n, hit, n_items, sha, bad), text
            assert r.n_near == len(near), text


def test_near_match(spark):
    docs = spark.createDataFrame([(1, "q one two extra three four five q"), (2, "five four three"),
                                  (3, "one two three four five")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "One two, three four five")], "item_id long, text string")
    got = {r.doc_id: (r.n_near, r.contaminated) for r in D.contamination(docs, items, window=5).collect()}
    assert got == {1: (1, False), 2: (0, False), 3: (1, True)}


def test_empty(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "one two")], "item_id long, text string")
    assert [tuple(r)[:4] for r in D.contamination(docs, items.where("false")).collect()] == [(1, 2, 0, 0)]
    assert D.contamination(docs.where("false"), items).count() == 0
