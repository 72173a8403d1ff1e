"""The network against loops over its definition, and accuracy on held-out rows."""

import random
import zlib

import numpy as np
import pytest

from skein.llm import toxicity as X

DOCS = "id long, text string, language string, score int, label string"
BAD = {"en": ["wretch", "knave", "scoundrel", "oafish"], "de": ["grobian", "schurke", "lump", "wicht"]}


def corpus(seed, n=900):
    """Invented words; a text with two bad ones or more, next to each other or not, is toxic."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        lang = "de" if i % 3 == 0 else "en"
        words = ["".join(rng.choice("aeiou") + rng.choice("bdgklmnr") for _ in range(rng.randint(1, 3)))
                 for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD[lang]).title())
        rows.append((i, " ".join(words) + ".", lang, 1, "x"))
        if i % 5:
            labels.append((i, int(toxic)))
    return rows, labels, {i: x for i, x in labels}


def words_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    return "".join(chr(b) if X._WORD[b] else " " for b in text).split()


def bucket(word, head, seed):
    h = 0
    for k, c in enumerate(word[:head] if head else word):
        h = (h + (ord(c) + 1) * pow(0x01000193, k + 1, 1 << 32)) % (1 << 32)
    h = ((h ^ h >> 15) * seed) % (1 << 32)
    return ((h ^ h >> 13) * seed) % (1 << 32) >> 16


def loops(model, text):
    """A score, filter by filter and word by word."""
    words = [sum(model.embed[bucket(w, h, int(s))] for h, s in zip((None, *X.HEADS), X._SEEDS)) for w in words_of(text)]
    n = len(words)
    words += [np.zeros(X.DIM, np.float32)] * X.PAD
    strongest = []
    at = 0
    for i, width in enumerate(X.WIDTHS):
        for f in range(X.FILTERS):
            cols = [at + k * X.FILTERS + f for k in range(width)]
            answers = [model.bias[i * X.FILTERS + f] + sum(words[p + k] @ model.filters[:, c]
                                                            for k, c in enumerate(cols)) for p in range(n)]
            strongest.append(max([0.0, *answers]))
        at += width * X.FILTERS
    z = model.slope * (np.array(strongest) @ model.weigh + model.base) + model.shift
    return 1 / (1 + np.exp(-z))


def random_model(seed):
    rng = np.random.default_rng(seed)
    n = len(X.WIDTHS) * X.FILTERS
    return X.Model(rng.normal(0, 1, (X.BUCKETS, X.DIM)).astype(np.float32),
                   rng.normal(0, 0.2, (X.DIM, sum(X.WIDTHS) * X.FILTERS)).astype(np.float32),
                   rng.normal(0, 0.2, n).astype(np.float32), rng.normal(0, 0.05, n).astype(np.float32),
                   0.1, 0.7, -0.2, {None: 0.4, "de": 0.6})


TEXTS = ["", None, "one", "Two words", "ÄÖ x1,y2--zz\nlonger  texts é 中文 of Words", "?!", "a " * 50, "b" * 300]


def test_scores_equal_the_loops(monkeypatch):
    model = random_model(1)
    want = [loops(model, t) for t in TEXTS]
    assert np.allclose(X.scores(model, *X.hashed_words(TEXTS)), want, atol=1e-5)
    monkeypatch.setattr(X, "STRETCH", 3)        # filters that run over the ends of stretches
    monkeypatch.setattr(X, "TEXT_BYTES", 8)
    assert np.allclose(X.scores(model, *X.hashed_words(TEXTS)), want, atol=1e-5)


def test_gradients_follow_the_loss():
    """A few steps on a separable handful of texts tell them apart."""
    texts = ["good calm words here", "bad vile words here"] * 40
    codes, sizes = X.hashed_words(texts)
    model = X.fit(codes, sizes, np.array([0, 1] * 40))
    z = X.logits(model, codes, sizes)
    assert z[1::2].min() > z[0::2].max() + 2


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def test_held_out_accuracy(spark):
    rows, _, truth = corpus(5)
    docs = frame(spark, rows)
    labels = spark.createDataFrame(list(truth.items()), "id long, label int")
    model = X.train(docs, labels.where(~X.held_out("id")))
    out = X.score(docs.withColumnRenamed("score", "other").withColumn("held", X.held_out("id")), model)
    assert out.columns == ["id", "other", "label", "held", "score", "threshold", "flagged"]
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    assert all(r["held"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    test = [i for i in truth if got[i]["held"]]
    right = sum((got[i]["score"] >= X.THRESHOLD) == truth[i] for i in test)
    assert len(test) > 100 and right >= 0.95 * len(test)
    flags = sum(got[i]["flagged"] == truth[i] for i in test)
    assert flags >= 0.95 * len(test)
    assert all(r["flagged"] == (r["score"] >= r["threshold"]) for r in got.values())


def test_labels_language_and_id_are_no_inputs(spark):
    model = random_model(2)
    texts = TEXTS + ["x" * 400_000, "many words " * 40_000]
    rows = [(k * 100 + i, t, lang, 1, "x") for k, lang in enumerate(["en", "de", None]) for i, t in enumerate(texts)]
    rows += [(None, "Two words", "en", 1, "x")] * 3
    out = X.score(frame(spark, rows).drop("score"), model).collect()
    by_text = {}
    for r in out:
        i = 3 if r["id"] is None else r["id"] % 100
        by_text.setdefault(i, set()).add(round(r["score"], 5))
        lang = "en" if r["id"] is None else ["en", "de", None][r["id"] // 100]
        assert r["threshold"] == (0.6 if lang == "de" else 0.4)
    assert len(out) == len(rows) and all(len(v) == 1 for v in by_text.values())


@pytest.mark.parametrize("labels,want", [([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0),
                                         ([(1, 7), (None, 1), (2, None)], 0.0)])
def test_without_both_labels(spark, labels, want):
    docs = frame(spark, [(1, "a b", "en", 1, "x"), (2, None, None, 1, "x")])
    model = X.train(docs, spark.createDataFrame(labels, "id long, label int"))
    assert [round(r["score"], 6) for r in X.score(docs.drop("score"), model).collect()] == [want, want]


def test_few_repeated_and_conflicting_labels(spark):
    docs = frame(spark, [(1, "bad words", "en", 1, "x"), (1, "other bad", "en", 1, "x"), (2, "fine", "en", 1, "x"),
                         (3, "", "en", 1, "x"), (None, "bad", None, 1, "x")] * 4)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0), (3, None), (4, 1), (None, 1)], "id long, label int")
    out = X.score(docs.drop("score"), X.train(docs, labels)).collect()
    assert len(out) == 20 and all(0 <= r["score"] <= 1 for r in out)
    assert X.score(docs.limit(0).drop("score"), X.train(docs.limit(0), labels)).count() == 0


def test_no_language_value_breaks_it(spark):
    rows, _, truth = corpus(8, 300)
    rows = [(i, t, f"l{i % 40}" if i % 2 else None, 1, "x") for i, t, _, _, _ in rows]
    model = X.train(frame(spark, rows), spark.createDataFrame(list(truth.items()), "id long, label int"))
    assert set(model.thresholds) == {None}


def test_every_labelled_row_is_learnt(spark, monkeypatch):
    """Rows over several tasks, long texts among them, are all fitted or calibrate."""
    monkeypatch.setattr(X, "ROWS", 200)
    rows, _, truth = corpus(7, 700)
    rows[1] = (1, rows[1][1] + " pad" * 30_000, *rows[1][2:])       # longer than the bound there was
    seen, counted = [], []
    fit, judge = X._round, X.calibrate
    monkeypatch.setattr(X, "_round", lambda rows, *more: seen.append((rows.count(), rows.where("id = 1").first()["n"],
                                                                      rows.rdd.getNumPartitions())) or fit(rows, *more))
    monkeypatch.setattr(X, "calibrate", lambda model, x, y, n, z: counted.append(n.sum()) or judge(model, x, y, n, z))
    docs = frame(spark, rows)
    model = X.train(docs, spark.createDataFrame(list(truth.items()), "id long, label int"))
    assert seen and all(n == len(truth) and words > 30_000 and parts == 3 for n, words, parts in seen)
    assert 0.15 * len(truth) < counted[0] < 0.35 * len(truth)
    rest = {r["id"]: r["score"] for r in X.score(docs.drop("score"), model).collect() if r["id"] not in truth}
    bad = {w for x in BAD.values() for w in x}
    right = sum((rest[i] >= X.THRESHOLD) == (len(bad & set(words_of(t))) > 0) for i, t, *_ in rows if i in rest)
    assert right >= 0.9 * len(rest)


def test_strongest_answers_are_found_in_stretches(monkeypatch):
    model, texts = random_model(3), [t for t in TEXTS if words_of(t)]
    codes, sizes = X.hashed_words(texts)
    best, where = X.peaks(model, codes, sizes)
    monkeypatch.setattr(X, "STRETCH", 3)
    again, there = X.peaks(model, codes, sizes)
    assert np.allclose(best, again, atol=1e-5) and np.allclose(np.maximum(best, 0), X.pooled(model, codes, sizes), atol=1e-5)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    assert (owner[where] == np.arange(len(sizes))[:, None]).all() and (owner[there] == owner[where]).all()
