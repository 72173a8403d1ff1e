"""Language identification: the fusion against plain Python, and accuracy."""

import math
import os

import numpy as np
import pytest

from skein.llm import language as L

SF = "/root/testdata/sf0.01"
EN, DE, FR = "the quick onion and then with that", "der schnelle und nicht mit einer", "le vite des avec une pour"
SCHEMA = "key long, text string, declared string, suffix string, host string"


def rows():
    out = []
    for i in range(60):
        out.append((i, EN + " " * (i % 3) + f" {i}", "en", "com", f"a{i % 4}.x.com"))
        out.append((100 + i, DE + f"! {i}", "de", "de", f"b{i % 4}.y.de"))
        out.append((200 + i, FR, "fr", "fr" if i % 2 else None, "z.fr"))
    out += [(900, None, "en", "com", "a0.x.com"), (901, "", None, None, None), (902, "12 34 !!", "de", "de", "b1.y.de"),
            (903, EN, None, None, None), (904, "e", "fr", "fr", "z.fr"), (905, DE, "xx", "", ""),
            (None, EN, "de", "com", "new.x.com"), (3, EN, "en", "com", "a3.x.com"),
            (3, EN, "en", "com", "a3.x.com")]
    return out


def model(data):
    """The same posterior from plain counts (every row is in the sample)."""
    said = [r[2] for r in data if r[2]]
    names = sorted({x for x in said if said.count(x) >= L.MIN_ROWS})
    n = len(names)
    counts = np.full((n, L.GRAMS), L.SMOOTH)
    for r in data:
        if r[2] in names:
            np.add.at(counts[names.index(r[2])], L.trigrams([r[1]])[0].astype(int), 1)
    logs = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    text = [L.TEMPER * logs[:, L.trigrams([r[1]])[0].astype(int)].sum(axis=1, dtype=float)
            if len(L.trigrams([r[1]])[0]) else None for r in data]
    best = [None if t is None else int(np.argmax(t)) for t in text]
    total = np.array([best.count(i) for i in range(n)], float)
    overall = (total + L.SMOOTH) / (total + L.SMOOTH).sum()

    def tally(pick):
        out = np.zeros(n)
        for r, b in zip(data, best):
            if b is not None and pick(r):
                out[b] += 1
        return out

    def smooth(c, up):
        return (c + L.STRENGTH * up) / (c.sum() + L.STRENGTH)

    suffixes = {r[3] for r, b in zip(data, best) if r[3] and b is not None}
    all_suffix = tally(lambda r: r[3])
    told_total = tally(lambda r: r[2])
    out = []
    for r, t in zip(data, text):
        log = np.zeros(n) if t is None else t.copy()
        if r[2]:
            log += np.log((tally(lambda x: x[2] == r[2]) + L.SMOOTH) / (told_total + L.SMOOTH * (n + 1)))
        if r[3]:
            log += np.log((tally(lambda x: x[3] == r[3]) + L.SMOOTH) / (all_suffix + L.SMOOTH * len(suffixes)))
        if r[4]:
            domain = ".".join(r[4].split(".")[-2:])
            up = smooth(tally(lambda x: x[4] and ".".join(x[4].split(".")[-2:]) == domain), overall)
            log += np.log(smooth(tally(lambda x: x[4] == r[4]), up))
        else:
            log += np.log(overall)
        p = np.exp(log - log.max())
        p /= p.sum()
        ok = t is not None and p.max() >= L.MIN_POSTERIOR
        out.append((r[0], names[int(p.argmax())] if ok else None, round(float(p.max()), 5)))
    return out


def test_fusion(spark):
    data = rows()
    got = [(r.key, r.language, round(r.posterior, 5)) for r in
           L.identify(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()]
    want = model(data)
    assert [x[:2] for x in sorted(got, key=repr)] == [x[:2] for x in sorted(want, key=repr)]
    assert all(math.isclose(a[2], b[2], abs_tol=2e-4)
               for a, b in zip(sorted(got, key=repr), sorted(want, key=repr)))
    verdict = {k: v for k, v, _ in got}
    assert verdict[900] is None and verdict[901] is None and verdict[902] is None
    assert verdict[903] == "en" and verdict[905] == "de" and verdict[None] == "en"


def test_prior_follows_the_hierarchy(spark):
    counts = [("h.a.com", 0)] * 50 + [("i.a.com", 0)] * 2 + [("j.b.com", 1)] * 3
    df = spark.createDataFrame(counts, "host string, best int")
    got = {r.host: np.exp(r.host_log) for r in L.host_priors(df, np.array([.5, .5])).collect()}
    up = (52 + 20 * .5) / 72
    assert got["h.a.com"][0] == pytest.approx((50 + 20 * up) / 70)
    assert got["i.a.com"][0] == pytest.approx((2 + 20 * up) / 22)
    assert got["j.b.com"][1] > .5 and got["i.a.com"][0] > .85


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, EN, None, None, None)], SCHEMA)
    assert [(r.key, r.language, r.kept) for r in L.identify(df).collect()] == [(1, None, False)]
    assert L.identify(df.where("false")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_held_out_accuracy(spark):
    """Rows without a declaration are judged by what the others taught."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hidden = "pmod(xxhash64(doc_id), 4) = 0"
    evidence = L.document_evidence(docs).selectExpr(
        "key", "text", f"if(pmod(xxhash64(key), 4) = 0, null, declared) AS declared", "suffix",
        f"if(pmod(xxhash64(key), 4) = 0, null, host) AS host")
    got = L.identify(evidence)
    both = got.join(docs.where(hidden).selectExpr("doc_id AS key", "lang"), "key")
    n, right = both.count(), both.where("language = lang").count()
    assert n > 150 and right >= 0.97 * n


def invented(i):
    """Words of an invented language of its own."""
    rng = np.random.default_rng(i)
    letters = rng.permutation(list("abcdefghijklmnopqrstuvwxyz"))[:9]
    return ["".join(rng.choice(letters, 5)) for _ in range(12)]


def test_every_declared_language_is_known(spark):
    """More languages than one block holds, the last ones with few rows."""
    rng = np.random.default_rng(5)
    data, n = [], 130
    for i in range(n):
        words = invented(i)
        data += [(1000 * i + j, " ".join(rng.choice(words, 30)), f"q{i:03d}" + ("-XX" if j % 2 else ""),
                  None, f"h{i % 7}.org") for j in range(8 if i < 100 else 4)]
        data.append((1000 * i + 900, " ".join(rng.choice(words, 30)), None, None, None))
    got = L.identify(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    assert len(got) == len(data) and n > L.BLOCK
    assert sum(r.language == f"q{r.key // 1000:03d}" for r in got) == len(data)


def test_tags(spark):
    df = spark.createDataFrame([("en-US", "en"), (" EN_gb ", "en"), ("De", "de"), ("", None), ("-", None),
                                (None, None)], "x string, y string")
    assert all(r.x == r.y for r in df.select(L.tag(df.x).alias("x"), "y").collect())


def test_page_evidence(spark):
    pages = [(1, "https://A.b.org/x", '<html class="c" lang="EN-us"><title>no</title><p>yes&amp;so</p>'
              "<script>var x</script><!-- c --></html>", "s"),
             (2, None, None, "s"), (3, "no address", "", None), (None, "ftp://h.de?x", "<HTML LANG=de>da", "s")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, suffix string")
    got = {r.key: (" ".join((r.text or "").split()), r.declared, r.suffix, r.host) for r in
           L.page_evidence(df).collect()}
    assert got[1] == ("yes so", "en", "org", "a.b.org") and got[2][0] == "" and not got[2][1] and not got[2][3]
    assert got[3][0] == "" and not got[3][3] and got[None] == ("da", "de", "de", "h.de")


def test_long_texts_and_clashing_names(spark):
    docs = [(i, (EN if i % 2 else DE) + " ", "en" if i % 2 else "de", "s", "x", 1, 2) for i in range(40)]
    docs += [(90, (DE + " ") * 60_000, None, None, "x", 1, 2), (91, "en " + "1 " * 900_000, None, None, "x", 1, 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, "
                                     "key string, told int, n long")
    got = {r.key: r.language for r in L.identify(L.document_evidence(df)).collect()}
    assert len(got) == len(docs) and got[90] == "de" and got[1] == "en" and got[0] == "de"
