"""Text functions against Python's own re/str behaviour on edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from skein.functions import text as T

CASES = [
    "", "   ", " \t\n a  b \r\n", "a b", "x\u001cy", "éte", "½ cup",
    "٣٤ arabic digits", "emoji \U0001F600 ok", "snake_case_word", "mail me@ex.com now",
    "ip 1.2.3.4. end", "ip 10.0.0.1 mid sentence", "last 192.168.1.1", "a b　c",
    "Ünïcödé ÀÉÎ", "tabs\t\tand\u000bvt", "end\u0085nel", "x_y-z!!", "12abc34",
]

# Python models of the original's helpers (the behaviour to match)
MODELS = {
    "trim_whitespace": lambda s: re.sub(r"\s+", " ", s.strip()),
    "keep_alnum": lambda s: re.sub(r"\W+", " ", s),
    "strip_digits": lambda s: re.sub(r"\d+", " ", s),
    "remove_specials": lambda s: re.sub(r"[^\w\s]", "", s),
    "remove_digits": lambda s: re.sub(r"\d", "", s),
    "strip_emails": lambda s: re.sub(r"[a-zA-Z0-9\-_.]+@[a-zA-Z0-9\-_.]+", "", s),
    "strip_ips": lambda s: re.sub(r"((25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)(\.|$)){4}", "", s),
}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(CASES)], "i int, s string")


@pytest.mark.parametrize("name", sorted(MODELS))
def test_scalar_text_functions(texts, name):
    fn = getattr(T, name)
    got = {r.i: r.o for r in texts.select("i", fn("s").alias("o")).collect()}
    for i, s in enumerate(CASES):
        assert got[i] == MODELS[name](s), (name, repr(s))


def test_tokenize_like_str_split(texts):
    got = {r.i: r.t for r in texts.select("i", T.tokenize("s").alias("t")).collect()}
    for i, s in enumerate(CASES):
        assert got[i] == s.split(), repr(s)


def test_preprocess_order_fixed(texts):
    full = T.preprocess_text("s", strip_specials=True, strip_digits_=True, trim=True,
                             lower=True, tokenize_=True)
    got = {r.i: r.t for r in texts.select("i", full.alias("t")).collect()}
    for i, s in enumerate(CASES):
        x = re.sub(r"\W+", " ", s)
        x = re.sub(r"\d+", " ", x)
        x = re.sub(r"\s+", " ", x.strip())
        assert got[i] == x.lower().split(), repr(s)


def test_length_and_chars(texts):
    got = {r.i: (r.n, r.c) for r in texts.select("i", T.text_length("s").alias("n"),
                                                  T.chars("s").alias("c")).collect()}
    for i, s in enumerate(CASES):
        assert got[i] == (len(s), list(s)), repr(s)


def test_terms_and_ngrams(spark):
    df = spark.createDataFrame([("Ab c de fg_1 hi",), ("x",), ("",)], "s string")
    got = [r.g for r in df.select(T.word_ngrams(T.terms("s"), 2).alias("g")).collect()]
    assert got[0] == ["ab", "de", "fg_1", "hi", "ab de", "de fg_1", "fg_1 hi"]
    assert got[1] == [] and got[2] == []
    tri = df.select(T.word_ngrams(T.terms("s"), 3).alias("g")).first().g
    assert tri[-2:] == ["ab de fg_1", "de fg_1 hi"]


def test_preprocess_partial_flags(texts):
    both = T.preprocess_text("s", strip_specials=True, strip_digits_=True)
    got = {r.i: r.t for r in texts.select("i", both.alias("t")).collect()}
    for i, s in enumerate(CASES):
        assert got[i] == re.sub(r"\d+", " ", re.sub(r"\W+", " ", s)), repr(s)
    trimmed = T.preprocess_text("s", trim=True, tokenize_=True)
    got = {r.i: r.t for r in texts.select("i", trimmed.alias("t")).collect()}
    for i, s in enumerate(CASES):
        assert got[i] == s.split(), repr(s)


def test_clean_labelled_matches_steps(texts):
    got = {r.i: r.t for r in texts.select("i", T.clean_labelled("s").alias("t")).collect()}
    for i, s in enumerate(CASES):
        x = MODELS["strip_ips"](MODELS["strip_emails"](s.lower()))
        assert got[i] == MODELS["remove_digits"](MODELS["remove_specials"](x)), repr(s)
