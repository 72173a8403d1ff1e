"""Labelled-text features: stop words, seeded split, word n-grams, TF-IDF.

Plan shape: documents are hash-partitioned once by id; n-grams are then counted in
each document's own row (in an aggregate if several rows share the id) and the
per-document L2 norm runs inside those partitions. Document frequencies are a partial + final aggregate on the term.
The fitted vocabulary is at most ``max_features`` rows, a proven bound, so it
is broadcast to the weighting step.
"""

from __future__ import annotations

import math
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import terms, tokenize, word_ngrams
from skein.operators.ordered import split_at
from skein.operators.rows import as_col, explode_rows
from skein.session import staged

# ---- fixed values: the English stop-word list of the reference's library ----
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him",
    "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's", "its",
    "itself", "they", "them", "their", "theirs", "themselves", "what", "which", "who",
    "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing",
    "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into", "through", "during",
    "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on",
    "off", "over", "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other",
    "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very",
    "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now", "d",
    "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven",
    "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn",
    "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren",
    "weren't", "won", "won't", "wouldn", "wouldn't",
]
# ---- fixed values: the vectorizer settings of the featurizer ----
NGRAM_MAX = 2
MAX_FEATURES = 50_000
MAX_DF = 0.5
VALIDATION_FRACTION = 0.10
# -------------------------------------------------------------------------------


def remove_stopwords(c, stop_words=STOP_WORDS) -> Column:
    """Drop stop words from the whitespace tokens and re-join with spaces (F2)."""
    return F.array_join(F.filter(tokenize(c), lambda w: ~w.isin(list(stop_words))), " ")


def train_val_split(df: DataFrame, index: str = "index", seed: int = 0,
                    val_fraction: float = VALIDATION_FRACTION) -> DataFrame:
    """Seeded shuffle split (F3): (index, split). Rows are ranked by md5(seed:index)
    and the first ceil(fraction * n) are validation. Deterministic in any engine.

    The last validation key is selected by counting (``selection``): nothing is
    sorted or shuffled, and only the index column is read, not the text.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(index).cast("string")))
    keys = df.select(index, h.alias("_h"))
    first, rest = split_at(keys, math.ceil(val_fraction * keys.count()), ["_h", index])
    return (first.select(index, F.lit("validation").alias("split"))
            .unionByName(rest.select(index, F.lit("train").alias("split"))))


def term_counts(df: DataFrame, text, doc: str = "index", n_max: int = NGRAM_MAX,
                keep: Sequence[str] = ()) -> DataFrame:
    """(doc, *keep, term, tf): word 1..n_max-grams of lower-cased runs of >= 2 word
    characters, counted per document (F4); ``keep`` names columns of the document.

    A document in one row is counted in that row, as the runs of its sorted n-grams: no
    task holds, spills or shuffles the terms of more than one. Only rows that share a
    document key or have none (their keys are looked up first, without the text) are
    aggregated. The input is hash-partitioned on the document key first, so the count
    and any later per-document window need no further exchange.
    """
    def grams(rows: DataFrame) -> DataFrame:
        # the token array is projected once; n-grams read that column
        toks = rows.select(F.col(doc), *keep, terms(as_col(text)).alias("_t"))
        return toks.select(doc, *keep, word_ngrams(F.col("_t"), n_max).alias("_g"))

    keys = df.groupBy(F.col(doc).alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = staged(keys.where((F.col("_n") > 1) & F.col("_of").isNotNull()).select("_of"), "repeated-documents")
    dealt = df.repartition(doc)
    own, same = F.col(doc).isNotNull(), F.col(doc) == F.col("_of")
    single = grams(dealt.where(own).join(repeated, same, "left_anti"))
    # each column is made of the one before, which is evaluated once
    single = single.select(doc, *keep, F.sort_array("_g").alias("_g"))
    starts = F.filter(F.sequence(F.lit(0), F.size("_g") - 1),
                      lambda i: (i == 0) | (F.get("_g", i) != F.get("_g", i - 1)))
    single = single.select(doc, *keep, "_g", F.when(F.size("_g") > 0, starts).alias("_s"))
    runs = F.transform("_s", lambda s, k: F.struct(F.get("_g", s).alias("term"), (
        F.coalesce(F.get("_s", k + 1), F.size("_g")) - s).cast("bigint").alias("tf")))
    single = explode_rows(single.select(doc, *keep, runs.alias("_r")), "_r", "_i", "_r")
    single = single.select(doc, *keep, "_r.term", "_r.tf")
    shared = dealt.join(repeated, same, "left_semi").unionByName(dealt.where(~own))
    shared = explode_rows(grams(shared), "_g", "_gi", "term").drop("_gi")
    return single.unionByName(shared.groupBy(doc, *keep, "term").agg(F.count(F.lit(1)).alias("tf")))


def fit_vocabulary(counts: DataFrame, n_docs, doc: str = "index",
                   max_df: float = MAX_DF, max_features: int = MAX_FEATURES) -> DataFrame:
    """Fitted vocabulary (F5): drop terms found in more than max_df of the
    documents, keep the max_features most frequent (ties by term), index them
    alphabetically. Output (term, term_index, df, tf)."""
    stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))
    kept = (stats.where(F.col("df") <= F.lit(max_df) * n_docs)
            .orderBy(F.col("tf").desc(), F.col("term").asc()).limit(max_features))
    # at most max_features rows: a single ordered window over them is bounded
    return kept.withColumn("term_index",
                           (F.row_number().over(Window.orderBy("term")) - 1).cast("bigint"))


def tfidf_weights(counts: DataFrame, vocab: DataFrame, n_docs, doc: str = "index") -> DataFrame:
    """Smoothed-idf TF-IDF with L2 norm per document (F6):
    w = tf * (ln((1 + n) / (1 + df)) + 1), divided by the document's norm.
    ``counts`` must come from :func:`term_counts` (partitioned by document)."""
    idf = F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + F.lit(1.0)
    # at most max_features rows
    v = F.broadcast(vocab.select("term", "term_index", idf.alias("idf")))
    w = counts.join(v, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return w.withColumn("weight", F.col("w") / norm).drop("tf", "idf", "w")


def featurize(labelled: DataFrame, text: str = "Sentence", doc: str = "index", label: str = "Class",
              seed: int = 0, prepare: Callable[[Column], Column] | None = None) -> DataFrame:
    """Split, fit on the training part, weight both parts.

    Output: index, split, Class, term_index, term, weight (sparse rows).

    ``prepare`` cleans the text; it runs behind the exchange that deals the documents
    out, not in the tasks of the scan, which may be few.

    The term counts feed both the fit and the weighting; they are written once to the
    shared folder, so the text is read, cleaned and cut into n-grams once.
    """
    split = train_val_split(labelled, doc, seed)
    # split and label ride along with the document, so nothing is joined to the terms
    docs = labelled.select(doc, text, label).join(split, doc)
    cleaned = prepare(F.col(text)) if prepare else F.col(text)
    counts = staged(term_counts(docs, cleaned, doc, keep=["split", label]), "term-counts")
    train = F.col("split") == "train"
    n_train = split.where(train).agg(F.count(F.lit(1))).scalar()
    vocab = fit_vocabulary(counts.where(train), n_train, doc)
    return tfidf_weights(counts, vocab, n_train, doc)
