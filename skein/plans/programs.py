"""The pair extractor and the labelled-text featurizer as end-to-end jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.text import clean_labelled
from skein.operators.features import featurize, remove_stopwords
from skein.operators.pairs import modify_parent_id, pair_prepared, preprocess
from skein.session import staged
from skein.sources.files import read_comments, read_labelled
from skein.sources.sinks import write_pairs_tsv


def dump_pairs(spark: SparkSession, out_path: str, *in_files: str, **hooks) -> None:
    """Training pairs of the given dump files (plain or .bz2) as TSV, in stream
    order. The files are decompressed and parsed once: the preprocessed ids, parent
    keys and bodies are written, and both phases read that table."""
    prepared = preprocess(modify_parent_id(read_comments(spark, *in_files)), **hooks)
    rows = staged(prepared.select("pos", "id", "parent_id", "body"), "prepared")
    write_pairs_tsv(pair_prepared(rows), out_path)


def prepare_sentence(text) -> Column:
    """A labelled sentence cleaned and without stop words (F1, F2)."""
    return remove_stopwords(clean_labelled(text))


def featurize_file(spark: SparkSession, *paths: str, seed: int = 0) -> DataFrame:
    """Labelled TSV -> cleaned -> 90/10 split -> TF-IDF fitted on training rows.
    Output: sparse rows (index, split, Class, term_index, term, weight)."""
    return featurize(read_labelled(spark, *paths), seed=seed, prepare=prepare_sentence) \
        .select("index", "split", "Class", "term_index", "term", F.col("weight"))
