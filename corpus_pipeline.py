"""A training corpus from raw documents: language, near-duplicates, benchmark
leaks, secrets, packing. Every stage calls one operator of ``skein.llm`` on all
that the stage before kept; all but the last return the columns of documents.

Defined results: each operator's own; rows are told apart by id and text, so a
decision on one of several rows with the same id leaves the others alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import make_importable, materialize, read_table, row_key, without
from skein.llm.decontaminate import contamination
from skein.llm.language import document_evidence, identify
from skein.llm.packing import pack, token_pieces
from skein.llm.secrets import redact
from skein.llm.simhash import MAX_BITS, SHINGLE, simhash_groups


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the others go."""
    make_importable(spark)
    evidence = document_evidence(docs).withColumn("key", row_key("key", "text"))
    return without(docs, identify(evidence).where("NOT kept").select("key"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that with the smallest id."""
    make_importable(spark)
    key = F.xxhash64("doc_id", "text_hash")
    groups = materialize(simhash_groups(docs, shingle=SHINGLE, max_bits=MAX_BITS)
                         .select("root", "doc_id", key.alias("key")), "group-rows")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"]
    kept = materialize(groups.groupBy("root").agg(first.alias("kept")).withColumnRenamed("root", "of"),
                       "kept-rows")
    rows = groups.join(kept, groups.root == kept.of)
    out = without(docs, rows.where("key != kept").select("key"))
    # of rows that are the same in id and text, one stays
    again = materialize(rows.where("key = kept").groupBy("key").count().where("count > 1").select("key"),
                        "repeated-rows")
    if again.isEmpty():
        return out
    mark = row_key().alias("row_key")
    repeated = docs.select("*", mark).join(again, F.col("row_key") == again.key, "left_semi")
    return without(out, again).unionByName(repeated.dropDuplicates(["row_key"]).select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    keyed = docs.select(row_key().alias("doc_id"), "text")
    hits = contamination(keyed, read_table(spark, sf_dir, "benchmark"))
    return without(docs, hits.where("contaminated").select("doc_id"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    make_importable(spark)
    return redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of at most 2048 tokens."""
    make_importable(spark)
    return pack(token_pieces(docs))


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("secrets", mask_secrets),
    ("packing", best_fit_packing),
]

ORACLE_SQL = None   # text models, fingerprints and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
