"""The corpus explorer.

The command line of the original becomes ``ExploreOptions``; its printed reports
become DataFrames. The stage order is kept exactly, because both caps depend on
position and never commute with filters:

    read -> read_max -> drop deleted -> process_max -> subreddit filter ->
    field filter -> [summary, field statistics] -> text pipeline ->
    max length -> min length -> [vocabulary, records, pairs, threads]

Input is either typed rows (``pos`` and the comment columns) or schema-less records
(``pos``, ``value`` with the JSON text, as ``read_records`` gives them without a
schema). Records keep every field they have, known or not, and nulls that are
there; a field is only touched if an option asks for it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from skein.functions import predicates as P
from skein.functions import text as T
from skein.operators import ordered, pairs, taps, threads, vocab
from skein.operators.indexing import dense_index
from skein.session import staged


@dataclass
class ExploreOptions:
    text_field: str = "body"
    ignore_deleted: bool = False
    read_max: Optional[int] = None
    process_max: Optional[int] = None
    keep_subreddits: Optional[Sequence[str]] = None
    strip_subreddits: Optional[Sequence[str]] = None
    keep_fields: Optional[Sequence[str]] = None
    strip_fields: Optional[Sequence[str]] = None
    strip_specials: bool = False
    strip_digits: bool = False
    trim_whitespace: bool = False
    to_lower: bool = False
    tokenize: bool = False
    min_length: Optional[int] = None
    max_length: Optional[int] = None
    summary: bool = False
    list_fields: bool = False
    count_fields: bool = False
    count_field_values: bool = False
    vocab: bool = False
    vocab_order: Optional[str] = None  # 'count' | 'index' | 'word' | None (= word)
    reverse: bool = False
    brief: bool = False
    show_records: bool = False
    pairs: bool = False
    keep_parent: bool = False
    conversations: bool = False
    show_header: bool = True
    extra: dict = field(default_factory=dict)


USED = ("id", "parent_id", "subreddit", "subreddit_id", "author")
TEXT_OPTIONS = ("strip_specials", "strip_digits", "trim_whitespace", "to_lower", "tokenize")


def _typed(records: DataFrame, o: ExploreOptions) -> DataFrame:
    """Schema-less records with the fields that options use as string columns."""
    wanted = dict.fromkeys([*USED, "body", o.text_field])
    parsed = records.select("pos", "value", F.parse_json("value").alias("_r"))
    return parsed.select("pos", "value", *[F.try_variant_get("_r", f"$.{f}", "string").alias(f) for f in wanted])


def _field_filter(df: DataFrame, o: ExploreOptions, raw: bool) -> DataFrame:
    """Keep or strip fields; a record that has none left goes."""
    keys = F.json_object_keys("value")
    if o.keep_fields is not None:
        wanted = list(o.keep_fields)
        columns = [c for c in df.columns if c in wanted]
        left = F.arrays_overlap(keys, F.array(*map(F.lit, wanted)).cast("array<string>"))
    elif o.strip_fields is not None:
        gone = list(o.strip_fields)
        columns = [c for c in df.columns if c not in gone]
        left = F.size(F.array_except(keys, F.array(*map(F.lit, gone)).cast("array<string>"))) > 0
    else:
        return df
    always = ["pos", "value"] if raw else ["pos"]
    if raw:
        df = df.where(left)
    out = df.select(*always, *[c for c in columns if c not in always])
    if not raw:     # a null column of a typed row is an absent field
        there = [F.col(c).isNotNull() for c in out.columns if c != "pos"]
        out = out.where(reduce(lambda a, b: a | b, there, F.lit(False)))
    return out


def _need(df: DataFrame, fields: Sequence[str], what: str) -> None:
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"{what} needs the fields {missing}, which the field filter removed")


def explore(records: DataFrame, o: ExploreOptions) -> dict[str, DataFrame]:
    """Build every requested report; a dict of DataFrames by report name.

    Summary, field statistics, vocabulary, pair listing and the final count come from
    one pass over the source (``taps``), which runs here and writes their tallies only.
    Records are the rows themselves and are made when the caller acts on them. The
    caps and the conversations run jobs here as well; these read the source once more
    and write what the conversation display shows.
    """
    out: dict[str, DataFrame] = {}
    raw = "value" in records.columns
    df = ordered.take(records, o.read_max) if o.read_max is not None else records
    if raw:
        df = _typed(df, o)
    if o.ignore_deleted:
        df = df.where(P.not_deleted("body"))
    if o.process_max is not None:
        df = ordered.take(df, o.process_max)
    if o.keep_subreddits is not None:
        df = P.keep_groups(df, o.keep_subreddits)
    elif o.strip_subreddits is not None:
        df = P.strip_groups(df, o.strip_subreddits)
    df = _field_filter(df, o, raw)

    # taps that see rows before cleaning and length filters
    tally = taps.Tally(df)
    if o.summary:
        _need(df, ["body", "parent_id", "subreddit", "subreddit_id"], "the summary")
        tally.groups()
    if o.list_fields or o.count_fields or o.count_field_values:
        columns = [c for c in df.columns if c != "pos"]
        record = F.parse_json("value" if raw else F.to_json(F.struct(*columns)))
        wanted = None
        if raw and (o.keep_fields is not None or o.strip_fields is not None):
            def wanted(name):
                return name.isin(list(o.keep_fields)) if o.keep_fields is not None else ~name.isin(list(o.strip_fields))
        tally.fields(record, o.count_field_values, wanted)

    key = o.text_field
    cleaned = F.col(key) if key in df.columns else None
    kept = F.lit(True)
    if any(getattr(o, x) for x in TEXT_OPTIONS) or o.max_length or o.min_length or o.vocab:
        _need(df, [key], "the text options")
        # cleaned once, beside the field as it was, which the taps above count
        df = df.withColumn("_cleaned", T.preprocess_text(key, o.strip_specials, o.strip_digits,
                                                         o.trim_whitespace, o.to_lower, o.tokenize))
        cleaned = F.col("_cleaned")
    if o.max_length:
        kept = kept & P.max_text_length(o.max_length, "_cleaned", tokens=o.tokenize)
    if o.min_length:
        kept = kept & P.min_text_length(o.min_length, "_cleaned", tokens=o.tokenize)
    if o.vocab:
        tally.words(cleaned if o.tokenize else T.chars("_cleaned"), kept)
    if o.pairs:
        _need(df, ["id", "parent_id"], "the pair listing")
        tally.pairs(F.col("parent_id") if o.keep_parent else pairs.parent_key("parent_id"), kept)
    tally.rows(kept)

    tallies = tally.count(df)
    if o.summary:
        out["summary"] = taps.summary_totals(tallies)
        out["summary_groups"] = taps.summary_groups(tallies, tally)
    if o.list_fields or o.count_fields:
        out["fields"] = taps.fields(tallies, tally, o.count_fields)
    if o.count_field_values:
        out["field_values"] = taps.field_values(tallies)
    if o.vocab:
        v = taps.vocabulary(tallies)
        out["vocab"] = vocab.vocab_brief(v) if o.brief else vocab.vocab_ordered(v, o.vocab_order, o.reverse)
    if o.pairs:
        out["pairs"] = taps.listed_pairs(tallies, tally)
    out["count"] = taps.row_count(tallies)

    # reports that are rows, after cleaning and the length filters
    df = df.where(kept)
    if "_cleaned" in df.columns:
        df = df.withColumn(key, F.col("_cleaned")).drop("_cleaned")
    if o.show_records:
        out["records"] = df
    if o.conversations:
        _need(df, ["id", "parent_id", "author", "body"], "the conversation display")
        placed = staged(df.select("pos", "id", "parent_id", "author", "body"), "displayed")
        if not isinstance(df.schema["pos"].dataType, IntegralType):
            placed = dense_index(placed, "pos", "_n").drop("pos").withColumnRenamed("_n", "pos")
        thr = threads.threads(placed)
        out["conversations"] = threads.transcript(thr, show_header=o.show_header, clean=False) \
            .orderBy("root_pos", "rank")
    return out
