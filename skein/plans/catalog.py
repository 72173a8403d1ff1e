"""Registered queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame.

Every query reads the supplied tables (or data Spark derives from them) in full.
Bindings: ``conversations`` -> comments (reply trees), ``documents`` -> text and
vocabulary, ``documents`` + ``labels`` -> labelled sentences, ``events`` ->
ordered stream operators and JSON, ``pages`` -> special-character cleaning.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import predicates as P
from skein.functions import text as T
from skein.operators import ordered as O
from skein.operators import pairs, rows, stats, vocab
from skein.session import table
from skein.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _comments(spark, d):
    return tables.comments(spark, d)


def _prep(spark, d):
    """Comments as the pair extractor prepares them: parent keys, no deleted
    rows, whitespace collapsed."""
    return pairs.preprocess(pairs.modify_parent_id(_comments(spark, d)))


def _docs(spark, d):
    return table(spark, d, "documents")


def _events(spark, d):
    return tables.events(spark, d)


def _full_pipeline(text="text"):
    """The explorer's full text pipeline (H6)."""
    return T.preprocess_text(text, strip_specials=True, strip_digits_=True, trim=True, lower=True, tokenize_=True)


def _doc_tokens(spark, d):
    return _docs(spark, d).select(F.col("doc_id").alias("pos"), _full_pipeline().alias("tokens"))


def _joined(tokens):
    return F.array_join(tokens, " ")


# ---------------------------------------------------------------- pairs (J, A6)

@query("training_pairs")
def q_training_pairs(spark, d):
    return pairs.extract_pairs(_comments(spark, d))


@query("pairs_tsv")
def q_pairs_tsv(spark, d):
    p = pairs.extract_pairs(_comments(spark, d))
    return p.select("pos", F.concat_ws("\t", "parent_body", "reply_body").alias("line"))


@query("parent_key")
def q_parent_key(spark, d):
    return _comments(spark, d).select("id", pairs.parent_key("parent_id", strict=True).alias("parent_key"))


@query("list_pairs")
def q_list_pairs(spark, d):
    return pairs.list_pairs(_comments(spark, d))


@query("list_pairs_raw")
def q_list_pairs_raw(spark, d):
    return pairs.list_pairs(_comments(spark, d), keep_parent=True)


@query("verified_pairs")
def q_verified_pairs(spark, d):
    return pairs.verified_pairs(_prep(spark, d))


@query("paired_ids")
def q_paired_ids(spark, d):
    return pairs.paired_ids(pairs.verified_pairs(_prep(spark, d)))


@query("body_pairs")
def q_body_pairs(spark, d):
    return pairs.body_pairs(_prep(spark, d))


@query("record_pairs")
def q_record_pairs(spark, d):
    return pairs.record_pairs(_comments(spark, d))


@query("count_reply_pairs")
def q_count_reply_pairs(spark, d):
    return pairs.count_reply_pairs(_comments(spark, d))


@query("direct_replies")
def q_direct_replies(spark, d):
    return pairs.direct_replies(_comments(spark, d))


@query("pair_preprocess")
def q_pair_preprocess(spark, d):
    """Custom hooks: only users' comments, lower-cased and trimmed, at least 20 chars."""
    prep = pairs.preprocess(
        pairs.modify_parent_id(_comments(spark, d)),
        pre_filter=lambda: P.not_deleted("body") & (F.col("author") == "user"),
        transform=rows.compose(rows.wrap(T.to_lower), rows.wrap(T.trim_whitespace)),
        post_filter=lambda: P.min_text_length(20, "body"),
    )
    return pairs.body_pairs(prep)


# ---------------------------------------------------------------- text (H, F1)

def _doc_text(fn):
    return lambda spark, d: _docs(spark, d).select("doc_id", fn(F.col("text")).alias("text"))


QUERIES["trim_whitespace"] = _doc_text(T.trim_whitespace)
QUERIES["strip_digits"] = _doc_text(T.strip_digits)
QUERIES["to_lower"] = _doc_text(T.to_lower)
QUERIES["strip_emails"] = _doc_text(T.strip_emails)
QUERIES["strip_ips"] = _doc_text(T.strip_ips)
QUERIES["remove_specials"] = _doc_text(T.remove_specials)
QUERIES["remove_digits"] = _doc_text(T.remove_digits)


@query("keep_alnum")
def q_keep_alnum(spark, d):
    return table(spark, d, "pages").select("page_id", T.keep_alnum("html").alias("html"))


@query("tokenize")
def q_tokenize(spark, d):
    t = _docs(spark, d).select("doc_id", T.tokenize("text").alias("t"))
    return t.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), _joined(F.col("t")).alias("tokens"))


@query("preprocess_full")
def q_preprocess_full(spark, d):
    t = _doc_tokens(spark, d)
    return t.select(F.col("pos").alias("doc_id"), F.size("tokens").cast("bigint").alias("n_tokens"),
                    _joined(F.col("tokens")).alias("tokens"))


@query("text_length")
def q_text_length(spark, d):
    return _docs(spark, d).select("doc_id", T.text_length("text").cast("bigint").alias("length"),
                                  T.token_count(T.tokenize("text")).cast("bigint").alias("n_words"))


@query("clean_labelled")
def q_clean_labelled(spark, d):
    return tables.sentences(spark, d).select("index", T.clean_labelled("Sentence").alias("Sentence"))


# ---------------------------------------------------------------- rows (B) and predicates (P)

@query("map_project")
def q_map_project(spark, d):
    e = _events(spark, d)
    return rows.map_rows(e.select("event_id", "value", "event_type"),
                         value=F.round((F.col("value") + 2) * 3, 6),
                         event_type=F.upper("event_type"))


@query("flat_map_range")
def q_flat_map_range(spark, d):
    """flat_map(range): each event expands to (event_id % 4) rows 0..n-1."""
    e = _events(spark, d).select("event_id", (F.col("event_id") % 4).alias("n"))
    return rows.flat_map(e, rows.range_array("n"), name="value", keep=["event_id"])


@query("flat_map_tokens")
def q_flat_map_tokens(spark, d):
    docs = _docs(spark, d).select("doc_id", T.tokenize("text").alias("t"))
    return rows.flat_map(docs, "t", name="token", keep=["doc_id"])


@query("filter_rows")
def q_filter_rows(spark, d):
    e = _events(spark, d).select("event_id", "event_type", "value")
    return rows.filter_rows(e, (F.col("event_type") == "click") & (F.col("value") > 10))


@query("wrap_field")
def q_wrap_field(spark, d):
    c = _comments(spark, d).select("id", "body")
    return rows.wrap(T.keep_alnum, "body")(c)


@query("compose_chain")
def q_compose_chain(spark, d):
    f = rows.compose(T.keep_alnum, T.to_lower, T.trim_whitespace)
    return _docs(spark, d).select("doc_id", f(F.col("text")).alias("text"))


@query("with_computed")
def q_with_computed(spark, d):
    e = _events(spark, d).select("event_id", "user_id")
    out = rows.with_computed(e, F.col("user_id") * 2 + 1, name="computed")
    return out.select("record.*", "computed")


@query("strip_fields")
def q_strip_fields(spark, d):
    return rows.strip_fields(_comments(spark, d), ["author", "subreddit", "no_such_field"])


@query("keep_fields")
def q_keep_fields(spark, d):
    return rows.keep_fields(_comments(spark, d), ["id", "body", "no_such_field"])


@query("peek_observe")
def q_peek_observe(spark, d):
    """The tap's own metrics, taken while the rows pass to a sink."""
    e = _events(spark, d).select("event_id", "user_id", "event_type")
    tapped, seen = rows.peek(e, n=F.count(F.lit(1)), max_id=F.max("event_id"), users=F.sum("user_id"))
    tapped.write.format("noop").mode("overwrite").save()
    got = seen.get
    return spark.createDataFrame([(got["n"], got["max_id"], got["users"])], "n long, max_id long, users long")


@query("foreach_rows")
def q_foreach_rows(spark, d):
    n, total = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def consume(row):
        n.add(1)
        total.add(row.event_id)

    rows.foreach_partition(_events(spark, d).select("event_id"), consume)
    return spark.createDataFrame([(n.value, total.value)], "n long, total long")


@query("keep_groups")
def q_keep_groups(spark, d):
    return P.keep_groups(_comments(spark, d), ["s1", "s3"]).select("pos", "id", "subreddit")


@query("strip_groups")
def q_strip_groups(spark, d):
    return P.strip_groups(_comments(spark, d), ["s1", "s3"]).select("pos", "id", "subreddit")


@query("strip_groups_null")
def q_strip_groups_null(spark, d):
    return P.strip_groups(_comments(spark, d), ["s1", None, "s3"]).select("pos", "id", "subreddit")


@query("keep_groups_null")
def q_keep_groups_null(spark, d):
    return P.keep_groups(_comments(spark, d), [None, "s1"]).select("pos", "id", "subreddit")


@query("not_deleted")
def q_not_deleted(spark, d):
    return _comments(spark, d).where(P.not_deleted("body")).select("pos", "id")


@query("on_comment")
def q_on_comment(spark, d):
    return _comments(spark, d).where(P.on_comment("parent_id")).select("pos", "id")


@query("min_length")
def q_min_length(spark, d):
    return _docs(spark, d).where(P.min_text_length(1000, "text")).select("doc_id")


@query("max_length")
def q_max_length(spark, d):
    return _docs(spark, d).where(P.max_text_length(500, "text")).select("doc_id")


# ---------------------------------------------------------------- ordered (L, S, E9-E15)

@query("take_n")
def q_take_n(spark, d):
    return O.take(_events(spark, d).select("pos", "event_id", "event_type"), 100)


@query("drop_n")
def q_drop_n(spark, d):
    return O.drop(_events(spark, d).select("pos", "event_id"), 1000)


@query("drop_ties")
def q_drop_ties(spark, d):
    """A position that many rows share, or that is null: rows left by position."""
    user = F.when(F.col("user_id") % 5 != 0, F.col("user_id"))
    e = _events(spark, d).select(user.alias("pos"), "event_id")
    return O.drop(e, 777).groupBy("pos").agg(F.count(F.lit(1)).alias("n"))


@query("take_while")
def q_take_while(spark, d):
    return O.take_while(_events(spark, d).select("pos", "value"), F.col("value") < 300)


@query("drop_while")
def q_drop_while(spark, d):
    return O.drop_while(_events(spark, d).select("pos", "value"), F.col("value") < 300)


@query("read_max")
def q_read_max(spark, d):
    return O.take(_comments(spark, d), 100).select("pos", "id")


@query("process_max")
def q_process_max(spark, d):
    c = O.take(_comments(spark, d).where(P.not_deleted("body")), 100)
    return P.strip_groups(c, ["s1"]).select("pos", "id", "subreddit")


@query("concat_streams")
def q_concat_streams(spark, d):
    e = _events(spark, d).select("pos", "event_id", "event_type")
    click = F.col("event_type").eqNullSafe(F.lit("click"))
    return O.concat(e.where(click), e.where(~click))


@query("distinct_first")
def q_distinct_first(spark, d):
    return O.distinct_first(_events(spark, d), ["user_id"])


@query("count_rows")
def q_count_rows(spark, d):
    return O.count_rows(_events(spark, d))


@query("reduce_sum")
def q_reduce_sum(spark, d):
    return O.reduce(_events(spark, d), "user_id", "sum", seed=4)


@query("reduce_ordered")
def q_reduce_ordered(spark, d):
    """Per user, the fold ``lambda a, b: a`` over event types: the first one."""
    return O.to_dict_merge(_events(spark, d), "user_id", "event_type", merge="first")


@query("to_dict_last")
def q_to_dict_last(spark, d):
    return O.to_dict_last(_events(spark, d), "user_id", "event_type")


@query("to_dict_merge")
def q_to_dict_merge(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return O.to_dict_merge(_events(spark, d), "event_type", k, merge="sum")


@query("to_set")
def q_to_set(spark, d):
    return O.to_set(_events(spark, d), ["event_type"])


@query("to_list")
def q_to_list(spark, d):
    return O.to_list(_events(spark, d), "event_id")


@query("to_string")
def q_to_string(spark, d):
    return O.to_string(_events(spark, d), "user_id", sep=":")


@query("reduce_concat")
def q_reduce_concat(spark, d):
    """An ordered fold that does not commute, per key."""
    from skein.functions.udfs import ordered_reduce
    e = _events(spark, d).select("event_type", "event_id", (F.col("event_id") % 10).cast("string").alias("digit"))
    return ordered_reduce(e, "digit", lambda a, b: a + b, "event_id", "string", keys=["event_type"])


@query("reduce_concat_all")
def q_reduce_concat_all(spark, d):
    from skein.functions.udfs import ordered_reduce
    e = _events(spark, d).select("event_id", (F.col("user_id") % 10).cast("string").alias("digit"))
    return ordered_reduce(e, "digit", lambda a, b: a + b, "event_id", "string")


# ---------------------------------------------------------------- statistics

@query("summary_totals")
def q_summary_totals(spark, d):
    return stats.summary_totals(_comments(spark, d))


@query("summary_groups")
def q_summary_groups(spark, d):
    return stats.summary_groups(_comments(spark, d))


@query("inconsistent_names")
def q_inconsistent_names(spark, d):
    return stats.inconsistent_names(_comments(spark, d))


@query("group_counts")
def q_group_counts(spark, d):
    return stats.group_counts(_comments(spark, d))


def _records(spark, d):
    return stats.records_as_json(_comments(spark, d))


@query("list_fields")
def q_list_fields(spark, d):
    return stats.list_fields(_records(spark, d))


@query("count_fields")
def q_count_fields(spark, d):
    return stats.count_fields(_records(spark, d))


@query("count_field_values")
def q_count_field_values(spark, d):
    return stats.count_field_values(_records(spark, d))


@query("json_scan")
def q_json_scan(spark, d):
    e = _events(spark, d).select("event_id", F.from_json("props", "k bigint").alias("p"))
    return e.select("event_id", F.col("p.k").alias("k"))


# ---------------------------------------------------------------- vocabulary (V)

def _vocab(spark, d, min_count=1):
    return vocab.build_vocab(_doc_tokens(spark, d), "tokens", min_count=min_count)


@query("vocab")
def q_vocab(spark, d):
    return _vocab(spark, d)


@query("encode")
def q_encode(spark, d):
    docs = _docs(spark, d).select(F.col("doc_id").alias("pos"), "text")
    enc = vocab.encode(docs, _full_pipeline(), _vocab(spark, d))
    return enc.select(F.col("pos").alias("doc_id"), F.size("codes").cast("bigint").alias("n_codes"),
                      F.array_join(F.transform("codes", lambda c: c.cast("string")), " ").alias("codes"))


def _listing(by, reverse):
    return lambda spark, d: vocab.vocab_ordered(_vocab(spark, d), by, reverse)


QUERIES["vocab_by_count"] = _listing("count", True)
QUERIES["vocab_by_word"] = _listing(None, False)
QUERIES["vocab_by_index"] = _listing("index", False)
QUERIES["vocab_by_word_reversed"] = _listing("word", True)


@query("vocab_lookup_index")
def q_vocab_lookup_index(spark, d):
    """index -> word, count, for the numbers that the documents' lengths are."""
    keys = _docs(spark, d).select(F.col("n_chars").alias("index")).distinct()
    return vocab.lookup(_vocab(spark, d), keys, "index")


@query("vocab_brief")
def q_vocab_brief(spark, d):
    return vocab.vocab_brief(_vocab(spark, d))


@query("vocab_lookup")
def q_vocab_lookup(spark, d):
    bench = table(spark, d, "benchmark").select(
        F.explode(T.preprocess_text("text", True, True, True, True, True)).alias("word")).distinct()
    return vocab.lookup(_vocab(spark, d), bench, "word")


@query("char_vocab")
def q_char_vocab(spark, d):
    c = _comments(spark, d).select("pos", T.chars("body").alias("chars"))
    return vocab.build_vocab(c, "chars")


@query("vocab_pruned")
def q_vocab_pruned(spark, d):
    return _vocab(spark, d, min_count=5)


@query("vocab_by_group")
def q_vocab_by_group(spark, d):
    docs = P.keep_groups(_docs(spark, d), ["de"], "lang")
    toks = docs.select(F.col("doc_id").alias("pos"),
                       T.preprocess_text("text", True, True, True, True, True).alias("tokens"))
    return vocab.build_vocab(toks, "tokens")


# ---------------------------------------------------------------- threads (T)

def _threads(spark, d):
    from skein.operators import threads as TH
    return TH.threads(_comments(spark, d))


@query("threads")
def q_threads(spark, d):
    return _threads(spark, d).select("root_id", "root_pos", "id", "pos", "level", "rank")


@query("threads_limited")
def q_threads_limited(spark, d):
    from skein.operators.threads import limit_conversations
    t = limit_conversations(_threads(spark, d), 20)
    return t.select("root_id", "root_pos", "id", "pos", "level", "rank")


@query("thread_transcript")
def q_thread_transcript(spark, d):
    from skein.operators.threads import transcript
    return transcript(_threads(spark, d), show_header=True, clean=True)


@query("group_by_parent")
def q_group_by_parent(spark, d):
    from skein.operators.threads import group_by_parent
    return group_by_parent(_comments(spark, d))


# ---------------------------------------------------------------- featurizer (F)

@query("stopwords")
def q_stopwords(spark, d):
    """Every document, labelled or not: these steps use no label."""
    from skein.plans.programs import prepare_sentence
    return tables.sentences(spark, d).select("index", prepare_sentence("Sentence").alias("Sentence"))


@query("train_val_split")
def q_train_val_split(spark, d):
    from skein.operators.features import train_val_split
    return train_val_split(tables.labelled_sentences(spark, d), "index")


@query("ngrams")
def q_ngrams(spark, d):
    from skein.operators.features import term_counts
    from skein.plans.programs import prepare_sentence
    return term_counts(tables.sentences(spark, d), prepare_sentence("Sentence"), "index")


@query("tfidf_vocab")
def q_tfidf_vocab(spark, d):
    from skein.operators.features import fit_vocabulary, term_counts, train_val_split
    from skein.plans.programs import prepare_sentence
    inp = tables.labelled_sentences(spark, d)
    train = train_val_split(inp, "index").where(F.col("split") == "train").select("index")
    n = train.agg(F.count(F.lit(1))).scalar()
    v = fit_vocabulary(term_counts(inp.join(train, "index", "left_semi"), prepare_sentence("Sentence"), "index"), n)
    return v.select("term", "term_index", "df", "tf")


@query("tfidf")
def q_tfidf(spark, d):
    from skein.operators.features import featurize
    from skein.plans.programs import prepare_sentence
    f = featurize(tables.labelled_sentences(spark, d), prepare=prepare_sentence)
    return f.select("index", "split", "Class", "term_index", "term", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------- sources and sinks (A)

@query("row_index")
def q_row_index(spark, d):
    from skein.operators.indexing import dense_index
    return dense_index(_docs(spark, d).select("doc_id", "lang"), "doc_id", "index")


@query("processed_records")
def q_processed_records(spark, d):
    """What the explorer emits with --ignore-deleted --strip-specials --to-lower
    --trim-whitespace --min-length 10: the processed comment records (A7)."""
    c = _comments(spark, d).where(P.not_deleted("body"))
    body = T.preprocess_text("body", strip_specials=True, trim=True, lower=True)
    c = c.withColumn("body", body).where(P.min_text_length(10, "body"))
    return c.select("pos", "id", "parent_id", "subreddit", "body")


# ---------------------------------------------------------------- user functions (U)

@query("udf_scalar")
def q_udf_scalar(spark, d):
    from skein.functions.udfs import scalar
    upper = scalar(str.upper, "string")
    return _events(spark, d).select("event_id", upper("event_type").alias("event_type"))


@query("udtf_flat_map")
def q_udtf_flat_map(spark, d):
    from skein.functions.udfs import flat_map_rows
    e = _events(spark, d).select("event_id", (F.col("event_id") % 4).alias("n"))
    return flat_map_rows(e, range, "n").select("event_id", "elem", "value")


@query("udaf_reduce")
def q_udaf_reduce(spark, d):
    from skein.functions.udfs import grouped_reduce
    return grouped_reduce(_events(spark, d), ["event_type"], "user_id", lambda a, b: a + b, "bigint")


# ---------------------------------------------------------------- streaming (R)

HORIZON = "1 hour"      # staged event times are a millisecond per position


def _comment_stream(spark, d, name):
    from skein.streaming import streams as S
    staged = S.with_event_time(_comments(spark, d))
    return S.source(spark, S.stage_json(staged, name), staged.schema)


@query("stream_clean")
def q_stream_clean(spark, d):
    from skein.streaming import streams as S
    return S.run(S.clean_stream(_comment_stream(spark, d, "clean")), "clean")


def _stream_pairs(spark, d, name):
    from skein.streaming import streams as S
    found = S.pair_stream(_comment_stream(spark, d, name), HORIZON, "0 seconds")
    return S.run(found, name, keys=S.PAIR_KEYS, latest_by="parent_pos")


@query("stream_pairs")
def q_stream_pairs(spark, d):
    return _stream_pairs(spark, d, "pairs").select("pos", "id", "parent_id")


@query("stream_pairs_versions")
def q_stream_pairs_versions(spark, d):
    return _stream_pairs(spark, d, "versions")


def _late_comment_stream(spark, d, name):
    """Comments that arrive up to 400 positions late, in several micro-batches: many
    replies come before their parents, or before a later version of them. A last row
    without an id moves the watermark past all others."""
    from skein.streaming import streams as S
    comments = _comments(spark, d)
    end = comments.agg((F.max("pos") + 10_000).alias("pos"))
    staged = S.with_event_time(comments.unionByName(end, allowMissingColumns=True))
    path = S.stage_json(staged, name, late=F.pmod(F.xxhash64("pos"), F.lit(400)))
    return S.source(spark, path, staged.schema, files_per_batch=2)


@query("stream_late_pairs")
def q_stream_late_pairs(spark, d):
    from skein.streaming import streams as S
    found = S.exact_pair_stream(_late_comment_stream(spark, d, "late"), HORIZON, "1 second", spread=3)
    return S.run(found, "late")


@query("stream_pair_lines")
def q_stream_pair_lines(spark, d):
    from skein.streaming import streams as S
    lines = S.pair_line_stream(_late_comment_stream(spark, d, "pair-lines"), HORIZON, "1 second")
    return S.run(lines, "pair-lines", text="line")


@query("stream_summary")
def q_stream_summary(spark, d):
    from skein.streaming import streams as S
    return S.run(S.running_totals(_comment_stream(spark, d, "summary")), "summary", keys=["all"]).drop("all")


@query("stream_group_counts")
def q_stream_group_counts(spark, d):
    from skein.streaming import streams as S
    return S.run(S.running_counts(_comment_stream(spark, d, "groups"), ["subreddit_id"]),
                 "groups", keys=["subreddit_id"])


@query("stream_word_counts")
def q_stream_word_counts(spark, d):
    from skein.streaming import streams as S
    return S.run(S.running_word_counts(_comment_stream(spark, d, "words"), "body"),
                 "words", keys=["word"])


@query("stream_distinct")
def q_stream_distinct(spark, d):
    from skein.streaming import streams as S
    ev = S.with_event_time(_events(spark, d).select("pos", "user_id", "event_type"))
    src = S.source(spark, S.stage_json(ev, "distinct"), ev.schema)
    return S.run(S.distinct_stream(src, ["user_id"], "ts", "30 days"), "distinct")


@query("stream_field_counts")
def q_stream_field_counts(spark, d):
    from skein.streaming import streams as S
    path = S.stage_json(_comments(spark, d), "fields")
    lines = spark.readStream.text(path)
    return S.run(S.running_field_counts(lines, "value"), "fields", keys=["field"])


# ---------------------------------------------------------------- the explorer as one plan

@query("explore_vocab")
def q_explore_vocab(spark, d):
    """Explorer run: --ignore-deleted --process-max 400 --strip-subreddits s2
    --strip-specials --to-lower --trim-whitespace --tokenize --min-length 3 --vocab."""
    from skein.plans.explore import ExploreOptions, explore
    o = ExploreOptions(ignore_deleted=True, process_max=400, strip_subreddits=["s2"],
                       strip_specials=True, to_lower=True, trim_whitespace=True, tokenize=True,
                       min_length=3, vocab=True, vocab_order="index")
    return explore(_comments(spark, d), o)["vocab"]


@query("stream_vocab")
def q_stream_vocab(spark, d):
    from skein.streaming import streams as S
    src = _comment_stream(spark, d, "vocab").select("pos", T.tokenize("body").alias("tokens"))
    return S.run_vocab(src, "tokens", "vocab")


# ---------------------------------------------------------------- files, written and read back

def _scratch(spark, name):
    from skein.session import scratch_path
    return scratch_path(spark, name)


@query("read_bz2")
def q_read_bz2(spark, d):
    """Comments as a bzip2 JSON dump, read back in order."""
    from skein.sources.files import read_comments
    path = _scratch(spark, "dump")
    _comments(spark, d).orderBy("pos").drop("pos").write.option("compression", "bzip2").json(path)
    return read_comments(spark, path, dense_pos=True).select("pos", "id", "parent_id", "body")


@query("read_first")
def q_read_first(spark, d):
    """The explorer's --read-max on a bzip2 dump: the first 400 comments, of which
    those not deleted; no more of the dump is read."""
    from skein.sources.files import read_comments
    path = _scratch(spark, "dump")
    _comments(spark, d).orderBy("pos").drop("pos").write.option("compression", "bzip2").json(path)
    first = read_comments(spark, path, first=400, dense_pos=True)
    return first.where(P.not_deleted("body")).select("pos", "id", "parent_id", "body")


@query("read_many")
def q_read_many(spark, d):
    """Folders by event type, listed in order, and the first one again."""
    from skein.sources.files import read_lines
    path = _scratch(spark, "lines")
    e = _events(spark, d).select("event_type", "event_id")
    kinds = [r[0] for r in e.select("event_type").distinct().orderBy("event_type").collect()]
    for i, kind in enumerate(kinds):
        e.where(F.col("event_type") == kind).orderBy("event_id").select(F.col("event_id").cast("string")) \
            .write.text(f"{path}/type {i}")
    folders = [f"{path}/type {i}" for i in range(len(kinds))]
    return read_lines(spark, *folders, folders[0], dense_pos=True).select("pos", "value")


@query("read_labelled")
def q_read_labelled(spark, d):
    """Documents and their labels as tab-separated text, read back by row number."""
    from skein.sources.files import read_labelled
    path = _scratch(spark, "labelled")
    docs = _docs(spark, d).join(table(spark, d, "labels"), "doc_id", "left")
    text = F.translate("text", "\t\n\r", "   ")
    docs.orderBy("doc_id").select(text, F.col("quality").cast("int")).write.option("sep", "\t").option(
        "quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option(
        "ignoreTrailingWhiteSpace", "false").csv(path)
    return read_labelled(spark, path)


@query("write_pairs")
def q_write_pairs(spark, d):
    """The pair dump end to end: a bzip2 dump in, TSV lines out, in stream order."""
    from skein.plans.programs import dump_pairs
    from skein.sources.files import read_lines
    dump, out = _scratch(spark, "dump"), _scratch(spark, "pairs")
    _comments(spark, d).orderBy("pos").drop("pos").write.option("compression", "bzip2").json(dump)
    dump_pairs(spark, out, dump)
    return read_lines(spark, out, dense_pos=True).select(F.col("pos").alias("n"), F.col("value").alias("line"))


def _mixed_records(spark, d):
    """Records with missing, null, nested and mixed-type fields, as a JSON dump."""
    from skein.sources.files import read_records
    path = _scratch(spark, "records")
    third = F.col("event_id") % 3
    user = F.col("user_id")
    mixed = F.when(third == 0, F.concat(F.lit(', "mixed": "'), "event_type", F.lit('"'))).when(
        third == 1, F.concat(F.lit(', "mixed": '), F.when(user % 2 == 0, "true").otherwise("false"))).otherwise("")
    line = F.concat(F.lit('{"pos": '), "event_id", F.lit(', "user_id": '), user, mixed,
                    F.lit(', "gone": null, "nested": {"k": '), user % 4, F.lit("}}"))
    _events(spark, d).orderBy("event_id").select(line).write.option("compression", "bzip2").text(path)
    return read_records(spark, path, dense_pos=True)


@query("explore_fields")
def q_explore_fields(spark, d):
    """Explorer run on a dump: --strip-fields nested --count-fields. (Positions
    are row numbers; event ids start at 0 or 1.)"""
    from skein.plans.explore import ExploreOptions, explore
    records = _mixed_records(spark, d)
    start = _events(spark, d).agg(F.min("event_id")).first()[0]
    found = explore(records, ExploreOptions(strip_fields=["nested"], count_fields=True))["fields"]
    return found.withColumn("first_pos", F.col("first_pos") + start)


@query("explore_field_values")
def q_explore_field_values(spark, d):
    """Explorer run on a dump: --keep-fields mixed gone nested --count-field-values."""
    from skein.plans.explore import ExploreOptions, explore
    o = ExploreOptions(keep_fields=["mixed", "gone", "nested"], count_field_values=True)
    return explore(_mixed_records(spark, d), o)["field_values"]
