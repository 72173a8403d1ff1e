"""Language identification by Bayesian fusion of independent kinds of evidence.

    P(L | all) ~ P(text | L)^t * P(declared | L) * P(suffix | L) * P(L | host)

* text: naive Bayes over hashed byte trigrams of the letters, tempered by ``t``
  because neighbouring trigrams say much the same. Fitted on a sample of rows
  with a declared language, of about ``SAMPLE`` rows a language. Every declared
  value of ``min_rows`` rows or more is a language, however many there are; tags
  count by their first part in lower case (``en-US`` and ``EN_gb`` are ``en``).
* declared markup language and address suffix: how often each language (by its
  text alone) comes with this declaration or suffix, counted over all rows.
* host: the languages of the host's rows, smoothed towards those of its domain,
  those towards the whole corpus: a host with few rows takes its domain's prior.

Counts are grouped aggregates over all rows (map-side combined) and joined back
as plain written tables, so Spark broadcasts them when they are small and splits a
hot host when they are not. The text model is fitted and kept in blocks of
``BLOCK`` languages (65,536 numbers each): the driver and a task hold one block at
a time, and with one block a task loads it once. Only tables by language reach
every task whole. Text is read twice and never shuffled (once more for the fit of
each further block, sampled rows only).

Defined results: a row without letters, or whose best language is less likely
than ``min_posterior``, is rejected (language null); missing declarations,
suffixes and hosts say nothing; ties go to the language first by name; repeated
rows and null ids are kept row by row; an empty table, or one without any
declared language of ``min_rows`` rows, knows no language and rejects every
row; other columns are ignored; long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from skein.llm.common import (
    make_importable, materialize, new_file, open_input, open_output, pick, read_table, slices, to_batch)
from skein.llm.url_filter import host_and_path
from skein.session import scratch_path

SAMPLE = 2000           # rows a language that the text model is fitted on
MIN_ROWS = 2            # rows that make a declared value a language
BLOCK = 64              # languages whose text model is held together
GRAMS = 1 << 16
TEMPER = 0.2
SMOOTH = 0.5            # added to counts of trigrams, declarations and suffixes
STRENGTH = 20.0         # rows that a prior from the next level up is worth
MIN_POSTERIOR = 0.5
TEXT_BYTES = 1 << 20

# letters stay; other ASCII becomes a blank (text is in lower case by then)
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def trigrams(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts put together, and each text's first place
    (one more at the end)."""
    parts, ends = [], [0]
    for t in texts:
        parts.append(b" %s " % b" ".join((t or "").lower().encode().translate(_LETTERS).split()))
        ends.append(ends[-1] + max(0, len(parts[-1]) - 2))
    codes = []
    for p in parts:
        b = np.frombuffer(p, "u1").astype(np.uint32)
        codes.append(((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(16))
    return (np.concatenate(codes) if codes else np.zeros(0, np.uint32)), np.array(ends)


# ---- the text model ------------------------------------------------------------

def tag(declared: Column) -> Column:
    """The first part of a language tag, in lower case; null if empty."""
    first = F.substring_index(F.translate(F.lower(F.trim(declared)), "_", "-"), "-", 1)
    return F.when(first != "", first)


def known_languages(rows: DataFrame, min_rows: int = MIN_ROWS) -> tuple[list[str], DataFrame]:
    """Names of the languages in order, and a written table (known, told, n_rows):
    each name with its number and its declared rows. ``rows`` has ``tag``."""
    counts = (rows.where("tag IS NOT NULL").groupBy("tag").count()
              .where(F.col("count") >= min_rows).collect())         # a row a language
    size = {r["tag"]: r["count"] for r in counts}
    names = sorted(size)
    numbered = [(name, i, size[name]) for i, name in enumerate(names)]
    return names, materialize(
        rows.sparkSession.createDataFrame(numbered, "known string, told int, n_rows long").coalesce(1),
        "languages")


def fit_text(rows: DataFrame, languages: DataFrame, n: int, sample: int = SAMPLE) -> list[str]:
    """Fit log P(trigram | language) for the ``n`` languages, as one file of the
    shared folder for each block of them: a (trigrams, languages) table. ``rows``
    has ``key``, ``text`` and ``tag``."""
    folder = scratch_path(rows.sparkSession, "language-model")
    # rows by the hash of all they hold: about `sample` a language, spread evenly
    share = F.pmod(F.xxhash64("tag", "text", "key"), F.lit(1 << 30)) / float(1 << 30)
    schema = pa.schema([("language", pa.int32()), ("gram", pa.int32()), ("n", pa.int64())])
    files = []
    for low in range(0, n, BLOCK):
        size = min(BLOCK, n - low)

        def count(batches, low=low, size=size):
            total = np.zeros(size * GRAMS, dtype=np.int64)
            for batch in batches:
                for part in slices(batch, "text", TEXT_BYTES):
                    codes, ends = trigrams(part.column(1).to_pylist())
                    owner = part.column(0).to_numpy() - low
                    np.add.at(total, np.repeat(owner, np.diff(ends)) * GRAMS + codes, 1)
            some = np.flatnonzero(total)
            yield to_batch(schema, [some // GRAMS, some % GRAMS, total[some]])

        block = languages.where((F.col("told") >= low) & (F.col("told") < low + size))
        taken = (rows.join(block, F.col("tag") == F.col("known"))
                 .where(share < F.lit(float(sample)) / F.col("n_rows")).select("told", "text"))
        seen = np.full((GRAMS, size), SMOOTH)
        summed = (taken.mapInArrow(count, "language int, gram int, n long")
                  .groupBy("language", "gram").agg(F.sum("n").alias("n")).toPandas())
        np.add.at(seen, (summed["gram"].to_numpy(), summed["language"].to_numpy()), summed["n"].to_numpy())
        files.append(new_file(folder, "block", ".f32"))
        with open_output(files[-1]) as out:
            out.write(np.log(seen / seen.sum(axis=0)).astype(np.float32).tobytes())
    return files


def _blocks(files: list[str]) -> Callable[[int], np.ndarray]:
    """Read a block's table; the last one stays in memory."""
    held: list = [None, None]

    def load(i: int) -> np.ndarray:
        if held[0] != i:
            held[1] = None
            with open_input(files[i]) as f:
                held[:] = i, np.frombuffer(f.read(), np.float32).reshape(GRAMS, -1)
        return held[1]

    return load


def score_text(rows: DataFrame, files: list[str], n: int, temper: float) -> DataFrame:
    """``rows`` without its text, with the tempered log-likelihoods ``text_log``
    (empty for a text without letters); written to the shared folder."""
    kept = [c for c in rows.columns if c != "text"]
    fields = rows.select(*kept).schema.add("text_log", ArrayType(DoubleType()))
    # further blocks are read again for every slice, which is larger then
    slice_bytes = TEXT_BYTES if len(files) == 1 else 8 * TEXT_BYTES

    def score(batches):
        load = _blocks(files)
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                codes, ends = trigrams(part.column(part.schema.get_field_index("text")).to_pylist())
                lengths = np.diff(ends)
                some = np.flatnonzero(lengths)
                sums = np.zeros((len(some), n))
                for i in range(len(files) if len(some) else 0):
                    logs = load(i)
                    at = slice(i * BLOCK, i * BLOCK + logs.shape[1])
                    # texts one batch of trigrams at a time: bounded rows of the table
                    for lo, hi in _runs(lengths[some]):
                        first = ends[some[lo]]
                        sums[lo:hi, at] = np.add.reduceat(
                            logs[codes[first:ends[some[hi - 1] + 1]]], ends[some[lo:hi]] - first,
                            axis=0, dtype=np.float64)
                scores = [[] for _ in lengths]
                for i, row in zip(some.tolist(), (temper * sums).tolist()):
                    scores[i] = row
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in kept]
                    + [pa.array(scores, pa.list_(pa.float64()))], names=[*kept, "text_log"])

    return materialize(rows.mapInArrow(score, fields), "language-scores")


def _runs(lengths: np.ndarray, most: int = 1 << 18):
    """Neighbouring texts of about ``most`` trigrams together (one at least)."""
    lo, held = 0, 0
    for i, size in enumerate(lengths.tolist()):
        if held and held + size > most:
            yield lo, i
            lo, held = i, 0
        held += size
    if lo < len(lengths):
        yield lo, len(lengths)


# ---- the other evidence --------------------------------------------------------

def _domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _counts(rows: DataFrame, key: str) -> DataFrame:
    """(key, best, n): rows of each language for each non-empty key."""
    return (rows.where(f"{key} IS NOT NULL AND {key} != ''").groupBy(key, "best")
            .agg(F.count("*").alias("n")))


def _entries(name: str) -> Column:
    """Counts by language as a list of at most one entry a language."""
    return F.collect_list(F.struct("best", "n")).alias(name)


def _dense(entries, n: int) -> np.ndarray:
    out = np.zeros(n)
    for e in entries:
        out[e["best"]] = e["n"]
    return out


def host_priors(rows: DataFrame, overall: np.ndarray, strength: float = STRENGTH) -> DataFrame:
    """(host, host_log): log P(language | host), smoothed by domain and corpus.
    ``rows`` has ``host`` and ``best``, a language's number."""
    n = len(overall)
    counted = materialize(_counts(rows, "host").withColumn("domain", _domain(F.col("host"))), "host-counts")
    domains = (counted.groupBy("domain", "best").agg(F.sum("n").alias("n"))
               .groupBy(F.col("domain").alias("of_domain")).agg(_entries("domain_n")))
    hosts = counted.groupBy("host", "domain").agg(_entries("host_n"))

    def smooth(batches):
        for batch in batches:
            logs = []
            for own, up in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own, up = _dense(own, n), _dense(up, n)
                prior = (up + strength * overall) / (up.sum() + strength)
                logs.append(np.log((own + strength * prior) / (own.sum() + strength)).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(logs, pa.list_(pa.float64()))],
                                             names=["host", "host_log"])

    joined = hosts.join(domains, F.col("domain") == F.col("of_domain")).select("host", "host_n", "domain_n")
    return materialize(joined.mapInArrow(smooth, "host string, host_log array<double>"), "host-priors")


def _likelihood(counts: np.ndarray, totals: np.ndarray, kinds: int) -> np.ndarray:
    return np.log((counts + SMOOTH) / (totals + SMOOTH * kinds))


def identify(rows: DataFrame, min_posterior: float = MIN_POSTERIOR, temper: float = TEMPER,
             sample: int = SAMPLE, min_rows: int = MIN_ROWS) -> DataFrame:
    """``rows`` has key, text, declared, suffix, host (strings but for the key).
    One row each: key, text_hash, declared, text_language (by the text alone),
    language (null: rejected), posterior, kept."""
    result = ("text_hash long, declared string, text_language string, language string, "
              "posterior double, kept boolean")
    hashed = rows.select("key", F.xxhash64("text").alias("text_hash"), "declared",
                         tag(F.col("declared")).alias("tag"), "suffix", "host", "text")
    names, languages = known_languages(hashed, min_rows)
    if not names:
        none = F.lit(None).cast("string")
        return hashed.select("key", "text_hash", "declared", none.alias("text_language"),
                             none.alias("language"), F.lit(0.0).alias("posterior"),
                             F.lit(False).alias("kept"))
    n = len(names)
    files = fit_text(hashed, languages, n, sample)
    scored = score_text(hashed, files, n, temper)
    # each known language, n for any other declaration, n + 1 for none
    told = F.coalesce("told", F.when(F.col("tag").isNotNull(), n).otherwise(n + 1)).alias("told")
    scored = scored.join(languages, F.col("tag") == F.col("known"), "left").select(
        *[c for c in scored.columns if c != "tag"], told)
    best = F.when(F.size("text_log") > 0,
                  F.array_position("text_log", F.array_max("text_log")).cast("int") - 1)
    judged = scored.select("told", "suffix", "host", best.alias("best")).where("best IS NOT NULL")
    # P(declared | language)
    by_told, totals = np.zeros((n + 1, n)), np.zeros(n)
    for r in judged.groupBy("told", "best").count().collect():     # by language twice
        totals[r["best"]] += r["count"]
        if r["told"] <= n:
            by_told[r["told"], r["best"]] = r["count"]
    told_log = np.vstack([_likelihood(by_told, by_told.sum(axis=0), n + 1), np.zeros(n)])
    overall = (totals + SMOOTH) / (totals + SMOOTH).sum()
    hosts = host_priors(judged, overall).withColumnRenamed("host", "h_host")
    counted = materialize(_counts(judged, "suffix"), "suffix-counts")
    of_suffix = np.zeros(n)
    for r in counted.groupBy("best").agg(F.sum("n").alias("n")).collect():
        of_suffix[r["best"]] = r["n"]
    suffixes = counted.groupBy(F.col("suffix").alias("s_suffix")).agg(_entries("suffix_n"))
    suffixes = materialize(suffixes, "suffixes")
    kinds = suffixes.count()
    joined = (scored.join(hosts, F.col("host") == F.col("h_host"), "left")
              .join(suffixes, F.col("suffix") == F.col("s_suffix"), "left")
              .select("key", "text_hash", "declared", "text_log", "host_log", "suffix_n", "told"))
    flat = np.log(overall)
    no_suffix = np.zeros(n)

    def fuse(batches):
        for b in batches:
            col = {c: b.column(i).to_pylist() for i, c in enumerate(b.schema.names)}
            text = np.array([x or [0.0] * n for x in col["text_log"]]).reshape(-1, n)
            seen = np.array([bool(x) for x in col["text_log"]], dtype=bool)
            log = (text + np.array([x or flat for x in col["host_log"]]).reshape(-1, n)
                   + np.array([no_suffix if x is None else _likelihood(_dense(x, n), of_suffix, kinds)
                               for x in col["suffix_n"]]).reshape(-1, n)
                   + told_log[np.array(col["told"], dtype=int)])
            p = np.exp(log - log.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            top = p.argmax(axis=1)
            posterior = p[np.arange(len(p)), top]
            kept = seen & (posterior >= min_posterior)
            by_text = text.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2),
                 pa.array([names[i] if s else None for i, s in zip(by_text, seen)], pa.string()),
                 pa.array([names[i] if k else None for i, k in zip(top, kept)], pa.string()),
                 pa.array(posterior, pa.float64()), pa.array(kept, pa.bool_())],
                names=["key", "text_hash", "declared", "text_language", "language", "posterior", "kept"])

    key = scored.schema["key"].dataType.simpleString()
    return joined.mapInArrow(fuse, f"key {key}, {result}")


# ---- bindings --------------------------------------------------------------------

def document_evidence(docs: DataFrame) -> DataFrame:
    """documents: the lang column is the declaration, the source is the host."""
    rows = pick(docs, key="doc_id", text="text", declared="lang", host="source")
    return rows.select("key", F.col("text").cast("string"), F.col("declared").cast("string"),
                       F.lit(None).cast("string").alias("suffix"), F.col("host").cast("string"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """pages: visible text, the html element's lang, the host and its last label."""
    rows = pick(pages, key="page_id", url="url", html="html")
    host, _ = host_and_path(F.col("url"))
    text = F.regexp_replace("html", r"(?is)<(script|style|title)\b.*?</\1>|<!--.*?-->|<[^>]*>|&\w+;", " ")
    declared = F.regexp_extract("html", r"""(?i)<html[^>]*\blang=["']?([A-Za-z]+)""", 1)
    return rows.select("key", text.alias("text"), F.lower(declared).alias("declared"),
                       F.substring_index(host, ".", -1).alias("suffix"), host.alias("host"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    found = identify(document_evidence(read_table(spark, sf_dir, "documents")))
    return found.withColumnRenamed("key", "doc_id").drop("text_hash")


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, from all four kinds of evidence."""
    make_importable(spark)
    found = identify(page_evidence(read_table(spark, sf_dir, "pages")))
    return found.withColumnRenamed("key", "page_id").drop("text_hash")
