"""Target-distribution importance resampling over hashed word runs.

Words come from an untrained ``tokenizers`` pre-tokenizer, a ``Split`` by a regular
expression over the text with A-Z lowered, with their offsets. A feature is a run
of ``low`` to ``high`` consecutive words, a window from one word's offset pair to
another's, joined by one space; its bucket is the CRC-32 of its bytes modulo
``buckets``. A bucket's gain compares its share in the target with its share in the
corpus, a document's weight is the floored mean of its features' gains, and keyed
Gumbel noise turns the highest scores into a sample without replacement.

Texts are split once: the buckets of each document are written (two bytes a feature)
and read for the histogram and for the sums. Histograms are counted per task and
added up by bucket; only they reach the driver, ``buckets`` numbers each. The rank
comes from a range partitioning of narrow rows, never from one task. A very long text
is split in stretches that end between words.

Defined results: a null text has no words, a document without features the weight
0, and one of fewer than ``min_words`` words is not drawn; a null id is hashed as the
empty string and comes last among ties; repeated rows count, score and rank
row by row (rows that tie in id as well are told apart by their text); an empty
target or corpus has empty buckets; an empty table of documents gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import materialize, pick, read_table, slices, to_batch
from skein.operators.indexing import dense_index

LOW = HIGH = 1              # words of a feature
BUCKETS = 10_000
SHARE = 10                  # per cent of the eligible documents that are drawn
MIN_WORDS = 20
SEED = 2024
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TEXT_BYTES = 4 << 20        # of a batch that are split together
STRETCH = 1 << 18           # characters of one text that are split together
KEPT = 300_000              # words whose bytes a worker remembers

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def splitter():
    """The untrained pre-tokenizer: words with their offsets, the rest removed."""
    from tokenizers import Regex, pre_tokenizers
    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def words_of(text: str, split) -> list[tuple[str, tuple[int, int]]]:
    """Words of a whole text with their offsets in it, A-Z lowered."""
    out, start = [], 0
    text = text.encode().translate(_LOWER).decode()
    while start < len(text):
        end = len(text)
        if end - start > STRETCH:
            gap = _GAP.search(text, start + STRETCH)
            end = gap.start() if gap else end
        part = split.pre_tokenize_str(text[start:end])
        out += [(w, (a + start, b + start)) for w, (a, b) in part] if start else part
        start = end
    return out


class Buckets:
    """Buckets of the features of texts, for use inside a task."""

    def __init__(self, low: int, high: int, buckets: int):
        self.low, self.high, self.n = low, high, buckets
        self.split, self.crc = splitter(), {}
        self.kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def _crcs(self, words: list[str]) -> np.ndarray:
        crc = self.crc
        got = list(map(crc.get, words))
        for i, c in enumerate(got):
            if c is None:
                if len(crc) >= KEPT:
                    crc.clear()
                got[i] = crc[words[i]] = zlib.crc32(words[i].encode())
        return np.array(got, dtype=np.uint32)

    def of(self, text: str | None) -> tuple[int, np.ndarray]:
        """(words, buckets of all windows, repeats included)."""
        words = [w for w, _ in words_of(text or "", self.split)]
        if self.high == 1:
            return len(words), (self._crcs(words) % self.n).astype(self.kind)
        # a window grows by one word at a time: its CRC goes on from the shorter one's
        found, window = [], [zlib.crc32(w.encode()) for w in words]
        for size in range(1, min(self.high, len(words)) + 1):
            if size > 1:
                window = [zlib.crc32(b" " + w.encode(), c) for c, w in zip(window, words[size - 1:])]
            if size >= self.low:
                found.append(np.array(window, dtype=np.uint32))
        return len(words), (np.concatenate(found or [np.zeros(0, np.uint32)]) % self.n).astype(self.kind)


def bucket_rows(docs: DataFrame, low: int, high: int, buckets: int, name: str) -> DataFrame:
    """``docs`` (id, text) with its text as ``n_words`` and packed ``features``, written."""
    schema = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()),
                        ("features", pa.binary())])

    def split(batches):
        counter = Buckets(low, high, buckets)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                made = [counter.of(t) for t in part.column(2).to_pylist()]
                yield to_batch(schema, [part.column(0), part.column(1), [n for n, _ in made],
                                        [f.tobytes() for _, f in made]])

    hashed = docs.select(F.col("id").cast("long"), F.xxhash64("text").alias("text_hash"),
                         F.col("text").cast("string").alias("text"))
    return materialize(hashed.mapInArrow(split, "id long, text_hash long, n_words long, features binary"), name)


def histogram(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features in every bucket."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for cell in batch.column(0):
                total += np.bincount(np.frombuffer(cell.as_buffer(), kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield to_batch(schema, [some, total[some]])

    out = np.zeros(buckets, dtype=np.int64)
    for r in (rows.select("features").mapInArrow(count, "bucket int, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed target share over the corpus share)."""
    n = len(corpus)
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, text_hash, n_words, n_features, weight."""
    kind = np.dtype("<u2") if len(gain) <= 1 << 16 else np.dtype("<u4")
    shared = rows.sparkSession.sparkContext.broadcast(gain)     # one number a bucket
    schema = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()),
                        ("n_features", pa.int64()), ("weight", pa.int64())])

    def weigh(batches):
        gain = shared.value
        for batch in batches:
            found = [np.frombuffer(cell.as_buffer(), kind) for cell in batch.column(3)]
            sizes = [len(f) for f in found]
            sums = [int(gain[f].sum()) // max(1, len(f)) for f in found]
            yield to_batch(schema, [batch.column(0), batch.column(1), batch.column(2), sizes, sums])

    return rows.mapInArrow(weigh, "id long, text_hash long, n_words long, n_features long, weight long")


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        target_text: str = "text", low: int = LOW, high: int = HIGH, buckets: int = BUCKETS,
                        share: int = SHARE, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Every document: id, n_words, n_features, weight, score, rank (null: not drawn)."""
    rows = bucket_rows(pick(docs, id=id_col, text=text_col), low, high, buckets, "feature-buckets")
    wanted = bucket_rows(pick(target, text=target_text).select(F.lit(0).alias("id"), "text"),
                         low, high, buckets, "target-buckets")
    gain = gains(histogram(rows, buckets), histogram(wanted, buckets))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = materialize(weighted(rows, gain).withColumn("score", F.col("weight") + noise)
                         .withColumn("in", F.col("n_words") >= min_words), "resample-scores")
    k = scored.where("in").count() * share // 100
    # the eligible first, from the highest score on; one narrow range shuffle
    ranked = dense_index(scored, [F.col("in").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(),
                                  F.col("text_hash"), F.monotonically_increasing_id()], "_place")
    drawn = F.when(F.col("in") & (F.col("_place") < k), F.col("_place") + 1).cast("long")
    return ranked.select("id", "n_words", "n_features", "weight", "score", drawn.alias("rank"))


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the distribution of the benchmark."""
    out = importance_resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


# CRC-32 by its definition: a byte at a time, eight shifts of the reflected polynomial
CRC_SQL = """crc_table AS (
  SELECT list(v ORDER BY n) AS crc_of FROM (
    SELECT n, list_reduce([n::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8],
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c // 2) ELSE c // 2 END) AS v
    FROM range(256) r(n)))"""


def crc_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes in DuckDB (needs ``CRC_SQL``'s table beside it)."""
    return (f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform("
            f"range(length(hex(encode({text}))) // 2), lambda i: "
            f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)), "
            f"lambda c, b: xor(c // 256, crc_of[xor(c % 256, b) + 1])))")


OP12_SQL = f"""WITH {CRC_SQL},
lowered AS (
  SELECT 0 AS side, row_number() OVER () AS row, doc_id,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
found AS (SELECT side, row, unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
          FROM lowered WHERE text IS NOT NULL),
counted AS (SELECT side, row, word, count(*) AS n FROM found GROUP BY ALL),
bucketed AS (SELECT word, ({crc_sql('word')}) % 10000 AS bucket
             FROM (SELECT DISTINCT word FROM counted), crc_table),
held AS (SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s,
           coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
         FROM counted JOIN bucketed USING (word) GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM held),
gained AS (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain
           FROM held, totals),
weighed AS (SELECT row, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
            FROM counted JOIN bucketed USING (word) JOIN gained USING (bucket) WHERE side = 0 GROUP BY row),
noisy AS (
  SELECT l.row, l.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(l.doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h
  FROM lowered l LEFT JOIN weighed w ON w.row = l.row WHERE l.side = 0),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM noisy),
ranked AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place,
             count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (row)"""
