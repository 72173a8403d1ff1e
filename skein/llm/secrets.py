"""Secret scans: fixed patterns, and a battery of randomness tests.

Patterns find keys that look like keys (assignments, access ids, long hex runs).
The battery adds strings that only look random. Every run of 16 or more key
characters is a candidate; its encoding is inferred as the smallest alphabet that
has all its characters, and three tests ask whether it could be uniform there:
chi-squared of the symbol counts, the number of runs above and below the
alphabet's middle, and the lag-1 serial correlation of the symbols. The
Bonferroni-combined p-value is the candidate's score: uniform for a random
string, tiny for words.

How tiny depends on the length, so false discoveries are controlled by length
class. Each document also gives ordinary snippets (its letters and digits closed
up, candidates left out), scored the same way: one of every length class for each
``STRIDE`` characters of the whole text, at least one, so that they grow with the
text that is searched. Their scores are the distribution under "this is ordinary text"; in each class the
Benjamini-Hochberg rule at ``FDR`` picks the lowest score that is still
accepted. Scores are counted in bins, so the corpus-wide statistics are one
bounded histogram.

Scale. Two maps over the documents' rows and one histogram between them; no
shuffle carries text, and no key is hot.

Defined results: null and empty texts have no spans; repeated rows and null ids
are kept row by row; an empty table gives no rows; other columns are ignored
(``redact`` returns all columns as they were, but for the text).
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import materialize, pick, read_table, slices, to_batch

FDR = 0.01
SHORTEST = 16
TEXT_BYTES = 2 << 20        # text looked at together
STRIDE = 512            # closed-up characters that give a snippet of every class
CLASSES = np.array([16, 18, 20, 24, 32, 40, 64, 128])   # lengths from each to the next
BINS = 240              # of a quarter of -log10 p
KINDS = ("assign", "access", "hex", "random")

# Fixed patterns and least lengths of the base kinds. Only the named words may
# be in either case, of A-Z alone.
_EITHER = {c: f"[{c.upper()}{c}]" for c in "abcdefghijklmnopqrstuvwxyz"}
_NAMES = "|".join("".join(_EITHER.get(c, c) for c in name) for name in
                  ("password", "passwd", "secret", "token", "api_")).replace(
                      "_", "_?" + "".join(_EITHER[c] for c in "key"))
ASSIGN = re.compile(rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_KEY = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
_RUNS = bytes(b if b in _KEY else 32 for b in range(256))
_NOT_ALNUM = bytes(b for b in range(256) if b not in _KEY[:62])


def find(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base spans (start, kind's number, end) in order, and candidate runs
    (start, end): what the base spans leave of each run, where long enough."""
    if not text:
        return [], []
    raw = text.encode()
    base, runs = [], []
    low = raw.lower()
    if any(w in low for w in _WORDS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                 if len(m.group(2)) >= LEAST["assign"]]
    # access ids and hex runs are long enough to lie in a candidate run
    if max(map(len, raw.translate(_RUNS).split()), default=0) >= SHORTEST:
        runs = [m.span() for m in CANDIDATE.finditer(text)]
        for a, b in runs:
            base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, a, b)
                     if m.end() - m.start() >= LEAST["access"]]
            base += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, b)
                     if m.end() - m.start() >= LEAST["hex"]]
    base.sort()
    free, i = [], 0
    for a, b in runs:
        while i < len(base) and base[i][2] <= a:
            i += 1
        j = i
        while j < len(base) and base[j][0] < b:
            if base[j][0] - a >= SHORTEST:
                free.append((a, base[j][0]))
            a, j = max(a, base[j][2]), j + 1
        if b - a >= SHORTEST:
            free.append((a, b))
    return base, free


# ---- the battery ---------------------------------------------------------------

_LOWER, _UPPER, _DIGIT, _OTHER = 1, 2, 4, 8     # what kinds of characters a string has
_HEXED, _B32 = 16, 32                           # all letters a-f; all digits 2-7
_erfc = np.frompyfunc(math.erfc, 1, 1)


def _tail(z: np.ndarray) -> np.ndarray:
    return _erfc(z / math.sqrt(2)).astype(float) / 2


def symbols(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equally long ASCII strings -> the symbols' places in each row's
    inferred alphabet, and the alphabets' sizes."""
    lower, upper = (text >= 97) & (text <= 122), (text >= 65) & (text <= 90)
    digit = (text >= 48) & (text <= 57)
    has_lower, has_upper, has_digit = lower.any(axis=1), upper.any(axis=1), digit.any(axis=1)
    other = (~(lower | upper | digit)).any(axis=1)
    letter = (text | 32) - 97                   # a, A -> 0
    one_case = ~(has_lower & has_upper)
    hexed = one_case & ((lower | upper) <= (letter < 6)).all(axis=1)
    base32 = has_upper & ~has_lower & has_digit & (digit <= ((text >= 50) & (text <= 55))).all(axis=1)
    letters = has_lower | has_upper
    d, ten = text - 48, 10
    mixed = np.where(digit, d, np.where(upper, text - 65 + ten, np.where(lower, text - 97 + 36, 62 + (text & 1))))
    rows = [
        (other, mixed, 64),
        (~letters, d, 10),
        (hexed & has_digit, np.where(digit, d, letter + ten), 16),
        (one_case & ~has_digit, letter, 26),
        (base32, np.where(digit, d - 2 + 26, letter), 32),
        (one_case, np.where(digit, d, letter + ten), 36),
        (~has_digit, np.where(upper, letter, letter + 26), 52),
        (np.ones(len(text), bool), mixed, 62)]
    out, size = np.zeros(text.shape, np.int64), np.zeros(len(text), np.int64)
    for fits, places, k in rows:
        mine = fits & (size == 0)
        out[mine], size[mine] = places[mine], k
    return out, size


def battery(text: np.ndarray) -> np.ndarray:
    """Combined p-value of every row (equally long ASCII strings, as bytes)."""
    if not len(text):
        return np.zeros(0)
    x, k = symbols(text.astype(np.int64))
    m, n = x.shape
    counts = np.bincount((np.arange(m)[:, None] * 64 + x).reshape(-1), minlength=64 * m).reshape(m, 64)
    df = k - 1.0
    chi = (counts.astype(float) ** 2).sum(axis=1) * k / n - n
    # Wilson-Hilferty: the cube root of a chi-squared value is nearly normal
    uniform = _tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df)))
    high = 2 * x >= k[:, None]
    n1 = high.sum(axis=1).astype(float)
    n2 = n - n1
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 1 + 2 * n1 * n2 / n
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-12))
    run = np.where((n1 > 1) & (n2 > 1), 2 * _tail(np.abs(runs - mean) / spread), 0.0)
    c = x - x.mean(axis=1, keepdims=True)
    power = (c ** 2).sum(axis=1)
    r = (c[:, 1:] * c[:, :-1]).sum(axis=1) / np.maximum(power, 1e-12)
    serial = np.where(power > 0, 2 * _tail(np.abs(r + 1 / n) * math.sqrt(n)), 0.0)
    return np.minimum(1.0, 3 * np.minimum(np.minimum(uniform, run), serial))


def score_bins(strings: list[bytes]) -> np.ndarray:
    """Bin of each string's p-value; 0 is the most random."""
    out = np.zeros(len(strings), dtype=np.int64)
    by_length: dict[int, list[int]] = {}
    for i, s in enumerate(strings):
        by_length.setdefault(len(s), []).append(i)
    for n, at in by_length.items():
        step = max(1, (1 << 20) // n)
        for lo in range(0, len(at), step):
            some = at[lo:lo + step]
            rows = np.frombuffer(b"".join(strings[i] for i in some), "u1").reshape(len(some), n)
            p = np.maximum(battery(rows), 1e-300)
            out[some] = np.minimum(BINS - 1, np.floor(-4 * np.log10(p))).astype(np.int64)
    return out


def class_of(length) -> np.ndarray:
    return np.searchsorted(CLASSES, length, side="right") - 1


def snippets(text: str | None, runs: list[tuple[int, int]],
             base: list[tuple[int, int, int]]) -> list[bytes]:
    """Ordinary text of each length class from all over a document: one in each
    stretch of ``STRIDE`` characters, the last of which may be shorter."""
    if not text:
        return []
    parts, at = [], 0
    for a, b in sorted([*runs, *((s, e) for s, _, e in base)]):
        if a > at:
            parts.append(text[at:a])
        at = max(at, b)
    raw = ("".join([*parts, text[at:]])).encode().translate(None, _NOT_ALNUM)
    out = []
    for start in range(0, max(1, len(raw)), STRIDE):
        size = min(STRIDE, len(raw) - start)
        for i, n in enumerate(CLASSES.tolist()):
            free = size - n
            if free >= 0:       # another place for every class, spread over the stretch
                at = start + free * (2 * i + 1) // (2 * len(CLASSES))
                out.append(raw[at:at + n])
    return out


# ---- over the corpus -------------------------------------------------------------

FOUND = "doc_id long, base array<struct<start:int,kind:int,end:int>>, " \
        "runs array<struct<start:int,end:int,bin:int>>, null_bins array<int>"


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Base spans and scored candidates of every row, written to the shared
    folder; rows with ``null_bins`` are no documents but counts, by length class
    and bin, of the ordinary snippets of a batch."""
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    run = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bin", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(span)), ("runs", pa.list_(run)),
                        ("null_bins", pa.list_(pa.int32()))])

    def look(batches):
        for batch in (part for b in batches for part in slices(b, "text", TEXT_BYTES)):
            bases, owned, strings, ordinary = [], [], [], []
            for text in batch.column(1):
                text = text.as_py()
                base, runs = find(text)
                bases.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                owned.append(runs)
                strings += [text[a:b].encode() for a, b in runs]
                ordinary += snippets(text, runs, base)
            bins = iter(score_bins(strings).tolist())
            scored = [[{"start": a, "end": b, "bin": next(bins)} for a, b in runs] for runs in owned]
            counts = np.zeros((len(CLASSES), BINS), dtype=np.int64)
            if ordinary:
                np.add.at(counts, (class_of([len(s) for s in ordinary]), score_bins(ordinary)), 1)
            n = batch.num_rows
            yield to_batch(schema, [batch.column(0), bases, scored, [None] * n])
            yield to_batch(schema, [[None], [None], [None], [counts.reshape(-1)]])

    rows = pick(docs, id=id_col, text=text_col)
    rows = rows.select(F.col("id").cast("long"), F.col("text").cast("string"))
    return materialize(rows.mapInArrow(look, FOUND), "secret-scan")


def cutoffs(found: DataFrame, fdr: float = FDR) -> np.ndarray:
    """For each length class the last bin that is accepted (-1: none)."""
    null = np.zeros((len(CLASSES), BINS))
    counted = (found.where("null_bins IS NOT NULL").select(F.posexplode("null_bins").alias("at", "n"))
               .where("n > 0").groupBy("at").agg(F.sum("n").alias("n")))
    for r in counted.collect():                         # at most classes x bins rows
        null.flat[r["at"]] = r["n"]
    seen = np.zeros((len(CLASSES), BINS))
    runs = found.where("null_bins IS NULL").select(F.explode("runs").alias("r"))
    size = (F.col("r.end") - F.col("r.start")).alias("size")
    klass = sum((F.when(size >= int(c), 1).otherwise(0) for c in CLASSES), F.lit(-1)).alias("klass")
    for r in runs.groupBy(klass, F.col("r.bin").alias("bin")).count().collect():
        seen[r["klass"], r["bin"]] = r["count"]
    out = np.full(len(CLASSES), -1)
    for c in range(len(CLASSES)):
        accepted = np.cumsum(seen[c])
        chance = (np.cumsum(null[c]) + 1) / (null[c].sum() + 1)     # empirical p-value
        good = np.flatnonzero((accepted > 0) & (chance * accepted[-1] <= fdr * accepted))
        if len(good):
            out[c] = good[-1]
    return out


def _labels(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            fdr: float = FDR) -> DataFrame:
    """One row per document: counts of each kind, the SHA-256 of its base spans'
    labels, and the labels of all spans."""
    found = scan(docs, id_col, text_col)
    last = cutoffs(found, fdr)
    schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                        ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
                        ("n_random", pa.int64())])

    def tell(batches):
        for b in batches:
            rows = []
            for doc_id, base, runs in zip(*[c.to_pylist() for c in b.columns]):
                base = [(x["start"], x["kind"], x["end"]) for x in base]
                more = [(r["start"], 3, r["end"]) for r in runs
                        if r["bin"] <= last[class_of(r["end"] - r["start"])]]
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((doc_id, *counts, hashlib.sha256(_labels(base).encode()).hexdigest(),
                             _labels(sorted(base + more)), len(more)))
            if rows:
                yield to_batch(schema, zip(*rows))

    return found.where("null_bins IS NULL").select("doc_id", "base", "runs").mapInArrow(
        tell, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
              "spans string, n_random long")


def mask(text: str | None, last: np.ndarray, mark: str) -> str | None:
    """The text with every secret replaced; overlapping spans are one."""
    base, runs = find(text)
    spans = [(s, e) for s, _, e in base]
    if runs:
        bins = score_bins([text[a:b].encode() for a, b in runs])
        spans += [r for r, k in zip(runs, bins) if k <= last[class_of(r[1] - r[0])]]
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           length_col: str | None = "n_chars", mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """All rows with the secrets in their text replaced by ``mark`` and, where
    there is one, the length column of changed texts set anew."""
    last = cutoffs(scan(docs, id_col, text_col), fdr)
    names = docs.columns
    at = names.index(text_col)

    def clean(batches):
        for b in (part for whole in batches for part in slices(whole, text_col, TEXT_BYTES)):
            columns = list(b.columns)
            old = columns[at].to_pylist()
            new = [mask(t, last, mark) for t in old]
            columns[at] = pa.array(new, type=columns[at].type)
            if length_col in names:
                n = names.index(length_col)
                lengths = [len(y) if x != y else v for x, y, v in
                           zip(old, new, columns[n].to_pylist())]
                columns[n] = pa.array(lengths, type=columns[n].type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(clean, docs.schema)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets(read_table(spark, sf_dir, "documents"))
