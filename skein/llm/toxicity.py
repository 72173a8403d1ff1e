"""A convolutional text classifier for toxicity, trained in numpy.

A word (A-Z lowered) is the sum of three hashed embeddings: of the whole word and of
its first ``HEADS`` bytes. Filters of several widths slide over the words of a whole
text, max pooling keeps each filter's strongest answer, and a logistic unit weighs
them. Weights and embeddings are fitted on all labelled rows; embeddings of buckets
seen in fewer than ``MIN_DOCS`` texts are zero, so rare words say nothing. A fixed
share of the rows is left out of the fit: they calibrate the score to a probability
(Platt) and give each language the threshold with the best F1; a language enters
nowhere else.

Labelled rows are hashed words once, dealt out to tasks of some ``ROWS`` rows each, and
checkpointed. In a round every task goes over its rows (Adam, Adagrad for the
embeddings) from the model of the round before, and one aggregate averages what they
found: an embedding by how often a task met its bucket, the rest by rows. A single
task makes all epochs in one round. The driver gets a model of a few MB a round, and
for the calibration counts of rows by language, label and 64th of the raw score.
Whole texts are scored at the scan, without a shuffle; long ones in stretches of words
that overlap by a filter's width.

Defined results: a document's label is the largest of its label rows, of which those
other than 0 and 1 do not count; of documents that share an id one text is learnt; a
null id has no label and is not held out; null and empty texts, and texts without
words, score what no word at all scores; repeated rows score row by row; without rows
of both labels every score is the share of label 1 (0 without labels); a language
without enough calibration rows has the threshold of all; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from skein.llm.common import make_importable, materialize, pick, read_table, slices, to_batch
from skein.session import cut_lineage

ROWS = 20_000           # labelled rows of a task
MIN_DOCS = 3
DEV_SHARE = 0.25        # of the labelled rows, for calibration
BUCKETS = 1 << 16
HEADS = (4, 7)          # bytes
DIM, FILTERS, WIDTHS = 16, 16, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY = 6, 32, 0.01, 1e-5
LEAST_STEPS = 300       # of the fit, when there are few rows
ROW_VISITS = 30_000     # from here on epochs are fewer, two at least
BITS = 1 << 24          # that tell most unlabelled ids from labelled ones
STEP = 64               # parts of a raw score of 1 that calibration tells apart
THRESHOLD = 0.3
MIN_DEV = 10            # calibration rows of each label that a language's threshold needs
TEXT_BYTES = 1 << 20
STRETCH = 1 << 12       # words that filters run over together
PAD = max(WIDTHS) - 1
CODES = np.dtype("<u2")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_SEEDS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


# ---- hashed words --------------------------------------------------------------

def _hash(raw: bytes) -> np.ndarray:
    """Bucket of each word and of its heads, (words, 1 + heads)."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, lens = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return np.zeros((0, 1 + len(HEADS)), dtype=CODES)
    first = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum())) - np.repeat(first, lens)
    power = np.cumprod(np.full(int(lens.max()), 0x01000193, dtype=np.uint32), dtype=np.uint32)
    values = (data[inside].astype(np.uint32) + np.uint32(1)) * power[place]
    out = np.empty((len(starts), 1 + len(HEADS)), dtype=CODES)
    for i, (head, seed) in enumerate(zip((None, *HEADS), _SEEDS)):
        sums = np.add.reduceat(values if head is None else np.where(place < head, values, 0), first, dtype=np.uint32)
        sums = (sums ^ (sums >> np.uint32(15))) * seed
        out[:, i] = (sums ^ (sums >> np.uint32(13))) * seed >> np.uint32(16)
    return out


def hashed_words(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of whole texts put together, and how many each text has."""
    parts, sizes = [], []
    for t in texts:
        raw, n, at = (t or "").encode(), 0, 0
        while at < len(raw):
            end = at + TEXT_BYTES
            while end < len(raw) and _WORD[_LOWER[raw[end]]]:
                end += 1            # a stretch ends between words
            parts.append(_hash(raw[at:end]))
            n, at = n + len(parts[-1]), end
        sizes.append(n)
    return (np.concatenate(parts) if parts else np.zeros((0, 1 + len(HEADS)), CODES)), np.array(sizes, dtype=np.int64)


# ---- the network ---------------------------------------------------------------

class Model(NamedTuple):
    embed: np.ndarray       # (buckets, dim)
    filters: np.ndarray     # (dim, all offsets of all widths * filters)
    bias: np.ndarray        # (widths * filters,)
    weigh: np.ndarray       # (widths * filters,)
    base: float
    slope: float            # of the calibration
    shift: float
    thresholds: dict        # language -> threshold; None: of all


def _offsets():
    """(width's number, offset, columns of ``filters``) for every width and offset."""
    at = 0
    for i, width in enumerate(WIDTHS):
        for k in range(width):
            yield i, k, slice(at, at + FILTERS)
            at += FILTERS


def _answers(model: Model, words: np.ndarray) -> np.ndarray:
    """Every filter's answer at every word; ``words`` ends with PAD empty words."""
    made = words @ model.filters
    n = len(words) - PAD
    out = np.repeat(model.bias[None], n, axis=0)
    for i, k, cols in _offsets():
        out[:, i * FILTERS:(i + 1) * FILTERS] += made[k:k + n, cols]
    return out


def _padded(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words when PAD empty words follow each text, and first places."""
    first = np.cumsum(sizes + PAD) - (sizes + PAD)
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(codes)), first


def pooled(model: Model, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The strongest answers (at least 0) of every text; zeros without words."""
    out = np.zeros((len(sizes), len(model.bias)), dtype=np.float32)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for lo in range(0, len(codes), STRETCH):
        who = owner[lo:lo + STRETCH]
        texts, n = np.unique(who, return_counts=True)
        # words of the last text that go on behind the stretch still meet its filters
        more = codes[lo + len(who):lo + len(who) + PAD]
        more = more[owner[lo + len(who):lo + len(who) + PAD] == who[-1]]
        place, first = _padded(codes[lo:lo + len(who)], n)
        words = np.zeros((len(who) + PAD * len(texts) + PAD, DIM), dtype=np.float32)
        words[place] = model.embed[codes[lo:lo + len(who)]].sum(axis=1)
        if len(more):
            words[place[-1] + 1:place[-1] + 1 + len(more)] = model.embed[more].sum(axis=1)
        answers = _answers(model, words)[place]
        best = np.maximum.reduceat(answers, np.cumsum(n) - n, axis=0)
        out[texts] = np.maximum(out[texts], best)
    return out


def logits(model: Model, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return pooled(model, codes, sizes).astype(np.float64) @ model.weigh.astype(np.float64) + model.base


def scores(model: Model, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return _sigmoid(model.slope * logits(model, codes, sizes) + model.shift)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class _Adam:
    def __init__(self, *shapes):
        self.moments = [(np.zeros(s, np.float32), np.zeros(s, np.float32)) for s in shapes]
        self.t = 0

    def step(self, values, grads, rate):
        self.t += 1
        for (m, v), value, grad in zip(self.moments, values, grads):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            value -= rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-7)


def peaks(model: Model, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every filter's strongest answer in each text, and at which of ``codes``; texts
    have words."""
    best = np.full((len(sizes), len(model.bias)), -np.inf, dtype=np.float32)
    where = np.zeros(best.shape, dtype=np.int64)
    ends = np.cumsum(sizes)
    for lo in range(0, len(codes), STRETCH):
        hi = min(lo + STRETCH, len(codes))
        texts = np.arange(np.searchsorted(ends, lo, side="right"), np.searchsorted(ends, hi - 1, side="right") + 1)
        # words of the last text that go on behind the stretch still meet its filters
        upto = np.minimum(ends[texts], min(hi + PAD, ends[texts[-1]]))
        from_ = np.maximum(ends[texts] - sizes[texts], lo)
        place, _ = _padded(codes[lo:upto[-1]], upto - from_)
        words = np.zeros((upto[-1] - lo + PAD * len(texts) + PAD, DIM), dtype=np.float32)
        words[place] = model.embed[codes[lo:upto[-1]]].sum(axis=1)
        answers = _answers(model, words)[place[:hi - lo]]
        for t, x, y in zip(texts.tolist(), (from_ - lo).tolist(), (np.minimum(upto, hi) - lo).tolist()):
            at = answers[x:y].argmax(axis=0)
            found = answers[x + at, np.arange(answers.shape[1])]
            more = found > best[t]
            best[t, more], where[t, more] = found[more], lo + x + at[more]
    return best, where


def begin(known: np.ndarray, seed: int = 0) -> Model:
    """A model before the fit; ``known`` tells which buckets have an embedding."""
    rng = np.random.default_rng(seed)
    n_filters = len(WIDTHS) * FILTERS
    return Model(rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32) * known[:, None],
                 rng.normal(0, 0.3, (DIM, sum(WIDTHS) * FILTERS)).astype(np.float32),
                 np.zeros(n_filters, np.float32), rng.normal(0, 0.3, n_filters).astype(np.float32),
                 0.0, 1.0, 0.0, {})


def descend(model: Model, seen: np.ndarray, known: np.ndarray, codes: np.ndarray, sizes: np.ndarray,
            labels: np.ndarray, weight: np.ndarray, epochs: int, rng, part: tuple[float, float] = (0.0, 1.0)):
    """``epochs`` over the rows, of the given ``part`` of all steps: the model, the Adagrad
    sums of the embeddings (``seen``), and how many batches met each bucket."""
    embed, filters, bias, weigh = (x.copy() for x in model[:4])
    base, seen = np.array([model.base], np.float32), seen.copy()
    met = np.zeros(BUCKETS, dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    adam = _Adam(filters.shape, bias.shape, weigh.shape, base.shape)
    steps, step = epochs * -(-len(sizes) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(sizes))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            rows = rows[sizes[rows] > 0]
            step += 1
            if not len(rows):
                continue
            n = sizes[rows]
            some = np.concatenate([codes[bounds[r]:bounds[r + 1]] for r in rows])
            best, where = peaks(Model(embed, filters, bias, weigh, 0.0, 1.0, 0.0, {}), some, n)
            pool = np.maximum(best, 0)
            error = ((_sigmoid(pool @ weigh + base) - labels[rows]) * weight[labels[rows]] / len(rows)).astype(np.float32)
            # only the place of each maximum answers for it
            text, flt = np.nonzero(best > 0)
            spot, back, end = where[text, flt], error[text] * weigh[flt], np.cumsum(n)[text]
            d_filters, hits, grads = np.zeros_like(filters), [], []
            for i, k, cols in _offsets():
                mine = np.flatnonzero((flt // FILTERS == i) & (spot + k < end))     # no words behind a text
                column, word = cols.start + flt[mine] % FILTERS, some[spot[mine] + k]
                np.add.at(d_filters.T, column, embed[word].sum(axis=1) * back[mine, None])
                hits.append(word.astype(np.int64).ravel())
                grads.append(np.repeat(filters.T[column] * back[mine, None], some.shape[1], axis=0))
            d_bias = np.bincount(flt, back, len(bias)).astype(np.float32)
            d_weigh = pool.T @ error
            rate = RATE * (1 - (part[0] + (part[1] - part[0]) * step / (steps + 1)))
            uniq, inverse = np.unique(np.concatenate(hits), return_inverse=True)
            summed = np.zeros((len(uniq), DIM), np.float32)
            np.add.at(summed, inverse, np.concatenate(grads))
            summed *= known[uniq, None]
            adam.step([filters, bias, weigh, base],
                      [d_filters + DECAY * filters, d_bias, d_weigh + DECAY * weigh,
                       error.sum(keepdims=True)], rate)
            seen[uniq] += (summed ** 2).mean(axis=1, keepdims=True)
            met[uniq] += 1
            embed[uniq] -= 10 * rate * summed / (np.sqrt(seen[uniq]) + 1e-7)
    return model._replace(embed=embed, filters=filters, bias=bias, weigh=weigh, base=float(base[0])), seen, met


def text_counts(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """In how many of the texts each bucket is."""
    out, bounds = np.zeros(BUCKETS, dtype=np.int64), np.concatenate([[0], np.cumsum(sizes)])
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        for column in codes[lo:hi].T:
            out[np.unique(column)] += 1
    return out


def epochs_for(rows: int) -> int:
    return max(min(EPOCHS, max(2, -(-ROW_VISITS // rows))), -(-LEAST_STEPS * BATCH // rows))


def fit(codes: np.ndarray, sizes: np.ndarray, labels: np.ndarray, seed: int = 0) -> Model:
    """Weights and embeddings of one task's rows; each label weighs half."""
    known = text_counts(codes, sizes) >= MIN_DOCS
    weight = 0.5 * len(labels) / np.maximum(1, np.bincount(labels, minlength=2))
    return descend(begin(known, seed), np.zeros((BUCKETS, 1), np.float32), known, codes, sizes, labels, weight,
                   epochs_for(len(sizes)), np.random.default_rng(seed))[0]


def calibrate(model: Model, x, labels, weights, languages) -> Model:
    """Platt scaling and the thresholds, on the raw scores ``x`` of rows that the fit has
    not seen; ``weights`` says how many rows each stands for."""
    slope, shift = 1.0, float(np.log(max(weights[labels == 1].sum(), 1e-9) / max(weights[labels == 0].sum(), 1e-9)))
    y = np.where(labels == 1, 1 - 0.5 / (1 + weights[labels == 1].sum()), 0.5 / (1 + weights[labels == 0].sum()))
    for _ in range(50):             # Newton
        p = _sigmoid(slope * x + shift)
        g = weights * (p - y)
        h = weights * p * (1 - p) + 1e-9
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hess, [(g * x).sum() + 1e-3 * (slope - 1), g.sum()])
        slope, shift = slope - np.clip(move[0], -1, 1), shift - np.clip(move[1], -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    slope = max(slope, 1e-3)
    got = _sigmoid(slope * x + shift)

    def best(mine):
        grid = np.linspace(0.05, 0.95, 91)
        true = np.array([weights[mine & (labels == 1) & (got >= t)].sum() for t in grid])
        false = np.array([weights[mine & (labels == 0) & (got >= t)].sum() for t in grid])
        f1 = 2 * true / (weights[mine & (labels == 1)].sum() + true + false)
        return float(grid[np.flatnonzero(f1 >= f1.max() - 1e-9)].mean())

    def enough(mine):
        return min(weights[mine & (labels == 0)].sum(), weights[mine & (labels == 1)].sum()) >= MIN_DEV

    everything = np.ones(len(labels), dtype=bool)
    thresholds = {None: best(everything) if enough(everything) else THRESHOLD}
    for language in sorted({x for x in languages if x is not None}):
        mine = np.array([x == language for x in languages])
        if enough(mine):
            thresholds[language] = best(mine)
    return model._replace(slope=float(slope), shift=float(shift), thresholds=thresholds)


def constant(share: float) -> Model:
    """The model that gives every text the same score."""
    zero = np.zeros
    shift = np.log(share / (1 - share)) if 0 < share < 1 else (60.0 if share else -60.0)
    return Model(zero((BUCKETS, DIM), np.float32), zero((DIM, sum(WIDTHS) * FILTERS), np.float32),
                 zero(len(WIDTHS) * FILTERS, np.float32), zero(len(WIDTHS) * FILTERS, np.float32),
                 0.0, 1.0, float(shift), {None: THRESHOLD})


# ---- over tables -----------------------------------------------------------------

_TAKEN = f"key int, w double, seen double, {', '.join(f'v{i} double' for i in range(DIM))}"


def _rows_of(batch: pa.RecordBatch, keep) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """(codes, sizes, labels, languages) of the rows that ``keep`` selects."""
    b = batch.filter(keep)
    cells = b.column(b.schema.get_field_index("codes")).to_pylist()
    return (np.frombuffer(b"".join(cells), CODES).reshape(-1, 1 + len(HEADS)),
            np.array([len(c) // CODES.itemsize // (1 + len(HEADS)) for c in cells], dtype=np.int64),
            b.column(b.schema.get_field_index("label")).to_numpy().astype(int),
            b.column(b.schema.get_field_index("language")).to_pylist())


def _flat(model: Model) -> np.ndarray:
    """All but the embeddings, as rows of ``DIM`` numbers."""
    x = np.concatenate([model.filters.ravel(), model.bias, model.weigh, [model.base]])
    return np.concatenate([x, np.zeros(-len(x) % DIM)]).reshape(-1, DIM)


def _unflat(model: Model, embed: np.ndarray, rows: np.ndarray) -> Model:
    x, at, out = rows.astype(np.float32).ravel(), 0, []
    for y in (model.filters, model.bias, model.weigh):
        out.append(x[at:at + y.size].reshape(y.shape))
        at += y.size
    return Model(embed, *out, float(x[at]), 1.0, 0.0, {})


def _labelled(docs: DataFrame, known: DataFrame, parts: int, seed: int) -> DataFrame:
    """Hashed words of every labelled document, one text for each id, dealt out and
    mixed by the hash of the id. Of other documents only those go that far that share a
    bit of ``BITS`` with a labelled id."""
    def bit(id_):
        return F.pmod(F.xxhash64(id_), F.lit(BITS))

    # BITS / 64 rows at most
    some = known.groupBy(F.floor(bit("id") / 64).alias("of")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {BITS}) % 64 AS int))")).alias("bits"))
    rows = (docs.join(F.broadcast(some), F.floor(bit("id") / 64) == F.col("of"))
            .where(F.expr(f"getbit(bits, cast(pmod(xxhash64(id), {BITS}) % 64 AS int)) = 1"))
            .select("id", "language", F.col("text").cast("string").alias("text")))
    schema = pa.schema([("id", pa.int64()), ("language", pa.string()), ("n", pa.int64()), ("codes", pa.binary())])

    def encode(batches):
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                codes, sizes = hashed_words(part.column(2).to_pylist())
                ends = np.cumsum(sizes)
                cells = [codes[e - n:e].tobytes() for n, e in zip(sizes, ends)]
                yield to_batch(schema, [*part.columns[:2], sizes, cells])

    dev = F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(1000)) / 1000.0 < DEV_SHARE
    dealt = (rows.mapInArrow(encode, "id long, language string, n long, codes binary").repartition(parts, "id")
             .groupBy("id").agg(F.max(F.struct(F.xxhash64("codes").alias("by"), "n", "codes", "language")).alias("v"))
             .join(known.withColumnRenamed("id", "of"), F.col("id") == F.col("of"))
             .select("id", "label", dev.alias("dev"), "v.language", "v.n", "v.codes"))
    # a few tasks, however small or large the rows look to the planner
    return cut_lineage(dealt.repartition(parts, "id").sortWithinPartitions(F.xxhash64("id", F.lit(seed))))


def _round(rows: DataFrame, model: Model, seen: np.ndarray, known: np.ndarray, weight: np.ndarray, epochs: int,
           seed: int, part: tuple[float, float]) -> tuple[Model, np.ndarray]:
    """Every task goes over its rows; the mean of what they found."""
    shared = rows.sparkSession.sparkContext.broadcast((model, seen, known))     # some 4 MB
    schema = to_arrow_schema(StructType.fromDDL(_TAKEN))

    def learn(batches):
        import tempfile
        sizes, labels, size = [], [], 0
        with tempfile.TemporaryFile() as held:      # of a task's rows, so that it can go over them in any order
            for batch in batches:
                for some in slices(batch, "codes", TEXT_BYTES):
                    codes, n, y, _ = _rows_of(some, pc.invert(some.column(some.schema.get_field_index("dev"))))
                    held.write(codes.tobytes())
                    sizes, labels, size = [*sizes, n], [*labels, y], size + len(codes)
            if not size:
                return
            held.flush()
            codes = np.memmap(held, CODES, "r", shape=(size, 1 + len(HEADS)))
            old, was, known = shared.value
            sizes, labels = np.concatenate(sizes), np.concatenate(labels)
            rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
            new, now, met = descend(old, was, known, codes, sizes, labels, weight, epochs, rng, part)
        hit, flat = np.flatnonzero(met), _flat(new)
        values = np.concatenate([new.embed[hit].astype(np.float64), flat])
        # the places of a bucket that is met often weigh more; all else goes by rows
        yield to_batch(schema, [np.concatenate([hit, BUCKETS + np.arange(len(flat))]),
                                np.concatenate([met[hit], np.full(len(flat), len(sizes))]).astype(float),
                                np.concatenate([(now - was)[hit, 0], np.zeros(len(flat))]).astype(float), *values.T])

    mean = [(F.sum(F.col("w") * F.col(f"v{i}")) / F.sum("w")).alias(f"v{i}") for i in range(DIM)]
    got = (rows.mapInArrow(learn, _TAKEN).groupBy("key").agg(F.sum("seen").alias("seen"), *mean)
           .orderBy("key").toPandas())      # a row for each bucket at most, and those of the filters
    shared.unpersist()
    if not len(got):
        return model, seen
    key, values = got["key"].to_numpy(), got[[f"v{i}" for i in range(DIM)]].to_numpy()
    hit = key < BUCKETS
    embed, seen = model.embed.copy(), seen.copy()
    embed[key[hit]] = values[hit]
    seen[key[hit], 0] += got["seen"].to_numpy()[hit]
    return _unflat(model, embed, values[~hit]), seen


def train(docs: DataFrame, labels: DataFrame, seed: int = 0) -> Model:
    """Fit on all of ``docs`` (id, text, language) that ``labels`` (id, label) names."""
    make_importable(docs.sparkSession)
    known = materialize(labels.where("id IS NOT NULL AND label IN (0, 1)").groupBy("id")
                        .agg(F.max("label").cast("int").alias("label")), "labels")
    size = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(size) < 2:
        return constant(1.0 if 1 in size else 0.0)
    parts = -(-sum(size.values()) // ROWS)
    rows = _labelled(docs, known, parts, seed)

    def count(batches):
        found, per = np.zeros(BUCKETS, dtype=np.int64), np.zeros(4, dtype=np.int64)
        for batch in batches:
            dev = batch.column(batch.schema.get_field_index("dev"))
            for of, keep in ((0, pc.invert(dev)), (1, dev)):
                codes, n, y, _ = _rows_of(batch, keep)
                per += np.bincount(2 * of + y, minlength=4)
                if not of:
                    found += text_counts(codes, n)
        n = np.concatenate([found, per])
        yield to_batch(pa.schema([("key", pa.int32()), ("n", pa.int64())]), [np.flatnonzero(n), n[n > 0]])

    counted = rows.mapInArrow(count, "key int, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(BUCKETS + 4, dtype=np.int64)
    n[counted["key"].to_numpy(int)] = counted["n"].to_numpy(int)
    fitted, left = n[BUCKETS:BUCKETS + 2], n[BUCKETS + 2:]
    if not fitted.all():
        return constant(size[1] / sum(size.values()))
    had = n[:BUCKETS] >= MIN_DOCS
    weight, epochs = 0.5 * fitted.sum() / fitted, epochs_for(int(fitted.sum()))
    model, seen = begin(had, seed), np.zeros((BUCKETS, 1), np.float32)
    rounds = 1 if parts == 1 else epochs
    for i in range(rounds):
        model, seen = _round(rows, model, seen, had, weight, epochs // rounds, seed + i,
                             (i / rounds, (i + 1) / rounds))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("language", pa.string()), ("label", pa.int32()), ("x", pa.int64())])

    def judge(batches):
        for batch in batches:
            for some in slices(batch, "codes", TEXT_BYTES):
                codes, n, y, languages = _rows_of(some, pa.array(np.ones(some.num_rows, dtype=bool)))
                yield to_batch(schema, [languages, y, np.round(STEP * logits(shared.value, codes, n)).astype(np.int64)])

    # with too few rows to set some aside, those that were fitted
    judged = rows.where("dev") if left.all() else rows
    found = (judged.mapInArrow(judge, "language string, label int, x long").groupBy("language", "label", "x")
             .count().orderBy("x", "label", "language").toPandas())
    languages = [x if isinstance(x, str) else None for x in found["language"]]
    return calibrate(model, found["x"].to_numpy() / STEP, found["label"].to_numpy(int),
                     found["count"].to_numpy(float), languages)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (id, text, language, other columns kept) with score, threshold and
    flagged (score at least the threshold of the row's language) in place of its text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # about 4 MB
    kept = [c for c in docs.columns if c not in ("text", "language")]
    rows = docs.select(*kept, "language", F.col("text").cast("string").alias("text"))
    fields = rows.select(*kept).schema.add("score", "double").add("threshold", "double").add("flagged", "boolean")

    def apply(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                got = scores(model, *hashed_words(part.column(part.num_columns - 1).to_pylist()))
                least = [model.thresholds.get(x, model.thresholds[None])
                         for x in part.column(part.num_columns - 2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-2], pa.array(got, pa.float64()), pa.array(least, pa.float64()),
                     pa.array(got >= np.array(least), pa.bool_())], names=[*kept, "score", "threshold", "flagged"])

    return rows.mapInArrow(apply, fields)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are for testing only."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = pick(read_table(spark, sf_dir, "documents"), id="doc_id", text="text", language="lang")
    docs = docs.select(F.col("id").cast("long").alias("id"), "text", F.col("language").cast("string").alias("language"))
    labels = pick(read_table(spark, sf_dir, "labels"), id="doc_id", label="toxic")
    model = train(docs, labels.where(~held_out("id")))
    out = score(docs.withColumn("held_out", held_out("id")), model)
    return out.select(F.col("id").alias("doc_id"), "held_out", "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "threshold", "flagged")
