"""Benchmark decontamination with a distributed positional inverted index.

Index. Training documents are cut into segments of a few MB of text. A segment
is a small inverted index of its own, written as one row: its dictionary of
terms and, for each term, the list of its positions. Positions count words over
the whole segment, with a gap between documents, so that one number says which
document and which place. The index does not depend on the benchmark; it is
written once and can be searched for any number of test sets.

Search. A test item is cut into windows of ``window`` consecutive words (one
window if it is shorter). In each segment every window starts from its rarest
term's list; the lists of the other terms, by rising length, are moved by the
distance of the words in the window and intersected with it. A place from which
every word of the window is found within ``slack`` words of where the phrase
would have it is a proximity match; with no distance at all it is an exact phrase. All windows take a
step together, by binary search in the segment's sorted (term, position) keys.

Scale. Segments never meet: building and searching are maps over documents
without a shuffle, and no term is hot. Test windows are cut into blocks of
``BLOCK_BYTES`` of item text, written to the shared folder and loaded by the
tasks one at a time, so neither a task nor the driver holds more than a block.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Defined results: null and empty texts have no words and are clean; repeated rows
and null ids are judged row by row; an item without words occurs nowhere; items
that share an id are one item, a null item id counts as the empty id; an empty
benchmark leaves all documents clean; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import (materialize, open_input, open_output, pick, read_table, slices,
                              to_batch)
from skein.session import scratch_path

WINDOW = 10
SLACK = 2
SEGMENT_BYTES = 2 << 20     # text of a segment; at least one document
BLOCK_BYTES = 4 << 20       # item text of a block of test windows
CANDIDATES = 1 << 19        # places looked at together
GAP = 64                    # positions between two documents

# bytes that make words, A-Z lowered; all others become spaces
_FOLD = bytes(ord(chr(b).lower()) if 65 <= b <= 90 else
              b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def _zip(a: np.ndarray | bytes) -> bytes:
    return pa.compress(a if isinstance(a, bytes) else a.tobytes(), codec="zstd", asbytes=True)


def _unzip(raw: bytes, size: int) -> bytes:
    return pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


# ---- index -----------------------------------------------------------------

SEGMENT = ("doc_ids array<long>, n_words array<int>, n_terms int, n_places int, term_bytes int, "
           "terms binary, term_ends binary, counts binary, places binary")


def build_segment(ids: pa.Array, texts: pa.Array) -> list:
    """The fields of one segment's row."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts])           # offsets from zero
    _, offsets, data = texts.buffers()
    data = (data.to_pybytes() if data else b"").translate(_FOLD)
    folded = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, offsets, pa.py_buffer(data)])
    lists = pc.split_pattern(folded, b" ")
    bounds = lists.offsets.to_numpy().astype(np.int64)
    coded = pc.dictionary_encode(lists.flatten())
    codes = coded.indices.to_numpy(zero_copy_only=False)
    terms = coded.dictionary
    lens = pc.binary_length(terms).to_numpy(zero_copy_only=False)
    real = lens[codes] > 0 if len(codes) else np.zeros(0, bool)     # runs of spaces make empty words
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))[real]
    codes = codes[real]
    n_words = np.bincount(doc, minlength=len(texts))
    place = np.arange(len(codes), dtype=np.int64) + GAP * doc
    order = np.argsort(codes, kind="stable")
    counts = np.bincount(codes, minlength=len(terms)).astype("<u4")
    delta = np.diff(place[order], prepend=0).astype("<i4")     # small within a list
    planes = delta.view("u1").reshape(-1, 4).T.copy()
    joined = b"".join(terms.to_pylist())
    return [ids.to_pylist(), n_words.tolist(), len(terms), len(codes), len(joined), _zip(joined),
            _zip(np.cumsum(lens).astype("<u4")), _zip(counts), _zip(planes)]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional inverted index of all documents, written to the shared folder."""
    schema = pa.schema([
        ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())),
        ("n_terms", pa.int32()), ("n_places", pa.int32()), ("term_bytes", pa.int32()),
        ("terms", pa.binary()), ("term_ends", pa.binary()), ("counts", pa.binary()),
        ("places", pa.binary())])

    def build(batches):
        for batch in batches:
            for part in slices(batch, "text", SEGMENT_BYTES):
                yield to_batch(schema, [[x] for x in build_segment(part.column(0), part.column(1))])

    rows = pick(docs, id=id_col, text=text_col)
    rows = rows.select(F.col("id").cast("long"), F.col("text").cast("string"))
    return materialize(rows.mapInArrow(build, SEGMENT), "positional-index")


class Segment:
    """A segment's row, opened for search."""

    def __init__(self, row: dict):
        n_terms, n = row["n_terms"], row["n_places"]
        self.doc_ids, self.n_words = row["doc_ids"], np.array(row["n_words"], dtype=np.int64)
        ends = np.frombuffer(_unzip(row["term_ends"], 4 * n_terms), "<u4")
        offsets = np.concatenate([[0], ends]).astype("<i8")
        self.terms = pa.Array.from_buffers(pa.large_binary(), n_terms, [
            None, pa.py_buffer(offsets.tobytes()),
            pa.py_buffer(_unzip(row["terms"], row["term_bytes"]))])
        self.counts = np.frombuffer(_unzip(row["counts"], 4 * n_terms), "<u4").astype(np.int64)
        planes = np.frombuffer(_unzip(row["places"], 4 * n), "u1").reshape(4, n)
        delta = np.ascontiguousarray(planes.T).view("<i4").reshape(-1)
        self.places = np.cumsum(delta, dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)[:-1]]) if n_terms else np.zeros(0, np.int64)
        # a document's first place
        before = np.cumsum(self.n_words) - self.n_words
        self.doc_starts = before + GAP * np.arange(len(self.n_words))

    def search(self, block: "Block", slack: int) -> tuple[np.ndarray, ...]:
        """(window, place of its first word, document, exact) of every match in
        the segment."""
        none = np.zeros(0, np.int64)
        nothing = none, none, none, none.astype(bool)
        if not len(self.terms) or not len(block.windows):
            return nothing
        here = pc.index_in(block.terms, value_set=self.terms)
        here = pc.fill_null(here, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        used = block.windows >= 0
        local = np.where(used, here[block.windows], 0)
        live = np.flatnonzero((local >= 0).all(axis=1))
        if not len(live):
            return nothing
        local, used = local[live], used[live]
        # only the lists of terms that a live window has, as sorted (term, place) keys
        terms = np.unique(local[used])
        lens = self.counts[terms]
        at = np.arange(int(lens.sum())) + np.repeat(self.starts[terms] - (np.cumsum(lens) - lens), lens)
        dense = np.zeros(len(self.counts), np.int64)
        dense[terms] = np.arange(len(terms))
        keys = (np.repeat(np.arange(len(terms)), lens) << 40) | self.places[at]
        list_start = np.cumsum(lens) - lens
        length = np.where(used, lens[dense[local]], np.iinfo(np.int64).max)
        order = np.argsort(length, axis=1, kind="stable")       # the rarest term first
        first = length[np.arange(len(local)), order[:, 0]]
        found = []
        lo = 0
        while lo < len(local):
            hi = lo + max(1, int(np.searchsorted(np.cumsum(first[lo:]), CANDIDATES, side="right")))
            found.append(self._intersect(np.arange(lo, min(hi, len(local))), local, used, dense,
                                         order, first, list_start, keys, slack))
            lo = hi
        w, start, place, exact = (np.concatenate(x) for x in zip(*found))
        return live[w], start, np.searchsorted(self.doc_starts, place, side="right") - 1, exact

    @staticmethod
    def _intersect(some, local, used, dense, order, first, list_start, keys, slack):
        n = first[some]
        window = np.repeat(some, n)
        rare = order[window, 0]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        term = dense[local[window, rare]]
        place = keys[list_start[term] + nth] & ((1 << 40) - 1)

        def meet(window, start, place, slack, first_step):
            """Keep the starts for which every term has a place near its own."""
            exact = np.ones(len(window), dtype=bool)
            for step in range(first_step, local.shape[1]):
                j = order[window, step]
                wanted = used[window, j]
                base = (dense[local[window, j]] << 40) + start + j
                near = np.searchsorted(keys, base - slack)
                close = (near < len(keys)) & (keys[np.minimum(near, len(keys) - 1)] <= base + slack)
                spot = np.searchsorted(keys, base)
                same = (spot < len(keys)) & (keys[np.minimum(spot, len(keys) - 1)] == base)
                keep = ~wanted | close
                exact = (exact & (same | ~wanted))[keep]
                window, start, place = window[keep], start[keep], place[keep]
                if not len(window):
                    break
            return window, start, place, exact

        # around the rarest term's places first, then every start those allow
        window, start, place, _ = meet(window, place - rare, place, 2 * slack, 1)
        shift = np.arange(-slack, slack + 1)
        return meet(np.repeat(window, len(shift)), (start[:, None] + shift).reshape(-1),
                    np.repeat(place, len(shift)), slack, 0)


# ---- test windows -----------------------------------------------------------

class Block:
    """Windows of some items: rows of term numbers (-1 past a short window's
    end), and for each window the items that have it."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        terms: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], int] = {}
        owners: set[tuple[int, int]] = set()
        names: dict[str, int] = {}
        for item_id, text in items:
            codes = [terms.setdefault(w, len(terms)) for w in words_of(text)]
            owner = names.setdefault(item_id, len(names))
            for i in range(max(1, len(codes) - window + 1) if codes else 0):
                w = windows.setdefault(tuple(codes[i:i + window]), len(windows))
                owners.add((w, owner))
        self.names = np.array(list(names), dtype=object)
        self.terms = pa.array(list(terms), type=pa.large_binary())
        self.windows = np.full((len(windows), window), -1, dtype=np.int64)
        for w, i in windows.items():
            self.windows[i, :len(w)] = w
        self.lens = (self.windows >= 0).sum(axis=1)
        pairs = np.array(sorted(owners), dtype=np.int64).reshape(-1, 2)
        self.owners = pairs[:, 1]
        self.owner_at = np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1))

    def items_of(self, windows: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Different (document, item) pairs as document << 32 | item."""
        n = self.owner_at[windows + 1] - self.owner_at[windows]
        at = np.arange(int(n.sum())) + np.repeat(self.owner_at[windows] - (np.cumsum(n) - n), n)
        return np.unique((np.repeat(docs, n) << 32) | self.owners[at])


def write_blocks(items: DataFrame, window: int, id_col: str, text_col: str) -> list[str]:
    """Cut the test items into blocks and write them to the shared folder."""
    import pickle
    rows = pick(items, id=id_col, text=text_col).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
        F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    folder = scratch_path(items.sparkSession, "test-windows")
    paths = []
    for b in range(n):
        # items that share an id stay together
        some = rows.where(F.pmod(F.xxhash64("id"), F.lit(n)) == b) if n > 1 else rows
        block = Block([tuple(r) for r in some.collect()], window)
        paths.append(f"{folder}/block-{b:06d}.pickle")
        with open_output(paths[-1]) as out:
            out.write(pickle.dumps(block))
    return paths


_LAST: dict[str, Block] = {}


def _load(path: str) -> Block:
    import pickle
    if path not in _LAST:
        _LAST.clear()       # one block at a time
        with open_input(path) as f:
            _LAST[path] = pickle.load(io.BytesIO(f.read()))
    return _LAST[path]


# ---- search ------------------------------------------------------------------

RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
          "contaminated boolean, n_near long")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = SLACK,
                  id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row per document: its words, the words inside exact occurrences of
    windows, the items that occur (their number and the SHA-256 of their sorted,
    comma-joined ids), and the number of items with a proximity match
    (``n_near``; exact ones included)."""
    if window + 2 * slack >= GAP:
        raise ValueError(f"window + 2 * slack must stay under {GAP}")
    blocks = write_blocks(items, window, item_id_col, item_text_col)
    index = build_index(docs, id_col, text_col)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                        ("n_items", pa.int64()), ("items_sha256", pa.string()),
                        ("contaminated", pa.bool_()), ("n_near", pa.int64())])

    def find(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield judge(Segment({f: c[0].as_py() for f, c in
                                     zip(batch.schema.names, batch.slice(i, 1).columns)}))

    def judge(segment: Segment) -> pa.RecordBatch:
        docs_n = len(segment.doc_ids)
        cover = np.zeros(int(segment.n_words.sum()) + GAP * (docs_n + 1), dtype=np.int32)
        names: dict[int, list[str]] = {}
        near_items = np.zeros(docs_n, dtype=np.int64)
        for path in blocks:
            block = _load(path)
            window_no, start, doc, exact = segment.search(block, slack)
            np.add.at(cover, start[exact], 1)
            np.add.at(cover, start[exact] + block.lens[window_no[exact]], -1)
            for pair in block.items_of(window_no[exact], doc[exact]).tolist():
                names.setdefault(pair >> 32, []).append(block.names[pair & 0xFFFFFFFF])
            near_items += np.bincount(block.items_of(window_no, doc) >> 32, minlength=docs_n)
        sums = np.concatenate([[0], np.cumsum(np.cumsum(cover) > 0)])
        hit = sums[segment.doc_starts + segment.n_words] - sums[segment.doc_starts]
        found = [sorted(names.get(d, [])) for d in range(docs_n)]
        return to_batch(schema, [
            segment.doc_ids, segment.n_words, hit, [len(f) for f in found],
            [hashlib.sha256(",".join(f).encode()).hexdigest() for f in found],
            pa.array(hit > 0), near_items])

    return index.mapInArrow(find, RESULT)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return contamination(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "benchmark"))


_WORDS_SQL = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
OP1_SQL = f"""
WITH dw AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents),
iw AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS_SQL} AS w FROM benchmark),
pairs AS (SELECT DISTINCT item, list_slice(w, i + 1, i + 10) AS g
          FROM (SELECT item, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM iw WHERE len(w) > 0)),
win AS MATERIALIZED (SELECT g, row_number() OVER () AS wid FROM (SELECT DISTINCT g FROM pairs)),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
dg AS (SELECT rid, n, i, list_slice(w, i + 1, i + n) AS g
       FROM (SELECT rid, w, n, unnest(range(len(w) - n + 1)) AS i FROM dw, lens WHERE len(w) >= n)),
hits AS MATERIALIZED (SELECT rid, n, i, dg.g FROM dg WHERE g IN (SELECT g FROM win)),
cover AS (SELECT rid, count(DISTINCT p) AS n_hit
          FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha
          FROM (SELECT DISTINCT rid, item FROM hits JOIN pairs USING (g)) GROUP BY rid),
pos AS MATERIALIZED (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS p FROM dw),
freq AS (SELECT word, count(*) AS n FROM pos GROUP BY word),
places AS (SELECT wid, unnest(g) AS word, unnest(range(len(g))) AS j FROM win),
rare AS (SELECT wid, arg_min(word, n * 100 + j) AS word, arg_min(j, n * 100 + j) AS j
         FROM (SELECT wid, word, j, coalesce(n, 0) AS n FROM places LEFT JOIN freq USING (word)) GROUP BY wid),
starts AS (SELECT DISTINCT rid, wid, p - j + unnest([-{SLACK}, -1, 0, 1, {SLACK}]) AS s FROM rare JOIN pos USING (word)),
near AS (SELECT DISTINCT rid, wid FROM starts JOIN win USING (wid) JOIN dw USING (rid)
         WHERE list_bool_and(list_transform(range(len(g)), lambda k: s + k + {SLACK} >= 0 AND list_contains(
           list_slice(w, greatest(s + k - {SLACK}, 0) + 1, s + k + {SLACK} + 1), g[k + 1])))),
near_items AS (SELECT rid, count(DISTINCT item) AS n_near FROM near JOIN win USING (wid) JOIN pairs USING (g) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM dw LEFT JOIN cover USING (rid) LEFT JOIN items USING (rid) LEFT JOIN near_items USING (rid)
"""
