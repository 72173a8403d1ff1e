"""Token ids, token files and packing against the whole encoder and brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from skein.llm import packing, token_files as TF
from skein.llm.tokens import IDS, encoder

TEXTS = ["", None, "one", "two words", " lead", "trail ", "line\nfeed", "two\n\nfeeds", "end\n",
         "a  b", "it's 'sre x'll, ok.", "naïve café über", "中文 字符", "tab\tbed", "a\x1c b",
         "x" * 5000, "word " * 4000, "a <|endoftext|> b", "\n", "\n\n", " ", "one"]


def docs(spark, texts=TEXTS):
    rows = [(i, t, f"rank{i}") for i, t in enumerate(texts)]
    rows += [(None, "no id", "x"), (3, "two words", "again")]
    return spark.createDataFrame(rows, "doc_id long, text string, rank string")


def truth(rows):
    out = []
    for doc_id, text in rows:
        out.append((doc_id, np.append(encoder().whole(text or ""), 0).astype(IDS)))
    return out


def test_word_by_word_equals_whole():
    rng = random.Random(5)
    letters = " \n\t\r.,;:'séß中​\x1c aB1_-"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
                     for _ in range(5000)]
    for text, ids in zip(texts, encoder().column(pa.array(texts))):
        assert ids.tolist() == encoder().whole(text or "").tolist(), text
    assert list(encoder().column(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("top", [0, 1, 7, 50_000, 2 ** 31, 2 ** 60 - 1, 2 ** 64 - 1])
@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_simple8b_round_trip(top, n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64, endpoint=True)
    if n > 100:
        ids[40:100] = 0     # a run for the widest selector
    words, counts = TF.pack(ids)
    sizes = np.full(len(counts), TF.BLOCK)
    if n:
        sizes[-1] = n - (len(counts) - 1) * TF.BLOCK
    assert len(words) == counts.sum()
    back = TF.unpack(words, np.cumsum(counts), sizes) if n else ids
    assert np.array_equal(back, ids)


def test_token_files(spark):
    df = docs(spark)
    manifest = TF.write_token_files(df)
    got = sorted(map(tuple, TF.read_token_files(manifest).collect()), key=lambda r: r[1])
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = sorted(truth(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for (doc_id, ids), row in zip(want, got):
        assert (row[0], row[1]) == (doc_id, at)
        at += row[2]
    assert len(want) == len(got)
    assert sorted((d if d is not None else -1, len(i), zlib.crc32(i.tobytes())) for d, i in want) \
        == sorted((r[0] if r[0] is not None else -1, r[2], r[3]) for r in got)
    one = TF.Reader(manifest.collect()[0]["path"])
    ids = np.concatenate([c for _, c in one.chunks()])
    for i in range(len(one.doc_ids)):
        assert np.array_equal(one.document(i), ids[one.starts[i]:one.starts[i + 1]])


def test_token_files_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert TF.read_token_files(TF.write_token_files(empty)).count() == 0


def check_packing(rows, df_rows, capacity):
    want = {}
    for doc_id, ids in truth(df_rows):
        want.setdefault(doc_id, []).append(ids)
    bins, pieces = {}, {}
    for r in rows:
        assert 1 <= r.length <= capacity
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, all_ids in want.items():
        need = []
        for ids in all_ids:
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            need += [(i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                     for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(need) == sorted((r.piece, r.start, r.length, r.ids_crc32)
                                      for r in pieces[doc_id])
    return len(bins)


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_packing(spark, rule):
    df = docs(spark).repartition(3)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    out = packing.pack(packing.token_pieces(df, capacity=512), capacity=512, rule=rule).collect()
    n = check_packing(out, rows, 512)
    assert n <= 1 + -(-sum(r.length for r in out) // 512)


def test_packing_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.token_pieces(empty)).count() == 0


def test_every_capacity_holds():
    rng = np.random.default_rng(3)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 300, 4000),
                                                           return_counts=True))}
    cost = 300 ** 2 * 1.2
    for rule in ("dot", "norm"):
        plan = packing.vector_best_fit(histogram, 512, max_docs=5, max_attention=cost, rule=rule)
        bins = {}
        for length, n in histogram.items():
            seq, off = plan.place(np.full(n, length), np.arange(n))
            for s, o in zip(seq.tolist(), off.tolist()):
                bins.setdefault(s, []).append((o, length))
        assert len(bins) == plan.sequences
        for places in bins.values():
            places.sort()
            assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist()
            assert len(places) <= 5 and sum(n for _, n in places) <= 512
            assert sum(n * n for _, n in places) <= cost
    with pytest.raises(ValueError):
        packing.vector_best_fit({600: 1}, 512)
