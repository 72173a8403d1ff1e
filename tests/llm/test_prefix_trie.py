"""The trie against a model that holds every prefix as a tuple."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skein.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, p1 int, depth string"


def key(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:30]


def in_order(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, key((role or "", text or "")), (role or "", text or "")))
    return {c: [t[3] for t in sorted(v)] for c, v in own.items()}


def rebuild(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def model(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        turns = tuple(convs[c])
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
    return sorted((who[0], len(node), members[node[:-1]][0] if node else -1, len(who), kids[node], leaves[node],
                   saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
                  for node, who in members.items())


def corpus(seed, n=260):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", None, ""], ["a", "bb", "", None, "ééé", "中文 text", "the common first turn"]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 8)):
            text = texts[-1] if t == 0 and rng.random() < 0.4 else rng.choice(texts)
            text = f"own {c} {t}" if rng.random() < 0.3 else text
            rows.append((c if c % 17 else c + 1000, rng.choice([None, t, t, t, 0]), rng.choice(roles), text))
    rows += [(5000 + i, t, "user", f"same {t}") for i in range(120) for t in range(4)]      # a group of copies
    rows += [(9000, t, "user", f"long {t % 3}") for t in range(150)]                        # a long one, and
    rows += [(9001, t, "user", f"long {t % 3}") for t in range(140)]                        # what it shares
    rows += [(None, 0, "user", "nobody's"), (4, 0, "user", "twice"), (4, 0, "user", "twice"), (-7, 1, "x", "y")]
    return rows


def collect(df):
    assert df.columns == T.COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def turns(spark, rows):
    return T.ordered_turns(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA))


@pytest.mark.parametrize("seed", [1, 2])
def test_rebuilt_conversations(spark, seed):
    rows = corpus(seed)
    conv = F.col("conv")
    got = T.prefix_trie(*T.rebuilt(turns(spark, rows), F.crc32(conv.cast("string").cast("binary")) % 6,
                                   conv - conv % 100, 5))
    own = in_order(rows)
    assert collect(got) == model({c: rebuild({**own})[c] for c in own})


def test_small_sketch_and_stretches(spark, monkeypatch):
    """A sketch that proves next to nothing, and windows of seven turns."""
    monkeypatch.setattr(T, "BLOCK", 16)
    monkeypatch.setattr(T, "STRETCH", 7)
    monkeypatch.setattr(T, "BLOB_BYTES", 64)
    rows = corpus(3, 90)
    assert collect(T.prefix_trie(*T.sequences(turns(spark, rows)), bits=6)) == model(in_order(rows))


def test_screen_keeps_every_shared_prefix(spark):
    rows = corpus(4)
    seqs, _ = T.sequences(turns(spark, rows))
    made = T.prefixes(seqs)
    count = {tuple(r[:2]): r["n"] for r in made.groupBy("p1", "p2").agg(F.count("*").alias("n")).collect()}
    cut = {r["conv"]: r["cut"] for r in T.screened(made).collect()}
    proven = 0
    for r in made.collect():
        if r["depth"] >= cut.get(r["conv"], 1 << 60):
            assert count[r["p1"], r["p2"]] == 1
            proven += 1
    alone = sum(1 for n in count.values() if n == 1)
    assert proven >= 0.9 * alone > 0


def test_one_turn_very_long_texts_and_empty(spark):
    rows = [(1, 0, "user", "x" * 300_000), (2, 0, "user", "x" * 300_000), (3, None, None, None)]
    assert collect(T.prefix_trie(*T.sequences(turns(spark, rows)))) == model(in_order(rows))
    empty = turns(spark, [])
    assert collect(T.prefix_trie(*T.sequences(empty))) == []
    conv = F.col("conv")
    assert collect(T.prefix_trie(*T.rebuilt(empty, F.lit(1), conv, 5))) == []


def test_turnless_conversations(spark):
    rows = [(c, 0, "user", "only") for c in (101, 102, 103)]
    conv = F.col("conv")
    # none of them has a turn left: bases are absent, and one turn each is dropped
    got = collect(T.prefix_trie(*T.rebuilt(turns(spark, rows), F.lit(1), conv - conv % 100, 5)))
    assert got == model({101: [], 102: [], 103: []})
