"""SimHash groups and components against all pairs on small inputs."""

import random
import re

import numpy as np
import xxhash

from skein.llm import simhash as S
from skein.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def model_fp(text, k=4):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i:i + k]).encode(), 42) for i in range(max(1, len(ws) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(x) for x in range(n)]


def test_fingerprint(monkeypatch):
    monkeypatch.setattr(S, "SHINGLES", 7)
    rng = random.Random(4)
    texts = [None, "", " \t\n", "one", "One two\x0bthree", "É é\xa0x A", "a b c d", "w " * 3000]
    texts += [" ".join(rng.choice("aBcÄ　d") for _ in range(rng.randint(1, 40))) for _ in range(50)]
    assert [S.fingerprint(t) for t in texts] == [model_fp(t) for t in texts]
    assert S.fingerprint("a b c", 2) == model_fp("a b c", 2)


def near_prints(seed, n):
    """Random prints with runs of neighbours at 1 to 6 bits."""
    rng = random.Random(seed)
    out = [0, 2 ** 64 - 1]
    while len(out) < n:
        x = rng.getrandbits(64) if rng.random() < .3 else rng.choice(out)
        for b in rng.sample(range(64), rng.randint(0, 6)):
            x ^= 1 << b
        out.append(x)
    return out


def test_links_are_exact(spark, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 100)
    monkeypatch.setattr(S, "PAIRS", 64)
    fps = sorted(set(near_prints(8, 900)))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    got = {(r.node): r.component for r in connected_components(S.segment_links(df, 4)).collect()}
    a = np.array(fps, dtype=np.uint64)
    pairs = [(i, j) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4) if j > i]
    want = roots(len(fps), pairs)
    group = {}
    for i, r in enumerate(want):
        group.setdefault(r, []).append(signed[i])
    want = {x: min(g) for g in group.values() if len(g) > 1 for x in g}
    assert got == want and len(pairs) > 300


def test_groups(spark):
    rng = random.Random(1)
    base = [" ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(120)) for _ in range(12)]
    rows = [(100 + i, t) for i, t in enumerate(base)] + [(i, base[i % 12].upper()) for i in range(40)]
    rows += [(200 + i, base[i] + " tail") for i in range(12)]
    rows += [(900, None), (901, ""), (902, "  "), (None, base[0]), (None, "alone words here now"), (5, base[5])]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, fp string, root int")
    got = S.simhash_groups(df).collect()
    fps = [model_fp(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = roots(len(rows), links)
    least = {}
    for (doc_id, _), r in zip(rows, root):
        least[r] = min([x for x in (least.get(r), doc_id) if x is not None], default=None)
    want = [(d, f - (1 << 64) if f >> 63 else f, least[r]) for (d, _), f, r in zip(rows, fps, root)]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.fp, r.component_id)) for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_groups(df).count() == 0


def test_components_of_long_chains_and_hubs(spark):
    rng = random.Random(6)
    n = 3000
    links = [(i, i + 1) for i in range(0, 1200)] + [(1500, i) for i in range(1501, 2500)]
    links += [(rng.randint(2500, n), rng.randint(2500, n)) for _ in range(300)] + [(7, 7), (-5, 2600)]
    rng.shuffle(links)
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = sorted({x for p in links if p[0] != p[1] for x in p})
    at = {x: i for i, x in enumerate(ids)}
    want = roots(len(ids), [(at[a], at[b]) for a, b in links if a != b])
    assert got == {x: ids[r] for x, r in zip(ids, want)}
