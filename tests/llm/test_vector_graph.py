"""Graph search links and components against all pairs."""

import math

import numpy as np
import pytest

from skein.llm import vector_graph as V


def cloud(seed, n, dims=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    for i in range(n // 3):     # near copies of a few, exact and scaled copies of others
        x[i] = x[n - 1 - i % 7] + 0.05 * rng.normal(size=dims)
    x[5], x[6], x[7] = x[4], 2 * x[4], x[4]
    return x.astype(np.float32)


def model(rows, threshold=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and None not in v and len(v)
          and all(map(math.isfinite, v)) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in ok:
        for b in ok:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[i][1], dtype=float) for i in (a, b))
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if (x / np.sqrt(x @ x)) @ (y / np.sqrt(y @ y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out, seen = [], set()
    for i in links:
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - group:
                group.add(j)
                todo.append(j)
        seen |= group
        least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        out += [(rows[j][0], len(links[j]), least, rows[j][0] is not None and rows[j][0] == least) for j in group]
    return sorted(map(repr, out))


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, node int")
    got = V.near_vectors(df.repartition(3), **more).collect()
    return sorted(repr(tuple(r)[:4]) for r in got), {r.recall for r in got}


def test_links_and_components(spark):
    rows = [(1000 + i, v.tolist()) for i, v in enumerate(cloud(1, 200))]
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [float("nan")] * 16), (5, [1.0] * 15 + [float("inf")]),
             (6, [1.0] * 15 + [None]), (7, [1.0, 0.0]), (8, [1.0, 0.1]), (None, rows[4][1]), (None, None),
             (1004, rows[4][1]), (9, [3e38] * 16), (10, [1e-38] * 16)]
    got, recall = run(spark, rows)
    assert got == model(rows) and recall == {1.0}


@pytest.mark.parametrize("limit", [40, 100])
def test_small_shards_and_blocks(spark, monkeypatch, limit):
    """Many shards of several levels, and one tight group larger than a shard."""
    monkeypatch.setattr(V, "LIMIT", limit)
    monkeypatch.setattr(V, "TARGET", limit // 3)
    monkeypatch.setattr(V, "CENTROIDS", 4)
    monkeypatch.setattr(V, "LEVELS", 3)
    monkeypatch.setattr(V, "NEAR", 12)
    rng = np.random.default_rng(2)
    x = np.vstack([cloud(3, 150), rng.normal(size=16) + 0.03 * rng.normal(size=(130, 16))])
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    got, recall = run(spark, rows)
    want = model(rows)
    found, true = (sum(eval(r)[1] for r in x) for x in (got, want))
    assert 0.95 * true <= found <= true and min(recall) >= 0.9


def test_graph_search_finds_what_is_there():
    x = cloud(4, 600).astype(float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    q, b = V.range_search(x, x, V.build_graph(x, 1), 0.9, V.BEAM)
    true = (x @ x.T) >= 0.9
    assert true[q, b].all() and len(q) >= 0.98 * true.sum()


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert V.near_vectors(df).count() == 0
