"""Embedding near-duplicates through a robust-pruned flat graph.

Build. Equal vectors collapse to one node. Nodes are dealt to cluster shards,
each to its ``OVERLAP`` nearest centroids, so that shards overlap. A shard builds
a flat graph over its members: each node's candidates are its nearest members and
some random ones, thinned by robust pruning (a candidate goes if a kept neighbour
is closer to it than the node by the factor ``ALPHA``), then joined by the reverse
edges. The adjacency lists of a node from all its shards are united.

Search. Every node is a query in its shards. A greedy beam search walks the united
graph from the shard's medoid; the result is then expanded by range: every found
node within the radius (and a margin) hands on its neighbours until nothing new is
within it. What is found is verified by cosine in double precision. A pair is
taken in the first shard that both have, so it counts once.

Audit. The links of a sample of nodes are counted by brute force against all
nodes; if recall is below ``RECALL`` all is done again with more overlap and a
wider beam.

Scale. Centroids come from samples of bounded size; shards over ``LIMIT`` members
are clustered again, and those that do not come apart are searched by blocks of
``LIMIT`` queries and ``LIMIT`` base nodes. A task returns one link per node (to the
smallest of its group) and its count of links, never all pairs.

Defined results: vectors that are null, zero or hold null or non-finite numbers
link with nothing, nor do vectors of different lengths with each other; repeated
rows and null ids are kept row by row; a component's id is its smallest id that is
not null (of a row that links with nothing: its own); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import materialize, open_input, open_output, pick, read_table, to_batch
from skein.llm.components import connected_components, merge_links
from skein.session import scratch_path

THRESHOLD = 0.9
OVERLAP = 2
TARGET, LIMIT = 700, 2048   # members a shard should have, and may have
CENTROIDS = 1024            # of one split
SAMPLE = 20_000             # members that centroids are fitted on
LEVELS = 4
NEAR, KEEP = 48, 24         # nearest candidates, and how many pruning keeps of them
FAR = 8                     # random candidates that are kept
ALPHA = 1.2
BEAM = 16
MARGIN = 0.05               # range expansion goes on from this much under the radius
AUDIT = 256                 # nodes whose links are counted by brute force
RECALL = 0.95
PAIRS = 1 << 19             # (query, node) pairs looked at together


def _matrix(column) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<f8").reshape(len(column), -1)


# ---- nodes -----------------------------------------------------------------------

def unit_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, size, unit): the vector over its length as little-endian doubles,
    null if it links with nothing. Written to the shared folder."""
    schema = pa.schema([("vec_id", pa.int64()), ("size", pa.int32()), ("unit", pa.binary())])

    def scale(batches):
        for b in batches:
            sizes, units = [], []
            for v in b.column(1):
                v = v.as_py()
                x = np.array(v if v and None not in v else [0.0], dtype=np.float64)
                top = np.abs(x).max()
                ok = np.isfinite(top) and top > 0
                x = x / top if ok else x            # so that no square can overflow or vanish
                sizes.append(len(x) if ok else None)
                units.append((x / np.sqrt((x * x).sum()) + 0.0).astype("<f8").tobytes() if ok else None)
            yield to_batch(schema, [b.column(0), sizes, units])

    return materialize(rows.select(F.col("vec_id").cast("long"), F.col("v").cast("array<double>"))
                       .mapInArrow(scale, "vec_id long, size int, unit binary"), "unit-vectors")


# ---- shards ----------------------------------------------------------------------

def fit_centroids(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means from evenly spaced members."""
    x = x.astype(np.float32)
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        c = np.where(norms > 0, sums / np.maximum(norms, 1e-12), c)
    return c


def _save(path: str, a: np.ndarray) -> None:
    out = io.BytesIO()
    np.save(out, a)
    with open_output(path) as f:
        f.write(out.getvalue())


def _load(path: str) -> np.ndarray:
    with open_input(path) as f:
        return np.load(io.BytesIO(f.read()))


def split(members: DataFrame, big: DataFrame, overlap: int, level: int) -> DataFrame:
    """Deal the members (shard, node, m, unit) of the shards in ``big`` (shard, n)
    to new, smaller shards."""
    folder = scratch_path(members.sparkSession, "centroids")

    def fit(table: pa.Table) -> pa.Table:
        shard, n = table.column("shard")[0].as_py(), table.column("n")[0].as_py()
        k = min(CENTROIDS, max(2, -(-overlap * n // TARGET)))
        rows = table.sort_by("node")
        path = f"{folder}/{shard}-{np.random.default_rng().integers(1 << 62):x}.npy"
        _save(path, fit_centroids(_matrix(rows.column("unit")), k))
        return pa.table({"shard": pa.array([shard], pa.int64()), "path": [path]})

    mine = members.join(big, "shard")
    share = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
    fitted = materialize(
        mine.where(share < F.lit(float(SAMPLE)) / F.col("n")).select("shard", "n", "node", "unit")
        .groupBy("shard").applyInArrow(fit, "shard long, path string"), "centroid-files")
    schema = pa.schema([("shard", pa.int64()), ("node", pa.int64()), ("m", pa.int64()),
                        ("unit", pa.binary())])

    def deal(batches):
        path, c = None, None
        for b in batches:
            paths = np.array(b.column("path").to_pylist(), dtype=object)
            units = b.column("unit")
            parent, node, m = (b.column(x).to_numpy() for x in ("shard", "node", "m"))
            cuts = np.flatnonzero(np.append(True, paths[1:] != paths[:-1])).tolist() + [len(paths)]
            for lo, hi in zip(cuts, cuts[1:]):
                if paths[lo] != path:
                    path, c = paths[lo], _load(paths[lo])
                near = _matrix(units.slice(lo, hi - lo)).astype(np.float32) @ c.T
                take = min(overlap, len(c))
                best = np.argpartition(-near, take - 1, axis=1)[:, :take]
                at = np.repeat(np.arange(lo, hi), take)
                # a child's number: 11 bits a level under the parent's
                yield to_batch(schema, [parent[at] | (best.reshape(-1) + 1) << (11 * level), node[at],
                                        m[at], units.take(pa.array(at))])

    dealt = (members.join(fitted, "shard").sortWithinPartitions("path")
             .mapInArrow(deal, "shard long, node long, m long, unit binary"))
    # a node can reach a child by one way only, as each parent has its own children
    return materialize(dealt, "shard-members")


def make_shards(nodes: DataFrame, overlap: int) -> DataFrame:
    """(shard, node, m, unit), a few rows for each node."""
    members = nodes.select(F.lit(0).cast("long").alias("shard"), "node", "m", "unit")
    done = []
    for level in range(LEVELS):
        sizes = materialize(members.groupBy("shard").agg(F.count("*").alias("n")), "shard-sizes")
        big = sizes.where(F.col("n") > LIMIT)
        if not big.count():
            break
        done.append(members.join(sizes.where(F.col("n") <= LIMIT).select("shard"), "shard", "left_semi"))
        members = split(members, big, overlap, level)
    for d in done:
        members = members.unionByName(d)
    return members


def blocks(members: DataFrame) -> DataFrame:
    """Members with ``block``; shards over the limit have several."""
    sizes = materialize(members.groupBy("shard").agg(F.count("*").alias("n")), "shard-sizes")
    count = F.ceil(F.col("n") / LIMIT)
    return materialize(members.join(sizes, "shard").select(
        "shard", "node", "m", "unit", count.cast("int").alias("of"),
        F.pmod(F.xxhash64("node"), count).cast("int").alias("block")), "shard-blocks")


# ---- graph -----------------------------------------------------------------------

def robust_prune(x: np.ndarray, rows: np.ndarray, candidates: np.ndarray, keep: int) -> np.ndarray:
    """The kept candidates (nearest first, -1 for none) of some rows of x."""
    c = np.maximum(candidates, 0)
    own = 1 - np.einsum("md,mnd->mn", x[rows], x[c])
    alive = candidates >= 0
    out = np.full((len(rows), min(keep, c.shape[1])), -1, dtype=np.int64)
    for t in range(out.shape[1]):
        some = np.flatnonzero(alive.any(axis=1))
        if not len(some):
            break
        first = alive[some].argmax(axis=1)
        best = c[some, first]
        out[some, t] = best
        between = 1 - np.einsum("md,mnd->mn", x[best], x[c[some]])
        # 1 - cosine grows with the square of the distance, so does the factor
        alive[some] &= ALPHA ** 2 * between > own[some]
        alive[some, first] = False
    return out


def build_graph(x: np.ndarray, seed: int) -> np.ndarray:
    """Neighbours of each row of ``x`` (-1 for none)."""
    m = len(x)
    x = x.astype(np.float32)
    if m == 1:
        return np.full((1, 1), -1)
    near = min(NEAR, m - 1)
    rng = np.random.default_rng(seed)
    rows = []
    for lo in range(0, m, 512):
        hi = min(m, lo + 512)
        sims = x[lo:hi] @ x.T
        sims[np.arange(hi - lo), np.arange(lo, hi)] = -2
        best = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        order = np.argsort(-np.take_along_axis(sims, best, axis=1), axis=1, kind="stable")
        best = np.take_along_axis(best, order, axis=1)
        far = rng.integers(0, m, (hi - lo, FAR))
        far[far == np.arange(lo, hi)[:, None]] = -1
        rows.append(np.hstack([robust_prune(x, np.arange(lo, hi), best, KEEP), far]))
    out = np.vstack(rows)
    a = np.repeat(np.arange(m), out.shape[1])
    b = out.reshape(-1)
    a, b = a[b >= 0], b[b >= 0]
    edges = np.unique(np.concatenate([a * m + b, b * m + a]))
    a, b = edges // m, edges % m
    # a node keeps its nearest in case very many point to it
    most = 3 * (KEEP + FAR)
    sims = np.einsum("ed,ed->e", x[a], x[b])
    order = np.lexsort((-sims, a))
    a, b = a[order], b[order]
    nth = np.arange(len(a)) - np.searchsorted(a, a)
    return _table(a[nth < most], b[nth < most], m)


def _table(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """Edges sorted by a as rows of neighbours, padded with -1."""
    n = np.bincount(a, minlength=m)
    out = np.full((m, max(1, int(n.max(initial=0)))), -1, dtype=np.int64)
    out[a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)] = b
    return out


# ---- search ----------------------------------------------------------------------

def range_search(q: np.ndarray, x: np.ndarray, graph: np.ndarray, threshold: float,
                 beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs of cosine >= threshold that the walk finds."""
    q32, x32 = q.astype(np.float32), x.astype(np.float32)
    n_q, n = len(q), len(x)
    medoid = int((x32 @ x32.mean(axis=0)).argmax())
    seen = np.zeros((n_q, n), dtype=bool)
    expanded = np.zeros((n_q, n), dtype=bool)
    sims = np.full((n_q, n), -2, dtype=np.float32)      # of the pairs that were looked at

    def look(rows, cols):
        """Measure (row, neighbour) pairs that are new."""
        for lo in range(0, len(rows), max(1, PAIRS // graph.shape[1])):
            hi = lo + max(1, PAIRS // graph.shape[1])
            to = graph[cols[lo:hi]]
            r = np.repeat(rows[lo:hi], to.shape[1])
            to = to.reshape(-1)
            new = to >= 0
            r, to = r[new], to[new]
            new = ~seen[r, to]
            r, to = r[new], to[new]
            seen[r, to] = True
            for at in range(0, len(r), PAIRS // 8):
                s = slice(at, at + PAIRS // 8)
                sims[r[s], to[s]] = np.einsum("pd,pd->p", q32[r[s]], x32[to[s]])

    every = np.arange(n_q)
    seen[:, medoid] = True
    sims[:, medoid] = q32 @ x32[medoid]
    wide = min(beam, n)
    active = every
    while len(active):      # each query expands the best of its beam that is still open
        at = sims[active]
        top = np.argpartition(-at, wide - 1, axis=1)[:, :wide]
        value = np.take_along_axis(at, top, axis=1)
        value[expanded[active[:, None], top] | (value < -1.5)] = -3
        best = value.argmax(axis=1)
        go = value[np.arange(len(active)), best] > -3
        active, best = active[go], top[np.arange(len(top)), best][go]
        expanded[active, best] = True
        look(active, best)
    while True:             # then all within reach of the radius
        rows, cols = np.nonzero((sims >= threshold - MARGIN) & ~expanded)
        if not len(rows):
            break
        expanded[rows, cols] = True
        look(rows, cols)
    rows, cols = np.nonzero(sims >= threshold - 1e-4)
    exact = np.empty(len(rows))
    for lo in range(0, len(rows), PAIRS // 8):
        s = slice(lo, lo + PAIRS // 8)
        exact[s] = np.einsum("pd,pd->p", q[rows[s]], x[cols[s]])
    return rows[exact >= threshold], cols[exact >= threshold]


def link_nodes(nodes: DataFrame, threshold: float, overlap: int, beam: int) -> DataFrame:
    """(node, other, n): a node, one node it is connected with, and how many rows
    it links with, as each shard found; written to the shared folder."""
    members = blocks(make_shards(nodes, overlap))
    edge_schema = pa.schema([("node", pa.int64()), ("near", pa.list_(pa.int64()))])

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        node = table.column("node").to_numpy()
        graph = build_graph(_matrix(table.column("unit")), int(node[0]) & 0xFFFF)
        ids = node[np.maximum(graph, 0)]
        return pa.table([pa.array(node), pa.array([r[g >= 0].tolist() for r, g in zip(ids, graph)],
                                                  pa.list_(pa.int64()))], schema=edge_schema)

    lists = (members.select("shard", "block", "node", "unit").groupBy("shard", "block")
             .applyInArrow(build, "node long, near array<long>"))
    # a node has a few shards, and a bounded list from each
    graph = materialize(lists.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    homes = materialize(members.groupBy("node").agg(F.collect_set("shard").alias("homes")), "homes")
    full = materialize(members.join(graph.withColumnRenamed("node", "g"), F.col("node") == F.col("g"))
                       .join(homes.withColumnRenamed("node", "h"), F.col("node") == F.col("h"))
                       .select("shard", "of", "block", "node", "m", "unit", "near", "homes"), "full-members")
    # queries of block i against base nodes of block j, i <= j
    other = F.explode(F.sequence(F.lit(0), F.col("of") - 1))
    tasks = full.withColumn("to", other).select(
        "shard", F.least("block", "to").alias("i"), F.greatest("block", "to").alias("j"),
        "block", "node", "m", "unit", "near", "homes")
    out_schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        shard, i, j = (table.column(c)[0].as_py() for c in ("shard", "i", "j"))
        block = table.column("block").to_numpy()
        node, m = table.column("node").to_numpy(), table.column("m").to_numpy()
        x = _matrix(table.column("unit"))
        asks, base = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(asks) or not len(base):
            return out_schema.empty_table()
        # the united adjacency, as far as it leads to base nodes
        near = table.column("near").combine_chunks().take(pa.array(base))
        to = near.flatten().to_numpy()
        a = np.repeat(np.arange(len(base)), near.value_lengths().to_numpy())
        at = np.minimum(np.searchsorted(node[base], to), len(base) - 1)
        here = node[base][at] == to
        q, b = range_search(x[asks], x[base], _table(a[here], at[here], len(base)), threshold, beam)
        p, r = asks[q], base[b]
        p, r = np.minimum(p, r), np.maximum(p, r)
        pair = np.unique(p[p != r] * len(node) + r[p != r])
        p, r = pair // len(node), pair % len(node)
        # a pair belongs to the first shard that both have
        homes = table.column("homes").to_pylist()
        width = max(map(len, homes))
        home = np.array([h + [-1] * (width - len(h)) for h in homes])
        ours, theirs = home[p][:, :, None], home[r][:, None, :]
        both = np.where((ours == theirs) & (ours >= 0), ours, np.iinfo(np.int64).max)
        mine = both.reshape(len(p), width * width).min(axis=1) == shard
        p, r = p[mine], r[mine]
        n = np.bincount(p, m[r], len(node)) + np.bincount(r, m[p], len(node))
        label = np.arange(len(node))
        merge_links(label, p, r)
        some = np.flatnonzero(n)
        return pa.table([node[some], node[label[some]], n[some].astype(np.int64)], schema=out_schema)

    return materialize(tasks.groupBy("shard", "i", "j").applyInArrow(
        search, "node long, other long, n long"), "shard-links")


def audit(nodes: DataFrame, links: DataFrame, threshold: float) -> float:
    """Share of the true links of a sample of nodes that were found."""
    count = nodes.count()
    share = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    asked = nodes.where(share < AUDIT / max(1, count)).select("node", "unit").collect()
    if not asked:
        return 1.0
    ids = np.array([r["node"] for r in asked])
    q = np.vstack([np.frombuffer(r["unit"], "<f8") for r in asked])
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64())])

    def compare(batches):
        n = np.zeros(len(ids), dtype=np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                some = b.slice(lo, 4096)
                hit = q @ _matrix(some.column(1)).T >= threshold
                hit &= ids[:, None] != some.column(0).to_numpy()
                n += hit @ some.column(2).to_numpy()
        yield to_batch(schema, [ids, n])

    true = (nodes.select("node", "unit", "m").mapInArrow(compare, "node long, n long")
            .groupBy("node").agg(F.sum("n").alias("true")))
    found = links.groupBy("node").agg(F.sum("n").alias("found"))
    r = (true.join(found, "node", "left")
         .agg(F.sum("true"), F.sum(F.least("true", F.coalesce("found", F.lit(0))))).first())
    return 1.0 if not r[0] else r[1] / r[0]


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD, overlap: int = OVERLAP, beam: int = BEAM,
                 recall: float = RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, recall (as audited
    on vectors of its length)."""
    units = unit_vectors(pick(rows, vec_id=id_col, v=vector_col))
    parts = []
    for size in [r[0] for r in units.where("size IS NOT NULL").select("size").distinct().collect()]:
        own = units.where(F.col("size") == size)
        nodes = materialize(own.groupBy("unit").agg(F.min("vec_id").alias("least"), F.count("*").alias("m"))
                            .select(F.monotonically_increasing_id().alias("node"), "unit", "least", "m"),
                            "vector-nodes")
        wide, far = overlap, beam
        while True:
            links = link_nodes(nodes, threshold, wide, far)
            share = audit(nodes, links, threshold)
            if share >= recall or wide >= 4 * overlap:
                break
            wide, far = 2 * wide, 2 * far
        groups = connected_components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
        rooted = materialize(nodes.select("node", "least").join(groups, "node", "left").select(
            "node", "least", F.coalesce("component", "node").alias("root")), "rooted")
        least = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
        counts = materialize(links.groupBy("node").agg(F.sum("n").alias("n")), "link-counts")
        known = materialize(
            nodes.join(rooted.select("node", "root"), "node").join(least, "root")
            .join(counts, "node", "left")
            .select(F.col("unit").alias("of_unit"), "component_id",
                    (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links")), "vector-results")
        parts.append(own.join(known, F.col("unit") == F.col("of_unit"))
                     .select("vec_id", "n_links", "component_id", F.lit(share).alias("recall")))
    alone = units.where("size IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                               F.col("vec_id").alias("component_id"),
                                               F.lit(1.0).alias("recall"))
    for p in parts:
        alone = alone.unionByName(p)
    return alone.select("vec_id", "n_links", "component_id",
                        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
                        "recall")


def op8_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all embeddings."""
    return near_vectors(read_table(spark, sf_dir, "embeddings")).drop("recall")


OP8_SQL = f"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS MATERIALIZED (SELECT rid, vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v
      WHERE e IS NOT NULL AND len(e) > 0 AND list_bool_and(list_transform(e, lambda x: coalesce(isfinite(x), false)))
            AND list_dot_product(e, e) > 0),
links AS MATERIALIZED (SELECT a.rid AS x, b.rid AS y FROM u a JOIN u b ON a.rid <> b.rid AND len(a.e) = len(b.e)
          WHERE list_dot_product(a.e, b.e) >= {THRESHOLD}),
reach(x, y) AS (SELECT rid, rid FROM v UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
comp AS (SELECT x AS rid, min(vec_id) AS component_id FROM reach JOIN v ON v.rid = reach.y GROUP BY x)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = v.rid) AS n_links, component_id,
       coalesce(vec_id = component_id, false) AS kept
FROM v JOIN comp USING (rid)
"""
