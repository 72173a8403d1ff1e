"""The trie of conversation prefixes, with the tokens that sharing them saves.

A turn is told by 120 bits of the SHA-256 of its role and text; a prefix by the sum
without carry of its turns' digests, each hashed with its depth, so that a running
total over (conversation, stretch of turns) gives all prefixes and a parent's digest
follows from its child's. A count-min sketch of all prefix digests, made in the tasks
and added up by block, then screens them: an estimate of one proves that a prefix
belongs to a single conversation, and so does everything behind it, so this tail is
emitted as nodes where it is. Only prefixes that may be shared are shuffled and
grouped exactly; there, a group with two parents or two last turns would be a
collision and raises.

Sums over a subtree need no walk down the levels. A node is on the path of its
smallest member, and that conversation is the smallest one in all of its path below;
so a node's saving is what its smallest member's path saves from it on, and all that
the other members' own nodes save.

Scale: texts are hashed at the scan and never shuffled. Groups are sums with map-side
partials; running totals go by stretches of ``STRETCH`` turns, so one long
conversation is many windows; conversations meet their turns in plain joins, which
Spark splits. The ids that end at one node are joined to blobs in their order by
range, and one hash runs over the blobs. The sketch has at most ``3 * 2**MAX_BITS``
cells, of which a bit each reaches the tasks: beyond some ten million prefixes
estimates rise and more prefixes are grouped exactly, with the same result.

Defined results: a null role or text is empty; turns are in the order of their number,
null first, and of their digest where numbers tie; repeated rows are repeated turns;
rows without a conversation id belong to no conversation and are left out; a
conversation without turns is a member of the root only; an empty table has no nodes;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import materialize, pick, read_table, spread, to_batch
from skein.llm.resample import CRC_SQL, crc_sql
from skein.operators.indexing import dense_index

SKETCH_ROWS = 3
MIN_BITS, MAX_BITS = 16, 24     # cells of a sketch row, as a power of two
BLOCK = 1 << 16                 # cells that are added up together
STRETCH = 4096                  # turns of one window
BLOB_BYTES = 1 << 16
KEY = ["p1", "p2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _two(text: Column) -> tuple[Column, Column]:
    """120 bits of a text's SHA-256, as two numbers."""
    digest = F.sha2(text, 256)
    return tuple(F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16))


# ---- turns in order ------------------------------------------------------------

def ordered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, place (from 0), v1, v2, chars of every turn; written."""
    rows = pick(conversations, conv=id_col, turn=turn_col, role=role_col, text=text_col).where("conv IS NOT NULL")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    v1, v2 = _two(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = materialize(rows.select(F.col("conv").cast("long"), "turn", v1.alias("v1"), v2.alias("v2"),
                                    F.length(text).cast("long").alias("chars")), "turn-digests")
    ranked = dense_index(turns, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("v1"), F.col("v2")], "at")
    ranked = materialize(ranked.select("conv", "at", "v1", "v2", "chars"), "ranked-turns")
    first = ranked.groupBy(F.col("conv").alias("of")).agg(F.min("at").alias("first"))
    return materialize(ranked.join(first, F.col("conv") == F.col("of"))
                       .select("conv", (F.col("at") - F.col("first")).alias("place"), "v1", "v2", "chars"),
                       "ordered-turns")


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (conv, depth, v1, v2, chars) and (conv, n_turns)."""
    return (turns.select("conv", (F.col("place") + 1).alias("depth"), "v1", "v2", "chars"),
            turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n_turns")))


def rebuilt(turns: DataFrame, head: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``head`` (at most ``most``) turns of
    conversation ``base`` and go on with their own after as many; as ``sequences``."""
    sizes = materialize(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
                        .select("conv", "own", head.cast("long").alias("h"), base.alias("base")), "own-sizes")
    heads = (turns.where(F.col("place") < most)
             .groupBy(F.col("conv").alias("of"))
             .agg(F.array_sort(F.collect_list(F.struct("place", "v1", "v2", "chars"))).alias("head")))
    bases = sizes.select("base").distinct()
    heads = materialize(heads.join(bases, heads.of == bases.base, "left_semi"), "heads")
    lead = F.least("h", F.coalesce(F.size("head"), F.lit(0))).cast("long")
    convs = materialize(
        sizes.join(heads, F.col("base") == F.col("of"), "left")
        .select("conv", "h", lead.alias("lead"), F.slice("head", 1, lead.cast("int")).alias("head"),
                (lead + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns")), "rebuilt-sizes")
    led = convs.where("lead > 0").select("conv", F.explode("head").alias("t")).select(
        "conv", (F.col("t.place") + 1).alias("depth"), "t.v1", "t.v2", "t.chars")
    facts = convs.select(F.col("conv").alias("of"), "h", "lead")
    own = (turns.join(facts, F.col("conv") == F.col("of")).where("place >= h")
           .select("conv", (F.col("lead") + F.col("place") - F.col("h") + 1).alias("depth"), "v1", "v2", "chars"))
    return led.unionByName(own), convs.select("conv", "n_turns")


# ---- prefixes --------------------------------------------------------------------

def _later(rows: DataFrame, totals: list[Column], names: list[str], start: int, end: int) -> DataFrame:
    """``rows`` with the totals over the conversation's other stretches, from the one
    ``start`` places on to ``end``; only conversations of several stretches have any."""
    by = Window.partitionBy("s_conv").orderBy("s_stretch").rowsBetween(start, end)
    parts = rows.groupBy(F.col("conv").alias("s_conv"), F.col("stretch").alias("s_stretch")).agg(
        *[t.alias(f"s_{n}") for t, n in zip(totals, names)])
    many = parts.groupBy(F.col("s_conv").alias("m")).count().where("count > 1")
    parts = parts.join(many, F.col("s_conv") == F.col("m"), "left_semi")
    merge = F.bit_xor if start == Window.unboundedPreceding else F.sum
    parts = parts.select("s_conv", "s_stretch", *[merge(f"s_{n}").over(by).alias(f"o_{n}") for n in names])
    joined = rows.join(parts, (F.col("conv") == F.col("s_conv")) & (F.col("stretch") == F.col("s_stretch")), "left")
    return joined.drop("s_conv", "s_stretch")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with the digests of their prefix (p1, p2) and of the turn at its
    depth (t1, t2); written. The parent's digests are the difference."""
    t1, t2 = _two(F.concat_ws(":", "depth", "v1", "v2"))
    rows = turns.select("conv", "depth", "chars", t1.alias("t1"), t2.alias("t2"),
                        F.floor((F.col("depth") - 1) / STRETCH).alias("stretch"))
    run = Window.partitionBy("conv", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = materialize(rows.withColumns({"r1": F.bit_xor("t1").over(run), "r2": F.bit_xor("t2").over(run)}),
                       "stretch-prefixes")
    rows = _later(rows, [F.bit_xor("t1"), F.bit_xor("t2")], ["t1", "t2"], Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return materialize(rows.select(
        "conv", "depth", "chars", "t1", "t2",
        F.col("r1").bitwiseXOR(F.coalesce("o_t1", zero)).alias("p1"),
        F.col("r2").bitwiseXOR(F.coalesce("o_t2", zero)).alias("p2")), "prefixes")


# ---- the sketch ------------------------------------------------------------------

def _cells(p1: np.ndarray, p2: np.ndarray, bits: int) -> list[np.ndarray]:
    """A prefix's cell in every row of the sketch."""
    a, b = p1.astype(np.uint64), p2.astype(np.uint64) | np.uint64(1)
    return [((a + np.uint64(r) * b) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
            for r in range(SKETCH_ROWS)]


def sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """For every cell, row by row, whether two prefixes or more fell into it (packed
    bits). Counts stop at two, as only one or more matters."""
    blocks = (1 << bits) // BLOCK
    schema = pa.schema([("block", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])

    def count(batches):
        seen = np.zeros((SKETCH_ROWS, 1 << bits), dtype=np.uint8)
        for batch in batches:
            p1, p2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for row, cells in zip(seen, _cells(p1, p2, bits)):
                cell, n = np.unique(cells, return_counts=True)
                row[cell] = np.minimum(2, row[cell] + np.minimum(n, 2))
        for i, block in enumerate(seen.reshape(-1, BLOCK)):
            if block.any():
                yield to_batch(schema, [[i], [np.flatnonzero(block == 1).astype("<u2").tobytes()],
                                        [np.flatnonzero(block == 2).astype("<u2").tobytes()]])

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, once, more in zip(*(c.to_pylist() for c in batch.columns)):
                block = held.setdefault(i, np.zeros(BLOCK, dtype=np.uint8))
                at = np.frombuffer(once, "<u2")
                block[at] = np.minimum(2, block[at] + 1)
                block[np.frombuffer(more, "<u2")] = 2
        for i, block in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()),
                                              pa.array([np.packbits(block == 2).tobytes()], pa.binary())],
                                             names=["block", "bits"])

    out = np.zeros((SKETCH_ROWS * blocks, BLOCK // 8), dtype=np.uint8)
    parts = rows.select(*KEY).mapInArrow(count, "block int, once binary, more binary")
    for r in parts.repartition(spread(rows), "block").mapInArrow(merge, "block int, bits binary").collect():
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(SKETCH_ROWS, -1)


def screened(rows: DataFrame, bits: int | None = None) -> DataFrame:
    """(conv, cut): the first depth whose prefix is proven to be the conversation's
    alone; conversations without one are left out."""
    if bits is None:
        bits = min(MAX_BITS, max(MIN_BITS, (4 * rows.count()).bit_length()))
    shared = rows.sparkSession.sparkContext.broadcast(sketch(rows, bits))
    schema = pa.schema([("conv", pa.int64()), ("cut", pa.int64())])

    def single(batches):
        more = shared.value
        for batch in batches:
            p1, p2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            alone = np.zeros(len(p1), dtype=bool)
            for row, cells in zip(more, _cells(p1, p2, bits)):
                alone |= (row[cells >> np.uint64(3)] >> (7 - (cells & np.uint64(7))).astype(np.uint8)) & 1 == 0
            at = pa.array(np.flatnonzero(alone))
            yield to_batch(schema, [batch.column(2).take(at), batch.column(3).take(at)])

    return (rows.select(*KEY, "conv", "depth").mapInArrow(single, "conv long, cut long")
            .groupBy("conv").agg(F.min("cut").alias("cut")))


# ---- ids that end at a node --------------------------------------------------------

def ends_digest(ends: DataFrame) -> DataFrame:
    """(p1, p2, conv) to (p1, p2, ends): SHA-256 of the ascending ids, comma-joined.
    Ids go by range, so a node's many ids are blobs of several tasks; the hash then
    runs over the blobs in order."""
    n = spread(ends)
    blob_schema = pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("least", pa.int64()), ("blob", pa.binary())])
    schema = pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("ends", pa.string())])

    def runs(batch):
        """Bounds of the stretches of one node."""
        p1, p2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        new = np.flatnonzero((p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])) + 1
        return zip([0, *new.tolist()], [*new.tolist(), len(p1)]) if len(p1) else ()

    def join(batches):
        for batch in batches:
            made = []
            for lo, hi in runs(batch):
                key = batch.column(0)[lo].as_py(), batch.column(1)[lo].as_py()
                ids = batch.column(2).slice(lo, hi - lo).to_pylist()
                for at in range(0, len(ids), BLOB_BYTES // 16):
                    some = ids[at:at + BLOB_BYTES // 16]
                    made.append((*key, some[0], ",".join(map(str, some)).encode()))
            if made:
                yield to_batch(blob_schema, zip(*made))

    def digest(batches):
        key, state = None, None
        for batch in batches:
            made = []
            for p1, p2, _, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if (p1, p2) != key:
                    if key:
                        made.append((*key, state.hexdigest()))
                    key, state = (p1, p2), hashlib.sha256(blob)
                else:
                    state.update(b"," + blob)
            if made:
                yield to_batch(schema, zip(*made))
        if key:
            yield to_batch(schema, [[key[0]], [key[1]], [state.hexdigest()]])

    blobs = (ends.repartitionByRange(n, *KEY, "conv").sortWithinPartitions(*KEY, "conv")
             .mapInArrow(join, "p1 long, p2 long, least long, blob binary"))
    return (blobs.repartition(n, *KEY).sortWithinPartitions(*KEY, "least")
            .mapInArrow(digest, "p1 long, p2 long, ends string"))


# ---- the trie ------------------------------------------------------------------------

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(turns: DataFrame, convs: DataFrame, bits: int | None = None) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv, depth, v1, v2, chars) of ``convs`` (conv,
    n_turns): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. ``bits``: cells of a sketch row."""
    rows = prefixes(turns)
    cuts = screened(rows, bits).withColumnRenamed("conv", "of")
    convs = materialize(convs.join(cuts, F.col("conv") == F.col("of"), "left")
                        .select("conv", "n_turns", F.coalesce("cut", F.col("n_turns") + 1).alias("cut")), "cuts")
    rows = materialize(
        rows.join(convs.withColumnRenamed("conv", "of"), F.col("conv") == F.col("of"))
        .select("conv", "depth", "chars", "p1", "p2", "t1", "t2", "n_turns", "cut"), "screened-prefixes")
    up = [F.col("p1").bitwiseXOR(F.col("t1")).alias("u1"), F.col("p2").bitwiseXOR(F.col("t2")).alias("u2")]
    shared, tails = rows.where("depth < cut"), rows.where("depth >= cut")

    same = (F.min("t1") == F.max("t1")) & (F.min("t2") == F.max("t2"))
    nodes = materialize(
        shared.groupBy(*KEY, "depth").agg(
            F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"),
            F.when(same, F.min("t1")).otherwise(F.raise_error(F.lit("prefix digests collide"))).alias("t1"),
            F.min("t2").alias("t2")).select("*", *up), "shared-nodes")
    first_tail = tails.where("depth = cut").select("conv", "depth", *up)
    children = materialize(
        nodes.select("u1", "u2").unionByName(first_tail.select("u1", "u2"))
        .groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("n_children")), "children")
    at_node = (F.col("p1") == F.col("u1")) & (F.col("p2") == F.col("u2"))

    # a leaf counts for the path of its smallest member, a saving for that of the node's
    worth = ((F.col("n_convs") - 1) * F.col("chars")).alias("worth")
    ends_here = nodes.join(children, (nodes.p1 == children.u1) & (nodes.p2 == children.u2), "left_anti")
    leaf = convs.where("cut <= n_turns").select("conv").unionByName(
        ends_here.select(F.col("conv_id").alias("conv")))
    own = materialize(
        leaf.select("conv", F.lit(1).alias("leaf"), F.lit(0).cast("long").alias("worth"))
        .unionByName(nodes.select(F.col("conv_id").alias("conv"), F.lit(0).alias("leaf"), worth))
        .groupBy("conv").agg(F.sum("leaf").alias("leaf"), F.sum("worth").alias("worth")), "paths")
    facts = own.withColumnRenamed("conv", "of")
    sums = (shared.select("conv", *KEY).join(facts, F.col("conv") == F.col("of"))
            .groupBy(F.col("p1").alias("a1"), F.col("p2").alias("a2"))
            .agg(F.sum("leaf").alias("n_leaves"), F.sum("worth").alias("members_worth")))
    back = Window.partitionBy("conv", "stretch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    path = nodes.select(*KEY, F.col("conv_id").alias("conv"), "depth", worth,
                        F.floor((F.col("depth") - 1) / STRETCH).alias("stretch"))
    path = materialize(path.withColumn("from_here", F.sum("worth").over(back)), "path-worth")
    path = _later(path, [F.sum("worth")], ["worth"], 1, Window.unboundedFollowing).select(
        F.col("p1").alias("w1"), F.col("p2").alias("w2"),
        (F.col("from_here") + F.coalesce("o_worth", F.lit(0))).alias("path_worth"))

    ends = ends_digest(materialize(
        shared.where("depth = n_turns").select(*KEY, "conv").unionByName(
            convs.where("n_turns = 0").select(F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"),
                                              "conv")), "ends"))
    ends = materialize(ends.toDF("e1", "e2", "ends_sha256"), "ends-digests")
    none = F.lit(EMPTY_SHA)

    # the root, from sums over the conversations
    all_convs = convs.agg(F.min("conv").alias("least"), F.count(F.lit(1)).alias("n")).first()
    all_paths = own.agg(F.coalesce(F.sum("leaf"), F.lit(0)).alias("leaf"),
                        F.coalesce(F.sum("worth"), F.lit(0)).alias("worth")).first()
    top = F.lit(all_convs["least"])
    root = rows.sparkSession.createDataFrame(
        [(all_convs["least"], all_convs["n"], max(1, all_paths["leaf"]), all_paths["worth"], 0, 0)],
        "conv_id long, n_convs long, n_leaves long, saved_tokens long, p1 long, p2 long").where("n_convs > 0")
    root = (root.join(children, at_node, "left")
            .join(ends, (F.col("p1") == F.col("e1")) & (F.col("p2") == F.col("e2")), "left")
            .select("conv_id", F.lit(0).alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
                    F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", none).alias("ends_sha256")))

    parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent"))
    of_parent = (F.col("u1") == F.col("q1")) & (F.col("u2") == F.col("q2"))
    kids = children.select(F.col("u1").alias("c1"), F.col("u2").alias("c2"), "n_children")
    inner = (nodes.join(parents, of_parent, "left")
             .join(kids, (F.col("p1") == F.col("c1")) & (F.col("p2") == F.col("c2")), "left")
             .join(sums, (F.col("p1") == F.col("a1")) & (F.col("p2") == F.col("a2")), "left")
             .join(path, (F.col("p1") == F.col("w1")) & (F.col("p2") == F.col("w2")))
             .join(ends, (F.col("p1") == F.col("e1")) & (F.col("p2") == F.col("e2")), "left")
             .join(facts, F.col("conv_id") == F.col("of"))
             .select("conv_id", "depth", F.when(F.col("depth") == 1, top).otherwise(F.col("parent"))
                     .alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                     "n_leaves", (F.col("path_worth") + F.col("members_worth") - F.col("worth")).alias("saved_tokens"),
                     F.coalesce("ends_sha256", none).alias("ends_sha256")))

    # tails: each node has one member; only the first one's parent is elsewhere
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    last = F.col("depth") == F.col("n_turns")
    alone = [one.alias("n_convs"), F.when(last, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"),
             zero.alias("saved_tokens"),
             F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(none).alias("ends_sha256")]
    begin = tails.where("depth = cut AND depth > 1").select("conv", "depth", "n_turns", *up).join(
        parents, of_parent, "left")
    tail = tails.where("depth > cut OR depth = 1").select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") == 1, top).otherwise(F.col("conv")).alias("parent_conv_id"), *alone)
    begin = begin.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), *alone)
    return _result(root.unionByName(inner).unionByName(tail).unionByName(begin))


def _result(nodes: DataFrame) -> DataFrame:
    return nodes.select(*[F.col(c).cast("long").alias(c) for c in COLUMNS[:-1]],
                        F.col("ends_sha256").cast("string").alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt on the first turns of every hundredth."""
    turns = ordered_turns(read_table(spark, sf_dir, "conversations"))
    conv = F.col("conv")
    head = F.crc32(conv.cast("string").cast("binary")) % 6
    return prefix_trie(*rebuilt(turns, head, conv - conv % 100, 5))


OP13_SQL = f"""WITH {CRC_SQL},
own AS (
  SELECT conv_id, d, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS p FROM (
    SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
      sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS d
    FROM conversations WHERE conv_id IS NOT NULL)),
ids AS (SELECT conv_id, ({crc_sql('conv_id::VARCHAR')}) % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM own), crc_table),
turns AS (
  SELECT i.conv_id, 0 AS part, p, d, chars FROM ids i JOIN own o ON o.conv_id = i.conv_id - i.conv_id % 100 AND p <= h
  UNION ALL SELECT i.conv_id, 1, p, d, chars FROM ids i JOIN own o ON o.conv_id = i.conv_id AND p > h),
prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(d, '') OVER w AS key, chars,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, p ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0, (SELECT count(*) FROM turns t WHERE t.conv_id = ids.conv_id) FROM ids),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth),
kids AS (SELECT substr(key, 1, 64 * (depth - 1)) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT substr(key, 1, 64 * up) AS key, sum(leaf) AS n_leaves, sum(worth) AS saved_tokens
  FROM (SELECT n.key, unnest(range(depth + 1)) AS up, (k.n IS NULL)::INT AS leaf, (n_convs - 1) * chars AS worth
        FROM nodes n LEFT JOIN kids k ON k.key = n.key) GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.key = n.key LEFT JOIN kids k ON k.key = n.key
LEFT JOIN nodes u ON n.depth > 0 AND u.depth = n.depth - 1 AND u.key = substr(n.key, 1, 64 * (n.depth - 1))"""
