"""Streams: pairing beyond the horizon, versions, resuming after a stop."""

import random

from pyspark.sql import functions as F

from skein.streaming import streams as S

SCHEMA = "pos long, id string, parent_id string, author string, body string"


def land(spark, folder, rows, schema=SCHEMA):
    """Drop one file of rows into the landing folder."""
    df = S.with_event_time(spark.createDataFrame(rows, schema), unit_ms=60_000)
    df.coalesce(1).write.mode("append").json(str(folder))
    return df.schema


def test_horizon_and_latest_version(spark, tmp_path):
    rows = [(0, "c0", "t3_p", "a", "v0"), (1, "c1", "t1_c0", "a", "r1"), (5, "c0", "t3_p", "a", "v5"),
            (6, "c6", "t1_c0", "a", "r6"), (16, "c16", "t1_c1", "a", "late"), (17, "c17", "t1_c6", "a", "[deleted]")]
    schema = land(spark, tmp_path / "in", rows)

    def pairs(horizon):
        found = S.pair_stream(S.source(spark, str(tmp_path / "in"), schema), horizon, "0 seconds")
        return sorted((r.pos, r.parent_pos, r.parent_body) for r in
                      S.run(found, "t", keys=S.PAIR_KEYS, latest_by="parent_pos").collect())

    assert pairs("10 minutes") == [(1, 0, "v0"), (6, 5, "v5")]      # 15 minutes is too late
    assert pairs("1 hour") == [(1, 0, "v0"), (6, 5, "v5"), (16, 1, "r1")]


def test_stop_and_resume(spark, tmp_path):
    landing, folder = tmp_path / "in", str(tmp_path / "state")
    schema = land(spark, landing, [(0, "c0", "t3_p", "a", "one two"), (1, "c1", "t1_c0", "a", "two")])

    def stream():
        return S.source(spark, str(landing), schema)

    def vocab():
        words = stream().select("pos", F.split("body", " ").alias("t"))
        return {r.word: (r["index"], r["count"]) for r in S.run_vocab(words, "t", "v", f"{folder}/v").collect()}

    def totals():
        return S.run(S.running_totals(stream()), "s", keys=["all"], folder=f"{folder}/s").first()

    def lines():
        found = S.pair_line_stream(stream(), "1 hour", "0 seconds")
        return sorted(r.line for r in S.run(found, "p", folder=f"{folder}/p", text="line").collect())

    assert vocab() == {"one": (0, 1), "two": (1, 2)}
    assert totals().comments == 2 and lines() == ["one two\ttwo"]
    land(spark, landing, [(2, "c2", "t1_c1", "a", "three two")])
    # each goes on from where it was: old indexes stay, counts add up, state is kept
    assert vocab() == {"one": (0, 1), "two": (1, 3), "three": (2, 1)}
    assert (totals().comments, totals().pairs) == (3, 2)
    assert lines() == ["one two\ttwo", "two\tthree two"]


def test_distinct_forgets(spark, tmp_path):
    rows = [(0, "a"), (1, "a"), (2, "b")]
    schema = land(spark, tmp_path / "in", rows, "pos long, k string")
    folder = str(tmp_path / "state")

    def run():
        s = S.distinct_stream(S.source(spark, str(tmp_path / "in"), schema), ["k"], "ts", "5 minutes")
        return sorted(r.k for r in S.run(s, "d", folder=folder).collect())

    assert run() == ["a", "b"]
    land(spark, tmp_path / "in", [(4, "b"), (60, "c")], "pos long, k string")
    assert run() == ["a", "b", "c"]
    land(spark, tmp_path / "in", [(120, "a")], "pos long, k string")
    assert run() == ["a", "a", "b", "c"]        # long after the state of the first a is gone


def test_exact_pairs_in_any_order_of_arrival(spark, tmp_path):
    """One row a reply, answered by its latest earlier version, over restarts; state
    holds what may still be wanted."""
    rng = random.Random(4)
    rows = []
    for pos in range(240):
        ident = f"c{rng.randrange(60)}"         # ids repeat: many versions
        parent = rng.choice([f"t1_c{rng.randrange(60)}", f"t1_{ident}", "t3_p", None])
        rows.append((pos, ident if rng.random() < 0.95 else None, parent, "a", f"b{pos}" if pos % 9 else "[deleted]"))
    kept = [r for r in rows if r[4] != "[deleted]"]
    horizon = 50
    want = []
    for pos, ident, parent, _, body in kept:
        key = parent and parent.split("_", 1)[1]
        found = [v for v in kept if key and v[1] == key and pos - horizon <= v[0] < pos]
        if found:
            want.append((pos, ident, key, found[-1][0], found[-1][4], body))

    shuffled = sorted(rows, key=lambda r: r[0] + rng.randrange(20))
    folder = tmp_path / "in"
    schema = land(spark, folder, shuffled[:1])

    def run(spread, state):
        stream = S.source(spark, str(folder), schema, files_per_batch=2)
        found = S.exact_pair_stream(stream, f"{horizon} minutes", "25 minutes", spread)
        return sorted(tuple(r) for r in S.run(found, "x", folder=str(tmp_path / state)).collect())

    for at in range(1, 240, 60):                # a stop after every four files
        for k in range(at, min(at + 60, 240), 15):
            land(spark, folder, shuffled[k:min(k + 15, 240)])
        got = run(1, "one")
        assert len({r[0] for r in got}) == len(got) and set(got) <= set(want)
    land(spark, folder, [(1000, None, None, "a", "the end")])
    assert run(1, "one") == sorted(want)
    assert run(7, "seven") == sorted(want)      # replies dealt out over seven states


def test_state_is_freed(spark, tmp_path):
    """Versions that newer ones replace, and answered replies, leave the state."""
    rows = [(i, "c0", "t1_c0", "a", f"b{i}") for i in range(200)] + [(1000, None, None, "a", "the end")]
    schema = land(spark, tmp_path / "in", rows)
    stream = S.exact_pair_stream(S.source(spark, str(tmp_path / "in"), schema), "1000 minutes", "1 minute")
    got = S.run(stream, "f", folder=str(tmp_path / "state")).collect()
    assert sorted((r.pos, r.parent_pos) for r in got) == [(i, i - 1) for i in range(1, 200)]
    left = (spark.read.format("statestore").option("stateVarName", "versions")
            .load(str(tmp_path / "state" / "checkpoint")).count())
    waits = (spark.read.format("statestore").option("stateVarName", "waiting")
             .load(str(tmp_path / "state" / "checkpoint")).count())
    assert (left, waits) == (1, 0)


def test_state_is_kept_by_buckets(spark, tmp_path):
    """Many ids share few states, which calls and timers are made for; their replies and
    versions stay apart, also where a version is out of the horizon."""
    rows = [(i, f"c{i}", f"t1_c{i - 40}", "a", f"b{i}") for i in range(200)] + [(230, "c230", "t1_c20", "a", "late"),
                                                                            (300, None, None, "a", "the end")]
    schema = land(spark, tmp_path / "in", rows)
    stream = S.exact_pair_stream(S.source(spark, str(tmp_path / "in"), schema), "150 minutes", "1 minute", buckets=4)
    got = S.run(stream, "b", folder=str(tmp_path / "state")).collect()
    assert sorted((r.pos, r.parent_id, r.parent_pos, r.parent_body) for r in got) == [
        (i, f"c{i - 40}", i - 40, f"b{i - 40}") for i in range(40, 200)]
    state = (spark.read.format("statestore").option("stateVarName", "versions")
             .load(str(tmp_path / "state" / "checkpoint")))
    assert 0 < state.select("key").distinct().count() <= 4
