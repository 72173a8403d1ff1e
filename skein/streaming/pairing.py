"""Exact reply pairs on a stream: one row per reply, whatever the order of arrival.

A comment is two entries, a version under its id and a reply under its parent's key.
State is kept by buckets of keys with ``transformWithState``: the versions that may still
be wanted, and the replies that wait, as lists that a micro-batch adds to at once; a call
for each row or key would cost far more than the pairing. A reply is answered once the
watermark has reached its event time, as nothing earlier can arrive from then on: by the
latest version at an earlier position and at most ``horizon`` before it. At that time all
settled versions but the latest go, and so does this one a horizon later (a list is
written anew once half of it has gone); state grows with the ids seen within the horizon
and with what arrives within the delay, not with versions times replies. Timers, state and
the output are committed with each micro-batch, so a restarted query neither repeats nor
misses a reply.

Positions follow event times. Rows later than the delay are dropped by the watermark.
A null id is no version and a null parent key asks for nothing. ``spread`` deals the
replies to a parent out over that many states, each with the parent's versions: for
streams in which one parent gets a large share of all replies.
"""

from __future__ import annotations

from bisect import bisect_left
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skein.functions.predicates import not_deleted
from skein.functions.text import trim_whitespace
from skein.operators.pairs import parent_key

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 256
OUTPUT = "pos long, id string, parent_id string, parent_pos long, parent_body string, reply_body string"


class _Answers(StatefulProcessor):
    def __init__(self, horizon_us: int):
        self.horizon = horizon_us
        self.looked = {}        # the watermark at which a bucket's timers were last served

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", "key string, pos long, ts long, body string")
        self.waiting = handle.getListState("waiting", "key string, pos long, ts long, id string, body string")

    def _wake(self, ts: int) -> None:
        """A timer for when the watermark has reached this time."""
        self.handle.registerTimer(-(-ts // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        versions, waiting = [], []
        for batch in rows:
            for pos, ts, asks, id_, body, of in zip(batch["pos"], batch["us"], batch["asks"], batch["id"],
                                                    batch["body"], batch["key"]):
                if asks:
                    waiting.append((of, int(pos), int(ts), id_, body))
                else:
                    versions.append((of, int(pos), int(ts), body))
        if versions:
            self.versions.appendList(versions)
            self._wake(max(v[2] for v in versions) + self.horizon + 1000)
        if waiting:
            self.waiting.appendList(waiting)
            self._wake(min(w[2] for w in waiting))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        if self.looked.get(key) == watermark:
            return      # several timers of a bucket at once: the first has served all
        self.looked[key] = watermark
        now = watermark * 1000
        # of entries with the same key and position the last stands
        waiting = {w[:2]: w for w in self.waiting.get()}
        versions: dict[str, dict[int, tuple]] = {}
        held = 0
        for of, pos, ts, body in self.versions.get():
            versions.setdefault(of, {})[pos] = (pos, ts, body)
            held += 1
        ordered = {of: sorted(v.values(), key=lambda x: x[0]) for of, v in versions.items()}
        out, later = [], []
        for w in waiting.values():
            of, pos, ts, id_, body = w
            if ts > now:
                later.append(w)
                continue
            some = ordered.get(of, [])
            for v in reversed(some[:bisect_left(some, pos, key=lambda x: x[0])]):
                if ts - self.horizon <= v[1] <= ts:
                    out.append((pos, id_, of, v[0], v[2], body))
                    break
        if len(later) < len(waiting):
            self.waiting.put(later) if later else self.waiting.clear()
        if later:
            self._wake(min(w[2] for w in later))
        kept = []
        for of, some in ordered.items():
            settled = [v for v in some if v[1] <= now]
            last = settled[-1] if settled else None
            kept += [(of, *v) for v in some if v[1] > now or (v is last and v[1] + self.horizon >= now)]
        if held and 2 * len(kept) <= held:      # a list is written anew once half of it has gone
            self.versions.put(kept) if kept else self.versions.clear()
        if out:
            yield pd.DataFrame(out, columns=["pos", "id", "parent_id", "parent_pos", "parent_body", "reply_body"])


def exact_pair_stream(comments: DataFrame, horizon: str, delay: str, spread: int = 1,
                      buckets: int = BUCKETS) -> DataFrame:
    """Replies with the latest earlier version of their parent (R2): pos, id,
    parent_id, parent_pos, parent_body, reply_body; append mode. ``comments`` has pos,
    id, parent_id, body and the event time ``ts``; ``horizon`` and ``delay`` are
    intervals such as '1 hour'. A task holds the state of one of ``buckets`` at a time."""
    spark = comments.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)     # what keyed state needs
    horizon_us = spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {horizon}"))).first()[0]
    c = comments.where(not_deleted("body")).withWatermark("ts", delay)
    salt = F.pmod(F.xxhash64("pos"), F.lit(spread)).cast("int")
    common = [F.col("pos"), F.unix_micros("ts").alias("us"), F.col("id"), trim_whitespace("body").alias("body")]
    version = F.struct(F.col("id").alias("key"), F.lit(False).alias("asks"))
    asked = F.struct(parent_key("parent_id").alias("key"), F.lit(True).alias("asks"))
    entries = c.select("ts", *common, salt.alias("mine"), F.explode(F.array(version, asked)).alias("e"))
    salts = F.when(F.col("e.asks"), F.array("mine")).otherwise(F.sequence(F.lit(0), F.lit(spread - 1)))
    entries = entries.select("ts", "pos", "us", "id", "body", F.col("e.key").alias("key"), F.col("e.asks").alias("asks"),
                             F.explode(salts).alias("salt")).where("key IS NOT NULL")
    bucket = F.pmod(F.xxhash64("key", "salt"), F.lit(buckets)).cast("int")
    return entries.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(
        _Answers(horizon_us), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
