"""Stateful stream gap tracking (STR-4, STR-5, STR-6) with ``transformWithStateInPandas``.

The state is keyed by ``(chain, number div WIDTH)``: each key holds a bitmap of
the numbers present in its bucket (``WIDTH / 8`` bytes, whatever the traffic),
so a chain is spread over as many tasks as it has buckets, in bulk replays too.
What is present does not depend on the order of arrival; neither, in the end,
do the open gaps.

Events of a bucket, per micro-batch:

* ``gap``    a range between two present numbers of the bucket that is missing
  and was not reported before (``handling`` ``inline`` up to ``inline_max``);
* ``filled`` a range reported missing before that has now arrived;
* ``edge``   the bucket's lowest and highest present number, when changed.

:func:`open_gaps` reduces the events to the gaps still open, and finds those
between buckets from the edges: a step over one row per bucket.

Staleness (the dead-man timer) is a query of its own: :func:`stale_events`, a
processor over one row per chain and task, by the wall clock;
:func:`silent_events`, by session windows, by the time of the events
themselves, which gives the same events in a replay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gapseries.operators.ordered import exclusive_scan

OUTPUT_SCHEMA = ("chain string, bucket long, event string, gap_start long, gap_end long, gap_size long, "
                 "handling string, at_ms long")
HEARTBEAT = ""                  # chain of rows that only tell how late it is
STALE_SCHEMA = "chain string, event string, number long, at_ms long"
WIDTH = 1 << 16
INLINE_MAX = 5

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ranges(mask: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values: (first, last) positions."""
    step = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(step == 1).tolist(), (np.flatnonzero(step == -1) - 1).tolist()))


def _missing(present: np.ndarray) -> np.ndarray:
    """Absent positions between the first and the last present one."""
    out = np.zeros(len(present), bool)
    at = np.flatnonzero(present)
    if len(at):
        out[at[0]:at[-1]] = ~present[at[0]:at[-1]]
    return out


class GapTracker(StatefulProcessor):
    def __init__(self, inline_max: int = INLINE_MAX, width: int = WIDTH):
        self.inline_max, self.width = inline_max, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.present = handle.getValueState("present", "bits binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        chain, bucket = key
        now, low = timerValues.getCurrentProcessingTimeInMs(), bucket * self.width
        before = np.zeros(self.width, bool)
        if self.present.exists():
            before = np.unpackbits(np.frombuffer(self.present.get()[0], np.uint8), count=self.width).astype(bool)
        after = before.copy()
        for pdf in rows:
            after[pdf["number"].to_numpy(np.int64) - low] = True
        if (after == before).all():
            return
        self.present.update((np.packbits(after).tobytes(),))
        was, missing = _missing(before), _missing(after)
        out = [("gap", a, b) for a, b in _ranges(missing & ~was)] + [("filled", a, b) for a, b in _ranges(was & ~missing)]
        at = np.flatnonzero(after)
        old = np.flatnonzero(before)
        if not len(old) or (old[0], old[-1]) != (at[0], at[-1]):
            out.append(("edge", int(at[0]), int(at[-1])))
        yield pd.DataFrame([{"chain": chain, "bucket": bucket, "event": event, "gap_start": low + a, "gap_end": low + b,
                             "gap_size": b - a + 1, "at_ms": now,
                             "handling": None if event != "gap" else "inline" if b - a < self.inline_max else "deferred"}
                            for event, a, b in out])

    def close(self) -> None:
        pass


def _by_value() -> None:
    """Ship the processor classes by value: Python workers then need no package on their path but pyspark."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def gap_processor(stream: DataFrame, chain_col: str = "chain", inline_max: int = INLINE_MAX, width: int = WIDTH) -> DataFrame:
    """STR-4/5: ``gap``, ``filled`` and ``edge`` events of a block stream (``chain``, ``number``).

    Rows without a number are ignored. Sets the session's state store provider
    to RocksDB (:data:`ROCKSDB`) for queries started afterwards.
    """
    _by_value()
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    s = stream.filter(F.col("number").isNotNull()).select(
        F.col(chain_col).alias("chain"), F.floor(F.col("number") / F.lit(width)).cast("bigint").alias("bucket"),
        F.col("number").cast("bigint").alias("number"))
    return s.groupBy("chain", "bucket").transformWithStateInPandas(
        statefulProcessor=GapTracker(inline_max, width), outputStructType=OUTPUT_SCHEMA, outputMode="Append", timeMode="None")


def open_gaps(events: DataFrame, inline_max: int = INLINE_MAX) -> DataFrame:
    """Gaps still open after all ``events`` (of :func:`gap_processor`): ``(chain, gap_start, gap_end, gap_size, handling)``.

    Inside a bucket a number is open if it was reported missing and not
    filled since; the order of the events plays no part. Between buckets the
    gap runs from the highest present number of the bucket before.
    """
    ranges = events.filter(F.col("event").isin("gap", "filled"))
    sign = F.when(F.col("event") == "gap", 1).otherwise(-1)
    points = ranges.select("chain", "bucket", F.explode(F.array(
        F.struct(F.col("gap_start").alias("at"), sign.alias("step")),
        F.struct((F.col("gap_end") + 1).alias("at"), (-sign).alias("step")))).alias("p"))
    points = points.groupBy("chain", "bucket", F.col("p.at").alias("at")).agg(F.sum("p.step").alias("step")).filter("step <> 0")
    w = Window.partitionBy("chain", "bucket").orderBy("at")
    inner = points.select("chain", F.col("at").alias("gap_start"), (F.lead("at").over(w) - 1).alias("gap_end"),
                          F.sum("step").over(w).alias("depth")).filter("depth > 0").drop("depth")
    edges = events.filter("event = 'edge'").groupBy("chain", "bucket").agg(F.min("gap_start").alias("lo"), F.max("gap_end").alias("hi"))
    scan = exclusive_scan(edges, ["chain"], "bucket", "hi", "last", "prev_hi")
    between = scan.filter(F.col("lo") - F.col("prev_hi") > 1).select(
        "chain", (F.col("prev_hi") + 1).alias("gap_start"), (F.col("lo") - 1).alias("gap_end"))
    size = F.col("gap_end") - F.col("gap_start") + 1
    return inner.unionByName(between).withColumn("gap_size", size).withColumn(
        "handling", F.when(F.col("gap_size") <= inline_max, "inline").otherwise("deferred"))


class StaleTimer(StatefulProcessor):
    def __init__(self, stale_after_s: int):
        self.stale_after_ms = stale_after_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "number long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(pdf["number"].max()) for pdf in rows)
        if not self.last.exists() or newest >= self.last.get()[0]:
            self.last.update((newest,))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stale_after_ms)
        yield pd.DataFrame(columns=["chain", "event", "number", "at_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame([{"chain": key[0], "event": "stale", "number": self.last.get()[0],
                             "at_ms": expiredTimerInfo.getExpiryTimeInMs()}])

    def close(self) -> None:
        pass


def _newest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per chain and batch, ahead of the shuffle."""
    for pdf in batches:
        if len(pdf):
            yield pdf.groupby("chain", as_index=False)["number"].max()


def stale_events(stream: DataFrame, chain_col: str = "chain", stale_after_s: int = 960) -> DataFrame:
    """STR-6: a ``stale`` event when a chain sends no block for ``stale_after_s`` seconds of processing time."""
    _by_value()
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    s = (stream.filter(F.col("number").isNotNull()).select(F.col(chain_col).alias("chain"), F.col("number").cast("bigint"))
         .mapInPandas(_newest, "chain string, number long"))
    return s.groupBy("chain").transformWithStateInPandas(
        statefulProcessor=StaleTimer(stale_after_s), outputStructType=STALE_SCHEMA, outputMode="Append", timeMode="ProcessingTime")


def silent_events(stream: DataFrame, chain_col: str = "chain", ts: str = "timestamp", stale_after_s: int = 960, delay: str = "0 seconds") -> DataFrame:
    """STR-6 on event time: one row per silence of more than ``stale_after_s`` seconds, ``at`` the time it was due.

    Time is the stream's watermark (the newest event of any chain less
    ``delay``), so a replay gives the same rows. A chain's events without a
    silence between them are a session; it ends ``stale_after_s`` after its
    last event and is told once time has passed that end, by a millisecond at
    least, as a watermark has no smaller steps. State and output are kept and
    merged by Spark; each task sends one row per session to the shuffle. Rows
    of chain :data:`HEARTBEAT` move the time on and are no chain. Events must
    not arrive out of order by more than ``delay``. Rows without a time are
    ignored, a missing number counts as 0. Sets the session's state store
    provider and lets tasks merge sessions, for queries started afterwards.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    # a session that ends with the newest event is not silent yet: a watermark a millisecond behind has not reached its end
    s = (stream.filter(F.col(ts).isNotNull())
         .select(F.col(chain_col).cast("string").alias("chain"), F.col(ts).alias("due"), F.coalesce(F.col("number").cast("bigint"), F.lit(0)).alias("number"))
         .withWatermark("due", f"{delay} 1 millisecond"))
    ended = s.groupBy("chain", F.session_window("due", f"{stale_after_s} seconds").alias("session")).agg(
        F.max(F.struct("due", "number")).alias("last"),
        # not a filter on the key: Spark would move it ahead of the watermark, which the heartbeats must reach
        F.count_if(F.coalesce(F.col("chain") != HEARTBEAT, F.lit(True))).alias("events"))
    return ended.filter("events > 0").select("chain", F.col("last.number").alias("number"), F.col("session.end").alias("at"))
