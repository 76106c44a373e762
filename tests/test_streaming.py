"""Streaming: ingest replay is idempotent, quarantine, stateful gap tracking with a late block."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from gapseries.sources import decoders as D
from gapseries.sources import driver
from gapseries.streaming import gap_state, ingest

from conftest import SF001


def _land(df, folder, name):
    rows = [r[0] for r in df.collect()]
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(rows) + "\n")


def test_ingest_available_now_replay_idempotent(spark):
    base = tempfile.mkdtemp(prefix="gs-stream-")
    landed = os.path.join(base, "landed")
    os.makedirs(landed)
    blocks = driver.blocks(spark, SF001)
    enc = D.encode_blocks(blocks)
    _land(enc, landed, "part-1.json")
    with open(os.path.join(landed, "junk.json"), "w") as fh:
        fh.write("{broken\n" + '{"result": null}\n')
    table, quar, ckpt = (os.path.join(base, x) for x in ("table", "quarantine", "ckpt"))
    q = ingest.start_ingest(ingest.block_stream(spark, landed), table, quar, ckpt, available_now=True)
    q.awaitTermination(300)
    n1 = spark.read.parquet(table).count()
    assert n1 == blocks.count()
    assert spark.read.parquet(quar).count() == 2
    # the same payloads land again under another name: the table does not change
    _land(enc, landed, "part-2.json")
    q = ingest.start_ingest(ingest.block_stream(spark, landed), table, quar, ckpt, available_now=True)
    q.awaitTermination(300)
    t = spark.read.parquet(table)
    assert t.count() == n1 and t.select("number").distinct().count() == n1


def test_gap_processor_any_order(spark):
    base = tempfile.mkdtemp(prefix="gs-gaps-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    schema = "chain string, number long"

    def run():
        # catch-up runs: the state survives between them in the checkpoint
        stream = spark.readStream.schema(schema).parquet(os.path.join(src, "*"))
        q = (gap_state.gap_processor(stream, width=8).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()

    def events():
        return sorted((r.event, r.gap_start, r.gap_end) for r in spark.read.parquet(out).where("event <> 'edge'").collect())

    spark.createDataFrame([("eth", 9), ("eth", 10), ("eth", 13), ("eth", 30), ("eth", None)], schema).write.parquet(os.path.join(src, "b1"))
    run()
    assert events() == [("gap", 11, 12)]
    # late blocks: one closes a number, one opens a range below the lowest so far, one lies in a bucket of its own
    spark.createDataFrame([("eth", 12), ("eth", 1), ("eth", 15), ("eth", 12)], schema).write.parquet(os.path.join(src, "b2"))
    run()
    assert events() == [("filled", 12, 12), ("gap", 11, 12), ("gap", 14, 14)]
    got = sorted((r.gap_start, r.gap_end, r.handling) for r in gap_state.open_gaps(spark.read.parquet(out)).collect())
    assert got == [(2, 8, "deferred"), (11, 11, "inline"), (14, 14, "inline"), (16, 29, "deferred")]


def test_rollup_counts_late_rows(spark):
    base = tempfile.mkdtemp(prefix="gs-roll-")
    blocks = driver.blocks(spark, SF001).select("timestamp", "number", "transaction_count", "gas_used")
    # newest first, one file per trigger
    blocks.repartitionByRange(4, F.col("number").desc()).write.parquet(os.path.join(base, "in"))
    stream = spark.readStream.schema(blocks.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in"))
    out = os.path.join(base, "out")
    ingest.start_rollup(stream, out, os.path.join(base, "ck"), width="1 day").awaitTermination()
    got = {r.bucket.date(): (r.blocks, r.tx) for r in ingest.read_rollup(spark, out).collect()}
    want = {r.d: (r.n, r.tx) for r in blocks.groupBy(F.to_date("timestamp").alias("d")).agg(
        F.count("*").alias("n"), F.sum("transaction_count").alias("tx")).collect()}
    assert got == want
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 4


def test_quarantine_keeps_equal_messages_and_survives_a_retry(spark):
    base = tempfile.mkdtemp(prefix="gs-quar-")
    landed = os.path.join(base, "landed")
    os.makedirs(landed)
    with open(os.path.join(landed, "junk.json"), "w") as fh:
        fh.write("{broken\n" * 3 + '{"result": {"number": "0x1z"}}\n')
    run = lambda: ingest.start_ingest(ingest.block_stream(spark, landed), *(os.path.join(base, x) for x in ("t", "q", "ckpt")),
                                      available_now=True).awaitTermination()
    run()
    assert spark.read.parquet(os.path.join(base, "q")).count() == 4
    # forget the commit: the batch runs again
    os.remove(os.path.join(base, "ckpt", "commits", "0"))
    run()
    assert spark.read.parquet(os.path.join(base, "q")).count() == 4


def test_stale_timer(spark):
    base = tempfile.mkdtemp(prefix="gs-stale-")
    src = os.path.join(base, "src")
    schema = "chain string, number long"
    spark.createDataFrame([("eth", 10)], schema).write.parquet(os.path.join(src, "b1"))
    stream = spark.readStream.schema(schema).parquet(os.path.join(src, "*"))
    q = (gap_state.stale_events(stream, stale_after_s=2).writeStream.format("memory").queryName("stale_events")
         .option("checkpointLocation", os.path.join(base, "ckpt")).outputMode("append")
         .trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 120
        stale = []
        while time.time() < deadline and not stale:
            time.sleep(2)
            stale = spark.sql("SELECT * FROM stale_events WHERE event = 'stale'").collect()
        assert stale and stale[0].number == 10
    finally:
        q.stop()


def _message(number, ts="0x5", gas="0x1"):
    return ('{"result":{"number":"%s","timestamp":"%s","gasLimit":"0x1","gasUsed":"%s","size":"0x2","transactions":[]}}' % (hex(number), ts, gas))


def test_poison_message_is_set_aside(spark):
    """A time beyond any year neither stops the stream nor reaches the table; the rest is stored."""
    base = tempfile.mkdtemp(prefix="gs-poison-")
    landed = os.path.join(base, "landed")
    os.makedirs(landed)
    with open(os.path.join(landed, "m.json"), "w") as fh:
        fh.write("\n".join([_message(1), _message(2, "0x7fffffffffffffff"), _message(3, "0x3afff44180")]) + "\n")
    table, quar, ckpt = (os.path.join(base, x) for x in ("table", "quarantine", "ckpt"))
    ingest.start_ingest(ingest.block_stream(spark, landed), table, quar, ckpt, available_now=True).awaitTermination()
    assert [r.number for r in spark.read.parquet(table).collect()] == [1]
    assert spark.read.parquet(quar).count() == 2


def test_failed_flush_is_kept_and_retried(spark, monkeypatch):
    """A batch whose write fails is delivered again by the next run, with what has landed since; its quarantine is not doubled."""
    base = tempfile.mkdtemp(prefix="gs-retry-")
    landed = os.path.join(base, "landed")
    os.makedirs(landed)
    with open(os.path.join(landed, "a.json"), "w") as fh:
        fh.write(_message(1) + "\n{broken\n")
    real, calls = ingest.upsert_table, []

    def failing(*args, **kw):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("store is away")
        return real(*args, **kw)
    monkeypatch.setattr(ingest, "upsert_table", failing)
    start = lambda: ingest.flush_query(ingest.block_stream(spark, landed), *(os.path.join(base, x) for x in ("t", "q", "ckpt")), interval_s=1)
    q = start()
    try:
        q.processAllAvailable()
        raise AssertionError("the first flush must fail")
    except Exception as e:  # noqa: BLE001
        assert "store is away" in str(e)
    q.stop()
    with open(os.path.join(landed, "b.json"), "w") as fh:
        fh.write(_message(2) + "\n")
    q = start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.number for r in spark.read.parquet(os.path.join(base, "t")).collect()) == [1, 2]
    assert spark.read.parquet(os.path.join(base, "q")).count() == 1
    assert len(calls) >= 2


def test_rollup_counts_each_block_once(spark):
    """Ten blocks delivered twice, one revised to another hour, by two queries with checkpoints of one name."""
    base = tempfile.mkdtemp(prefix="gs-once-")
    schema = "timestamp timestamp, number long, transaction_count long, gas_used long, _ingest_seq long"
    rows = [(f"2024-01-01 0{i % 2}:00:00", i, 2, 10, 1) for i in range(10)]
    df = spark.createDataFrame(rows, "t string, number long, transaction_count long, gas_used long, _ingest_seq long")
    df = df.select(F.col("t").cast("timestamp").alias("timestamp"), *df.columns[1:])
    src, out = os.path.join(base, "in"), os.path.join(base, "out")
    for _ in range(2):
        df.write.mode("append").parquet(src)
    moved = df.filter("number = 0").withColumn("timestamp", F.lit("2024-01-01 05:00:00").cast("timestamp")).withColumn("_ingest_seq", F.lit(2).cast("long"))
    moved.write.mode("append").parquet(src)
    for name in ("x", "y"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(src)
        ingest.start_rollup(stream, out, os.path.join(base, name, "ckpt")).awaitTermination()
    got = {r.bucket.hour: (r.blocks, r.tx) for r in ingest.read_rollup(spark, out).collect()}
    assert got == {0: (4, 8), 1: (5, 10), 5: (1, 2)}


def test_silences_are_told_once(spark):
    """Within a delivery, between deliveries, by a timer before the chain comes back, and for ever; quiet heartbeats make no event."""
    base = tempfile.mkdtemp(prefix="gs-silent-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    schema = "chain string, number long, s long"

    def deliver(rows):
        df = spark.createDataFrame(rows, schema).select("chain", "number", F.timestamp_seconds("s").alias("timestamp"))
        df.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(df.schema).parquet(src)
        (gap_state.silent_events(stream, stale_after_s=100).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start()).awaitTermination()

    def events():
        return sorted((r.chain or "-", r.number, int(r.s)) for r in spark.read.parquet(out).select("chain", "number", F.unix_seconds("at").alias("s")).collect())
    deliver([("a", 1, 1000), ("a", 2, 1300), ("b", 1, 1000), ("b", 2, 1090), ("b", 3, 1180), (None, 7, 1310)])
    assert ("a", 1, 1100) in events() and ("a", 2, 1400) not in events()
    deliver([("b", 4, 1500), (gap_state.HEARTBEAT, None, 1600)])
    deliver([(gap_state.HEARTBEAT, None, 1700)])
    deliver([("a", 3, 1800), ("b", 5, 1810), (gap_state.HEARTBEAT, None, 1820)])
    assert [e for e in events() if e[0] in ("a", "b")] == [("a", 1, 1100), ("a", 2, 1400), ("b", 3, 1280), ("b", 4, 1600)]


def test_silences_are_found_by_spark(spark, capsys):
    """Session windows: no Python call per chain, ends exact, rows late by up to the delay counted, the heartbeat no chain."""
    base = tempfile.mkdtemp(prefix="gs-silent-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    schema = "chain string, number long, timestamp timestamp"

    def deliver(rows):
        (spark.createDataFrame(rows, "chain string, number long, s double").select("chain", "number", F.timestamp_micros((F.col("s") * 1e6).cast("long")).alias("timestamp"))
         .repartition(3).write.mode("append").parquet(src))
        q = (gap_state.silent_events(spark.readStream.schema(schema).parquet(src), stale_after_s=100, delay="50 seconds").writeStream
             .format("parquet").option("path", out).option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    def events():
        return sorted((r.chain or "-", r.number, r.s) for r in spark.read.parquet(out).select("chain", "number", (F.unix_micros("at") / 1e6).alias("s")).collect())
    capsys.readouterr()
    deliver([("a", 1, 1000.0), ("b", 1, 1200.0), ("c", None, 1000.0), (None, 3, 1000.25), (None, 4, 1100.25)]).explain()
    plan = capsys.readouterr().out
    assert "SessionWindow" in plan and "Python" not in plan and "Pandas" not in plan
    first = [("a", 1, 1100.0), ("c", 0, 1100.0)]
    assert events() == first
    deliver([("a", 2, 1160.0), (gap_state.HEARTBEAT, None, 1250.25)])       # 40 s late; the null chain's end is not passed yet
    assert events() == first
    deliver([(gap_state.HEARTBEAT, None, 1250.252)])
    assert events() == [("-", 4, 1200.25), *first]
    deliver([(gap_state.HEARTBEAT, None, 1320.0)])
    assert events() == [("-", 4, 1200.25), ("a", 1, 1100.0), ("a", 2, 1260.0), ("c", 0, 1100.0)]
