"""Long transaction lists: messages are written and parsed once, over many tasks, and only kept where they are needed."""

import glob
import os

from pyspark.sql import functions as F

from gapseries.functions import hexcodec as H
from gapseries.plans import registry
from gapseries.session import ensure_checkpoint_dir
from gapseries.sources import decoders as D
from gapseries.sources import driver
from gapseries.streaming import ingest

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_on_decoded_values_does_not_parse_again(spark):
    rows = spark.createDataFrame([("{}",), ("{broken",), (None,)], "json string")
    decoded = D.decode_blocks(rows)
    assert _plan(decoded.filter("_valid")).count("from_json(") == 1
    assert decoded.count() == 3 and decoded.filter("_valid").count() == 0


def test_messages_hold_the_same_list(spark):
    blocks = driver.raw_blocks(spark, SF001)
    listed = F.from_json("json", D.RPC_MESSAGE)["result"]["transactions"]
    wanted = F.transform(F.sequence(F.lit(1), F.col("transaction_count").cast("int")), lambda i: H.long_to_hex(F.col("number") * 100000 + i))
    got = D.encode_blocks(blocks).select(listed.alias("t"))
    assert got.exceptAll(blocks.select(wanted)).count() == 0 and got.count() == blocks.count()
    assert "array_join" not in _plan(D.encode_blocks(blocks)) and "concat_ws" in _plan(D.encode_blocks(blocks))


def test_messages_of_odd_blocks(spark):
    row = driver.raw_blocks(spark, SF001).limit(1)
    message = lambda number, n: D.encode_blocks(row.withColumn("number", F.lit(number).cast("bigint")).withColumn(
        "transaction_count", F.lit(n).cast("bigint"))).first()[0]
    assert message(7, 2).endswith('"transactions":["0xaae61","0xaae62"]}}')
    assert message(7, 0).endswith('"transactions":[]}}') and message(7, None).endswith('"transactions":[]}}')
    assert message(None, 2).endswith('"transactions":[null,null]}}')


def _dealt(spark, name):
    return "RepartitionByExpression" in _plan(registry.plans()[name](spark, SF001))


def test_builder_tags_is_dealt(spark):
    assert _dealt(spark, "builder_tags")


def test_wide_hex_round_trip_is_dealt(spark):
    assert _dealt(spark, "wide_hex_round_trip")


def test_ingest_quarantine_is_dealt(spark):
    assert _dealt(spark, "ingest_quarantine")


def test_only_malformed_messages_keep_their_text(spark, tmp_path):
    good = D.encode_blocks(driver.raw_blocks(spark, SF001).limit(1))
    good.unionByName(spark.createDataFrame([("{broken",)], "json string")).write.text(str(tmp_path / "in"))
    kept = ingest.stored_columns(ingest.block_stream(spark, str(tmp_path / "in")))
    q = kept.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = {r["_valid"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows[True]["json"] is None and rows[True]["row_hash"] is not None and rows[False]["json"] == "{broken"
    assert "withdrawals" not in kept.columns


def _landed(spark, name):
    shared = ensure_checkpoint_dir(spark)
    before = set(os.listdir(shared))
    registry.plans()[name](spark, SF001)
    return [f for d in set(os.listdir(shared)) - before for f in glob.glob(os.path.join(shared, d, "landed", "part-*"))]


def test_stream_ingest_lands_little(spark):
    files = _landed(spark, "stream_ingest")
    assert sum(f.endswith(".txt.gz") for f in files) > 1


def test_ingest_bad_messages_lands_little(spark):
    assert any(f.endswith(".txt.gz") for f in _landed(spark, "ingest_bad_messages"))


def test_stream_interval_flush_lands_little(spark):
    files = _landed(spark, "stream_interval_flush")
    assert files and all(f.endswith(".txt.gz") for f in files)


def test_ingest_revisions_lands_in_several_files(spark):
    files = _landed(spark, "ingest_revisions")
    assert len(files) > 1 and all(f.endswith(".txt.gz") for f in files)


def test_hash_lists_by_columns_of_digits():
    """The lists of one table of digits: carries, numbers without leading zeros, negative numbers, whatever came before."""
    tables = {}
    for lo, n in ((1, 20), (600_000_000_001, 90_000), (65_530, 10), (1, 70_000), (100_001, 7), (-99_999, 150_000), (0xfffff0, 40), (65_536, 1)):
        wanted = ",".join(f'"{i & (1 << 64) - 1:#x}"' for i in range(lo, lo + n))
        assert b"".join(bytes(t) for t in D._hashes(lo, lo + n - 1, tables)).decode() == wanted


def test_long_messages_are_handed_on_a_few_at_a_time():
    import pyarrow as pa
    n, size = 40, 50_000
    batch = pa.record_batch([pa.array(['{"transactions":[]}}'] * n), pa.array([1_000_001] * (n - 1) + [None], pa.int64()),
                             pa.array([1_000_000 + size] * (n - 1) + [None], pa.int64())], ["json", "lo", "hi"])
    out = list(D.write_lists(iter([batch])))
    assert len(out) > 1 and sum(b.num_rows for b in out) == n and all(b.nbytes < D.HELD + size * 16 for b in out)
    texts = [t for b in out for t in b.column(0).to_pylist()]
    assert texts[-1] == '{"transactions":[]}}' and all(t.count('"0x') == size and t.endswith('"]}}') for t in texts[:-1])


def test_a_landed_message_is_parsed_once(spark, tmp_path):
    """The JSON-RPC id comes from the parse of the message; one that is text, or no number, leaves the block valid."""
    D.encode_blocks(driver.raw_blocks(spark, SF001).limit(1)).write.text(str(tmp_path / "in"))
    stream = ingest.block_stream(spark, str(tmp_path / "in"))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "get_json_object" not in plan and plan.count("from_json(") == 1
    good = '{"id":%s,"result":{"number":"0x5","timestamp":"0x5","gasLimit":"0x1","gasUsed":"0x1","size":"0x2","transactions":[{"a":[1]},"b",null]}}'
    rows = spark.createDataFrame([(good % i,) for i in ("7", '"8"', '"x"', "null", '{"a":1}')], "json string")
    got = D.decode_blocks(rows, keep_raw=True, message_col="_message").collect()
    assert [r._message for r in got] == [7, 8, None, None, None] and all(r._valid and r.transaction_count == 3 for r in got)


def test_stream_interval_flush_lands_by_the_length_of_the_lists(spark):
    from gapseries.plans import q_streaming
    assert len(_landed(spark, "stream_interval_flush")) >= 4       # two deliveries, two files a trigger
    blocks = driver.raw_blocks(spark, SF001).limit(100).withColumn("transaction_count", F.lit(q_streaming.FILE_HASHES // 10))
    assert q_streaming._dealt(blocks).rdd.getNumPartitions() == 10
    assert q_streaming._dealt(blocks.filter("false")).rdd.getNumPartitions() == 2
