"""Decoders: hex cases, quarantine, fee history golden, klines, dedup/upsert idempotence."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.functions import hexcodec as H
from gapseries.operators import rollup, sets
from gapseries.sources import decoders as D
from gapseries.sources import driver

from conftest import SF001

# A fee-history payload of five blocks (public RPC example).
FEE_HISTORY = {
    "oldestBlock": "0x16a00e0",
    "baseFeePerGas": ["0x3b561e55", "0x3b35c053", "0x3a8c0e0b", "0x3b8b9f26", "0x39f2153e", "0x363316d5"],
    "baseFeePerBlobGas": ["0x3", "0x2", "0x2", "0x2", "0x2", "0x2"],
    "gasUsedRatio": [0.49147676766492737, 0.4552185777777778, 0.5682054666666667, 0.39253506666666665, 0.241408],
    "blobGasUsedRatio": [0, 0.7777777777777778, 0.5555555555555556, 0.7777777777777778, 0],
    "reward": [["0xb7980", "0x5f5e100", "0x1dcd6500"], ["0x22544", "0x5f5e100", "0x29726d06"],
               ["0x2b282", "0xa1e5e77", "0x6553f100"], ["0x54e0840", "0xa2e4816", "0x6553f100"],
               ["0x54e0840", "0xe1cc6b2", "0x1dcd6500"]],
}


def test_hex_cases(spark):
    df = spark.createDataFrame([("0x0",), ("0x16a00e1",), (None,), ("0xc70d815d562d3cfa955",), ("0x" + "f" * 40,)],
                               "h string")
    r = df.select(H.hex_to_long("h").alias("l"), H.hex_to_decimal("h").alias("d")).collect()
    assert r[0].l == 0 and r[1].l == 0x16a00e1 and r[2].l is None
    assert int(r[3].d) == 58750003716598352816469
    assert r[4].d is None                    # wider than 38 digits: NULL, to quarantine


def test_builder_tag(spark):
    df = spark.createDataFrame([("0x4275696c6465722b20ff",)], "h string")
    assert df.select(H.hex_to_text("h")).first()[0] == "Builder+"


def test_decode_cases_and_quarantine(spark):
    full = {"result": {"number": "0x10", "timestamp": "0x65920080", "gasLimit": "0x1c9c380", "gasUsed": "0x0",
                       "size": "0x100", "difficulty": "0x0", "transactions": [], "blobGasUsed": "0x0"}}
    msgs = [json.dumps(full), "{not json", json.dumps({"result": None}),
            json.dumps({"result": {"timestamp": "0x1"}})]
    df = spark.createDataFrame([(m,) for m in msgs], "json string")
    valid, bad = D.split_blocks(D.decode_blocks(df))
    v = valid.collect()
    assert len(v) == 1 and bad.count() == 3
    r = v[0]
    assert r.number == 16 and r.blob_gas_used == 0 and r.excess_blob_gas is None
    assert r.transaction_count == 0 and r.base_fee_per_gas == 0 and int(r.total_difficulty) == 0


def test_fee_history_golden(spark):
    df = spark.createDataFrame([(json.dumps(FEE_HISTORY),)], "json string")
    rows = D.decode_fee_history(df, keep=[]).withColumn("p", F.lit(1))
    assert rows.count() == 5
    s = rollup.fee_history_summary(rows, "p").first()
    assert round(s.avg_gas_utilization_pct / 100, 2) == 0.43
    assert s.congestion_level == "low"
    assert round(s.base_fee_change_pct, 2) == -8.66
    assert s.base_fee_trend == "decreasing"


def test_klines_bad_numbers_and_cut(spark):
    k = [[1700000000000, "1.0", "2.0", "0.5", "1.5", "oops", 1700000059999, "0", "12", "0", "0", "0"],
         [1700000060000, "1.5", "2.5", "1.0", "2.0", "10.0", 1700000119999, "0", "7", "0", "0", "0"]]
    df = spark.createDataFrame([("SOLUSDT", json.dumps(k))], "symbol string, json string")
    out = D.decode_klines(df, end_ms=1700000060000).collect()
    assert len(out) == 1 and out[0].volume is None and out[0].trades == 12


def test_roundtrip_encode_decode(spark):
    b = driver.blocks(spark, SF001)
    valid, bad = D.split_blocks(D.decode_blocks(D.encode_blocks(b)))
    assert bad.count() == 0 and valid.count() == b.count()
    v = valid.select("number", *[F.col(c).alias("v_" + c) for c in ("difficulty", "total_difficulty", "blob_gas_used")])
    j = v.join(b, "number").filter(
        (F.col("v_difficulty") != F.col("difficulty")) | (F.col("v_total_difficulty") != F.col("total_difficulty"))
        | ~F.col("v_blob_gas_used").eqNullSafe(F.col("blob_gas_used")))
    assert j.count() == 0


def test_upsert_idempotent(spark):
    raw = driver.raw_blocks(spark, SF001)
    once = sets.upsert(raw.filter(F.col("_ingest_seq") == 1), raw.filter(F.col("_ingest_seq") == 2))
    twice = sets.upsert(once, raw.filter(F.col("_ingest_seq") == 2))
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == once.select("number").distinct().count()


def test_schema_diff(spark):
    from pyspark.sql import types as T

    from gapseries.sources.contract import block_contract, schema_diff
    live = T.StructType([f for f in block_contract().fields if f.name != "size"]
                        + [T.StructField("extra", T.StringType())])
    live = T.StructType([T.StructField(f.name, T.IntegerType()) if f.name == "gas_used" else f for f in live.fields])
    d = {r.name: r.status for r in schema_diff(spark, block_contract(), live).collect()}
    assert d["size"] == "missing_in_live" and d["extra"] == "extra_in_live" and d["gas_used"] == "type_mismatch"
    assert d["number"] == "ok"


def test_read_csv_years_lookback_reports(spark, tmp_path):
    import datetime as dt

    from gapseries.sinks import writers as W
    csv = tmp_path / "blocks.csv"
    csv.write_text("block_number,timestamp,datetime_utc,hash,parent_hash,miner,gas_used,gas_limit,base_fee_per_gas,tx_count\n"
                   "21540120,1736035199,2025-01-04 23:59:59,0xa,0xb,0xc,100,200,7,3\n"
                   "21540121,1736035211,2025-01-05 00:00:11,0xd,0xa,0xc,bad,200,7,3\n")
    df = D.read_csv_blocks(spark, str(csv))
    rows = df.orderBy("block_number").collect()
    assert len(rows) == 2 and rows[1].gas_used is None and rows[0].ts == dt.datetime(2025, 1, 4, 23, 59, 59)
    assert D.read_years(df, 2025, 2026, ts="ts").count() == 2
    assert D.read_lookback(df, 1, "2025-01-05 00:00:11", ts="ts").count() == 1      # half-open
    base = str(tmp_path / "reports")
    W.append_reports(df.drop("timestamp").withColumnRenamed("ts", "timestamp"), "gaps", base)
    assert D.read_reports(spark, base, "gaps", start="2025-01-05").count() == 1


def test_overwide_difficulty_is_quarantined(spark):
    msg = {"result": {"number": "0x1", "timestamp": "0x1", "gasLimit": "0x1", "gasUsed": "0x0", "size": "0x1",
                      "difficulty": "0x0", "totalDifficulty": "0x" + "f" * 40, "transactions": []}}
    df = spark.createDataFrame([(json.dumps(msg),)], "json string")
    valid, bad = D.split_blocks(D.decode_blocks(df))
    assert valid.count() == 0 and bad.count() == 1


def test_wide_values_and_bad_fields_are_never_stored(spark):
    good = '{"result":{"number":"0x5","timestamp":"0x5","gasLimit":"%s","gasUsed":"0x1","size":"0x2","transactions":[]%s}}'
    cases = [(good % ("0x9", ""), True), (good % ("0x" + "f" * 20, ""), False), (good % ("0x1z", ""), False),
             (good % ("9", ""), False), (good % ("0x9", ',"blobGasUsed":"0xq"'), False), (good % ("0x9", ',"difficulty":"0x%s"' % ("f" * 40)), False),
             ('{"result":{"number":"0x5"}}', False), ("", False), ("[]", False), (None, False)]
    rows = D.decode_blocks(spark.createDataFrame([(j,) for j, _ in cases], "json string"), keep_raw=True).collect()
    assert {r.json: r._valid for r in rows} == dict(cases)


def test_decoders_survive_bad_records(spark):
    df = spark.createDataFrame([("nope",), ('{"timestamp":"25:61"}',), ('{"timestamp":"2024-01-01T00:00:00Z"}',)], "json string")
    good, bad = D.split_timed(D.decode_mempool(df))
    assert good.count() == 1 and bad.count() == 2
    good, bad = D.split_timed(D.decode_fee_history(spark.createDataFrame(
        [('{"oldestBlock":"0x1","gasUsedRatio":[0.1,0.2],"baseFeePerGas":["0x5"],"reward":[["0x1"]]}',), ("{",)], "json string")), "number")
    assert [(r.number, r.base_fee_per_gas, r.reward_p25, r.reward_p50) for r in good.collect()] == [(1, 5, 1, None), (2, None, None, None)]
    assert bad.count() == 1     # the unreadable payload is set aside, it used to vanish
    bars = D.decode_klines(spark.createDataFrame([("[[1000],[]]",), ("x",)], "json string"), symbol="S").collect()
    assert sorted((r.ts is not None, r.close) for r in bars) == [(False, None), (False, None), (True, None)]


def test_footers_add_up(spark, tmp_path):
    """Sizes, nulls and row groups from footers alone, several files, nested columns, hidden files, a single file, no file."""
    import pyarrow.parquet as pq
    import pytest

    from gapseries.sources import footers
    path = str(tmp_path / "t")
    df = spark.range(0, 1000).selectExpr("id", "CASE WHEN id % 4 = 0 THEN NULL ELSE id * 0.5 END AS v", "array(id, id + 1) AS a")
    df.repartition(3).write.partitionBy().parquet(path)
    got = {r.column: r for r in footers.column_storage(spark, path, files_per_partition=2).collect()}
    assert set(got) == {"id", "v", "a.list.element"}
    files = [f for f in (tmp_path / "t").iterdir() if f.name.startswith("part-")]
    for name, i in (("id", 0), ("v", 1), ("a.list.element", 2)):
        want = [pq.read_metadata(f).row_group(g).column(i) for f in files for g in range(pq.read_metadata(f).num_row_groups)]
        assert got[name].compressed_bytes == sum(c.total_compressed_size for c in want)
        assert got[name].plain_bytes == sum(c.total_uncompressed_size for c in want)
        assert got[name].rows == 1000 and got[name].files == len(files)
    assert got["v"].nulls == 250 and got["id"].nulls == 0 and got["a.list.element"]["values"] == 2000
    assert footers.footers(spark, path, 1).rdd.getNumPartitions() == len(files)
    one = footers.file_storage(spark, str(files[0])).collect()
    assert len(one) == 1 and one[0].rows == pq.read_metadata(files[0]).num_rows
    (tmp_path / "none").mkdir()
    assert footers.column_storage(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(Exception, match="FileNotFoundError"):
        footers.column_storage(spark, str(tmp_path / "missing")).collect()


def test_times_beyond_any_year_are_no_times(spark):
    """Huge and negative epochs give NULL in every decoder and stop nothing."""
    big = 9223372036854775807
    blocks = D.decode_blocks(spark.createDataFrame([('{"result":{"number":"0x1","timestamp":"0x7fffffffffffffff","gasLimit":"0x1","gasUsed":"0x1",'
                                                     '"size":"0x1","transactions":[]}}',)], "json string")).first()
    assert blocks.timestamp is None and not blocks._valid
    bars = D.decode_klines(spark.createDataFrame([(f'[[{big},"1"],[253402300800000,"1"],[253402300799999,"1"]]',)], "json string"), symbol="S").collect()
    assert [b.ts is None for b in bars] == [True, True, False]
    points = D.decode_series(spark.createDataFrame([('{"values":[{"x":%d,"y":1},{"x":-%d,"y":2},{"x":0,"y":3}]}' % (big, big),)], "json string")).collect()
    assert [p.ts is None for p in points] == [True, True, False]


def test_unreadable_payloads_are_not_lost(spark):
    df = spark.createDataFrame([("not json",), (None,), ('{"error":"x"}',), ('{"oldestBlock":"0x1","gasUsedRatio":[]}',),
                                ('{"oldestBlock":"0x1","gasUsedRatio":[0.5]}',), ('{"gasUsedRatio":[0.5,0.5]}',)], "json string")
    good, bad = D.split_timed(D.decode_fee_history(df), "number")
    assert good.count() == 1 and bad.count() == 5
    df = spark.createDataFrame([("not json",), (None,), ('{"code":-1}',), ("[]",), ('[[1000,"1"]]',)], "json string")
    rows = D.decode_klines(df, symbol="S", end_ms=500, keep=["json"])
    good, bad = D.split_timed(rows, "ts")
    assert good.count() == 0 and sorted(map(str, (r.json for r in bad.collect()))) == ["None", "not json", '{"code":-1}']
    df = spark.createDataFrame([("not json",), ("{}",), ('{"values":[]}',), ('{"values":[{"x":1,"y":2}]}',)], "json string")
    good, bad = D.split_timed(D.decode_series(df), "ts")
    assert good.count() == 1 and bad.count() == 2


def test_contract_files(spark, tmp_path):
    """A contract read from a file enforces types, null rules, minima and era starts; a wrong one is refused."""
    import pytest

    from gapseries.sources import contract as C
    text = ('{"chain": "toy", "columns": [{"name": "number", "type": "bigint", "nullable": false, "minimum": 0},'
            ' {"name": "fee", "type": "decimal(20,0)", "nullable": false, "since_block": 10, "minimum": 1}, {"name": "tags", "type": "array<string>"}]}')
    (tmp_path / "toy.json").write_text(text)
    got = C.load_contract(spark, str(tmp_path / "toy.json"))
    assert C.contract_schema("toy") is got and got["fee"].dataType == T.DecimalType(20, 0) and got["fee"].metadata["since_block"] == 10
    rows = [(1, None, ["a"]), (12, None, None), (-1, 5, None), (None, 0, None), (20, 7, None)]
    df = spark.createDataFrame(rows, "number long, fee long, tags array<string>").withColumn("fee", F.col("fee").cast("decimal(20,0)"))
    df.withColumn("other", F.lit(1)).write.parquet(str(tmp_path / "t"))
    good, bad = C.read_contract(spark, str(tmp_path / "t"), got, key="number")
    assert sorted(r.number for r in good.collect()) == [1, 20] and good.columns == ["number", "fee", "tags"]
    assert sorted((r.number or 0, tuple(r.violations)) for r in bad.collect()) == [
        (-1, ("number:minimum",)), (0, ("number:null", "fee:minimum")), (12, ("fee:null",))]
    # a column that the files lack
    df.drop("fee").write.parquet(str(tmp_path / "u"))
    good, bad = C.read_contract(spark, str(tmp_path / "u"), got, key="number")
    assert {r.number for r in bad.collect()} == {12, 20, -1, None}
    for wrong in ('[]', '{"chain": "x"}', '{"chain": "x", "columns": []}', '{"chain": "x", "columns": [{"name": "a"}]}',
                  '{"chain": "x", "columns": [{"name": "a", "type": "bigint", "minumum": 1}]}', '{"chain": "x", "rules": 1, "columns": [{"name": "a", "type": "int"}]}',
                  '{"chain": "x", "columns": [{"name": "a", "type": "int"}, {"name": "A", "type": "int"}]}',
                  '{"chain": "x", "columns": [{"name": "a", "type": "int", "minimum": "1"}]}'):
        with pytest.raises(ValueError):
            C.parse_contract(wrong)
    with pytest.raises(ValueError, match="unknown contract"):
        C.contract_schema("nowhere")
