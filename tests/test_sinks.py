"""Sinks: partitioned writes, idempotent upsert of touched partitions, reports, retention, compaction."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from gapseries.sinks import writers as W
from gapseries.sources import decoders as D
from gapseries.sources import driver

from conftest import SF001


def test_upsert_table_idempotent_and_moves(spark):
    base = tempfile.mkdtemp(prefix="gs-sink-")
    path = os.path.join(base, "blocks")
    raw = driver.raw_blocks(spark, SF001)
    first = raw.filter(F.col("_ingest_seq") == 1)
    revised = raw.filter(F.col("_ingest_seq") == 2)
    W.write_blocks(first, path, mode="overwrite")
    W.upsert_table(spark, path, revised)
    n1 = spark.read.parquet(path).count()
    W.upsert_table(spark, path, revised)          # replay: no change
    t2 = spark.read.parquet(path)
    assert n1 == t2.count() == first.count()
    got = {r.number: r.gas_used for r in t2.select("number", "gas_used").collect()}
    exp = {r.number: r.gas_used for r in driver.blocks(spark, SF001).select("number", "gas_used").collect()}
    assert got == exp
    # a revision that moves a block to another month removes the old row
    moved = D.normalise_blocks(driver.blocks(spark, SF001).filter(F.col("number") == 5)).withColumn(
        "timestamp", F.lit(dt.datetime(2024, 2, 3))).withColumn("_ingest_seq", F.lit(9).cast("bigint")).drop(
        "year_month")
    W.upsert_table(spark, path, moved)
    t3 = W.read_table(spark, path)
    rows = t3.filter(F.col("number") == 5).collect()
    assert len(rows) == 1 and rows[0].year_month == "202402"
    v = {r.year: (r.source_rows, r.target_rows) for r in W.verify_counts(first, t3).collect()}
    assert v == {2024: (first.count(), first.count())}


def test_append_new_first_wins(spark):
    base = tempfile.mkdtemp(prefix="gs-ins-")
    path = os.path.join(base, "blocks")
    a = driver.source_blocks(spark, SF001, "primary")
    b = driver.source_blocks(spark, SF001, "backfill")
    W.write_blocks(a, path, mode="overwrite")
    W.append_new(spark, path, b)
    t = spark.read.parquet(path)
    assert t.count() == t.select("number").distinct().count() == a.unionByName(b).select("number").distinct().count()


def test_reports_retention_and_compaction(spark):
    base = tempfile.mkdtemp(prefix="gs-rep-")
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d, 12), "x") for d in range(1, 11)], "timestamp timestamp, v string")
    W.append_reports(rows, "validation", base)
    W.retain(spark, base, "validation", dt.datetime(2024, 1, 11), 3, os.path.join(base, "kept"))
    kept = spark.read.parquet(os.path.join(base, "kept"))
    assert kept.count() == 3
    W.write_hourly(rows, os.path.join(base, "hourly"))
    W.compact(spark, os.path.join(base, "hourly"), os.path.join(base, "daily"))
    assert spark.read.parquet(os.path.join(base, "daily")).count() == 10
    W.export(rows, os.path.join(base, "csv"), "csv")
    assert spark.read.option("header", True).csv(os.path.join(base, "csv")).count() == 10


def test_copy_range_and_expected_grid(spark):
    from gapseries.operators.ranges import expected_grid
    base = tempfile.mkdtemp(prefix="gs-copy-")
    dst = os.path.join(base, "copy")
    W.copy_range(driver.raw_blocks(spark, SF001), dst, start="2024-01-02", end="2024-01-03")
    t = W.read_table(spark, dst)
    exp = driver.blocks(spark, SF001).filter((F.col("timestamp") >= "2024-01-02") & (F.col("timestamp") < "2024-01-04"))
    assert t.count() == exp.count() == t.select("number").distinct().count()
    g = expected_grid(spark, "2025-01-01 00:00:00", "2025-01-01 00:05:00", 60).orderBy("ts").collect()
    assert [r.ts for r in g] == [dt.datetime(2025, 1, 1, 0, m) for m in range(6)]


def test_upsert_daily_partitions(spark):
    base = tempfile.mkdtemp(prefix="gs-day-")
    path = os.path.join(base, "blocks")
    raw = driver.raw_blocks(spark, SF001)
    W.write_blocks(raw.filter(F.col("_ingest_seq") == 1), path, mode="overwrite", part_col="day")
    W.upsert_table(spark, path, raw.filter(F.col("_ingest_seq") == 2), part_col="day")
    t = W.read_table(spark, path, part_col="day")
    exp = {r.number: r.gas_used for r in driver.blocks(spark, SF001).select("number", "gas_used").collect()}
    assert {r.number: r.gas_used for r in t.select("number", "gas_used").collect()} == exp
    assert t.select("day").distinct().count() == 30 and t.filter(F.col("day") != F.date_format(
        "timestamp", "yyyyMMdd")).count() == 0


def _one(spark, number, when, gas, seq):
    b = driver.blocks(spark, SF001).limit(1)
    return b.withColumn("number", F.lit(number).cast("long")).withColumn("timestamp", F.lit(when)).withColumn(
        "gas_used", F.lit(gas).cast("long")).withColumn("_ingest_seq", F.lit(seq).cast("long"))


def test_first_write_keeps_the_newest_version(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="gs-first-"), "blocks")
    both = _one(spark, 5, dt.datetime(2024, 1, 3), 900, 1).unionByName(_one(spark, 5, dt.datetime(2024, 1, 3), 100, 2))
    W.upsert_table(spark, path, both)
    assert [r.gas_used for r in W.read_table(spark, path).collect()] == [100]


def test_upsert_removes_an_emptied_partition(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="gs-moved-"), "blocks")
    W.upsert_table(spark, path, _one(spark, 5, dt.datetime(2024, 1, 3), 1, 1).unionByName(_one(spark, 9, dt.datetime(2024, 3, 3), 1, 1)))
    W.upsert_table(spark, path, _one(spark, 5, dt.datetime(2024, 2, 3), 2, 2))
    assert sorted((r.number, r.year_month, r.gas_used) for r in W.read_table(spark, path).collect()) == [(5, "202402", 2), (9, "202403", 1)]
    assert not os.path.exists(os.path.join(path, "year_month=202401"))


def test_upsert_does_not_wipe_what_it_cannot_read(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="gs-bad-"), "blocks")
    os.makedirs(os.path.join(path, "year_month=202401"))
    bad = os.path.join(path, "year_month=202401", "part-0.parquet")
    with open(bad, "w") as fh:
        fh.write("no parquet")
    try:
        W.upsert_table(spark, path, _one(spark, 5, dt.datetime(2024, 1, 3), 1, 1))
        raised = False
    except Exception:  # noqa: BLE001 - whichever error Spark gives for a broken file
        raised = True
    assert raised and os.path.exists(bad)


def test_checkpoint_folder_must_be_shared_off_local():
    import pytest

    from gapseries import session

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared"
    assert session.ensure_checkpoint_dir(Session()) == "hdfs:///shared"


def test_report_messages_may_hold_quotes(spark):
    from gapseries.operators import quality as Q
    b = driver.blocks(spark, SF001)
    rows = Q.report(b, [Q.custom_rule("c", F.col("size") > 0, "it can't be \\ \"empty\"")], "2024-01-31", "x").collect()
    assert [r.message for r in rows] == ["it can't be \\ \"empty\""]


def test_prefilter_loses_no_stored_key(spark):
    """Every stored key may be stored; few new ones may; a saturated filter only sends more rows to the exact join."""
    from gapseries.operators.prefilter import split_known
    stored = spark.range(0, 40_000, 2).select("id", F.concat(F.lit("k"), F.col("id")).alias("name"))
    rows = spark.range(0, 40_000).select("id", F.concat(F.lit("k"), F.col("id")).alias("name"), F.lit(1).alias("v"))
    for keys in (["id"], ["id", "name"], ["name"]):
        new, maybe = split_known(rows, stored, keys, 20_000)
        assert new.where("id % 2 = 0").count() == 0 and maybe.where("id % 2 = 0").count() == 20_000
        assert maybe.where("id % 2 = 1").count() < 600 and new.count() + maybe.count() == 40_000
        assert new.columns == maybe.columns == rows.columns
    full = split_known(rows, stored, ["id"], 20_000, max_bytes=1)          # one page
    assert full[0].where("id % 2 = 0").count() == 0 and full[1].count() > 25_000
    none = split_known(rows, stored.limit(0), ["id"], 0)
    assert (none[0].count(), none[1].count()) == (40_000, 0)


def test_append_new_whatever_the_filter(spark):
    """Stored, new, repeated and null-sequence rows: the same table with a saturated filter; a second run adds nothing."""
    raw = driver.raw_blocks(spark, SF001)
    first = raw.filter((F.col("number") % 3 == 0) & (F.col("_ingest_seq") == 1))
    tables = []
    for size in (1, 1 << 20):
        path = os.path.join(tempfile.mkdtemp(prefix="gs-ign-"), "blocks")
        W.write_blocks(first, path, mode="overwrite")
        for _ in range(2):
            W.append_new(spark, path, raw, max_filter_bytes=size)
        tables.append(sorted((r.number, r.gas_used, r._ingest_seq) for r in W.read_table(spark, path).collect()))
    numbers = [r[0] for r in tables[0]]
    assert tables[0] == tables[1] and len(numbers) == len(set(numbers)) == raw.select("number").distinct().count()
    assert {r[2] for r in tables[0]} == {1}
