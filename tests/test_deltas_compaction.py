"""Upserts by delta and compaction by file size."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gapseries.sinks import compaction as C
from gapseries.sinks import deltas as X
from gapseries.sinks import writers as W
from gapseries.sources import driver

from conftest import SF001


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def _rows(df):
    return sorted(tuple(r) for r in df.select("number", "gas_used", "timestamp", "year_month", "_ingest_seq").collect())


def test_deltas_equal_upserts(spark):
    base = tempfile.mkdtemp(prefix="gs-delta-")
    path, plain = f"{base}/t", f"{base}/plain"
    raw = driver.raw_blocks(spark, SF001)
    assert X.read_merged(spark, path).count() == 0
    for name, rows in (("a", raw.filter("_ingest_seq = 1")), ("b", raw.filter("_ingest_seq = 2 and number % 2 = 0"))):
        assert X.append_delta(spark, path, rows, name)
        W.upsert_table(spark, plain, rows)
    assert _rows(X.read_merged(spark, path)) == _rows(W.read_table(spark, plain))         # deltas alone
    assert X.merge_deltas(spark, path) == 2 and X.batches(spark, path) == []
    assert _rows(X.read_merged(spark, path)) == _rows(W.read_table(spark, plain))         # base alone
    # an older version, a new one, one that moves to another month and a new key
    moved = raw.filter("number = 5").limit(1).withColumn("timestamp", F.lit("2024-03-03 01:00:00").cast("timestamp"))
    batch = (raw.filter("number < 3").withColumn("_ingest_seq", F.lit(0).cast("long"))
             .unionByName(raw.filter("number = 4").limit(1).withColumn("gas_used", F.lit(7).cast("long")).withColumn("_ingest_seq", F.lit(9).cast("long")))
             .unionByName(moved.withColumn("_ingest_seq", F.lit(9).cast("long")))
             .unionByName(raw.filter("number = 6").limit(1).withColumn("number", F.lit(10**9).cast("long"))))
    W.upsert_table(spark, plain, batch)
    assert X.append_delta(spark, path, batch, "c") and not X.append_delta(spark, path, batch, "c")
    assert _rows(X.read_merged(spark, path)) == _rows(W.read_table(spark, plain))
    # bytes of a flush follow the batch; a flush that was not committed is not read
    assert _size(f"{path}/delta") < _size(f"{path}/base") / 5
    os.remove(f"{path}/delta/batch=c/_SUCCESS")
    assert 10**9 not in {r[0] for r in X.read_merged(spark, path).select("number").collect()}
    assert X.append_delta(spark, path, batch, "c")
    assert X.merge_deltas(spark, path) == 1 and X.merge_deltas(spark, path) == 0
    assert _rows(X.read_merged(spark, path)) == _rows(W.read_table(spark, plain))
    with pytest.raises(ValueError):
        X.append_delta(spark, path, batch, "../c")


def test_merge_cut_off_before_its_batches_go(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(prefix="gs-delta-"), "t")
    raw = driver.raw_blocks(spark, SF001)
    X.append_delta(spark, path, raw, "a")
    want = _rows(X.read_merged(spark, path))
    kept = X.batches(spark, path)
    W.upsert_table(spark, f"{path}/base", X._delta_rows(spark, kept, "_ingest_seq", "year_month"))   # and then the job dies
    assert X.batches(spark, path) == kept and _rows(X.read_merged(spark, path)) == want
    assert X.merge_deltas(spark, path) == 1 and _rows(X.read_merged(spark, path)) == want


def _table(spark, path):
    """Partition a: one big file and 30 small ones; b: a single file; c: 5 small ones."""
    row = F.sha2(F.col("id").cast("string"), 512)
    big = spark.range(0, 20_000).select("id", row.alias("v"), F.lit("a").alias("p"))
    small = spark.range(20_000, 26_000, 1, 30).select("id", row.alias("v"), F.lit("a").alias("p"))
    one = spark.range(30_000, 30_100, 1, 1).select("id", row.alias("v"), F.lit("b").alias("p"))
    few = spark.range(40_000, 40_500, 1, 5).select("id", row.alias("v"), F.lit("c").alias("p"))
    for df in (big.coalesce(1), small, one, few):
        df.write.mode("append").partitionBy("p").parquet(path)


def _files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_compaction_by_size(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="gs-comp-"), "t")
    _table(spark, path)
    before = _files(path)
    largest = max(before, key=before.get)
    target = 300_000
    assert before[largest] > target
    rows = sorted(map(tuple, spark.read.parquet(path).select("id", "v", "p").collect()))
    got = {r.folder.rsplit("=", 1)[1]: r for r in C.compact_files(spark, path, "id", target).collect()}
    after = _files(path)
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "v", "p").collect())) == rows
    assert largest in after and after[largest] == before[largest]                # the big one is not rewritten
    assert {f for f in after if "p=b" in f} == {f for f in before if "p=b" in f}   # nor a file that is alone
    for p in "abc":
        count = sum(f"p={p}" in f for f in after)
        assert got[p].files_after == count and got[p].files_before == sum(f"p={p}" in f for f in before)
    assert got["c"].files_after == 1 and got["b"].bytes_rewritten == 0 and got["a"].files_after < got["a"].files_before / 3
    assert all(size < 1.75 * target for f, size in after.items() if f != largest)
    assert not os.path.exists(f"{path}/_compaction")
    for f in set(after) - set(before):                                          # each sorted
        ids = [r.id for r in spark.read.parquet(f).collect()]
        assert ids == sorted(ids)
    # nothing left to do: no file changes
    C.compact_files(spark, path, "id", 1)
    assert set(_files(path)) == set(after)


@pytest.mark.parametrize("moved", [0, 1])
def test_compaction_cut_off(spark, monkeypatch, moved):
    """Killed before or while the files are exchanged: the next run finishes it, no row lost or doubled."""
    path = os.path.join(tempfile.mkdtemp(prefix="gs-comp-"), "t")
    _table(spark, path)
    rows = sorted(map(tuple, spark.read.parquet(path).select("id", "v", "p").collect()))
    swap = C._swap

    def die(spark, staging):
        if moved:                                                               # one file is in its place already
            folder = open(f"{staging}/ready").read().split("\n")[0].removeprefix("file:")
            name = next(f for f in os.listdir(f"{staging}/files") if f.endswith(".parquet"))
            os.rename(f"{staging}/files/{name}", f"{folder}/{name}")
        raise RuntimeError("killed")
    monkeypatch.setattr(C, "_swap", die)
    with pytest.raises(RuntimeError):
        C.compact_files(spark, path, "id")
    got = sorted(map(tuple, spark.read.parquet(path).select("id", "v", "p").collect()))
    assert set(got) == set(rows) and (moved or got == rows)
    monkeypatch.setattr(C, "_swap", swap)
    C.compact_files(spark, path, "id")
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "v", "p").collect())) == rows
    assert not os.path.exists(f"{path}/_compaction")


def test_compaction_of_an_empty_folder(spark):
    path = tempfile.mkdtemp(prefix="gs-comp-")
    assert C.compact_files(spark, path).count() == 0
