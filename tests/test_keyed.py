"""The keyed target of the streaming load: it reads its buckets only, and stays small."""

import os

from pyspark.sql import functions as F

from feedspark.operators import load
from feedspark.plans import fixtures as fx
from feedspark.streaming.keyed import KeyedTarget, load_keyed_batch, stream_keyed_load

SF = "/root/testdata/sf0.001"


def some(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").cast("string").alias("id"))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_stream_equals_batch_resumes_and_replays(spark, tmp_dir):
    ev = fx.events(spark, SF)
    d = fx.deliveries(ev).select("id", "strategy")
    landing, path = tmp_dir + "/landing", tmp_dir + "/target"
    target = KeyedTarget(spark, path).create(fx.existing_target(ev), n_buckets=8)
    d.where("strategy = 'feed'").repartition(3).write.parquet(landing)
    stream_keyed_load(spark, landing, d.schema, path, tmp_dir + "/c", files_per_trigger=1, tend_every=2, max_files=2)
    d.where("strategy != 'feed'").repartition(3).write.mode("append").parquet(landing)
    stream_keyed_load(spark, landing, d.schema, path, tmp_dir + "/c", files_per_trigger=2, tend_every=2, max_files=2)
    want = ids(load.loaded_ids(d, fx.existing_target(ev)))
    assert ids(target.read()) == want
    stream_keyed_load(spark, landing, d.schema, path, tmp_dir + "/c2")          # replay with a fresh checkpoint
    assert ids(target.read()) == want


def test_a_batch_reads_only_its_buckets(spark, tmp_dir):
    target = KeyedTarget(spark, tmp_dir + "/t").create(some(spark, 0, 20000), n_buckets=64)
    batch = some(spark, 19998, 20003)
    plan = target.unseen(batch)
    read = {f.split("bucket=")[1].split("/")[0] for f in plan.inputFiles() if "bucket=" in f}
    mine = {str(r[0]) for r in batch.select(F.pmod(F.xxhash64("id"), F.lit(64))).collect()}
    assert read and read <= mine and len(mine) <= 5
    assert ids(plan) == ["20000", "20001", "20002"]
    assert "Cartesian" not in plan._jdf.queryExecution().executedPlan().toString()


def bytes_read(target, batch):
    files = [f for f in target.unseen(batch).inputFiles() if "bucket=" in f]
    return sum(os.path.getsize(f.removeprefix("file:")) for f in set(files))


def test_bytes_read_do_not_grow_with_the_target(spark, tmp_dir):
    target = KeyedTarget(spark, tmp_dir + "/t").create(some(spark, 0, 10000), n_buckets=4)
    target.tend(bucket_bytes=20_000)
    before, n = bytes_read(target, some(spark, 5000, 5003)), target.state["n_buckets"]
    for lo in range(10000, 160000, 50000):
        target.append(some(spark, lo, lo + 50000))
        target.tend(bucket_bytes=20_000)
    assert target.state["n_buckets"] >= 8 * n
    assert target.read().count() == 160000 == target.read().select("id").distinct().count()
    assert bytes_read(target, some(spark, 5000, 5003)) < 2 * before


def test_small_files_are_compacted_by_a_staged_swap(spark, tmp_dir, monkeypatch):
    path = tmp_dir + "/t"
    target = KeyedTarget(spark, path).create(n_buckets=4)
    for i in range(5):
        target.append(some(spark, i * 10, i * 10 + 40))
    want = ids(some(spark, 0, 80))
    assert len(target.read().inputFiles()) > 8

    def fails(*_):
        raise RuntimeError("stop")
    with monkeypatch.context() as m:
        m.setattr(KeyedTarget, "_publish", fails)            # a rewrite that ends before its swap
        try:
            target.tend(max_files=2)
        except RuntimeError:
            pass
    assert ids(target.read()) == want
    assert target.tend(max_files=2)["rewritten"] == 4
    assert ids(target.read()) == want and len(target.read().inputFiles()) == 4
    target.append(some(spark, 70, 90))                       # into the new versions
    assert ids(target.read()) == ids(some(spark, 0, 90))
    assert target.tend(max_files=20) == {"rewritten": 0, "n_buckets": 4}


def test_edges(spark, tmp_dir):
    target = KeyedTarget(spark, tmp_dir + "/t").create(n_buckets=4)
    assert target.read().collect() == []
    rows = spark.createDataFrame([("a",), (None,), ("a",), ("",)], "id string")
    load_keyed_batch(tmp_dir + "/t", tend_every=0)(rows, 0)
    target.append(rows.where("id = 'zzz'"))
    assert ids(target.read()) == ["", "a"]
    try:
        target.create()
        raise AssertionError
    except FileExistsError:
        pass
