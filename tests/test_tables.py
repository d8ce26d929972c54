"""K07 / K01 on a bucketed id table: the target is not shuffled."""

from pyspark.sql import functions as F

from feedspark.operators import load, sinks


def test_bucketed_target_not_shuffled(spark, tmp_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sinks.create_id_table(spark, "ids_bucketed", location=tmp_dir + "/ids", buckets=8)
        first = spark.range(1000).select(F.col("id").cast("string").alias("id"))
        assert load.append_new_ids_to_table(first, "ids_bucketed") == 1000
        offered = spark.range(500, 1500).select(F.col("id").cast("string").alias("id"))
        plan = load.new_ids(offered, spark.table("ids_bucketed"))._jdf.queryExecution() \
            .executedPlan().toString()
        assert "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") == 1  # the offered side only
        assert load.append_new_ids_to_table(offered, "ids_bucketed") == 500
        assert load.append_new_ids_to_table(offered, "ids_bucketed") == 0  # idempotent
        assert spark.table("ids_bucketed").count() == 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS ids_bucketed")


def test_path_table_load_and_stamp(spark, tmp_dir):
    ids = spark.range(20).select(F.col("id").cast("string").alias("id"))
    path = tmp_dir + "/idtable"
    assert load.append_new_ids(ids.where(F.col("id") < 10), path) == 10
    assert load.append_new_ids(ids, path) == 10
    assert load.append_new_ids(ids, path) == 0
    assert spark.read.parquet(path).count() == 20
    d = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), ("b", 2, "z")], "id string, seq long, data string")
    rows = load.first_wins_new(d, spark.createDataFrame([("b",)], "id string"), "seq",
                               payload=["data"], stamp=True).collect()
    assert [(r["id"], r["data"]) for r in rows] == [("a", "y")] and rows[0]["ingested_at"] is not None


def test_estimated_count_paths(spark, tmp_dir):
    from feedspark.operators import reconcile
    spark.range(50).write.parquet(tmp_dir + "/est")
    spark.sql(f"CREATE TABLE est_t USING parquet LOCATION '{tmp_dir}/est'")
    try:
        exact = reconcile.estimated_count(spark, "est_t").first()
        assert (exact["n"], exact["method"]) == (50, "exact")
        est = reconcile.estimated_count(spark, "est_t", exact_below=10).first()
        assert (est["n"], est["method"]) == (50, "estimate")
    finally:
        spark.sql("DROP TABLE IF EXISTS est_t")


def test_gated_export_publishes_or_leaves_nothing(spark, tmp_dir):
    import os
    ids = spark.range(100).select((F.col("id") % 60).cast("string").alias("id"))
    assert sinks.gated_export(ids, tmp_dir + "/few", 61)["status"] == "refused_count"
    broken = ids.withColumn("id", F.when(F.col("id") == "7", "7\n7").otherwise(F.col("id")))
    res = sinks.gated_export(broken, tmp_dir + "/broken", 60)
    assert (res["exact"], res["exported"], res["status"]) == (60, 61, "refused_mismatch")
    res = sinks.gated_export(ids, tmp_dir + "/out", 60, file_bytes=40)
    assert (res["exact"], res["exported"], res["status"]) == (60, 60, "exported")
    assert sorted(os.listdir(tmp_dir)) == ["out"]
    out = spark.read.text(tmp_dir + "/out")
    assert out.count() == 60 and len(out.inputFiles()) >= 4          # some 15 lines a file
    try:
        sinks.gated_export(ids, tmp_dir + "/out", 60)
        raise AssertionError
    except FileExistsError:
        pass


def test_new_rows_are_rows_that_were_delivered(spark):
    rows = [("a", 1, "z"), ("a", 2, "b"), ("b", 5, "c"), (None, 1, "d"), ("k", 1, "e")]
    offered = spark.createDataFrame(rows, "id string, n long, t string")
    target = spark.createDataFrame([("k",)], "id string")
    got = sorted(tuple(r) for r in load.new_rows(offered, target, same_per_key=True).collect())
    assert got == [("a", 2, "b"), ("b", 5, "c")]


def test_checkpoint_metadata_and_times(spark):
    from feedspark.operators import progress
    log = spark.createDataFrame([(1, "a", "running", None, 9), (2, "b", "running", '{"x":1}', 5)],
                                "seq long, strategy string, status string, metadata string, updated_at long")
    state = progress.checkpoint_state(log)
    assert sorted((r["seq"], r["metadata"]) for r in state.collect()) == [(1, "{}"), (2, '{"x":1}')]
    assert progress.latest_open_checkpoint(state).first()["seq"] == 1
