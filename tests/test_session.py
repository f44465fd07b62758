from __future__ import annotations

from pyspark.sql import functions as F

from stratastar.session import SETTINGS, TEXT_SETTINGS, dealt, tune


def _held(df):
    return {r["task"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()}


def test_rows_of_a_large_row_group_are_dealt_out(spark, tmp_path):
    """Many scan tasks, but one holds every row; a third of the rows has one key."""
    rows = spark.range(0, 40000, 1, 1)
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.floor(F.col("id") / 2))
    rows.select("id", key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("pad")).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        table = spark.read.parquet(str(tmp_path / "t"))
        assert table.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert max(_held(dealt(table)).values()) == 40000
        out = dealt(table, [F.col("key")], task_rows=4000)
        assert max(_held(out).values()) < 4000 * 3
        assert out.columns == table.columns
        assert out.exceptAll(table).isEmpty() and table.exceptAll(out).isEmpty()
        # Versions of a key that are among neighbouring rows stay in one task.
        tasks = out.where("key <> -1").select("key", F.floor(F.col("id") / 4000).alias("run"), F.spark_partition_id().alias("task"))
        assert tasks.groupBy("key", "run").agg(F.count_distinct("task").alias("n")).where("n > 1").isEmpty()
        assert "__piece" not in dealt(table, [F.col("key")], task_rows=40000)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_hot_key_is_split_before_its_sort_fills_a_task(spark):
    """Keys of a few statuses come as partitions of 64 to 256 MB, ten times that when sorted."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        assert [tune(spark).conf.get(k) for k in names] == [SETTINGS[k] for k in names] == ["32m", "64m"]
        assert [tune(spark, TEXT_SETTINGS).conf.get(k) for k in names] == ["128m", "256m"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_versions_stay_together_when_dealt_to_idle_cores(spark, tmp_path):
    """A file of one row group: its rows go to all cores, versions of a key to the same one."""
    spark.range(20000).select("id", F.floor(F.col("id") / 2).alias("key")).coalesce(1).write.parquet(str(tmp_path / "t"))
    out = dealt(spark.read.parquet(str(tmp_path / "t")), [F.col("key")], task_rows=None)
    tasks = out.select("key", F.spark_partition_id().alias("task"))
    assert tasks.groupBy("key").agg(F.count_distinct("task").alias("n")).where("n > 1").isEmpty()
    assert len(_held(out)) == spark.sparkContext.defaultParallelism
    assert out.count() == 20000 and out.columns == ["id", "key"]


def test_partitions_follow_the_given_tables(spark, tmp_path, monkeypatch):
    """Sorted rows of a window cannot be split by adaptive execution, so larger tables get more shuffle partitions."""
    from stratastar import session

    spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("pad")).write.parquet(str(tmp_path / "in" / "t.parquet"))
    held = session.stored_bytes(spark, str(tmp_path / "in"))
    monkeypatch.setattr(session, "INPUT_OF_PARTITION", held // 40)
    name, least = session.PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert int(tune(spark, folder=str(tmp_path / "in")).conf.get(name)) == held // (held // 40) >= 40
        monkeypatch.setattr(session, "INPUT_OF_PARTITION", held)
        assert int(tune(spark, folder=str(tmp_path / "in")).conf.get(name)) == least
    finally:
        assert tune(spark, TEXT_SETTINGS).conf.get(name, None) is None
        tune(spark)
