from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from marmita.jobs import run_maintenance
from marmita.operators import maintenance


def files(folder):
    return sorted(Path(folder).glob("*.parquet"))


def test_compaction_keeps_rows_and_restores_settings(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.range(1000).repartition(25).write.parquet(str(tmp_path / "small"))
    result = maintenance.compact(spark, str(tmp_path / "small"), str(tmp_path / "big"))
    assert len(files(tmp_path / "small")) == 25 and len(files(tmp_path / "big")) == 1
    assert result.agg(F.count("id"), F.sum("id")).first()[:] == (1000, 499500)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert maintenance.file_stats(spark.read.parquet(str(tmp_path / "small"))).first().files == 25


def test_compaction_does_not_shuffle(spark, tmp_path):
    spark.range(10).repartition(5).write.parquet(str(tmp_path / "small"))
    df = spark.read.parquet(str(tmp_path / "small"))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_maintenance_job_switches_tables(spark, tmp_path):
    spark.range(100).repartition(10).write.parquet(str(tmp_path / "t"))
    spark.sql(f"CREATE TABLE small_files USING parquet LOCATION '{tmp_path}/t'")
    moved = run_maintenance(spark, {"small_files": str(tmp_path / "t")}, str(tmp_path / "new"))
    assert spark.table("small_files").count() == 100
    assert moved["small_files"] in spark.table("small_files").inputFiles()[0]
    spark.sql("DROP TABLE small_files")


def test_clustered_table_is_rewritten_in_key_order(spark, tmp_path):
    spark.range(500).select(
        F.expr("date_add(DATE'2024-01-01', cast(id * 7 % 50 as int))").alias("metric_date"), "id",
    ).repartition(20).write.parquet(str(tmp_path / "t"))
    spark.sql(f"CREATE TABLE gold_daily_delivery_kpis USING parquet LOCATION '{tmp_path}/t'")
    for _ in range(2):  # a second run writes a folder of its own
        moved = run_maintenance(spark, {"gold_daily_delivery_kpis": str(tmp_path / "t")}, str(tmp_path / "new"))
    days = [r.metric_date for r in spark.table("gold_daily_delivery_kpis").collect()]
    assert len(files(moved["gold_daily_delivery_kpis"])) == 1
    assert len(days) == 500 and days == sorted(days)
    spark.sql("DROP TABLE gold_daily_delivery_kpis")


def test_clustering_sorts_and_spreads_a_hot_key(spark, tmp_path):
    df = spark.range(9000).select(
        F.expr("if(id % 3 = 0, 'hot', cast(id % 50 as string))").alias("k"), "id")
    maintenance.clustered(df, ("k",), files=9).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    per_file = stored.groupBy("_metadata.file_name").agg(
        F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo", "hi").collect()
    assert sum(r.n for r in per_file) == 9000
    assert max(r.n for r in per_file) < 2000
    assert all(a.hi <= b.lo for a, b in zip(per_file, per_file[1:]))


def test_retention(spark):
    today = date(2024, 12, 31)
    days = [today - timedelta(days=n) for n in (0, 89, 90, 91, 200)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    kept = {layer: maintenance.retained(df, layer, "d", today).count() for layer in ("bronze", "silver", "gold")}
    assert kept == {"bronze": 4, "silver": 5, "gold": 6}


def test_row_counts(spark):
    counts = maintenance.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert {(r.table_name, r.rows) for r in counts} == {("a", 3), ("b", 0)}
