"""The feed that the registered queries share."""

from __future__ import annotations

import time
from pathlib import Path

from conftest import client, order, payload, restaurant
from marmita.plans.workspace import Workspace
from marmita.session import let_go
from marmita.sources.feed import feed
from marmita.streaming.runner import Lakehouse

SF = "/root/testdata/sf0.001"


def test_the_feed_is_stored_small_and_without_a_sort(spark, monkeypatch):
    """Sorting the documents by their folder is what spilled: with a writer per arrival no task sorts."""
    limits = []
    build = feed
    monkeypatch.setattr("marmita.plans.workspace.feed.feed", lambda *a: build(*a).filter("SequenceNumber % 8 < 4"))
    write = type(spark.range(1).write).parquet
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lambda self, *a, **k: (
        limits.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")), write(self, *a, **k))[1])
    ws = Workspace(spark, SF)
    files = [*Path(ws.landing).rglob("*.parquet")]
    assert limits == ["2"] and {f.parent.name for f in files} == {"arrival=0", "arrival=1"}
    assert all(f.name.endswith(".zstd.parquet") for f in files)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    stored = spark.read.parquet(ws.landing)
    assert stored.filter("arrival <> SequenceNumber div 8 % 2").count() == 0
    assert stored.count() == build(spark, SF).filter("SequenceNumber % 8 < 4").count()


def test_documents_are_written_and_parsed_by_small_tasks(spark, monkeypatch, tmp_path):
    """A task's share of the feed is small, as it grows many times when it becomes documents; the caller's settings come back."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(n) for n in names]
    seen = []
    write = type(spark.range(1).write).parquet
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lambda self, *a, **k: (
        seen.append([spark.conf.get(n) for n in names]), write(self, *a, **k))[1])
    ws = Workspace(spark, SF)
    assert ws.batches().count() == ws.raw().count()
    for arrival in (0, 1):
        ws.deliver(arrival, str(tmp_path / "files"))
    assert seen == [["8m", before[1]], [before[0], "16m"], [before[0], "16m"], [before[0], "16m"]]
    assert [spark.conf.get(n) for n in names] == before
    delivered = spark.read.parquet(str(tmp_path / "files"))
    assert delivered.columns == ws.spark.read.parquet(ws.landing).drop("arrival").columns
    assert delivered.select("SequenceNumber").distinct().count() == delivered.count() == ws.raw().count()


def shuffled(spark):
    """Names of the shuffle files that Spark keeps."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_of_finished_steps_are_deleted(spark, tmp_path):
    before = shuffled(spark)
    spark.range(1000).repartition(5).write.parquet(str(tmp_path / "dealt"))
    for _ in range(10):  # Spark deletes them in a thread of its own
        let_go(spark)
        if not shuffled(spark) - before:
            break
    assert not shuffled(spark) - before


def test_the_feed_and_every_run_let_go_of_their_shuffles(spark, archive, tmp_path, monkeypatch):
    steps = []
    monkeypatch.setattr("marmita.plans.workspace.let_go", lambda _: steps.append("feed"))
    monkeypatch.setattr("marmita.streaming.runner.let_go", lambda _: steps.append("run"))
    assert Workspace(spark, SF).landing and steps == ["feed"]
    archive.add(payload(clientes=[client()], restaurantes=[restaurant()], orders=[order()]))
    Lakehouse(spark, str(tmp_path / "house"), archive.folder).update_bronze()
    assert steps == ["feed", "run", "run"]
