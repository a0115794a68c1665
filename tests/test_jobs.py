from __future__ import annotations

import json
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marmita import __main__ as cli
from conftest import client, order, payload
from marmita.jobs import EXPIRES, run_generate, run_retention, run_update
from marmita.operators import maintenance
from marmita.session import shared_folder
from marmita.sources.generator import Volume
from marmita.streaming.partitions import days_of


def test_generate_then_update(spark, tmp_path):
    archive, root = str(tmp_path / "in"), str(tmp_path / "house")
    run_generate(spark, archive, 30, volume=Volume(orders=4))
    run_generate(spark, archive, 10, first=30, volume=Volume(orders=4))
    house = run_update(spark, root, archive)
    assert house.read("silver_orders").count() == 160
    assert house.read("silver_clientes").count() == 40
    kpis = house.read("gold_daily_delivery_kpis").agg(F.sum("total_orders"), F.sum("total_revenue")).first()
    assert kpis[0] == 160 and kpis[1] == house.read("silver_orders").agg(F.sum("valor_total")).first()[0]


def test_json_archive(spark, tmp_path):
    run_generate(spark, str(tmp_path / "in"), 5, fmt="json")
    house = run_update(spark, str(tmp_path / "house"), str(tmp_path / "in"), source_format="json")
    assert house.read("silver_orders").count() == 40


def test_stored_dimension_can_be_compacted_and_trimmed(spark, tmp_path):
    run_generate(spark, str(tmp_path / "in"), 5)
    house = run_update(spark, str(tmp_path / "house"), str(tmp_path / "in"))
    compacted = maintenance.compact(spark, house.path("silver_items"), str(tmp_path / "compact"))
    assert compacted.count() == 40
    trimmed = maintenance.rewrite_retained(
        spark, house.path("silver_orders"), str(tmp_path / "trim"), "silver", "order_date", "2024-12-31")
    assert trimmed.count() == 0 and "order_id" in trimmed.columns


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    cli.main(["generate", "--target", str(tmp_path / "in"), "--batches", "3", "--orders", "2"])
    cli.main(["update", "--source", str(tmp_path / "in"), "--root", str(tmp_path / "house"), "--max-files", "2"])
    assert "silver_orders" in capsys.readouterr().out
    cli.main(["compact", "--root", str(tmp_path / "house")])
    assert "[" in capsys.readouterr().out
    cli.main(["retention", "--root", str(tmp_path / "house"), "--as-of", "2099-01-02"])
    assert "datetime.date(2024, 1, 1)" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["update"])


def files(house, table):
    return {str(f) for f in Path(house.path(table)).rglob("*.parquet")}


def test_retention_removes_whole_days_and_streams_go_on(spark, archive, tmp_path):
    """Days go as folders, kept files stay as they are, and a later update adds to what is left."""
    for n, day in enumerate(("2024-01-10", "2024-03-01", "2024-05-01")):
        at = f"{day}T12:00:00+00:00"
        body = json.loads(payload(f"b{n}", clientes=[client(f"C{n}")], orders=[order(f"P{n}", created_at=at)]))
        archive.add(json.dumps(body | {"ingestion_ts": at}), enqueued=at)
    house = run_update(spark, str(tmp_path / "house"), archive.folder, grain="day")
    assert days_of(spark, house.path("silver_orders")) == [date(2024, 1, 10), date(2024, 3, 1), date(2024, 5, 1)]
    before = {t: files(house, t) for t in EXPIRES}
    dropped = run_retention(house, "2024-09-01")
    assert dropped["bronze_delivery_batches"] == [date(2024, 1, 10), date(2024, 3, 1), date(2024, 5, 1)]
    assert dropped["silver_orders"] == [date(2024, 1, 10), date(2024, 3, 1)]
    assert dropped["gold_daily_delivery_kpis"] == dropped["gold_restaurant_performance"] == []
    for table in EXPIRES:
        assert files(house, table) <= before[table]
    assert [r.order_id for r in house.read("silver_orders").collect()] == ["P2"]
    assert house.read("bronze_delivery_batches").count() == 0
    assert house.read("gold_daily_delivery_kpis").count() == 3

    archive.add(payload("late", orders=[order("P9", created_at="2024-05-01T15:00:00+00:00")]))
    house = run_update(spark, str(tmp_path / "house"), archive.folder, grain="day")
    assert {r.order_id for r in house.read("silver_orders").collect()} == {"P2", "P9"}
    kpis = {r.metric_date.isoformat(): r.total_orders for r in house.read("gold_daily_delivery_kpis").collect()}
    assert kpis == {"2024-01-10": 1, "2024-03-01": 1, "2024-05-01": 2}
    assert run_retention(house, "2024-09-01")["silver_orders"] == []


def test_retention_of_what_cannot_be_dated(spark, archive, tmp_path):
    """Bodies without a day expire by the day they arrived."""
    archive.add("not json", None, payload("b1", clientes=[client()]))
    house = run_update(spark, str(tmp_path / "house"), archive.folder)
    run_retention(house, "2024-05-02")
    assert house.read("bronze_delivery_batches").count() == 3
    run_retention(house, "2024-12-31")
    assert house.read("bronze_delivery_batches").count() == 2
    run_retention(house, "2099-01-01")
    assert house.read("bronze_delivery_batches").count() == 0


def session_with(master, **conf):
    get = lambda key, default=None: conf.get(key.replace(".", "_"), default)
    context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=get))
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=context)


def test_shared_folder_comes_from_the_session():
    session = session_with("spark://x", spark_checkpoint_dir="hdfs://cluster/shared/")
    first, second = shared_folder(session), shared_folder(session)
    assert first.startswith("hdfs://cluster/shared/marmita-") and first != second


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_with("spark://x"))
    assert shared_folder(session_with("local[2]"))
