from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import STAMP, client, driver, item, order, payload, restaurant
from marmita.jobs import run_governance, run_live_maintenance, run_update
from marmita.operators import silver
from marmita.operators.maintenance import settings
from marmita.schemas import batches_ddl
from marmita.streaming import runner
from marmita.streaming.runner import Lakehouse, rejected
from marmita.tables import BRONZE_BATCHES, BRONZE_RAW, GOLD_TABLES, SCHEMAS

ONE_FILE = {"source_options": {"maxFilesPerTrigger": "1"}}


def whole(n=0):
    return payload(f"b{n}", clientes=[client(f"C{n}")], restaurantes=[restaurant(f"R{n}")],
                   drivers=[driver(f"D{n}")], items=[item(f"I{n}")],
                   orders=[order(f"P{n}", ClientID=f"C{n}", MerchantID=f"R{n}")])


def counts(house):
    return {t: house.read(t).count() for t in (*SCHEMAS, *GOLD_TABLES)}


def test_update_rerun_and_late_files(spark, archive, tmp_path):
    archive.add(whole(0), whole(1))
    house = run_update(spark, str(tmp_path / "house"), archive.folder)
    first = counts(house)
    assert set(first.values()) == {2, 1}
    assert house.progress[BRONZE_BATCHES]["rules"] == {"rows": 2, "valid_json_payload": 2, "rows_kept": 2}

    house.update()
    assert counts(house) == first
    assert all(p["rows_read"] == 0 for p in house.progress.values())

    archive.add(whole(2), "{bad", None)
    again = run_update(spark, str(tmp_path / "house"), archive.folder)
    after = counts(again)
    assert after[BRONZE_RAW] == after[BRONZE_BATCHES] == 5
    assert after["silver_orders"] == after["silver_clientes"] == 3
    assert again.progress[BRONZE_BATCHES]["rules"] == {"rows": 3, "valid_json_payload": 1, "rows_kept": 1}
    revenue = again.read("gold_daily_delivery_kpis").agg({"total_revenue": "sum"}).first()[0]
    assert revenue == 3 * 61


def test_split_arrival_equals_single_arrival(spark, archive, tmp_path):
    archive.add(whole(0)).add(whole(1)).add(whole(2))
    together = run_update(spark, str(tmp_path / "a"), archive.folder)
    one_by_one = run_update(spark, str(tmp_path / "b"), archive.folder, **ONE_FILE)
    for table in SCHEMAS:
        if table.startswith("silver"):
            left, right = (h.read(table).drop("silver_processed_at") for h in (together, one_by_one))
            assert sorted(left.collect()) == sorted(right.collect()), table


def test_documents_of_a_day_are_written_by_one_task(spark, archive, tmp_path):
    """However many files the events come in, a day gets a file; undated and broken documents are all there too."""
    for n in range(5):
        archive.add(*(whole(10 * n + d).replace(STAMP, f"2024-05-0{d + 1}T12:00:00+00:00", 1) for d in range(4)), "{bad", None)
    house = Lakehouse(spark, str(tmp_path / "house"), archive.folder)
    house.update_bronze()
    stored = house.read(BRONZE_BATCHES)
    assert stored.count() == stored.select("sequence_number").distinct().count() == 30
    per_day = {p.name: len([*p.glob("*.parquet")]) for p in (tmp_path / "house/tables" / BRONZE_BATCHES).glob("day=*")}
    assert len(per_day) == 5 and set(per_day.values()) == {1}
    assert house.progress[BRONZE_BATCHES]["rules"] == {"rows": 30, "valid_json_payload": 20, "rows_kept": 20}
    assert all(f.name.endswith(".zstd.parquet") for t in (BRONZE_RAW, BRONZE_BATCHES) for f in (tmp_path / "house/tables" / t).rglob("*.parquet"))


@pytest.mark.parametrize("dedup, stream", [("arrival", "entities"), ("state", "silver_drivers")])
def test_a_state_has_as_many_partitions_as_the_cores_ask_for(spark, archive, tmp_path, dedup, stream):
    """Each partition is a store that every micro-batch commits: two hundred of them cost an update more than its rows."""
    archive.add(whole(0), whole(1))
    changelog = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    with settings(spark, **{"spark.sql.shuffle.partitions": "200", changelog: "false"}):
        house = Lakehouse(spark, str(tmp_path / "house"), archive.folder, dedup=dedup)
        house.update_bronze()
        house.run("silver_drivers")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200" and spark.conf.get(changelog) == "false"
    state = tmp_path / "house/checkpoints" / stream / "state/0"
    assert len([p for p in state.iterdir() if p.name.isdigit()]) == min(200, runner.TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    assert [*state.rglob("*.changelog")] and house.read("silver_drivers").count() == 2


@pytest.mark.parametrize("dedup", ["arrival", "state"])
@pytest.mark.parametrize("validate_first, kept", [(False, 0), (True, 1)])
def test_bad_first_file_claims_the_key(spark, archive, tmp_path, dedup, validate_first, kept):
    house = Lakehouse(spark, str(tmp_path / "house"), archive.folder, dedup=dedup, validate_first=validate_first)
    for n, cpf in enumerate(("1", "12345678901", "12345678901")):
        archive.add(payload(f"b{n}", clientes=[client(CPF=cpf)]))
        house.update_bronze()
        house.run("silver_clientes")
    assert house.read("silver_clientes").count() == kept


def test_arrival_order_decides_within_one_micro_batch(spark, archive, tmp_path):
    for n in range(6):
        archive.add(payload(f"b{n}", clientes=[client(nome=f"n{n}"), client("C2", CPF="1" if n == 0 else "2" * 11)]))
    house = Lakehouse(spark, str(tmp_path / "house"), archive.folder)
    house.update_bronze()
    house.run("silver_clientes")
    assert [r.nome for r in house.read("silver_clientes").collect()] == ["n0"]
    assert house.progress["silver_clientes"]["rules"]["rows"] == 2
    assert house.progress["silver_clientes"]["rules"]["rows_kept"] == 1


def test_a_repeated_micro_batch_changes_nothing(spark, archive, tmp_path):
    """As after a crash between writing a micro-batch and noting it as done."""
    house = Lakehouse(spark, str(tmp_path / "house"), archive.folder)
    for n in range(3):
        archive.add(payload(f"b{n}", clientes=[client(f"C{n}"), client("C0", nome=f"n{n}")]))
        house.update_bronze()
        house.run("silver_clientes")
    before = sorted(house.read("silver_clientes").drop("silver_processed_at").collect())
    for note in (tmp_path / "house" / "checkpoints" / "entities" / "commits").glob("*2*"):
        note.unlink()
    for note in (tmp_path / "house" / "checkpoints" / "entities" / "commits").glob(".*2*"):
        note.unlink()
    again = Lakehouse(spark, str(tmp_path / "house"), archive.folder)
    again.run("silver_clientes")
    assert again.progress["silver_clientes"]["rules"] == {}
    assert sorted(again.read("silver_clientes").drop("silver_processed_at").collect()) == before


def test_first_arrival_does_not_depend_on_the_split(spark, archive, tmp_path):
    """Files come against the order of arrival: later micro-batches hold the earlier rows."""
    for n in range(9, 0, -1):
        stamp = f"2024-05-01T12:{n % 4:02d}:00+00:00"
        archive.next = n % 3  # as from several bus partitions, where numbers are equal
        archive.add(payload(f"b{n}", clientes=[client(nome=f"n{n}"), client(f"C{n}"), client("C0", CPF="1" * (n % 2) or "2" * 11)]),
                    enqueued=stamp)
    one = run_update(spark, str(tmp_path / "one"), archive.folder)
    split = run_update(spark, str(tmp_path / "split"), archive.folder, **ONE_FILE)
    step = Lakehouse(spark, str(tmp_path / "step"), str(tmp_path / "part"))
    files = sorted((tmp_path / "archive").glob("*.parquet"), key=lambda f: f.stat().st_mtime)
    (tmp_path / "part").mkdir()
    for file in files:
        (tmp_path / "part" / file.name).write_bytes(file.read_bytes())
        step.update()
    want = sorted(silver.dimension(one.read(BRONZE_BATCHES), silver.CLIENTES).collect())
    for house in (one, split, step):
        assert sorted(house.read("silver_clientes").drop("silver_processed_at").collect()) == want
    changes = spark.read.parquet(step.changes)
    assert changes.filter("change = -1").count() > 0
    assert step.progress["silver_clientes"]["rules"]["rows"] <= 3


def test_a_settling_that_broke_off_is_repeated(spark, archive, tmp_path, monkeypatch):
    archive.add(payload("b1", clientes=[client(nome="first")]))
    root = str(tmp_path / "house")
    run_update(spark, root, archive.folder)
    archive.add(payload("b2", clientes=[client(nome="later"), client("C2", nome="new")]))
    with monkeypatch.context() as patch:
        patch.setattr(runner, "replace_days", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            run_update(spark, root, archive.folder)
    again = run_update(spark, root, archive.folder)
    assert sorted(r.nome for r in again.read("silver_clientes").collect()) == ["first", "new"]


def test_maintenance_between_updates(spark, archive, tmp_path):
    archive.add(whole(0)).add(whole(1))
    house = run_update(spark, str(tmp_path / "house"), archive.folder, **ONE_FILE)
    spark.sql(f"CREATE SCHEMA live LOCATION '{tmp_path}/live'")
    house.register("live")
    for n in (2, 3):
        house.read("silver_clientes").withColumn("day", F.lit("2024-05-01")).repartition(2, "client_id").write.mode(
            "overwrite").partitionBy("day").parquet(str(tmp_path / "split"))
        folder = tmp_path / "house" / "tables" / "silver_clientes" / "day=2024-05-01"
        for file in [*folder.iterdir()]:
            file.unlink()
        for file in (tmp_path / "split" / "day=2024-05-01").glob("*.parquet"):
            (folder / file.name).write_bytes(file.read_bytes())
        assert "silver_clientes" in run_live_maintenance(house, "live")
        assert len([*folder.glob("*.parquet")]) == 1 and run_live_maintenance(house, "live") == []
        archive.add(whole(n))
        house = run_update(spark, str(tmp_path / "house"), archive.folder)
        house.register("live")
        for table in (*SCHEMAS, *GOLD_TABLES):
            assert spark.table(f"live.{table}").count() == house.read(table).count(), table
        assert house.read("silver_clientes").count() == n + 1
    with pytest.raises(ValueError):
        house.compact("silver_orders")
    spark.sql("DROP SCHEMA live CASCADE")


def test_unknown_dedup_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        Lakehouse(spark, str(tmp_path), "x", dedup="never")
    with pytest.raises(ValueError):
        Lakehouse(spark, str(tmp_path), "x", dedup="state", keep_rejected=True)


@pytest.mark.parametrize("dedup", ["arrival", "state"])
def test_claim_outlives_the_update(spark, archive, tmp_path, dedup):
    archive.add(payload("b1", clientes=[client(nome="first")]))
    root = str(tmp_path / "house")
    run_update(spark, root, archive.folder, dedup=dedup)
    archive.add(payload("b2", clientes=[client(nome="later"), client("C2", nome="new")]))
    house = run_update(spark, root, archive.folder, dedup=dedup)
    assert {r.nome for r in house.read("silver_clientes").collect()} == {"first", "new"}


def test_stream_equals_batch_per_table(spark, archive, tmp_path):
    for n in range(4):
        archive.add(whole(n % 3), payload(f"x{n}", clientes=[client("C0", nome=f"n{n}")]))
    house = run_update(spark, str(tmp_path / "house"), archive.folder, **ONE_FILE)
    batches = house.read(BRONZE_BATCHES)
    for entity in silver.DEDUPLICATED:
        streamed = house.read(entity.table).drop("silver_processed_at").collect()
        assert sorted(streamed) == sorted(silver.dimension(batches, entity).collect()), entity.table
    orders = silver.orders(batches)
    assert house.read("silver_orders").drop("silver_processed_at").count() == orders.count() == 4


def test_redelivered_orders_option(spark, archive, tmp_path):
    archive.add(payload("b1", orders=[order(), order()])).add(payload("b2", orders=[order()]))
    kept = run_update(spark, str(tmp_path / "a"), archive.folder)
    assert kept.read("silver_orders").count() == 3
    once = run_update(spark, str(tmp_path / "b"), archive.folder, dedup_orders=True)
    assert once.read("silver_orders").count() == 1


def test_kept_and_rejected_make_the_whole(spark, archive, tmp_path):
    archive.add(payload("b1", clientes=[client(), client("C2", CPF="1", tipo_pagamento="CHEQUE")],
                        orders=[order(), order("P2", valor_total=0)]))
    house = run_update(spark, str(tmp_path / "house"), archive.folder, keep_rejected=True)
    refused = house.read(rejected("silver_clientes")).collect()
    assert [(r.client_id, r.failed_rules) for r in refused] == [("C2", ["valid_cpf", "valid_client_payment_type"])]
    assert house.read("silver_clientes").count() == 1
    refused = house.read(rejected("silver_orders")).collect()
    assert [(r.order_id, r.failed_rules) for r in refused] == [("P2", ["valid_order_amount"])]
    assert house.read(rejected("silver_order_items")).count() == 0


def test_backfill_in_several_micro_batches(spark, archive, tmp_path):
    for n in range(4):
        archive.add(whole(n), payload(f"x{n}", clientes=[client("C0", nome=f"n{n}")]))
    house = run_update(spark, str(tmp_path / "house"), archive.folder, batch_bytes=5000)
    assert len([*(tmp_path / "house" / "checkpoints" / "entities" / "commits").glob("[0-9]*")]) > 1
    streamed = house.read("silver_clientes").drop("silver_processed_at").collect()
    assert sorted(streamed) == sorted(silver.dimension(house.read(BRONZE_BATCHES), silver.CLIENTES).collect())


def test_micro_batches_do_not_multiply_from_table_to_table(spark, archive, tmp_path):
    """A table with many folders is followed by micro-batches as it was written, not file by file."""
    for n in range(3):
        archive.add(*(payload(f"b{n}{d}", orders=[order(f"P{n}{d}", created_at=f"2024-{d:02d}-01T12:00:00+00:00")]).replace(
            '"ingestion_ts": "2024-05-01', f'"ingestion_ts": "2024-05-{d:02d}') for d in range(1, 9)))
    house = Lakehouse(spark, str(tmp_path / "house"), archive.folder, source_options={"maxFilesPerTrigger": "1"}, batch_bytes=1)
    house.update_bronze()
    house.run("silver_orders")
    house.run("silver_order_items")
    ran = {t: len([*(tmp_path / "house" / "checkpoints" / t / "commits").glob("[0-9]*")]) for t in (BRONZE_RAW, "silver_orders", "silver_order_items")}
    assert ran[BRONZE_RAW] == 3 and all(2 <= n <= 6 for n in ran.values()), ran  # 24 files of orders by day, 24 by month
    assert house.read("silver_order_items").count() == 24


@pytest.mark.parametrize("dedup", ["arrival", "state"])
def test_bounded_dedup_state(spark, archive, tmp_path, dedup):
    archive.add(payload("b1", clientes=[client(), client()])).add(payload("b2", clientes=[client(), client("C2")]))
    house = run_update(spark, str(tmp_path / "house"), archive.folder, dedup=dedup, dedup_horizon="7 days")
    assert house.read("silver_clientes").count() == 2


def test_only_the_wanted_entity_is_read(spark, archive, tmp_path):
    archive.add(whole())
    house = run_update(spark, str(tmp_path / "house"), archive.folder)
    narrow = silver.entity_rows(house.read(BRONZE_BATCHES, batches_ddl(silver.DRIVERS.keep)), silver.DRIVERS)
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "drivers" in plan and "clientes:" not in plan and "body_json" not in plan


def test_tables_views_and_tags_in_the_catalog(spark, archive, tmp_path):
    archive.add(whole(0))
    house = run_update(spark, str(tmp_path / "house"), archive.folder)
    spark.sql(f"CREATE SCHEMA shop LOCATION '{tmp_path}/shop'")
    spark.sql(f"CREATE SCHEMA shop_views LOCATION '{tmp_path}/views'")
    house.register("shop")
    views = run_governance(spark, "shop", "shop_views")
    assert spark.table("shop_views.vw_clientes_analyst").first().asDict() == {
        "client_id": "C0", "nome": "A***", "cpf_mascarado": "***8901", "tipo_pagamento": "PIX",
        "created_at": house.read("silver_clientes").first().created_at}
    assert spark.table("shop_views.vw_drivers_analyst").first().placa_mascarada == "***-1234"
    assert len(views) == 4 and all(spark.table(f"shop_views.{v}").count() == 1 for v in views)
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES shop.silver_clientes").collect()}
    assert properties["classification"] == "restricted"
