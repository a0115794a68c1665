"""First arrivals in the state store, and tables that are refreshed by day."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import client, order, payload, restaurant
from marmita.jobs import run_update
from marmita.operators import gold, silver
from marmita.streaming.first_arrival import FirstArrival, content_order, entity_arrivals, new_firsts, thinned
from marmita.streaming.partitions import days_of, drop_days, replace_days
from marmita.tables import BRONZE_BATCHES


def at(day, hour=12):
    return f"2024-05-{day:02d}T{hour:02d}:00:00+00:00"


def files(house, table):
    """Data files per folder."""
    found = {}
    for file in Path(house.path(table)).rglob("*.parquet"):
        found.setdefault(next(p.name for p in file.parents if p.name.startswith("day=")), set()).add(file.name)
    return found


def changed(before, after):
    return {day.removeprefix("day=") for day in before | after if before.get(day) != after.get(day)}


class Kept:
    """A value of the state store."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_changes_of_a_key(spark):
    schema = T.StructType.fromDDL("k string, t long, name string")
    processor = FirstArrival(schema, {"one": [1, 2], "other": [2]})
    processor.first = Kept()
    step = lambda *rows: [tuple(r) for r in processor.handleInputRows(("one", "a"), iter([Row("a", *r) for r in rows]), None)]
    assert step((5, "x"), (4, "y"), (4, "z")) == [("a", 4, "y", 1)]
    assert step((4, "y"), (9, "a")) == []
    assert step((4, "b")) == [("a", 4, "y", -1), ("a", 4, "b", 1)]  # ties go by content
    assert step((None, "c"), (1, "d")) == [("a", 4, "b", -1), ("a", None, "c", 1)]  # nulls first, as in a sort
    assert step((None, None)) == [("a", None, "c", -1), ("a", None, None, 1)]


def test_thinned_keeps_the_earliest_of_a_batch_and_ties(spark):
    rows = [("t", "a", 2, 1, 0, "late"), ("t", "a", 1, 2, 0, "first"), ("t", "a", 1, 2, 0, "tie"), ("t", None, 1, 1, 0, "null"),
            ("t", None, None, 5, 0, "null time"), ("t", "b", 1, 1, 1, "b"), ("u", "a", 5, 5, 5, "of another table")]
    ddl = "table_name string, entity_key string, enqueued_time_utc long, sequence_number long, position int, name string"
    df = spark.createDataFrame(rows, ddl).coalesce(1)
    assert {r.name for r in thinned(df).collect()} == {"first", "tie", "null time", "b", "of another table"}
    assert thinned(df.limit(0)).count() == 0


def test_one_order_of_columns_sorts_every_entity():
    place = content_order().index
    for entity in silver.DEDUPLICATED:
        places = [place(name) for name in entity.names if name != entity.key]
        assert places == sorted(places), entity.table


def test_first_rows_need_no_python_worker(spark, batches):
    some = batches(payload("b1", clientes=[client(nome="b"), client(nome="a"), client("C2")])).withColumn("sequence_number", F.lit(1).cast("long"))
    first = new_firsts(entity_arrivals(some.unionByName(some)))
    assert sorted((r.entity_key, r.nome, r.takes_over) for r in first.filter("entity_key IS NOT NULL").collect()) == [("C1", "b", False), ("C2", "Ana", False)]
    assert first.filter("entity_key IS NULL").count() == 3
    assert "Python" not in first._jdf.queryExecution().executedPlan().toString()


def test_one_scan_has_the_rows_of_all_entities(spark, batches):
    some = batches(payload("b1", clientes=[client(), client("C2", CPF=5)], items=[]), "not json", None, payload("b2", drivers=[{"placa": "x"}]))
    some = some.withColumn("sequence_number", F.col("sequence_number").cast("long"))
    rows = entity_arrivals(some)
    for entity in silver.DEDUPLICATED:
        mine = rows.filter(F.col("table_name") == entity.table).select("entity_key", *silver.ARRIVAL, "batch_id", *entity.names)
        assert sorted(mine.drop("entity_key").collect(), key=str) == sorted(
            silver.arrivals(some, entity).select(*silver.ARRIVAL, "batch_id", *entity.names).collect(), key=str), entity.table
        assert mine.filter(~F.col("entity_key").eqNullSafe(F.col(entity.key))).count() == 0


def test_an_earlier_arrival_moves_the_row_to_its_day(spark, archive, tmp_path):
    """The key leaves the day it was in; days without changes keep their files."""
    root = str(tmp_path / "house")
    archive.add(payload("b1", clientes=[client("C1", nome="late"), client("C2")]), enqueued=at(20))
    archive.add(payload("b2", clientes=[client("C3", nome="alone")]), enqueued=at(21))
    archive.add(payload("b3", clientes=[client("C4")]), enqueued=at(22))
    house = run_update(spark, root, archive.folder)
    before = files(house, "silver_clientes")
    assert set(before) == {"day=2024-05-20", "day=2024-05-21", "day=2024-05-22"}
    archive.add(payload("b4", clientes=[client("C1", nome="early"), client("C3", nome="early too"), client("C4", nome="not first")]), enqueued=at(10))
    archive.add(payload("b5", clientes=[client("C4", nome="later still")]), enqueued=at(23))
    house = run_update(spark, root, archive.folder)
    after = files(house, "silver_clientes")
    assert set(after) == {"day=2024-05-10", "day=2024-05-20"}  # C3 and C4 were alone in their days
    names = {r.client_id: r.nome for r in house.read("silver_clientes").collect()}
    assert names == {"C1": "early", "C2": "Ana", "C3": "early too", "C4": "not first"}
    archive.add(payload("b6", clientes=[client("C5")]), enqueued=at(25))
    house = run_update(spark, root, archive.folder)
    assert changed(after, files(house, "silver_clientes")) == {"2024-05-25"}
    batch = silver.dimension(house.read(BRONZE_BATCHES), silver.CLIENTES)
    assert sorted(house.read("silver_clientes").drop("silver_processed_at").collect()) == sorted(batch.collect())


@pytest.mark.parametrize("per_trigger", ["1", "100"])
def test_rule_counts_follow_the_rows_in_the_table(spark, archive, tmp_path, per_trigger):
    """A row that is taken back is taken out of the counts."""
    for n in range(6, 0, -1):
        archive.add(payload(f"b{n}", clientes=[client("C1", CPF="1" if n > 1 else "2" * 11), client(None), client(f"C{n + 10}")]), enqueued=at(n))
    house = run_update(spark, str(tmp_path / "house"), archive.folder, source_options={"maxFilesPerTrigger": per_trigger})
    counts = house.progress["silver_clientes"]["rules"]
    assert (counts["rows"], counts["rows_kept"]) == (8, 7)
    assert house.read("silver_clientes").count() == 7


def test_a_hot_key_over_many_files(spark, archive, tmp_path):
    for n in range(12):
        archive.add(payload(f"b{n}", clientes=[client("C900", nome=f"n{n}-{i}") for i in range(200)] + [client(f"C{n}")]), enqueued=at(20 - n))
    house = run_update(spark, str(tmp_path / "house"), archive.folder)
    names = {r.client_id: r.nome for r in house.read("silver_clientes").collect()}
    assert names["C900"] == "n11-0" and len(names) == 13


def orders(*ids, day=1, merchant="R1", **more):
    return payload(f"b{ids}", orders=[order(i, MerchantID=merchant, created_at=at(day)) for i in ids], **more)


def same_as_full_refresh(house):
    for table, rows in (("gold_daily_delivery_kpis", gold.daily_kpis(house.read("silver_orders"))),
                        ("gold_restaurant_performance", gold.restaurant_performance(house.read("silver_orders"), house.read("silver_restaurantes")))):
        stored = house.read(table).drop("gold_processed_at", "day")
        assert sorted(stored.collect(), key=str) == sorted(rows.collect(), key=str), table


def test_a_late_order_rewrites_only_its_day(spark, archive, tmp_path):
    root = str(tmp_path / "house")
    for day in range(1, 9):
        archive.add(orders(f"P{day}", f"P1{day}", day=day, merchant=f"R{day % 3}"))
    house = run_update(spark, root, archive.folder, grain="day")
    tables = ("gold_daily_delivery_kpis", "gold_restaurant_performance")
    before = {t: files(house, t) for t in tables}
    assert all(len(b) == 8 for b in before.values())
    archive.add(orders("P99", day=3))
    house = run_update(spark, root, archive.folder, grain="day")
    for table in tables:
        assert changed(before[table], files(house, table)) == {"2024-05-03"}
    assert house.read("gold_daily_delivery_kpis").filter("metric_date = '2024-05-03'").first().total_orders == 3
    same_as_full_refresh(house)
    before = {t: files(house, t) for t in tables}
    house.update()
    assert all(not changed(before[t], files(house, t)) for t in tables)


def test_a_restaurant_that_changes_refreshes_its_days(spark, archive, tmp_path):
    root = str(tmp_path / "house")
    for day in range(1, 5):
        archive.add(orders(f"P{day}", day=day, merchant=f"R{day % 2}"), enqueued=at(20))
    house = run_update(spark, root, archive.folder, grain="day")
    before = files(house, "gold_restaurant_performance")
    archive.add(payload("r", restaurantes=[restaurant("R1", nome="New")]), enqueued=at(21))
    house = run_update(spark, root, archive.folder, grain="day")
    after = files(house, "gold_restaurant_performance")
    assert changed(before, after) == {"2024-05-01", "2024-05-03"}
    same_as_full_refresh(house)
    archive.add(payload("r2", restaurantes=[restaurant("R1", nome="Older")]), enqueued=at(19))
    house = run_update(spark, root, archive.folder, grain="day")
    assert {r.restaurant_name for r in house.read("gold_restaurant_performance").filter("restaurant_id = 'R1'").collect()} == {"Older"}
    same_as_full_refresh(house)


def test_replacing_and_dropping_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(r, "x int, day string").withColumn("day", F.col("day").cast("date"))
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    replace_days(rows((1, "2024-01-01"), (2, "2024-01-02"), (3, None)), path, [one, two, None])
    assert days_of(spark, path) == [one, two, None]
    replace_days(rows((4, "2024-01-02")), path, [two, None])
    assert days_of(spark, path) == [one, two]
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 4]
    replace_days(rows((9, "2024-01-01")).limit(0), path, [one])
    assert days_of(spark, path) == [two]
    drop_days(spark, path, [two, None])
    assert days_of(spark, path) == []
    replace_days(rows((1, "2024-01-01")), path, [])
    assert days_of(spark, path) == []
