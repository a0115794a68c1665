"""Micro-batches that are refused, and counts that are stored as the streams report them."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException

from conftest import client, order, payload
from marmita.operators.quality import rule_counts
from marmita.operators.silver import order_rows
from marmita.streaming.history import RuleHistory, rule_history, rule_totals
from marmita.streaming.runner import Lakehouse
from marmita.tables import BRONZE_BATCHES

POSITIVE = {"silver_orders": {"positive": "valor_total > 0"}}


def test_a_refused_micro_batch_leaves_no_row(spark, archive, tmp_path):
    root = str(tmp_path / "house")
    archive.add(payload("b1", orders=[order("P1")]))
    house = Lakehouse(spark, root, archive.folder, refuse=POSITIVE)
    house.update_bronze()
    house.run("silver_orders")
    archive.add(payload("b2", orders=[order("P2"), order("P3", valor_total=-1), order("P4")]))
    for _ in range(2):
        house = Lakehouse(spark, root, archive.folder, refuse=POSITIVE)
        house.update_bronze()
        with pytest.raises(StreamingQueryException, match="positive"):
            house.run("silver_orders")
        assert [r.order_id for r in house.read("silver_orders").collect()] == ["P1"]
    archive.add(payload("b3", orders=[order("P5")]))
    mended = Lakehouse(spark, root, archive.folder, refuse={"silver_orders": {"known": "valor_total IS NOT NULL"}})
    mended.update_bronze()
    mended.run("silver_orders")
    assert sorted(r.order_id for r in mended.read("silver_orders").collect()) == ["P1", "P2", "P4", "P5"]


def test_entities_are_refused_by_their_own_rules(spark, archive, tmp_path):
    root, rules = str(tmp_path / "house"), {"silver_clientes": {"named": "nome IS NOT NULL"}}
    archive.add(payload("b1", clientes=[client("C1"), client("C2", nome=None)]))
    house = Lakehouse(spark, root, archive.folder, refuse=rules)
    house.update_bronze()
    with pytest.raises(StreamingQueryException, match="refused"):
        house.run("silver_clientes")
    mended = Lakehouse(spark, root, archive.folder)
    mended.run("silver_clientes")
    assert sorted(r.client_id for r in mended.read("silver_clientes").collect()) == ["C1", "C2"]


def test_counts_of_many_micro_batches(spark, archive, tmp_path):
    """More micro-batches than a query keeps reports of."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for n in range(25):
            archive.add(payload(f"b{n}", orders=[order(f"P{n}", valor_total=n % 3), order(f"P{n}", quantidade_total=None)]), *(["bad"] * (n % 2)))
        house = Lakehouse(spark, str(tmp_path / "house"), archive.folder, source_options={"maxFilesPerTrigger": "1"}, batch_bytes=1)
        house.update_bronze()
        house.run("silver_orders")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    stored = rule_history(spark, house.history.path)
    assert stored.filter("table_name = 'silver_orders' AND rule IS NULL").count() > 20
    totals = {(r.rule, r.passed, r.failed) for r in rule_totals(stored).filter("table_name = 'silver_orders'").collect()}
    batch = rule_counts(order_rows(house.read(BRONZE_BATCHES)), house.rules["silver_orders"])
    assert totals == {(r.rule, r.passed, r.failed) for r in batch.collect()}
    assert house.progress["silver_orders"]["rules"]["rows"] == 62  # a row of nulls for each bad body


def test_a_micro_batch_that_ran_twice_counts_once(spark, tmp_path):
    history = RuleHistory(spark, str(tmp_path / "rules"))
    history.expect("t", "q")
    history.add("q", "id", 0, 3, {"rows": 3, "rows_kept": 2, "rule": 2})
    history.flush()
    history.add("q", "id", 0, 3, {"rows": 3, "rows_kept": 2, "rule": 2})
    history.add("q", "id", 1, 1, {"rows": 1, "rows_kept": 1, "rule": 1})
    history.flush()
    history.flush()
    assert [tuple(r) for r in rule_totals(rule_history(spark, history.path)).collect()] == [("t", "rule", 3, 1)]
