from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from conftest import client, item, line, order, payload
from marmita.operators import silver


def test_missing_and_empty_arrays_give_one_null_row(batches):
    df = batches(payload("b1"), payload("b2", clientes=[]))
    rows = silver.entity_rows(df, silver.CLIENTES).collect()
    assert [(r.batch_id, r.client_id) for r in rows] == [("b1", None), ("b2", None)]
    assert silver.dimension(df, silver.CLIENTES).count() == 0


@pytest.mark.parametrize("validate_first, names", [(False, []), (True, ["later"])])
def test_bad_first_record_claims_its_key(batches, validate_first, names):
    df = batches(payload("b1", clientes=[client(CPF="1")]), payload("b2", clientes=[client(nome="later")]))
    assert [r.nome for r in silver.dimension(df, silver.CLIENTES, validate_first).collect()] == names


def test_first_arrival_wins_across_and_within_batches(batches):
    df = batches(
        payload("b1", clientes=[client(nome="first"), client(nome="same batch")]),
        payload("b2", clientes=[client(nome="later"), client("C2", nome="other")]))
    found = {r.client_id: r.nome for r in silver.dimension(df, silver.CLIENTES).collect()}
    assert found == {"C1": "first", "C2": "other"}


@pytest.mark.parametrize("amount, category, stored", [
    (99.99, "Low", "99.99"), (100, "Medium", "100.00"), (199.99, "Medium", "199.99"),
    (199.999, "Medium", "200.00"), (200, "High", "200.00"),
])
def test_bucket_uses_the_unrounded_amount(batches, amount, category, stored):
    row = silver.orders(batches(payload(orders=[order(valor_total=amount)]))).first()
    assert (row.amount_category, row.valor_total) == (category, Decimal(stored))


@pytest.mark.parametrize("amount", [0, -1, None, 1e9])
def test_amounts_that_are_dropped(batches, amount):
    assert silver.orders(batches(payload(orders=[order(valor_total=amount)]))).count() == 0


def test_null_amount_is_low(batches):
    assert silver.order_rows(batches(payload(orders=[order(valor_total=None)]))).first().amount_category == "Low"


def test_order_columns_and_values(batches):
    row = silver.orders(batches(payload(orders=[order(quantidade_total=2.9, created_at="2024-05-01T23:30:00-03:00")]))).first()
    assert row.asDict().keys() == set(silver.ORDER_COLUMNS)
    assert row.quantidade_total == 2
    assert row.created_at == datetime(2024, 5, 2, 2, 30) and row.order_date == date(2024, 5, 2)
    assert (row.order_year, row.order_month, row.order_day, row.order_hour) == (2024, 5, 2, 2)
    assert row.restaurant_id == row.merchant_id == "R1"


def test_bad_time_is_dropped_not_fatal(batches):
    df = batches(payload(orders=[order(created_at="31/12/1998 10:00"), order("P2")]))
    assert [r.order_id for r in silver.orders(df).collect()] == ["P2"]


def test_redelivered_orders_stay_unless_asked(batches):
    df = batches(payload("b1", orders=[order()]), payload("b2", orders=[order()]))
    assert silver.orders(df).count() == 2
    assert silver.orders(df, dedup_orders=True).count() == 1


def test_first_delivery_of_an_order_wins(batches):
    df = batches(payload("b1", orders=[order(valor_total=5), order(valor_total=6)]), payload("b2", orders=[order()]))
    row, = silver.orders(df, dedup_orders=True).collect()
    assert (row.batch_id, row.valor_total) == ("b1", Decimal("5.00"))
    assert tuple(row.asDict()) == silver.ORDER_COLUMNS


def test_order_items(batches):
    bad = line("I2", preco=1e9)
    df = silver.orders(batches(payload(orders=[order(Produtos=[line(), bad, line("I3", quantidade=0)]),
                                               order("P2", Produtos=[])])))
    assert silver.order_item_rows(df).count() == 4
    row, = silver.order_items(df).collect()
    assert (row.order_id, row.item_id, row.preco, row.quantidade) == ("P1", "I1", Decimal("30.50"), 2)


def test_items_of_dropped_orders_do_not_appear(batches):
    df = silver.orders(batches(payload(orders=[order(tipo_pagamento="CHEQUE")])))
    assert silver.order_items(df).count() == 0


def test_own_rules(batches):
    df = batches(payload(items=[item(preco=5), item("I2", preco=50)]))
    assert [r.item_id for r in silver.dimension(df, silver.ITEMS, rules={"dear": "preco > 10"}).collect()] == ["I2"]


def test_thinning_keeps_the_first_row_per_key_and_chunk(spark):
    rows = [("a", 1), (None, 2), ("a", 3), ("b", 4), (None, 5)]
    df = spark.createDataFrame(rows, "k string, n int").coalesce(1)
    assert [r.n for r in silver.first_of_each_chunk(df, "k").collect()] == [1, 2, 4]
    empty = spark.createDataFrame([], "k string, n int")
    assert silver.first_of_each_chunk(empty, "k").count() == 0


def test_hot_key_is_limited_before_the_shuffle(batches):
    plan = silver.first_arrivals(batches(payload()), silver.CLIENTES)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
