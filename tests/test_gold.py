from __future__ import annotations

from decimal import Decimal

from conftest import line, order, payload, restaurant
from marmita.operators import gold, silver


def test_redelivery_doubles_sums_not_counts(batches):
    df = silver.orders(batches(payload("b1", orders=[order()]), payload("b2", orders=[order()])))
    row, = gold.daily_kpis(df).collect()
    assert (row.total_orders, row.total_items, row.total_revenue) == (1, 4, Decimal("122.00"))
    assert (row.unique_clients, row.unique_restaurants, row.unique_drivers) == (1, 1, 1)


def test_average_is_rounded_to_six_places_then_two(batches):
    df = silver.orders(batches(payload(orders=[order("P1", valor_total=0.01), order("P2", valor_total=0.02)])))
    assert gold.daily_kpis(df).first().avg_order_value == Decimal("0.02")


def test_order_of_unknown_restaurant_has_no_name(batches):
    source = batches(payload(
        restaurantes=[restaurant(), restaurant("R2", nome=None)],
        orders=[order(), order("P2", MerchantID="R2"), order("P3", MerchantID="R9")]))
    result = gold.restaurant_performance(
        silver.orders(source), silver.dimension(source, silver.RESTAURANTES)).collect()
    assert {r.restaurant_id: r.restaurant_name for r in result} == {"R1": "Cantina", "R2": None, "R9": None}
    assert all(r.total_orders == 1 for r in result)


def test_category_metrics_average_lines_not_units(batches):
    products = [line("I1", preco=10, quantidade=3, valor_total_item=30), line("I2", preco=20, quantidade=1,
                                                                             valor_total_item=20)]
    items = silver.order_items(silver.orders(batches(payload(orders=[order(Produtos=products)]))))
    row, = gold.item_category_metrics(items).collect()
    assert (row.categoria, row.orders_with_category, row.unique_items, row.total_quantity) == ("Pizza", 1, 2, 4)
    assert (row.total_revenue, row.avg_item_price) == (Decimal("50.00"), Decimal("15.00"))


def test_gold_revenue_is_silver_revenue(batches):
    orders = silver.orders(batches(payload(orders=[order(f"P{i}", valor_total=10.1 * i + 1) for i in range(20)])))
    silver_sum = orders.agg({"valor_total": "sum"}).first()[0]
    assert gold.daily_kpis(orders).agg({"total_revenue": "sum"}).first()[0] == silver_sum
