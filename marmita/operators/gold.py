"""Gold: business metrics recomputed from the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marmita.functions.casts import utc_day

MONEY = "decimal(18,2)"


def _money(value: Column, name: str) -> Column:
    return value.cast(MONEY).alias(name)


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("gold_processed_at", F.current_timestamp())


def daily_kpis(orders: DataFrame) -> DataFrame:
    """Per day and payment type.

    The distinct counts shuffle on (group, id), not on the group, so a day that
    holds a third of all orders still spreads over all tasks.
    """
    return orders.groupBy(utc_day(F.col("created_at")).alias("metric_date"), "tipo_pagamento").agg(
        *(F.count_distinct(F.col(source)).alias(name) for name, source in (
            ("total_orders", "order_id"),
            ("unique_clients", "client_id"),
            ("unique_restaurants", "merchant_id"),
            ("unique_drivers", "driver_id"),
        )),
        F.sum("quantidade_total").alias("total_items"),
        _money(F.sum("valor_total"), "total_revenue"),
        _money(F.avg("valor_total"), "avg_order_value"),
    )


def restaurant_performance(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Per day and restaurant, with the restaurant's name where it is known.

    ``restaurants`` has one row per merchant_id (its table is deduplicated on
    it), so the name may be joined on after the aggregation: the join then
    carries one row per day and restaurant instead of every order, and a
    restaurant with a third of all orders causes no skewed join.
    """
    measured = orders.groupBy(
        utc_day(F.col("created_at")).alias("order_date"), F.col("merchant_id").alias("restaurant_id"),
    ).agg(
        F.count_distinct(F.col("order_id")).alias("total_orders"),
        F.count_distinct(F.col("client_id")).alias("unique_clients"),
        _money(F.sum("valor_total"), "total_revenue"),
        _money(F.avg("valor_total"), "avg_order_value"),
    )
    names = restaurants.select(
        F.col("merchant_id").alias("restaurant_id"), F.col("nome").alias("restaurant_name"))
    return measured.join(names, "restaurant_id", "left").select(
        "order_date", "restaurant_id", "restaurant_name",
        "total_orders", "unique_clients", "total_revenue", "avg_order_value",
    )


def item_category_metrics(order_items: DataFrame) -> DataFrame:
    """Per menu category; the price average is per product line, not per unit."""
    return order_items.groupBy("categoria").agg(
        F.count_distinct(F.col("order_id")).alias("orders_with_category"),
        F.count_distinct(F.col("item_id")).alias("unique_items"),
        F.sum("quantidade").alias("total_quantity"),
        _money(F.sum("valor_total_item"), "total_revenue"),
        _money(F.avg("preco"), "avg_item_price"),
    )
