from __future__ import annotations

import json

from pyspark.sql import functions as F

from marmita.operators import silver
from marmita.operators.bronze import parse_batches
from marmita.sources import generator
from marmita.sources.generator import Volume


def ticks(spark, n):
    return spark.range(n).select("id", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("at"))


def documents(spark, n, volume=Volume()):
    batches = generator.generate(ticks(spark, n), "id", F.col("at"), volume)
    return [json.loads(r.body_json) for r in batches.orderBy("tick").collect()]


def test_default_batch(spark):
    for doc in documents(spark, 20):
        tables = doc["tables"]
        assert {k: len(v) for k, v in tables.items()} == {
            "clientes": 1, "restaurantes": 1, "items": 8, "drivers": 1, "orders": 8}
        prices = {i["ItemID"]: i["preco"] for i in tables["items"]}
        assert len(prices) == 8 and all(10 <= p <= 120 for p in prices.values())
        for o in tables["orders"]:
            ids = [p["ItemID"] for p in o["Produtos"]]
            assert 2 <= len(ids) <= 4 and len(set(ids)) == len(ids) and set(ids) <= set(prices)
            assert o["ClientID"] == tables["clientes"][0]["ClientID"]
            assert o["tipo_pagamento"] == tables["clientes"][0]["tipo_pagamento"]
            assert all(p["preco"] == prices[p["ItemID"]] and 1 <= p["quantidade"] <= 3 for p in o["Produtos"])
            assert o["valor_total"] == round(sum(p["valor_total_item"] for p in o["Produtos"]), 2)
            assert o["quantidade_total"] == sum(p["quantidade"] for p in o["Produtos"])


def test_orders_take_items_of_their_own_restaurant(spark):
    volume = Volume(clients=3, restaurants=3, drivers=2, items_per_restaurant=3, orders=20)
    for doc in documents(spark, 5, volume):
        menu = {i["ItemID"]: i["MerchantID"] for i in doc["tables"]["items"]}
        assert len(menu) == 9 and {len([1 for m in menu.values() if m == r["MerchantID"]])
                                   for r in doc["tables"]["restaurantes"]} == {3}
        for o in doc["tables"]["orders"]:
            assert 2 <= len(o["Produtos"]) <= 3
            assert {menu[p["ItemID"]] for p in o["Produtos"]} == {o["MerchantID"]}


def test_empty_menu_and_no_orders(spark):
    doc, = documents(spark, 1, Volume(items_per_restaurant=0, orders=1))
    assert doc["tables"]["items"] == [] and doc["tables"]["orders"][0]["Produtos"] == []
    doc, = documents(spark, 1, Volume(orders=0))
    assert doc["tables"]["orders"] == []


def test_values_do_not_depend_on_partitioning(spark):
    one, many = (generator.generate(ticks(spark, 30).repartition(p), "id", F.col("at")) for p in (1, 7))
    assert sorted(one.select("body_json").collect()) == sorted(many.select("body_json").collect())
    other = generator.generate(ticks(spark, 30), "id", F.col("at"), Volume(seed=1))
    assert sorted(other.select("body_json").collect()) != sorted(one.select("body_json").collect())


def test_generated_entities_pass_every_rule(spark):
    events = generator.envelopes(generator.generate(ticks(spark, 50), "id", F.col("at")))
    batches = parse_batches(events.select(
        F.col("SequenceNumber").alias("sequence_number"), F.col("Body").cast("string").alias("body_json")))
    assert silver.orders(batches).count() == 400
    for entity, n in ((silver.CLIENTES, 50), (silver.RESTAURANTES, 50), (silver.DRIVERS, 50), (silver.ITEMS, 400)):
        assert silver.dimension(batches, entity).count() == n
    assert silver.order_items(silver.orders(batches)).count() == silver.order_item_rows(silver.orders(batches)).count()


def test_envelope_properties(spark):
    row = generator.envelopes(generator.generate(ticks(spark, 1), "id", F.col("at"))).first()
    body = json.loads(bytes(row.Body).decode("utf-8"))
    assert row.Properties == {"event_type": "delivery_fake_batch", "schema_version": "1.0",
                              "batch_id": body["batch_id"]}
