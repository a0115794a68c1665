from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from marmita.operators import quality
from marmita.rules import RULES, load_rules

TYPES = {
    "preco": "decimal(10,2)", "valor_total": "decimal(10,2)", "valor_total_item": "decimal(10,2)",
    "quantidade": "int", "quantidade_total": "int", "created_at": "timestamp", "order_date": "date",
}
GOOD = {
    "bronze_delivery_batches": {"batch_id": "b"},
    "silver_clientes": {"client_id": "C1", "cpf": "12345678901", "tipo_pagamento": "CARTÃO DEBITO",
                        "created_at": "2024-01-01"},
    "silver_restaurantes": {"merchant_id": "R1", "cnpj": "12345678901234", "nome": "x", "created_at": "2024-01-01"},
    "silver_drivers": {"driver_id": "D1", "veiculo": "moto", "placa": "ABC-1234", "created_at": "2024-01-01"},
    "silver_items": {"item_id": "I1", "nome": "x", "categoria": "Bebida", "preco": "1", "merchant_id": "R1",
                     "created_at": "2024-01-01"},
    "silver_orders": {"order_id": "P1", "client_id": "C1", "merchant_id": "R1", "driver_id": "D1",
                      "valor_total": "1", "quantidade_total": "1", "tipo_pagamento": "VOUCHER",
                      "created_at": "2024-01-01", "order_date": "2024-01-01"},
    "silver_order_items": {"order_id": "P1", "item_id": "I1", "categoria": "Pizza", "preco": "1", "quantidade": "1",
                           "valor_total_item": "1", "created_at": "2024-01-01"},
}
# rule -> (column, a value that breaks the rule; None where only null can)
BREAKS = {
    "valid_json_payload": ("batch_id", None),
    "valid_client_id": ("client_id", None), "valid_client_id_format": ("client_id", "X1"),
    "valid_cpf": ("cpf", "1234567890"), "valid_client_payment_type": ("tipo_pagamento", "CHEQUE"),
    "valid_client_created_at": ("created_at", None),
    "valid_merchant_id": ("merchant_id", None), "valid_merchant_id_format": ("merchant_id", "R"),
    "valid_cnpj": ("cnpj", "123"), "valid_restaurant_name": ("nome", None),
    "valid_restaurant_created_at": ("created_at", None),
    "valid_driver_id": ("driver_id", None), "valid_driver_id_format": ("driver_id", "d1"),
    "valid_vehicle_type": ("veiculo", "patinete"), "valid_plate": ("placa", "abc-1234"),
    "valid_driver_created_at": ("created_at", None),
    "valid_item_id": ("item_id", None), "valid_item_id_format": ("item_id", "1"), "valid_item_name": ("nome", None),
    "valid_item_category": ("categoria", "Outros"), "valid_price": ("preco", "0"),
    "valid_item_merchant_id": ("merchant_id", "M1"), "valid_item_created_at": ("created_at", None),
    "valid_order_id": ("order_id", None), "valid_order_id_format": ("order_id", "P1a"),
    "valid_order_client_id": ("client_id", "1"), "valid_order_merchant_id": ("merchant_id", ""),
    "valid_order_driver_id": ("driver_id", "D"), "valid_order_amount": ("valor_total", "-1"),
    "valid_total_quantity": ("quantidade_total", "0"), "valid_order_payment_type": ("tipo_pagamento", "pix"),
    "valid_order_created_at": ("created_at", None), "valid_order_date": ("order_date", None),
    "valid_order_item": ("item_id", None), "valid_order_item_ids_format": ("item_id", "x"),
    "valid_order_item_category": ("categoria", "Pizzas"), "valid_order_item_price": ("preco", "-0.01"),
    "valid_item_quantity": ("quantidade", "0"), "valid_order_item_total": ("valor_total_item", "0"),
    "valid_order_item_created_at": ("created_at", None),
}


def rows_for(spark, table, *changes):
    """The good row of a table once per set of changes."""
    names = list(GOOD[table])
    data = [tuple((GOOD[table] | change)[n] for n in names) for change in changes]
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
    return df.select(*(F.col(n).cast(TYPES.get(n, "string")).alias(n) for n in names))


def test_forty_rules():
    assert sum(len(r) for r in RULES.values()) == 40
    assert set(BREAKS) == {name for rules in RULES.values() for name in rules}


@pytest.mark.parametrize("table", sorted(RULES))
def test_each_rule_passes_fails_and_counts_null_as_failed(spark, table):
    rules = RULES[table]
    cases = [{}]
    for name in rules:
        column, bad = BREAKS[name]
        cases.append({column: None})
        if bad is not None:
            cases.append({column: bad})
    marked = quality.with_failed_rules(rows_for(spark, table, *cases), rules).collect()
    assert marked[0].failed_rules == []
    at = 1
    for name in rules:
        column, bad = BREAKS[name]
        assert name in marked[at].failed_rules
        at += 1
        if bad is not None:
            assert name in marked[at].failed_rules
            at += 1
    kept = quality.keep_valid(rows_for(spark, table, *cases), rules).count()
    rejected = quality.quarantine(rows_for(spark, table, *cases), rules).count()
    assert kept == 1 and kept + rejected == len(cases)


def test_counts_per_rule(spark):
    df = rows_for(spark, "silver_drivers", {}, {"placa": "x"}, {"placa": None, "veiculo": "nave"})
    counts = {r.rule: (r.passed, r.failed) for r in quality.rule_counts(df, RULES["silver_drivers"]).collect()}
    assert counts["valid_plate"] == (1, 2) and counts["valid_vehicle_type"] == (2, 1)
    assert counts["valid_driver_id"] == (3, 0)


def test_counts_of_an_empty_table(spark):
    df = rows_for(spark, "silver_drivers", {}).filter("false")
    assert {(r.passed, r.failed) for r in quality.rule_counts(df, RULES["silver_drivers"]).collect()} == {(0, 0)}


def test_warn_keeps_rows_and_reports(spark):
    seen = Observation()
    df = rows_for(spark, "bronze_delivery_batches", {}, {"batch_id": None})
    assert len(quality.warn(df, RULES["bronze_delivery_batches"], seen).collect()) == 2
    assert seen.get == {"rows": 2, "valid_json_payload": 1, "rows_kept": 1}


def test_fail_mode(spark):
    rules = RULES["silver_drivers"]
    assert quality.fail_on_violation(rows_for(spark, "silver_drivers", {}), rules).count() == 1
    with pytest.raises(PySparkException, match="valid_plate"):
        quality.fail_on_violation(rows_for(spark, "silver_drivers", {}, {"placa": "x"}), rules).collect()


def test_rules_from_a_file(tmp_path):
    file = tmp_path / "rules.json"
    file.write_text('{"silver_drivers": {"any": "true"}}')
    rules = load_rules(str(file))
    assert rules["silver_drivers"] == {"any": "true"} and rules["silver_items"] == RULES["silver_items"]
