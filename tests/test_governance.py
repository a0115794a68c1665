from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import client, driver, order, payload
from marmita.functions.masks import initial_only, last_four, last_four_strict
from marmita.operators import governance, integrity, silver


def test_masks(spark):
    df = spark.createDataFrame([("Ana", "12345678901"), (None, None), ("Z", "abc"), ("", "1234")], "a string, b string")
    rows = df.select(initial_only(F.col("a")), last_four(F.col("b")), last_four_strict(F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [
        ("A***", "***8901", "***8901"), (None, None, None), ("Z***", "***abc", "***"), ("***", "***1234", "***")]


def test_views_leave_out_what_they_should(batches):
    source = batches(payload(clientes=[client()], drivers=[driver()]))
    view = governance.governed("vw_clientes_analyst", silver.dimension(source, silver.CLIENTES))
    assert view.columns == ["client_id", "nome", "cpf_mascarado", "tipo_pagamento", "created_at"]
    row = governance.governed("vw_drivers_analyst", silver.dimension(source, silver.DRIVERS)).first()
    assert (row.nome, row.placa_mascarada) == ("D***", "***-1234")


def test_view_masks_of_null_and_short_names(batches):
    source = batches(payload(clientes=[client(nome=None), client("C2", nome="Z")]))
    shown = governance.governed("vw_clientes_analyst", silver.dimension(source, silver.CLIENTES)).collect()
    assert {r.client_id: r.nome for r in shown} == {"C1": None, "C2": "Z***"}


def test_every_tagged_text_column_is_masked(batches, tmp_path, spark):
    tagged = governance.tag_columns(
        silver.dimension(batches(payload(clientes=[client()])), silver.CLIENTES), "silver_clientes")
    tagged.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert governance.classification_of(stored) == {"nome": "PII", "endereco": "PII", "cpf": "PII_HIGH"}
    row = governance.mask_by_tag(stored).first()
    assert (row.client_id, row.nome, row.endereco, row.cpf) == ("C1", "A***", "R***", "***8901")


def test_nested_and_unknown_classes_are_hidden(batches):
    source = governance.tag_columns(batches(payload(clientes=[client()])), "bronze_delivery_batches")
    row = governance.mask_by_tag(source).first()
    assert row.tables is None and "Ana" not in row.body_json and row.batch_id == "b1"
    odd = source.withMetadata("batch_id", {"classification": "SECRET"})
    assert governance.mask_by_tag(odd).first().batch_id == "***"


def test_untagged_frames_and_tables_are_refused(batches, spark, tmp_path):
    plain = silver.dimension(batches(payload(clientes=[client()])), silver.CLIENTES)
    with pytest.raises(ValueError):
        governance.mask_by_tag(plain)
    spark.sql(f"CREATE SCHEMA bare LOCATION '{tmp_path}/bare'")
    plain.write.saveAsTable("bare.silver_clientes")
    with pytest.raises(ValueError):
        governance.mask_table(spark, "bare.silver_clientes")
    governance.tag_table(spark, "bare.silver_clientes", "silver_clientes")
    row = governance.mask_table(spark, "bare.silver_clientes").first()
    assert (row.client_id, row.nome, row.cpf) == ("C1", "A***", "***8901")
    spark.sql("DROP SCHEMA bare CASCADE")


def test_pseudonyms_need_the_secret(batches):
    orders = governance.tag_columns(silver.orders(batches(payload(orders=[order()]))), "silver_orders")
    shown = {s: governance.mask_by_tag(orders, governance.analyst_masks(s)).first().client_id for s in (None, "a", "b")}
    assert shown[None] == "***" and len(set(shown.values())) == 3 and len(shown["a"]) == 64


def test_orphans_are_counted_by_key_and_row(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",)], "k string")
    rows = {r.missing_key: r.rows for r in integrity.orphans(child, "fk", parent, "k").collect()}
    assert rows == {"b": 2, None: 1}
