from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from conftest import client, order, payload
from marmita.functions.casts import bus_timestamp
from marmita.operators.bronze import parse_batches
from marmita.sources.capture import capture_rows, path_attributes, read_capture


def test_unparsable_and_missing_bodies_keep_their_row(batches):
    rows = batches("{oops", None, payload("b3")).orderBy("sequence_number").collect()
    assert [r.batch_id for r in rows] == [None, None, "b3"]
    assert rows[0].tables is None and rows[1].tables is None
    assert rows[0].body_json == "{oops"


def test_one_bad_leaf_leaves_the_rest(batches):
    row = batches(payload(orders=[order(valor_total="x", quantidade_total=3)])).first()
    found = row.tables.orders[0]
    assert (found.valor_total, found.quantidade_total, found.PedidoID) == (None, 3.0, "P1")


def test_unknown_keys_are_ignored_and_missing_ones_null(batches):
    body = json.dumps({"batch_id": "b", "extra": 1, "tables": {"clientes": [{"ClientID": "C1", "x": 2}]}})
    row = batches(body).first()
    assert row.source_system is None and row.tables.clientes[0].nome is None and row.tables.orders is None


def test_header_time_with_offset_gives_utc_day(batches):
    body = json.dumps({"batch_id": "b", "ingestion_ts": "2024-05-01T23:30:00-03:00"})
    row = batches(body).first()
    assert str(row.event_date) == "2024-05-02"
    bad = batches(json.dumps({"batch_id": "b", "ingestion_ts": "yesterday"})).first()
    assert bad.source_ingestion_ts is None and bad.event_date is None


def test_narrowed_parse_gives_the_same_entities(spark, batches):
    bodies = [payload(clientes=[client()], orders=[order()]), "{bad", payload(orders=[])]
    full = batches(*bodies).select("batch_id", "tables.orders.PedidoID", "tables.orders.valor_total")
    raw = spark.createDataFrame(list(enumerate(bodies)), "sequence_number BIGINT, body_json STRING")
    narrow = parse_batches(raw, {"orders": ["PedidoID", "valor_total"]})
    assert [f.name for f in narrow.schema["tables"].dataType] == ["orders"]
    assert narrow.select("batch_id", "tables.orders.PedidoID", "tables.orders.valor_total").collect() == full.collect()
    assert "tables" not in parse_batches(raw, {}).columns


def test_enqueue_time_in_both_forms(spark):
    df = spark.createDataFrame([("2026-12-03T15:40:12",), ("12/3/2026 3:40:12 PM",), ("soon",)], "t string")
    found = [r[0] for r in df.select(bus_timestamp(F.col("t"))).collect()]
    assert found[:2] == [datetime(2026, 12, 3, 15, 40, 12)] * 2 and found[2] is None


def test_accents_survive_and_lineage_is_kept(spark, archive):
    archive.add(payload(clientes=[client(nome="Conceição", tipo_pagamento="CARTÃO CREDITO")]), sub="ns/hub/0")
    archive.add(None, sub="ns/hub/1")
    raw = capture_rows(read_capture(spark, archive.folder))
    rows = raw.orderBy("sequence_number").collect()
    assert "Conceição" in rows[0].body_json and "CARTÃO CREDITO" in rows[0].body_json
    assert rows[1].body_json is None
    assert "/ns/hub/0/" in rows[0].source_file and rows[0].source_file_modification_time is not None
    assert raw.columns == [
        "sequence_number", "eventhub_offset", "enqueued_time_utc", "system_properties", "event_properties",
        "body_json", "source_file", "source_file_modification_time", "bronze_ingestion_time", "ingestion_date"]


def test_capture_path_attributes(spark):
    df = spark.createDataFrame([("file:/x/ns/hub/1/2024/02/29/23/59/58.avro",), ("/other/part-0.parquet",),
                                ("ns/hub/1/2024/13/29/23/59/58",)], "p string")
    rows = df.select(*(c.alias(n) for n, c in path_attributes(F.col("p")).items())).collect()
    assert tuple(rows[0]) == ("ns", "hub", 1, datetime(2024, 2, 29, 23, 59, 58))
    assert tuple(rows[1]) == (None,) * 4
    assert rows[2].captured_at is None
