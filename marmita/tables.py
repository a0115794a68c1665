"""Stored tables: order of refresh and schemas, so a stream can start before its input exists."""

from __future__ import annotations

from marmita.schemas import ITEM_FIELDS, tables_ddl

_PRODUCTS = "ARRAY<STRUCT<" + ", ".join(f"`{n}`: {t}" for n, t in ITEM_FIELDS.items()) + ">>"
_LINEAGE = "sequence_number BIGINT, eventhub_offset STRING, enqueued_time_utc TIMESTAMP"
_FILE = "source_file STRING, source_file_modification_time TIMESTAMP"
_INGESTION = "bronze_ingestion_time TIMESTAMP, ingestion_date DATE"
_SILVER = "silver_processed_at TIMESTAMP"

BRONZE_RAW = "bronze_eventhub_capture_raw"
BRONZE_BATCHES = "bronze_delivery_batches"

SCHEMAS = {
    BRONZE_RAW:
        f"{_LINEAGE}, system_properties MAP<STRING, STRING>, event_properties MAP<STRING, STRING>, "
        f"body_json STRING, {_FILE}, {_INGESTION}",
    BRONZE_BATCHES:
        f"{_LINEAGE}, {_FILE}, {_INGESTION}, batch_id STRING, source_ingestion_ts TIMESTAMP, event_date DATE, "
        f"source_system STRING, schema_version STRING, tables {tables_ddl()}, body_json STRING",
    "silver_clientes":
        "batch_id STRING, client_id STRING, nome STRING, endereco STRING, cpf STRING, tipo_pagamento STRING, "
        f"created_at TIMESTAMP, {_SILVER}",
    "silver_restaurantes":
        "batch_id STRING, merchant_id STRING, nome STRING, endereco STRING, cnpj STRING, "
        f"created_at TIMESTAMP, {_SILVER}",
    "silver_drivers":
        "batch_id STRING, driver_id STRING, nome STRING, endereco STRING, veiculo STRING, placa STRING, "
        f"created_at TIMESTAMP, {_SILVER}",
    "silver_items":
        "batch_id STRING, item_id STRING, nome STRING, categoria STRING, preco DECIMAL(10,2), "
        f"merchant_id STRING, created_at TIMESTAMP, {_SILVER}",
    "silver_orders":
        "batch_id STRING, order_id STRING, client_id STRING, merchant_id STRING, restaurant_id STRING, "
        "driver_id STRING, quantidade_total INT, valor_total DECIMAL(10,2), tipo_pagamento STRING, "
        f"created_at TIMESTAMP, order_date DATE, produtos {_PRODUCTS}, order_year INT, order_month INT, "
        f"order_day INT, order_hour INT, amount_category STRING, {_SILVER}",
    "silver_order_items":
        "batch_id STRING, order_id STRING, item_id STRING, nome STRING, categoria STRING, preco DECIMAL(10,2), "
        f"quantidade INT, valor_total_item DECIMAL(10,2), created_at TIMESTAMP, {_SILVER}",
}
GOLD_TABLES = ("gold_daily_delivery_kpis", "gold_restaurant_performance", "gold_item_category_metrics")
COST_TABLES = ("azure_cost_by_resource_daily", "azure_cost_summary_daily")
