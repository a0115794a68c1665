"""Silver: entity tables unnested from parsed batches.

Each table is described by data: where its rows sit in the document, which
fields it takes with which type, its dedup key and its rules.  The same
description builds the batch and the streaming form.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marmita.functions.casts import utc_day
from marmita.operators.quality import Rules, keep_valid
from marmita.rules import RULES

MONEY = "decimal(10,2)"


@dataclass(frozen=True)
class Entity:
    """How one silver table is taken out of the ``tables`` struct."""

    table: str
    array: str
    columns: tuple[tuple[str, str, str], ...]  # (column, document field, type)
    key: str | None = None
    rules: Rules = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [name for name, _, _ in self.columns]

    @property
    def keep(self) -> dict[str, list[str]]:
        """The document fields this table needs, for narrowing reads and parses."""
        return {self.array: [source for _, source, _ in self.columns]}


CLIENTES = Entity("silver_clientes", "clientes", (
    ("client_id", "ClientID", "string"),
    ("nome", "nome", "string"),
    ("endereco", "endereco", "string"),
    ("cpf", "CPF", "string"),
    ("tipo_pagamento", "tipo_pagamento", "string"),
    ("created_at", "created_at", "timestamp"),
), "client_id", RULES["silver_clientes"])

RESTAURANTES = Entity("silver_restaurantes", "restaurantes", (
    ("merchant_id", "MerchantID", "string"),
    ("nome", "nome", "string"),
    ("endereco", "endereco", "string"),
    ("cnpj", "CNPJ", "string"),
    ("created_at", "created_at", "timestamp"),
), "merchant_id", RULES["silver_restaurantes"])

DRIVERS = Entity("silver_drivers", "drivers", (
    ("driver_id", "DriversID", "string"),
    ("nome", "nome", "string"),
    ("endereco", "endereco", "string"),
    ("veiculo", "veiculo", "string"),
    ("placa", "placa", "string"),
    ("created_at", "created_at", "timestamp"),
), "driver_id", RULES["silver_drivers"])

ITEMS = Entity("silver_items", "items", (
    ("item_id", "ItemID", "string"),
    ("nome", "nome", "string"),
    ("categoria", "categoria", "string"),
    ("preco", "preco", MONEY),
    ("merchant_id", "MerchantID", "string"),
    ("created_at", "created_at", "timestamp"),
), "item_id", RULES["silver_items"])

ORDERS = Entity("silver_orders", "orders", (
    ("order_id", "PedidoID", "string"),
    ("client_id", "ClientID", "string"),
    ("merchant_id", "MerchantID", "string"),
    ("driver_id", "DriversID", "string"),
    ("quantidade_total", "quantidade_total", "int"),
    ("valor_total", "valor_total", MONEY),
    ("tipo_pagamento", "tipo_pagamento", "string"),
    ("created_at", "created_at", "timestamp"),
    ("produtos", "Produtos", ""),
), None, RULES["silver_orders"])

ORDER_ITEMS = Entity("silver_order_items", "produtos", (
    ("item_id", "ItemID", "string"),
    ("nome", "nome", "string"),
    ("categoria", "categoria", "string"),
    ("preco", "preco", MONEY),
    ("quantidade", "quantidade", "int"),
    ("valor_total_item", "valor_total_item", MONEY),
    ("created_at", "created_at", "timestamp"),
), None, RULES["silver_order_items"])

# What decides which of two rows came first.  Sequence numbers count per bus
# partition, so the time of arrival at the bus comes first.
ARRIVAL = ("enqueued_time_utc", "sequence_number", "position")
ARRIVAL_DDL = "enqueued_time_utc TIMESTAMP, sequence_number BIGINT, position INT"

DEDUPLICATED = (CLIENTES, RESTAURANTES, DRIVERS, ITEMS)

# Column order of the order table; some are derived after the typed fields.
ORDER_COLUMNS = (
    "batch_id", "order_id", "client_id", "merchant_id", "restaurant_id", "driver_id",
    "quantidade_total", "valor_total", "tipo_pagamento", "created_at", "order_date", "produtos",
    "order_year", "order_month", "order_day", "order_hour", "amount_category",
)

# Lower bounds and names of the order amount buckets.
AMOUNT_BUCKETS = ((200, "High"), (100, "Medium"))
LOWEST_BUCKET = "Low"


def _typed(record: str, entity: Entity) -> list[Column]:
    """The entity's columns out of a struct column, bad values becoming null."""
    return [
        (F.col(f"{record}.{source}").try_cast(kind) if kind else F.col(f"{record}.{source}")).alias(name)
        for name, source, kind in entity.columns
    ]


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("silver_processed_at", F.current_timestamp())


def amount_category(amount: Column) -> Column:
    """Bucket of the unrounded amount; null falls into the lowest."""
    bucket = F
    for bound, name in AMOUNT_BUCKETS:
        bucket = bucket.when(amount >= bound, name)
    return bucket.otherwise(LOWEST_BUCKET)


def date_parts(ts: Column) -> dict[str, Column]:
    return {
        "order_date": utc_day(ts),
        "order_year": F.year(ts),
        "order_month": F.month(ts),
        "order_day": F.dayofmonth(ts),
        "order_hour": F.hour(ts),
    }


def entity_rows(batches: DataFrame, entity: Entity) -> DataFrame:
    """Unnested, typed rows before dedup and rules.

    A missing or empty array gives one row of nulls, which the not-null rules
    count and drop.
    """
    return (
        batches.select("batch_id", F.explode_outer(f"tables.{entity.array}").alias("record"))
        .select("batch_id", *_typed("record", entity))
    )


def _bus_arrival(batches: DataFrame) -> list[Column]:
    """Time at the bus and sequence number; parsed documents that never met a bus may lack the time."""
    known = "enqueued_time_utc" in batches.columns
    time = F.col("enqueued_time_utc") if known else F.lit(None).cast("timestamp").alias("enqueued_time_utc")
    return [time, F.col("sequence_number")]


def earliest(rows: DataFrame, key: str) -> DataFrame:
    """The earliest of all rows with a key, with its arrival.

    Arrival is (time at the bus, sequence number, position in the document); rows that still tie
    are ordered by content, so the result does not depend on task timing.  Spark
    plans ``row_number() = 1`` with a per-task limit ahead of the shuffle: a key
    that fills a third of the input sends one row per task.
    """
    content = [c for c in rows.columns if c not in (key, *ARRIVAL)]
    order = Window.partitionBy(key).orderBy(*ARRIVAL, *content)
    return rows.withColumn("arrival", F.row_number().over(order)).filter("arrival = 1").drop("arrival")


def _first(rows: DataFrame, key: str) -> DataFrame:
    return earliest(rows, key).drop(*ARRIVAL)


def arrivals(batches: DataFrame, entity: Entity, validate_first: bool = False, rules: Rules | None = None) -> DataFrame:
    """All rows of an entity with their arrival, or the valid ones with ``validate_first``."""
    rows = batches.select(
        *_bus_arrival(batches), "batch_id",
        F.posexplode_outer(f"tables.{entity.array}").alias("position", "record"),
    ).select(*ARRIVAL, "batch_id", *_typed("record", entity))
    return keep_valid(rows, entity.rules if rules is None else rules) if validate_first else rows


def claims(batches: DataFrame, entity: Entity, validate_first: bool = False,
           rules: Rules | None = None) -> DataFrame:
    """The first arrival of each key of an entity, with its arrival: before the rules, or after them with ``validate_first``."""
    return earliest(arrivals(batches, entity, validate_first, rules), entity.key)


def first_arrivals(batches: DataFrame, entity: Entity, validate_first: bool = False,
                   rules: Rules | None = None) -> DataFrame:
    """Batch dedup of an entity before its rules, or after them with ``validate_first``."""
    return claims(batches, entity, validate_first, rules).drop(*ARRIVAL)


def first_of_each_chunk(df: DataFrame, key: str) -> DataFrame:
    """Thin out repeated keys before a shuffle, keeping the first row of each Arrow batch.

    Streaming dedup sends every row of a key to one task.  Dropping repeats on
    the map side first leaves at most one row per key and Arrow batch, so a hot
    key no longer decides the length of a micro-batch.  Rows stay in Arrow form;
    only the key column is looked at.
    """
    position = df.columns.index(key)

    def thin(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks:
            if chunk.num_rows:
                codes = chunk.column(position).dictionary_encode(null_encoding="encode").indices
                _, first = np.unique(codes.to_numpy(zero_copy_only=False), return_index=True)
                chunk = chunk.take(pa.array(np.sort(first)))
            yield chunk

    return df.mapInArrow(thin, df.schema)


def dimension(batches: DataFrame, entity: Entity, validate_first: bool = False,
              rules: Rules | None = None, horizon: str | None = None) -> DataFrame:
    """A deduplicated entity table with its drop rules.

    By default the key is claimed by whatever arrives first and the rules come
    after: if the first record of a key breaks a rule, the key is gone.
    ``validate_first`` lets the first *valid* record claim it instead.

    In a stream the claimed keys live in the state store for good; ``horizon``
    (say ``"7 days"``, on the event's creation time) bounds that state, after
    which a key may appear again.
    """
    rules = entity.rules if rules is None else rules
    if not batches.isStreaming:
        first = first_arrivals(batches, entity, validate_first, rules)
        return first if validate_first else keep_valid(first, rules)
    rows = entity_rows(batches, entity)
    if validate_first:
        rows = keep_valid(rows, rules)
    rows = first_of_each_chunk(rows, entity.key)
    if horizon:
        rows = rows.withWatermark("created_at", horizon).dropDuplicatesWithinWatermark([entity.key])
    else:
        rows = rows.dropDuplicates([entity.key])
    return rows if validate_first else keep_valid(rows, rules)


def order_rows(batches: DataFrame, products: bool = True, arrival: bool = False) -> DataFrame:
    """Orders before their rules, with date parts and amount bucket."""
    columns = ORDERS.columns if products else ORDERS.columns[:-1]
    wanted = Entity(ORDERS.table, ORDERS.array, columns)
    if arrival:
        unnested = batches.select(
            *_bus_arrival(batches), "batch_id", F.posexplode_outer("tables.orders").alias("position", "record"))
    else:
        unnested = batches.select("batch_id", F.explode_outer("tables.orders").alias("record"))
    leading = ARRIVAL if arrival else ()
    typed = unnested.select(
        *leading, "batch_id", *_typed("record", wanted),
        F.col("record.MerchantID").alias("restaurant_id"),
        amount_category(F.col("record.valor_total")).alias("amount_category"),
    )
    order = [c for c in ORDER_COLUMNS if products or c != "produtos"]
    return typed.withColumns(date_parts(F.col("created_at"))).select(*leading, *order)


def orders(batches: DataFrame, rules: Rules | None = None, products: bool = True,
           dedup_orders: bool = False) -> DataFrame:
    """Valid orders.  Redelivered orders stay unless ``dedup_orders``."""
    if dedup_orders and not batches.isStreaming:
        rows = _first(order_rows(batches, products, arrival=True), "order_id")
    elif dedup_orders:
        rows = first_of_each_chunk(order_rows(batches, products), "order_id").dropDuplicates(["order_id"])
    else:
        rows = order_rows(batches, products)
    return keep_valid(rows, ORDERS.rules if rules is None else rules)


def order_item_rows(orders_table: DataFrame) -> DataFrame:
    """Product lines of (valid) orders before their own rules."""
    return (
        orders_table.select("batch_id", "order_id", F.explode_outer("produtos").alias("record"))
        .select("batch_id", "order_id", *_typed("record", ORDER_ITEMS))
    )


def order_items(orders_table: DataFrame, rules: Rules | None = None) -> DataFrame:
    return keep_valid(order_item_rows(orders_table), ORDER_ITEMS.rules if rules is None else rules)
