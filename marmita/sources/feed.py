"""The given tables as a feed of archived delivery events.

Every source row becomes one event, an order with many parts several, so an
event's size never depends on how often a key occurs.  Every part that an order
has in the given lines is a product line.

The feed holds, on purpose, the faults a real one has: unparsable and missing
bodies, leaves of the wrong type, entities that break rules, repeated keys
with differing content, redelivered orders, time offsets and bad dates.
``marmita/plans/oracle.py`` states the same feed in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marmita.schemas import ENVELOPE_DDL
from marmita.sources.tables import read_table

PAYMENTS = ("PIX", "CARTÃO CREDITO", "CARTÃO DEBITO", "VOUCHER", "CHEQUE")
CATEGORIES = ("Hamburguer", "Pizza", "Comida Japonesa", "Sobremesa", "Bebida", "Outros")
VEHICLES = ("moto", "carro", "bicicleta", "patinete")

# Each table's events have their own residue, which keeps sequence numbers apart.
KINDS = {"customer": 0, "supplier": 1, "events": 2, "part": 3, "orders": 4}
STRIDE = 8
# Parts per order event, about, and how far apart the events of one order are numbered.
CHUNK = 8
CHUNK_STRIDE = 1 << 36
EPOCH = 1704067200  # 2024-01-01T00:00:00Z
YEAR_SECONDS = 31536000


def _pick(values: tuple[str, ...], number: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.expr(f"cast({number} % {len(values)} as int) + 1"))


def _id(letter: str, expr: str) -> Column:
    return F.expr(f"'{letter}' || cast({expr} as string)")


def _iso(ts: str) -> str:
    return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss\")"


def _enqueued(seq: str) -> str:
    return f"timestamp_seconds({EPOCH} + ({seq}) % {YEAR_SECONDS})"


def _events(rows: DataFrame, kind: str, key: str, tables: Column, body: Column | None = None,
            us_time: bool = False) -> DataFrame:
    """Wrap one payload per row into the capture envelope."""
    numbered = rows.withColumn("seq", F.expr(f"{key} * {STRIDE} + {KINDS[kind]}"))
    batch_id = F.expr("lpad(cast(seq as string), 20, '0')")
    payload = F.to_json(F.struct(
        batch_id.alias("batch_id"),
        F.expr(f"{_iso(_enqueued('seq'))} || '+00:00'").alias("ingestion_ts"),
        F.lit("delivery_batch_generator").alias("source_system"),
        F.lit("1.0").alias("schema_version"),
        tables.alias("tables"),
    ))
    enqueued_text = "M/d/yyyy h:mm:ss a" if us_time else "yyyy-MM-dd'T'HH:mm:ss"
    return numbered.withColumn("payload", payload).select(
        F.col("seq").cast("bigint").alias("SequenceNumber"),
        F.expr("cast(seq * 100 as string)").alias("Offset"),
        F.date_format(F.expr(_enqueued("seq")), enqueued_text).alias("EnqueuedTimeUtc"),
        F.create_map(F.lit("partition"), F.expr("cast(seq % 2 as string)")).alias("SystemProperties"),
        F.create_map(
            F.lit("event_type"), F.lit("delivery_fake_batch"),
            F.lit("schema_version"), F.lit("1.0"),
            F.lit("batch_id"), batch_id,
        ).alias("Properties"),
        F.encode(F.col("payload") if body is None else body, "UTF-8").alias("Body"),
    )


def _client_events(customers: DataFrame, nations: DataFrame) -> DataFrame:
    client = F.struct(
        _id("C", "c_custkey").alias("ClientID"),
        F.col("c_name").alias("nome"),
        F.col("n_name").alias("endereco"),
        F.expr("left(lpad(cast(c_custkey as string), 11, '0'), if(c_custkey % 17 = 0, 10, 11))").alias("CPF"),
        _pick(PAYMENTS, "c_custkey").alias("tipo_pagamento"),
        F.expr(f"{_iso(_enqueued('c_custkey'))} || '+00:00'").alias("created_at"),
    )
    no_orders = F.array().cast("array<string>")
    tables = F.struct(F.array(client).alias("clientes"), no_orders.alias("orders"))
    rows = customers.join(nations, customers.c_nationkey == nations.n_nationkey, "left")
    return _events(rows, "customer", "c_custkey", tables)


def _restaurant_events(suppliers: DataFrame, nations: DataFrame) -> DataFrame:
    def restaurant(name: Column) -> Column:
        return F.struct(
            _id("R", "s_suppkey").alias("MerchantID"),
            name.alias("nome"),
            F.col("n_name").alias("endereco"),
            F.expr("left(lpad(cast(s_suppkey as string), 14, '0'), if(s_suppkey % 19 = 0, 13, 14))").alias("CNPJ"),
            F.expr(f"{_iso(_enqueued('s_suppkey * 3600'))} || '+00:00'").alias("created_at"),
        )

    first = restaurant(F.expr("if(s_suppkey % 13 = 0, null, s_name)"))
    again = restaurant(F.expr("'Filial ' || s_name"))
    both = F.when(F.expr("s_suppkey % 7 = 0"), F.array(first, again)).otherwise(F.array(first))
    rows = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey, "left")
    return _events(rows, "supplier", "s_suppkey", F.struct(both.alias("restaurantes")), us_time=True)


def _driver_events(events: DataFrame) -> DataFrame:
    driver = F.struct(
        _id("D", "user_id").alias("DriversID"),
        F.expr("'Driver ' || cast(user_id as string)").alias("nome"),
        F.col("event_type").alias("endereco"),
        _pick(VEHICLES, "event_id").alias("veiculo"),
        F.expr("if(event_id % 11 = 0, 'abc-', 'ABC-') || lpad(cast(user_id % 10000 as string), 4, '0')")
        .alias("placa"),
        F.expr("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '+00:00'").alias("created_at"),
    )
    body = (
        F.when(F.expr("event_id % 50 = 7"), F.expr("'not json {' || cast(event_id as string)"))
        .when(F.expr("event_id % 50 = 8"), F.lit(None))
        .otherwise(F.col("payload"))
    )
    return _events(events, "events", "event_id", F.struct(F.array(driver).alias("drivers")), body)


def _item_events(parts: DataFrame, restaurants: int) -> DataFrame:
    def item(price: str) -> Column:
        return F.struct(
            _id("I", "p_partkey").alias("ItemID"),
            F.col("p_name").alias("nome"),
            _pick(CATEGORIES, "p_partkey").alias("categoria"),
            F.expr(f"cast(cast(round(p_retailprice * 100) as bigint) + {price} as double) / 100D").alias("preco"),
            _id("R", f"p_partkey % {restaurants}").alias("MerchantID"),
            F.expr(f"{_iso(_enqueued('p_partkey * 60'))} || '+00:00'").alias("created_at"),
        )

    both = F.when(F.expr("p_partkey % 5 = 0"), F.array(item("0"), item("100"))).otherwise(F.array(item("0")))
    bad_leaf = F.when(
        F.expr("p_partkey % 97 = 0"),
        F.regexp_replace("payload", r'"preco":[0-9.E]+', '"preco":"oops"'),
    ).otherwise(F.col("payload"))
    return _events(parts, "part", "p_partkey", F.struct(both.alias("items")), bad_leaf)


def lines_by_order(lineitem: DataFrame) -> DataFrame:
    """(l_orderkey, chunk, suppkey, quantity, lines): every part of an order, in chunks of about ``CHUNK`` parts.

    Lines are summed per order and part before anything is gathered, and an
    order of many parts becomes many small chunks, so no event and no group
    grows with a hot order.
    """
    lines = lineitem.select(
        "l_orderkey", "l_suppkey", "l_partkey",
        F.expr("cast(l_quantity as bigint)").alias("quantity"),
        F.expr("cast(round(l_extendedprice * 100) as bigint)").alias("cents"),
    )
    per_part = lines.groupBy("l_orderkey", "l_partkey").agg(
        F.min("l_suppkey").alias("suppkey"), F.sum("quantity").alias("quantity"), F.sum("cents").alias("cents"))
    n_parts = per_part.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_parts"))
    chunked = per_part.join(n_parts, "l_orderkey").withColumn(
        "chunk", F.expr(f"l_partkey % ceil(n_parts / {CHUNK})"))
    return chunked.groupBy("l_orderkey", "chunk").agg(
        F.min("suppkey").alias("suppkey"), F.sum("quantity").alias("quantity"),
        F.array_sort(F.collect_list(F.struct("l_partkey", "quantity", "cents"))).alias("lines"))


def _order_events(orders: DataFrame, lineitem: DataFrame, drivers: int) -> DataFrame:
    created = (
        "if(o_orderkey % 101 = 0, '31/12/1998 10:00', "
        f"{_iso('o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int))')}"
        " || if(o_orderkey % 3 = 0, '-03:00', '+00:00'))"
    )

    def product(line: Column) -> Column:
        part, quantity, cents = (line[c] for c in ("l_partkey", "quantity", "cents"))
        category = F.element_at(F.array(*map(F.lit, CATEGORIES)), (part % len(CATEGORIES) + 1).cast("int"))
        return F.struct(
            F.concat(F.lit("I"), part.cast("string")).alias("ItemID"),
            F.concat(F.lit("Item "), part.cast("string")).alias("nome"),
            category.alias("categoria"),
            (F.floor(cents / F.nullif(quantity, F.lit(0))).cast("double") / 100).alias("preco"),
            F.concat(F.lit("R"), F.col("suppkey").cast("string")).alias("MerchantID"),
            quantity.cast("double").alias("quantidade"),
            (cents.cast("double") / 100).alias("valor_total_item"),
            F.col("created").alias("created_at"),
        )

    products = F.coalesce(F.transform("lines", product), F.array())
    client = F.struct(
        _id("C", "o_custkey").alias("ClientID"),
        F.expr("'Customer#' || lpad(cast(o_custkey as string), 9, '0')").alias("nome"),
        F.col("o_orderpriority").alias("endereco"),
        F.expr("left(lpad(cast(o_custkey as string), 11, '0'), if(o_orderkey % 17 = 0, 10, 11))").alias("CPF"),
        _pick(PAYMENTS, "o_custkey").alias("tipo_pagamento"),
        F.col("created").alias("created_at"),
    )
    order = F.struct(
        _id("P", "o_orderkey").alias("PedidoID"),
        _id("C", "o_custkey").alias("ClientID"),
        _id("R", "suppkey").alias("MerchantID"),
        _id("D", f"o_orderkey % {drivers}").alias("DriversID"),
        products.alias("Produtos"),
        F.expr("cast(quantity as double) + if(o_orderkey % 113 = 0, 0.9D, 0D)").alias("quantidade_total"),
        F.expr(
            "case when o_orderkey % 103 = 0 then 199.999D when o_orderkey % 107 = 0 then -1D "
            "when o_orderkey % 109 = 0 then 1000000000D "
            "else cast(cast(round(o_totalprice * 100) as bigint) div 1000 as double) / 100D end"
        ).alias("valor_total"),
        _pick(PAYMENTS, "o_custkey").alias("tipo_pagamento"),
        F.col("created").alias("created_at"),
    )
    sent = F.array_repeat(order, F.expr("if(o_orderkey % 211 = 0, 2, 1)"))
    rows = orders.join(
        lines_by_order(lineitem), F.col("o_orderkey") == F.col("l_orderkey"), "left",
    ).withColumn("created", F.expr(created)).withColumn(
        "event", F.expr(f"o_orderkey + coalesce(chunk, 0) * {CHUNK_STRIDE}"))
    return _events(rows, "orders", "event", F.struct(F.array(client).alias("clientes"), sent.alias("orders")))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of the given tables as capture envelopes."""
    def read(name: str) -> DataFrame:
        return read_table(spark, sf_dir, name)

    # Two numbers: items and orders are dealt over as many restaurants and drivers as there are.
    restaurants = max(1, read("supplier").count())
    drivers = max(1, (read("events").agg(F.max("user_id")).first()[0] or 0) + 1)
    parts = [
        _client_events(read("customer"), read("nation")),
        _restaurant_events(read("supplier"), read("nation")),
        _driver_events(read("events")),
        _item_events(read("part"), restaurants),
        _order_events(read("orders"), read("lineitem"), drivers),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.to(spark.createDataFrame([], ENVELOPE_DDL).schema)
