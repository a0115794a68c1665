"""Synthetic delivery batches, one per tick, as a column expression per tick.

All values derive from ``xxhash64`` of the tick and the position, so a lost
task regenerates the same rows, and ids are unique across ticks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Domains of the generated fields.
PAYMENTS = ("PIX", "CARTÃO CREDITO", "CARTÃO DEBITO", "VOUCHER")
VEHICLES = ("moto", "carro", "bicicleta")
CATEGORIES = ("Hamburguer", "Pizza", "Comida Japonesa", "Sobremesa", "Bebida")
PRICE_CENTS = (1000, 12000)
LINES_PER_ORDER = (2, 4)
UNITS_PER_LINE = (1, 3)
SOURCE_SYSTEM = "delivery_batch_generator"
SCHEMA_VERSION = "1.0"
EVENT_TYPE = "delivery_fake_batch"

FIRST_NAMES = ("Ana", "João", "Márcia", "Antônio", "Luíza", "Caetano", "Iara", "Davi")
LAST_NAMES = ("Silva", "Conceição", "Araújo", "Gonçalves", "Souza", "Lima", "Brandão", "Nóbrega")
STREETS = ("Rua das Flores", "Avenida São João", "Travessa do Açaí", "Alameda Ipê")
FOODS = ("Clássico", "Especial", "da Casa", "Família", "Trufado", "Picante", "Leve", "Duplo")


@dataclass(frozen=True)
class Volume:
    """How much one batch holds."""

    clients: int = 1
    restaurants: int = 1
    drivers: int = 1
    items_per_restaurant: int = 8
    orders: int = 8
    seed: int = 0


def _draw(seed: int, salt: str, *of: Column) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(salt), *of)


def _between(bounds: tuple[int, int], draw: Column) -> Column:
    low, high = bounds
    return F.lit(low) + F.pmod(draw, F.lit(high - low + 1))


def _one_of(values: tuple[str, ...], draw: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(draw, F.lit(len(values))) + 1).cast("int"))


def _digits(draw: Column, n: int) -> Column:
    return F.lpad(F.pmod(draw, F.lit(10**n)).cast("string"), n, "0")


def _plate(draw: Column) -> Column:
    letters = [F.char(F.lit(65) + F.pmod(F.shiftright(draw, 8 * i), F.lit(26))) for i in range(3)]
    return F.concat(*letters, F.lit("-"), _digits(F.shiftright(draw, 24), 4))


def _many(n: int, build) -> Column:
    """``n`` elements, each built from its position."""
    if n == 0:
        return F.slice(F.transform(F.array(F.lit(0)), build), 1, 0)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), build)


def generate(ticks: DataFrame, tick: str, at: Column, volume: Volume = Volume()) -> DataFrame:
    """One batch document per row of ``ticks``.

    ``tick`` names a whole-number column that is unique per row; ``at`` is the
    time of the batch.  Returns tick, batch_id and body_json.
    """
    t, v = F.col(tick), volume
    # A column, so that a batch formats its time once and not for every record.
    created = F.col("created")
    created_at = F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))

    def uid(letter: str, per_tick: int, i: Column) -> Column:
        return F.concat(F.lit(letter), (t * F.lit(per_tick) + i).cast("string"))

    def person(salt: str, i: Column) -> Column:
        first, last = (_draw(v.seed, salt + part, t, i) for part in ("first", "last"))
        return F.concat_ws(" ", _one_of(FIRST_NAMES, first), _one_of(LAST_NAMES, last))

    def address(salt: str, i: Column) -> Column:
        draw = _draw(v.seed, salt + "address", t, i)
        return F.concat_ws(", ", _one_of(STREETS, draw), F.pmod(F.shiftright(draw, 16), F.lit(2000)).cast("string"))

    def client(i: Column) -> Column:
        return F.struct(
            uid("C", max(v.clients, 1), i).alias("ClientID"), person("client", i).alias("nome"),
            address("client", i).alias("endereco"), _digits(_draw(v.seed, "cpf", t, i), 11).alias("CPF"),
            _one_of(PAYMENTS, _draw(v.seed, "payment", t, i)).alias("tipo_pagamento"),
            created.alias("created_at"),
        )

    def restaurant(i: Column) -> Column:
        return F.struct(
            uid("R", max(v.restaurants, 1), i).alias("MerchantID"),
            F.concat(F.lit("Restaurante "), person("restaurant", i)).alias("nome"),
            address("restaurant", i).alias("endereco"),
            _digits(_draw(v.seed, "cnpj", t, i), 14).alias("CNPJ"), created.alias("created_at"),
        )

    def driver(i: Column) -> Column:
        return F.struct(
            uid("D", max(v.drivers, 1), i).alias("DriversID"), person("driver", i).alias("nome"),
            address("driver", i).alias("endereco"),
            _one_of(VEHICLES, _draw(v.seed, "vehicle", t, i)).alias("veiculo"),
            _plate(_draw(v.seed, "plate", t, i)).alias("placa"), created.alias("created_at"),
        )

    menu_size = v.restaurants * v.items_per_restaurant

    def menu_item(i: Column) -> Column:
        category = _one_of(CATEGORIES, _draw(v.seed, "category", t, i))
        return F.struct(
            uid("I", max(menu_size, 1), i).alias("ItemID"),
            F.concat_ws(" ", category, _one_of(FOODS, _draw(v.seed, "food", t, i))).alias("nome"),
            category.alias("categoria"),
            _between(PRICE_CENTS, _draw(v.seed, "price", t, i)).alias("cents"),
            uid("R", max(v.restaurants, 1), F.floor(i / F.lit(max(v.items_per_restaurant, 1)))).alias("MerchantID"),
        )

    def order_head(i: Column) -> Column:
        """Choice of client, restaurant and driver, and that restaurant's shuffled menu."""
        def choose(column: str, salt: str, n: int) -> Column:
            return F.get(F.col(column), F.pmod(_draw(v.seed, salt, t, i), F.lit(max(n, 1))).cast("int"))

        shop = choose("restaurantes", "order restaurant", v.restaurants)["MerchantID"]
        shuffled = F.array_sort(F.transform(
            F.filter("menu", lambda m: m["MerchantID"] == shop),
            lambda m: F.struct(
                _draw(v.seed, "pick", t, i, m["ItemID"]).alias("rank"),
                m.alias("item"),
                _between(UNITS_PER_LINE, _draw(v.seed, "units", t, i, m["ItemID"])).alias("units"),
            ),
        ))
        lines = _between(LINES_PER_ORDER, _draw(v.seed, "lines", t, i)).cast("int")
        return F.struct(
            i.alias("i"),
            choose("clientes", "order client", v.clients).alias("client"),
            shop.alias("shop"),
            choose("drivers", "order driver", v.drivers)["DriversID"].alias("driver"),
            F.slice(shuffled, F.lit(1), lines).alias("lines"),
        )

    def money(cents: Column) -> Column:
        return cents.cast("double") / F.lit(100.0)

    def order(head: Column) -> Column:
        def total(of) -> Column:
            return F.aggregate(head["lines"], F.lit(0).cast("bigint"), lambda acc, line: acc + of(line))

        products = F.transform(head["lines"], lambda line: F.struct(
            line["item"]["ItemID"].alias("ItemID"), line["item"]["nome"].alias("nome"),
            line["item"]["categoria"].alias("categoria"), money(line["item"]["cents"]).alias("preco"),
            line["item"]["MerchantID"].alias("MerchantID"), line["units"].alias("quantidade"),
            money(line["item"]["cents"] * line["units"]).alias("valor_total_item"),
            created.alias("created_at"),
        ))
        return F.struct(
            uid("P", max(v.orders, 1), head["i"]).alias("PedidoID"),
            head["client"]["ClientID"].alias("ClientID"), head["shop"].alias("MerchantID"),
            head["driver"].alias("DriversID"), products.alias("Produtos"),
            total(lambda line: line["units"]).alias("quantidade_total"),
            money(total(lambda line: line["item"]["cents"] * line["units"])).alias("valor_total"),
            head["client"]["tipo_pagamento"].alias("tipo_pagamento"), created.alias("created_at"),
        )

    batch_id = F.lpad(t.cast("string"), 20, "0")
    announced = F.transform("menu", lambda m: F.struct(
        m["ItemID"].alias("ItemID"), m["nome"].alias("nome"), m["categoria"].alias("categoria"),
        money(m["cents"]).alias("preco"), m["MerchantID"].alias("MerchantID"), created.alias("created_at"),
    ))
    body = F.to_json(F.struct(
        batch_id.alias("batch_id"), created.alias("ingestion_ts"),
        F.lit(SOURCE_SYSTEM).alias("source_system"), F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.struct(
            F.col("clientes"), F.col("restaurantes"), announced.alias("items"), F.col("drivers"),
            F.transform("heads", order).alias("orders"),
        ).alias("tables"),
    ))
    return (
        ticks.withColumn("created", created_at).withColumns({
            "clientes": _many(v.clients, client),
            "restaurantes": _many(v.restaurants, restaurant),
            "drivers": _many(v.drivers, driver),
            "menu": _many(menu_size, menu_item),
        })
        .withColumn("heads", _many(v.orders, order_head))
        .select(t.alias("tick"), batch_id.alias("batch_id"), at.alias("at"), body.alias("body_json"))
    )


def envelopes(batches: DataFrame) -> DataFrame:
    """Generated batches as bus events: UTF-8 body plus event properties."""
    return batches.select(
        F.col("tick").cast("bigint").alias("SequenceNumber"),
        F.col("tick").cast("string").alias("Offset"),
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("EnqueuedTimeUtc"),
        F.create_map(F.lit("partition"), F.pmod("tick", F.lit(2)).cast("string")).alias("SystemProperties"),
        F.create_map(
            F.lit("event_type"), F.lit(EVENT_TYPE),
            F.lit("schema_version"), F.lit(SCHEMA_VERSION),
            F.lit("batch_id"), F.col("batch_id"),
        ).alias("Properties"),
        F.encode("body_json", "UTF-8").alias("Body"),
    )
