from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from marmita.schemas import ENVELOPE_DDL, payload_ddl
from marmita.sources import feed
from marmita.sources.tables import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return feed.feed(spark, SF).cache()


def test_one_event_per_source_row_or_chunk(spark, events):
    rows = sum(read_table(spark, SF, t).count() for t in ("customer", "supplier", "events", "part"))
    orders, chunks = read_table(spark, SF, "orders"), feed.lines_by_order(read_table(spark, SF, "lineitem"))
    rows += orders.join(chunks, orders.o_orderkey == chunks.l_orderkey, "left").count()
    assert events.count() == events.select("SequenceNumber").distinct().count() == rows
    assert events.schema.simpleString() == spark.createDataFrame([], ENVELOPE_DDL).schema.simpleString()


def test_every_part_of_an_order_is_a_line(spark, events):
    bodies = events.filter(F.col("SequenceNumber") % feed.STRIDE == feed.KINDS["orders"]).select(
        F.from_json(F.col("Body").cast("string"), payload_ddl()).alias("p"))
    lines = bodies.select(F.explode("p.tables.orders").alias("o")).select("o.PedidoID", F.explode("o.Produtos.ItemID"))
    given = read_table(spark, SF, "lineitem").join(
        read_table(spark, SF, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_partkey")
    assert lines.distinct().count() == given.distinct().count()


def test_lines_add_up_and_a_hot_order_is_cut(spark):
    given = read_table(spark, SF, "lineitem")
    hot = given.withColumn("l_orderkey", F.lit(7).cast("bigint"))
    for lines in (given, hot):
        chunks = feed.lines_by_order(lines)
        in_lines = F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, x: a + x["quantity"])
        ours = chunks.agg(F.sum(in_lines), F.sum("quantity"), F.max(F.size("lines"))).first()
        assert ours[0] == ours[1] == int(lines.agg(F.sum("l_quantity")).first()[0])
        assert ours[2] <= 3 * feed.CHUNK


def test_feed_has_its_faults(events):
    text = events.select(F.col("Body").cast("string").alias("b"))
    assert text.filter("b IS NULL").count() > 0
    assert text.filter("b LIKE 'not json%'").count() > 0
    assert text.filter("b LIKE '%\"preco\":\"oops\"%'").count() > 0
    sample = json.loads(text.filter("b LIKE '%\"orders\":[{%'").first().b)
    assert set(sample["tables"]) == {"clientes", "orders"}
