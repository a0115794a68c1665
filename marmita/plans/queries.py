"""One entry per operator: ``REGISTRY[name](spark, sf_dir)`` returns a DataFrame.

Audit timestamps are left out, nested columns appear as sizes or joined text,
so that every result can be compared with SQL over the given tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marmita.jobs import EXPIRES, run_governance, run_live_maintenance, run_retention
from marmita.operators import bronze, cost, gold, governance, integrity, maintenance, quality, silver
from marmita.plans.workspace import Workspace, workspace
from marmita.rules import RULES
from marmita.sources import cost_responses, feed, generator
from marmita.sources.capture import path_attributes
from marmita.streaming.history import rule_history, rule_totals
from marmita.streaming.runner import SILVER, Lakehouse, rejected
from marmita.tables import BRONZE_BATCHES, BRONZE_RAW, SCHEMAS

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Days the retention queries are taken as of, and the look-ahead of the cost ones.
RETENTION_AS_OF = {"bronze": "2024-12-31", "silver": "2001-06-30", "gold": "2001-06-30"}
SUBSCRIPTION = "subscription-1"
#: Key of the pseudonyms in queries; a deployment passes its own.
SECRET = "query-secret"

ENTITY_TABLES = tuple(entity.table for entity in silver.DEDUPLICATED)
ENTITIES = {
    "clientes": silver.CLIENTES,
    "restaurantes": silver.RESTAURANTES,
    "drivers": silver.DRIVERS,
    "items": silver.ITEMS,
}


def register(name: str):
    def add(build: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
        REGISTRY[name] = lambda spark, sf_dir: build(workspace(spark, sf_dir))
        return build

    return add


# -- sources and bronze ---------------------------------------------------------

def _raw_columns(raw: DataFrame) -> DataFrame:
    return raw.select(
        "sequence_number", "eventhub_offset", "enqueued_time_utc",
        F.col("system_properties")["partition"].alias("bus_partition"),
        F.col("event_properties")["event_type"].alias("event_type"),
        F.col("event_properties")["batch_id"].alias("property_batch_id"),
        F.col("body_json").isNull().alias("body_missing"),
    )


@register("src_capture_stream")
def _(ws):
    return _raw_columns(ws.lakehouse.read(BRONZE_RAW))


@register("bronze_raw")
def _(ws):
    return _raw_columns(ws.raw())


@register("src_file_lineage")
def _(ws):
    return ws.raw().agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("source_file").endswith(".parquet")).alias("rows_with_file"),
        F.count("source_file_modification_time").alias("rows_with_time"),
    )


@register("src_path_attrs")
def _(ws):
    path = F.expr(
        "case when o_orderkey % 29 = 0 then 'elsewhere/' || o_orderkey else "
        "'bus-ns/hub-' || (o_orderkey % 3) || '/' || (o_orderkey % 2) || '/' || "
        "date_format(o_orderdate, 'yyyy/MM/dd/HH/mm/ss') || '.parquet' end"
    )
    columns = [c.alias(n) for n, c in path_attributes(F.col("path")).items()]
    return ws.table("orders").select("o_orderkey", path.alias("path")).select("o_orderkey", *columns)


@register("bronze_body_decode")
def _(ws):
    text = F.col("body_json")
    return ws.raw().groupBy((F.col("sequence_number") % feed.STRIDE).alias("kind")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count(text).alias("bodies"),
        F.count_if(text.startswith("not json")).alias("unparsable"),
        F.count_if(text.contains("CARTÃO CREDITO")).alias("credit"),
        F.count_if(text.contains("CARTÃO DEBITO")).alias("debit"),
    )


@register("bronze_parse")
def _(ws):
    sizes = (F.array_size(f"tables.{name}").alias(f"n_{name}")
             for name in ("clientes", "restaurantes", "drivers", "items", "orders"))
    return bronze.parse_batches(ws.raw()).select("sequence_number", "batch_id", *sizes)


@register("bronze_batches")
def _(ws):
    return bronze.parse_batches(ws.raw(), keep={}).select(
        "sequence_number", "eventhub_offset", "enqueued_time_utc", "batch_id", "source_ingestion_ts",
        "event_date", "source_system", "schema_version",
    )


# -- silver ---------------------------------------------------------------------

def _register_entity(name: str, entity: silver.Entity) -> None:
    register(f"silver_{name}")(lambda ws: ws.dimension(entity))
    register(f"silver_{name}_validate_first")(lambda ws: ws.dimension(entity, validate_first=True))
    register(f"dedup_first_{name}")(lambda ws: silver.first_arrivals(ws.batches(entity.keep), entity))
    register(f"dq_drop_{name}")(lambda ws: quality.keep_valid(ws.entity_rows(entity), entity.rules))
    register(f"dq_metrics_{name}")(
        lambda ws: quality.rule_counts(silver.first_arrivals(ws.batches(entity.keep), entity), entity.rules))


for _name, _entity in ENTITIES.items():
    _register_entity(_name, _entity)


@register("silver_orders")
def _(ws):
    orders = ws.orders_with_products()
    return orders.withColumn("produtos", F.array_size("produtos")).withColumnRenamed("produtos", "n_produtos")


@register("silver_orders_dedup")
def _(ws):
    batches = ws.batches({"orders": [s for _, s, _ in silver.ORDERS.columns if s != "Produtos"]})
    return silver.orders(batches, products=False, dedup_orders=True)


@register("silver_order_items")
def _(ws):
    return ws.order_items()


@register("unnest_outer")
def _(ws):
    """Rows per entity after the outer unnest, and how many are all null."""
    counts = None
    for name, entity in ENTITIES.items():
        key = F.col(entity.key)
        one = ws.entity_rows(entity).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(key.isNull()).alias("null_rows"))
        one = one.select(F.lit(name).alias("entity"), "rows", "null_rows")
        counts = one if counts is None else counts.unionByName(one)
    orders = ws.order_rows().agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("order_id").isNull()).alias("null_rows"))
    return counts.unionByName(orders.select(F.lit("orders").alias("entity"), "rows", "null_rows"))


@register("amount_category")
def _(ws):
    return ws.order_rows().groupBy("amount_category").agg(
        F.count(F.lit(1)).alias("orders"), F.min("valor_total").alias("least"), F.max("valor_total").alias("most"))


@register("order_date_parts")
def _(ws):
    return ws.order_rows().groupBy("order_date", "order_year", "order_month", "order_day", "order_hour").agg(
        F.count(F.lit(1)).alias("orders"))


# -- quality --------------------------------------------------------------------

@register("dq_warn")
def _(ws):
    """Every event stays; the flag is what the observed counts are made of."""
    kept = quality.warn(ws.batches(), RULES[BRONZE_BATCHES], f"warn-{uuid.uuid4().hex[:8]}")
    return kept.select("sequence_number", quality.passes("batch_id IS NOT NULL").alias("valid_json_payload"))


@register("dq_drop_orders")
def _(ws):
    return ws.orders().select("batch_id", "order_id", "valor_total", "quantidade_total")


@register("dq_drop_order_items")
def _(ws):
    return ws.order_items().select("batch_id", "order_id", "item_id", "quantidade", "valor_total_item")


@register("dq_metrics_orders")
def _(ws):
    return quality.rule_counts(ws.order_rows(), RULES["silver_orders"])


@register("dq_metrics_order_items")
def _(ws):
    return quality.rule_counts(ws.order_item_rows(), RULES["silver_order_items"])


@register("dq_fail")
def _(ws):
    """Only valid orders reach the check, so it lets the job run to its end."""
    return quality.fail_on_violation(ws.orders(), RULES["silver_orders"]).select("order_id", "valor_total")


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("failed_rules", F.array_join("failed_rules", ","))


@register("dq_quarantine")
def _(ws):
    rejected = quality.quarantine(ws.order_rows(), RULES["silver_orders"])
    return _joined(rejected).select("batch_id", "order_id", "valor_total", "failed_rules")


@register("dq_row_errors")
def _(ws):
    marked = quality.with_failed_rules(ws.entity_rows(silver.ITEMS), silver.ITEMS.rules)
    return _joined(marked).select("batch_id", "item_id", "preco", "failed_rules")


@register("ref_integrity")
def _(ws):
    return integrity.orphan_summary(ws.silver())


# -- gold -----------------------------------------------------------------------

@register("gold_daily_delivery_kpis")
def _(ws):
    return ws.gold()["gold_daily_delivery_kpis"]


@register("gold_restaurant_performance")
def _(ws):
    return ws.gold()["gold_restaurant_performance"]


@register("gold_item_category_metrics")
def _(ws):
    return ws.gold()["gold_item_category_metrics"]


@register("layer_row_counts")
def _(ws):
    return maintenance.row_counts(
        {BRONZE_RAW: ws.raw(), BRONZE_BATCHES: ws.batches()} | ws.silver() | ws.gold())


# -- governance -----------------------------------------------------------------

def _register_view(view: str, table: Callable[[Workspace], DataFrame]) -> None:
    register(view)(lambda ws: governance.governed(view, table(ws)))


_register_view("vw_clientes_analyst", lambda ws: ws.dimension(silver.CLIENTES))
_register_view("vw_drivers_analyst", lambda ws: ws.dimension(silver.DRIVERS))
_register_view("vw_orders_analytics", lambda ws: ws.orders())
_register_view("vw_gold_delivery_dashboard", lambda ws: ws.gold()["gold_daily_delivery_kpis"])


@register("mask_by_tag")
def _(ws):
    return governance.mask_by_tag(governance.tag_columns(ws.dimension(silver.CLIENTES), "silver_clientes"))


@register("mask_by_tag_orders")
def _(ws):
    tagged = governance.tag_columns(ws.orders(), "silver_orders")
    masked = governance.mask_by_tag(tagged, governance.analyst_masks(SECRET))
    return masked.select("order_id", "client_id", "driver_id", "valor_total")


@register("mask_catalog_table")
def _(ws):
    """The masks as a reader of the catalog meets them, after the governance job."""
    schema = f"masked_{uuid.uuid4().hex[:8]}"
    ws.spark.sql(f"CREATE SCHEMA {schema} LOCATION '{ws.folder(schema)}'")
    ws.lakehouse.register(schema)
    run_governance(ws.spark, schema, schema)
    return governance.mask_table(ws.spark, f"{schema}.silver_clientes").drop("silver_processed_at")


# -- layout and maintenance -----------------------------------------------------

def _write_new(ws: Workspace, df: DataFrame, name: str) -> str:
    path = ws.folder(f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return path


@register("layout_clustered")
def _(ws):
    """Orders stored by day and restaurant, then one year read back."""
    keys = maintenance.CLUSTER_KEYS["silver_orders"]
    stored = _write_new(ws, maintenance.clustered(ws.orders(), keys), "clustered")
    year = ws.spark.read.parquet(stored).filter("order_date BETWEEN DATE'1996-01-01' AND DATE'1996-12-31'")
    return year.select("order_date", "restaurant_id", "order_id", "valor_total")


@register("compact_files")
def _(ws):
    """Order items stored as many small files, rewritten as few, summed per category."""
    small = _write_new(ws, ws.order_items().repartition(40), "small-files")
    compacted = maintenance.compact(ws.spark, small, ws.folder(f"compacted-{uuid.uuid4().hex[:8]}"))
    return compacted.groupBy("categoria").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("valor_total_item").cast("decimal(18,2)").alias("total"))


@register("retention_keep_bronze")
def _(ws):
    """From the stored batches: a pruned scan whose day filter is pushed down."""
    stored = ws.spark.read.schema(SCHEMAS[BRONZE_BATCHES]).parquet(ws.batches_path)
    dated = stored.withColumn("enqueued_day", F.to_date("enqueued_time_utc"))
    kept = maintenance.retained(dated, "bronze", "event_date", RETENTION_AS_OF["bronze"], arrived="enqueued_day")
    return kept.select("sequence_number", "event_date")


@register("retention_keep_silver")
def _(ws):
    kept = maintenance.retained(ws.orders(), "silver", "order_date", RETENTION_AS_OF["silver"])
    return kept.select("order_id", "order_date")


@register("retention_keep_gold")
def _(ws):
    kpis = ws.gold()["gold_daily_delivery_kpis"]
    return maintenance.retained(kpis, "gold", "metric_date", RETENTION_AS_OF["gold"])


# -- cost -----------------------------------------------------------------------

def _charges(ws: Workspace) -> DataFrame:
    """Every raw charge, typed."""
    return cost.detail(cost_responses.usage_rows(ws.table("lineitem")), SUBSCRIPTION)


def _reshaped(ws: Workspace) -> DataFrame:
    return cost_responses.reshape_responses(cost_responses.saved_responses(ws.table("lineitem")))


@register("cost_reshape")
def _(ws):
    return _reshaped(ws)


@register("cost_detail")
def _(ws):
    return cost.detail(_reshaped(ws), SUBSCRIPTION)


@register("cost_by_resource_daily")
def _(ws):
    return cost.by_resource_daily(_charges(ws))


@register("cost_summary_daily")
def _(ws):
    return cost.summary_daily(_charges(ws))


@register("cost_write_roundtrip")
def _(ws):
    name = f"cost_roundtrip_{uuid.uuid4().hex[:8]}"
    summary = cost.summary_daily(_charges(ws))
    for _ in range(2):
        cost.write_table(summary, name, path=ws.folder(name))
    return ws.spark.table(name)


@register("cost_lookback")
def _(ws):
    return cost.look_back(_charges(ws), 30).select("usage_date", "resource_id", "meter_subcategory", "pretax_cost")


@register("cost_daily_total")
def _(ws):
    return cost.total_by(_charges(ws), "usage_date")


@register("cost_by_group")
def _(ws):
    return cost.total_by(_charges(ws), "resource_group")


@register("cost_by_type")
def _(ws):
    return cost.total_by(_charges(ws), "resource_type")


@register("cost_by_service")
def _(ws):
    return cost.total_by(_charges(ws), "service_name")


@register("cost_by_dimension")
def _(ws):
    return cost.total_by_each(_charges(ws), "resource_group", "resource_type", "service_name")


@register("cost_top_resources")
def _(ws):
    return cost.top_resources(_charges(ws), 10)


@register("cost_variation_7d")
def _(ws):
    return cost.variation(_charges(ws), 7)


@register("cost_variation_30d")
def _(ws):
    return cost.variation(_charges(ws), 30)


@register("cost_rolling_7d")
def _(ws):
    return cost.rolling(_charges(ws), 7)


@register("cost_summary_sorted")
def _(ws):
    return cost.sorted_summary(cost.summary_daily(_charges(ws)))


@register("cost_limit_100")
def _(ws):
    return cost.sorted_summary(cost.summary_daily(_charges(ws))).limit(100)


# -- generator ------------------------------------------------------------------

def _generated(ws: Workspace) -> DataFrame:
    """One batch per row of the event table; a tick is two narrow columns and becomes a whole document, so ticks are spread first.

    By a fixed number of tasks: sized by the ticks, AQE would leave the documents to a few.
    """
    tasks = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
    ticks = ws.table("events").select("event_id", "ts").repartition(max(tasks, ws.spark.sparkContext.defaultParallelism), "event_id")
    return generator.generate(ticks, "event_id", F.col("ts").cast("timestamp"))


@register("gen_batches")
def _(ws):
    """What every generated order must satisfy, counted after the silver step."""
    batches = bronze.parse_batches(_generated(ws))
    orders = silver.orders(batches)
    item_ids = F.transform("produtos", lambda p: p["ItemID"])
    cents = F.aggregate(
        "produtos", F.lit(0).cast("bigint"),
        lambda acc, p: acc + F.round(p["valor_total_item"] * 100).cast("bigint"))
    units = F.aggregate("produtos", F.lit(0).cast("bigint"), lambda acc, p: acc + p["quantidade"].cast("bigint"))
    own_menu = F.forall("produtos", lambda p: p["MerchantID"] == F.col("merchant_id"))
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.array_size("produtos").between(*generator.LINES_PER_ORDER)).alias("orders_2_to_4_lines"),
        F.count_if(F.array_size(F.array_distinct(item_ids)) == F.array_size("produtos")).alias("orders_distinct_items"),
        F.count_if(own_menu).alias("orders_of_own_menu"),
        F.count_if((F.col("valor_total") * 100).cast("bigint") == cents).alias("orders_total_matches"),
        F.count_if(F.col("quantidade_total") == units).alias("orders_quantity_matches"),
        F.count_if(F.forall("produtos", lambda p: p["quantidade"].between(*generator.UNITS_PER_LINE)))
        .alias("orders_1_to_3_units"),
    )


@register("gen_envelope")
def _(ws):
    events = generator.envelopes(_generated(ws)).withColumn("body_json", F.col("Body").cast("string"))
    parsed = F.from_json("body_json", "batch_id STRING, schema_version STRING")
    return events.groupBy(
        F.col("Properties")["event_type"].alias("event_type"),
        F.col("Properties")["schema_version"].alias("schema_version"),
    ).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(parsed["batch_id"] == F.col("Properties")["batch_id"]).alias("same_batch_id"),
    )


# -- streams --------------------------------------------------------------------

@register("sink_stream_append")
def _(ws):
    return ws.lakehouse.read(BRONZE_BATCHES).select("sequence_number", "batch_id", "event_date")


@register("stream_chain")
def _(ws):
    return ws.lakehouse.read("silver_order_items").drop("silver_processed_at")


@register("sink_mv_refresh")
def _(ws):
    ws.lakehouse.update_gold()
    return ws.lakehouse.read("gold_daily_delivery_kpis").drop("gold_processed_at")


@register("stream_incremental")
def _(ws):
    """Two arrivals, an update after each: rows the tables hold then."""
    source = ws.folder(f"incremental-{uuid.uuid4().hex[:8]}")
    house = Lakehouse(ws.spark, f"{source}-tables", f"{source}-files")
    states = None
    for arrival in (0, 1):
        ws.deliver(arrival, f"{source}-files")
        house.update_bronze()
        house.run("silver_orders")
        # Written out, so that the next update cannot change what this count sees.
        counted = maintenance.row_counts({
            t: house.read(t) for t in (BRONZE_RAW, BRONZE_BATCHES, "silver_orders")
        }).select(F.lit(arrival).alias("after_arrival"), "table_name", "rows")
        stored = ws.spark.read.parquet(_write_new(ws, counted, "incremental-counts"))
        states = stored if states is None else states.unionByName(stored)
    return states


@register("stream_rerun_idempotent")
def _(ws):
    """Rows after a second update without new files."""
    ws.lakehouse.update_bronze()
    ws.lakehouse.update_silver()
    return maintenance.row_counts({t: ws.lakehouse.read(t) for t in SCHEMAS})


@register("stream_dedup_state")
def _(ws):
    """Dedup by the state store: stored rows and distinct keys per entity, null keys dropped."""
    rules = {e.table: {"has_key": f"{e.key} IS NOT NULL"} for e in ENTITIES.values()}
    house = Lakehouse(
        ws.spark, ws.folder(f"state-{uuid.uuid4().hex[:8]}"), ws.landing, rules=rules, dedup="state")
    house.update_bronze()
    house.run(*rules)
    counts = None
    for entity in ENTITIES.values():
        one = house.read(entity.table).agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col(entity.key)).alias("keys"))
        one = one.select(F.lit(entity.table).alias("table_name"), "rows", "keys")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@register("stream_rejected")
def _(ws):
    """Rows the silver rules refuse, as kept by the streams, and how many rules they break."""
    house = Lakehouse(
        ws.spark, ws.folder(f"rejected-{uuid.uuid4().hex[:8]}"), ws.landing, keep_rejected=True)
    house.update_bronze()
    house.update_silver()
    counts = None
    for table in SILVER:
        one = house.read(rejected(table)).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.array_size("failed_rules")).alias("broken_rules"))
        one = one.select(F.lit(table).alias("table_name"), "rows", "broken_rules")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@register("stream_split_equals_batch")
def _(ws):
    """The feed in many micro-batches whose files interleave in arrival, against the batch form."""
    files = ws.folder(f"interleaved-{uuid.uuid4().hex[:8]}")
    ws.spark.read.parquet(ws.landing).drop("arrival").repartition(12, F.xxhash64("SequenceNumber")).write.parquet(files)
    house = Lakehouse(ws.spark, f"{files}-tables", files, source_options={"maxFilesPerTrigger": "1"}, batch_bytes=1)
    house.update_bronze()
    house.update_silver()
    return _same_content(ws, house)


@register("stream_fail_set")
def _(ws):
    """A rule that the second arrival breaks refuses its micro-batch; mended, the next update stores each row once."""
    files = ws.folder(f"refused-{uuid.uuid4().hex[:8]}")
    strict = {"silver_orders": {"first_arrival": "batch_id IS NULL OR CAST(batch_id AS BIGINT) DIV 8 % 2 = 0"}}
    states = []
    for arrival, refuse, state in ((0, strict, "first"), (1, strict, "refused"), (None, {}, "mended")):
        if arrival is not None:
            ws.deliver(arrival, files)
        house = Lakehouse(ws.spark, f"{files}-tables", files, refuse=refuse)
        house.update_bronze()
        try:
            house.run("silver_orders")
        except StreamingQueryException:
            if state != "refused":
                raise
        counted = maintenance.row_counts({"silver_orders": house.read("silver_orders")}).select(F.lit(state).alias("state"), "rows")
        states.append(ws.spark.read.parquet(_write_new(ws, counted, "refused-counts")))
    return states[0].unionByName(states[1]).unionByName(states[2])


@register("dq_rule_history")
def _(ws):
    """Counts of all micro-batches, as the streams reported and stored them."""
    return rule_totals(rule_history(ws.spark, ws.lakehouse.history.path))


def _stepwise(ws: Workspace, name: str) -> Lakehouse:
    """A lakehouse that was updated after each of the two arrivals."""
    files = ws.folder(f"{name}-{uuid.uuid4().hex[:8]}")
    house = Lakehouse(ws.spark, f"{files}-tables", files)
    for arrival in (0, 1):
        ws.deliver(arrival, files)
        house.update()
    return house


@register("sink_mv_incremental")
def _(ws):
    """Days refreshed where an update touched them, against the whole refresh that the SQL is."""
    return _stepwise(ws, "by-day").read("gold_restaurant_performance").drop("gold_processed_at")


@register("retention_enforced")
def _(ws):
    """What the lakehouse itself still holds once expired days are dropped, and after one more update."""
    house = _stepwise(ws, "expiring")
    for layer, as_of in RETENTION_AS_OF.items():
        run_retention(house, as_of, {t: kept for t, kept in EXPIRES.items() if kept == layer})
    house.update()
    return maintenance.row_counts({t: house.read(t) for t in EXPIRES})


@register("maintenance_then_update")
def _(ws):
    """Compact, update, compact again: rows by the lakehouse, by the catalog and by a view on it."""
    name = f"live_{uuid.uuid4().hex[:8]}"
    files = ws.folder(f"{name}-files")
    house = Lakehouse(ws.spark, ws.folder(name), files)
    ws.spark.sql(f"CREATE SCHEMA {name} LOCATION '{ws.folder(name)}-schema'")
    for arrival in (0, 1):
        ws.deliver(arrival, files)
        house.update()
        run_live_maintenance(house, name)
    run_governance(ws.spark, name, name)
    counts = [maintenance.row_counts({t: read(t) for t in ENTITY_TABLES}).withColumnRenamed("rows", side) for side, read in (
        ("lakehouse_rows", house.read), ("catalog_rows", lambda t: ws.spark.table(f"{name}.{t}")))]
    view = maintenance.row_counts({"silver_clientes": ws.spark.table(f"{name}.vw_clientes_analyst")}).withColumnRenamed(
        "rows", "view_rows")
    return counts[0].join(counts[1], "table_name").join(view, "table_name", "left")


@register("stream_equals_batch")
def _(ws):
    return _same_content(ws, ws.lakehouse)


def _same_content(ws: Workspace, house: Lakehouse) -> DataFrame:
    """Content checksums of the streamed tables next to those of the batch form."""
    batch = ws.silver()

    def checksum(df: DataFrame, name: str, columns: list[str], side: str) -> DataFrame:
        row = F.xxhash64(*columns).cast("decimal(20,0)")
        return df.agg(F.count(F.lit(1)).alias(f"{side}_rows"), F.sum(row).alias(f"{side}_sum")).select(
            F.lit(name).alias("table_name"), f"{side}_rows", f"{side}_sum")

    result = None
    for name, df in batch.items():
        one = checksum(df, name, df.columns, "batch").join(
            checksum(house.read(name), name, df.columns, "stream"), "table_name")
        one = one.select(
            "table_name", "batch_rows", "stream_rows",
            (F.col("batch_sum") == F.col("stream_sum")).alias("same_content"))
        result = one if result is None else result.unionByName(one)
    return result
