"""One triggered update of the lakehouse: bronze and silver as streams, gold refreshed where they changed it.

Each table has its own query, checkpoint and folder, so a rerun continues where
the last one stopped and a lost executor costs only its unfinished tasks.
Streaming tables are written by the file sink, whose log makes reads see each
micro-batch exactly once.  Tables that expire, and those that are refreshed in
part, have a folder per day.

The entity tables keep the first arrival of each key, in one of two ways:

``arrival``  The state store remembers the earliest row of every key.  A stream
             writes down what each micro-batch changes: a new key enters, and a
             key whose earlier arrival shows up later gets that row instead of
             the one it had.  A second stream then makes the days of the table
             anew that have changes, from the changes of those days alone.
             Which row wins depends neither on task timing nor on how the input
             was split into micro-batches, so the table equals its batch form.
``state``    ``dropDuplicates``; within one micro-batch any row of a key may win.

``dedup_horizon`` bounds the state of both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from marmita.functions.casts import utc_day
from marmita.operators import bronze, gold, maintenance, silver
from marmita.operators.governance import tag_columns
from marmita.operators.maintenance import settings
from marmita.operators.quality import Rules, fail_on_violation, keep_valid, passes, passes_all, quarantine, warn
from marmita.rules import RULES
from marmita.schemas import batches_ddl
from marmita.session import let_go
from marmita.sources.capture import capture_rows, stream_capture
from marmita.streaming.first_arrival import CHANGE, KEY, TABLE, TAKES_OVER, arrival_changes, columns_of, entity_arrivals, new_firsts
from marmita.streaming.history import RuleHistory
from marmita.streaming.partitions import DAY, bytes_at_once, created, days_of, files_of, in_days, replace_days
from marmita.tables import BRONZE_BATCHES, BRONZE_RAW, GOLD_TABLES, SCHEMAS

SILVER = tuple(table for table in SCHEMAS if table.startswith("silver_"))
# Followed tables with a folder per day, and what the day is: those that expire.
DAYS = {BRONZE_BATCHES: "coalesce(event_date, ingestion_date)", "silver_orders": "order_date"}
# Gold tables that are refreshed by day, and their day column.
GOLD_DAYS = {"gold_daily_delivery_kpis": "metric_date", "gold_restaurant_performance": "order_date"}
# Name of the stream that all entity tables share.
ENTITIES = "entities"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# How every stream runs.  A commit of the state uploads its changes instead of all of its files; tables of documents are stored small and read in pieces that
# fit a task's memory once decoded.
RUNS = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": "32m",
}
# Tasks per core where a shuffle has no other measure.  A new state gets so many partitions: each is a store of its own that every micro-batch commits, empty or not.
TASKS_PER_CORE = 4
# Stored bytes of raw events that are parsed by a task, and that one day of arrival may bring to a single task.
PARSED_BYTES, DAY_BYTES = 16 * 1024**2, 256 * 1024**2
# The day that a document says it is of, as its text has it.
SAID_DAY = r'"ingestion_ts"\s*:\s*"(\d{4}-\d{2}-\d{2})'


def rejected(table: str) -> str:
    """Name of the table that keeps what ``table`` refuses, with the rules each row breaks."""
    return f"rejected_{table}"


class Lakehouse:
    """Tables below ``root``, fed by the archive at ``source``.

    ``keep_rejected`` also stores the rows the silver rules drop.  ``refuse`` has rules per streaming table that every row must meet: a
    micro-batch with one that doesn't ends the update before it is committed, leaves no row, and is run again by the next update.
    ``grain`` says whether orders and the gold tables have a folder per ``month`` or per ``day`` of the order: what a late order makes
    anew, and what expires at a time.  Other tables have a folder per day of arrival.
    """

    def __init__(self, spark: SparkSession, root: str, source: str, source_format: str = "parquet",
                 table_format: str = "parquet", rules: Mapping[str, Rules] = RULES,
                 validate_first: bool = False, dedup: str = "arrival", dedup_orders: bool = False,
                 dedup_horizon: str | None = None, keep_rejected: bool = False, refuse: Mapping[str, Rules] | None = None,
                 grain: str = "month",
                 batch_bytes: int = 512 * 1024**3,
                 source_options: Mapping[str, str] | None = None):
        if dedup not in ("arrival", "state"):
            raise ValueError(f"dedup is 'arrival' or 'state', not {dedup!r}")
        if keep_rejected and (dedup == "state" or dedup_orders):
            raise ValueError("kept and rejected rows come from one choice of first rows only with dedup='arrival' "
                             "and without dedup_orders")
        self.spark = spark
        self.root = root.rstrip("/")
        self.source = source
        self.source_format = source_format
        self.table_format = table_format
        self.rules = RULES | dict(rules)
        self.validate_first = validate_first
        self.dedup = dedup
        self.dedup_orders = dedup_orders
        self.dedup_horizon = dedup_horizon
        self.keep_rejected = keep_rejected
        # A backfill runs as several micro-batches, so a failure repeats one of them, not all.
        self.batch_bytes = {"maxBytesPerTrigger": str(batch_bytes)}
        self.source_options = dict(source_options or {})
        if not any(option.lower().startswith("max") for option in self.source_options):
            self.source_options |= self.batch_bytes
        if grain not in ("month", "day"):
            raise ValueError(f"grain is 'month' or 'day', not {grain!r}")
        self.refuse, self.grain = dict(refuse or {}), grain
        self.history = RuleHistory(spark, f"{self.root}/history/rules", table_format)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        # Claimed keys are kept for good; off-heap state keeps them out of the executors' JVM heap.
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    @property
    def progress(self) -> dict[str, dict]:
        """Figures of the last update: table -> rows read and rule counts."""
        return self.history.progress

    # -- places ---------------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/checkpoints/{table}"

    @property
    def changes(self) -> str:
        """What each micro-batch changed in the first arrivals of the entities, before their rules; a folder per table, day and micro-batch."""
        return f"{self.root}/first_arrivals"

    def _reader(self, schema: str | None):
        # Retention may have removed what an older log still names.
        reader = self.spark.read.format(self.table_format).option("ignoreMissingFiles", "true")
        return reader.schema(schema) if schema else reader

    def read(self, table: str, schema: str | None = None) -> DataFrame:
        """Batch read with classification tags.

        ``schema`` may narrow a nested table to the fields wanted.
        """
        rows = self._reader(schema or SCHEMAS.get(table)).option("recursiveFileLookup", "true").load(self.path(table))
        return tag_columns(rows, table)

    def by_day(self, table: str) -> DataFrame:
        """Batch read with the column ``day`` that names the folders; a filter on it lists only those of its days."""
        return self._reader(f"{SCHEMAS[table]}, {DAY} DATE").load(self.path(table)).drop("written_in")

    def follow(self, table: str, schema: str | None = None) -> DataFrame:
        """Streaming read of a table written by another query.

        A micro-batch takes what a micro-batch of that query wrote, or more: file by file, a table of many folders would multiply the
        micro-batches from one table to the next.
        """
        at_once = max(int(self.batch_bytes["maxBytesPerTrigger"]), bytes_at_once(self.spark, self.path(table), self.checkpoint(table)))
        return self._follow(self.path(table), schema or SCHEMAS[table], maxBytesPerTrigger=str(at_once))

    def _follow(self, path: str, schema: str, **options: str) -> DataFrame:
        return (
            self.spark.readStream.format(self.table_format).schema(schema)
            .option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").options(**options).load(path)
        )

    # -- streams --------------------------------------------------------------

    def _append(self, table: str, df: DataFrame) -> StreamingQuery:
        if table == "silver_orders":
            return self._by_day(table, df)
        return self._appended(table, df, self.path(table), F.expr(DAYS[table]) if table in DAYS else None)

    def _folder(self, day: Column) -> Column:
        """The first day of the folder that holds a day of orders."""
        return F.trunc(day, "month") if self.grain == "month" else day

    def ends(self, table: str, folder: date) -> date:
        """The first day that is too late for a folder of a table."""
        if self.grain == "month" and table in (*GOLD_DAYS, "silver_orders"):
            return date(folder.year + folder.month // 12, folder.month % 12 + 1, 1)
        return folder + timedelta(days=1)

    def _by_day(self, table: str, df: DataFrame) -> StreamingQuery:
        """Rows that belong to many days at once come to the writers by day: few files a day, several for a large one.

        Safe to repeat: a micro-batch replaces only its own folder in each day.
        """
        def write_batch(batch: DataFrame, number: int) -> None:
            rows = batch.withColumns({DAY: self._folder(F.expr(DAYS[table])), "written_in": F.lit(number)})
            with settings(batch.sparkSession, **{"spark.sql.adaptive.enabled": "true"}):
                (rows.hint("rebalance", F.col(DAY)).sortWithinPartitions(DAY, *maintenance.CLUSTER_KEYS[table])
                 .write.mode("overwrite").format(self.table_format).partitionBy(DAY, "written_in")
                 .option("partitionOverwriteMode", "dynamic").save(self.path(table)))

        return self._start(table, df.writeStream.foreachBatch(write_batch))

    def _appended(self, table: str, df: DataFrame, path: str, day: Column | None = None) -> StreamingQuery:
        writer = (df if day is None else df.withColumn(DAY, day)).writeStream.format(self.table_format).outputMode("append")
        if day is not None:
            writer = writer.partitionBy(DAY)
        if self.table_format == "parquet":  # the sink does not see the settings that the stream runs with
            writer = writer.option("compression", RUNS["spark.sql.parquet.compression.codec"])
        return self._start(table, writer.option("path", path))

    def _start(self, name: str, writer: DataStreamWriter) -> StreamingQuery:
        """Start a query that ends when all available input is read; what it reports is counted under its name."""
        writer = writer.queryName(self._query(name)).option("checkpointLocation", self.checkpoint(name))
        cores = self.spark.sparkContext.defaultParallelism
        with settings(self.spark, **RUNS, **({
            "spark.sql.shuffle.partitions": str(min(TASKS_PER_CORE * cores, int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        } if self._has_state(name) else {})):
            return writer.trigger(availableNow=True).start()

    def _has_state(self, name: str) -> bool:
        """Whether a stream remembers keys; how many partitions its state has is settled with its first micro-batch."""
        keyed = [ENTITIES] if self.dedup == "arrival" else [e.table for e in silver.DEDUPLICATED]
        return name in keyed or (self.dedup_orders and name == "silver_orders")

    def _query(self, name: str) -> str:
        return f"{name} {self.root}"

    def _track_arrivals(self) -> StreamingQuery:
        """The arrivals of all entities: one scan, one state."""
        keep = {e.array: e.keep[e.array] for e in silver.DEDUPLICATED}
        rows = entity_arrivals(self.follow(BRONZE_BATCHES, batches_ddl(keep)))
        if self.validate_first:
            rows = rows.filter(self._meets(self.rules))
        if any(e.table in self.refuse for e in silver.DEDUPLICATED):
            rows = fail_on_violation(rows, {"refused": self._meets(self.refuse)})
        horizon = self._horizon_ms()
        changed = new_firsts(rows) if horizon is None else arrival_changes(rows, ttl_ms=horizon)
        writer = changed.withColumn(DAY, utc_day(F.col(silver.ARRIVAL[0]))).writeStream.outputMode("update" if horizon is None else "append")
        # With a horizon Spark asks for one more micro-batch after each, so that the update would never end; keys expire with the next data.
        with settings(self.spark, **({} if horizon is None else {"spark.sql.streaming.noDataMicroBatches.enabled": "false"})):
            return self._start(ENTITIES, writer.foreachBatch(self._log_changes))

    def _log_changes(self, batch: DataFrame, number: int) -> None:
        """Write down the rows that enter with a micro-batch, in the folders numbered twice its number, and those that leave in the next ones.

        The rows that enter are written in one action, which is the one that moves the state on.  Only if some take a key over are the rows
        that they replace looked up, in what earlier micro-batches wrote of the days since.  Safe to repeat.
        """
        done = f"{self.changes}/_written/{number}"
        if created(self.spark, done):
            batch.write.format("noop").mode("append").save()  # the state still has to follow
            return
        entering = batch if CHANGE in batch.columns else batch.withColumn(CHANGE, F.lit(1))
        with settings(batch.sparkSession, **{"spark.sql.adaptive.enabled": "true"}):
            self._log(entering, 2 * number)
        if TAKES_OVER in batch.columns:
            held = f"{batch.drop(DAY, TABLE, TAKES_OVER)._jdf.schema().toDDL()}, {CHANGE} INT"
            log = self._change_log(f"{held}, {TAKES_OVER} BOOLEAN")
            taken = log.filter((F.col("written_in") == 2 * number) & F.col(TAKES_OVER))
            since = taken.groupBy(TABLE).agg(F.min(DAY).alias("day"), F.bool_or(F.col(DAY).isNull()).alias("undated")).collect()  # a row per table
            if since:
                before = log.filter((F.col("written_in") < 2 * number) & (F.col(CHANGE) == 1) & reduce(or_, (
                    (F.col(TABLE) == s[TABLE]) & (F.lit(True) if s.undated else F.col(DAY) >= F.lit(s.day)) for s in since)))
                keys = taken.select(F.col(TABLE).alias("its_table"), F.col(KEY).alias("its_key"))
                row = F.struct(*(c for c in before.columns if c not in (TABLE, KEY)))
                last = before.join(keys, (F.col(TABLE) == F.col("its_table")) & F.col(KEY).eqNullSafe(F.col("its_key")), "left_semi").groupBy(
                    TABLE, KEY).agg(F.max_by(row, "written_in").alias("row")).select(TABLE, KEY, "row.*")
                self._log(last.drop("written_in").withColumns({CHANGE: F.lit(-1), TAKES_OVER: F.lit(False)}), 2 * number + 1)
        created(self.spark, done, make=True)
        for entity in silver.DEDUPLICATED:
            self.history.begun(entity.table)

    def _log(self, rows: DataFrame, written_in: int) -> None:
        (rows.withColumn("written_in", F.lit(written_in)).hint("rebalance", F.col(TABLE), F.col(DAY)).sortWithinPartitions(TABLE, DAY)
         .write.mode("overwrite").format(self.table_format).partitionBy(TABLE, DAY, "written_in")
         .option("partitionOverwriteMode", "dynamic").save(self.changes))

    def _change_log(self, schema: str) -> DataFrame:
        return self._reader(f"{schema}, {TABLE} STRING, {DAY} DATE, written_in INT").load(self.changes)

    def _meets(self, rules: Mapping[str, Rules]) -> Column:
        """Whether a row of several tables meets the rules of its own."""
        return F.coalesce(*(F.when(F.col(TABLE) == e.table, passes_all(rules.get(e.table, {}))) for e in silver.DEDUPLICATED))

    def _horizon_ms(self) -> int | None:
        if not self.dedup_horizon:
            return None
        end = F.expr(f"unix_millis(TIMESTAMP'1970-01-01' + INTERVAL {self.dedup_horizon})")
        return self.spark.range(1).select(end).first()[0]

    def _settle(self) -> StreamingQuery:
        """Make the days of the entity tables anew that have new changes, each from the changes of that day."""
        held = {**columns_of(silver.DEDUPLICATED), "batch_id": "string"}
        logged = ", ".join((silver.ARRIVAL_DDL, *(f"{name} {kind}" for name, kind in held.items()), f"{CHANGE} INT"))
        def write_batch(batch: DataFrame, number: int) -> None:
            counted = {"rows": F.lit(True), "rows_kept": self._meets(self.rules)}
            counted |= {f"{e.table} {name}": passes(rule) for e in silver.DEDUPLICATED for name, rule in self.rules[e.table].items()}
            seen = batch.groupBy(TABLE).agg(
                *(F.sum(F.when(holds, F.col(CHANGE)).otherwise(0)).alias(name) for name, holds in counted.items()),
                F.collect_set(DAY).alias("days"), F.bool_or(F.col(DAY).isNull()).alias("undated")).collect()  # a row per table, an entry per day
            for found in seen:
                self._replace_entity_days(found[TABLE], [*found.days, *([None] if found.undated else [])], logged)
                counts = {"rows": found.rows, "rows_kept": found.rows_kept} | {n: found[f"{found[TABLE]} {n}"] for n in self.rules[found[TABLE]]}
                self.history.add(f"{found[TABLE]}-days", f"{found[TABLE]}-days", number, 0, counts)

        return self._start(f"{ENTITIES}-days", self._follow_changes(logged).writeStream.foreachBatch(write_batch))

    def _follow_changes(self, schema: str) -> DataFrame:
        reader = self.spark.readStream.format(self.table_format).schema(f"{schema}, {TABLE} STRING, {DAY} DATE, written_in INT")
        return reader.option("ignoreMissingFiles", "true").load(self.changes)

    def _replace_entity_days(self, table: str, days: list[date | None], schema: str) -> None:
        rules = self.rules[table]
        columns = [c.split(" ")[0] for c in SCHEMAS[table].split(", ")][:-1]
        log = self._change_log(schema).filter((F.col(TABLE) == table) & in_days(F.col(DAY), days))
        first = (log.groupBy(*silver.ARRIVAL, *columns, DAY).agg(F.sum(CHANGE).alias(CHANGE)).filter(F.col(CHANGE) > 0)
                 .select(*columns, DAY))
        replace_days(silver.stamped(keep_valid(first, rules)), self.path(table), days, self.table_format)
        if self.keep_rejected:
            replace_days(silver.stamped(quarantine(first, rules)), self.path(rejected(table)), days, self.table_format)

    def _finish(self, start: Mapping[str, Callable[[], StreamingQuery]]) -> None:
        """Run queries side by side to their end, with their reports going to the history; the first failure is raised after the others ended."""
        query = failure = None
        self.spark.streams.addListener(self.history)
        try:
            for query in [begin() for begin in start.values()]:
                try:
                    query.awaitTermination()
                except Exception as error:  # noqa: BLE001 - re-raised below
                    failure = failure or error
            self.history.settle()
        finally:
            self.spark.streams.removeListener(self.history)
            del query  # holds the plan of its last micro-batch
            let_go(self.spark)
        if failure:
            raise failure

    def _streams(self) -> dict[str, Callable[[], StreamingQuery]]:
        """How to start the stream of each table."""
        built = {BRONZE_RAW: self.bronze_raw, BRONZE_BATCHES: self.bronze_batches}
        claimed = {e.table: e for e in silver.DEDUPLICATED} if self.dedup == "arrival" else {}
        for table in SILVER:
            if table not in claimed:
                built[table] = lambda t=table: self.checked(t)
                built[rejected(table)] = lambda t=table: self.refused(t)
        return {table: (lambda t=table, b=build: self._append(t, b())) for table, build in built.items()}

    def run(self, *tables: str) -> None:
        """Bring these tables up to date side by side; they must not feed each other.

        With ``dedup="arrival"`` the entity tables share a stream, so one of them brings all of them up to date.
        """
        streams = self._streams()
        entities = [e.table for e in silver.DEDUPLICATED if e.table not in streams]
        shared = any(t in entities for t in tables)
        wanted = [t for t in tables if t not in entities]
        if self.keep_rejected:
            wanted += [rejected(t) for t in tables if rejected(t) in streams]
        for table in (*wanted, *(entities if shared else ())):
            self.history.expect(table, self._query(table), f"{table}-days")
        if shared:
            self.history.expect(ENTITIES, self._query(ENTITIES))
        start = {table: streams[table] for table in wanted}
        self._finish(start | ({ENTITIES: self._track_arrivals} if shared else {}))
        if shared:
            self._finish({ENTITIES: self._settle})

    def bronze_raw(self) -> DataFrame:
        return capture_rows(
            stream_capture(self.spark, self.source, self.source_format, **self.source_options))

    def bronze_batches(self) -> DataFrame:
        parsed = self._refusing(BRONZE_BATCHES, bronze.parse_batches(self._gathered(self.follow(BRONZE_RAW))))
        return warn(parsed, self.rules[BRONZE_BATCHES], "rules")

    def _gathered(self, raw: DataFrame) -> DataFrame:
        """The same rows with those of a day in few tasks: else every task writes a file for every day, and files grow as tasks times days.

        Texts travel before they are parsed, which about halves them.  What their text says of the day only decides where they are parsed; no day, however many
        rows it has, brings a task more than about ``DAY_BYTES``.
        """
        at_once = bytes_at_once(self.spark, self.path(BRONZE_RAW), self.checkpoint(BRONZE_RAW))
        tasks = max(TASKS_PER_CORE * self.spark.sparkContext.defaultParallelism, -(-at_once // PARSED_BYTES))
        parts = max(1, -(-at_once // DAY_BYTES))
        said = F.coalesce(F.regexp_extract("body_json", SAID_DAY, 1), F.lit(""))
        return raw.repartition(tasks, said, F.pmod(F.xxhash64("sequence_number", "eventhub_offset"), F.lit(parts)))

    def unchecked(self, table: str) -> DataFrame:
        """A silver table's streaming rows before its rules; claimed keys are in the state store."""
        if table == "silver_orders":
            batches = self.follow(BRONZE_BATCHES, batches_ddl({"orders": None}))
            return silver.orders(batches, rules={}, dedup_orders=self.dedup_orders)
        if table == "silver_order_items":
            return silver.order_item_rows(self.follow("silver_orders"))
        entity = next(e for e in silver.DEDUPLICATED if e.table == table)
        batches = self.follow(BRONZE_BATCHES, batches_ddl(entity.keep))
        first_valid = self.rules[table] if self.validate_first else {}
        return silver.dimension(batches, entity, self.validate_first, first_valid, self.dedup_horizon)

    def checked(self, table: str) -> DataFrame:
        rules = self.rules[table]
        return silver.stamped(keep_valid(warn(self._refusing(table, self.unchecked(table)), rules, "rules"), rules))

    def _refusing(self, table: str, rows: DataFrame) -> DataFrame:
        """``rows`` before any rule drops some, ending the micro-batch at one that the table refuses."""
        return fail_on_violation(rows, self.refuse[table]) if table in self.refuse else rows

    def refused(self, table: str) -> DataFrame:
        return silver.stamped(quarantine(self.unchecked(table), self.rules[table]))

    def update_bronze(self) -> None:
        self.run(BRONZE_RAW)
        self.run(BRONZE_BATCHES)

    def update_silver(self) -> None:
        """The five entity streams run side by side; order items follow the orders."""
        self.run(*(e.table for e in silver.DEDUPLICATED), "silver_orders")
        self.run("silver_order_items")

    # -- gold -----------------------------------------------------------------

    def gold(self, table: str, days: Iterable[date | None] | None = None) -> DataFrame:
        """A gold table as defined by the current silver tables, or what it holds of some days."""
        orders = self.read("silver_orders") if days is None else self.by_day("silver_orders").filter(in_days(F.col(DAY), days)).drop(DAY)
        if table == "gold_daily_delivery_kpis":
            return gold.daily_kpis(orders)
        if table == "gold_restaurant_performance":
            return gold.restaurant_performance(orders, self.read("silver_restaurantes"))
        if table == "gold_item_category_metrics":
            return gold.item_category_metrics(self.read("silver_order_items"))
        raise KeyError(table)

    def refresh_days(self, table: str, days: Iterable[date | None]) -> None:
        """Make these folders of a gold table anew from the orders of the same folders."""
        days = list(days)
        rows = gold.stamped(self.gold(table, days)).withColumn(DAY, self._folder(F.col(GOLD_DAYS[table])))
        replace_days(rows, self.path(table), days, self.table_format, maintenance.CLUSTER_KEYS.get(table, ()))

    def _refresh_changed(self, table: str) -> StreamingQuery:
        """Refresh the days, or months, that new orders belong to; a late one corrects its own."""
        def write_batch(batch: DataFrame, _: int) -> None:
            self.refresh_days(table, [row[0] for row in batch.select(self._folder(F.col("order_date"))).distinct().collect()])  # a row per folder

        return self._start(table, self._follow(self.path("silver_orders"), SCHEMAS["silver_orders"]).writeStream.foreachBatch(write_batch))

    def _refresh_renamed(self) -> StreamingQuery:
        """Refresh the days that have a restaurant whose row is new or another one; days that hold no such restaurant stay."""
        table = "gold_restaurant_performance"

        def write_batch(batch: DataFrame, _: int) -> None:
            if not days_of(self.spark, self.path(table)):
                return
            stored = self.spark.read.format(self.table_format).load(self.path(table))
            changed = batch.select(F.col("merchant_id").alias("restaurant_id")).distinct()
            self.refresh_days(table, [row[0] for row in stored.join(changed, "restaurant_id", "left_semi").select(DAY).distinct().collect()])

        if self.dedup == "arrival":
            changes = self._follow_changes("merchant_id STRING").filter(F.col(TABLE) == "silver_restaurantes")
        else:
            changes = self.follow("silver_restaurantes")
        return self._start(f"{table}-names", changes.writeStream.foreachBatch(write_batch))

    def update_gold(self) -> None:
        """Days with new orders are refreshed, and days with a restaurant that changed; the category table, which has no days, as a whole."""
        self._finish({"names": self._refresh_renamed})
        self._finish({table: (lambda t=table: self._refresh_changed(t)) for table in GOLD_DAYS})
        self._overwrite("gold_item_category_metrics", gold.stamped(self.gold("gold_item_category_metrics")))

    def _overwrite(self, table: str, rows: DataFrame) -> None:
        rows.hint("rebalance").write.mode("overwrite").format(self.table_format).save(self.path(table))

    def compact(self, table: str) -> list[date | None]:
        """Rewrite the days of a table that consist of several files, as few files; returns them.

        Tables of the file sink are left alone: streams follow their files, which
        must not come a second time.
        """
        if table not in (*GOLD_DAYS, *(e.table for e in silver.DEDUPLICATED)) or (self.dedup != "arrival" and table not in GOLD_DAYS):
            raise ValueError(f"{table} is written by the file sink and followed by streams; its files stay as they are")
        path = self.path(table)
        several = [day for day in days_of(self.spark, path) if len(files_of(self.spark, path, day)) > 1]
        if several:
            stored = self._reader(f"{SCHEMAS[table]}, {DAY} DATE" if table in SCHEMAS else None).load(path)
            replace_days(stored.filter(in_days(F.col(DAY), several)), path, several, self.table_format, maintenance.CLUSTER_KEYS.get(table, ()))
        return several

    def update(self) -> None:
        self.update_bronze()
        self.update_silver()
        self.update_gold()

    def register(self, schema: str = "default") -> None:
        """Catalog tables over the current folders, for SQL users and views; to be repeated after updates and maintenance."""
        for table in (*SCHEMAS, *GOLD_TABLES):
            columns = f"({SCHEMAS[table]}) " if table in SCHEMAS else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {schema}.{table} {columns}USING {self.table_format} "
                f"OPTIONS (recursiveFileLookup 'true') LOCATION '{self.path(table)}'")
            self.spark.sql(f"ALTER TABLE {schema}.{table} SET LOCATION '{self.path(table)}'")
            self.spark.catalog.refreshTable(f"{schema}.{table}")
