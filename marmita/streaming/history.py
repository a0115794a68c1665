"""Rule counts of every micro-batch, appended to a table as the streams report them."""

from __future__ import annotations

import threading
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.window import Window

#: ``rule`` is null in the row of a micro-batch that says how many rows were read and written.
HISTORY_DDL = ("table_name STRING, query STRING, batch_id BIGINT, at TIMESTAMP, rows_read BIGINT, rows BIGINT, rows_kept BIGINT, "
               "rule STRING, passed BIGINT")
#: Rows that wait in the driver at most, before they are written.
WAITING = 5_000


class RuleHistory(StreamingQueryListener):
    """Listens to the queries whose name it was told, adds up their counts and appends them to the table at ``path``.

    Every progress event comes here, however many a query has; nothing is polled.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path, fmt
        self.lock = threading.Lock()
        self.rows: list[tuple] = []
        self.tables: dict[str, str] = {}
        self.progress: dict[str, dict] = {}

    def expect(self, table: str, *names: str) -> None:
        """What queries of these names report are counts of ``table``, from zero on."""
        with self.lock:
            self.tables |= dict.fromkeys(names, table)
            self.progress[table] = {"rows_read": 0, "rules": {}}

    def begun(self, table: str) -> None:
        """New rows of ``table`` were looked at: its counts start at zero rows, also if none of them changes anything."""
        with self.lock:
            if table in self.progress:
                for name in ("rows", "rows_kept"):
                    self.progress[table]["rules"].setdefault(name, 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name not in self.tables:
            return
        counts: dict[str, int] = {}
        for metrics in (progress.observedMetrics or {}).values():
            counts |= metrics.asDict()
        # The id outlives restarts of the query, so a micro-batch that is run again is known as the same.
        self.add(progress.name, str(progress.id), progress.batchId, progress.numInputRows, counts)

    def add(self, name: str, query: str, batch_id: int, rows_read: int, counts: Mapping[str, int]) -> None:
        """Counts of one micro-batch: ``rows``, ``rows_kept`` and one for each rule."""
        now = datetime.now(UTC)
        with self.lock:
            table = self.tables[name]
            whole = self.progress[table]
            whole["rows_read"] += rows_read
            for name, value in counts.items():
                whole["rules"][name] = whole["rules"].get(name, 0) + value
            head = (table, query, batch_id, now, rows_read, counts.get("rows"), counts.get("rows_kept"))
            if rows_read or counts:
                self.rows.append((*head, None, None))
                self.rows += [(*head, name, value) for name, value in counts.items() if name not in ("rows", "rows_kept")]
            full = len(self.rows) >= WAITING
        if full:
            self.flush()

    def flush(self) -> None:
        """Append what is waiting."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, HISTORY_DDL).coalesce(1).write.mode("append").format(self.fmt).save(self.path)

    def settle(self) -> None:
        """Wait for the events that are on their way, then write."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.flush()


def rule_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The stored history, each micro-batch once: one that was run again counts as it ran last."""
    stored = spark.read.format(fmt).schema(HISTORY_DDL).load(path)
    last = Window.partitionBy("table_name", "query", "batch_id", "rule").orderBy(F.col("at").desc())
    return stored.withColumn("turn", F.row_number().over(last)).filter("turn = 1").drop("turn")


def rule_totals(history: DataFrame) -> DataFrame:
    """Rows passed and failed per table and rule, over all micro-batches."""
    return history.filter("rule IS NOT NULL").groupBy("table_name", "rule").agg(
        F.sum("passed").alias("passed"), F.sum(F.col("rows") - F.col("passed")).alias("failed"))
