"""Layout, compaction, retention and counts of stored tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Days kept per layer, and clustering keys per table.
RETENTION_DAYS = {"bronze": 90, "silver": 180, "gold": 365}
CLUSTER_KEYS = {
    "silver_orders": ("order_date", "restaurant_id"),
    "gold_daily_delivery_kpis": ("metric_date",),
    "gold_restaurant_performance": ("restaurant_id",),
}
TARGET_FILE_BYTES = 256 * 1024 * 1024


def retained(df: DataFrame, layer: str, day: str, as_of: date | str,
             days: Mapping[str, int] = RETENTION_DAYS, arrived: str | None = None) -> DataFrame:
    """Rows young enough for their layer on ``as_of``.

    A row without a day is as old as its ``arrived`` day: an unparsable body
    expires too.  Without either it stays.
    """
    oldest = F.date_sub(F.lit(as_of).cast("date"), days[layer])
    kept = F.col(day) >= oldest
    undated = F.col(day).isNull()
    if arrived:
        undated = undated & (F.col(arrived).isNull() | (F.col(arrived) >= oldest))
    return df.filter(kept | undated)


def rewrite_retained(spark: SparkSession, source: str, target: str, layer: str, day: str,
                     as_of: date | str, fmt: str = "parquet",
                     days: Mapping[str, int] = RETENTION_DAYS, arrived: str | None = None) -> DataFrame:
    """Store the rows still to be kept in a new folder; no shuffle, the day filter reaches the scan."""
    kept = retained(spark.read.format(fmt).option("recursiveFileLookup", "true").load(source), layer, day, as_of, days,
                    arrived)
    kept.write.format(fmt).mode("errorifexists").save(target)
    return spark.read.format(fmt).load(target)


def clustered(df: DataFrame, keys: tuple[str, ...], files: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by ``keys``, so parquet statistics skip files.

    The last key, a hash of the row, lets one key value spread over several
    ranges: a restaurant with a third of all rows does not become one task and
    one file.  It depends on the row alone, so a task that is run again sends
    its rows to the same ranges.
    """
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    ranges = [*(F.col(k) for k in keys), F.xxhash64(*hashable)]
    spread = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    return spread.sortWithinPartitions(*keys)


def file_stats(df: DataFrame) -> DataFrame:
    """Files behind a table read, their bytes and rows."""
    per_file = df.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"), F.sum("rows").alias("rows"))


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """These session settings within the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def compact(spark: SparkSession, source: str, target: str, fmt: str = "parquet",
            target_bytes: int = TARGET_FILE_BYTES, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rewrite many small files as few large ones in a new folder.

    The scan itself packs small files into one task up to ``target_bytes``, and
    each task writes one file: no shuffle.  With ``keys`` the rows are clustered
    by them instead, which takes a range shuffle.  The old folder stays
    untouched, so readers switch over (see :func:`swap_location`) only once all
    is written.
    """
    with settings(spark, **{
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }):
        whole = spark.read.format(fmt).option("recursiveFileLookup", "true").load(source)
        rewritten = clustered(whole, keys) if keys else whole
        rewritten.write.format(fmt).mode("errorifexists").save(target)
    return spark.read.format(fmt).load(target)


def swap_location(spark: SparkSession, table: str, target: str) -> None:
    """Point a catalog table at its rewritten folder in one metadata step."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
    spark.catalog.refreshTable(table)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, as one query."""
    result = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        result = one if result is None else result.unionByName(one)
    return result
