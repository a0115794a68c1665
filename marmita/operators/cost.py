"""Cloud-cost tables: typed detail, daily summary, totals, ranking and variation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

COST = "decimal(18,6)"
RESOURCE_KEYS = (
    "resource_id", "resource_type", "resource_group", "service_name",
    "meter_category", "meter_subcategory",
)
DAY = 86400


def detail(rows: DataFrame, subscription_id: str, audit: bool = False) -> DataFrame:
    """All-text cost rows typed; text that is no date or number becomes null."""
    typed = rows.withColumns({
        "usage_date": F.col("usage_date").try_cast("date"),
        "pretax_cost": F.col("pretax_cost").try_cast(COST),
        "subscription_id": F.lit(subscription_id),
    })
    return typed.withColumn("ingested_at", F.current_timestamp()) if audit else typed


def _total(name: str) -> Column:
    return F.sum("pretax_cost").cast(COST).alias(name)


def by_resource_daily(raw_detail: DataFrame) -> DataFrame:
    """Raw charges summed to one row per day, resource and meter."""
    return raw_detail.groupBy("usage_date", *RESOURCE_KEYS, "currency", "subscription_id").agg(
        _total("pretax_cost"))


def summary_daily(cost_detail: DataFrame, audit: bool = False) -> DataFrame:
    summary = cost_detail.groupBy("usage_date", "resource_group", "service_name", "currency").agg(
        _total("total_cost"),
        F.count_distinct(F.col("resource_id")).alias("resource_count"),
    )
    return summary.withColumn("updated_at", F.current_timestamp()) if audit else summary


def sorted_summary(summary: DataFrame) -> DataFrame:
    """Latest day first, dearest first within it; names settle ties."""
    return summary.orderBy(
        F.desc("usage_date"), F.desc("total_cost"), "resource_group", "service_name", "currency")


def last_day(cost_detail: DataFrame, end: date | None = None) -> Column:
    """The given end day, or the latest day in the data - never the clock."""
    if end is not None:
        return F.lit(end)
    return cost_detail.agg(F.max("usage_date")).scalar()


def look_back(cost_detail: DataFrame, days: int = 30, end: date | None = None) -> DataFrame:
    to = last_day(cost_detail, end)
    return cost_detail.filter(F.col("usage_date").between(F.date_sub(to, days), to))


def total_by(cost_detail: DataFrame, *columns: str) -> DataFrame:
    return cost_detail.groupBy(*columns).agg(_total("total_cost"))


def total_by_each(cost_detail: DataFrame, *columns: str) -> DataFrame:
    """Totals per value of each column, all in one pass over the detail."""
    sets = cost_detail.groupingSets([[F.col(c)] for c in columns], *columns)
    dimension = F.coalesce(*(F.when(F.grouping(c) == 0, F.lit(c)) for c in columns))
    value = F.coalesce(*(F.when(F.grouping(c) == 0, F.col(c)) for c in columns))
    return sets.agg(
        _total("total_cost"), dimension.alias("dimension"), value.alias("dimension_value"),
    ).select("dimension", "dimension_value", "total_cost")


def top_resources(cost_detail: DataFrame, k: int = 10) -> DataFrame:
    """The resources that rank among the ``k`` dearest; equal totals share a rank, so none is cut at the edge.

    Spark limits the ranks per task before the window's shuffle, so its single
    task gets k rows and their ties from each.
    """
    order = Window.orderBy(F.desc_nulls_last("total_cost"))
    ranked = total_by(cost_detail, "resource_id").withColumn("cost_rank", F.rank().over(order))
    return ranked.filter(F.col("cost_rank") <= k)


def variation(cost_detail: DataFrame, days: int, by: str = "service_name",
              end: date | None = None) -> DataFrame:
    """Total of the last ``days`` days against the same span before it.

    ``pct_change`` is null where the earlier span cost nothing.  The latest day
    is an aggregate of its own over that one column, taken at once by a read of its
    own, so that the daily sums of all values never meet in a task.
    """
    if end is None:
        end = cost_detail.agg(F.max("usage_date")).first()[0]
    daily = cost_detail.groupBy(by, "usage_date").agg(F.sum("pretax_cost").alias("cost"))
    dated = daily.withColumn("to", F.lit(end).cast("date"))
    spans = dated.withColumn("age", F.datediff("to", "usage_date")).filter(F.col("age").between(0, 2 * days - 1))

    def span(low: int, high: int, name: str) -> Column:
        inside = F.when(F.col("age").between(low, high), F.col("cost")).otherwise(F.lit(0).cast(COST))
        return F.sum(inside).cast(COST).alias(name)

    change = F.col("current_cost").cast("double") - F.col("previous_cost").cast("double")
    earlier = F.nullif(F.col("previous_cost").cast("double"), F.lit(0.0))
    return spans.groupBy(by).agg(
        span(0, days - 1, "current_cost"), span(days, 2 * days - 1, "previous_cost"),
    ).withColumn("pct_change", F.round(change / earlier, 6))


def rolling(cost_detail: DataFrame, days: int = 7, by: str = "service_name") -> DataFrame:
    """Trailing total over calendar days; the window sees one row per group and day."""
    daily = total_by(cost_detail.filter("usage_date IS NOT NULL"), by, "usage_date")
    trailing = Window.partitionBy(by).orderBy(F.unix_date("usage_date")).rangeBetween(1 - days, 0)
    return daily.withColumn("rolling_cost", F.sum("total_cost").over(trailing).cast(COST))


def write_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Full replace of a catalog table; AQE sizes the files, splitting large and merging small ones."""
    writer = df.hint("rebalance").write.mode("overwrite").format(fmt)
    (writer.option("path", path) if path else writer).saveAsTable(name)
