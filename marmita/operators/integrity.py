"""Orphan checks between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# child table, its column, parent table, its key
FOREIGN_KEYS = (
    ("silver_orders", "client_id", "silver_clientes", "client_id"),
    ("silver_orders", "merchant_id", "silver_restaurantes", "merchant_id"),
    ("silver_orders", "driver_id", "silver_drivers", "driver_id"),
    ("silver_order_items", "item_id", "silver_items", "item_id"),
    ("silver_items", "merchant_id", "silver_restaurantes", "merchant_id"),
)


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, with the rows they stand for.

    Rows are counted per key before the join, so a key that fills a third of
    the child joins as one row.
    """
    counted = child.groupBy(F.col(column).alias("missing_key")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parent.select(F.col(key).alias("missing_key")), "missing_key", "left_anti")


def orphan_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per foreign key: orphan keys and orphan rows.

    All foreign keys go through one aggregation and one join: each child row
    turns into (foreign key, value) pairs, counted per pair before the join.
    """
    def union(frames: list[DataFrame]) -> DataFrame:
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        return whole

    children, parents = [], []
    for child in dict.fromkeys(fk[0] for fk in FOREIGN_KEYS):
        pairs = [
            F.struct(F.lit(i).alias("fk"), F.col(fk[1]).alias("value"))
            for i, fk in enumerate(FOREIGN_KEYS) if fk[0] == child
        ]
        children.append(tables[child].select(F.inline(F.array(*pairs))))
    for parent in dict.fromkeys(fk[2:] for fk in FOREIGN_KEYS):
        numbers = [F.lit(i) for i, fk in enumerate(FOREIGN_KEYS) if fk[2:] == parent]
        parents.append(tables[parent[0]].select(
            F.explode(F.array(*numbers)).alias("fk"), F.col(parent[1]).alias("value"), F.lit(True).alias("found")))

    counted = union(children).groupBy("fk", "value").agg(F.count(F.lit(1)).alias("rows"))
    missing = F.col("found").isNull()
    per_key = counted.join(union(parents), ["fk", "value"], "left").groupBy("fk").agg(
        F.count_if(missing).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(missing, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
    )

    def name(position: int):
        return F.element_at(F.array(*(F.lit(fk[position]) for fk in FOREIGN_KEYS)), F.col("fk") + 1)

    return per_key.select(
        name(0).alias("child_table"), name(1).alias("child_column"), name(2).alias("parent_table"),
        "orphan_keys", "orphan_rows",
    )
