"""Which row of a key arrived first, remembered in the state store from one micro-batch to the next."""

from __future__ import annotations

from collections.abc import Iterator
from graphlib import TopologicalSorter
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marmita.operators import silver

#: Column of a row that enters the table (1) or leaves it because an earlier arrival takes its key (-1).
CHANGE = "change"
#: Columns that say whose row it is.
TABLE, KEY = "table_name", "entity_key"
#: Column of a row that enters: whether its key had a later arrival until now, whose row has to leave.
TAKES_OVER = "takes_over"


class FirstArrival(StatefulProcessor):
    """Keeps the earliest row of a key and says what that changes.

    ``order`` has, per table, the places of the columns that decide, nulls first.  With ``ttl_ms`` a key is forgotten so long after its last change.
    """

    def __init__(self, schema: T.StructType, order: dict[str, list[int]], ttl_ms: int | None = None):
        self.schema, self.order, self.ttl_ms = schema, order, ttl_ms
        self.names = (*schema.names, CHANGE)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", self.schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        order = self.order[key[0]]
        rank = lambda row: tuple((row[i] is not None, row[i]) for i in order)
        best = min(map(tuple, rows), key=rank)
        known = tuple(self.first.get()) if self.first.exists() else None
        if known is not None and rank(known) <= rank(best):
            return
        self.first.update(best)
        if known is not None:
            yield self.changed(known, -1)
        yield self.changed(best, 1)

    def changed(self, row: tuple, change: int) -> Row:
        return Row(**dict(zip(self.names, (*row, change), strict=True)))

    def close(self) -> None:
        pass


def thinned(rows: DataFrame) -> DataFrame:
    """``rows`` without those that a row of the same Arrow batch, table and key precedes, so that a hot key reaches its task as a row or few per batch.

    Arrivals are the numbers ``silver.ARRIVAL``; rows that tie all stay.
    """
    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.iinfo(np.int64).min
        for batch in batches:
            if batch.num_rows:
                table, key = (batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) for c in (TABLE, KEY))
                arrival = [batch.column(c).cast(pa.int64()).fill_null(least).to_numpy(zero_copy_only=False) for c in silver.ARRIVAL]
                by = np.lexsort((*reversed(arrival), key, table))
                new_key = np.r_[True, (key[by][1:] != key[by][:-1]) | (table[by][1:] != table[by][:-1])]
                first = by[new_key][np.cumsum(new_key) - 1]
                same = np.logical_and.reduce([a[by] == a[first] for a in arrival])
                batch = batch.take(pa.array(np.sort(by[same])))
            yield batch

    return rows.mapInArrow(thin, rows.schema)


def columns_of(entities: tuple[silver.Entity, ...]) -> dict[str, str]:
    """The columns of all entities with their types; those of the same name have the same type."""
    return {name: kind for entity in entities for name, _, kind in entity.columns}


def entity_arrivals(batches: DataFrame, entities: tuple[silver.Entity, ...] = silver.DEDUPLICATED) -> DataFrame:
    """The rows of all ``entities`` of parsed batches in one scan: table, key, arrival, batch and the columns of all, null where a table has none.

    A missing or empty array gives one row of nulls, as in ``silver.entity_rows``.
    """
    columns = columns_of(entities)

    def row(entity: silver.Entity, record: Column, position: Column) -> Column:
        typed = {name: record[source].try_cast(kind) for name, source, kind in entity.columns}
        return F.struct(
            F.lit(entity.table).alias(TABLE), typed[entity.key].alias(KEY), position.cast("int").alias("position"),
            *(typed.get(name, F.lit(None).cast(kind)).alias(name) for name, kind in columns.items()))

    def rows(entity: silver.Entity) -> Column:
        array = F.col(f"tables.{entity.array}")
        return F.when(F.size(array) > 0, F.transform(array, lambda record, i: row(entity, record, i))).otherwise(
            F.array(row(entity, F.try_element_at(array, F.lit(1)), F.lit(None))))

    return batches.select(
        "enqueued_time_utc", "sequence_number", "batch_id", F.explode(F.concat(*map(rows, entities))).alias("row"),
    ).select(f"row.{TABLE}", f"row.{KEY}", "enqueued_time_utc", "sequence_number", "row.position", "batch_id", *(f"row.{c}" for c in columns))


def content_order(entities: tuple[silver.Entity, ...] = silver.DEDUPLICATED) -> list[str]:
    """All columns in an order that sorts the rows of each entity as the order of its own columns does, its key left out."""
    order = TopologicalSorter({name: () for name in columns_of(entities)})
    for entity in entities:
        for before, after in pairwise(n for n in entity.names if n != entity.key):
            order.add(after, before)
    return list(order.static_order())


def new_firsts(rows: DataFrame, entities: tuple[silver.Entity, ...] = silver.DEDUPLICATED) -> DataFrame:
    """For a stream of ``entity_arrivals`` in update mode: the rows that each micro-batch makes the first of their key, with ``takes_over``.

    An aggregation of Spark's own, so a hot key is cut to a row per task before the shuffle and no key visits a Python worker.
    ``seen`` is the time of the micro-batch, the same for all its rows; as the last field of the least row it tells
    whether that row is new, and of equal rows the one seen first stays.
    """
    first = F.struct(*silver.ARRIVAL, "batch_id", *content_order(entities), "seen")
    kept = rows.withColumn("seen", F.current_timestamp()).groupBy(KEY, TABLE).agg(
        F.min(first).alias("first"), F.min("seen").alias("since"), F.max("seen").alias("now"))
    return kept.filter(F.col("first.seen") == F.col("now")).select(
        *(c if c in (TABLE, KEY) else F.col(f"first.{c}").alias(c) for c in rows.columns), (F.col("since") < F.col("now")).alias(TAKES_OVER))


def arrival_changes(rows: DataFrame, entities: tuple[silver.Entity, ...] = silver.DEDUPLICATED, ttl_ms: int | None = None) -> DataFrame:
    """What a stream of ``entity_arrivals`` changes in the first arrivals of each key: such rows with ``change``.

    Added up over all micro-batches, the rows of a table with +1 that no -1 took back are those of ``silver.claims`` over the whole input, however
    it was split.  Times travel as microseconds, so no zone of a worker touches them.
    """
    times = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)]
    plain = thinned(rows.withColumns({c: F.unix_micros(c) for c in times}))
    order = {e.table: [plain.columns.index(c) for c in (*silver.ARRIVAL, "batch_id", *e.names) if c != e.key] for e in entities}
    changed = T.StructType([*plain.schema.fields, T.StructField(CHANGE, T.IntegerType())])
    kept = plain.groupBy(TABLE, KEY).transformWithState(
        FirstArrival(plain.schema, order, ttl_ms), changed, "Append", "ProcessingTime" if ttl_ms else "None")
    return kept.withColumns({c: F.timestamp_micros(c) for c in times})
