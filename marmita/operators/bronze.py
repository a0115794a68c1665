"""Bronze: the JSON document parsed once, header fields lifted out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marmita.functions.casts import utc_day
from marmita.schemas import Keep, payload_ddl

LINEAGE = (
    "sequence_number", "eventhub_offset", "enqueued_time_utc", "source_file",
    "source_file_modification_time", "bronze_ingestion_time", "ingestion_date",
)


def parse_batches(raw: DataFrame, keep: Keep | None = None) -> DataFrame:
    """One row per event with batch header, ``tables`` struct and the raw text.

    A malformed or null body gives null header and tables; a leaf of the wrong
    type gives a null leaf.  ``keep`` narrows the parse to some entities or
    fields where the caller will not store the result for others.
    """
    source_time = F.col("payload.ingestion_ts").try_cast("timestamp")
    lineage = [name for name in LINEAGE if name in raw.columns]
    tables = [] if keep is not None and not keep else [F.col("payload.tables").alias("tables")]
    return raw.withColumn("payload", F.from_json("body_json", payload_ddl(keep))).select(
        *lineage,
        "payload.batch_id",
        source_time.alias("source_ingestion_ts"),
        utc_day(source_time).alias("event_date"),
        "payload.source_system",
        "payload.schema_version",
        *tables,
        "body_json",
    )
