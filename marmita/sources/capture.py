"""Archived event files: one envelope row per event, read once per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marmita.functions.casts import body_text, bus_timestamp
from marmita.schemas import ENVELOPE_DDL

# Envelope and file attributes under the names of our raw table, in its order.
BUS_FIELDS = {
    "SequenceNumber": "sequence_number",
    "Offset": "eventhub_offset",
    "EnqueuedTimeUtc": "enqueued_time_utc",
    "SystemProperties": "system_properties",
    "Properties": "event_properties",
    "Body": "body_json",
}
FILE_FIELDS = {
    "file_path": "source_file",
    "file_modification_time": "source_file_modification_time",
}

# {namespace}/{hub}/{partition}/{year}/{month}/{day}/{hour}/{minute}/{second}.{extension}
CAPTURE_PATH = r"([^/]+)/([^/]+)/(\d+)/(\d{4})/(\d{2})/(\d{2})/(\d{2})/(\d{2})/(\d{2})[^/]*$"


def read_capture(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Batch read of every archived file below ``path``."""
    return (
        spark.read.format(fmt).schema(ENVELOPE_DDL)
        .option("recursiveFileLookup", "true").options(**options).load(path)
    )


def stream_capture(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Streaming read: each new file below ``path`` is processed once.

    ``fmt`` may be ``avro`` where Spark's Avro module is on the classpath.
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` in ``options`` bounds a micro-batch.
    """
    return (
        spark.readStream.format(fmt).schema(ENVELOPE_DDL)
        .option("recursiveFileLookup", "true").options(**options).load(path)
    )


def capture_rows(envelopes: DataFrame, audit: bool = True) -> DataFrame:
    """Envelope projection: bus fields, decoded body, file lineage and ingestion time."""
    bus = {ours: F.col(theirs) for theirs, ours in BUS_FIELDS.items()}
    bus["enqueued_time_utc"] = bus_timestamp(bus["enqueued_time_utc"])
    bus["body_json"] = body_text(bus["body_json"])
    lineage = {ours: F.col(f"_metadata.{theirs}") for theirs, ours in FILE_FIELDS.items()}
    ingestion = {"bronze_ingestion_time": F.current_timestamp(), "ingestion_date": F.current_date()}
    columns = bus | lineage | (ingestion if audit else {})
    return envelopes.select(*(column.alias(name) for name, column in columns.items()))


def path_attributes(path: Column) -> dict[str, Column]:
    """Namespace, hub, partition and capture time spelled out in an archive path.

    Null where the path does not have that layout.
    """
    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(path, CAPTURE_PATH, group), F.lit(""))

    digits = [part(i).cast("int") for i in range(4, 10)]
    return {
        "namespace": part(1),
        "event_hub": part(2),
        "partition_id": part(3).try_cast("int"),
        "captured_at": F.try_make_timestamp(*digits),
    }
