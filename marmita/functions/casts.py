"""Casts of untrusted text: a bad value becomes null instead of ending the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two forms in which archives write the enqueue time.
US_TIME_FORMAT = "M/d/yyyy h:mm:ss a"


def bus_timestamp(text: Column) -> Column:
    """Enqueue time: ISO text, or the US 12-hour form some writers use."""
    return F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit(US_TIME_FORMAT)))


def body_text(body: Column) -> Column:
    """Event body bytes as UTF-8 text."""
    return body.cast("binary").cast("string")


def utc_day(ts: Column) -> Column:
    """Calendar day of a timestamp in the session zone, which the jobs pin to UTC."""
    return F.to_date(ts)
