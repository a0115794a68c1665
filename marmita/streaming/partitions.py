"""Tables whose rows lie in one folder per day: replacing, packing and dropping whole days."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column that names a row's folder; the data columns are all in the files.
DAY = "day"
#: Name of the folder of rows without a day, as Spark writes it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def in_days(day: Column, days: Iterable[date | None]) -> Column:
    """Rows of these days, None being the days that are null; plain values, so that the scan lists only their folders."""
    days = set(days)
    known = day.isin(sorted(d for d in days if d is not None))
    return known | day.isNull() if None in days else known


def _folder(path: str, day: date | None) -> str:
    return f"{path}/{DAY}={NO_DAY if day is None else day.isoformat()}"


def _status(spark: SparkSession, path: str) -> list:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(system.listStatus(where)) if system.exists(where) else []


def files_of(spark: SparkSession, path: str, day: date | None) -> set[str]:
    """Names of the data files of a day."""
    names = (s.getPath().getName() for s in _status(spark, _folder(path, day)) if s.isFile())
    return {n for n in names if n[0] not in "._"}


def days_of(spark: SparkSession, path: str) -> list[date | None]:
    """The days that a table has folders of, from its listing."""
    names = (s.getPath().getName() for s in _status(spark, path) if s.isDirectory())
    values = sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{DAY}="))
    return [None if v == NO_DAY else date.fromisoformat(v) for v in values]


def bytes_at_once(spark: SparkSession, path: str, checkpoint: str) -> int:
    """Bytes of the table at ``path`` for each micro-batch of the query that wrote it, rounded up; 0 if it has none yet."""
    done = [int(name) for name in (s.getPath().getName() for s in _status(spark, f"{checkpoint}/commits")) if name.isdigit()]
    if not done:
        return 0
    where, log = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}/_spark_metadata"))
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    held = system.getContentSummary(where).getLength() - (system.getContentSummary(log).getLength() if system.exists(log) else 0)
    return -(-held // (max(done) + 1))


def created(spark: SparkSession, note: str, make: bool = False) -> bool:
    """Whether a file ``note`` exists; ``make`` creates it, empty."""
    where = spark._jvm.org.apache.hadoop.fs.Path(note)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.createNewFile(where) if make else system.exists(where)


def drop_days(spark: SparkSession, path: str, days: Iterable[date | None]) -> None:
    """Remove whole days; no row is read or written."""
    for day in days:
        where = spark._jvm.org.apache.hadoop.fs.Path(_folder(path, day))
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def replace_days(rows: DataFrame, path: str, days: Iterable[date | None], fmt: str = "parquet", sort: tuple[str, ...] = ()) -> None:
    """Make ``rows`` (with ``day``) all that the table holds of ``days``; other days are not touched.

    Rows come to the writers by day, large days in several tasks and small ones together.  A day that no longer has rows loses its folder.
    Doing it again gives the same table.
    """
    spark, days = rows.sparkSession, list(days)
    if not days:
        return
    before = {day: files_of(spark, path, day) for day in days}
    (rows.hint("rebalance", F.col(DAY)).sortWithinPartitions(DAY, *sort)
     .write.mode("overwrite").format(fmt).partitionBy(DAY).option("partitionOverwriteMode", "dynamic").save(path))
    drop_days(spark, path, [day for day in days if before[day] and files_of(spark, path, day) == before[day]])
