"""Session settings and the shared folder that holds written tables."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "marmita", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides or adds."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Day keys are UTC days, whatever zone the caller's session started with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def let_go(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished steps, so that those of many steps don't add up.

    It deletes them when their plans are collected as garbage, which a driver with memory to spare puts off for as long as it runs.
    """
    gc.collect()
    for _ in range(3):  # what is found is cleaned, then what that held is found
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def shared_folder(spark: SparkSession) -> str:
    """A new folder for this run under the cluster's shared checkpoint directory.

    Only a local-mode session may fall back to a temporary directory, because
    only there is the driver's disk also the executors' disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="marmita-")
    return f"{root.rstrip('/')}/marmita-{uuid.uuid4().hex[:12]}"
