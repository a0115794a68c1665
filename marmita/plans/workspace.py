"""Tables the registered queries share: the archived feed and the parsed batches.

They are written once per session and input folder, the way the lakehouse
itself stores them; every query then starts from a column-pruned scan instead
of building and parsing the documents again.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marmita.operators import bronze, gold, silver
from marmita.operators.maintenance import settings
from marmita.schemas import Keep, batches_ddl
from marmita.session import let_go, shared_folder, use_utc
from marmita.sources import feed
from marmita.sources.capture import capture_rows, read_capture
from marmita.sources.tables import read_table
from marmita.streaming.runner import Lakehouse
from marmita.tables import BRONZE_BATCHES, SCHEMAS


#: Bytes of stored feed that a task takes, and of a shuffle that becomes documents: both grow many times in the task, so a few large ones would make
#: tasks that outlast all others and sort in memory what does not fit.
SPLIT_BYTES = "16m"
SHUFFLE_BYTES = "8m"


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = shared_folder(spark)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    @cached_property
    def landing(self) -> str:
        """Folder of the archived feed, in two arrivals."""
        path = self.folder("landing")
        arrivals = feed.feed(self.spark, self.sf_dir).withColumn("arrival", F.expr("SequenceNumber div 8 % 2"))
        # Two files are open at once, so that no task sorts its documents by the folder.
        with settings(self.spark, **{"spark.sql.maxConcurrentOutputFileWriters": "2",
                                     "spark.sql.adaptive.advisoryPartitionSizeInBytes": SHUFFLE_BYTES}):
            arrivals.write.partitionBy("arrival").option("compression", "zstd").parquet(path)
        del arrivals
        let_go(self.spark)
        return path

    def raw(self) -> DataFrame:
        return capture_rows(read_capture(self.spark, self.landing))

    @cached_property
    def batches_path(self) -> str:
        path = self.folder(BRONZE_BATCHES)
        raw = self.raw()
        with settings(self.spark, **{"spark.sql.files.maxPartitionBytes": SPLIT_BYTES}):
            bronze.parse_batches(raw).write.option("compression", "zstd").parquet(path)
        return path

    def deliver(self, arrival: int, files: str) -> None:
        """Add the envelopes of one arrival to the folder ``files``; the column comes from the folder name."""
        rows = self.spark.read.parquet(self.landing).filter(F.col("arrival") == arrival).drop("arrival")
        with settings(self.spark, **{"spark.sql.files.maxPartitionBytes": SPLIT_BYTES}):
            rows.write.mode("append").option("compression", "zstd").parquet(files)

    def batches(self, keep: Keep | None = None) -> DataFrame:
        """Parsed batches; ``keep`` limits the scan to some entities and fields."""
        schema = SCHEMAS[BRONZE_BATCHES] if keep is None else batches_ddl(keep)
        return self.spark.read.schema(schema).parquet(self.batches_path)

    def entity_rows(self, entity: silver.Entity) -> DataFrame:
        return silver.entity_rows(self.batches(entity.keep), entity)

    def dimension(self, entity: silver.Entity, validate_first: bool = False) -> DataFrame:
        return silver.dimension(self.batches(entity.keep), entity, validate_first)

    def order_rows(self) -> DataFrame:
        """Orders before their rules, without the product list."""
        return silver.order_rows(self._order_batches(), products=False)

    def orders(self) -> DataFrame:
        return silver.orders(self._order_batches(), products=False)

    def _order_batches(self) -> DataFrame:
        fields = [source for _, source, _ in silver.ORDERS.columns if source != "Produtos"]
        return self.batches({"orders": fields})

    def orders_with_products(self) -> DataFrame:
        return silver.orders(self.batches({"orders": None}))

    def order_item_rows(self) -> DataFrame:
        return silver.order_item_rows(self.orders_with_products())

    def order_items(self) -> DataFrame:
        return silver.order_items(self.orders_with_products())

    def silver(self) -> dict[str, DataFrame]:
        tables = {e.table: self.dimension(e) for e in silver.DEDUPLICATED}
        return tables | {"silver_orders": self.orders(), "silver_order_items": self.order_items()}

    def gold(self) -> dict[str, DataFrame]:
        return {
            "gold_daily_delivery_kpis": gold.daily_kpis(self.orders()),
            "gold_restaurant_performance":
                gold.restaurant_performance(self.orders(), self.dimension(silver.RESTAURANTES)),
            "gold_item_category_metrics": gold.item_category_metrics(self.order_items()),
        }

    @cached_property
    def lakehouse(self) -> Lakehouse:
        """The same feed run through the streams, to the end of its files."""
        house = Lakehouse(self.spark, self.folder("lakehouse"), self.landing)
        house.update()
        return house


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    use_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = Workspace(spark, sf_dir)
    return _open[key]
