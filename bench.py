"""Seconds per headline query: median of three runs after a warm-up, one JSON line on stdout."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marmita.operators import silver  # noqa: E402
from marmita.plans.queries import REGISTRY  # noqa: E402
from marmita.plans.workspace import Workspace, workspace  # noqa: E402
from marmita.session import build_session  # noqa: E402
from marmita.streaming.runner import Lakehouse  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "bronze_parse", "bronze_batches",
    "silver_clientes", "silver_restaurantes", "silver_drivers", "silver_items",
    "silver_orders", "silver_order_items", "dq_metrics_orders", "dq_quarantine", "ref_integrity",
    "gold_daily_delivery_kpis", "gold_restaurant_performance", "gold_item_category_metrics",
    "layer_row_counts", "layout_clustered", "compact_files",
    "cost_reshape", "cost_detail", "cost_by_resource_daily", "cost_summary_daily",
    "cost_top_resources", "cost_variation_30d", "cost_rolling_7d",
    "gen_batches",
)


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="marmita-bench-")
    spark = build_session("marmita-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    results: dict[str, float] = {}

    # Built once, as the lakehouse stores them; the other queries start from these tables.
    shared = workspace(spark, SF_DIR)
    results["build_feed"] = seconds(lambda: shared.landing)
    results["build_bronze"] = seconds(lambda: shared.batches_path)

    def execute(name: str) -> None:
        REGISTRY[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    for name in HEADLINE:
        execute(name)
        results[name] = statistics.median(seconds(lambda: execute(name)) for _ in range(RUNS))

    def stream_update(_: Workspace = shared) -> Lakehouse:
        house = Lakehouse(spark, shared.folder(f"bench-{time.time_ns()}"), shared.landing)
        house.update()
        return house

    results["stream_update_all_tables"] = seconds(stream_update)
    house = stream_update()
    state = {e.table: house.read(e.table).count() for e in silver.DEDUPLICATED}

    total = round(sum(results.values()), 3)
    print(json.dumps({
        "metric": "total seconds over headline queries",
        "value": total,
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in results.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS),
        "stream_dedup_rows": state,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
