"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
Each query is forced with a ``noop`` write (full evaluation, nothing
collected to the driver). ``value`` is the sum of the per-query times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dwspark.plans.registry import all_queries  # noqa: E402
from dwspark.session import get_spark  # noqa: E402

HEADLINE = [
    "h09_fct_ventas",
    "j01_monthly_sales",
    "j02_category_brand",
    "j05_channel_payment",
    "j07_returns_rollup",
    "j11_customer_type",
    "h14_mart_cumplimiento_metas",
    "h15_mart_alertas_inventario",
    "i34_staging_results",
    "i34_singular_results",
    "h19_hechos_vuelos",
    "j29_measures_by_airline",
    "j41_revenue_mom",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = all_queries()
    times: dict[str, float] = {}
    # warm-up: JVM class loading and parquet footer caches, not counted
    qs["h02_dim_sucursal"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for n in names:
        t0 = time.perf_counter()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
