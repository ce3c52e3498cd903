"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (the full plan
executes, nothing is collected). First every stored layer is built into an empty
folder and timed (``layers``; their sum and the first pass over the queries make
``cold``); then the median of $BENCH_REPS timed runs per query, which read the
layers. The headline value is that warm sum. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortlens.plans.catalog import QUERIES, Layers  # noqa: E402
from cohortlens.session import build_session  # noqa: E402

HEADLINE = ["d01a_fee_pivot", "d01_fee_ledger", "d02_deal_fact", "d10_churn_report", "d11_global_churn_v1",
            "d14_monthly_kpi_cube", "d15_yearly_kpi_cube", "d16_yearly_retained_by_dim", "d20_return_interval"]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(cpus=cpus, app="cohortlens-bench")
    layers, store = {}, Layers(spark, sf_dir, rebuild=True)
    for name in ("obligations", "fee_ledger", "deal_fact", "activity", "dim_scaffold", "account_month"):
        t0 = time.perf_counter()
        store.get(name, **({"n": 12} if name == "account_month" else {}))
        layers[name] = round(time.perf_counter() - t0, 3)
    cold = {name: round(run(spark, name, sf_dir), 3) for name in names}  # and the warm-up of the runs below
    times = {}
    for name in names:
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(reps)), 3)
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "headline_query_time_sum", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "reps": reps, "layers": layers,
                      "cold": round(sum(layers.values()) + sum(cold.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
