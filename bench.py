"""Headline-query benchmark: prints ONE JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)

Each query is executed to completion with the ``noop`` sink (full
computation, no collect to the driver); the session start is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from opsanalytics.plans import registry  # noqa: E402
from opsanalytics.session import checkpoint_dir, get_session  # noqa: E402

HEADLINE = [
    "r15_clean_reconcile_by_depot",  # raw strings -> clean -> reconcile -> summary (first: nothing cached)
    "r11_reconcile",            # full O2C chain: 3 aggregations, 2 joins, 5 categories
    "a6_kpi_cuts",              # filtered KPI bundle, grouping sets in one scan
    "a4_leakage_by_customer",   # group summary over the reconciled table
    "q4_gate_status",           # clean raw exports + schema/FK/threshold gate
    "j4_lineitem_orphans",      # anti join on the largest table
    "w3_rolling_features",      # skew-proof per-entity rolling windows
    "w5_interpolate_linear",    # spine + interpolation
    "a29_describe",             # exact percentiles per group
    "t1_pearson",               # correlation + t statistic
    "m12_threshold_sweep",      # score-bin sweep
    "m13_roc_auc",              # rank-sum AUC
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", app_name="opsanalytics-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    registry.load_all()
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed
    times: dict[str, float] = {}
    extra: dict[str, object] = {}
    # The reference's job, like for like: raw CSV exports (landed once, untimed)
    # -> read as strings -> clean -> gate -> reconcile -> write every output + run log.
    from opsanalytics.plans.driver_tables import PRIORITY_ALIASES, SEGMENT_PRICES, o2c_raw_exports
    from opsanalytics.plans.o2c_job import run_job
    from opsanalytics.sources import files as io

    base = f"{checkpoint_dir(spark)}/bench-{int(time.time())}"
    columns = {}
    for name, df in o2c_raw_exports(spark, sf_dir).items():
        columns[name] = [c for c in df.columns if c != "_row"]
        df.orderBy("_row").select(*columns[name]).write.mode("overwrite").option("header", True).csv(f"{base}/raw/{name}")
    t0 = time.time()
    raw = {n: io.read_raw_csv(spark, f"{base}/raw/{n}", cols) for n, cols in columns.items()}
    rec = run_job(spark, raw, f"{base}/out", default_prices=SEGMENT_PRICES, aliases=PRIORITY_ALIASES, strict=False)
    times["o2c_job_csv"] = round(time.time() - t0, 3)
    extra["o2c_job_source_rows"] = rec["raw_rows"]
    extra["o2c_job_rows_per_sec"] = round(rec["raw_rows"] / times["o2c_job_csv"], 1)
    extra["o2c_job_phase_s"] = rec["phase_s"]
    for name in HEADLINE:
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, **extra}))
    spark.stop()


if __name__ == "__main__":
    main()
