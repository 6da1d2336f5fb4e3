"""Summarise the physical plans of registered queries (after execution, so AQE's
final plan is shown): exchanges, join strategies, windows, and what reaches each
parquet scan (ReadSchema, PushedFilters).

usage: python tools/plan_report.py [--sf-dir DIR] [name-substring ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsanalytics.plans import registry  # noqa: E402
from opsanalytics.session import get_session  # noqa: E402

DEFAULT = ["r11_reconcile", "a6_kpi_cuts", "a4_leakage_by_customer", "j4_lineitem_orphans", "w3_rolling_features",
           "a29_describe", "m13_roc_auc"]
JOINS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"]


def summary(plan: str) -> dict[str, object]:
    scans = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        line = m.group(0)
        table = re.search(r"/([a-z]+)\.parquet", line)
        cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        scans.append({"table": table.group(1) if table else "?",
                      "columns": len(cols.group(1).split(",")) if cols and cols.group(1) else 0,
                      "pushed": pushed.group(1)[:80] if pushed else ""})
    return {
        "exchanges": plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning"),
        "single_partition_exchanges": plan.count("Exchange SinglePartition"),
        "joins": {j: plan.count(j) for j in JOINS if j in plan},
        "windows": plan.count("Window ["),
        "whole_stage_codegen": len(re.findall(r"WholeStageCodegen|\*\(\d+\)", plan)),
        "scans": scans,
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    registry.load_all()
    spark = get_session("local[8]", shuffle_partitions=8)
    names = [n for n in registry.QUERIES if any(s in n for s in args.names)] if args.names else DEFAULT
    for name in names:
        df = registry.QUERIES[name](spark, args.sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summary(df._jdf.queryExecution().executedPlan().toString())
        print(f"== {name}: exchanges={s['exchanges']} single={s['single_partition_exchanges']} joins={s['joins']} "
              f"windows={s['windows']} codegen_stages={s['whole_stage_codegen']}")
        for sc in s["scans"]:
            print(f"     scan {sc['table']:<10} cols={sc['columns']:<3} pushed=[{sc['pushed']}]")
    spark.stop()


if __name__ == "__main__":
    main()
