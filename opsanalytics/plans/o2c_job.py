"""The end-to-end order-to-cash job.

raw exports -> clean + issue log -> cleaned tables written once -> quality gate
(strict runs stop on FAIL) -> reconciliation written once, partitioned by
month -> one result document (KPIs, segments, gate, ROI, texts), exception list
and CSV reports -> run log with per-table counts (also on failure).

Fault tolerance: every stage boundary is a table written to the output folder
(shared storage on a cluster), so later stages read stable inputs instead of
re-running lineage, and a lost executor only re-runs its own tasks.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.operators import clean as cl
from opsanalytics.operators import quality as qa
from opsanalytics.operators import reconcile as rc
from opsanalytics.session import checkpoint_dir
from opsanalytics.sources import files as io


def _parallel(tasks: Mapping[str, object]) -> dict[str, object]:
    """Run independent Spark actions as concurrent jobs (thread per action)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=min(8, max(1, len(tasks)))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def _counts(spark: SparkSession, tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows of each table in one action (scalar subqueries run concurrently)."""
    row = spark.range(1).select(*[df.agg(F.count("*")).scalar().alias(name) for name, df in tables.items()]).first()
    return {name: int(row[name]) for name in tables}


def _persist(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def stored_tables(spark: SparkSession, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Several tables written to the shared checkpoint folder by concurrent jobs and read back."""
    base = f"{checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"
    return _parallel({name: (lambda d=df, n=name: _persist(d, f"{base}/{n}")) for name, df in tables.items()})


@dataclass(frozen=True)
class Settings:
    """What a run may set besides prices and aliases; the defaults are the library's."""

    specs: Mapping[str, qa.TableSpec] | None = None  # by default the library's, with the products that have a price
    window_days: int = rc.SIMULATION_WINDOW_DAYS
    shrinkage_threshold_pct: float = rc.SHRINKAGE_ALERT_THRESHOLD_PCT
    implementation_cost_kes: float = rc.DEFAULT_IMPLEMENTATION_COST_KES
    recovery_rates: Mapping[str, float] = field(default_factory=lambda: rc.RECOVERY_RATES)
    ramp: float = rc.YEAR1_ADOPTION_RAMP_FACTOR
    actions: Mapping[str, str] | None = None
    top_customers: int = 10
    top_exceptions: int = 15


def run_job(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out_dir: str,
    default_prices: Mapping[str, float] = rc.DEFAULT_UNIT_PRICE_KES,
    aliases: Mapping[str, str] = cl.DEPOT_ALIASES,
    strict: bool = True,
    settings: Settings | None = None,
) -> dict[str, object]:
    """Run the job; returns the run record (also appended to ``out_dir/run_log``).

    ``out_dir/result`` holds the result document (:func:`reconcile.result_document`)."""
    use = settings or Settings()
    specs = use.specs or qa.with_allowed(qa.O2C_SPECS, "loading_events", "product", list(default_prices))
    out = out_dir.rstrip("/")
    t0 = time.time()
    record: dict[str, object] = {
        "run_id": uuid.uuid4().hex, "status": "FAILED", "started_at": datetime.now(timezone.utc).replace(tzinfo=None),
        "duration_s": None, "raw_rows": None, "clean_rows": None, "raw_rows_by_table": None, "clean_rows_by_table": None,
        "gate_status": None, "total_leakage_kes": None, "exception_count": None, "error": None, "phase_s": {},
    }
    mark = [time.time()]

    def phase(name: str) -> None:
        now = time.time()
        record["phase_s"][name] = round(now - mark[0], 3)
        mark[0] = now

    def count(which: str, tables: Mapping[str, DataFrame]) -> None:
        record[f"{which}_rows_by_table"] = _counts(spark, tables)
        record[f"{which}_rows"] = sum(record[f"{which}_rows_by_table"].values())

    try:
        count("raw", raw)
        phase("read_count")
        cleaned, issues = cl.clean_all(raw, default_prices, aliases, store=lambda name, df: _persist(df, f"{out}/clean/{name}"))
        issues = _persist(issues.coalesce(1), f"{out}/dq_issues")
        count("clean", cleaned)
        phase("clean")

        report = _persist(qa.quality_gate(cleaned, issues, specs), f"{out}/quality_report")
        record["gate_status"] = qa.gate_status(report).first()["overall_status"]  # also kept when a strict run stops here
        io.write_csv(issues, f"{out}/dq_issues_csv", single_file=True)
        qa.enforce_gate(report, strict=strict)
        phase("gate")

        r = rc.reconcile(cleaned, prices=default_prices, shrinkage_threshold_pct=use.shrinkage_threshold_pct)
        r = r.withColumn("loading_month", F.date_format("loading_ts", "yyyy-MM"))
        # A few files a month: rows are gathered by month and a small salt before the partitioned write.
        r = r.repartition("loading_month", F.pmod(F.xxhash64("loading_id"), F.lit(4)))
        reconciled = _persist(r, f"{out}/reconciled", partition_by=("loading_month",))
        phase("reconcile")

        reports = rc.result_parts(reconciled, cleaned["invoices"], use.window_days, use.top_exceptions, use.actions)
        multi = rc.multi_invoice_rows(cleaned["invoices"])
        parts = _parallel({
            **{name: (lambda d=df, n=name: _persist(d, f"{out}/reports/{n}")) for name, df in reports.items()},
            "_multi_invoice": lambda: io.write_csv(multi, f"{out}/multi_invoice"),
        })
        document = rc.result_document(parts, report, issues, use.implementation_cost_kes, use.recovery_rates, use.ramp, use.top_customers, use.actions)
        roi = rc.compute_roi(parts["summary"], use.implementation_cost_kes, use.recovery_rates, use.ramp)
        _parallel({
            "result": lambda: io.write_json_document(document, f"{out}/result"),
            "summary": lambda: io.write_json_document(parts["summary"], f"{out}/summary"),
            "roi": lambda: io.write_json_document(roi, f"{out}/roi"),
            "alerts": lambda: io.write_csv(parts["alerts"], f"{out}/alerts", single_file=True),
            **{f"by_{c}": (lambda c=c: io.write_csv(parts[f"by_{c}"].orderBy(F.desc("total_leakage_kes"), F.asc(c)), f"{out}/by_{c}",
                                                    single_file=c != "customer")) for c in ("depot", "product", "customer")},
        })
        kpi = parts["summary"].select("total_leakage_kes", "exception_count").first()
        record["total_leakage_kes"], record["exception_count"] = float(kpi[0]), int(kpi[1])
        phase("outputs")
        record["status"] = "SUCCESS"
        return record
    except Exception as exc:  # noqa: BLE001 - the run log records every failure, then re-raises
        record["error"] = f"{type(exc).__name__}: {exc}"
        raise
    finally:
        record["duration_s"] = time.time() - t0
        io.append_run_log(spark, f"{out}/run_log", record)
