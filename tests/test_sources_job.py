"""Sources, sinks, the end-to-end job and the driver contract."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from opsanalytics.operators.quality import DataQualityGateError
from opsanalytics.plans import o2c_job
from opsanalytics.plans.driver_tables import PRIORITY_ALIASES, SEGMENT_PRICES, o2c_raw_exports
from opsanalytics.sources import files as io
from opsanalytics.sources import payloads as pl

SF = "/root/testdata/sf0.001"

TABLE_HTML = """<html><body><table><tr><th>trade_date</th><th>brent_usd_bbl</th></tr>
<tr><td>2026-06-01</td><td>82.4</td></tr><tr><td>2026-06-02</td><td><b>83.1</b></td></tr></table></body></html>"""


def test_html_table_records(spark):
    df = spark.createDataFrame([(1, TABLE_HTML)], "page_id int, html string")
    recs = pl.html_table_records(df, "html", keep=["page_id"]).orderBy("row_no").collect()
    assert [r["record"] for r in recs] == [{"trade_date": "2026-06-01", "brent_usd_bbl": "82.4"},
                                           {"trade_date": "2026-06-02", "brent_usd_bbl": "83.1"}]


def test_parallel_arrays_and_records(spark):
    body = '{"hourly": {"time": ["t0", "t1"], "precipitation": [0.0, 1.5], "temperature_2m": [20.1, null]}}'
    df = spark.createDataFrame([(body,)], "payload string")
    rows = pl.explode_parallel_arrays(df, "payload", "time", ["precipitation", "temperature_2m"]).collect()
    assert [(r["time"], r["precipitation"], r["temperature_2m"]) for r in rows] == [("t0", 0.0, 20.1), ("t1", 1.5, None)]
    rec = spark.createDataFrame([('{"records": [{"region": "A", "humidity_pct": 50.0}]}',)], "payload string")
    out = pl.explode_records(rec, "payload", "region string, humidity_pct double").collect()
    assert out[0]["region"] == "A"


def test_missing_logs_read_as_empty(spark, out_dir):
    assert io.read_issue_log(spark, f"{out_dir}/nope").count() == 0
    assert io.read_run_log(spark, f"{out_dir}/nope").count() == 0


def test_fallback_source(spark, out_dir):
    fb = spark.createDataFrame([(1,)], "x int")
    df, used = io.read_or_else(lambda: spark.read.parquet(f"{out_dir}/missing"), lambda: fb)
    assert used == "fallback" and df.count() == 1


def test_raw_csv_null_tokens_and_order(spark, out_dir):
    p = f"{out_dir}/raw.csv"
    with open(p, "w") as f:
        f.write("a,b\n1,N/A\n2,\n3,x\n")
    df = io.read_raw_csv(spark, p, ["a", "b"])
    rows = df.orderBy("_row").collect()
    assert [r["b"] for r in rows] == [None, None, "x"] and [r["a"] for r in rows] == ["1", "2", "3"]


def test_end_to_end_job(spark, out_dir):
    raw_dir = f"{out_dir}/raw"
    raw = o2c_raw_exports(spark, SF)
    landed = {}
    for name, df in raw.items():
        cols = [c for c in df.columns if c != "_row"]
        df.orderBy("_row").select(*cols).coalesce(1).write.option("header", True).csv(f"{raw_dir}/{name}")
        landed[name] = io.read_raw_csv(spark, f"{raw_dir}/{name}", cols)
    rec = o2c_job.run_job(spark, landed, f"{out_dir}/out", default_prices=SEGMENT_PRICES, aliases=PRIORITY_ALIASES, strict=False)
    assert rec["status"] == "SUCCESS" and rec["gate_status"] in ("PASS", "FAIL")
    r = spark.read.parquet(f"{out_dir}/out/reconciled")
    assert r.count() > 0
    total = r.agg(F.sum("total_leakage_kes")).first()[0]
    assert rec["total_leakage_kes"] == pytest.approx(total)
    cats = r.select((F.col("dispatch_capture_gap_kes") + F.col("shrinkage_kes") + F.col("billing_gap_kes")
                     + F.col("underbilling_kes") + F.col("collections_gap_kes") - F.col("total_leakage_kes")).alias("d"))
    assert cats.agg(F.max(F.abs("d"))).first()[0] < 1e-6
    log = io.read_run_log(spark, f"{out_dir}/out/run_log").collect()
    assert len(log) == 1 and log[0]["status"] == "SUCCESS"
    counts = {n: d.count() for n, d in raw.items()}
    assert log[0]["raw_rows_by_table"] == counts and log[0]["raw_rows"] == sum(counts.values())
    assert log[0]["exception_count"] == r.filter("is_exception").count()
    doc = spark.read.json(f"{out_dir}/out/result").first()
    assert doc["data_quality"]["overall_status"] == rec["gate_status"] and len(doc["data_quality"]["checks"]) > 8
    assert doc["summary"]["total_leakage_kes"] == pytest.approx(total)
    assert sum(x["total_leakage_kes"] for x in doc["by_product"]) == pytest.approx(total)
    assert len(doc["by_customer"]) == 10 and len(doc["alert_narratives"]) == 15
    assert doc["roi"]["implementation_cost_kes"] == 75e6 and doc["executive_narrative"].endswith(doc["roi"]["note"])


def test_job_settings(spark, out_dir):
    raw = o2c_raw_exports(spark, SF)
    use = o2c_job.Settings(window_days=90, implementation_cost_kes=1e6, ramp=0.5, actions={"billing_gap_kes": "Send the bill."}, top_exceptions=4,
                           top_customers=2)
    o2c_job.run_job(spark, raw, f"{out_dir}/set", default_prices=SEGMENT_PRICES, aliases=PRIORITY_ALIASES, strict=False, settings=use)
    doc = spark.read.json(f"{out_dir}/set/result").first()
    assert doc["summary"]["simulation_window_days"] == 90 and doc["roi"]["year1_adoption_ramp_factor"] == 0.5
    assert doc["roi"]["implementation_cost_kes"] == 1e6 and len(doc["by_customer"]) == 2 and len(doc["alert_narratives"]) == 4
    assert all((a["recommended_action"] == "Send the bill.") == (a["leakage_category"] == "billing_gap") for a in doc["alert_narratives"])


def test_strict_job_stops_and_logs(spark, out_dir):
    raw = o2c_raw_exports(spark, SF)
    # Orphan every dispatch: the strict gate must stop the run and still log it.
    raw["dispatch_events"] = raw["dispatch_events"].withColumn("loading_id", F.lit("GHOST"))
    with pytest.raises(DataQualityGateError):
        o2c_job.run_job(spark, raw, f"{out_dir}/strict", default_prices=SEGMENT_PRICES, aliases=PRIORITY_ALIASES, strict=True)
    log = io.read_run_log(spark, f"{out_dir}/strict/run_log").collect()
    assert log[0]["status"] == "FAILED" and log[0]["gate_status"] == "FAIL"


def test_entry_contract(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 3
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


def test_refresh_stream_runs_job_once(spark, out_dir):
    from opsanalytics.streaming.refresh import refresh_on_landing

    raw = o2c_raw_exports(spark, SF)
    columns = {}
    for name, df in raw.items():
        cols = [c for c in df.columns if c != "_row"]
        columns[name] = cols
        df.orderBy("_row").select(*cols).coalesce(1).write.option("header", True).csv(f"{out_dir}/landing/{name}")
    q = refresh_on_landing(spark, f"{out_dir}/landing", f"{out_dir}/refresh_out", columns,
                           checkpoint_location=f"{out_dir}/ckpt", default_prices=SEGMENT_PRICES, aliases=PRIORITY_ALIASES,
                           strict=False)
    q.awaitTermination(600)
    log = io.read_run_log(spark, f"{out_dir}/refresh_out/run_log").collect()
    assert [r["status"] for r in log] == ["SUCCESS"]


def test_typed_dayfirst_catalog_load_and_json(spark, out_dir):
    p = f"{out_dir}/t.csv"
    with open(p, "w") as f:
        f.write("d,x\n31/12/2026,1.5\n01/06/2026,2\n")
    typed = io.read_typed_csv(spark, p, "d string, x double").collect()
    assert [r["x"] for r in typed] == [1.5, 2.0]
    day = io.read_dayfirst_csv(spark, p, ["d", "x"], ["d"]).collect()
    assert [str(r["d"]) for r in day] == ["2026-12-31", "2026-06-01"]
    spark.range(3).createOrReplaceTempView("opsanalytics_tmp_view")
    assert "opsanalytics_tmp_view" in {r["name"] for r in io.list_tables(spark).collect()}
    df = spark.range(5)
    assert io.load_replace(df, f"{out_dir}/loaded") == 5
    assert io.load_replace(df, f"{out_dir}/loaded") == 5  # idempotent: replaced, not appended
    doc = spark.createDataFrame([(1.5, "x")], "total double, label string")
    io.write_json_document(doc, f"{out_dir}/doc")
    back = io.read_json_document(spark, f"{out_dir}/doc", "total double, label string").first()
    assert (back["total"], back["label"]) == (1.5, "x")
    with pytest.raises(io.SourceMissingError):
        io.read_json_document(spark, f"{out_dir}/missing_doc", "total double").collect()
