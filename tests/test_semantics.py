"""One small test per remaining null/ordering rule of SURVEY §1.1."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsanalytics.operators import diagnostics as dg
from opsanalytics.operators import reconcile as rc
from opsanalytics.operators import summaries as sm
from opsanalytics.operators import timeseries as ts
from opsanalytics.operators.filters import conjunctive_filter


def test_n5_group_summary_drops_null_keys(spark):
    df = spark.createDataFrame([("A", 1.0), (None, 2.0)], "depot string, v double")
    r = df.select("depot", *[F.col("v").alias(c) for c in ["expected_revenue_kes", "collected_revenue_kes", "total_leakage_kes",
                                                           *rc.LEAKAGE_CATEGORIES]], F.lit("L").alias("loading_id"))
    assert [x["depot"] for x in rc.summarize_by(r, "depot").collect()] == ["A"]


def test_n8_null_keys_never_match(spark):
    ts0 = datetime(2026, 6, 1)
    L = spark.createDataFrame([(None, "M", "PMS", "C", 10.0, ts0)],
                              "loading_id string, depot string, product string, customer string, volume_loaded_litres double, loading_ts timestamp")
    D = spark.createDataFrame([("D1", None, 10.0, ts0, "Dispatched")],
                              "dispatch_id string, loading_id string, volume_dispatched_litres double, dispatch_ts timestamp, status string")
    empty_i = spark.createDataFrame([], "invoice_id string, dispatch_id string, volume_invoiced_litres double, unit_price_kes double, amount_kes double, invoice_date timestamp")
    empty_p = spark.createDataFrame([], "payment_id string, invoice_id string, amount_paid_kes double, payment_date timestamp")
    r = rc.reconcile({"loading_events": L, "dispatch_events": D, "invoices": empty_i, "payments": empty_p}).first()
    assert r["dispatch_id"] is None and r["dispatch_capture_gap_kes"] == pytest.approx(1655.0)


def _seq(spark, vals):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "t int, v double")


def test_n9_min_periods_counts_values(spark):
    df = _seq(spark, [1.0, None, 3.0, 5.0])
    w = ts.rows_window([], "t", 3)
    got = [r["m"] for r in df.select("t", ts.rolling_mean("v", w, min_periods=2).alias("m")).orderBy("t").collect()]
    assert got == [None, None, 2.0, 4.0]


def test_n10_single_row_std_is_zero(spark):
    df = _seq(spark, [4.0, 6.0])
    w = ts.rows_window([], "t", 6)
    got = [r["s"] for r in df.select("t", ts.rolling_std("v", w).alias("s")).orderBy("t").collect()]
    assert got[0] == 0.0 and got[1] == pytest.approx(1.41421356, abs=1e-6)


def test_n11_resample_keeps_empty_bins(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 0, 10), 1.0), (datetime(2026, 1, 1, 3, 5), 3.0)], "ts timestamp, v double")
    out = ts.resample(df, "ts", "hour", {"m": F.avg("v"), "n": F.count("*")}, empty={"n": 0}).orderBy("bin").collect()
    assert [(r["m"], r["n"]) for r in out] == [(1.0, 1), (None, 0), (None, 0), (3.0, 1)]


def test_n14_round_is_half_up(spark):
    df = spark.createDataFrame([(2.5,), (0.125,)], "x double")
    assert [r[0] for r in df.select(F.round("x", 0)).collect()][0] == 3.0
    assert [r[0] for r in df.select(F.round("x", 2)).collect()][1] == 0.13


def test_n15_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "x string")
    assert sm.most_frequent(df, "x").first()[0] == "a"


def test_n19_contains_is_case_insensitive_regex(spark):
    df = spark.createDataFrame([("Kenol Ltd",), ("KENOL",), ("other",), (None,)], "c string")
    assert conjunctive_filter(df, contains={"c": "ken.l"}).count() == 2


def test_n20_sample_vs_population_std(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double")
    samp = dg.global_z_outliers(df, "x", cut=1.5, ddof=1).count()
    pop = dg.outlier_counts(df, ["x"], cut=1.5).first()["n_outliers"]
    assert samp == 1 and pop == 1
    z_s = dg.global_z_outliers(df, "x", cut=0.0, ddof=1).orderBy("x").collect()[-1]["z_x"]
    z_p = dg.global_z_outliers(df, "x", cut=0.0, ddof=0).orderBy("x").collect()[-1]["z_x"]
    assert z_p > z_s  # the population std is smaller
