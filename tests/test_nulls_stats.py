"""Null semantics and the p-value functions."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsanalytics.functions import nulls as nl
from opsanalytics.functions.pvalues import betainc, f_upper_p, normal_ppf, t_two_sided_p
from opsanalytics.operators import stats as st


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "x double")
    assert [r[0] for r in df.select(nl.clip_low("x")).collect()] == [None, 0.0, 2.0]


def test_floor_days(spark):
    df = spark.createDataFrame([(datetime(2026, 6, 1, 1), datetime(2026, 6, 1, 0)), (datetime(2026, 6, 1, 23), datetime(2026, 6, 2, 1))],
                               "a timestamp, b timestamp")
    assert [r[0] for r in df.select(nl.floor_days("a", "b")).collect()] == [-1, 0]


def test_mask_and_not_equal(spark):
    df = spark.createDataFrame([(None,), ("none",), ("x",)], "s string")
    assert [r[0] for r in df.select(nl.mask(F.col("s") == "x")).collect()] == [False, False, True]
    assert [r[0] for r in df.select(nl.mask_not_equal("s", "none")).collect()] == [True, False, True]


def test_sum_of_missing_is_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert df.agg(nl.sum0("x")).first()[0] == 0.0


def test_betainc_known_values():
    assert betainc(1.0, 1.0, 0.3)[()] == pytest.approx(0.3)
    assert betainc(2.0, 3.0, 0.4)[()] == pytest.approx(0.5248, abs=1e-4)


def test_t_and_f_pvalues():
    assert t_two_sided_p(2.0, 10)[()] == pytest.approx(0.07339, abs=1e-4)
    assert t_two_sided_p(0.0, 5)[()] == pytest.approx(1.0)
    assert f_upper_p(3.49, 2, 20)[()] == pytest.approx(0.0502, abs=5e-4)
    assert normal_ppf(0.95) == pytest.approx(1.644854, abs=1e-6)


def test_pearson_planted(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=400)
    y = 2 * x + rng.normal(size=400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    r = st.pearson(df, "x", "y").first()
    assert r["r"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)
    assert r["p_value"] < 1e-10 and r["interpretation"].startswith("strong positive")


def test_welch_and_anova(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 5]] + [("b", float(v)) for v in [3, 5, 7, 9, 11]]
    df = spark.createDataFrame(rows, "g string, v double")
    w = st.welch_ttest(df, "v", F.col("g"), "a", "b").first()
    assert w["t_stat"] == pytest.approx(-2.5298, abs=1e-3) and w["dof"] == pytest.approx(5.8824, abs=1e-3)
    assert w["p_value"] == pytest.approx(0.0460, abs=1e-3)
    a = st.anova_oneway(df, "v", "g").first()
    assert a["f_stat"] == pytest.approx(6.4, abs=1e-9) and a["p_value"] == pytest.approx(0.0353, abs=1e-3)
