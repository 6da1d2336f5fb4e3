"""Plan checks: no nested-loop/cartesian joins anywhere, and no
unpartitioned window in the fact-table operators that must stay skew-proof."""

import re

import pytest

from opsanalytics.plans import registry

SF = "/root/testdata/sf0.001"
MODEL_FITS = ("m2_", "m4_", "m5_", "m6_", "m7_", "m8_", "m9_", "m10_cv", "m14", "m15", "m16", "m17", "m18")
# Fact-table operators whose windows must be partitioned (no single-task window).
SKEW_PROOF = ["w3_rolling_features", "w4_rolling_std_diff", "w13_feature_recheck", "w14_top_per_group",
              "m1_stratified_split", "m10_stratified_folds", "c9_clean_loading_events", "a29_describe", "a36_box_stats"]


def _plan(spark, name):
    df = registry.QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def loaded():
    registry.load_all()
    return registry.QUERIES


def test_no_nested_loop_or_cartesian(spark, loaded):
    bad = {}
    for name in loaded:
        if name.startswith(MODEL_FITS):
            continue
        plan = _plan(spark, name)
        hits = [k for k in ("BroadcastNestedLoopJoin", "CartesianProduct") if k in plan]
        if hits:
            bad[name] = hits
    assert bad == {}


@pytest.mark.parametrize("name", SKEW_PROOF)
def test_windows_are_partitioned(spark, loaded, name):
    plan = _plan(spark, name)
    assert _unpartitioned_windows(plan) == []


# In an unpartitioned window spec the first argument is already an ordering
# term (ASC/DESC) or the frame itself; partitioned specs start with a key.
_GLOBAL_SPEC = re.compile(r"windowspecdefinition\((?:[^,()]+ (?:ASC|DESC)\b|specifiedwindowframe)")


def _unpartitioned_windows(plan: str) -> list[str]:
    return [line.strip()[:160] for line in plan.splitlines() if "Window [" in line and _GLOBAL_SPEC.search(line)]


def test_detector_flags_a_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(50)
    glob = df.withColumn("r", F.row_number().over(Window.orderBy("id")))
    part = df.withColumn("r", F.row_number().over(Window.partitionBy(F.col("id") % 3).orderBy("id")))
    assert _unpartitioned_windows(glob._jdf.queryExecution().executedPlan().toString())
    assert not _unpartitioned_windows(part._jdf.queryExecution().executedPlan().toString())
