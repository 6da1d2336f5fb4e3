"""Ordinary degenerate inputs: constant groups, perfect lines, one class, zeros, NaN, hot values, file order."""

import math
import random

import pytest
from pyspark.sql import functions as F

from opsanalytics.operators import diagnostics as dg
from opsanalytics.operators import ml, planning, stats
from opsanalytics.operators import summaries as sm
from opsanalytics.operators.quantiles import exact_quantiles
from opsanalytics.sources import files as io


@pytest.fixture(scope="module")
def constant(spark):
    return spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("a", 1.0, 4.0)], "g string, v double, w double")


def _interpolated(values, p):
    v = sorted(values, key=lambda x: (math.isnan(x), x))
    at = (len(v) - 1) * p
    lo, hi = v[math.floor(at)], v[math.ceil(at)]
    return lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))


R = random.Random(8)
COLUMNS = {
    "with NaN": [float("nan")] + [R.random() for _ in range(9_001)],
    "600 decades": [10.0 ** R.uniform(-300, 300) for _ in range(5_000)],
    "two thirds equal": [1.0] * 8_000 + [R.random() * 3 for _ in range(4_000)],
    "infinities": [float("inf")] * 3 + [float("-inf")] * 3 + [0.0],
}


@pytest.mark.parametrize("values", COLUMNS.values(), ids=COLUMNS)
def test_quantiles_on_any_spread(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75]).first()
    assert got["n"] == len(values)
    for k, p in enumerate([0.0, 0.25, 0.5, 0.75]):
        assert got[f"q{k}"] == pytest.approx(_interpolated(values, p), rel=1e-12)


def test_no_value_list_in_the_quantile_plan(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("double").alias("v"))
    plan = exact_quantiles(df, "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(_v" not in plan


def test_constant_columns_and_groups(constant):
    assert [r["z_v"] for r in dg.group_zscore(constant, ["g"], "v").collect()] == [None] * 3
    assert dg.flag_low_z(constant, ["g"], "v").count() == 0
    assert dg.global_z_outliers(constant, "v").count() == 0
    assert {r["column"]: r["n_outliers"] for r in dg.outlier_counts(constant, ["v", "w"]).collect()} == {"v": 0, "w": 0}
    assert {r["density"] for r in dg.binned_kde(constant, "v", ["g"]).collect()} == {None}
    assert {r["column"]: r["is_constant"] for r in sm.constant_columns(constant).collect()} == {"g": True, "v": True, "w": False}


def test_density_integrates_to_one(constant):
    grid = sorted((r["x"], r["density"]) for r in dg.binned_kde(constant, "w", grid=400).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(grid, grid[1:]))
    assert area == pytest.approx(1.0, abs=0.01)


def test_tests_without_variation(constant):
    line = constant.withColumn("x", 2 * F.col("w"))
    r = stats.pearson(line, "w", "x").first()
    assert (r["r"], r["t_stat"], r["p_value"]) == (1.0, None, 0.0)
    r = stats.pearson(constant, "v", "w").first()
    assert (r["r"], r["t_stat"], r["p_value"], r["interpretation"]) == (None, None, None, None)
    assert stats.line_fit(constant, "v", "w").first()["slope"] is None
    two = constant.unionByName(constant.withColumn("g", F.lit("b")))
    r = stats.welch_ttest(two, "v", F.col("g"), "a", "b").first()
    assert (r["diff"], r["t_stat"], r["p_value"]) == (0.0, None, None)
    r = stats.anova_oneway(constant, "w", "g").first()
    assert (r["f_stat"], r["p_value"]) == (None, None)


def test_one_class_zero_actual_no_supply(spark):
    assert ml.roc_auc(spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")).first()["auc"] is None
    a = spark.createDataFrame([(1, 0.0), (2, 4.0)], "k int, y double")
    p = spark.createDataFrame([(1, 1.0), (2, 5.0)], "k int, yhat double")
    r = planning.holdout_scores(a, p, ["k"]).first()
    assert (r["mape_pct"], r["mae"], r["n"]) == (25.0, 1.0, 2)
    sites = spark.createDataFrame([("s", "x", 0.0, 0.0, 5.0, 0.0)], "scenario string, site string, cost double, min_qty double, max_qty double, supply double")
    r = planning.allocate(sites).first()
    assert (r["utilization_pct"], r["cost_share_pct"]) == (None, None)


def test_smote_ids_and_missing_neighbours(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(k, 0, Vectors.dense(float(k), 1.0)) for k in range(400)] + [(1000, 1, Vectors.dense(0.0, 0.0)), (1001, 1, Vectors.dense(1.0, 1.0))]
    train = spark.createDataFrame(rows, ["id", "label", "features"])
    out = ml.smote(train, "label", "features", k=5)
    ids = [r["id"] for r in out.select("id").collect()]
    assert len(ids) == len(set(ids)) == 800
    with pytest.raises(ValueError, match="two minority rows"):
        ml.smote(train.filter("id <> 1001"), "label", "features", k=5)


def test_missing_categories_are_learnt_from_the_training_rows(spark):
    df = spark.createDataFrame([("x", "train"), (None, "train"), ("y", "test"), ("y", "test"), (None, "test")], "c string, split string")
    got = ml.fill_most_frequent(df, ["c"], df.filter("split = 'train'")).groupBy("split", "c").count().collect()
    assert {(r["split"], r["c"], r["count"]) for r in got} == {("train", "x", 2), ("test", "y", 2), ("test", "x", 1)}


def test_keep_first_follows_files_of_different_size(spark, out_dir):
    import os

    os.makedirs(f"{out_dir}/in")
    with open(f"{out_dir}/in/a.csv", "w") as f:
        f.write("id,v\nk,from a\n")
    with open(f"{out_dir}/in/b.csv", "w") as f:
        f.write("id,v\n" + "".join(f"other{n},x\n" for n in range(20_000)) + "k,from b\n")
    from opsanalytics.operators.clean import keep_first

    df = io.read_raw_csv(spark, f"{out_dir}/in", ["id", "v"])
    assert keep_first(df, "id", "_row").filter("id = 'k'").first()["v"] == "from a"


def test_fallback_source(spark, out_dir):
    other = spark.range(3)
    df, used = io.read_or_else(lambda: spark.read.parquet(f"{out_dir}/none"), lambda: other)
    assert (df.count(), used) == (3, "fallback")
    assert io.read_or_else(lambda: other, lambda: other.limit(0))[1] == "primary"
    with pytest.raises(ZeroDivisionError):
        io.read_or_else(lambda: 1 / 0, lambda: other)
