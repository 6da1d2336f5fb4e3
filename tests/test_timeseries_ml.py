"""Skew-proof windows and ML evaluation against brute force."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from opsanalytics.operators import ml
from opsanalytics.operators import summaries as sm
from opsanalytics.operators import timeseries as ts


def _series(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    t0 = datetime(2026, 1, 1)
    rows = []
    for i in range(n):
        # one hot entity with most rows, a few small ones
        ent = "hot" if rng.random() < 0.7 else f"e{rng.integers(0, 5)}"
        v = None if rng.random() < 0.1 else float(rng.normal(10, 3))
        rows.append((i, ent, t0 + timedelta(minutes=int(rng.integers(0, 60 * 24 * 20))), v))
    return spark.createDataFrame(rows, "id long, ent string, ts timestamp, v double")


@pytest.mark.parametrize("block_rows", [7, 3])  # 3 rows are less than a window reaches back
def test_rolling_rows_equals_plain_window(spark, block_rows):
    df = _series(spark)
    fast = ts.rolling_rows(df, ["ent"], ["ts", "id"], 6,
                           {"m": ts.mean_of("v"), "p2p": ts.peak_to_peak("v"), "sd": ts.std_filled("v")},
                           block_rows=block_rows)
    w = Window.partitionBy("ent").orderBy("ts", "id").rowsBetween(-5, 0)
    ref = df.select("id", F.avg("v").over(w).alias("m0"), (F.max("v").over(w) - F.min("v").over(w)).alias("p0"),
                    F.coalesce(F.stddev_samp("v").over(w), F.lit(0.0)).alias("s0"))
    j = fast.join(ref, "id").collect()
    assert len(j) == df.count()
    for r in j:
        for a, b in (("m", "m0"), ("p2p", "p0"), ("sd", "s0")):
            assert (r[a] is None and r[b] is None) or r[a] == pytest.approx(r[b], abs=1e-9)


def test_row_numbers_dense_and_ordered(spark):
    df = _series(spark, 300, seed=3)
    n = ts.row_numbers(df, ["ent"], ["ts", "id"])
    w = Window.partitionBy("ent").orderBy("ts", "id")
    ref = df.select("id", F.row_number().over(w).alias("rn0"))
    assert n.join(ref, "id").filter(F.col("_rn") != F.col("rn0")).count() == 0


def test_interpolation_and_fill(spark):
    rows = [(1, None), (2, 1.0), (3, None), (4, None), (5, 4.0), (6, None)]
    df = spark.createDataFrame(rows, "t int, v double")
    got = [r["x"] for r in df.select("t", ts.interpolate_linear("v", [], "t").alias("x")).orderBy("t").collect()]
    assert got == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]
    got = [r["x"] for r in df.select("t", ts.ffill_bfill("v", [], "t").alias("x")).orderBy("t").collect()]
    assert got == [1.0, 1.0, 1.0, 1.0, 4.0, 4.0]


def test_weekly_counts_sunday_label_and_zero_weeks(spark):
    d = spark.createDataFrame([(datetime(2026, 6, 1),), (datetime(2026, 6, 7),), (datetime(2026, 6, 22),)], "d timestamp")
    got = [(str(r["week_ending"]), r["n"]) for r in ts.weekly_counts(d, "d").orderBy("week_ending").collect()]
    assert got == [("2026-06-07", 2), ("2026-06-14", 0), ("2026-06-21", 0), ("2026-06-28", 1)]


def test_top_per_group_matches_window(spark):
    df = _series(spark, 500, seed=5).na.drop()
    fast = sm.top_per_group(df, ["ent"], [F.desc("v"), F.asc("id")], 3, salt_buckets=4, tiebreak="id")
    w = Window.partitionBy("ent").orderBy(F.desc("v"), F.asc("id"))
    ref = df.withColumn("r", F.row_number().over(w)).filter("r <= 3")
    assert sorted(r["id"] for r in fast.collect()) == sorted(r["id"] for r in ref.collect())


def _scored(spark, n=800, seed=7):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.2).astype(float)
    s = np.clip(0.3 * y + rng.random(n) * 0.7, 0, 0.9999)
    s = np.round(s, 2)  # many ties and exact grid values
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, s))], "id long, label double, score double"), y, s


def test_auc_equals_brute_force(spark):
    df, y, s = _scored(spark)
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert ml.roc_auc(df).first()["auc"] == pytest.approx(brute, abs=1e-12)


def test_threshold_sweep_equals_brute_force(spark):
    df, y, s = _scored(spark)
    sweep = {round(r["threshold"], 2): r for r in ml.threshold_sweep(df).collect()}
    for k in range(5, 96):
        th = k / 100.0
        tp = int(((s >= th) & (y == 1)).sum())
        fp = int(((s >= th) & (y == 0)).sum())
        assert (sweep[round(th, 2)]["tp"], sweep[round(th, 2)]["fp"]) == (tp, fp)


def test_stratified_split_exact(spark):
    df, y, _ = _scored(spark)
    sp = ml.stratified_split(df, "label", "id", 0.25, 42)
    got = {(r["label"], r["split"]): r["count"] for r in sp.groupBy("label", "split").count().collect()}
    n1 = int(y.sum())
    assert got[(1.0, "test")] == round(n1 * 0.25)
    again = ml.stratified_split(df, "label", "id", 0.25, 42).filter("split = 'test'").select("id")
    assert again.exceptAll(sp.filter("split = 'test'").select("id")).count() == 0


def test_logistic_recovers_planted_signal(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, 2))
    p = 1 / (1 + np.exp(-(2.5 * x[:, 0] - 0.1)))
    y = (rng.random(600) < p).astype(float)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                               "id long, a double, b double, label double")
    sp = ml.stratified_split(df, "label", "id")
    model = ml.fit_pipeline(sp.filter("split='train'"), ml.preprocess_stages(["a", "b"], []), ml.logistic(450))
    coef = model.stages[-1].coefficients.toArray()
    assert coef[0] > 1.5 and abs(coef[1]) < 0.5
    auc = ml.roc_auc(ml.positive_score(model.transform(sp.filter("split='test'")))).first()["auc"]
    assert auc > 0.85


def _brute_neighbours(X, k):
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return {(i, r): (int(c), d[i, c]) for i in range(len(X)) for r, c in enumerate(np.argsort(d[i], kind="stable")[:k]) if np.isfinite(d[i, c])}


@pytest.mark.parametrize("shape", ["normal", "hot", "few"])
def test_knn_within_exact(spark, shape):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(160, 3)) * 5
    if shape == "hot":  # one tight cell with most points, repeats and ties on a grid
        X = np.concatenate([np.round(rng.normal(size=(140, 3)) * 0.3, 1), X[:40]])
    X = X[:3] if shape == "few" else X
    pts = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, x array<double>").repartition(3)
    got = {(r["qid"], r["rank"]): (r["cid"], r["dist"]) for r in ml.knn_within(pts, 4, block_rows=12).collect()}
    want = _brute_neighbours(X, 4)
    assert got.keys() == want.keys()
    for key, (cid, dist) in want.items():
        assert got[key][0] == cid and got[key][1] == pytest.approx(dist, abs=1e-9)


def test_knn_skips_far_blocks():
    """On separated groups a point looks at a small share of the blocks."""
    import pandas as pd

    rng = np.random.default_rng(8)
    pivots = rng.normal(size=(20, 4)) * 100
    blocks = [{"cell": c, "lo": 0.0, "hi": 2.0} for c in range(20)]
    pts = pd.DataFrame({"id": range(20), "x": [p + 0.5 for p in pivots], "seen": 0, "reach": 4.0})
    assert sum(len(p) for p in ml._next_blocks(pivots, blocks, 4)([pts])) == 20


def test_ranks_of_one_hot_group(spark):
    from opsanalytics.operators.ordering import with_ranks

    rng = np.random.default_rng(6)
    rows = [(i, "hot" if i % 3 else f"g{i % 5}", datetime(2026, 1, 1), float(rng.integers(0, 9))) for i in range(3000)]
    rows += [(9000, None, None, None), (9001, None, None, 1.0), (9002, "hot", datetime(2026, 1, 1), None)]
    df = spark.createDataFrame(rows, "id long, g string, day timestamp, v double").repartition(5)
    w = Window.partitionBy("g").orderBy("day", F.desc("v"), "id")
    got = with_ranks(df, ["day", F.desc("v"), "id"], ["g"], {"before": "v"})
    ref = df.withColumns({"r": F.row_number().over(w),
                          "b": F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))})
    assert got.join(ref, "id").where("_rn != r or abs(before - b) > 1e-9").count() == 0 and got.count() == len(rows)
    assert with_ranks(df.limit(0), ["v"], ["g"]).count() == 0


def test_one_day_of_an_entity_is_several_tasks(spark):
    """All rows at one moment of one entity: ranks come from many range partitions."""
    from opsanalytics.operators import ordering

    df = spark.range(20_000).select("id", F.lit("hot").alias("g"), F.lit(1).alias("day"))
    parts = df.repartitionByRange(8, "g", "day", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 5_000
    ranked = ordering.with_ranks(df, ["day", "id"], ["g"])
    assert ranked.where("_rn != id + 1").count() == 0


def test_cross_validation_and_profile(spark):
    df, y, s = _scored(spark, 300)

    def fit(train):
        cut = train.groupBy("label").agg(F.avg("score").alias("m")).agg(F.avg("m")).first()[0]
        return lambda test: test.withColumn("prediction", (F.col("score") >= cut).cast("double"))

    folds = ml.cross_validate(df, "label", "id", fit).collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3, 4]
    assert sum(r["tp"] + r["fn"] for r in folds) == int(y.sum()) and sum(r["tn"] + r["fp"] for r in folds) == int((1 - y).sum())
    assert all(r["train_rows"] == 300 - (r["tp"] + r["fp"] + r["tn"] + r["fn"]) for r in folds)
    prof = ml.cluster_profile(df.withColumn("cluster", (F.col("id") % 3).cast("int")), ["score"], "label").collect()
    assert sum(r["n"] * r["score"] for r in prof) == pytest.approx(s.sum())
    assert [r["label"] for r in prof] == sorted((r["label"] for r in prof), reverse=True)


def test_queue_threshold_leaves_a_queue(spark):
    low = spark.createDataFrame([(i, float(i % 2), 0.1 + i / 1000) for i in range(50)], "id long, label double, score double")
    t = ml.queue_threshold(ml.threshold_sweep(low)).first()["threshold"]
    assert t == 0.14 and ml.review_queue(low, t, ["id"]).count() == 10


def test_boosted_importance_sums_to_one(spark):
    df, _, _ = _scored(spark, 200)
    model = ml.fit_pipeline(df.withColumn("noise", F.lit(1.0)), ml.preprocess_stages(["score", "noise"], []), ml.boosted(n=5))
    imp = dict(ml.feature_importance(model.stages[-1], ["score", "noise"]))
    assert sum(imp.values()) == pytest.approx(1.0) and imp["score"] > 0.99


def test_smote_balances_on_segments(spark):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(4)
    rows = [(i, Vectors.dense(rng.normal(size=2).tolist()), 0.0) for i in range(60)]
    rows += [(100 + i, Vectors.dense((rng.normal(size=2) + 3).tolist()), 1.0) for i in range(12)]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    out = ml.smote(df, k=3, block_rows=5)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0.0] == counts[1.0] == 60
    synth = out.filter("synthetic").collect()
    mino = np.array([r[1].toArray() for r in rows if r[2] == 1.0])
    lo, hi = mino.min(0) - 1e-9, mino.max(0) + 1e-9
    for r in synth:  # interpolations stay inside the minority's bounding box
        v = r["features"].toArray()
        assert np.all(v >= lo) and np.all(v <= hi)


def test_tree_contributions_add_up(spark, out_dir):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(9)
    rows = []
    for i in range(300):
        a, b = rng.normal(size=2)
        rows.append((i, Vectors.dense([a, b, float(rng.integers(0, 3))]), float(a + 0.3 * rng.normal() > 0)))
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    m = RandomForestClassifier(numTrees=7, maxDepth=4, seed=3).fit(df)
    scored = ml.positive_score(m.transform(df))
    c = ml.tree_contributions(scored, m, ["a", "b", "c"], f"{out_dir}/rf")
    tot = c.groupBy("id").agg(F.first("bias").alias("bias"), F.sum("contribution").alias("s"))
    j = tot.join(scored.select("id", "score"), "id").collect()
    assert len(j) == 300
    for r in j:
        assert r["bias"] + r["s"] == pytest.approx(r["score"], abs=1e-9)
    imp = {r["feature"]: r["m"] for r in c.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("m")).collect()}
    assert imp["a"] > imp["b"] and imp["a"] > imp["c"]


def test_exact_quantiles_match_percentile(spark):
    from opsanalytics.operators import quantiles as qt

    rng = np.random.default_rng(21)
    rows = [("hot", float(v)) for v in np.round(rng.normal(10, 3, 5000), 3)]
    rows += [("few", float(v)) for v in rng.integers(0, 4, 90)] + [("one", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = {r["g"]: r for r in qt.exact_quantiles(df, "v", probs, by=["g"]).collect()}
    ref = df.groupBy("g").agg(*[F.percentile("v", p).alias(f"r{i}") for i, p in enumerate(probs)]).collect()
    for r in ref:
        for i in range(len(probs)):
            assert got[r["g"]][f"q{i}"] == pytest.approx(r[f"r{i}"], abs=1e-12)
