"""Tree models over evenly dealt rows, path contributions by groups of trees, nearest points by matrix products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsanalytics.operators import ml


def test_training_rows_are_dealt_over_the_cores(spark):
    one = spark.range(1_000).coalesce(1).withColumn("v", F.col("id") * 2)
    dealt = ml.spread(one, ["id"])
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(dealt.collect()) == sorted(one.collect())
    assert ml.spread(one, ["id"], part_rows=50).rdd.getNumPartitions() == 20


def test_forest_keeps_the_rows_nodes():
    # Without them every level ships the grown trees and walks all rows from the roots.
    forest = ml.forest()
    assert forest.getCacheNodeIds() and forest.getNumTrees() == 400 and forest.getMaxDepth() == 30


def test_tree_contributions_by_groups_of_trees(spark, out_dir, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    monkeypatch.setattr(ml, "GROUP_NODES", 20)
    monkeypatch.setattr(ml, "GROUP_ROWS", 40)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 2))
    df = spark.createDataFrame([(i // 2, Vectors.dense(a), float(a[0] > 0.2)) for i, a in enumerate(x)], ["id", "features", "label"])
    model = RandomForestClassifier(numTrees=6, maxDepth=4, seed=3).fit(df)
    scored = ml.positive_score(model.transform(df))
    c = ml.tree_contributions(scored, model, ["a", "b"], f"{out_dir}/rf")
    assert c.count() == 240  # a row for each feature of every row, repeated ids too
    got = {r["id"]: r["s"] for r in c.groupBy("id").agg((F.sum("contribution") + F.sum("bias") / 2).alias("s")).collect()}
    want = {r["id"]: r["s"] for r in scored.groupBy("id").agg(F.sum("score").alias("s")).collect()}
    assert got == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_nearest_points_equal_brute_force(shift):
    rng = np.random.default_rng(8)
    points = rng.integers(0, 4, size=(300, 3)).astype(float) + shift  # many ties and copies
    q = points[:50]
    skip = np.arange(50)[:, None] == np.arange(300)[None, :]
    d = np.sqrt(((q[:, None, :] - points[None, :, :]) ** 2).sum(2))
    d[skip] = np.inf
    best = np.argsort(d, axis=1, kind="stable")[:, :5]
    row, col, dist = ml._nearest(q, points, skip, 5)
    assert (row == np.repeat(np.arange(50), 5)).all() and (col == best.ravel()).all()
    assert (dist == np.take_along_axis(d, best, axis=1).ravel()).all()


def test_nearest_with_few_or_infinite_points():
    points = np.array([[0.0, 0.0], [1.0, 0.0], [np.inf, 0.0]])
    row, col, dist = ml._nearest(points[:2], points, np.eye(2, 3, dtype=bool), 5)
    assert list(row) == [0, 1] and list(col) == [1, 0] and list(dist) == [1.0, 1.0]


def test_tree_contributions_with_category_splits(spark, out_dir):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler, VectorIndexer

    rng = np.random.default_rng(5)
    kind, a = rng.integers(0, 5, 200), rng.normal(size=200)
    df = spark.createDataFrame([(i, float(k), float(v), float(k in (1, 4) or v > 1)) for i, (k, v) in enumerate(zip(kind, a, strict=True))],
                               ["id", "kind", "a", "label"])
    raw = VectorAssembler(inputCols=["kind", "a"], outputCol="raw").transform(df)
    x = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(raw).transform(raw)
    model = RandomForestClassifier(numTrees=5, maxDepth=4, seed=3).fit(x)
    scored = ml.positive_score(model.transform(x))
    c = ml.tree_contributions(scored, model, ["kind", "a"], f"{out_dir}/rf-kinds")
    got = {r["id"]: r["s"] for r in c.groupBy("id").agg((F.sum("contribution") + F.first("bias")).alias("s")).collect()}
    assert got == pytest.approx({r["id"]: r["score"] for r in scored.collect()}, abs=1e-9)
    # A threshold is one number: no list per node goes to the tasks, sets only where a split is by category.
    nodes = ml.forest_nodes(model, f"{out_dir}/rf-kinds-nodes", spark)
    assert dict(nodes.dtypes)["thr"] == "double"
    assert {(r["thr"] is None, r["cats"] is None) for r in nodes.filter("left >= 0").collect()} == {(True, False), (False, True)}
    # Groups of trees are dealt to the cores even if all nodes would fit one task, and stay apart.
    plan = c._jdf.queryExecution().optimizedPlan().toString()
    groups = min(5, 2 * spark.sparkContext.defaultParallelism)
    assert plan.count(f"RepartitionByExpression [group#") == 2 and f"], {4 * groups}" in plan


def test_neighbours_take_few_rounds(spark, monkeypatch):
    """Rounds look at more and more blocks: 4, 8, 16 and 16 of them here, which 4 at a time took eleven rounds."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 12))  # without structure: every point looks at nearly all blocks
    asked, held = [], ml._next_blocks
    monkeypatch.setattr(ml, "_next_blocks", lambda pivots, blocks, visits: asked.append(visits) or held(pivots, blocks, visits))
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    got = {(r["qid"], r["rank"]): r["cid"] for r in ml.knn_within(pts, 3, block_rows=8).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert got == {(i, r): int(c) for i, row in enumerate(np.argsort(d, axis=1, kind="stable")[:, :3]) for r, c in enumerate(row)}
    assert asked[:3] == [4, 8, 16][:len(asked)] and len(asked) <= 5
