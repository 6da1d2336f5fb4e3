"""Forests grown in tasks: the same trees as Spark's where nothing is drawn, whole results however the rows are dealt."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from opsanalytics.operators import forests, ml


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 4)).round(2)
    x[:, 3] = rng.integers(0, 2, 900)
    y = ((x[:, 0] + x[:, 1] * x[:, 3] + rng.normal(scale=0.7, size=900)) > 0.6).astype(float)
    data = [(i, Vectors.dense(a), b, 1.0 + 2.0 * b) for i, (a, b) in enumerate(zip(x.tolist(), y.tolist(), strict=True))]
    return ml.spread(spark.createDataFrame(data, ["id", "features", "label", "weight"]), ["id"], part_rows=150)


def test_one_tree_equals_sparks(spark, rows):
    data = rows.toPandas()
    x, y, w = np.stack([v.toArray() for v in data["features"]]), data["label"].to_numpy().astype(int), data["weight"].to_numpy()
    thresholds = [forests.candidate_splits(x[:, j], w, 31) for j in range(4)]
    bins = forests.to_bins(x, thresholds)
    tree = forests.grow(bins, y, w, np.ones(len(y), int), 32, 4, 2, 30, np.random.default_rng(0))
    rf = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="all", minInstancesPerNode=2, maxDepth=30, weightCol="weight")
    theirs = rf.fit(rows)
    assert len(tree["feat"]) == theirs.totalNumNodes
    got = np.zeros((len(y), 1))
    part = {k: tree[k] for k in ("feat", "bin", "left")} | {"p1": forests._share(tree["w0"], tree["w1"])}
    forests._walk({"feat": [-1], "final": [False]}, {0: part}, bins, got, False)
    scored = ml.positive_score(theirs.transform(rows)).select("id", "score").toPandas().set_index("id")["score"]
    assert got[:, 0] == pytest.approx(scored.loc[data["id"]].to_numpy(), abs=1e-9)
    gains = np.bincount(tree["feat"][tree["feat"] >= 0], tree["gain"][tree["feat"] >= 0], 4)
    assert gains / gains.sum() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)


def test_no_grown_tree_passes_through_the_driver(rows):
    model = ml.forest(n=12).fit(rows)
    assert not isinstance(model, RandomForestClassificationModel)
    assert sum(len(t["feat"]) for t in model.tops.values()) == 12  # only the roots' places
    assert model.parts().count() == 12
    scored = ml.positive_score(model.transform(rows))
    assert scored.count() == 900 and ml.roc_auc(scored).first()["auc"] > 0.9
    assert scored.filter((F.col("score") > 0.5) != (F.col("prediction") == 1.0)).isEmpty()


def test_forest_learns_as_sparks(rows):
    params = {"numTrees": 60, "minInstancesPerNode": 2, "maxDepth": 30, "weightCol": "weight", "seed": 5}
    ours, theirs = ml.forest(n=60, seed=5).fit(rows), RandomForestClassifier(**params).fit(rows)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.03)
    a, b = (ml.positive_score(m.transform(rows)).select("id", "score") for m in (ours, theirs))
    gap = a.join(b.withColumnRenamed("score", "other"), "id").agg(F.avg(F.abs(F.col("score") - F.col("other")))).first()[0]
    assert gap < 0.05


@pytest.mark.parametrize("part_rows", [30, 200])
def test_large_nodes_are_split_by_many_tasks(rows, monkeypatch, part_rows):
    """The top levels from added histograms and the rest from gathered rows give the tree that one task grows."""
    rf = ml.forest(n=3).setFeatureSubsetStrategy("all")
    whole = rf.fit(rows)
    monkeypatch.setattr(forests, "PART_ROWS", part_rows)
    parted = rf.fit(rows)
    assert all(len(t["feat"]) > 3 for t in parted.tops.values())
    assert parted.featureImportances.toArray() == pytest.approx(whole.featureImportances.toArray(), abs=1e-9)
    assert parted.bias() == pytest.approx(whole.bias(), abs=1e-12)
    a, b = ({r["id"]: r["score"] for r in ml.positive_score(m.transform(rows)).select("id", "score").collect()} for m in (whole, parted))
    assert a == pytest.approx(b, abs=1e-9)
    drawn = ml.forest(n=3).fit(rows)  # with features drawn per node the trees are others, as good
    assert ml.roc_auc(ml.positive_score(drawn.transform(rows))).first()["auc"] > 0.9


def test_contributions_add_up(rows, out_dir, monkeypatch):
    for part_rows in (10_000, 100):
        monkeypatch.setattr(forests, "PART_ROWS", part_rows)
        monkeypatch.setattr(forests, "BLOCK_ROWS", 70)
        model = ml.forest(n=7).fit(rows)
        scored = ml.positive_score(model.transform(rows))
        c = ml.tree_contributions(scored, model, list("abcd"), f"{out_dir}/unused")
        assert c.count() == 3_600
        got = {r["id"]: r["s"] for r in c.groupBy("id").agg((F.sum("contribution") + F.first("bias")).alias("s")).collect()}
        assert got == pytest.approx({r["id"]: r["score"] for r in scored.select("id", "score").collect()}, abs=1e-9)


def test_odd_rows(spark, rows):
    with pytest.raises(Exception, match="(?i)label"):
        ml.forest(n=2).fit(rows.withColumn("label", F.when(F.col("id") > 0, F.col("label"))))
    same = spark.createDataFrame([(i, Vectors.dense([1.0, float("nan")]), float(i % 2), 1.0) for i in range(9)], ["id", "features", "label", "weight"])
    model = ml.forest(n=3).fit(same)  # nothing to split by
    assert model.featureImportances.toArray().tolist() == [0.0, 0.0]
    assert ml.positive_score(model.transform(same)).agg(F.count_distinct("score")).first()[0] == 1
    assert model.transform(same.limit(0)).count() == 0
    three = rows.withColumn("label", F.col("id") % 3 * 1.0)
    assert isinstance(ml.forest(n=2, depth=3).fit(three), RandomForestClassificationModel)  # several classes: Spark's own
