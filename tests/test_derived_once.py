"""Derived tables are made once: duplicates planted in one pass, document features stored around the split."""

from pyspark.sql import functions as F

from opsanalytics.plans import driver_tables as dt
from opsanalytics.plans import q_ml


def test_duplicates_are_planted_in_one_pass(spark):
    df = spark.createDataFrame([(6, "a", "x"), (7, "b", "y"), (None, "c", "z"), (6, "a", None)], "k long, t string, v string")
    got = dt._with_dups(df.groupBy("k", "t").agg(F.max("v").alias("v")), F.col("k"), 3, {"v": F.lit("1.0")})
    assert got.columns == ["k", "t", "v", "_row"] and dict(got.dtypes)["_row"] == "bigint"
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(6, "a", "x", 12), (6, "a", "1.0", 13), (7, "b", "y", 14), (None, "c", "z", None)], key=str)
    # A union would group the rows once for the originals and once for the copies.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_split_reads_stored_features(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "en" if i % 3 else None, "web", float(i), float(i % 4 == 0)) for i in range(40)],
                                 "doc_id long, lang string, source string, n_chars double, label double")
    plain = docs.withColumn("n_words", F.length(F.regexp_replace(F.col("lang"), "n", "")) + F.col("n_chars"))
    monkeypatch.setattr(q_ml, "doc_features", lambda spark, sf_dir: plain)
    x = q_ml._split_docs(spark, "")
    assert {r["split"]: r["n"] for r in x.groupBy("split").agg(F.count("*").alias("n")).collect()} == {"test": 11, "train": 29}
    assert x.filter(F.col("lang").isNull()).count() == 0
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "Window" not in plan
    assert x.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_letters_are_counted_not_deleted(spark, out_dir):
    texts = ["", None, "A1", "aBÄ\U0001d7d8 9٣\n", "no match", "42AZ" * 50]
    spark.createDataFrame([(i, t, "en", "web", 5) for i, t in enumerate(texts)],
                          "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{out_dir}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(len(texts))], "doc_id long, toxic int").write.parquet(f"{out_dir}/labels.parquet")
    feats = q_ml.doc_features(spark, str(out_dir))
    got = {r["doc_id"]: (r["digit_share"], r["upper_share"]) for r in feats.collect()}
    want = {i: (None, None) if t is None else (sum(c in "0123456789" for c in t) / max(len(t), 1), sum("A" <= c <= "Z" for c in t) / max(len(t), 1))
            for i, t in enumerate(texts)}
    assert got == want
    assert "[^0-9]" not in feats._jdf.queryExecution().optimizedPlan().toString()  # almost every character was a match


def test_mean_contributions_do_not_score(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 0.5), (2, 0.25)], "doc_id long, features double").withColumn("score", F.raise_error(F.lit("scored")).cast("double"))
    seen = []

    class Model:
        stages = ["forest"]

    monkeypatch.setattr(q_ml, "_fit_eval", lambda *a, **k: (Model, rows))
    monkeypatch.setattr(q_ml.ml, "feature_names", lambda *a: ["f"])
    monkeypatch.setattr(q_ml.ml, "tree_contributions", lambda pred, *a, **k: seen.append(pred.columns) or pred.select(
        "doc_id", F.lit("f").alias("feature"), F.col("features").alias("contribution")))
    assert [tuple(r) for r in q_ml.m16_mean_abs_contribution(spark, "").collect()] == [("f", 0.375)]
    assert seen == [["doc_id", "features"]]
