"""Machine-learning queries (M1-M18) on ``documents`` + ``labels`` and ``embeddings``.

The failure label is ``labels.toxic`` (imbalanced, ~13 % positive); features
are computed from the whole document text.  Evaluation on a rule score
(M1, M10-M13) is SQL-checked; model fits are row-count checked, with planted
signals tested in ``tests/``.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from opsanalytics.operators import ml
from opsanalytics.operators.ordering import with_ranks
from opsanalytics.plans.driver_tables import read_table
from opsanalytics.plans.registry import finish, query
from opsanalytics.plans.sqlkit import sql_finish
from opsanalytics.session import cut_lineage

NUMERIC = ["n_chars", "n_words", "n_lines", "digit_share", "upper_share"]
CATEGORICAL = ["lang", "source"]
SEED = 42


def doc_features(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    lb = read_table(spark, sf_dir, "labels")
    t = F.col("text")
    n = F.greatest(F.length(t), F.lit(1))
    feats = d.select(
        "doc_id", "lang", "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.trim(t), "\\s+")).cast("double").alias("n_words"),
        F.size(F.split(t, "\n")).cast("double").alias("n_lines"),
        (F.regexp_count(t, F.lit("[0-9]")) / n).alias("digit_share"),
        (F.regexp_count(t, F.lit("[A-Z]")) / n).alias("upper_share"),
    )
    return feats.join(lb.select("doc_id", F.col("toxic").cast("double").alias("label")), "doc_id")


DOC_FEATURES_SQL = r"""feats AS (
  SELECT d.doc_id, d.lang, d.source, CAST(l.toxic AS DOUBLE) AS label, CAST(d.n_chars AS DOUBLE) AS n_chars,
         CAST(len(regexp_split_to_array(trim(d.text, ' '), '[ \t\n\x0B\f\r]+')) AS DOUBLE) AS n_words,
         CAST(len(string_split(d.text, chr(10))) AS DOUBLE) AS n_lines,
         length(regexp_replace(d.text, '[^0-9]', '', 'g')) * 1.0 / greatest(length(d.text), 1) AS digit_share,
         length(regexp_replace(d.text, '[^A-Z]', '', 'g')) * 1.0 / greatest(length(d.text), 1) AS upper_share
  FROM documents d JOIN labels l USING (doc_id))"""

SCORED_SQL = """scored AS (
  SELECT l.doc_id, CAST(l.toxic AS DOUBLE) AS label, d.n_chars / (d.n_chars + 1000.0) AS score
  FROM labels l JOIN documents d USING (doc_id)
)"""


def rule_scored(spark, sf_dir):
    """A fixed rule score in [0, 1): longer documents score higher."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lb = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    return lb.join(d, "doc_id").select("doc_id", "label", (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("score"))


# ----------------------------------------------------------------------------
# Exact stratified split and folds (counts are SQL-checked)
# ----------------------------------------------------------------------------
@query(
    "m1_stratified_split",
    "SELECT CAST(label AS BIGINT) AS label, s.split, CAST(CASE WHEN s.split = 'test' THEN round(n * 0.25) ELSE n - round(n * 0.25) END AS BIGINT) AS n "
    "FROM (SELECT toxic AS label, count(*) AS n FROM labels GROUP BY 1), (VALUES ('test'), ('train')) s(split)",
)
def m1_stratified_split(spark, sf_dir):
    lb = read_table(spark, sf_dir, "labels")
    sp = ml.stratified_split(lb.select("doc_id", F.col("toxic").alias("label")), "label", "doc_id", 0.25, SEED)
    return sp.groupBy(F.col("label").cast("bigint").alias("label"), "split").agg(F.count("*").alias("n"))


@query(
    "m10_stratified_folds",
    "SELECT CAST(label AS BIGINT) AS label, f.fold, CAST(n // 5 + CASE WHEN f.fold < n % 5 THEN 1 ELSE 0 END AS BIGINT) AS n "
    "FROM (SELECT toxic AS label, count(*) AS n FROM labels GROUP BY 1), (SELECT CAST(unnest(range(5)) AS INT) AS fold) f",
)
def m10_stratified_folds(spark, sf_dir):
    lb = read_table(spark, sf_dir, "labels")
    fo = ml.stratified_folds(lb.select("doc_id", F.col("toxic").alias("label")), "label", "doc_id", 5, SEED)
    return fo.groupBy(F.col("label").cast("bigint").alias("label"), "fold").agg(F.count("*").alias("n"))


# ----------------------------------------------------------------------------
# M11 / M12 / M13 on the rule score
# ----------------------------------------------------------------------------
@query(
    "m11_confusion_metrics",
    sql_finish(
        """
        WITH c AS (SELECT CAST(count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS BIGINT) AS tp,
                          CAST(count(*) FILTER (WHERE label <> 1 AND score >= 0.5) AS BIGINT) AS fp,
                          CAST(count(*) FILTER (WHERE label <> 1 AND NOT score >= 0.5) AS BIGINT) AS tn,
                          CAST(count(*) FILTER (WHERE label = 1 AND NOT score >= 0.5) AS BIGINT) AS fn FROM scored),
        m AS (SELECT *, (tp + tn) * 1.0 / (tp + fp + tn + fn) AS accuracy, tp * 1.0 / nullif(tp + fn, 0) AS recall,
                     fp * 1.0 / nullif(fp + tn, 0) AS false_alarm_rate, tp * 1.0 / nullif(tp + fp, 0) AS precision FROM c)
        SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1 FROM m
        """,
        doubles=["accuracy", "recall", "false_alarm_rate", "precision", "f1"], digits=6, ctes=SCORED_SQL,
    ),
)
def m11_confusion_metrics(spark, sf_dir):
    s = rule_scored(spark, sf_dir).withColumn("prediction", (F.col("score") >= 0.5).cast("double"))
    return finish(ml.confusion_metrics(s), digits=6)


SWEEP_SQL = """sweep0 AS (
  SELECT k / 100.0 AS threshold,
         CAST(count(*) FILTER (WHERE label = 1 AND score >= k / 100.0) AS BIGINT) AS tp,
         CAST(count(*) FILTER (WHERE label <> 1 AND score >= k / 100.0) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE label <> 1 AND NOT score >= k / 100.0) AS BIGINT) AS tn,
         CAST(count(*) FILTER (WHERE label = 1 AND NOT score >= k / 100.0) AS BIGINT) AS fn
  FROM scored, (SELECT unnest(range(5, 96)) AS k) g GROUP BY k
),
sweep1 AS (SELECT *, tp * 1.0 / nullif(tp + fn, 0) AS recall, fp * 1.0 / nullif(fp + tn, 0) AS fpr,
                  tp * 1.0 / nullif(tp + fp, 0) AS precision FROM sweep0),
sweep AS (SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1 FROM sweep1)"""


@query(
    "m12_threshold_sweep",
    sql_finish("SELECT * FROM sweep", doubles=["threshold", "recall", "fpr", "precision", "f1"], digits=6,
               ctes=SCORED_SQL + ",\n" + SWEEP_SQL),
)
def m12_threshold_sweep(spark, sf_dir):
    return finish(ml.threshold_sweep(rule_scored(spark, sf_dir)), digits=6)


@query(
    "m12_pick_threshold",
    sql_finish(
        "SELECT coalesce((SELECT threshold FROM sweep WHERE recall >= 0.8 AND fpr <= 0.05 "
        "ORDER BY coalesce(f1, -1.0) DESC, recall DESC, threshold ASC LIMIT 1), 0.5) AS threshold, "
        "EXISTS (SELECT 1 FROM sweep WHERE recall >= 0.8 AND fpr <= 0.05) AS constraints_met",
        doubles=["threshold"], ctes=SCORED_SQL + ",\n" + SWEEP_SQL,
    ),
)
def m12_pick_threshold(spark, sf_dir):
    return finish(ml.pick_threshold(ml.threshold_sweep(rule_scored(spark, sf_dir))))


@query(
    "m13_roc_auc",
    sql_finish(
        """
        WITH r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS ar FROM scored),
        t AS (SELECT sum(ar) FILTER (WHERE label = 1) AS rs, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS n FROM r)
        SELECT (rs - p * (p + 1) / 2.0) / (p * n) AS auc, CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg FROM t
        """,
        doubles=["auc"], digits=8, ctes=SCORED_SQL,
    ),
)
def m13_roc_auc(spark, sf_dir):
    return finish(ml.roc_auc(rule_scored(spark, sf_dir)), digits=8)


# ----------------------------------------------------------------------------
# Fitted models (row-count checked)
# ----------------------------------------------------------------------------
def _split_docs(spark, sf_dir):
    # Stored before and after the split: ranks, sizes and every fitted stage would each derive the features again.
    # Dealt over the cores: a small table would be one partition, and its rows pass a forest in one task.
    x = ml.spread(ml.stratified_split(cut_lineage(doc_features(spark, sf_dir)), "label", "doc_id", 0.25, SEED), ["doc_id"])
    return ml.fill_most_frequent(x, CATEGORICAL, x.filter(F.col("split") == "train"))


@query("m2_m3_preprocess")
def m2_m3_preprocess(spark, sf_dir):
    x = _split_docs(spark, sf_dir)
    stages = ml.preprocess_stages(NUMERIC, CATEGORICAL)
    from pyspark.ml import Pipeline

    model = Pipeline(stages=stages).fit(x.filter(F.col("split") == "train"))
    return model.transform(x).select("doc_id", "split", vector_to_array("features").alias("features"))


def _gappy(spark, sf_dir):
    """Document features with planted gaps."""
    x = doc_features(spark, sf_dir)
    return x.withColumns({"n_words": F.when(F.col("doc_id") % 7 != 0, F.col("n_words")), "lang": F.when(F.col("doc_id") % 11 != 0, F.col("lang"))})


GAPPY_SQL = """gappy AS (SELECT * REPLACE (CASE WHEN doc_id % 7 <> 0 THEN n_words END AS n_words, CASE WHEN doc_id % 11 <> 0 THEN lang END AS lang) FROM feats),
filled AS (SELECT * REPLACE (coalesce(n_words, (SELECT quantile_cont(n_words, 0.5) FROM gappy)) AS n_words,
           coalesce(lang, (SELECT lang FROM gappy WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)) AS lang) FROM gappy)"""


@query(
    "m3_prepared_features",
    sql_finish(
        "WITH " + DOC_FEATURES_SQL + ", " + GAPPY_SQL + """,
        slots AS (
          SELECT doc_id, f.feature, f.x FROM filled, LATERAL (SELECT unnest([""" + ", ".join(f"'{c}'" for c in NUMERIC)
        + "]) AS feature, unnest([" + ", ".join(NUMERIC) + """]) AS x) f
          UNION ALL SELECT doc_id, 'lang=' || v.lang, CAST(filled.lang = v.lang AS DOUBLE) FROM filled, (SELECT DISTINCT lang FROM filled) v)
        SELECT doc_id, feature, coalesce((x - avg(x) OVER w) / nullif(stddev_samp(x) OVER w, 0), 0) AS value FROM slots WINDOW w AS (PARTITION BY feature)
        """,
        doubles=["value"], digits=6,
    ),
)
def m3_prepared_features(spark, sf_dir):
    """M2 + M3 in long form: median and most frequent fill, one-hot levels, standardised slots."""
    from pyspark.ml import Pipeline

    x = _gappy(spark, sf_dir)
    x = cut_lineage(ml.fill_most_frequent(ml.fill_median(x, NUMERIC), ["lang"]))
    model = Pipeline(stages=ml.preprocess_stages(NUMERIC, ["lang"])).fit(x)
    names = ml.feature_names(model, NUMERIC, ["lang"])
    slots = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), vector_to_array("features").alias("value"))
    long = model.transform(x).select("doc_id", F.inline(slots))
    return finish(long.where("feature != 'lang=__unknown__'"), digits=6)


@query(
    "m5_ols_coefficients",
    sql_finish(
        "WITH " + DOC_FEATURES_SQL + """,
        s AS (SELECT var_pop(n_chars) AS aa, var_pop(n_lines) AS bb, covar_pop(n_chars, n_lines) AS ab, covar_pop(n_words, n_chars) AS ya,
                     covar_pop(n_words, n_lines) AS yb, avg(n_words) AS my, avg(n_chars) AS ma, avg(n_lines) AS mb FROM feats),
        b AS (SELECT (ya * bb - yb * ab) / (aa * bb - ab * ab) AS b1, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS b2, my, ma, mb FROM s),
        e AS (SELECT n_words - (my - b1 * ma - b2 * mb) - b1 * n_chars - b2 * n_lines AS e, n_words - my AS d FROM feats, b)
        SELECT (SELECT b1 FROM b) AS n_chars, (SELECT b2 FROM b) AS n_lines, (SELECT my - b1 * ma - b2 * mb FROM b) AS intercept,
               avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / sum(d * d) AS r2, CAST(count(*) AS BIGINT) AS n FROM e
        """,
        doubles=["n_chars", "n_lines", "intercept", "mae", "rmse", "r2"], digits=4,
    ),
)
def m5_ols_coefficients(spark, sf_dir):
    """M5 against its normal equations: words on characters and lines."""
    from pyspark.ml.feature import VectorAssembler

    cols = ["n_chars", "n_lines"]
    x = cut_lineage(doc_features(spark, sf_dir).select("doc_id", "n_words", *cols))
    x = VectorAssembler(inputCols=cols, outputCol="features").transform(x)
    model = ml.linear("n_words").fit(x)
    fit = {c: F.lit(float(b)) for c, b in zip(cols, model.coefficients, strict=True)} | {"intercept": F.lit(float(model.intercept))}
    return finish(ml.regression_metrics(model.transform(x), "n_words").withColumns(fit), digits=4)


def _fit_eval(spark, sf_dir, estimator_fn, weighted: bool = False, scored: bool = True):
    """The model fitted on the training rows, and the test rows, prepared and (if ``scored``) with the model's score."""
    x = _split_docs(spark, sf_dir)
    if weighted:
        x = ml.class_weights(x, "label")
    train, test = x.filter(F.col("split") == "train"), x.filter(F.col("split") == "test")
    model = ml.fit_pipeline(train, ml.preprocess_stages(NUMERIC, CATEGORICAL), estimator_fn(train), ["doc_id"])
    if not scored:
        from pyspark.ml import PipelineModel

        return model, PipelineModel(model.stages[:-1]).transform(test)
    return model, ml.positive_score(model.transform(test))


@query("m4_logistic_holdout")
def m4_logistic_holdout(spark, sf_dir):
    _, pred = _fit_eval(spark, sf_dir, lambda tr: ml.logistic(tr.count()))
    return _metrics_row(pred)


def _metrics_row(pred):
    cm = ml.confusion_metrics(pred)
    auc = ml.roc_auc(pred).select("auc").scalar()
    return cm.withColumn("auc", auc)


@query("m5_linear_regression")
def m5_linear_regression(spark, sf_dir):
    x = _split_docs(spark, sf_dir)
    num = [c for c in NUMERIC if c != "n_words"]
    train, test = x.filter(F.col("split") == "train"), x.filter(F.col("split") == "test")
    model = ml.fit_pipeline(train, ml.preprocess_stages(num, CATEGORICAL), ml.linear("n_words"))
    return ml.regression_metrics(model.transform(test), "n_words")


@query("m6_bagged_trees")
def m6_bagged_trees(spark, sf_dir):
    _, pred = _fit_eval(spark, sf_dir, lambda tr: ml.bagged_trees())
    return _metrics_row(pred)


@query("m7_weighted_forest")
def m7_weighted_forest(spark, sf_dir):
    _, pred = _fit_eval(spark, sf_dir, lambda tr: ml.forest(), weighted=True)
    return _metrics_row(cut_lineage(pred.select("doc_id", "label", "prediction", "score")))


@query("m8_boosted_trees")
def m8_boosted_trees(spark, sf_dir):
    _, pred = _fit_eval(spark, sf_dir, lambda tr: ml.boosted())
    return _metrics_row(cut_lineage(pred.select("doc_id", "label", "prediction", "score")))


# ----------------------------------------------------------------------------
# Five stratified folds for every model
# ----------------------------------------------------------------------------
def _prepared(train):
    """Preprocessing learned from the training rows only."""
    from pyspark.ml import Pipeline

    filled = ml.fill_most_frequent(train, CATEGORICAL)
    prep = Pipeline(stages=ml.preprocess_stages(NUMERIC, CATEGORICAL)).fit(filled)
    return prep, prep.transform(filled), lambda rows: prep.transform(ml.fill_most_frequent(rows, CATEGORICAL, train))


def _fit_logistic(train):
    _, x, prepare = _prepared(train)
    model = ml.logistic(x.count()).fit(x)
    return lambda test: ml.positive_score(model.transform(prepare(test)))


def _fit_forest(train):
    _, x, prepare = _prepared(train)
    model = ml.forest().fit(ml.spread(ml.class_weights(x, "label").select("doc_id", "label", "weight", "features"), ["doc_id"]))
    return lambda test: ml.positive_score(model.transform(prepare(test)))


def _fit_smote(estimator):
    """M9: the minority is filled up with synthetic rows inside the training fold, never in the test fold."""
    def fit(train):
        _, x, prepare = _prepared(train)
        balanced = ml.spread(ml.smote(x, "label", "features", k=5, seed=SEED, id_col="doc_id"), ["doc_id"])
        model = estimator(balanced).fit(balanced)
        return lambda test: ml.positive_score(model.transform(prepare(test)))
    return fit


def _cv(spark, sf_dir, fit, parallel: int = 5):
    return ml.cross_validate(doc_features(spark, sf_dir), "label", "doc_id", fit, 5, SEED, parallel)


@query("m10_cv_scores")
def m10_cv_scores(spark, sf_dir):
    return _cv(spark, sf_dir, _fit_logistic)


@query("m10_cv_forest")
def m10_cv_forest(spark, sf_dir):
    """The 400-tree forest, validated on five folds: two at a time fill the cores, and the driver plans fewer jobs at once."""
    return _cv(spark, sf_dir, _fit_forest, parallel=2)


@query("m9_smote_cv")
def m9_smote_cv(spark, sf_dir):
    return _cv(spark, sf_dir, _fit_smote(lambda rows: ml.logistic(rows.count())))


@query("m9_cv_boosted")
def m9_cv_boosted(spark, sf_dir):
    """SMOTE and 400 boosting rounds, validated on five folds."""
    return _cv(spark, sf_dir, _fit_smote(lambda rows: ml.boosted()))


FOLDS_SQL = """folds AS (
  SELECT fold, CAST(sum(t) FILTER (label = 1) AS BIGINT) AS positives, CAST(sum(t) FILTER (label = 0) AS BIGINT) AS negatives,
         CAST(sum(n - t) AS BIGINT) AS train_rows, CAST(max(n - t) AS BIGINT) AS larger, CAST(min(n - t) AS BIGINT) AS smaller
  FROM (SELECT label, fold, n, n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS t
        FROM (SELECT toxic AS label, count(*) AS n FROM labels SEMI JOIN documents USING (doc_id) GROUP BY 1), (SELECT unnest(range(5)) AS fold))
  GROUP BY fold)"""


@query("m10_cv_counts", f"WITH {FOLDS_SQL} SELECT CAST(fold AS BIGINT) AS fold, train_rows, positives, negatives, positives + negatives AS test_rows FROM folds")
def m10_cv_counts(spark, sf_dir):
    """What the folds' confusion counts add up to: every row is tested once, by a model that never saw it."""
    cv = _cv(spark, sf_dir, _fit_logistic)
    return cv.select(F.col("fold").cast("bigint").alias("fold"), F.col("train_rows").cast("bigint").alias("train_rows"),
                     (F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives"),
                     F.expr("tp + fp + tn + fn").alias("test_rows"))


@query("m9_smote_balance", f"WITH {FOLDS_SQL} SELECT CAST(fold AS BIGINT) AS fold, larger AS n_larger, larger AS n_balanced, larger - smaller AS n_synthetic FROM folds")
def m9_smote_balance(spark, sf_dir):
    """Class sizes after SMOTE inside each training fold."""
    folds = cut_lineage(ml.stratified_folds(doc_features(spark, sf_dir), "label", "doc_id", 5, SEED))
    out = None
    for f in range(5):
        _, x, _ = _prepared(folds.filter(F.col("fold") != f))
        balanced = ml.smote(x, "label", "features", k=5, seed=SEED, id_col="doc_id")
        sizes = balanced.groupBy("label").agg(F.count("*").alias("n"), ml.count_where(F.col("synthetic")).alias("s"))
        row = sizes.agg(F.lit(f).cast("bigint").alias("fold"), F.max("n").alias("n_larger"), F.min("n").alias("n_balanced"), F.sum("s").alias("n_synthetic"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "m9_neighbours",
    sql_finish(
        """
        WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings)
        SELECT a.vec_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x)) - 1 AS rank, list_distance(a.x, b.x) AS dist
        FROM e a JOIN e b ON a.vec_id <> b.vec_id QUALIFY rank < 5
        """,
        doubles=["dist"], digits=6, bigints=["rank"],
    ),
)
def m9_neighbours(spark, sf_dir):
    """The neighbour search of SMOTE over all vectors: distances to the five nearest."""
    e = read_table(spark, sf_dir, "embeddings")
    nn = ml.knn_within(e.select("vec_id", "embedding"), 5, id_col="vec_id", x_col="embedding")
    return finish(nn.select(F.col("qid").alias("vec_id"), "rank", "dist"), digits=6)


@query("m14_kmeans_profile")
def m14_kmeans_profile(spark, sf_dir):
    from pyspark.ml.feature import StandardScaler

    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("raw"))
    sc = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(e)
    z = sc.transform(e)
    km = ml.kmeans_best(z, k=3, seeds=range(20))
    c = km.transform(z)
    return c.groupBy("cluster").agg(F.count("*").alias("n"), F.avg((F.col("label") == 3).cast("double")).alias("label3_rate"),
                                    F.avg("label").alias("mean_label"))


def _segments(spark, sf_dir):
    """Documents in three segments of their standardised numeric features."""
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    x = cut_lineage(doc_features(spark, sf_dir).select("doc_id", "label", *NUMERIC))
    raw = VectorAssembler(inputCols=NUMERIC, outputCol="raw", handleInvalid="skip").transform(x)
    z = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(raw).transform(raw)
    return ml.kmeans_best(z, k=3, seeds=range(20)).transform(z)


@query("m14_cluster_profile")
def m14_cluster_profile(spark, sf_dir):
    return ml.cluster_profile(_segments(spark, sf_dir), NUMERIC, "label")


@query(
    "m14_profile_totals",
    sql_finish(
        "SELECT CAST(count(*) AS BIGINT) AS n, " + ", ".join(f"avg({c}) AS {c}" for c in [*NUMERIC, "label"]) + " FROM feats",
        doubles=[*NUMERIC, "label"], digits=6, ctes=DOC_FEATURES_SQL,
    ),
)
def m14_profile_totals(spark, sf_dir):
    """The cluster profile put together again: means weighted by cluster size are the means of all rows."""
    prof = ml.cluster_profile(_segments(spark, sf_dir), NUMERIC, "label")
    means = [(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in [*NUMERIC, "label"]]
    return finish(prof.agg(F.sum("n").alias("n"), *means), digits=6)


@query("m15_boosted_importance")
def m15_boosted_importance(spark, sf_dir):
    """Gain importance of every slot in the model that is put to use: SMOTE and boosting, trained on the training rows."""
    train = _split_docs(spark, sf_dir).filter(F.col("split") == "train")
    prep, x, _ = _prepared(train)
    balanced = ml.spread(ml.smote(x, "label", "features", k=5, seed=SEED, id_col="doc_id"), ["doc_id"])
    pairs = ml.feature_importance(ml.boosted().fit(balanced), ml.feature_names(prep, NUMERIC, CATEGORICAL), 15)
    return spark.createDataFrame(pairs, "feature string, importance double")


@query("m15_feature_importance")
def m15_feature_importance(spark, sf_dir):
    model, _ = _fit_eval(spark, sf_dir, lambda tr: ml.forest(), weighted=True, scored=False)
    names = ml.feature_names(model, NUMERIC, CATEGORICAL)
    pairs = ml.feature_importance(model.stages[-1], names, 15)
    return spark.createDataFrame(pairs, "feature string, importance double")


@query("m16_permutation_importance")
def m16_permutation_importance(spark, sf_dir):
    """Permutation importance: AUC drop when one numeric column is shuffled in the test set."""
    model, pred = _fit_eval(spark, sf_dir, lambda tr: ml.logistic(tr.count()))
    test = _split_docs(spark, sf_dir).filter(F.col("split") == "test")
    base = ml.roc_auc(pred).select("auc").scalar()
    numbered = with_ranks(test.withColumn("_h1", F.xxhash64("doc_id")), ["_h1", "doc_id"])
    out = None
    for i, c in enumerate(NUMERIC):
        donor = with_ranks(test.select("doc_id", c).withColumn("_h2", F.xxhash64("doc_id", F.lit(i + 1))), ["_h2", "doc_id"])
        donor = donor.select(F.col("_rn"), F.col(c).alias("_perm"))
        shuffled = numbered.join(donor, "_rn").withColumn(c, F.col("_perm")).drop("_perm", "_rn", "_h1")
        auc = ml.roc_auc(ml.positive_score(model.transform(shuffled))).select("auc").scalar()
        row = spark.range(1).select(F.lit(c).alias("feature"), (base - auc).alias("auc_drop"))
        out = row if out is None else out.unionByName(row)
    return out


@query("m17_local_explanation")
def m17_local_explanation(spark, sf_dir):
    model, pred = _fit_eval(spark, sf_dir, lambda tr: ml.logistic(tr.count()))
    names = ml.feature_names(model, NUMERIC, CATEGORICAL)
    lr = model.stages[-1]
    contrib = ml.linear_contributions(pred, lr.coefficients.toArray(), names)
    top = pred.agg(F.max_by("doc_id", F.struct("score", "doc_id")).alias("d")).select("d").scalar()
    return contrib.filter(F.col("doc_id") == top).select("doc_id", "score", "feature", "contribution")


@query("m18_review_queue")
def m18_review_queue(spark, sf_dir):
    _, pred = _fit_eval(spark, sf_dir, lambda tr: ml.logistic(tr.count()))
    pred = cut_lineage(pred.select("doc_id", "label", "score"))
    t = ml.queue_threshold(ml.threshold_sweep(pred)).first()["threshold"]
    return ml.review_queue(pred, t, ["doc_id", "label"])


@query(
    "m18_review_queue_rule",
    sql_finish(
        "SELECT doc_id, label, score FROM scored WHERE score >= (SELECT least(coalesce((SELECT threshold FROM sweep WHERE recall >= 0.8 AND fpr <= 0.05 "
        "ORDER BY coalesce(f1, -1.0) DESC, recall DESC, threshold ASC LIMIT 1), 0.5), (SELECT max(threshold) FROM sweep WHERE tp + fp > 0)))",
        doubles=["label", "score"], digits=6, ctes=SCORED_SQL + ",\n" + SWEEP_SQL,
    ),
)
def m18_review_queue_rule(spark, sf_dir):
    scored = rule_scored(spark, sf_dir)
    t = ml.queue_threshold(ml.threshold_sweep(scored)).first()["threshold"]
    return finish(ml.review_queue(scored, t, ["doc_id", "label"]), digits=6)


def _forest_contributions(spark, sf_dir, top: bool = False):
    """Contributions of the weighted forest for the test rows; ``top``: for the one with the highest score (ties: the
    larger id).  Scoring sends all rows past the whole forest, so that only a query that reads a score pays for it."""
    import uuid

    from opsanalytics.session import checkpoint_dir

    model, pred = _fit_eval(spark, sf_dir, lambda tr: ml.forest(), weighted=True, scored=top)
    pred = cut_lineage(pred.select("doc_id", "features", *["score"] * top))
    if top:
        first = pred.agg(F.max_by("doc_id", F.struct("score", "doc_id")).alias("d")).select("d").scalar()
        pred = pred.filter(F.col("doc_id") == first)
    names = ml.feature_names(model, NUMERIC, CATEGORICAL)
    work = f"{checkpoint_dir(spark)}/models/forest-{uuid.uuid4().hex}"
    return ml.tree_contributions(pred, model.stages[-1], names, work, id_col="doc_id")


@query("m17_tree_local_explanation")
def m17_tree_local_explanation(spark, sf_dir):
    """Path contributions of the weighted forest for the highest-risk test row."""
    return _forest_contributions(spark, sf_dir, top=True)


@query("m16_mean_abs_contribution")
def m16_mean_abs_contribution(spark, sf_dir):
    """Global explanation: mean |path contribution| per feature over the test rows."""
    contrib = _forest_contributions(spark, sf_dir)
    return contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
