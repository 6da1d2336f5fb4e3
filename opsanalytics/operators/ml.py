"""Machine learning on Spark ML.

Splits and folds are exact and repeatable: rows are ordered by a seeded hash
and numbered per class with :func:`ordering.with_ranks` (a class of any size
spans many tasks).  Evaluation metrics are aggregates: confusion counts, a
threshold sweep built from score-bin counts with running sums, and ROC-AUC from
the rank-sum formula over per-score counts -- no cross join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsanalytics.functions.nulls import count_where
from opsanalytics.operators.forests import DealtForestClassifier, DealtForestModel
from opsanalytics.operators.ordering import with_ranks
from opsanalytics.operators.quantiles import exact_quantiles
from opsanalytics.session import cut_lineage

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
THRESHOLD_GRID = (5, 95)  # thresholds 0.05 ... 0.95 in steps of 0.01
MIN_RECALL = 0.80
MAX_FPR = 0.05
FALLBACK_THRESHOLD = 0.50


def _hash_unit(key: str, seed: int) -> Column:
    """A seeded hash of the key mapped to [0, 1)."""
    return (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 40)).cast("double")) / float(1 << 40)


def class_row_numbers(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Row number per class in seeded-hash order (``_rn``) plus the class size (``_n``)."""
    x = df.withColumn("_h", _hash_unit(key, seed))
    numbered = with_ranks(x, ["_h", key], [label])
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    return numbered.join(F.broadcast(sizes), label)  # one row per class


def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.25, seed: int = 42) -> DataFrame:
    """M1: exact per-class test share (round(n * frac) rows per class), column ``split``."""
    x = class_row_numbers(df, label, key, seed)
    test = F.col("_rn") <= F.round(F.col("_n") * test_frac)
    return x.withColumn("split", F.when(test, "test").otherwise("train")).drop("_h", "_rn", "_n")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """fold = (row number within class - 1) mod k, column ``fold``."""
    x = class_row_numbers(df, label, key, seed)
    return x.withColumn("fold", ((F.col("_rn") - 1) % k).cast("int")).drop("_h", "_rn", "_n")


def class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """M7 balanced weights n / (n_classes * n_c), joined from a per-class aggregate."""
    counts = df.groupBy(label).agg(F.count("*").alias("_nc"))
    total = counts.agg(F.sum("_nc")).scalar()
    k = counts.agg(F.count("*")).scalar()
    w = counts.select(label, (total / (k * F.col("_nc"))).alias(weight_col))
    return df.join(F.broadcast(w), label)


# ---------------------------------------------------------------------------
# M2 / M3: preprocessing
# ---------------------------------------------------------------------------
def preprocess_stages(numeric: Sequence[str], categorical: Sequence[str], scale: bool = True) -> list:
    """M3 (+M2): median impute numerics, most-frequent fill is done in data, one-hot
    categoricals (unknown kept), assemble, optionally standardise."""
    stages = []
    imp_out = [f"{c}__imp" for c in numeric]
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=list(numeric), outputCols=imp_out))
    idx_out = [f"{c}__idx" for c in categorical]
    oh_out = [f"{c}__oh" for c in categorical]
    for c, o in zip(categorical, idx_out):
        stages.append(StringIndexer(inputCol=c, outputCol=o, handleInvalid="keep", stringOrderType="alphabetAsc"))
    if categorical:
        stages.append(OneHotEncoder(inputCols=idx_out, outputCols=oh_out, dropLast=False, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=imp_out + oh_out, outputCol="features_raw", handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True))
    return stages


def fill_most_frequent(df: DataFrame, cols: Sequence[str], learned_on: DataFrame | None = None) -> DataFrame:
    """M3: missing categorical <- most frequent value (ties -> smallest) of ``learned_on``, the training rows."""
    rows = df if learned_on is None else learned_on
    modes = {}
    for c in cols:  # counts per value, then one row: no map of all values in one task
        top = rows.filter(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).first()
        modes |= {c: top[0]} if top else {}
    return df.na.fill(modes) if modes else df


def fill_median(df: DataFrame, cols: Sequence[str], learned_on: DataFrame | None = None) -> DataFrame:
    """M2: missing numerics <- exact median of ``learned_on``, the training rows."""
    rows = df if learned_on is None else learned_on
    found = [(c, exact_quantiles(rows.select(c), c, [0.5]).select("q0").first()) for c in cols]
    medians = {c: float(r[0]) for c, r in found if r is not None and r[0] is not None}
    return df.na.fill(medians) if medians else df


def feature_names(model: PipelineModel, numeric: Sequence[str], categorical: Sequence[str]) -> list[str]:
    """Slot names of the assembled vector (numerics, then each one-hot level)."""
    names = list(numeric)
    indexers = [s for s in model.stages if s.__class__.__name__ == "StringIndexerModel"]
    for c, ix in zip(categorical, indexers):
        names += [f"{c}={v}" for v in ix.labels] + [f"{c}=__unknown__"]
    return names


# ---------------------------------------------------------------------------
# models
# ---------------------------------------------------------------------------
def logistic(n_train: int, label: str = "label", c: float = 1.0) -> LogisticRegression:
    """M4: L2 logistic regression with C = 1 -> regParam = 1 / (C n)."""
    return LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (c * max(n_train, 1)),
                              elasticNetParam=0.0, standardization=False, maxIter=200)


def linear(label: str) -> LinearRegression:
    """M5: ordinary least squares."""
    return LinearRegression(featuresCol="features", labelCol=label, regParam=0.0)


def bagged_trees(label: str = "label", n: int = 40, depth: int = 5, seed: int = 42) -> RandomForestClassifier:
    """M6: bagging = random forest that sees every feature at every split."""
    return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=n, maxDepth=depth,
                                  featureSubsetStrategy="all", bootstrap=True, seed=seed)


def forest(label: str = "label", n: int = 400, min_leaf: int = 2, weight_col: str | None = "weight", seed: int = 42, depth: int = 30):
    """M7: random forest, minimum leaf size, balanced class weights.

    The leaf size is meant to end the trees; 30 is the deepest tree Spark builds.  The trees grow in tasks
    (:mod:`forests`): deep trees over many rows do not fit the driver.  Where Spark's own forest is fitted instead,
    the node of every row is kept per tree."""
    rf = DealtForestClassifier(featuresCol="features", labelCol=label, numTrees=n, minInstancesPerNode=min_leaf, seed=seed,
                               maxDepth=depth, cacheNodeIds=True)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def boosted(label: str = "label", n: int = 400, depth: int = 5, lr: float = 0.05, row: float = 0.85, col: str = "0.9",
            seed: int = 42) -> GBTClassifier:
    """M8: gradient-boosted trees."""
    return GBTClassifier(featuresCol="features", labelCol=label, maxIter=n, maxDepth=depth, stepSize=lr,
                         subsamplingRate=row, featureSubsetStrategy=col, seed=seed)


def spread(rows: DataFrame, order: Sequence[str], part_rows: int = 20_000) -> DataFrame:
    """The training rows, stored in a partition per core (more where one would exceed ``part_rows`` rows).

    A tree model passes over its rows hundreds of times, and each pass costs a task per partition:
    the partitions that ranks and joins leave are one for small tables and far too many for large ones.
    Rows are sorted inside the partitions, so that their seeded draws do not depend on the order of arrival."""
    rows = cut_lineage(rows)
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // part_rows))
    return cut_lineage(rows.repartition(n, *order).sortWithinPartitions(*order))


def fit_pipeline(train: DataFrame, stages: list, model, order: Sequence[str] | None = None) -> PipelineModel:
    """Preprocessing and model; with ``order`` the prepared rows are dealt evenly by these columns first."""
    prep = Pipeline(stages=stages).fit(train)
    x = prep.transform(train)
    return PipelineModel(stages=[*prep.stages, model.fit(spread(x, order) if order else x)])


def positive_score(pred: DataFrame, prob_col: str = "probability") -> DataFrame:
    """Probability of the positive class as a double column ``score``."""
    return pred.withColumn("score", vector_to_array(F.col(prob_col))[1])


def kmeans_best(df: DataFrame, k: int = 3, seeds: Sequence[int] = range(20), features: str = "features"):
    """Best of several seeded runs by within-cluster cost."""
    best = None
    for s in seeds:
        m = KMeans(k=k, seed=s, featuresCol=features, predictionCol="cluster").fit(df)
        cost = m.summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, m)
    return best[1]


def cluster_profile(clustered: DataFrame, numeric: Sequence[str], rate: str, cluster: str = "cluster") -> DataFrame:
    """Rows, mean of each numeric column and mean of ``rate`` per cluster, highest rate first."""
    means = [F.avg(c).alias(c) for c in [*numeric, rate]]
    return clustered.groupBy(cluster).agg(F.count("*").alias("n"), *means).orderBy(F.desc(rate), cluster)


def cross_validate(rows: DataFrame, label: str, key: str, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
                   k: int = 5, seed: int = 42, parallel: int = 5) -> DataFrame:
    """One row per stratified fold: its confusion counts, rates and AUC, and the rows trained and tested on.

    ``fit(train)`` learns from a fold's training rows only and returns the scoring of other
    rows (columns ``prediction`` and ``score``).  Folds are stored once; their fits run as
    concurrent Spark jobs."""
    folds = cut_lineage(stratified_folds(rows, label, key, k, seed))

    def one(f: int) -> DataFrame:
        train, test = folds.filter(F.col("fold") != f).drop("fold"), folds.filter(F.col("fold") == f).drop("fold")
        scored = cut_lineage(fit(train)(test).select(label, "prediction", "score"))
        return fold_metrics(scored, label).withColumns({"fold": F.lit(f), "train_rows": F.lit(train.count())})

    with ThreadPoolExecutor(parallel) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, range(k)))


def fold_metrics(scored: DataFrame, label: str = "label") -> DataFrame:
    """Confusion counts and rates (M11) with the AUC (M13), one row."""
    return confusion_metrics(scored, label).withColumn("auc", roc_auc(scored, label).select("auc").scalar())


# ---------------------------------------------------------------------------
# evaluation
# ---------------------------------------------------------------------------
def confusion_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Confusion counts, accuracy, sensitivity (recall), false-alarm rate, precision, F1."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    c = df.agg(
        count_where(y & p).alias("tp"), count_where(~y & p).alias("fp"),
        count_where(~y & ~p).alias("tn"), count_where(y & ~p).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    prec = F.try_divide(tp.cast("double"), tp + fp)
    rec = F.try_divide(tp.cast("double"), tp + fn)
    return c.withColumns(
        {
            "accuracy": (tp + tn) / (tp + fp + tn + fn),
            "recall": rec,
            "false_alarm_rate": F.try_divide(fp.cast("double"), fp + tn),
            "precision": prec,
            "f1": F.try_divide(2 * prec * rec, prec + rec),
        }
    )


def _grid_bin(score: Column, lo: int, hi: int) -> Column:
    """Index k of the largest grid threshold k/100 <= score (lo - 1 when below all).

    Compared against the exact doubles k / 100.0 so the result equals a direct
    ``score >= k / 100.0`` test.
    """
    k = F.floor(score * 100).cast("int")
    k = F.when((k + 1) / 100.0 <= score, k + 1).when(k / 100.0 > score, k - 1).otherwise(k)
    return F.greatest(F.least(k, F.lit(hi)), F.lit(lo - 1))


def threshold_sweep(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """TP/FP/TN/FN and rates at every threshold 0.05..0.95.

    Rows are reduced to counts per grid bin and class (<= 92 x 2 rows); the
    counts at or above each threshold are running sums over those bins.
    """
    lo, hi = THRESHOLD_GRID
    y = F.col(label) == 1
    bins = scored.groupBy(_grid_bin(F.col(score), lo, hi).alias("k")).agg(
        count_where(y).alias("pos"), count_where(~y).alias("neg"))
    grid = scored.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("k"))
    full = grid.unionByName(bins.select("k").filter(F.col("k") < lo)).join(bins, "k", "left").na.fill({"pos": 0, "neg": 0})
    w_ge = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)  # <= 92 rows
    totals = bins.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P, N = totals.select("P").scalar(), totals.select("N").scalar()
    x = full.withColumns({"tp": F.sum("pos").over(w_ge), "fp": F.sum("neg").over(w_ge)}).filter(F.col("k") >= lo)
    x = x.withColumns({"fn": P - F.col("tp"), "tn": N - F.col("fp")})
    prec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp").cast("double"), P)
    x = x.select(
        (F.col("k") / 100.0).alias("threshold"), F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        F.col("tn").cast("bigint").alias("tn"), F.col("fn").cast("bigint").alias("fn"),
        rec.alias("recall"), F.try_divide(F.col("fp").cast("double"), N).alias("fpr"), prec.alias("precision"),
    )
    return x.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def pick_threshold(sweep: DataFrame) -> DataFrame:
    """Among thresholds with recall >= 0.8 and FPR <= 0.05, best F1 then recall; else 0.50."""
    ok = sweep.filter((F.col("recall") >= MIN_RECALL) & (F.col("fpr") <= MAX_FPR))
    best = ok.agg(F.max_by(F.col("threshold"), F.struct(F.coalesce("f1", F.lit(-1.0)), "recall", -F.col("threshold"))).alias("t"))
    t = best.select("t").scalar()
    return sweep.sparkSession.range(1).select(
        F.coalesce(t, F.lit(FALLBACK_THRESHOLD)).alias("threshold"), t.isNotNull().alias("constraints_met"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """AUC by the rank-sum formula, ties counted half; NULL if one class is missing.

    Counts per distinct score; the negatives strictly below each score are a
    running sum over range partitions (:mod:`ordering`), so no task sorts all scores.
    """
    y = F.col(label) == 1
    per = scored.groupBy(F.col(score).alias("s")).agg(count_where(y).alias("pos"), count_where(~y).alias("neg"))
    x = with_ranks(per, ["s"], sums={"neg_below": "neg"})
    agg = x.agg(F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("wins"),
                F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(F.try_divide(F.col("wins"), F.col("P") * F.col("N")).alias("auc"), F.col("P").cast("bigint").alias("n_pos"),
                      F.col("N").cast("bigint").alias("n_neg"))


def queue_threshold(sweep: DataFrame) -> DataFrame:
    """The picked threshold (M12) if it leaves a queue, else the largest grid threshold that does."""
    picked = pick_threshold(sweep).select("threshold").scalar()
    queued = F.col("tp") + F.col("fp") > 0
    reach = sweep.filter(queued).agg(F.max("threshold")).scalar()
    return sweep.sparkSession.range(1).select(F.least(picked, reach).alias("threshold"))


def review_queue(scored: DataFrame, threshold: float, keep: Sequence[str], score: str = "score") -> DataFrame:
    """Rows at or above the threshold, highest risk first."""
    return scored.filter(F.col(score) >= threshold).select(*keep, score).orderBy(F.desc(score), *keep)


def feature_importance(model, names: Sequence[str], top: int = 15) -> list[tuple[str, float]]:
    """A fitted tree model's importances by slot name (driver-side: one value per feature)."""
    imp = model.featureImportances.toArray()
    pairs = sorted(((n, float(v)) for n, v in zip(names, imp)), key=lambda t: (-t[1], t[0]))
    return pairs[:top]


def linear_contributions(scored: DataFrame, coef: Sequence[float], names: Sequence[str], features: str = "features") -> DataFrame:
    """M17 for a linear model: beta_j * (x_j - mean_j) per feature (exact decomposition
    of the margin around the mean row); long form per row."""
    arr = vector_to_array(F.col(features))
    means = scored.agg(*[F.avg(arr[i]).alias(f"m{i}") for i in range(len(names))]).first()
    contrib = F.array(*[F.struct(F.lit(n).alias("feature"), (F.lit(float(b)) * (arr[i] - F.lit(float(means[i])))).alias("contribution"))
                        for i, (n, b) in enumerate(zip(names, coef))])
    return scored.select("*", F.inline(contrib))


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M5: MAE, RMSE and R^2 as one aggregate (mean of label as a scalar subquery)."""
    e = F.col(label) - F.col(prediction)
    # The label mean is a scalar subquery projected first (aggregates may not wrap one).
    x = pred.withColumn("_dev", F.col(label) - pred.agg(F.avg(label)).scalar())
    return x.agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.sum(e * e) / F.sum(F.col("_dev") ** 2)).alias("r2"), F.count("*").alias("n"),
    )


# ---------------------------------------------------------------------------
# M9: exact k nearest neighbours by pivot cells, SMOTE inside a training fold
# ---------------------------------------------------------------------------
MAX_PIVOTS = 256
VISITS = 4          # blocks a point looks at in the first round; twice as many in the next, and so on
MOST_VISITS = 16
QUERIES = 8_000     # points of one task that look at a block
SLACK = 1e-9        # relative, for the rounding of distances in bounds


def _distances(q, c):
    """Euclidean distances by differences (exact up to rounding), in slices of bounded size."""
    import numpy as np

    step = max(1, 4_000_000 // max(c.size, 1))
    return np.concatenate([np.sqrt(((q[i:i + step, None, :] - c[None, :, :]) ** 2).sum(2)) for i in range(0, len(q), step)])


def _to_pivots(pivots):
    """Nearest pivot of every point and the distance to it."""
    import numpy as np
    import pandas as pd

    def run(batches):
        for pdf in batches:
            if len(pdf):
                d = _distances(np.stack(pdf["x"].to_numpy()).astype(float), pivots)
                cell = d.argmin(1)
                yield pd.DataFrame({"id": pdf["id"], "x": pdf["x"], "cell": cell, "far": d[np.arange(len(d)), cell]})

    return run


def _next_blocks(pivots, blocks, visits: int):
    """For each point the next ``visits`` blocks, in the order of their lower bound, that can still hold a neighbour
    (points without any are left out).

    Ring ``lo..hi`` of a cell: no point in it is nearer than the gap between the ring and the
    query's own distance to the pivot."""
    import numpy as np
    import pandas as pd

    cell, lo, hi = (np.array([b[c] for b in blocks]) for c in ("cell", "lo", "hi"))

    def run(batches):
        for pdf in batches:
            for i in range(0, len(pdf), 512):
                part = pdf.iloc[i:i + 512]
                d = _distances(np.stack(part["x"].to_numpy()).astype(float), pivots)[:, cell]
                low = np.maximum(np.maximum(d - hi, lo - d) - SLACK * (d + hi), 0.0)
                order = np.argsort(low, axis=1, kind="stable")
                at = part["seen"].to_numpy()[:, None] + np.arange(visits)[None, :]
                inside = at < len(cell)
                block = np.take_along_axis(order, np.minimum(at, len(cell) - 1), axis=1)
                near = np.take_along_axis(low, block, axis=1) <= part["reach"].to_numpy()[:, None]
                go = inside & near
                some = np.flatnonzero(go.any(1))
                yield pd.DataFrame({"id": part["id"].to_numpy()[some], "x": part["x"].to_numpy()[some],
                                    "blocks": pd.Series([block[i, go[i]] for i in some], dtype=object)})

    return run


def _nearest(q, points, skip, k: int):
    """(row, col, distance) of the ``k`` nearest points of every row of ``q``, nearest first (ties: the earlier point).

    A matrix product gives all squared distances up to a rounding error that is bounded per row; only points that
    the error lets be among the ``k`` nearest get their distance by differences, which decides."""
    import numpy as np

    mid = points.mean(0)
    a, b = q - mid, points - mid
    size = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    rough = size - 2.0 * (a @ b.T)
    if np.isfinite(rough).all():
        error = 16.0 * (q.shape[1] + 8) * np.finfo(float).eps * size.max(1)
        rough[skip] = np.inf
        kth = np.partition(rough, min(k, len(points)) - 1, axis=1)[:, min(k, len(points)) - 1]
        near = (rough <= (kth + 2.0 * error)[:, None]) & ~skip
    else:
        near = ~skip
    row, col = np.nonzero(near)
    step = max(1, 4_000_000 // q.shape[1])
    dist = np.concatenate([np.zeros(0)] + [np.sqrt(((q[row[i:i + step]] - points[col[i:i + step]]) ** 2).sum(1)) for i in range(0, len(row), step)])
    found = np.isfinite(dist)
    row, col, dist = row[found], col[found], dist[found]
    order = np.lexsort((col, dist, row))
    row, col, dist = row[order], col[order], dist[order]
    first = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[first], col[first], dist[first]


def _block_knn(k: int):
    import numpy as np
    import pandas as pd

    def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"id": pd.Series([], dtype="int64"), "cid": pd.Series([], dtype="int64"), "dist": pd.Series([], dtype="float64")})
        c = c.sort_values("id")
        points, cid = np.stack(c["x"].to_numpy()).astype(float), c["id"].to_numpy()
        out = []
        for i in range(0, len(q), 512):
            ids = q["id"].to_numpy()[i:i + 512]
            own = ids[:, None] == cid[None, :]  # a point is not its own neighbour
            row, col, dist = _nearest(np.stack(q["x"].to_numpy()[i:i + 512]).astype(float), points, own, k)
            out.append(pd.DataFrame({"id": ids[row], "cid": cid[col], "dist": dist}))
        return pd.concat(out)

    return run


def knn_within(points: DataFrame, k: int, block_rows: int = 4_000, id_col: str = "id", x_col: str = "x") -> DataFrame:
    """Exact k nearest neighbours of every point among the same points (ties: the smaller id).

    Points go to the cell of their nearest pivot, and cells are cut into rings of at most
    ``block_rows`` points by the distance to the pivot (ranks in range partitions, so a cell
    that holds a third of the points is many blocks).  Pivot, ring and triangle inequality give
    every block a lower bound for every point.  In rounds each point looks at its next blocks
    (``VISITS``, then twice as many, up to ``MOST_VISITS``) in the order of the bounds, and stops
    when the next bound exceeds its k-th distance: the exact stop bound.  A block meets its points in tasks of about
    ``QUERIES`` of them; local top-ks merge by an aggregate, so a point carries k rows.

    The driver holds the pivots (at most ``MAX_PIVOTS``) and three numbers per block.
    """
    pts = points.select(F.col(id_col).cast("long").alias("id"), F.col(x_col).cast("array<double>").alias("x"))
    m = pts.count()
    n_pivots = max(1, min(MAX_PIVOTS, -(-m // block_rows)))
    import numpy as np

    chosen = pts.orderBy(F.xxhash64("id"), "id").limit(n_pivots).collect()
    if not chosen:
        return pts.select(F.col("id").alias("qid"), F.lit(0).alias("rank"), F.col("id").alias("cid"), F.lit(0.0).alias("dist"))
    pivots = np.array([r["x"] for r in chosen], float)
    placed = pts.mapInPandas(_to_pivots(pivots), "id long, x array<double>, cell int, far double")
    ring = F.floor((F.col("_rn") - 1) / block_rows)
    placed = cut_lineage(with_ranks(placed, ["far", "id"], ["cell"]).select("id", "x", "cell", "far", ring.alias("ring")))
    blocks = [r.asDict() for r in placed.groupBy("cell", "ring").agg(F.min("far").alias("lo"), F.max("far").alias("hi"))
              .orderBy("cell", "ring").collect()]
    numbers = pts.sparkSession.createDataFrame([(b["cell"], b["ring"], i) for i, b in enumerate(blocks)], "cell int, ring long, block int")
    cands = cut_lineage(placed.join(numbers, ["cell", "ring"]).select("id", "x", "block"))

    knn, best = _block_knn(k), None
    schema = "id long, cid long, dist double"
    todo = pts.withColumn("seen", F.lit(0)).withColumn("reach", F.lit(float("inf")))
    done, take = 0, VISITS
    while done < len(blocks):
        looking = cut_lineage(todo.mapInPandas(_next_blocks(pivots, blocks, take), "id long, x array<double>, blocks array<int>"))
        visits = looking.select("id", "x", F.explode("blocks").alias("block"))
        shares = visits.groupBy("block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("shares"))
        shares = cut_lineage(shares)
        if shares.isEmpty():
            break
        asking = visits.join(shares, "block").withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int"))
        looked = cands.join(shares, "block").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        found = (asking.select("id", "x", "block", "share").groupBy("block", "share")
                 .cogroup(looked.select("id", "x", "block", "share").groupBy("block", "share"))
                 .applyInPandas(lambda q, c: knn(q, c), schema))
        rows = found if best is None else best.select("id", F.inline("nn")).unionByName(found)
        merged = rows.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct("dist", "cid"))), 1, k).alias("nn"))
        best = cut_lineage(merged)
        done += take
        full = F.when(F.size("nn") >= k, F.element_at("nn", -1)["dist"]).otherwise(float("inf"))
        # A point that looked at fewer blocks than it might has met its bound and stays out.
        went = looking.where(F.size("blocks") == take).select("id").distinct()
        take = min(2 * take, MOST_VISITS)
        todo = pts.join(went, "id").join(best.select("id", full.alias("reach")), "id", "left").select(
            "id", "x", F.lit(done).alias("seen"), F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
    return best.select(F.col("id").alias("qid"), F.posexplode("nn").alias("rank", "n")).select(
        "qid", "rank", F.col("n.cid").alias("cid"), F.col("n.dist").alias("dist"))


def smote(train: DataFrame, label: str = "label", features: str = "features", k: int = 5, seed: int = 42,
          block_rows: int = 4_000, id_col: str = "id") -> DataFrame:
    """M9: synthetic minority rows until the classes balance.

    Each minority row spawns ``ceil`` or ``floor`` of (needed / m) samples;
    each sample takes a seeded-random one of the row's k nearest minority
    neighbours and a seeded-random gap in [0, 1).  Returns the training rows
    plus the synthetic ones (``synthetic`` flag).
    """
    from pyspark.ml.functions import array_to_vector

    counts = train.groupBy(label).agg(F.count("*").alias("n"))
    minority = counts.agg(F.min_by(label, "n")).scalar()
    n_min = counts.agg(F.min("n")).scalar()
    n_max = counts.agg(F.max("n")).scalar()
    mino = train.filter(F.col(label) == minority).select(F.col(id_col).cast("long").alias("id"),
                                                         vector_to_array(F.col(features)).alias("x"))
    if not mino.limit(2).count() == 2:
        raise ValueError("SMOTE needs at least two minority rows: a single one has no neighbour")
    nn = knn_within(mino, k, block_rows)
    need = n_max - n_min
    base = F.floor(need / n_min)
    ranked = with_ranks(mino.withColumn("_h", F.xxhash64("id", F.lit(seed))), ["_h", "id"]).drop("_h")
    extra = F.col("_rn") <= F.pmod(need, n_min)  # exactly the remainder
    reps = ranked.withColumn("reps", (base + F.when(extra, 1).otherwise(0)).cast("int")).drop("_rn").filter(F.col("reps") > 0)
    samples = reps.select("id", "x", F.explode(F.sequence(F.lit(1), F.col("reps"))).alias("j"))
    pick = F.pmod(F.xxhash64("id", "j", F.lit(seed)), F.lit(k)).cast("int")
    gap = F.pmod(F.xxhash64("j", "id", F.lit(seed + 1)), F.lit(1 << 30)).cast("double") / float(1 << 30)
    samples = samples.withColumn("rank", pick).withColumn("gap", gap)
    # Rows with fewer than k neighbours (tiny classes) fall back to their last neighbour.
    nn = nn.select(F.col("qid").alias("id"), "rank", "cid")
    nmax = nn.groupBy("id").agg(F.max("rank").alias("maxr"))
    samples = samples.join(nmax, "id").withColumn("rank", F.least("rank", "maxr")).drop("maxr")
    j = samples.join(nn, ["id", "rank"])
    nbx = mino.select(F.col("id").alias("cid"), F.col("x").alias("nx"))
    j = j.join(nbx, "cid")
    newx = F.zip_with("x", "nx", lambda a, b: a + F.col("gap") * (b - a))
    # Copies of a row number at most ceil(need / n_min) < base + 2, so the ids are distinct (and negative for ids from 0 on).
    synth = j.select((-(F.col("id") * (base + 2) + F.col("j"))).alias(id_col), array_to_vector(newx).alias(features),
                     F.lit(minority).cast(train.schema[label].dataType).alias(label))
    keep = [id_col, features, label]
    return train.select(*keep).withColumn("synthetic", F.lit(False)).unionByName(synth.withColumn("synthetic", F.lit(True)))


# ---------------------------------------------------------------------------
# M17 for tree ensembles: path contributions (bias + sum = probability)
# ---------------------------------------------------------------------------
GROUP_NODES = 100_000   # nodes of the trees that a task walks
GROUP_ROWS = 20_000     # rows that a task sends down them


def forest_nodes(model, work_dir: str, spark) -> DataFrame:
    """The fitted forest's node table: the model is written to ``work_dir`` (shared storage) and read back."""
    model.write().overwrite().save(work_dir)
    stats = F.col("nodeData.impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    cut, ordered = F.col("nodeData.split.leftCategoriesOrThreshold"), F.col("nodeData.split.numCategories") < 0
    return spark.read.parquet(f"{work_dir}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.when(total > 0, stats[1] / total).otherwise(0.0).alias("p1"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feat"),
        F.when(ordered, F.get(cut, F.lit(0))).alias("thr"), F.when(~ordered, cut).alias("cats"))


def _trees(nodes):
    """Node columns of each tree as numpy arrays, indexed by node id."""
    for _, t in nodes.sort_values(["tree", "node"]).groupby("tree", sort=True):
        yield {c: t[c].to_numpy() for c in ("p1", "left", "right", "feat", "thr", "cats")}


def tree_contributions(scored: DataFrame, model, names: Sequence[str], work_dir: str, id_col: str = "id",
                       features: str = "features") -> DataFrame:
    """Per row: bias (mean root probability) and each feature's contribution to
    the positive-class probability, long form; bias + sum = probability.

    Groups of trees meet blocks of rows in tasks, whose sums per row are added up; neither
    the forest nor the rows pass through the driver, which holds one number per tree."""
    import numpy as np
    import pandas as pd

    if isinstance(model, DealtForestModel):
        x = cut_lineage(scored.select(id_col, features).withColumn("_row", F.monotonically_increasing_id()))
        mean = F.transform(F.slice("v", 1, len(names)), lambda v: v / F.lit(float(model.getNumTrees)))
        steps = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), mean.alias("contribution"))
        found = x.select(id_col, "_row").join(model.walked(x, features, True), "_row")
        return found.select(id_col, F.lit(model.bias()).alias("bias"), F.inline(steps))
    nodes = forest_nodes(model, work_dir, scored.sparkSession)
    n_feat, roots = len(names), [r["p1"] for r in nodes.filter(F.col("node") == 0).orderBy("tree").collect()]
    bias = float(np.mean(roots))
    x = cut_lineage(scored.select(id_col, vector_to_array(F.col(features)).alias("x")).withColumn("_row", F.monotonically_increasing_id()))
    blocks = max(1, -(-x.count() // GROUP_ROWS))
    cores = x.sparkSession.sparkContext.defaultParallelism
    groups = max(1, min(len(roots), max(-(-nodes.count() // GROUP_NODES), -(-2 * cores // blocks))))
    # The few pairs of a group and a block are all the tasks there are: room for them, so that they do not share one.
    deal = (groups * blocks + min(3 * groups * blocks, 100), "group", "block")

    def run(rows: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        X = np.stack(rows["x"].to_numpy()).astype(float) if len(rows) else np.zeros((0, n_feat))
        contrib = np.zeros((X.shape[0], n_feat))
        for t in _trees(part) if len(rows) else ():
            idx, nd = np.arange(X.shape[0]), np.zeros(X.shape[0], dtype=int)
            while True:
                inner = t["left"][nd] >= 0
                idx, nd = idx[inner], nd[inner]  # rows that have not reached a leaf
                if not len(idx):
                    break
                f, thr = t["feat"][nd], t["thr"][nd]
                xv = X[idx, f]
                go_left = xv <= thr
                if (by_set := np.isnan(thr)).any():
                    for n in np.unique(nd[by_set]):
                        go_left[nd == n] = np.isin(xv[nd == n], t["cats"][n])
                child = np.where(go_left, t["left"][nd], t["right"][nd])
                contrib[idx, f] += t["p1"][child] - t["p1"][nd]
                nd = child
        return pd.DataFrame({"_row": rows["_row"], "c": list(contrib / len(roots))})

    asked = x.select("_row", "x", F.pmod(F.xxhash64("_row"), F.lit(blocks)).alias("block"),
                     F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    held = nodes.select("*", F.pmod("tree", F.lit(groups)).cast("int").alias("group"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    sums = (asked.repartition(*deal).groupBy("group", "block").cogroup(held.repartition(*deal).groupBy("group", "block"))
            .applyInPandas(lambda rows, part: run(rows, part), "_row long, c array<double>"))
    total = sums.groupBy("_row").agg(*[F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(n_feat)])
    slots = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"c{i}").alias("contribution")) for i, n in enumerate(names)])
    return x.select(id_col, "_row").join(total, "_row").select(id_col, F.lit(bias).alias("bias"), F.inline(slots))
