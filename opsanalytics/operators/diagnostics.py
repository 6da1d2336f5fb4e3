"""Diagnostics: z-scores, outliers, Pareto loss, feature re-checks and a binned
kernel density (W9-W13, A35).

Group statistics are aggregates joined back on the group keys (never a window
over a whole group, which would put a hot group in one task); global
statistics are scalar subqueries.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsanalytics.functions.nulls import count_where
from opsanalytics.operators.ordering import with_ranks
from opsanalytics.operators.summaries import join_groups


def group_zscore(df: DataFrame, by: Sequence[str], value: str, ddof: int = 1) -> DataFrame:
    """z = (x - group mean) / group std, as a column ``z_<value>``; NULL where the group does not vary."""
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    stats = df.groupBy(*by).agg(F.avg(value).alias("_mu"), std(value).alias("_sd"))
    out = join_groups(df, stats, by) if by else df.withColumns({"_mu": stats.select("_mu").scalar(), "_sd": stats.select("_sd").scalar()})
    return out.withColumn(f"z_{value}", F.try_divide(F.col(value) - F.col("_mu"), F.col("_sd"))).drop("_mu", "_sd")


def flag_low_z(df: DataFrame, by: Sequence[str], value: str, cut: float = -2.5) -> DataFrame:
    """Rows whose in-group z-score is below ``cut``."""
    z = group_zscore(df, by, value)
    return z.filter(F.col(f"z_{value}") < cut)


def global_z_outliers(df: DataFrame, value: str, cut: float = 3.0, ddof: int = 1) -> DataFrame:
    """|z| > cut against the whole column; a missing value is never an outlier."""
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    st = df.agg(F.struct(F.avg(value).alias("mu"), std(value).alias("sd"))).scalar()  # one subquery
    z = F.try_divide(F.col(value) - st["mu"], st["sd"])  # NULL, and so no outlier, if the column does not vary
    return df.withColumn(f"z_{value}", z).filter(F.coalesce(F.abs(F.col(f"z_{value}")) > cut, F.lit(False)))


def outlier_counts(df: DataFrame, cols: Sequence[str], cut: float = 3.0) -> DataFrame:
    """Per numeric column, rows with |z| > cut (population std), long form; none in a column that does not vary."""
    st = df.agg(F.struct(*[F.avg(c).alias(f"{c}__mu") for c in cols], *[F.stddev_pop(c).alias(f"{c}__sd") for c in cols])).scalar()
    counts = [count_where(F.abs(F.try_divide(F.col(c) - st[f"{c}__mu"], st[f"{c}__sd"])) > cut).alias(c) for c in cols]
    wide = df.agg(*counts)
    return wide.unpivot([], list(cols), "column", "n_outliers")


def pareto(df: DataFrame, by: str, loss: Column) -> DataFrame:
    """Loss per group, sorted desc, cumulative % and share %.

    Ranks and running sums over the sorted group totals come from range
    partitions and their offsets (:mod:`ordering`), never from one global window.
    """
    g = df.groupBy(by).agg(F.sum(loss).alias("loss"))
    total = g.agg(F.sum("loss")).scalar()
    x = with_ranks(g, [F.desc("loss"), F.asc(by)], sums={"_before": "loss"})
    return x.select(
        by, "loss",
        (F.col("loss") * 100 / total).alias("share_pct"),
        ((F.col("_before") + F.coalesce("loss", F.lit(0.0))) * 100 / total).alias("cum_pct"),
        F.col("_rn").alias("rank"),
    )


def feature_mismatches(df: DataFrame, stored: str, recomputed: str, tol: float = 1e-6) -> DataFrame:
    """Rows where a stored feature and its recomputation differ by more than ``tol``."""
    d = F.abs(F.col(stored) - F.col(recomputed))
    return df.agg(
        F.count("*").alias("n_rows"),
        count_where(d > tol).alias("n_mismatch"),
        F.max(d).alias("max_abs_diff"),
    )


def binned_kde(df: DataFrame, value: str, by: Sequence[str] = (), grid: int = 64, fine_bins: int = 1024, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per group on a grid (Scott's bandwidth).

    The grid reaches ``cut`` bandwidths beyond the smallest and largest value.  The
    data are first reduced to ``fine_bins`` bin counts per group (an aggregate);
    each bin then spreads its weight over the grid points with ``explode`` of a
    fixed grid -- work is groups x bins x grid, independent of the row count.
    Binning moves each point by at most half a fine bin.  A group of one value
    has no bandwidth: its grid points coincide and the density is NULL.
    """
    stats = df.groupBy(*by).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_n"), F.stddev_samp(value).alias("_sd")
    )
    present = df.filter(F.col(value).isNotNull())
    if by:
        x = join_groups(present.select(*dict.fromkeys([*by, value])), stats, by)
    else:  # one global row: scalar subqueries, no join
        x = present.withColumns({c: stats.select(c).scalar() for c in ("_lo", "_hi", "_n", "_sd")})
    width = (F.col("_hi") - F.col("_lo")) / fine_bins
    b = F.coalesce(F.least(F.floor(F.try_divide(F.col(value) - F.col("_lo"), width)), F.lit(fine_bins - 1)), F.lit(0))
    bins = x.groupBy(*by, "_lo", "_hi", "_n", "_sd", b.alias("_b")).agg(F.count("*").alias("_w"))
    center = F.col("_lo") + (F.col("_b") + 0.5) * (F.col("_hi") - F.col("_lo")) / fine_bins
    h = F.coalesce(F.col("_sd"), F.lit(0.0)) * F.pow(F.col("_n"), -0.2)
    pts = bins.select(
        *by, "_lo", "_hi", "_n", center.alias("_c"), h.alias("_h"), "_w",
        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"),
    )
    left, right = F.col("_lo") - cut * F.col("_h"), F.col("_hi") + cut * F.col("_h")
    gx = left + F.col("point") * (right - left) / (grid - 1)
    u = F.try_divide(gx - F.col("_c"), F.col("_h"))
    k = F.try_divide(F.col("_w") * F.exp(-0.5 * u * u), F.col("_h") * math.sqrt(2 * math.pi))
    return pts.groupBy(*by, "point", gx.alias("x")).agg((F.sum(k) / F.first("_n")).alias("density"))
