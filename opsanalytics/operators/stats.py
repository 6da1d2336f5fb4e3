"""Statistical tests as aggregates.

Every test reduces to sufficient statistics (counts, sums, moments) computed
by one partial aggregate, so it scales with the data; the p-value is computed
on the one row (or one row per group) that results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsanalytics.functions.pvalues import f_pvalue, t_pvalue
from opsanalytics.functions.scalar import correlation_label

CI_Z = 1.96  # 95 % normal interval used by the reference


def _corr(x: str, y: str) -> Column:
    """Pearson r, NULL where one side does not vary (the built-in raises there under ANSI rules)."""
    r = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
    return F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)) * F.when(r.isNotNull(), 1.0)


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """R, n (complete pairs), t statistic, two-sided p, and the C25 label.

    On a perfect line t is NULL (unbounded) and p is 0; with fewer than three pairs both are NULL."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    g = both.groupBy(*by).agg(_corr(x, y).alias("r"), F.count("*").alias("n"))
    enough = F.col("n") > 2
    t = F.when(enough, F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, F.when(F.abs("r") <= 1 - 1e-14, 1 - F.col("r") * F.col("r")))))
    perfect = enough & (F.abs("r") > 1 - 1e-14)
    out = g.withColumn("t_stat", t).withColumn(
        "p_value", F.when(perfect, F.lit(0.0)).otherwise(F.nanvl(t_pvalue(F.col("t_stat"), F.col("n") - 2), F.lit(None))))
    return out.withColumn("interpretation", F.when(F.col("r").isNotNull(), correlation_label("r", "p_value")))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise Pearson r on complete cases, long form (x, y, r)."""
    cc = df.na.drop(subset=list(cols))
    pairs = [(a, b) for a in cols for b in cols]
    wide = cc.agg(*[(F.lit(1.0) if a == b else _corr(a, b)).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    return long.select(F.split("pair", "\\|")[0].alias("x"), F.split("pair", "\\|")[1].alias("y"), "r")


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept over complete pairs; NULL if ``x`` does not vary."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    slope = F.try_divide(F.covar_samp(y, x), F.var_samp(x))
    return both.agg(slope.alias("slope"), (F.avg(y) - slope * F.avg(x)).alias("intercept"), F.count("*").alias("n"))


def welch_ttest(df: DataFrame, value: str, group: Column, a, b) -> DataFrame:
    """T4 + T5: Welch t-test of group ``a`` vs ``b`` and the 95 % CI on the difference.

    If neither group varies, or one is too small for a variance, t, dof and p are NULL."""
    v = F.col(value)
    in_a, in_b = group == F.lit(a), group == F.lit(b)
    s = df.agg(
        F.avg(F.when(in_a, v)).alias("mean_a"), F.avg(F.when(in_b, v)).alias("mean_b"),
        F.var_samp(F.when(in_a, v)).alias("var_a"), F.var_samp(F.when(in_b, v)).alias("var_b"),
        F.count(F.when(in_a, v)).alias("n_a"), F.count(F.when(in_b, v)).alias("n_b"),
    )
    se2a, se2b = F.try_divide(F.col("var_a"), F.col("n_a")), F.try_divide(F.col("var_b"), F.col("n_b"))
    se = F.sqrt(se2a + se2b)
    dof = F.try_divide((se2a + se2b) ** 2, F.try_divide(se2a ** 2, F.col("n_a") - 1) + F.try_divide(se2b ** 2, F.col("n_b") - 1))
    diff = F.col("mean_a") - F.col("mean_b")
    out = s.withColumns({"diff": diff, "se": se, "t_stat": F.try_divide(diff, se), "dof": dof})
    return out.withColumns(
        {
            "p_value": F.nanvl(t_pvalue(F.col("t_stat"), F.col("dof")), F.lit(None)),
            "ci_low": F.col("diff") - CI_Z * F.col("se"),
            "ci_high": F.col("diff") + CI_Z * F.col("se"),
        }
    )


def anova_oneway(df: DataFrame, value: str, group: str) -> DataFrame:
    """One-way ANOVA from per-group moments: F, df1, df2, p (one row).

    SSB and SSW come from group n, mean and variance; no second pass over rows.
    With one group, one row per group, or no variation inside groups, F and p are NULL.
    """
    g = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v")
    )
    tot = g.agg(
        F.sum("n").alias("N"), F.count("*").alias("k"), F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("grand"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("v"), F.lit(0.0))).alias("ssw"),
    )
    grand = tot.select("grand").scalar()
    ssb = g.agg(F.sum(F.col("n") * (F.col("m") - grand) ** 2).alias("ssb"))
    out = tot.select("N", "k", "ssw", ssb.select("ssb").scalar().alias("ssb"))
    out = out.withColumns({"df_between": F.col("k") - 1, "df_within": F.col("N") - F.col("k")})
    f = F.try_divide(F.try_divide(F.col("ssb"), F.col("df_between")), F.try_divide(F.col("ssw"), F.col("df_within")))
    out = out.withColumn("f_stat", f)
    return out.withColumn("p_value", F.nanvl(f_pvalue(F.col("f_stat"), F.col("df_between"), F.col("df_within")), F.lit(None)))


def group_means(df: DataFrame, value: str, group: str) -> DataFrame:
    """T6 companion: mean and n per group."""
    return df.groupBy(group).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
