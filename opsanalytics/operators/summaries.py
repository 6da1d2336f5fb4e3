"""Aggregations, sorts, limits and reshaping.

Grouped aggregates are partially aggregated map-side, so a hot group key costs
one row per map task in the shuffle, not a third of the data in one task.
Ranking windows only ever run over already-aggregated, small results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsanalytics.functions.nulls import count_where, sum0
from opsanalytics.operators.reconcile import LEAKAGE_CATEGORIES
from opsanalytics.session import cut_lineage

FEW_GROUPS = 100_000  # group statistics up to so many rows are broadcast
KPI_SUMS = ["expected_revenue_kes", "collected_revenue_kes", "total_leakage_kes", *LEAKAGE_CATEGORIES]


# ---------------------------------------------------------------------------
# Several segment cuts in one scan
# ---------------------------------------------------------------------------
def kpi_cuts(
    reconciled: DataFrame,
    dims: Sequence[str],
    top: Mapping[str, int] | None = None,
) -> DataFrame:
    """Overall row + one row per segment of each dimension, from ONE scan.

    ``GROUPING SETS ((), (d1), (d2), ...)`` computes every cut in a single
    aggregation; ``top`` keeps the k largest segments of a cut (a per-cut
    ``row_number`` over the aggregated rows, which are small).
    """
    top = top or {}
    all_bits = (1 << len(dims)) - 1
    cut = F.when(F.grouping_id(*dims) == all_bits, F.lit("overall"))
    for d in dims:
        cut = cut.when(F.grouping(d) == 0, F.lit(d))
    g = reconciled.groupingSets([[]] + [[d] for d in dims], *dims).agg(
        cut.alias("cut"),
        F.count("loading_id").alias("loadings"),
        *[sum0(c).alias(c) for c in KPI_SUMS],
        F.coalesce(F.sum(F.col("is_exception").cast("int")), F.lit(0)).cast("bigint").alias("exception_count"),
    )
    g = g.select("cut", F.coalesce(*dims).alias("segment"), "loadings", *KPI_SUMS, "exception_count")
    g = g.filter((F.col("cut") == "overall") | F.col("segment").isNotNull())
    g = g.withColumn(
        "leakage_pct_of_expected", F.try_divide(F.col("total_leakage_kes") * 100, F.col("expected_revenue_kes"))
    )
    order = [F.desc("total_leakage_kes"), F.asc("segment")]
    # Capped cuts (e.g. top-10 customers, a high-cardinality dimension): salted
    # two-phase top-k, so one cut is never ranked whole in a single task.
    parts = []
    for d, k in top.items():
        ranked = top_per_group(g.filter(F.col("cut") == d), ["cut"], order, k, tiebreak="segment")
        parts.append(ranked.withColumnRenamed("rank", "rank_in_cut"))
    # Uncapped cuts rank every segment of a small business dimension (depots, products).
    w = Window.partitionBy("cut").orderBy(*order)
    rest = g.filter(~F.col("cut").isin(list(top))) if top else g
    out = rest.withColumn("rank_in_cut", F.row_number().over(w))
    for p in parts:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# L1-L6
# ---------------------------------------------------------------------------
def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """L2: ``orderBy().limit()`` -> TakeOrderedAndProject (per-task heaps of n rows)."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: Sequence[Column | str], limit: int, offset: int = 0) -> DataFrame:
    """L1: one page of a sorted result plus the total row count.

    The total is a scalar subquery (a count), the page a top-(offset+limit)
    sort; no window over the whole input.
    """
    total = df.agg(F.count("*")).scalar()
    return df.orderBy(*order).offset(offset).limit(limit).withColumn("total", total)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, salt_buckets: int = 64, tiebreak: str | None = None
) -> DataFrame:
    """W14/L2 per group: the first ``n`` rows of each group, skew-proof.

    Phase 1 ranks inside (group, hash bucket of ``tiebreak`` or the whole row)
    and keeps ``n`` per bucket, so a hot group is spread over ``salt_buckets``
    tasks; phase 2 ranks at most ``salt_buckets * n`` rows per group.
    """
    salt = F.pmod(F.xxhash64(F.col(tiebreak)) if tiebreak else F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
    local = Window.partitionBy(*group, "_salt").orderBy(*order)
    pre = df.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(local)).filter(F.col("_rn") <= n)
    final = Window.partitionBy(*group).orderBy(*order)
    return pre.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= n).drop("_salt", "_rn")


def seeded_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """N rows chosen by a seeded hash of a key (repeatable on any engine, no global shuffle of rows)."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def argmax_row(df: DataFrame, value_col: str, cols: Sequence[str]) -> DataFrame:
    """The row with the highest value (ties -> smallest struct), one row."""
    return df.agg(F.max_by(F.struct(*cols), F.col(value_col)).alias("best")).select("best.*")


def most_frequent(df: DataFrame, col: str) -> DataFrame:
    """The most frequent value; ties -> the smallest value; NULL for an empty column.

    Counts per value first (partial aggregates), then one best row: no map of all values in a task."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return counts.agg(F.min_by(F.col(col), F.struct(-F.col("n"), F.col(col))).alias(f"mode_{col}"))


# ---------------------------------------------------------------------------
# A8-A37 generic helpers
# ---------------------------------------------------------------------------
def multi_stat(df: DataFrame, by: Sequence[str], cols: Sequence[str], stats: Sequence[str], digits: int | None = 2):
    """Generated ``stat(col)`` list per group, named ``<col>_<stat>``.

    Supported stats: mean, max, min, median, std, count, sum.  The median is an
    exact quantile by range refinement (:mod:`quantiles`), joined on the group
    keys, so no group is ever buffered whole in one task.
    """
    from opsanalytics.operators.quantiles import exact_quantiles

    fns = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp, "count": F.count, "sum": F.sum}
    aggs = []
    for c in cols:
        for s_ in stats:
            if s_ == "median":
                continue
            e = fns[s_](c)
            if digits is not None and s_ != "count":
                e = F.round(e, digits)
            aggs.append(e.alias(f"{c}_{s_}"))
    out = df.groupBy(*by).agg(*aggs)
    if "median" in stats:
        for c in cols:
            med = F.col("q0") if digits is None else F.round("q0", digits)
            q = exact_quantiles(df, c, [0.5], by).select(*by, med.alias(f"{c}_median"))
            out = out.join(q, list(by), "left") if by else out.withColumn(f"{c}_median", q.select(f"{c}_median").scalar())
    order = [f"{c}_{s_}" for c in cols for s_ in stats]
    return out.select(*by, *order)


def frequency(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Value counts and share % (within ``by``).

    The denominator is a scalar subquery (ungrouped) or a per-group total
    joined back on ``by``: no window over all value counts, which for a
    high-cardinality column would be a single task.
    """
    counts = df.groupBy(*by, col).agg(F.count("*").alias("n"))
    if by:
        totals = counts.groupBy(*by).agg(F.sum("n").alias("_t"))
        return counts.join(totals, list(by)).withColumn("share_pct", F.col("n") * 100.0 / F.col("_t")).drop("_t")
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("share_pct", F.col("n") * 100.0 / total)


def ratio_of_counts(df: DataFrame, cond_major: Column, cond_minor: Column) -> DataFrame:
    """Majority / minority count ratio."""
    return df.agg(
        count_where(cond_major).alias("n_major"),
        count_where(cond_minor).alias("n_minor"),
    ).withColumn("ratio", F.try_divide(F.col("n_major").cast("double"), F.col("n_minor")))


def before_after(df: DataFrame, by: Sequence[str], date_col: str, cut: str, value: str) -> DataFrame:
    """Mean before (<= cut) and after a date, and % drop."""
    d = F.to_date(F.col(date_col))
    c = F.lit(cut).cast("date")
    out = df.groupBy(*by).agg(
        F.avg(F.when(d <= c, F.col(value))).alias("mean_before"),
        F.avg(F.when(d > c, F.col(value))).alias("mean_after"),
    )
    return out.withColumn(
        "pct_change", F.try_divide((F.col("mean_after") - F.col("mean_before")) * 100, F.col("mean_before"))
    )


def flag_rate(df: DataFrame, by: str, flag: str) -> DataFrame:
    """mean/sum/count of a 0/1 flag per group and its rate %, plus the
    network average (= mean of group rates) on every row."""
    g = df.groupBy(by).agg(
        F.avg(flag).alias("flag_mean"), F.sum(flag).cast("bigint").alias("flag_sum"), F.count(flag).alias("n")
    ).withColumn("rate_pct", F.col("flag_mean") * 100)
    network = g.agg(F.avg("rate_pct")).scalar()
    return g.withColumn("network_avg_rate_pct", network)


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), exact: bool = True,
             percentiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, std, min, percentiles, max per numeric column (long form).

    ``exact`` percentiles use range refinement (:mod:`quantiles`; bounded
    memory per task, exact result); ``exact=False`` uses ``percentile_approx``.
    """
    from opsanalytics.operators.quantiles import exact_quantiles

    names = [f"p{int(round(p * 100))}" for p in percentiles]
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"{c}__count"),
            F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__std"),
            F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
        ]
        if not exact:
            aggs += [F.percentile_approx(c, p, 10000).cast("double").alias(f"{c}__{n}") for p, n in zip(percentiles, names)]
    wide = df.groupBy(*by).agg(*aggs)
    if exact:
        # All columns at once: unpivot to (column, value) and refine with the
        # column as one more group key, so the passes are shared.
        long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(list(by), list(cols), "_col", "_val")
        q = exact_quantiles(long, "_val", percentiles, [*by, "_col"])
        piv = q.groupBy(*by).pivot("_col", list(cols)).agg(*[F.first(f"q{i}").alias(n) for i, n in enumerate(names)])
        # pivot names columns "<col>_<p>"; rename to "<col>__<p>"
        piv = piv.select(*by, *[F.col(f"{c}_{n}").alias(f"{c}__{n}") for c in cols for n in names])
        if by:
            wide = wide.join(piv, list(by), "left")
        else:
            wide = wide.withColumns({f"{c}__{n}": piv.select(f"{c}__{n}").scalar() for c in cols for n in names})
    stat_names = ["count", "mean", "std", "min", "max"] + names
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    *[F.col(f"{c}__{s_}").cast("double").alias(s_) for s_ in stat_names],
                )
                for c in cols
            ]
        )
    ).alias("r")
    return wide.select(*by, rows).select(*by, "r.*")


def missing_audit(df: DataFrame, cols: Sequence[str] | None = None, only_offenders: bool = True) -> DataFrame:
    """Missing count and % per column from one aggregate pass."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_n"], cols, "column", "n_missing").select(
        "column",
        F.col("n_missing").cast("bigint").alias("n_missing"),
        F.try_divide(F.col("n_missing") * 100.0, F.col("_n")).alias("pct_missing"),
    )
    return long.filter(F.col("n_missing") > 0) if only_offenders else long


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns with exactly one distinct value, NULL counting as a value.

    One pass of least, greatest and null count per column; no distinct values are gathered.
    In an empty table no column is constant."""
    cols = list(cols or df.columns)
    parts = df.agg(*[
        F.coalesce(F.when(F.count(c) == F.count("*"), F.min(c) == F.max(c)).otherwise(F.count(c) == 0), F.lit(False)).alias(c) for c in cols
    ])
    return parts.unpivot([], cols, "column", "is_constant")


def join_groups(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with their group's statistics (one row per group), which are stored first.

    Few groups are broadcast: the rows stay where they are read, and no task sorts or merges a hot
    group.  Many groups meet their rows in a shuffle join."""
    stats = cut_lineage(stats)
    return df.join(F.broadcast(stats) if stats.count() <= FEW_GROUPS else stats, list(by))


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the (per-group) min and max; counts per bin.

    Bin edges come from one aggregate per group joined back on the group keys
    (a scalar subquery when ungrouped).  Bin = floor((x - lo) / (hi - lo) * bins) + 1,
    the maximum falling in the last bin.
    """
    if by:
        x = join_groups(df.select(*dict.fromkeys([*by, value])), df.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")), by)
        lo, hi = F.col("_lo"), F.col("_hi")
    else:
        b = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()  # one subquery
        lo, hi = b["lo"], b["hi"]
        x = df
    raw = F.floor((F.col(value) - lo) / (hi - lo) * bins) + 1
    b = F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins)))
    return (
        x.filter(F.col(value).isNotNull())
        .withColumn("bin", b.cast("bigint"))
        .groupBy(*by, "bin")
        .agg(F.count("*").alias("n"), F.min(lo).alias("lo"), F.min(hi).alias("hi"))
        .withColumn("bin_start", F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins)
        .drop("lo", "hi")
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, 1.5 IQR fences and outlier count per group.

    Exact quartiles by counts (no group buffered in one task);
    fences are joined back on the group keys and outliers counted in a second
    aggregate.
    """
    from opsanalytics.operators.quantiles import exact_quantiles

    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], by).select(
        *by, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"), "n")
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")).withColumns(
        {
            "lower_fence": F.col("q1") - 1.5 * F.col("iqr"),
            "upper_fence": F.col("q3") + 1.5 * F.col("iqr"),
        }
    )
    if by:
        q = cut_lineage(q)
        joined = join_groups(df.select(*dict.fromkeys([*by, value])), q.select(*by, "lower_fence", "upper_fence"), by)
        outliers = joined.groupBy(*by).agg(
            count_where((F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence"))).alias(
                "n_outliers"
            )
        )
        return q.join(outliers, list(by))
    lf = q.select("lower_fence").scalar()
    uf = q.select("upper_fence").scalar()
    n_out = df.agg(count_where((F.col(value) < lf) | (F.col(value) > uf))).scalar()
    return q.withColumn("n_outliers", n_out)


def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Count pivot with a fixed column list, zeros for empty cells."""
    out = df.groupBy(row).pivot(col, list(values)).count()
    return out.na.fill(0, [str(v) for v in values])


def cohort_header(df: DataFrame, entity: str, date_col: str) -> DataFrame:
    """Distinct entities, first and last date."""
    return df.agg(
        F.count_distinct(entity).alias(f"n_{entity}"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.count("*").alias("n_rows"),
    )


def profile_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, unique, most frequent value (ties -> smallest) and its frequency per column.

    One pass over the rows counts (column, value) pairs; the top value is the
    smallest among those with the highest count.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols])).alias("p")
    counts = df.select(pairs).select("p.*").groupBy("column", "v").agg(F.count("*").alias("n"))
    some = F.col("v").isNotNull()
    return counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(some, F.col("n"))), F.lit(0)).alias("count"), F.count("v").alias("unique"),
        F.min_by("v", F.when(some, F.struct(-F.col("n"), F.col("v")))).alias("top"), F.max(F.when(some, F.col("n"))).alias("freq"))


def sum_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Helper: totals of several columns (N6 semantics)."""
    return df.agg(*[sum0(c).alias(c) for c in cols])
