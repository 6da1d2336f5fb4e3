"""Exact quantiles without buffering a group in one task.

``percentile``/``median`` aggregates keep every value of a group in memory; a hot
group would hold a third of the data in one task.  Here order statistics come
from counts:

1. rows per (group, distinct value), with partial aggregation, so a value that
   two thirds of the rows share is one row;
2. these are range-partitioned by (group, value); each partition's total per group
   gives the rank at which the partition starts;
3. only partitions that hold a wanted rank are read again, and a running count in
   value order inside the partition finds the value.

The work does not depend on how the values are spread, and there is nothing to
converge.  NaN sorts after every other value (Spark's own order), so it is the
largest order statistic; NULL values are left out; a group without values has no row.

Quantiles interpolate linearly between the order statistics at floor/ceil of
(n - 1) * p, the definition of Spark ``percentile`` and DuckDB ``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsanalytics.session import cut_lineage


def order_statistics(df: DataFrame, value: str, by: Sequence[str], ranks: DataFrame) -> DataFrame:
    """Value at 0-based rank ``k`` per (group, target); ``ranks`` has columns by + [target, k]."""
    by = list(by) or ["_g"]
    src = df if "_g" not in by else df.withColumn("_g", F.lit(0))
    rk = ranks if "_g" not in by else ranks.withColumn("_g", F.lit(0))
    x = src.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    counts = x.groupBy(*by, "_v").agg(F.count("*").alias("_c"))
    # Stored, so that a partition keeps its number and its values.
    placed = cut_lineage(counts.repartitionByRange(*by, "_v").withColumn("_p", F.spark_partition_id()))
    totals = placed.groupBy(*by, "_p").agg(F.sum("_c").alias("_t"))
    before = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = totals.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    wanted = rk.groupBy(*by).agg(F.collect_list(F.struct("target", "k")).alias("_want"))  # a few per group
    starts = starts.join(wanted, by).withColumn(
        "_want", F.filter("_want", lambda r: (r["k"] >= F.col("_off")) & (r["k"] < F.col("_off") + F.col("_t"))))
    starts = cut_lineage(starts.filter(F.size("_want") > 0).select(*by, "_p", "_off", "_want"))
    upto = Window.partitionBy(*by, "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.join(starts, [*by, "_p"]).withColumn("_end", F.col("_off") + F.sum("_c").over(upto))
    hit = F.filter("_want", lambda r: (r["k"] >= F.col("_end") - F.col("_c")) & (r["k"] < F.col("_end")))
    out = ranked.select(*by, F.col("_v").alias("value"), F.inline(hit)).select(*by, "target", "value")
    return out.drop("_g") if "_g" in by else out


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated quantiles per group: columns by + ``q0``, ``q1``, ... and ``n``."""
    by = list(by)
    n = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"))
    parts = []
    for i, p in enumerate(probs):
        pos = (F.col("n") - 1) * F.lit(float(p))
        parts.append(n.select(*by, F.lit(2 * i).alias("target"), F.floor(pos).cast("bigint").alias("k")))
        parts.append(n.select(*by, F.lit(2 * i + 1).alias("target"), F.ceil(pos).cast("bigint").alias("k")))
    ranks = parts[0]
    for t in parts[1:]:
        ranks = ranks.unionByName(t)
    stats = order_statistics(df, value, by, ranks)
    wide = stats.groupBy(*by).pivot("target", list(range(2 * len(probs)))).agg(F.first("value"))
    wide = wide.join(n, by) if by else wide.withColumn("n", n.select("n").scalar())
    cols = []
    for i, p in enumerate(probs):
        lo, hi = F.col(str(2 * i)), F.col(str(2 * i + 1))
        pos = (F.col("n") - 1) * F.lit(float(p))
        # Equal neighbours are the quantile themselves (infinities have no difference).
        cols.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (pos - F.floor(pos))).alias(f"q{i}"))
    return wide.select(*by, *cols, "n")
