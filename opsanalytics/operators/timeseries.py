"""Time-series operators: spines, resampling, rolling windows, interpolation and fills
(U4, A10, A11, W1-W8, J5-J7).

Series are ordinary rows with a timestamp column; order is always explicit.

Scale notes
-----------
* Resampled series (one row per entity and bin) have a size bounded by the
  time range, not the data volume, so plain windows over ``partitionBy(entity)``
  are fine on them.
* Raw per-entity rows can be hot (one asset holding a third of all rows).
  :func:`rolling_rows` computes row-count windows exactly without ever putting
  one entity in one task: row numbers come from per-(entity, day) counts and a
  running offset, rows are cut into fixed-size blocks, and each block gets a
  halo of the previous block's last ``n - 1`` rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsanalytics.operators.ordering import with_ranks

UNIT_INTERVAL = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS"}


# ---------------------------------------------------------------------------
# U4 / A10 / A11
# ---------------------------------------------------------------------------
def time_spine(df: DataFrame, ts: str, unit: str = "hour", by: Sequence[str] = (), name: str = "bin") -> DataFrame:
    """U4: every bin from the first to the last (per group), one row each.

    Built from one min/max aggregate and ``explode(sequence(...))``: its size is
    the number of bins, independent of the row count.
    """
    trunc = "week" if unit == "week" else unit
    bounds = df.groupBy(*by).agg(
        F.date_trunc(trunc, F.min(ts)).alias("_lo"), F.date_trunc(trunc, F.max(ts)).alias("_hi")
    )
    seq = F.sequence(F.col("_lo"), F.col("_hi"), F.expr(UNIT_INTERVAL[unit]))
    return bounds.select(*by, F.explode(seq).alias(name))


def resample(
    df: DataFrame, ts: str, unit: str, aggs: Mapping[str, Column], by: Sequence[str] = (), name: str = "bin",
    empty: Mapping[str, object] | None = None,
) -> DataFrame:
    """A10: aggregate per (group, bin) on a spine so empty bins are kept.

    ``empty`` gives values for empty bins (e.g. 0 for counts); others stay NULL.
    """
    trunc = "week" if unit == "week" else unit
    g = df.groupBy(*by, F.date_trunc(trunc, F.col(ts)).alias(name)).agg(*[e.alias(k) for k, e in aggs.items()])
    out = time_spine(df, ts, unit, by, name).join(g, [*by, name], "left")
    if empty:
        out = out.na.fill(dict(empty))
    return out


def weekly_counts(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts per Monday-Sunday week labelled by the Sunday, empty weeks as 0."""
    d = F.to_date(F.col(date_col))
    wk = F.date_trunc("week", d).cast("date")
    g = df.groupBy(*by, wk.alias("_wk")).agg(F.count("*").alias("n"))
    bounds = df.groupBy(*by).agg(F.date_trunc("week", F.min(d)).cast("date").alias("_lo"),
                                 F.date_trunc("week", F.max(d)).cast("date").alias("_hi"))
    spine = bounds.select(*by, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 7 DAYS"))).alias("_wk"))
    out = spine.join(g, [*by, "_wk"], "left").na.fill({"n": 0})
    return out.select(*by, F.date_add("_wk", 6).alias("week_ending"), F.col("n").cast("bigint").alias("n"))


# ---------------------------------------------------------------------------
# W1 / W2 / W4 / W7 / W8 on bounded series
# ---------------------------------------------------------------------------
def rows_window(by: Sequence[str], order: str | Sequence[str], n: int) -> Window:
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return w.orderBy(*order).rowsBetween(-(n - 1), 0)


def rolling_mean(col: str, w: Window, min_periods: int = 1, exact: bool = False) -> Column:
    """Mean of the last n rows, NULL while fewer than ``min_periods`` values.

    ``exact`` averages the values taken to 6 decimals as decimals, so the result
    does not depend on the summation order inside the frame.
    """
    v = F.col(col).cast("decimal(38,6)") if exact else F.col(col)
    return F.when(F.count(col).over(w) >= min_periods, F.avg(v).over(w).cast("double"))


def rolling_std(col: str, w: Window, fill: float | None = 0.0) -> Column:
    """Sample std of the last n rows; a single row gives NULL, filled."""
    s = F.stddev_samp(col).over(w)
    return F.coalesce(s, F.lit(fill)) if fill is not None else s


def fill_with_rolling(col: str, w: Window, how: str = "mean") -> Column:
    """Missing value <- rolling mean (or exact median) of the last n rows."""
    stat = F.avg(col).over(w) if how == "mean" else F.percentile(F.col(col), 0.5).over(w)
    return F.coalesce(F.col(col), stat)


def interpolate_linear(col: str, by: Sequence[str], order: str) -> Column:
    """Linear interpolation by row position inside each group; both ends take
    the nearest value (N13)."""
    base = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    rn = F.row_number().over(base.orderBy(order))
    past = base.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    future = base.orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    v = F.col(col)
    marked = F.when(v.isNotNull(), F.struct(rn.alias("r"), v.alias("v")))
    prev = F.last(marked, ignorenulls=True).over(past)
    nxt = F.first(marked, ignorenulls=True).over(future)
    interp = prev["v"] + (nxt["v"] - prev["v"]) * (rn - prev["r"]) / (nxt["r"] - prev["r"])
    return F.coalesce(v, interp, prev["v"], nxt["v"])


def ffill_bfill(col: str, by: Sequence[str], order: str) -> Column:
    """Forward fill, then backward fill what is still missing at the start."""
    base = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    past = base.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    future = base.orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return F.coalesce(F.last(col, ignorenulls=True).over(past), F.first(col, ignorenulls=True).over(future))


# ---------------------------------------------------------------------------
# W3 / W4 on raw, possibly hot, entities
# ---------------------------------------------------------------------------
def row_numbers(df: DataFrame, entity: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row number per entity in ``order`` (``_rn``) without one task per entity."""
    return with_ranks(df, order, entity)


def rolling_rows(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    n: int,
    features: Mapping[str, "callable"],
    block_rows: int = 100_000,
) -> DataFrame:
    """W3/W4 exactly over the last ``n`` rows per entity, skew-proof.

    ``features`` maps an output name to ``f(window) -> Column``.  Rows are cut
    into blocks of ``block_rows`` consecutive row numbers (``n - 1`` if that is
    more, so that one block before holds all rows a window reaches back to); each
    block is given the previous block's last ``n - 1`` rows as a halo, windows run
    per (entity, block), and halo rows are dropped afterwards.
    """
    block_rows = max(block_rows, n - 1)
    # Reuse row numbers from an earlier pass over the same entity order.
    numbered = df if "_rn" in df.columns else row_numbers(df, entity, order)
    blk = F.floor((F.col("_rn") - 1) / block_rows)
    core = numbered.withColumn("_blk", blk).withColumn("_halo", F.lit(False))
    tail = (
        numbered.filter(((F.col("_rn") - 1) % block_rows) >= block_rows - (n - 1))
        .withColumn("_blk", blk + 1)
        .withColumn("_halo", F.lit(True))
    )
    both = core.unionByName(tail)
    w = Window.partitionBy(*entity, "_blk").orderBy("_rn").rowsBetween(-(n - 1), 0)
    out = both.withColumns({name: fn(w) for name, fn in features.items()})
    return out.filter(~F.col("_halo")).drop("_blk", "_halo")


def rms(col: str):
    return lambda w: F.sqrt(F.avg(F.col(col) * F.col(col)).over(w))


def mean_of(col: str):
    return lambda w: F.avg(col).over(w)


def peak_to_peak(col: str):
    return lambda w: F.max(col).over(w) - F.min(col).over(w)


def std_filled(col: str, fill: float = 0.0):
    return lambda w: F.coalesce(F.stddev_samp(col).over(w), F.lit(fill))


def diff_rows(col: str, k: int, fill: float | None = 0.0):
    """W4 inside :func:`rolling_rows` (n = k + 1): x minus the value k rows back."""

    def fn(w):
        d = F.when(F.count("*").over(w) == k + 1, F.col(col) - F.first(col).over(w))
        return F.coalesce(d, F.lit(fill)) if fill is not None else d

    return fn


def diff_lag(col: str, by: Sequence[str], order: str, k: int, fill: float | None = 0.0) -> Column:
    """X - x shifted k rows (on a bounded series); missing -> fill."""
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(order)
    d = F.col(col) - F.lag(col, k).over(w)
    return F.coalesce(d, F.lit(fill)) if fill is not None else d
