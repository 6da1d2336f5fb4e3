"""Statistics, forecasting, inventory and allocation queries.

Test statistics (r, t, F, degrees of freedom, n) are checked against SQL;
p-values come from the incomplete beta function and are checked in unit tests
against known values, so the p-value queries are row-count checked only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from opsanalytics.functions import scalar as sc
from opsanalytics.functions.pvalues import normal_ppf
from opsanalytics.operators import planning as pl
from opsanalytics.operators import stats as st
from opsanalytics.plans.driver_tables import read_table
from opsanalytics.plans.q_series import CAL_SQL, calendar
from opsanalytics.plans.registry import finish, query
from opsanalytics.plans.sqlkit import sql_finish

T_SQL = "r * sqrt((n - 2) / (1 - r * r))"
STRENGTH_SQL = ("CASE WHEN abs(r) < 0.1 THEN 'negligible' WHEN abs(r) < 0.3 THEN 'weak' "
                "WHEN abs(r) < 0.5 THEN 'moderate' ELSE 'strong' END")


@query(
    "t1_pearson",
    sql_finish(
        f"SELECT l_returnflag, r, n, {T_SQL} AS t_stat, {STRENGTH_SQL} AS strength FROM ("
        "SELECT l_returnflag, corr(l_quantity, l_extendedprice) AS r, CAST(count(*) AS BIGINT) AS n FROM lineitem "
        "WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY l_returnflag)",
        doubles=["r", "t_stat"], overrides={"r": 6},
    ),
)
def t1_pearson(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    out = st.pearson(li, "l_quantity", "l_extendedprice", by=["l_returnflag"])
    return finish(out.select("l_returnflag", "r", "n", "t_stat", sc.correlation_strength("r").alias("strength")),
                  overrides={"r": 6})


def _t_p_sql(t: str, dof: str) -> str:
    """Two-sided p of Student's t by Simpson's rule over the angle, t = sqrt(dof) tan(angle)."""
    return (f"(SELECT 2 * exp(lgamma(({dof} + 1) / 2) - lgamma({dof} / 2)) / sqrt(pi()) * (pi() / 2 - a) / 60000 "
            f"* sum(CASE WHEN k IN (0, 20000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * pow(greatest(cos(a + (pi() / 2 - a) * k / 20000), 0), {dof} - 1)) "
            f"FROM (SELECT atan(abs({t}) / sqrt({dof})) AS a, unnest(range(20001)) AS k) GROUP BY a)")


def _f_p_sql(f: str, d1: str, d2: str) -> str:
    """Upper-tail p of F by Simpson's rule, the beta integral over sin^2 of the angle."""
    return (f"(SELECT 2 * exp(lgamma(({d1} + {d2}) / 2) - lgamma({d1} / 2) - lgamma({d2} / 2)) * a / 600000 "
            f"* sum(CASE WHEN k IN (0, 200000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END "
            f"* pow(sin(a * k / 200000), {d2} - 1) * pow(cos(a * k / 200000), {d1} - 1)) "
            f"FROM (SELECT asin(sqrt({d2} / ({d2} + {d1} * {f}))) AS a, unnest(range(200001)) AS k) GROUP BY a)")


@query(
    "t1_c25_pearson_test",
    sql_finish(
        f"""
        WITH h AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n_events, avg(value) AS mean_value FROM events GROUP BY 1),
        r AS (SELECT corr(n_events, mean_value) AS r, CAST(count(*) AS DOUBLE) AS n FROM h WHERE mean_value IS NOT NULL),
        t AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t_stat FROM r),
        p AS (SELECT *, {_t_p_sql("t_stat", "(n - 2)")} AS p_value FROM t)
        SELECT r, CAST(n AS BIGINT) AS n, t_stat, p_value,
               CASE WHEN abs(r) < 0.1 THEN 'negligible' WHEN abs(r) < 0.3 THEN 'weak' WHEN abs(r) < 0.5 THEN 'moderate' ELSE 'strong' END
               || CASE WHEN r < 0 THEN ' negative' ELSE ' positive' END || ' correlation, '
               || CASE WHEN p_value < 0.05 THEN 'statistically significant (p < 0.05)' ELSE 'not statistically significant (p ≥ 0.05)' END AS interpretation
        FROM p
        """,
        doubles=["r", "t_stat", "p_value"],
    ),
)
def t1_c25_pearson_test(spark, sf_dir):
    """T1 with p-value and the C25 interpretation label (p checked in tests)."""
    ev = read_table(spark, sf_dir, "events")
    hourly = ev.groupBy(F.date_trunc("hour", "ts").alias("h")).agg(
        F.count("*").alias("n_events"), F.avg("value").alias("mean_value"))
    return finish(st.pearson(hourly, "n_events", "mean_value"))


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "t2_corr_matrix",
    sql_finish(
        " UNION ALL ".join(
            f"SELECT '{a}' AS x, '{b}' AS y, {'max(1.0)' if a == b else f'corr({a}, {b})'} AS r FROM lineitem "
            f"WHERE {' AND '.join(c + ' IS NOT NULL' for c in CORR_COLS)}"
            for a in CORR_COLS for b in CORR_COLS
        ),
        doubles=["r"], digits=6,
    ),
)
def t2_corr_matrix(spark, sf_dir):
    return finish(st.corr_matrix(read_table(spark, sf_dir, "lineitem"), CORR_COLS), digits=6)


@query(
    "t3_line_fit",
    sql_finish(
        "SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept, "
        "CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem",
        doubles=["slope", "intercept"],
    ),
)
def t3_line_fit(spark, sf_dir):
    out = st.line_fit(read_table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return finish(out.withColumn("n", F.col("n").cast("bigint")))


WELCH_SQL = """
WITH s AS (
  SELECT avg(value) FILTER (WHERE event_type = 'click') AS mean_a, avg(value) FILTER (WHERE event_type = 'view') AS mean_b,
         var_samp(value) FILTER (WHERE event_type = 'click') AS var_a, var_samp(value) FILTER (WHERE event_type = 'view') AS var_b,
         CAST(count(value) FILTER (WHERE event_type = 'click') AS BIGINT) AS n_a, CAST(count(value) FILTER (WHERE event_type = 'view') AS BIGINT) AS n_b
  FROM events
), d AS (
  SELECT *, mean_a - mean_b AS diff, sqrt(var_a / n_a + var_b / n_b) AS se,
         (var_a / n_a + var_b / n_b) ^ 2 / ((var_a / n_a) ^ 2 / (n_a - 1) + (var_b / n_b) ^ 2 / (n_b - 1)) AS dof
  FROM s
)
SELECT *, diff / se AS t_stat, diff - 1.96 * se AS ci_low, diff + 1.96 * se AS ci_high FROM d
"""


@query(
    "t4_t5_welch_ttest",
    sql_finish(WELCH_SQL, doubles=["mean_a", "mean_b", "var_a", "var_b", "diff", "se", "dof", "t_stat", "ci_low", "ci_high"]),
)
def t4_t5_welch_ttest(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return finish(st.welch_ttest(ev, "value", F.col("event_type"), "click", "view").drop("p_value"))


@query(
    "t4_welch_pvalue",
    sql_finish(
        f"""
        WITH s AS (SELECT avg(value) FILTER (WHERE event_type = 'click') AS ma, avg(value) FILTER (WHERE event_type = 'view') AS mb,
                   var_samp(value) FILTER (WHERE event_type = 'click') / count(value) FILTER (WHERE event_type = 'click') AS a,
                   var_samp(value) FILTER (WHERE event_type = 'view') / count(value) FILTER (WHERE event_type = 'view') AS b,
                   count(value) FILTER (WHERE event_type = 'click') AS na, count(value) FILTER (WHERE event_type = 'view') AS nb FROM events),
        t AS (SELECT (ma - mb) / sqrt(a + b) AS t_stat, (a + b) ^ 2 / (a ^ 2 / (na - 1) + b ^ 2 / (nb - 1)) AS dof FROM s)
        SELECT t_stat, dof, {_t_p_sql("t_stat", "dof")} AS p_value FROM t
        """,
        doubles=["t_stat", "dof", "p_value"],
    ),
)
def t4_welch_pvalue(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return st.welch_ttest(ev, "value", F.col("event_type"), "click", "view").select("t_stat", "dof", "p_value").transform(finish)


ANOVA_SQL = """
WITH g AS (SELECT event_type, count(value) AS n, avg(value) AS m, var_samp(value) AS v FROM events
           WHERE value IS NOT NULL AND event_type IS NOT NULL GROUP BY 1),
t AS (SELECT CAST(sum(n) AS BIGINT) AS "N", CAST(count(*) AS BIGINT) AS k, sum(n * m) / sum(n) AS grand,
             sum(coalesce((n - 1) * v, 0.0)) AS ssw FROM g),
b AS (SELECT sum(g.n * (g.m - t.grand) ^ 2) AS ssb FROM g, t)
SELECT "N", k, ssw, ssb, k - 1 AS df_between, "N" - k AS df_within,
       (ssb / (k - 1)) / (ssw / ("N" - k)) AS f_stat
FROM t, b
"""


@query("t6_anova", sql_finish(ANOVA_SQL, doubles=["ssw", "ssb", "f_stat"], digits=2, overrides={"f_stat": 6},
                              bigints=["df_between", "df_within"]))
def t6_anova(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    out = st.anova_oneway(ev, "value", "event_type").drop("p_value")
    return finish(out, digits=2, overrides={"f_stat": 6})


@query(
    "t6_anova_pvalue",
    sql_finish(
        f"""
        WITH g AS (SELECT event_type, count(value) AS n, avg(value) AS m, var_samp(value) AS v FROM events
                   WHERE value IS NOT NULL AND event_type IS NOT NULL GROUP BY 1),
        t AS (SELECT CAST(sum(n) AS DOUBLE) AS n, CAST(count(*) AS DOUBLE) AS k, sum(n * m) / sum(n) AS grand, sum((n - 1) * v) AS ssw FROM g),
        f AS (SELECT k - 1 AS d1, t.n - k AS d2, (SELECT sum(g.n * (g.m - t.grand) ^ 2) FROM g) / (k - 1) / (ssw / (t.n - k)) AS f_stat FROM t)
        SELECT f_stat, {_f_p_sql("f_stat", "d1", "d2")} AS p_value FROM f
        """,
        doubles=["f_stat", "p_value"],
    ),
)
def t6_anova_pvalue(spark, sf_dir):
    return finish(st.anova_oneway(read_table(spark, sf_dir, "events"), "value", "event_type").select("f_stat", "p_value"))


# ----------------------------------------------------------------------------
# Daily demand per return flag, lead times 1-3 days
# ----------------------------------------------------------------------------
LEAD_TIMES = {"A": 1, "N": 2, "R": 3}
Z95 = normal_ppf(pl.SERVICE_LEVEL)


def _daily_demand(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_returnflag").alias("depot"), F.to_date("l_shipdate").alias("day")).agg(
        F.sum("l_quantity").alias("throughput"))


def _lead_times(spark):
    return spark.createDataFrame([(k, v) for k, v in LEAD_TIMES.items()], "depot string, lead_time_d int")


DEMAND_SQL = f"""daily AS (SELECT l_returnflag AS depot, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS throughput FROM lineitem GROUP BY 1, 2),
lt AS (SELECT * FROM (VALUES {', '.join(f"('{k}', {v})" for k, v in LEAD_TIMES.items())}) v(depot, lead_time_d)),
params AS (
  SELECT s.depot, s.mean_demand, s.std_dev, s.n_days, lt.lead_time_d, {Z95!r} * s.std_dev * sqrt(lt.lead_time_d) AS safety_stock
  FROM (SELECT depot, avg(throughput) AS mean_demand, stddev_samp(throughput) AS std_dev, CAST(count(throughput) AS BIGINT) AS n_days
        FROM daily GROUP BY depot) s JOIN lt USING (depot)
)"""


@query(
    "t11_safety_stock",
    sql_finish(
        "SELECT depot, mean_demand, std_dev, n_days, CAST(lead_time_d AS BIGINT) AS lead_time_d, safety_stock, "
        "mean_demand * lead_time_d + safety_stock AS reorder_point, mean_demand * 7 AS reorder_qty, "
        "mean_demand * lead_time_d + safety_stock + mean_demand * 7 AS max_stock FROM params",
        doubles=["mean_demand", "std_dev", "safety_stock", "reorder_point", "reorder_qty", "max_stock"], digits=2, ctes=DEMAND_SQL,
    ),
)
def t11_safety_stock(spark, sf_dir):
    return finish(pl.safety_stock(_daily_demand(spark, sf_dir), "depot", "throughput", _lead_times(spark)), digits=2)


@query(
    "t12_stockout_days",
    sql_finish(
        "SELECT d.depot, CAST(count(d.throughput) AS BIGINT) AS days, "
        "CAST(count(*) FILTER (WHERE d.throughput > p.mean_demand + 0.5 * p.std_dev) AS BIGINT) AS stockout_days_no_ss, "
        "CAST(count(*) FILTER (WHERE d.throughput > p.mean_demand + p.safety_stock / sqrt(p.lead_time_d)) AS BIGINT) AS stockout_days_with_ss, "
        "count(*) FILTER (WHERE d.throughput > p.mean_demand + 0.5 * p.std_dev) * 100.0 / count(d.throughput) AS stockout_pct_no_ss, "
        "count(*) FILTER (WHERE d.throughput > p.mean_demand + p.safety_stock / sqrt(p.lead_time_d)) * 100.0 / count(d.throughput) AS stockout_pct_with_ss, "
        "CAST(count(*) FILTER (WHERE d.throughput > p.mean_demand + 0.5 * p.std_dev) - count(*) FILTER (WHERE d.throughput > p.mean_demand + p.safety_stock / sqrt(p.lead_time_d)) AS BIGINT) AS days_saved "
        "FROM daily d JOIN params p USING (depot) GROUP BY d.depot",
        doubles=["stockout_pct_no_ss", "stockout_pct_with_ss"], ctes=DEMAND_SQL,
    ),
)
def t12_stockout_days(spark, sf_dir):
    daily = _daily_demand(spark, sf_dir)
    params = pl.safety_stock(daily, "depot", "throughput", _lead_times(spark))
    return finish(pl.stockout_days(daily, "depot", "throughput", params))


# ----------------------------------------------------------------------------
# Sites are order priorities; cost, minimum and capacity from the data
# ----------------------------------------------------------------------------
SUPPLY_FACTORS = [0.8, 1.0, 1.1, 1.2, 1.5]

SITES_SQL = """sites AS (
  SELECT o_orderpriority AS site, round(avg(o_totalprice) / 1000, 2) AS cost, CAST(count(*) AS DOUBLE) / 10 AS min_qty,
         CAST(count(*) AS DOUBLE) / 10 * 1.6 AS max_qty FROM orders GROUP BY 1
),
base AS (SELECT sum(min_qty) * 1.2 AS supply FROM sites)"""


def _sites(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    s = o.groupBy(F.col("o_orderpriority").alias("site")).agg(
        F.round(F.avg("o_totalprice") / 1000, 2).alias("cost"), (F.count("*").cast("double") / 10).alias("min_qty"))
    return s.withColumn("max_qty", F.col("min_qty") * 1.6)


ALLOC_COLS = ["site", "cost", "min_qty", "max_qty", "supply", "allocation", "status", "site_cost", "total_cost", "remaining",
              "utilization_pct", "cost_share_pct"]


@query(
    "t13_allocation",
    sql_finish(
        """
        WITH x AS (SELECT s.*, b.supply, s.min_qty AS allocation FROM sites s, base b),
        t AS (SELECT *, sum(min_qty) OVER () AS sum_min, sum(allocation) OVER () AS total_alloc,
                     max(CAST(min_qty > max_qty AS INT)) OVER () AS bad, allocation * cost AS site_cost FROM x)
        SELECT site, cost, min_qty, max_qty, supply, allocation,
               CASE WHEN sum_min <= supply AND bad = 0 AND total_alloc <= supply THEN 'Optimal' ELSE 'Infeasible' END AS status,
               site_cost, sum(site_cost) OVER () AS total_cost, supply - total_alloc AS remaining,
               total_alloc * 100.0 / supply AS utilization_pct, site_cost * 100.0 / sum(site_cost) OVER () AS cost_share_pct
        FROM t
        """,
        doubles=["cost", "min_qty", "max_qty", "supply", "allocation", "site_cost", "total_cost", "remaining", "utilization_pct",
                 "cost_share_pct"],
        digits=2, ctes=SITES_SQL,
    ),
)
def t13_allocation(spark, sf_dir):
    s = _sites(spark, sf_dir)
    supply = s.agg(F.sum("min_qty") * 1.2).scalar()
    x = s.withColumn("supply", supply).withColumn("scenario", F.lit(1.0))
    return finish(pl.allocate(x).select(*ALLOC_COLS), digits=2)


@query(
    "t14_supply_sensitivity",
    sql_finish(
        f"""
        WITH sc AS (SELECT unnest([{', '.join(str(f) for f in SUPPLY_FACTORS)}]) AS factor),
        x AS (SELECT s.*, sc.factor, sum(s.min_qty) OVER (PARTITION BY sc.factor) * sc.factor AS supply FROM sites s, sc),
        t AS (SELECT factor, supply, sum(min_qty) AS sum_min, sum(min_qty * cost) AS total_cost, max(CAST(min_qty > max_qty AS INT)) AS bad
              FROM x GROUP BY factor, supply)
        SELECT supply, CASE WHEN sum_min <= supply AND bad = 0 THEN 'Optimal' ELSE 'Infeasible' END AS status,
               CASE WHEN sum_min <= supply AND bad = 0 THEN round(total_cost) END AS total_cost,
               CASE WHEN sum_min <= supply AND bad = 0 THEN round(sum_min * 100.0 / supply, 1) END AS utilization_pct
        FROM t
        """,
        doubles=["supply", "total_cost", "utilization_pct"], digits=2, ctes=SITES_SQL,
    ),
)
def t14_supply_sensitivity(spark, sf_dir):
    s = _sites(spark, sf_dir)
    total_min = s.agg(F.sum("min_qty")).scalar()
    x = s.select("*", F.explode(F.array(*[F.lit(f) for f in SUPPLY_FACTORS])).alias("factor"))
    x = x.withColumn("supply", total_min * F.col("factor")).withColumn("scenario", F.col("factor"))
    out = pl.scenario_summary(pl.allocate(x)).drop("scenario")
    return finish(out, digits=2)


# ----------------------------------------------------------------------------
# Daily event counts per type
# ----------------------------------------------------------------------------
def _daily_counts(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("ds")).agg(
        F.count("*").cast("double").alias("y"), F.avg((F.col("value") > 100).cast("double")).alias("regressor"))


def _holidays(spark, sf_dir):
    cal = calendar(read_table(spark, sf_dir, "events"), "ts").filter(F.col("is_holiday") == 1)
    return pl.expand_holidays(cal.select(F.col("date").alias("ds"), "holiday_name"), "ds", -1, 1)


@query(
    "t8_holiday_windows",
    sql_finish(
        f"SELECT c.date AS ds, c.holiday_name, CAST(unnest(generate_series(c.date - 1, c.date + 1, INTERVAL 1 DAY)) AS DATE) AS window_ds "
        f"FROM cal c WHERE c.is_holiday = 1",
        dates=["ds", "window_ds"], ctes=CAL_SQL,
    ),
)
def t8_holiday_windows(spark, sf_dir):
    return finish(_holidays(spark, sf_dir).drop("offset"))


@query("t7_forecast")
def t7_forecast(spark, sf_dir):
    hist = _daily_counts(spark, sf_dir)
    rate = hist.agg(F.avg("regressor")).scalar()
    return pl.forecast(hist, 60, holidays=_holidays(spark, sf_dir), regressor_future=rate)


@query("t9_weekly_component")
def t9_weekly_component(spark, sf_dir):
    fc = t7_forecast(spark, sf_dir)
    return pl.weekly_component(fc).join(pl.horizon_means(fc), "series")


# The same model on a fixed design -- a line and the seven weekdays, nothing shrunk -- has a closed form.
FIXED = {"n_changepoints": 0, "ridge": 0.0, "weekly_order": 3, "yearly_order": 0}


def _line_sql(rows: str) -> str:
    """Least squares of a common slope and a level per weekday, per series, over ``rows`` (series, ds, y; y is null in the future)."""
    return f"""
        x AS (SELECT *, date_diff('day', min(ds) OVER (PARTITION BY series), ds) AS t, isodow(ds) - 1 AS wd FROM {rows}),
        m AS (SELECT series, wd, avg(t) AS tm, avg(y) AS ym FROM x WHERE y IS NOT NULL GROUP BY series, wd),
        b AS (SELECT series, sum((t - tm) * (y - ym)) / sum((t - tm) * (t - tm)) AS slope FROM x JOIN m USING (series, wd) WHERE y IS NOT NULL GROUP BY series),
        lvl AS (SELECT series, wd, ym - slope * tm AS a, avg(ym - slope * tm) OVER (PARTITION BY series) AS base, slope FROM m JOIN b USING (series)),
        fit AS (SELECT x.*, a + slope * t AS yhat, a - base AS weekly, base + slope * t AS trend FROM x JOIN lvl USING (series, wd)),
        sd AS (SELECT series, stddev_samp(y - yhat) AS sd FROM fit GROUP BY series),
        fc AS (SELECT fit.*, yhat - {pl.INTERVAL_Z} * sd AS yhat_lower, yhat + {pl.INTERVAL_Z} * sd AS yhat_upper FROM fit JOIN sd USING (series))"""


DAILY_SQL = "d AS (SELECT event_type AS series, CAST(ts AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y FROM events GROUP BY 1, 2)"
AHEAD_SQL = DAILY_SQL + """,
        r AS (SELECT series, ds, y FROM d UNION ALL SELECT series, CAST(unnest(generate_series(max(ds) + 1, max(ds) + 60, INTERVAL 1 DAY)) AS DATE), NULL
              FROM d GROUP BY series),""" + _line_sql("r")


def _fixed_forecast(spark, sf_dir):
    hist = _daily_counts(spark, sf_dir).withColumn("regressor", F.lit(0.0))
    return pl.forecast(hist, 60, **FIXED)


@query(
    "t7_fixed_design",
    sql_finish("SELECT series, ds, yhat, yhat_lower, yhat_upper, trend, weekly, y IS NULL AS is_future FROM fc",
               doubles=["yhat", "yhat_lower", "yhat_upper", "trend", "weekly"], dates=["ds"], ctes=AHEAD_SQL),
)
def t7_fixed_design(spark, sf_dir):
    fc = _fixed_forecast(spark, sf_dir)
    return finish(fc.select("series", "ds", "yhat", "yhat_lower", "yhat_upper", "trend", "weekly", "is_future"))


@query(
    "t9_fixed_design",
    sql_finish(
        """
        SELECT * FROM (SELECT series, strftime(ds, '%A') AS weekday, CAST(wd AS BIGINT) AS weekday_no, avg(weekly) AS mean_weekly_effect FROM fc GROUP BY ALL)
        JOIN (SELECT series, avg(yhat) AS mean_yhat, avg(yhat_lower) AS mean_lower, avg(yhat_upper) AS mean_upper, CAST(count(*) AS BIGINT) AS horizon_days
              FROM fc WHERE y IS NULL GROUP BY series) USING (series)
        """,
        doubles=["mean_weekly_effect", "mean_yhat", "mean_lower", "mean_upper"], ctes=AHEAD_SQL,
    ),
)
def t9_fixed_design(spark, sf_dir):
    fc = _fixed_forecast(spark, sf_dir)
    return finish(pl.weekly_component(fc).join(pl.horizon_means(fc), "series"))


@query("t10_forecast_holdout")
def t10_forecast_holdout(spark, sf_dir):
    """The whole model of T7, refitted before each of two held-out weeks and scored on them."""
    held = pl.rolling_holdout(_daily_counts(spark, sf_dir), [7, 14], 7, holidays=_holidays(spark, sf_dir))
    return pl.forecast_scores(held, by=["origin"])


@query(
    "t10_fixed_holdout",
    sql_finish(
        """
        SELECT origin, avg(abs(actual - yhat) / actual) * 100 AS mape_pct, sqrt(avg((actual - yhat) ^ 2)) AS rmse, avg(abs(actual - yhat)) AS mae,
               avg(actual) AS mean_actual, avg(yhat) AS mean_forecast, CAST(count(*) AS BIGINT) AS n,
               CASE WHEN avg(abs(actual - yhat) / actual) * 100 < 10 THEN 'EXCELLENT' WHEN avg(abs(actual - yhat) / actual) * 100 < 15 THEN 'GOOD'
                    ELSE 'ACCEPTABLE' END AS grade
        FROM fc WHERE y IS NULL GROUP BY origin
        """,
        doubles=["mape_pct", "rmse", "mae", "mean_actual", "mean_forecast"], dates=["origin"],
        ctes=DAILY_SQL + """,
        o AS (SELECT CAST(max(ds) - b + 1 AS DATE) AS origin FROM d, (SELECT unnest([7, 14])::INTEGER AS b) GROUP BY b),
        r AS (SELECT series || origin AS series, origin, ds, y AS actual, CASE WHEN ds < origin THEN y END AS y FROM d, o WHERE ds < origin + 7),"""
        + _line_sql("r"),
    ),
)
def t10_fixed_holdout(spark, sf_dir):
    hist = _daily_counts(spark, sf_dir).withColumn("regressor", F.lit(0.0))
    return finish(pl.forecast_scores(pl.rolling_holdout(hist, [7, 14], 7, **FIXED), by=["origin"]))


@query(
    "t10_holdout_scores",
    sql_finish(
        """
        WITH d AS (SELECT event_type AS series, CAST(ts AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y FROM events GROUP BY 1, 2),
        cut AS (SELECT max(ds) - 6 AS c FROM d),
        actual AS (SELECT d.* FROM d, cut WHERE d.ds >= cut.c),
        pred AS (SELECT series, ds + 7 AS ds, y AS yhat FROM d)
        SELECT avg(abs(a.y - p.yhat) / a.y) * 100 AS mape_pct, sqrt(avg((a.y - p.yhat) ^ 2)) AS rmse, avg(abs(a.y - p.yhat)) AS mae,
               avg(a.y) AS mean_actual, avg(p.yhat) AS mean_forecast, CAST(count(*) AS BIGINT) AS n,
               CASE WHEN avg(abs(a.y - p.yhat) / a.y) * 100 < 10 THEN 'EXCELLENT' WHEN avg(abs(a.y - p.yhat) / a.y) * 100 < 15 THEN 'GOOD'
                    ELSE 'ACCEPTABLE' END AS grade
        FROM actual a JOIN pred p ON a.series = p.series AND a.ds = p.ds
        """,
        doubles=["mape_pct", "rmse", "mae", "mean_actual", "mean_forecast"],
    ),
)
def t10_holdout_scores(spark, sf_dir):
    d = _daily_counts(spark, sf_dir).drop("regressor")
    cut = d.agg(F.date_sub(F.max("ds"), 6)).scalar()
    actual = d.filter(F.col("ds") >= cut)
    # A seasonal-naive forecast (same weekday last week) as the model under test.
    pred = d.select("series", F.date_add("ds", 7).alias("ds"), F.col("y").alias("yhat"))
    return finish(pl.holdout_scores(actual, pred, ["series", "ds"]))
