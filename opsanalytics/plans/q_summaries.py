"""Aggregation, profiling and diagnostic queries on the driver tables
(A8-A37, W9-W14, L4-L6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsanalytics.functions import scalar as sc
from opsanalytics.functions.nulls import count_where, mask_not_equal
from opsanalytics.operators import diagnostics as dg
from opsanalytics.operators import summaries as sm
from opsanalytics.operators import timeseries as ts
from opsanalytics.plans.driver_tables import read_table
from opsanalytics.plans.q_clean import EVENTS_SQL, _events
from opsanalytics.plans.q_series import CAL_SQL, calendar
from opsanalytics.plans.registry import finish, query
from opsanalytics.plans.sqlkit import sql_finish

SHIFT_SQL = ("CASE WHEN hour(ts) >= 6 AND hour(ts) < 14 THEN 'Morning' WHEN hour(ts) >= 14 AND hour(ts) < 22 "
             "THEN 'Afternoon' ELSE 'Night' END")
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _orders_x(spark, sf_dir):
    """Orders with customer nation and region (sites) and a 1-5 severity."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    x = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(
        r, F.col("n_regionkey") == F.col("r_regionkey"))
    return x.withColumn("severity", F.substring("o_orderpriority", 1, 1).cast("int"))


ORDERS_X_SQL = """orders_x AS (
  SELECT o.*, c.*, n.*, r.*, CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS severity
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


# ----------------------------------------------------------------------------
# A8 / A9 / A12 / A13 / A14 / A15 / A16 / A17 / A18 / A19
# ----------------------------------------------------------------------------
@query(
    "a8_stats_by_shift",
    sql_finish(
        f"WITH {EVENTS_SQL} SELECT {SHIFT_SQL} AS shift, avg(value) AS value_mean, max(value) AS value_max, min(value) AS value_min "
        "FROM events_g GROUP BY 1",
        doubles=["value_mean", "value_max", "value_min"], digits=2,
    ),
)
def a8_stats_by_shift(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn("shift", sc.shift_of_hour(F.hour("ts")))
    return finish(sm.multi_stat(ev, ["shift"], ["value"], ["mean", "max", "min"], digits=None), digits=2)


@query(
    "a9_stats_by_bin",
    sql_finish(
        f"WITH {EVENTS_SQL} SELECT CASE WHEN coalesce(value > 100, false) THEN 'High' ELSE 'Low' END AS bin, "
        "avg(value) AS value_mean, median(value) AS value_median, stddev_samp(value) AS value_std, CAST(count(value) AS BIGINT) AS value_count "
        "FROM events_g GROUP BY 1",
        doubles=["value_mean", "value_median", "value_std"],
    ),
)
def a9_stats_by_bin(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn("bin", sc.binary_bin("value", 100, "High", "Low"))
    return finish(sm.multi_stat(ev, ["bin"], ["value"], ["mean", "median", "std", "count"], digits=None))


@query(
    "a12_frequency_share",
    sql_finish(
        "SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS share_pct "
        "FROM customer GROUP BY c_mktsegment",
        doubles=["share_pct"],
    ),
)
def a12_frequency_share(spark, sf_dir):
    return finish(sm.frequency(read_table(spark, sf_dir, "customer"), "c_mktsegment"))


@query(
    "a13_class_ratio",
    sql_finish(
        "SELECT CAST(count(*) FILTER (WHERE quality = 1) AS BIGINT) AS n_major, CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_minor, "
        "count(*) FILTER (WHERE quality = 1) * 1.0 / nullif(count(*) FILTER (WHERE quality = 0), 0) AS ratio FROM labels",
        doubles=["ratio"],
    ),
)
def a13_class_ratio(spark, sf_dir):
    lb = read_table(spark, sf_dir, "labels")
    return finish(sm.ratio_of_counts(lb, F.col("quality") == 1, F.col("quality") == 0))


@query(
    "a14_structural_break",
    sql_finish(
        "SELECT event_type, avg(CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-15' THEN value END) AS mean_before, "
        "avg(CASE WHEN CAST(ts AS DATE) > DATE '2024-01-15' THEN value END) AS mean_after, "
        "(avg(CASE WHEN CAST(ts AS DATE) > DATE '2024-01-15' THEN value END) - avg(CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-15' THEN value END)) * 100 "
        "/ avg(CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-15' THEN value END) AS pct_change FROM events GROUP BY event_type",
        doubles=["mean_before", "mean_after", "pct_change"],
    ),
)
def a14_structural_break(spark, sf_dir):
    return finish(sm.before_after(read_table(spark, sf_dir, "events"), ["event_type"], "ts", "2024-01-15", "value"))


@query(
    "a15_month_site_mean",
    sql_finish(
        "SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS site, avg(o_totalprice) AS mean_price "
        "FROM orders GROUP BY 1, 2",
        doubles=["mean_price"], digits=2,
    ),
)
def a15_month_site_mean(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    g = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("site"))
    return finish(g.agg(F.avg("o_totalprice").alias("mean_price")), digits=2)


@query(
    "a16_weekday_mean",
    sql_finish(
        "SELECT dayname(o_orderdate) AS weekday_name, CAST(isodow(o_orderdate) AS BIGINT) AS weekday_no, avg(o_totalprice) AS mean_price "
        "FROM orders GROUP BY 1, 2",
        doubles=["mean_price"], digits=2,
    ),
)
def a16_weekday_mean(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    # weekday(): Monday = 0, so the fixed Monday..Sunday order is weekday + 1.
    g = o.groupBy(F.date_format("o_orderdate", "EEEE").alias("weekday_name"),
                  (F.weekday("o_orderdate") + 1).cast("bigint").alias("weekday_no"))
    return finish(g.agg(F.avg("o_totalprice").alias("mean_price")).orderBy("weekday_no"), digits=2)


@query(
    "a17_flag_rate",
    sql_finish(
        """
        WITH g AS (SELECT o_orderpriority, avg(CAST(o_orderstatus = 'F' AS INT)) AS flag_mean,
                          CAST(sum(CAST(o_orderstatus = 'F' AS INT)) AS BIGINT) AS flag_sum, CAST(count(*) AS BIGINT) AS n
                   FROM orders GROUP BY 1)
        SELECT *, flag_mean * 100 AS rate_pct, avg(flag_mean * 100) OVER () AS network_avg_rate_pct FROM g
        """,
        doubles=["flag_mean", "rate_pct", "network_avg_rate_pct"],
    ),
)
def a17_flag_rate(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").withColumn("flag", (F.col("o_orderstatus") == "F").cast("int"))
    return finish(sm.flag_rate(o, "o_orderpriority", "flag"))


@query(
    "a18_subset_means",
    sql_finish(
        "SELECT avg(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS mean_one, "
        "avg(o_totalprice) FILTER (WHERE o_orderpriority <> '1-URGENT') AS mean_peers, "
        "avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS mean_flagged, "
        "avg(o_totalprice) FILTER (WHERE o_orderstatus <> 'F') AS mean_unflagged FROM orders",
        doubles=["mean_one", "mean_peers", "mean_flagged", "mean_unflagged"], digits=2,
    ),
)
def a18_subset_means(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    p, s, v = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
    return finish(o.agg(F.avg(F.when(p == "1-URGENT", v)).alias("mean_one"), F.avg(F.when(p != "1-URGENT", v)).alias("mean_peers"),
                        F.avg(F.when(s == "F", v)).alias("mean_flagged"), F.avg(F.when(s != "F", v)).alias("mean_unflagged")),
                  digits=2)


@query(
    "a19_daily_rollup",
    sql_finish(
        "SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag AS depot, sum(l_quantity) AS qty, avg(l_extendedprice) AS mean_price, "
        "CAST(max(CAST(l_discount > 0.09 AS INT)) AS BIGINT) AS any_flag, "
        "CAST(max(CAST(coalesce(l_linestatus <> 'O', true) AS INT)) AS BIGINT) AS any_incident FROM lineitem GROUP BY 1, 2",
        doubles=["qty", "mean_price"], dates=["day"], digits=2,
    ),
)
def a19_daily_rollup(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    g = li.groupBy(F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("depot"))
    return finish(g.agg(
        F.sum("l_quantity").alias("qty"), F.avg("l_extendedprice").alias("mean_price"),
        F.max((F.col("l_discount") > 0.09).cast("int")).cast("bigint").alias("any_flag"),
        F.max(mask_not_equal("l_linestatus", "O").cast("int")).cast("bigint").alias("any_incident"),
    ), digits=2)


# ----------------------------------------------------------------------------
# Dashboard cuts
# ----------------------------------------------------------------------------
SIF_THRESHOLD = 100


def kpi_cards(x):
    return x.agg(
        F.count("*").alias("n_incidents"),
        F.avg("severity").alias("mean_severity"),
        count_where((F.col("severity") == 1) & (F.col("o_orderstatus") == "F")).alias("sif_count"),
        (F.avg((F.col("o_orderstatus") == "P").cast("int")) * 100).alias("lost_time_rate_pct"),
    ).withColumns(
        {
            "severity_bad": F.col("mean_severity") >= 2.5,
            "sif_bad": F.col("sif_count") > SIF_THRESHOLD,
            "lost_time_bad": F.col("lost_time_rate_pct") >= 25,
        }
    )


A20_SQL = f"""cards AS (
  SELECT CAST(count(*) AS BIGINT) AS n_incidents, avg(severity) AS mean_severity,
         CAST(count(*) FILTER (WHERE severity = 1 AND o_orderstatus = 'F') AS BIGINT) AS sif_count,
         avg(CAST(o_orderstatus = 'P' AS INT)) * 100 AS lost_time_rate_pct
  FROM orders_x WHERE r_name IN ('AFRICA', 'EUROPE')
)"""


@query(
    "a20_kpi_cards",
    sql_finish(
        f"SELECT *, mean_severity >= 2.5 AS severity_bad, sif_count > {SIF_THRESHOLD} AS sif_bad, lost_time_rate_pct >= 25 AS lost_time_bad FROM cards",
        doubles=["mean_severity", "lost_time_rate_pct"], ctes=ORDERS_X_SQL + ",\n" + A20_SQL,
    ),
)
def a20_kpi_cards(spark, sf_dir):
    x = _orders_x(spark, sf_dir).filter(F.col("r_name").isin("AFRICA", "EUROPE"))
    return finish(kpi_cards(x))


@query(
    "a21_threshold_alert",
    sql_finish(
        f"SELECT sif_count, printf('ALERT: %d potential serious incidents exceed the threshold of %d', sif_count, {SIF_THRESHOLD}) AS message "
        f"FROM cards WHERE sif_count > {SIF_THRESHOLD}",
        ctes=ORDERS_X_SQL + ",\n" + A20_SQL,
    ),
)
def a21_threshold_alert(spark, sf_dir):
    x = _orders_x(spark, sf_dir).filter(F.col("r_name").isin("AFRICA", "EUROPE"))
    cards = kpi_cards(x).filter(F.col("sif_bad"))
    msg = F.format_string("ALERT: %d potential serious incidents exceed the threshold of %d", F.col("sif_count"), F.lit(SIF_THRESHOLD))
    return cards.select("sif_count", msg.alias("message"))


@query(
    "a22_site_summary",
    sql_finish(
        "SELECT n_name AS site, CAST(count(*) AS BIGINT) AS n_incidents, round(avg(severity), 2) AS mean_severity, "
        "arg_min(c_acctbal, o_orderkey) AS latitude, arg_min(c_nationkey, o_orderkey) AS longitude FROM orders_x GROUP BY n_name",
        doubles=["latitude"], ctes=ORDERS_X_SQL,
    ),
)
def a22_site_summary(spark, sf_dir):
    x = _orders_x(spark, sf_dir)
    g = x.groupBy(F.col("n_name").alias("site")).agg(
        F.count("*").alias("n_incidents"), F.round(F.avg("severity"), 2).alias("mean_severity"),
        F.min_by("c_acctbal", "o_orderkey").alias("latitude"), F.min_by("c_nationkey", "o_orderkey").alias("longitude"),
    )
    return finish(g.orderBy(F.desc("n_incidents"), "site"))


@query(
    "a23_site_type_drilldown",
    sql_finish(
        "SELECT n_name AS site, o_orderpriority AS incident_type, CAST(count(*) AS BIGINT) AS n, avg(o_totalprice) AS mean_price "
        "FROM orders_x GROUP BY 1, 2",
        doubles=["mean_price"], digits=2, ctes=ORDERS_X_SQL,
    ),
)
def a23_site_type_drilldown(spark, sf_dir):
    x = _orders_x(spark, sf_dir)
    g = x.groupBy(F.col("n_name").alias("site"), F.col("o_orderpriority").alias("incident_type"))
    return finish(g.agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("mean_price")), digits=2)


@query(
    "a24_shift_weekday_pivot",
    "SELECT shift, " + ", ".join(f"CAST(count(*) FILTER (WHERE wd = '{d}') AS BIGINT) AS {d}" for d in WEEKDAYS)
    + f" FROM (SELECT {SHIFT_SQL} AS shift, dayname(ts) AS wd FROM events) GROUP BY shift",
)
def a24_shift_weekday_pivot(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(
        sc.shift_of_hour(F.hour("ts")).alias("shift"), F.date_format("ts", "EEEE").alias("wd"))
    out = sm.pivot_counts(ev, "shift", "wd", WEEKDAYS)
    return out.select("shift", *[F.col(d).cast("bigint").alias(d) for d in WEEKDAYS])


@query(
    "a25_region_condition_means",
    sql_finish(
        "SELECT r_name AS region, c_mktsegment AS condition, round(avg(c_acctbal), 2) AS mean_balance, round(avg(o_totalprice), 2) AS mean_price "
        "FROM orders_x GROUP BY 1, 2",
        ctes=ORDERS_X_SQL,
    ),
)
def a25_region_condition_means(spark, sf_dir):
    x = _orders_x(spark, sf_dir)
    g = x.groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("condition"))
    return g.agg(F.round(F.avg("c_acctbal"), 2).alias("mean_balance"), F.round(F.avg("o_totalprice"), 2).alias("mean_price"))


# ----------------------------------------------------------------------------
# SQL text over views
# ----------------------------------------------------------------------------
A26_TEXT = """
SELECT l_returnflag AS depot, l_linestatus AS product, COUNT(*) AS n_records, SUM(l_quantity) AS total_qty,
       ROUND(AVG(l_extendedprice), 2) AS avg_price
FROM {li}
GROUP BY l_returnflag, l_linestatus
ORDER BY total_qty DESC, depot
LIMIT 4
"""


@query(
    "a26_sql_two_key_summary",
    sql_finish(A26_TEXT.replace("{li}", "lineitem").replace("COUNT(*)", "CAST(COUNT(*) AS BIGINT)"), doubles=["total_qty"], digits=2),
)
def a26_sql_two_key_summary(spark, sf_dir):
    out = spark.sql(A26_TEXT, li=read_table(spark, sf_dir, "lineitem"))
    return finish(out, digits=2)


A27_TEXT = """
SELECT o_orderpriority AS depot, COUNT(*) AS n_orders, ROUND(AVG(o_totalprice), 2) AS avg_value,
       SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_finished
FROM {o}
GROUP BY o_orderpriority
ORDER BY n_finished DESC, depot ASC
"""


@query(
    "a27_sql_depot_summary",
    sql_finish(A27_TEXT.replace("{o}", "orders").replace("COUNT(*)", "CAST(COUNT(*) AS BIGINT)")
               .replace("ELSE 0 END)", "ELSE 0 END)::BIGINT")),
)
def a27_sql_depot_summary(spark, sf_dir):
    out = spark.sql(A27_TEXT, o=read_table(spark, sf_dir, "orders"))
    return out.withColumn("n_finished", F.col("n_finished").cast("bigint"))


A28_TEXT = """
SELECT holiday_name, listagg(CAST(date AS STRING), ', ') WITHIN GROUP (ORDER BY date) AS dates, max(is_holiday) AS is_holiday
FROM {cal}
GROUP BY holiday_name
ORDER BY is_holiday DESC, holiday_name
"""


@query(
    "a28_sql_string_agg",
    sql_finish(
        "SELECT holiday_name, string_agg(CAST(date AS VARCHAR), ', ' ORDER BY date) AS dates, max(is_holiday) AS is_holiday "
        "FROM cal GROUP BY holiday_name",
        bigints=["is_holiday"], ctes=CAL_SQL,
    ),
)
def a28_sql_string_agg(spark, sf_dir):
    cal = calendar(read_table(spark, sf_dir, "events"), "ts")
    return finish(spark.sql(A28_TEXT, cal=cal))


# ----------------------------------------------------------------------------
# Profiles and distributions
# ----------------------------------------------------------------------------
DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "a29_describe",
    sql_finish(
        " UNION ALL ".join(
            f"SELECT l_returnflag, '{c}' AS \"column\", CAST(count({c}) AS DOUBLE) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
            f"min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
            f"quantile_cont({c}, 0.75) AS p75 FROM lineitem GROUP BY l_returnflag"
            for c in DESC_COLS
        ),
        doubles=["count", "mean", "std", "min", "max", "p25", "p50", "p75"],
    ),
)
def a29_describe(spark, sf_dir):
    return finish(sm.describe(read_table(spark, sf_dir, "lineitem"), DESC_COLS, by=["l_returnflag"]))


PROFILE_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(
    "a30_profile_all",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", (SELECT CAST(count({c}) AS BIGINT) FROM customer) AS count,
                   (SELECT CAST(count(DISTINCT {c}) AS BIGINT) FROM customer) AS "unique",
                   (SELECT CAST({c} AS VARCHAR) FROM customer WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1) AS top,
                   (SELECT CAST(count(*) AS BIGINT) FROM customer WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq"""
        for c in PROFILE_COLS
    ),
)
def a30_profile_all(spark, sf_dir):
    return sm.profile_all(read_table(spark, sf_dir, "customer"), PROFILE_COLS)


@query(
    "a31_missing_audit",
    sql_finish(
        f"WITH {EVENTS_SQL} SELECT * FROM (SELECT 'value' AS \"column\", CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS n_missing, "
        "count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*) AS pct_missing FROM events_g) WHERE n_missing > 0",
        doubles=["pct_missing"],
    ),
)
def a31_missing_audit(spark, sf_dir):
    return finish(sm.missing_audit(_events(spark, sf_dir)))


A32_COLS = ["l_linestatus", "l_returnflag", "l_tax", "l_orderkey", "batch", "note"]


@query(
    "a32_constant_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", coalesce(count(DISTINCT {c}) + max(CAST({c} IS NULL AS INT)) = 1, false) AS is_constant "
        "FROM (SELECT *, 'batch 1' AS batch, CAST(NULL AS VARCHAR) AS note FROM lineitem)"
        for c in A32_COLS
    ),
)
def a32_constant_columns(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").withColumns({"batch": F.lit("batch 1"), "note": F.lit(None).cast("string")})
    return sm.constant_columns(li, A32_COLS)


@query(
    "a33_count_contract",
    f"WITH {EVENTS_SQL} SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(*) FILTER (WHERE user_id % 7 = 0) AS BIGINT) AS missing_rows, "
    "CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS null_rows, CAST(count(*) FILTER (WHERE value IS NOT NULL) AS BIGINT) AS valid_rows, "
    "count(*) = count(*) FILTER (WHERE value IS NULL) + count(*) FILTER (WHERE value IS NOT NULL) AS contract_holds FROM events_g",
)
def a33_count_contract(spark, sf_dir):
    ev = _events(spark, sf_dir)
    out = ev.agg(
        F.count("*").alias("total_rows"), count_where(F.col("user_id") % 7 == 0).alias("missing_rows"),
        count_where(F.col("value").isNull()).alias("null_rows"), count_where(F.col("value").isNotNull()).alias("valid_rows"),
    )
    return out.withColumn("contract_holds", F.col("total_rows") == F.col("null_rows") + F.col("valid_rows"))


@query(
    "a34_histogram",
    sql_finish(
        """
        WITH b AS (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1),
        x AS (SELECT l.l_returnflag, CAST(CASE WHEN b.hi = b.lo THEN 1 ELSE least(floor((l.l_extendedprice - b.lo) / (b.hi - b.lo) * 40) + 1, 40) END AS BIGINT) AS bin, b.lo, b.hi
              FROM lineitem l JOIN b USING (l_returnflag) WHERE l.l_extendedprice IS NOT NULL)
        SELECT l_returnflag, bin, CAST(count(*) AS BIGINT) AS n, min(lo) + (bin - 1) * (min(hi) - min(lo)) / 40 AS bin_start FROM x GROUP BY 1, 2
        """,
        doubles=["bin_start"], digits=2,
    ),
)
def a34_histogram(spark, sf_dir):
    return finish(sm.histogram(read_table(spark, sf_dir, "lineitem"), "l_extendedprice", 40, by=["l_returnflag"]), digits=2)


@query(
    "a35_kernel_density",
    sql_finish(
        """
        WITH s AS (SELECT l_returnflag, min(l_quantity) AS lo, max(l_quantity) AS hi, stddev_samp(l_quantity) * pow(count(l_quantity), -0.2) AS h,
                          count(l_quantity) AS n FROM lineitem GROUP BY 1),
        b AS (SELECT l.l_returnflag, least(floor((l_quantity - lo) / ((hi - lo) / 1024)), 1023) AS b, count(*) AS w
              FROM lineitem l JOIN s USING (l_returnflag) WHERE l_quantity IS NOT NULL GROUP BY 1, 2),
        g AS (SELECT *, unnest(range(32)) AS point FROM s),
        x AS (SELECT *, lo - 3 * h + point * (hi - lo + 6 * h) / 31 AS x FROM g)
        SELECT l_returnflag, point, x, sum(w * exp(-0.5 * pow((x - (lo + (b + 0.5) * (hi - lo) / 1024)) / h, 2)) / (h * sqrt(2 * pi()))) / any_value(n) AS density
        FROM x JOIN b USING (l_returnflag) GROUP BY 1, 2, 3
        """,
        doubles=["x", "density"], digits=6, bigints=["point"],
    ),
)
def a35_kernel_density(spark, sf_dir):
    return finish(dg.binned_kde(read_table(spark, sf_dir, "lineitem"), "l_quantity", by=["l_returnflag"], grid=32), digits=6)


@query(
    "a36_box_stats",
    sql_finish(
        """
        WITH q AS (SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median,
                          quantile_cont(l_quantity, 0.75) AS q3, CAST(count(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1),
        f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
        SELECT f.*, (SELECT CAST(count(*) AS BIGINT) FROM lineitem l WHERE l.l_returnflag = f.l_returnflag
                     AND (l.l_quantity < f.lower_fence OR l.l_quantity > f.upper_fence)) AS n_outliers FROM f
        """,
        doubles=["q1", "median", "q3", "iqr", "lower_fence", "upper_fence"],
    ),
)
def a36_box_stats(spark, sf_dir):
    return finish(sm.box_stats(read_table(spark, sf_dir, "lineitem"), "l_quantity", by=["l_returnflag"]))


@query(
    "a37_cohort_header",
    sql_finish(
        "SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_o_custkey, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date, "
        "CAST(count(*) AS BIGINT) AS n_rows FROM orders",
        times=["first_date", "last_date"],
    ),
)
def a37_cohort_header(spark, sf_dir):
    return finish(sm.cohort_header(read_table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate"))


# ----------------------------------------------------------------------------
# W9 - W14, L5, L6
# ----------------------------------------------------------------------------
@query(
    "w9_group_zscore_flags",
    sql_finish(
        f"""WITH {EVENTS_SQL},
        e AS (SELECT event_id, event_type, CASE WHEN event_id % 101 = 0 THEN value - 1000 ELSE value END AS value FROM events_g),
        s AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM e GROUP BY 1)
        SELECT e.event_id, e.event_type, e.value, (e.value - s.mu) / s.sd AS z_value
        FROM e JOIN s USING (event_type) WHERE (e.value - s.mu) / s.sd < -2.5""",
        doubles=["value", "z_value"],
    ),
)
def w9_group_zscore_flags(spark, sf_dir):
    # Every 101st event reads far too low.
    low = F.when(F.col("event_id") % 101 == 0, F.col("value") - 1000).otherwise(F.col("value"))
    ev = _events(spark, sf_dir).select("event_id", "event_type", low.alias("value"))
    return finish(dg.flag_low_z(ev, ["event_type"], "value"))


@query(
    "w10_global_z_outliers",
    sql_finish(
        "WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 211 = 0 THEN l_extendedprice * 20 ELSE l_extendedprice END "
        "AS l_extendedprice FROM lineitem), s AS (SELECT avg(l_extendedprice) AS mu, stddev_samp(l_extendedprice) AS sd FROM l) "
        "SELECT l_orderkey, l_linenumber, l_extendedprice, (l_extendedprice - mu) / sd AS z_l_extendedprice FROM l, s "
        "WHERE coalesce(abs((l_extendedprice - mu) / sd) > 3, false)",
        doubles=["l_extendedprice", "z_l_extendedprice"],
    ),
)
def w10_global_z_outliers(spark, sf_dir):
    # Some orders are priced twenty times too high.
    price = F.when(F.col("l_orderkey") % 211 == 0, F.col("l_extendedprice") * 20).otherwise(F.col("l_extendedprice"))
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", price.alias("l_extendedprice"))
    return finish(dg.global_z_outliers(li, "l_extendedprice"))


W11_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
W11_FACTOR = {"l_quantity": (97, 30), "l_extendedprice": (211, 20), "l_discount": (53, 1), "l_tax": (89, 25)}


@query(
    "w11_outlier_counts",
    "WITH l AS (SELECT " + ", ".join(f"{c} * CASE WHEN l_orderkey % {m} = 0 THEN {f} ELSE 1 END AS {c}" for c, (m, f) in W11_FACTOR.items())
    + " FROM lineitem) " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE abs(({c} - (SELECT avg({c}) FROM l)) / (SELECT stddev_pop({c}) FROM l)) > 3) AS BIGINT) AS n_outliers FROM l"
        for c in W11_COLS
    ),
)
def w11_outlier_counts(spark, sf_dir):
    # Some keys' values are scaled up, so that every cut-off has rows beyond it.
    scaled = {c: F.col(c) * F.when(F.col("l_orderkey") % m == 0, f).otherwise(1) for c, (m, f) in W11_FACTOR.items()}
    return dg.outlier_counts(read_table(spark, sf_dir, "lineitem").withColumns(scaled), W11_COLS)


@query(
    "w12_pareto_loss",
    sql_finish(
        """
        WITH g AS (SELECT n_name, sum(o_totalprice * 0.01 * severity) AS loss FROM orders_x GROUP BY n_name)
        SELECT n_name, loss, loss * 100 / sum(loss) OVER () AS share_pct,
               sum(loss) OVER (ORDER BY loss DESC, n_name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100 / sum(loss) OVER () AS cum_pct,
               row_number() OVER (ORDER BY loss DESC, n_name) AS rank
        FROM g
        """,
        doubles=["loss", "share_pct", "cum_pct"], digits=2, bigints=["rank"], ctes=ORDERS_X_SQL,
    ),
)
def w12_pareto_loss(spark, sf_dir):
    x = _orders_x(spark, sf_dir)
    return finish(dg.pareto(x, "n_name", F.col("o_totalprice") * 0.01 * F.col("severity")), digits=2)


@query(
    "w13_feature_recheck",
    sql_finish(
        """
        WITH f AS (SELECT event_id, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS m FROM events),
        d AS (SELECT abs(CASE WHEN event_id % 97 = 0 THEN m + 0.5 ELSE m END - m) AS d FROM f)
        SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE d > 1e-6) AS BIGINT) AS n_mismatch, max(d) AS max_abs_diff FROM d
        """,
        doubles=["max_abs_diff"],
    ),
)
def w13_feature_recheck(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    # The stored feature, from sums and counts, is wrong by a half for every 97th event; the recheck is the mean.
    x = ts.rolling_rows(ev, ["user_id"], ["ts", "event_id"], 6,
                        {"total": lambda w: F.sum("value").over(w), "n": lambda w: F.count("value").over(w), "recomputed": ts.mean_of("value")})
    stored = F.try_divide("total", "n") + F.when(F.col("event_id") % 97 == 0, 0.5).otherwise(0.0)
    return finish(dg.feature_mismatches(x.withColumn("stored", stored), "stored", "recomputed"))


@query(
    "w14_top_per_group",
    sql_finish(
        "SELECT o_orderpriority, o_orderkey, o_totalprice, rank FROM (SELECT o_orderpriority, o_orderkey, o_totalprice, "
        "row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3",
        doubles=["o_totalprice"], digits=2, bigints=["rank"],
    ),
)
def w14_top_per_group(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    out = sm.top_per_group(o, ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, tiebreak="o_orderkey")
    return finish(out, digits=2)


@query(
    "l5_seeded_sample",
    sql_finish("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey LIMIT 100",
               doubles=["o_totalprice"], digits=2),
)
def l5_seeded_sample(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return finish(sm.seeded_sample(o, 100, 42, "o_orderkey"), digits=2)


@query(
    "l6_argmax_and_mode",
    sql_finish(
        "SELECT (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) AS top_order, "
        "(SELECT o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) AS top_price, "
        "(SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1) AS mode_customer",
        doubles=["top_price"], digits=2,
    ),
)
def l6_argmax_and_mode(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    best = o.agg(F.max_by(F.struct("o_orderkey", "o_totalprice"), F.struct(F.col("o_totalprice"), -F.col("o_orderkey"))).alias("b"))
    mode = sm.most_frequent(o, "o_custkey")
    out = best.select(F.col("b.o_orderkey").alias("top_order"), F.col("b.o_totalprice").alias("top_price"),
                      mode.select("mode_o_custkey").scalar().alias("mode_customer"))
    return finish(out, digits=2)


@query(
    "l4_panel_sort",
    sql_finish("SELECT user_id, ts, event_id, value FROM events ORDER BY user_id, ts, event_id", doubles=["value"], times=["ts"]),
)
def l4_panel_sort(spark, sf_dir):
    """L4: chronological panel order (a range-partitioned sort, only at output)."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return finish(ev.orderBy("user_id", "ts", "event_id"))
