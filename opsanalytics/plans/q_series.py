"""Time-series queries on the driver tables.

``events`` plays the sensor log (value missing when user_id % 7 = 0), one
series per event_type; ``lineitem`` ship dates give daily demand; ``orders``
dates give weekly counts and the forecast horizon.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from opsanalytics.operators import timeseries as ts
from opsanalytics.plans.driver_tables import read_table
from opsanalytics.plans.q_clean import EVENTS_SQL, _events
from opsanalytics.plans.registry import finish, query
from opsanalytics.plans.sqlkit import sql_finish

HOURLY_SQL = f"""{EVENTS_SQL},
spine AS (
  SELECT event_type, unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS bin
  FROM events_g GROUP BY event_type
),
agg AS (SELECT event_type, date_trunc('hour', ts) AS bin, avg(value) AS mean_value, count(*) AS n FROM events_g GROUP BY 1, 2),
hourly AS (
  SELECT s.event_type, s.bin, a.mean_value, CAST(coalesce(a.n, 0) AS BIGINT) AS n
  FROM spine s LEFT JOIN agg a ON s.event_type = a.event_type AND s.bin = a.bin
)"""


def hourly(spark, sf_dir):
    """A10 output: hourly mean value and count per event type on a full spine."""
    ev = _events(spark, sf_dir)
    return ts.resample(ev, "ts", "hour", {"mean_value": F.avg("value"), "n": F.count("*")}, by=["event_type"],
                       empty={"n": 0})


@query(
    "u4_hour_spine",
    sql_finish(
        "SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS bin FROM events",
        times=["bin"],
    ),
)
def u4_hour_spine(spark, sf_dir):
    return finish(ts.time_spine(read_table(spark, sf_dir, "events"), "ts", "hour"))


@query("a10_hourly_mean", sql_finish("SELECT * FROM hourly", doubles=["mean_value"], times=["bin"], ctes=HOURLY_SQL))
def a10_hourly_mean(spark, sf_dir):
    return finish(hourly(spark, sf_dir))


@query(
    "a11_weekly_counts",
    sql_finish(
        """
        WITH w AS (SELECT CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS wk FROM orders),
        spine AS (SELECT unnest(generate_series(min(wk), max(wk), INTERVAL 7 DAY)) AS wk FROM w),
        g AS (SELECT wk, count(*) AS n FROM w GROUP BY wk)
        SELECT CAST(s.wk AS DATE) + 6 AS week_ending, CAST(coalesce(g.n, 0) AS BIGINT) AS n
        FROM spine s LEFT JOIN g ON CAST(s.wk AS DATE) = g.wk
        """,
        dates=["week_ending"],
    ),
)
def a11_weekly_counts(spark, sf_dir):
    return finish(ts.weekly_counts(read_table(spark, sf_dir, "orders"), "o_orderdate"))


@query(
    "w1_rolling24_mean",
    sql_finish(
        "SELECT event_type, bin, CAST(avg(round(CAST(CAST(mean_value AS VARCHAR) AS DECIMAL(38, 16)), 6)) OVER w AS DOUBLE) AS rolling_mean_24 FROM hourly "
        "WINDOW w AS (PARTITION BY event_type ORDER BY bin ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)",
        doubles=["rolling_mean_24"], times=["bin"], ctes=HOURLY_SQL,
    ),
)
def w1_rolling24_mean(spark, sf_dir):
    h = hourly(spark, sf_dir)
    w = ts.rows_window(["event_type"], "bin", 24)
    return finish(h.select("event_type", "bin", ts.rolling_mean("mean_value", w, 1, exact=True).alias("rolling_mean_24")))


DAILY_QTY_SQL = """
spine AS (SELECT l_returnflag, unnest(generate_series(date_trunc('day', min(l_shipdate)), date_trunc('day', max(l_shipdate)), INTERVAL 1 DAY)) AS bin
          FROM lineitem GROUP BY l_returnflag),
agg AS (SELECT l_returnflag, date_trunc('day', l_shipdate) AS bin, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
daily AS (SELECT s.l_returnflag, s.bin, a.qty FROM spine s LEFT JOIN agg a ON s.l_returnflag = a.l_returnflag AND s.bin = a.bin)"""


def daily_qty(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return ts.resample(li, "l_shipdate", "day", {"qty": F.sum("l_quantity")}, by=["l_returnflag"])


@query(
    "w2_rolling14_full",
    sql_finish(
        "SELECT l_returnflag, bin, CASE WHEN count(qty) OVER w >= 14 THEN avg(qty) OVER w END AS rolling_mean_14 FROM daily "
        "WINDOW w AS (PARTITION BY l_returnflag ORDER BY bin ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)",
        doubles=["rolling_mean_14"], times=["bin"], ctes=DAILY_QTY_SQL,
    ),
)
def w2_rolling14_full(spark, sf_dir):
    d = daily_qty(spark, sf_dir)
    w = ts.rows_window(["l_returnflag"], "bin", 14)
    return finish(d.select("l_returnflag", "bin", ts.rolling_mean("qty", w, 14).alias("rolling_mean_14")))


# Per-user rolling features on raw events via the skew-proof block method.
# A small block size makes the halo logic carry most rows even at sf0.01.


def _user_features(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    return ts.rolling_rows(
        ev, ["user_id"], ["ts", "event_id"], 6,
        {"value_mean_6": ts.mean_of("value"), "value_rms_6": ts.rms("value"), "value_p2p_6": ts.peak_to_peak("value"),
         "value_std_6": ts.std_filled("value")},
    )


W_USER = "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"


@query(
    "w3_rolling_features",
    sql_finish(
        f"WITH {EVENTS_SQL} SELECT event_id, user_id, avg(value) OVER w AS value_mean_6, sqrt(avg(value * value) OVER w) AS value_rms_6, "
        f"max(value) OVER w - min(value) OVER w AS value_p2p_6 FROM events_g {W_USER}",
        doubles=["value_mean_6", "value_rms_6", "value_p2p_6"],
    ),
)
def w3_rolling_features(spark, sf_dir):
    return finish(_user_features(spark, sf_dir).select("event_id", "user_id", "value_mean_6", "value_rms_6", "value_p2p_6"))


@query(
    "w4_rolling_std_diff",
    sql_finish(
        f"""WITH {EVENTS_SQL},
        f AS (SELECT event_id, user_id, ts, coalesce(stddev_samp(value) OVER w, 0.0) AS value_std_6, avg(value) OVER w AS m
              FROM events_g {W_USER})
        SELECT event_id, user_id, value_std_6,
               coalesce(m - lag(m, 6) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0.0) AS mean_diff_6
        FROM f""",
        doubles=["value_std_6", "mean_diff_6"],
    ),
)
def w4_rolling_std_diff(spark, sf_dir):
    f = _user_features(spark, sf_dir)
    d = ts.rolling_rows(f, ["user_id"], ["ts", "event_id"], 7, {"mean_diff_6": ts.diff_rows("value_mean_6", 6)})
    return finish(d.select("event_id", "user_id", "value_std_6", "mean_diff_6"))


@query(
    "w5_interpolate_linear",
    sql_finish(
        """
        WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY bin) AS rn,
                          CASE WHEN mean_value IS NOT NULL THEN row_number() OVER (PARTITION BY event_type ORDER BY bin) END AS vr
                   FROM hourly),
        p AS (SELECT *, last_value(vr IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pr,
                     last_value(CASE WHEN vr IS NOT NULL THEN mean_value END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
                     first_value(vr IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nr,
                     first_value(CASE WHEN vr IS NOT NULL THEN mean_value END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
              FROM r)
        SELECT event_type, bin, coalesce(mean_value, pv + (nv - pv) * (rn - pr) / (nr - pr), pv, nv) AS value_interp FROM p
        """,
        doubles=["value_interp"], times=["bin"], ctes=HOURLY_SQL,
    ),
)
def w5_interpolate_linear(spark, sf_dir):
    h = hourly(spark, sf_dir)
    return finish(h.select("event_type", "bin", ts.interpolate_linear("mean_value", ["event_type"], "bin").alias("value_interp")))


@query(
    "w6_ffill_bfill",
    sql_finish(
        "SELECT event_type, bin, coalesce("
        "last_value(mean_value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        "first_value(mean_value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value_filled "
        "FROM hourly",
        doubles=["value_filled"], times=["bin"], ctes=HOURLY_SQL,
    ),
)
def w6_ffill_bfill(spark, sf_dir):
    h = hourly(spark, sf_dir)
    return finish(h.select("event_type", "bin", ts.ffill_bfill("mean_value", ["event_type"], "bin").alias("value_filled")))


W7 = "(PARTITION BY event_type ORDER BY bin ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


@query(
    "w7_fill_rolling_mean",
    sql_finish(
        f"SELECT event_type, bin, coalesce(mean_value, avg(mean_value) OVER {W7}) AS value_filled FROM hourly",
        doubles=["value_filled"], times=["bin"], ctes=HOURLY_SQL,
    ),
)
def w7_fill_rolling_mean(spark, sf_dir):
    h = hourly(spark, sf_dir)
    w = ts.rows_window(["event_type"], "bin", 7)
    return finish(h.select("event_type", "bin", ts.fill_with_rolling("mean_value", w, "mean").alias("value_filled")))


@query(
    "w8_fill_rolling_median",
    sql_finish(
        f"SELECT event_type, bin, coalesce(mean_value, quantile_cont(mean_value, 0.5) OVER {W7}) AS value_filled FROM hourly",
        doubles=["value_filled"], times=["bin"], ctes=HOURLY_SQL,
    ),
)
def w8_fill_rolling_median(spark, sf_dir):
    h = hourly(spark, sf_dir)
    w = ts.rows_window(["event_type"], "bin", 7)
    return finish(h.select("event_type", "bin", ts.fill_with_rolling("mean_value", w, "median").alias("value_filled")))


# ----------------------------------------------------------------------------
# J5 / J6 / J7
# ----------------------------------------------------------------------------
@query(
    "j5_hourly_join",
    sql_finish(
        """
        SELECT h.event_type, h.bin, h.n AS events, v.peak_mean
        FROM hourly h LEFT JOIN (SELECT CASE WHEN hour(bin) % 6 <> 0 THEN bin END AS bin, max(mean_value) AS peak_mean FROM hourly GROUP BY hourly.bin) v
        ON h.bin = v.bin
        """,
        doubles=["peak_mean"], times=["bin"], ctes=HOURLY_SQL,
    ),
)
def j5_hourly_join(spark, sf_dir):
    return finish(_with_peak_mean(hourly(spark, sf_dir)))


def _with_peak_mean(h):
    """Every type's hours with the hour's highest mean of any type; the means of every sixth hour have lost their key."""
    means = h.groupBy("bin").agg(F.max("mean_value").alias("peak_mean"))
    means = means.withColumn("bin", F.when(F.hour("bin") % 6 != 0, F.col("bin")))
    return h.select("event_type", "bin", F.col("n").alias("events")).join(means, "bin", "left")


def calendar(df, date_col: str):
    """Day calendar over the data's date range: holiday on the 1st and 15th."""
    d = F.to_date(F.col(date_col))
    bounds = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    hol = F.dayofmonth("date").isin(1, 15)
    return days.select(
        "date",
        F.date_format("date", "EEEE").alias("day_name"),
        F.when(hol, F.concat(F.lit("Holiday "), F.dayofmonth("date").cast("string"))).alias("holiday_name"),
        hol.cast("int").alias("is_holiday"),
    )


CAL_SQL = """cal AS (
  SELECT CAST(d AS DATE) AS date, dayname(d) AS day_name,
         CASE WHEN day(d) IN (1, 15) THEN 'Holiday ' || CAST(day(d) AS VARCHAR) END AS holiday_name,
         CAST(day(d) IN (1, 15) AS INT) AS is_holiday
  FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM events)
)"""


@query(
    "j6_calendar_join",
    sql_finish(
        f"SELECT h.event_type, h.bin, h.n, c.day_name, coalesce(c.holiday_name, 'None') AS holiday_name, CAST(coalesce(c.is_holiday, 0) AS INT) AS is_holiday "
        f"FROM hourly h LEFT JOIN cal c ON CAST(h.bin AS DATE) = c.date",
        times=["bin"], bigints=["is_holiday"], ctes=HOURLY_SQL + ",\n" + CAL_SQL,
    ),
)
def j6_calendar_join(spark, sf_dir):
    h = hourly(spark, sf_dir).withColumn("date", F.to_date("bin"))
    cal = calendar(read_table(spark, sf_dir, "events"), "ts")
    # The calendar has one row per day of the range: bounded, broadcast it.
    j = h.join(F.broadcast(cal), "date", "left").select(
        "event_type", "bin", "n", "day_name", F.coalesce("holiday_name", F.lit("None")).alias("holiday_name"),
        F.coalesce("is_holiday", F.lit(0)).alias("is_holiday"),
    )
    return finish(j)


@query(
    "j7_future_regressor",
    sql_finish(
        """
        WITH last AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders),
        future AS (SELECT CAST(unnest(generate_series(d + 1, d + 60, INTERVAL 1 DAY)) AS DATE) AS ds FROM last),
        reg AS (SELECT CAST(o_orderdate AS DATE) + 365 AS ds, avg(o_totalprice) AS known_rate FROM orders GROUP BY 1)
        SELECT f.ds, coalesce(r.known_rate, 0.0) AS known_rate, CAST(day(f.ds) IN (1, 15) AS INT) AS is_holiday
        FROM future f LEFT JOIN reg r ON f.ds = r.ds
        """,
        doubles=["known_rate"], dates=["ds"], bigints=["is_holiday"], digits=2,
    ),
)
def j7_future_regressor(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    last = o.agg(F.max(d).alias("d"))
    future = last.select(F.explode(F.sequence(F.date_add("d", 1), F.date_add("d", 60))).alias("ds"))
    reg = o.groupBy(F.date_add(d, 365).alias("ds")).agg(F.avg("o_totalprice").alias("known_rate"))
    j = future.join(reg, "ds", "left").select(
        "ds", F.coalesce("known_rate", F.lit(0.0)).alias("known_rate"),
        F.dayofmonth("ds").isin(1, 15).cast("int").alias("is_holiday"),
    )
    return finish(j, digits=2)


@query(
    "j10_join_null_audit",
    sql_finish(
        "WITH j AS (SELECT h.event_type, h.bin, h.n AS events, v.peak_mean FROM hourly h LEFT JOIN "
        "(SELECT CASE WHEN hour(bin) % 6 <> 0 THEN bin END AS bin, max(mean_value) AS peak_mean FROM hourly GROUP BY hourly.bin) v ON h.bin = v.bin) "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing, "
            f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS pct_missing FROM j"
            for c in ("event_type", "bin", "events", "peak_mean")),
        doubles=["pct_missing"], ctes=HOURLY_SQL,
    ),
)
def j10_join_null_audit(spark, sf_dir):
    from opsanalytics.operators.summaries import missing_audit

    return finish(missing_audit(_with_peak_mean(hourly(spark, sf_dir)), only_offenders=False))
