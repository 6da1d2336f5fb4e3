"""Scalar parsing / labelling functions and filters on the driver tables.

Messy text is derived from the clean driver columns inside each query, then
parsed back with the library's functions; the SQL twin does the same in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from opsanalytics.functions import scalar as sc
from opsanalytics.functions.nulls import clip_range, count_where
from opsanalytics.operators.filters import conjunctive_filter, envelope_breaches
from opsanalytics.operators.summaries import before_after
from opsanalytics.plans.driver_tables import PRIORITY_ALIASES, fixed, read_table, sfixed
from opsanalytics.plans.registry import finish, query
from opsanalytics.plans.sqlkit import sql_finish, sround

NUM_RE = sc.NUMERIC_PATTERN[1:-1]


def _sql_num(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '{NUM_RE}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def _events(spark, sf_dir):
    """Events with planted gaps: value missing when user_id % 7 = 0."""
    ev = read_table(spark, sf_dir, "events")
    return ev.withColumn("value", F.when(F.col("user_id") % 7 != 0, F.col("value")))


EVENTS_SQL = "events_g AS (SELECT * REPLACE (CASE WHEN user_id % 7 <> 0 THEN value END AS value) FROM events)"


# ----------------------------------------------------------------------------
# parsing
# ----------------------------------------------------------------------------
@query(
    "c1_parse_mixed_datetime",
    """
    WITH t AS (
      SELECT o_orderdate AS d,
        CASE WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
             WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M')
             ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS raw
      FROM orders
    ), p AS (
      SELECT d, raw, CASE WHEN trim(raw) LIKE '%/%' THEN try_strptime(trim(raw), '%d/%m/%Y %H:%M')
                          ELSE try_strptime(trim(raw), '%Y-%m-%d %H:%M') END AS parsed FROM t
    )
    SELECT CASE WHEN raw LIKE '%/%' THEN 'day_first' ELSE 'iso' END AS pattern,
           CAST(count(*) AS BIGINT) AS n, CAST(count(parsed) AS BIGINT) AS n_parsed,
           CAST(count(*) FILTER (WHERE parsed = d) AS BIGINT) AS n_equal
    FROM p GROUP BY 1
    """,
)
def c1_parse_mixed_datetime(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    raw = (F.when(k % 13 == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
           .when(k % 2 == 0, F.date_format(d, "dd/MM/yyyy HH:mm"))
           .otherwise(F.date_format(d, "yyyy-MM-dd HH:mm")))
    t = o.select(d.alias("d"), raw.alias("raw")).withColumn("parsed", sc.parse_mixed_datetime("raw"))
    return t.groupBy(F.when(F.col("raw").contains("/"), "day_first").otherwise("iso").alias("pattern")).agg(
        F.count("*").alias("n"), F.count("parsed").alias("n_parsed"),
        count_where(F.col("parsed") == F.col("d")).alias("n_equal"),
    )


@query(
    "c2_parse_amount",
    sql_finish(
        f"""
        WITH t AS (
          SELECT o_orderkey % 3 AS branch,
            CASE WHEN o_orderkey % 3 = 0 THEN format('{{:,.2f}}', {sround('o_totalprice', 2)})
                 WHEN o_orderkey % 3 = 1 THEN ' ' || {sfixed('o_totalprice', 2)} || ' '
                 ELSE NULL END AS raw
          FROM orders
        )
        SELECT CAST(branch AS BIGINT) AS branch, CAST(count({_sql_num("replace(raw, ',', '')")}) AS BIGINT) AS n_parsed,
               coalesce(sum({_sql_num("replace(raw, ',', '')")}), 0.0) AS total
        FROM t GROUP BY branch
        """,
        doubles=["total"], digits=2,
    ),
)
def c2_parse_amount(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    raw = (F.when(k % 3 == 0, F.format_number(F.round(p, 2), 2))
           .when(k % 3 == 1, F.concat(F.lit(" "), fixed(p, 2), F.lit(" "))))
    t = o.select((k % 3).alias("branch"), sc.parse_amount(raw).alias("v"))
    return finish(t.groupBy("branch").agg(F.count("v").alias("n_parsed"), F.coalesce(F.sum("v"), F.lit(0.0)).alias("total")), digits=2)


@query(
    "c3_parse_numeric",
    sql_finish(
        f"""
        WITH t AS (
          SELECT l_linenumber % 4 AS branch,
            CASE l_linenumber % 4 WHEN 0 THEN {sfixed('l_quantity', 2)}
                 WHEN 1 THEN {sfixed('l_quantity', 2)} || 'd'
                 WHEN 2 THEN ' ' || {sfixed('l_quantity', 2)} || ' '
                 ELSE 'n/a' END AS raw
          FROM lineitem
        )
        SELECT CAST(branch AS BIGINT) AS branch, CAST(count({_sql_num('raw')}) AS BIGINT) AS n_parsed,
               coalesce(sum({_sql_num('raw')}), 0.0) AS total
        FROM t GROUP BY branch
        """,
        doubles=["total"], digits=2,
    ),
)
def c3_parse_numeric(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    q = fixed(F.col("l_quantity"), 2)
    b = F.col("l_linenumber") % 4
    raw = (F.when(b == 0, q).when(b == 1, F.concat(q, F.lit("d")))
           .when(b == 2, F.concat(F.lit(" "), q, F.lit(" "))).otherwise(F.lit("n/a")))
    t = li.select(b.cast("bigint").alias("branch"), sc.parse_numeric(raw).alias("v"))
    return finish(t.groupBy("branch").agg(F.count("v").alias("n_parsed"), F.coalesce(F.sum("v"), F.lit(0.0)).alias("total")), digits=2)


_MESSY_PRIORITY_SQL = """CASE WHEN o_orderkey % 250 = 0 THEN 'unknown place'
         WHEN o_orderkey % 4 = 0 THEN upper(o_orderpriority)
         WHEN o_orderkey % 4 = 1 THEN '  ' || lower(o_orderpriority) || ' '
         WHEN o_orderkey % 4 = 2 THEN lower(split_part(o_orderpriority, '-', -1))
         ELSE o_orderpriority END"""


@query(
    "c4_normalize_alias",
    f"""
    SELECT CASE lower(trim({_MESSY_PRIORITY_SQL})) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_ALIASES.items())} END AS depot,
           CAST(count(*) AS BIGINT) AS n
    FROM orders GROUP BY 1
    """,
)
def c4_normalize_alias(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    messy = (F.when(k % 250 == 0, F.lit("unknown place")).when(k % 4 == 0, F.upper(p))
             .when(k % 4 == 1, F.concat(F.lit("  "), F.lower(p), F.lit(" ")))
             .when(k % 4 == 2, F.lower(F.substring_index(p, "-", -1))).otherwise(p))
    return o.groupBy(sc.normalize_alias(messy, PRIORITY_ALIASES).alias("depot")).agg(F.count("*").alias("n"))


@query(
    "c5_normalize_label",
    """
    SELECT regexp_replace(upper(trim(CASE WHEN p_partkey % 2 = 0 THEN ' ' || lower(replace(p_type, ' ', '_'))
                                          ELSE replace(p_type, ' ', '-') || '  ' END)), '[-_]', ' ', 'g') AS label,
           CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE p_type = regexp_replace(upper(trim(CASE WHEN p_partkey % 2 = 0 THEN ' ' || lower(replace(p_type, ' ', '_')) ELSE replace(p_type, ' ', '-') || '  ' END)), '[-_]', ' ', 'g')) AS BIGINT) AS n_equal
    FROM part GROUP BY 1
    """,
)
def c5_normalize_label(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    t = F.col("p_type")
    messy = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), F.lower(F.regexp_replace(t, " ", "_")))).otherwise(
        F.concat(F.regexp_replace(t, " ", "-"), F.lit("  "))
    )
    x = p.select(t, sc.normalize_label(messy).alias("label"))
    return x.groupBy("label").agg(F.count("*").alias("n"), count_where(F.col("p_type") == F.col("label")).alias("n_equal"))


@query(
    "c6_parse_utc_timestamp",
    """
    WITH t AS (SELECT ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS raw FROM events)
    SELECT CAST(count(*) AS BIGINT) AS n,
           CAST(count(*) FILTER (WHERE CAST(try_strptime(raw, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) = date_trunc('second', ts)) AS BIGINT) AS n_equal
    FROM t
    """,
)
def c6_parse_utc_timestamp(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    t = ev.select(F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"), sc.parse_utc_timestamp(raw).cast("timestamp_ntz").alias("p"))
    return t.agg(F.count("*").alias("n"), count_where(F.col("p") == F.col("ts")).alias("n_equal"))


@query(
    "s4_parse_dayfirst_date",
    """
    SELECT CAST(count(*) AS BIGINT) AS n,
           CAST(count(*) FILTER (WHERE CAST(strptime(strftime(o_orderdate, '%-d/%-m/%Y'), '%d/%m/%Y') AS DATE) = CAST(o_orderdate AS DATE)) AS BIGINT) AS n_equal
    FROM orders
    """,
)
def s4_parse_dayfirst_date(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    d = sc.parse_dayfirst_date(F.date_format("o_orderdate", "d/M/yyyy"))
    return o.agg(F.count("*").alias("n"), count_where(d == F.to_date("o_orderdate")).alias("n_equal"))


# ----------------------------------------------------------------------------
# Guards, fills, subsets
# ----------------------------------------------------------------------------
@query(
    "c7_drop_missing",
    f"WITH {EVENTS_SQL} SELECT event_type, CAST(count(*) AS BIGINT) AS n_kept FROM events_g WHERE value IS NOT NULL AND ts IS NOT NULL GROUP BY event_type",
)
def c7_drop_missing(spark, sf_dir):
    return _events(spark, sf_dir).na.drop(subset=["value", "ts"]).groupBy("event_type").agg(F.count("*").alias("n_kept"))


@query(
    "c8_exact_dedupe",
    "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem",
)
def c8_exact_dedupe(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus").dropDuplicates()


@query(
    "c10_range_guard",
    sql_finish(
        "SELECT event_type, CAST(count(CASE WHEN value BETWEEN 0 AND 400 THEN value END) AS BIGINT) AS n_valid, "
        "avg(CASE WHEN value BETWEEN 0 AND 400 THEN value END) AS mean_valid FROM events GROUP BY event_type",
        doubles=["mean_valid"],
    ),
)
def c10_range_guard(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumn("g", sc.range_guard("value", 0, 400))
    return finish(ev.groupBy("event_type").agg(F.count("g").alias("n_valid"), F.avg("g").alias("mean_valid")))


@query(
    "c11_positive_filter",
    "SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_discount > 0 GROUP BY l_returnflag",
)
def c11_positive_filter(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_discount") > 0).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query(
    "c12_default_fill",
    """
    SELECT coalesce(c.c_name, 'UNKNOWN CUSTOMER') = 'UNKNOWN CUSTOMER' AS is_unknown, CAST(count(*) AS BIGINT) AS n,
           CAST(sum(coalesce(c.c_nationkey, 0)) AS BIGINT) AS nation_sum
    FROM orders o LEFT JOIN customer c ON o.o_custkey = CASE WHEN c.c_custkey % 10 <> 0 THEN c.c_custkey END
    GROUP BY 1
    """,
)
def c12_default_fill(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    # Every customer is read; a tenth of them lose their key, which makes the gaps.
    key = F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey"))
    c = read_table(spark, sf_dir, "customer").withColumn("c_custkey", key)
    j = o.join(c, o.o_custkey == c.c_custkey, "left").na.fill({"c_name": "UNKNOWN CUSTOMER"})
    j = j.withColumn("c_nationkey", F.coalesce(F.col("c_nationkey"), F.lit(0)).cast("bigint"))
    return j.groupBy((F.col("c_name") == "UNKNOWN CUSTOMER").alias("is_unknown")).agg(
        F.count("*").alias("n"), F.sum("c_nationkey").cast("bigint").alias("nation_sum")
    )


@query(
    "c16_flag_subset",
    f"WITH {EVENTS_SQL} SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events_g "
    "WHERE user_id % 7 <> 0 AND event_type <> 'error' GROUP BY event_type",
)
def c16_flag_subset(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.filter((F.col("user_id") % 7 != 0) & (F.col("event_type") != "error")).groupBy("event_type").agg(
        F.count("*").alias("n")
    )


@query(
    "c27_clip",
    sql_finish(
        "SELECT event_type, sum(CASE WHEN value < 5 THEN 5 WHEN value > 400 THEN 400 ELSE value END) AS clipped_sum, "
        "min(CASE WHEN value < 5 THEN 5 WHEN value > 400 THEN 400 ELSE value END) AS clipped_min, "
        "max(CASE WHEN value < 5 THEN 5 WHEN value > 400 THEN 400 ELSE value END) AS clipped_max FROM events GROUP BY event_type",
        doubles=["clipped_sum", "clipped_min", "clipped_max"], digits=2,
    ),
)
def c27_clip(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumn("c", clip_range("value", 5, 400))
    return finish(ev.groupBy("event_type").agg(F.sum("c").alias("clipped_sum"), F.min("c").alias("clipped_min"),
                                              F.max("c").alias("clipped_max")), digits=2)


@query(
    "c28_rename_select",
    sql_finish("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders",
               doubles=["amount"], digits=2),
)
def c28_rename_select(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "amount"}
    )
    return finish(o.select("order_id", "customer_id", "amount"), digits=2)


# ----------------------------------------------------------------------------
# Efficiency KPI and tiers
# ----------------------------------------------------------------------------
_NET = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"


def _tier_sql(x: str) -> str:
    return f"CASE WHEN {x} < 70.0 THEN 'Critical' WHEN {x} < 90.0 THEN 'Warning' ELSE 'Normal' END"


@query(
    "c18_efficiency_tiers",
    f"""
    WITH a AS (SELECT l_orderkey, sum({_NET}) AS actual FROM lineitem GROUP BY l_orderkey),
    e AS (SELECT CASE WHEN o.o_totalprice <> 0 THEN round(a.actual / o.o_totalprice * 100, 2) END AS eff
          FROM orders o JOIN a ON o.o_orderkey = a.l_orderkey)
    SELECT {_tier_sql('eff')} AS status, CAST(count(*) AS BIGINT) AS n FROM e GROUP BY 1
    """,
)
def c18_efficiency_tiers(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    a = li.groupBy("l_orderkey").agg(F.sum(F.expr(_NET)).alias("actual"))
    o = read_table(spark, sf_dir, "orders")
    e = o.join(a, o.o_orderkey == a.l_orderkey).select(sc.efficiency_pct("actual", "o_totalprice").alias("eff"))
    return e.groupBy(sc.efficiency_status("eff").alias("status")).agg(F.count("*").alias("n"))


@query(
    "c19_site_kpi_report",
    sql_finish(
        f"""
        WITH a AS (SELECT l_orderkey, sum({_NET}) AS actual FROM lineitem GROUP BY l_orderkey),
        s AS (SELECT o.o_orderpriority AS site, sum(a.actual) * 0.9 AS actual, sum(o.o_totalprice) AS target
              FROM orders o JOIN a ON o.o_orderkey = a.l_orderkey GROUP BY 1)
        SELECT site, actual, target, round(actual / target * 100, 2) AS efficiency_pct,
               {_tier_sql('round(actual / target * 100, 2)')} AS status FROM s
        """,
        doubles=["actual", "target"], digits=2,
    ),
)
def c19_site_kpi_report(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    a = li.groupBy("l_orderkey").agg(F.sum(F.expr(_NET)).alias("actual"))
    o = read_table(spark, sf_dir, "orders")
    s = o.join(a, o.o_orderkey == a.l_orderkey).groupBy(F.col("o_orderpriority").alias("site")).agg(
        (F.sum("actual") * 0.9).alias("actual"), F.sum("o_totalprice").alias("target")
    )
    eff = sc.efficiency_pct("actual", "target", on_zero="error")
    return finish(s.withColumn("efficiency_pct", eff).withColumn("status", sc.efficiency_status("efficiency_pct")), digits=2)


# ----------------------------------------------------------------------------
# Labels from time and sensors
# ----------------------------------------------------------------------------
@query(
    "c20_shift_of_hour",
    sql_finish(
        "SELECT CASE WHEN hour(ts) >= 6 AND hour(ts) < 14 THEN 'Morning' WHEN hour(ts) >= 14 AND hour(ts) < 22 "
        "THEN 'Afternoon' ELSE 'Night' END AS shift, CAST(count(*) AS BIGINT) AS n, avg(value) AS mean_value "
        "FROM events GROUP BY 1",
        doubles=["mean_value"],
    ),
)
def c20_shift_of_hour(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return finish(ev.groupBy(sc.shift_of_hour(F.hour("ts")).alias("shift")).agg(
        F.count("*").alias("n"), F.avg("value").alias("mean_value")))


@query(
    "c21_binary_bin",
    sql_finish(
        f"WITH {EVENTS_SQL} SELECT CASE WHEN coalesce(value > 100, false) THEN 'High (> 100)' ELSE 'Low (<= 100)' END AS bin, "
        "CAST(count(*) AS BIGINT) AS n, avg(value) AS mean_value FROM events_g GROUP BY 1",
        doubles=["mean_value"],
    ),
)
def c21_binary_bin(spark, sf_dir):
    ev = _events(spark, sf_dir)
    b = sc.binary_bin("value", 100, "High (> 100)", "Low (<= 100)")
    return finish(ev.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg("value").alias("mean_value")))


@query(
    "c22_calendar_parts",
    "SELECT CAST(ts AS DATE)::VARCHAR AS day, strftime(ts, '%Y-%m') AS month_period, CAST(month(ts) AS BIGINT) AS month, "
    "dayname(ts) AS weekday_name, strftime(ts, '%Y-%m-%d') AS day_str, CAST(count(*) AS BIGINT) AS n "
    "FROM events GROUP BY ALL",
)
def c22_calendar_parts(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    parts = sc.calendar_parts("ts")
    g = ev.groupBy(
        parts["day"].cast("string").alias("day"), parts["month_period"].alias("month_period"),
        parts["month"].cast("bigint").alias("month"), parts["weekday_name"].alias("weekday_name"),
        parts["day_str"].alias("day_str"),
    )
    return g.agg(F.count("*").alias("n"))


# Pump-like sensors derived from line items (vibration, temperature, pressure, errors).
_SENSORS_SQL = ("l_quantity / 10 AS vibration, 50 + l_discount * 400 AS temperature, "
                "90 + l_tax * 200 AS pressure, l_linenumber - 1 AS errors")


def _sensors(li):
    return li.select(
        "l_orderkey", "l_shipdate",
        (F.col("l_quantity") / 10).alias("vibration"), (50 + F.col("l_discount") * 400).alias("temperature"),
        (90 + F.col("l_tax") * 200).alias("pressure"), (F.col("l_linenumber") - 1).alias("errors"),
    )


_HEALTH_SQL = ("CASE WHEN coalesce(vibration > 4.1, false) OR coalesce(temperature > 85.0, false) OR coalesce(pressure < 98.0, false) "
               "OR coalesce(errors >= 4, false) THEN 'Critical' "
               "WHEN coalesce(vibration > 3.0, false) OR coalesce(temperature > 76.0, false) OR coalesce(errors >= 2, false) "
               "THEN 'Warning' ELSE 'Healthy' END")


@query(
    "c23_health_rule",
    f"SELECT {_HEALTH_SQL} AS health_status, CAST(count(*) AS BIGINT) AS n FROM (SELECT {_SENSORS_SQL} FROM lineitem) GROUP BY 1",
)
def c23_health_rule(spark, sf_dir):
    s = _sensors(read_table(spark, sf_dir, "lineitem"))
    st = sc.health_status("vibration", "temperature", "pressure", "errors")
    return s.groupBy(st.alias("health_status")).agg(F.count("*").alias("n"))


@query(
    "c24_failure_label",
    f"""
    WITH s AS (SELECT l_orderkey, l_shipdate, {_SENSORS_SQL} FROM lineitem),
    last AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
    x AS (SELECT s.*, date_diff('second', s.l_shipdate, last.last_ship) / 3600.0 AS remaining_hours, {_HEALTH_SQL} AS st
          FROM s JOIN last USING (l_orderkey))
    SELECT st AS health_status, CAST(coalesce(remaining_hours <= 168, false) OR coalesce(st = 'Critical', false) AS INT) AS failure_label,
           CAST(count(*) AS BIGINT) AS n
    FROM x GROUP BY 1, 2
    """,
)
def c24_failure_label(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    s = _sensors(li)
    # Per-order horizon as an aggregate joined back (no window over a hot key).
    last = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    x = s.join(last, "l_orderkey").withColumns(
        {
            "remaining_hours": F.timestamp_diff("SECOND", F.col("l_shipdate"), F.col("last_ship")) / 3600.0,
            "health_status": sc.health_status("vibration", "temperature", "pressure", "errors"),
        }
    )
    lab = sc.failure_label("remaining_hours", "health_status", horizon_hours=168)
    return x.groupBy("health_status", lab.alias("failure_label")).agg(F.count("*").alias("n"))


# ----------------------------------------------------------------------------
# F2 / F5 / F6
# ----------------------------------------------------------------------------
@query(
    "f2_four_way_filter",
    sql_finish(
        "SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, sum(l_quantity) AS qty FROM lineitem "
        "WHERE l_returnflag IN ('A', 'R') AND l_linestatus IN ('F') AND coalesce(regexp_matches(CAST(l_suppkey AS VARCHAR), '^[1-5]', 'i'), false) "
        "AND CAST(l_shipdate AS DATE) >= DATE '1993-01-01' AND CAST(l_shipdate AS DATE) <= DATE '1995-12-31' GROUP BY l_returnflag",
        doubles=["qty"], digits=2,
    ),
)
def f2_four_way_filter(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").withColumn("supp", F.col("l_suppkey").cast("string"))
    f = conjunctive_filter(li, in_lists={"l_returnflag": ["A", "R"], "l_linestatus": ["F"]}, contains={"supp": "^[1-5]"},
                           date_col="l_shipdate", start_date="1993-01-01", end_date="1995-12-31")
    return finish(f.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty")), digits=2)


@query(
    "f5_period_split",
    sql_finish(
        "SELECT l_returnflag, avg(CASE WHEN CAST(l_shipdate AS DATE) <= DATE '1995-06-17' THEN l_quantity END) AS mean_before, "
        "avg(CASE WHEN CAST(l_shipdate AS DATE) > DATE '1995-06-17' THEN l_quantity END) AS mean_after, "
        "(avg(CASE WHEN CAST(l_shipdate AS DATE) > DATE '1995-06-17' THEN l_quantity END) - avg(CASE WHEN CAST(l_shipdate AS DATE) <= DATE '1995-06-17' THEN l_quantity END)) * 100 "
        "/ avg(CASE WHEN CAST(l_shipdate AS DATE) <= DATE '1995-06-17' THEN l_quantity END) AS pct_change FROM lineitem GROUP BY l_returnflag",
        doubles=["mean_before", "mean_after", "pct_change"],
    ),
)
def f5_period_split(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return finish(before_after(li, ["l_returnflag"], "l_shipdate", "1995-06-17", "l_quantity"))


@query(
    "f6_envelope_breaches",
    sql_finish("SELECT event_id, ts, value FROM events WHERE value < 1 OR value > 450", doubles=["value"], times=["ts"]),
)
def f6_envelope_breaches(spark, sf_dir):
    return finish(envelope_breaches(read_table(spark, sf_dir, "events"), "value", 1, 450, ["event_id", "ts"]))
