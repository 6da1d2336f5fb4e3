"""Cleaning, issue log and quality-gate queries (C1-C16 on O2C exports, Q1-Q6, J4, U1, U2, R15)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from opsanalytics.functions.scalar import NUMERIC_PATTERN
from opsanalytics.operators import clean as cl
from opsanalytics.operators import quality as qa
from opsanalytics.operators import reconcile as rc
from opsanalytics.plans.driver_tables import (
    PRIORITY_ALIASES,
    RAW_CTES,
    SEGMENT_PRICES,
    o2c_raw_exports,
    read_table,
    sql_price,
)
from opsanalytics.plans.o2c_job import stored_tables
from opsanalytics.plans.registry import finish, query
from opsanalytics.plans.sqlkit import sql_finish, sround


# The driver's products are the market segments.
DRIVER_SPECS = qa.with_allowed(qa.O2C_SPECS, "loading_events", "product", list(SEGMENT_PRICES))


def cleaned_bundle(spark, sf_dir, persist: bool = True):
    """Cleaned tables + issue log.  With ``persist`` they are tables in the shared checkpoint folder, as the
    job writes them: the gate reads each in several independent aggregates (rules, uniqueness, anti joins, counts)."""
    raw = o2c_raw_exports(spark, sf_dir)
    if persist:
        # The issue counts and the cleaned tables both read the raw exports, whose derivation plan is deep.
        raw = stored_tables(spark, raw)
    if not persist:
        return cl.clean_all(raw, SEGMENT_PRICES, aliases=PRIORITY_ALIASES)
    cleaned, issues = cl.clean_all(raw, SEGMENT_PRICES, aliases=PRIORITY_ALIASES, store=lambda name, df: stored_tables(spark, {name: df})[name])
    return cleaned, stored_tables(spark, {"issues": issues})["issues"]


# ----------------------------------------------------------------------------
# SQL twins of the cleaners.
# ----------------------------------------------------------------------------
def _num(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '{NUMERIC_PATTERN[1:-1]}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def _amount(c: str) -> str:
    return _num(f"replace({c}, ',', '')")


def _dt(c: str) -> str:
    return (f"CASE WHEN trim({c}) LIKE '%/%' THEN try_strptime(trim({c}), '%d/%m/%Y %H:%M') "
            f"ELSE try_strptime(trim({c}), '%Y-%m-%d %H:%M') END")


_ALIAS = "CASE lower(trim(depot)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_ALIASES.items()) + " END"


def _dups(key: str) -> str:
    return f"count(*) - count(DISTINCT {key}) - max(CAST({key} IS NULL AS INT))"


def _keep_first(src: str, key: str) -> str:
    return f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY _row) = 1"


CLEAN_CTES = RAW_CTES + f""",
cl_l0 AS (
  SELECT loading_id, {_ALIAS} AS depot, product, customer, {_num('volume_loaded_litres')} AS volume_loaded_litres,
         {_num('meter_start')} AS meter_start, {_num('meter_end')} AS meter_end, {_dt('loading_ts')} AS loading_ts, _row
  FROM raw_loading_events
),
cl_l_cnt AS (
  SELECT count(*) FILTER (WHERE depot IS NULL) AS unmapped_depot_alias,
         count(*) FILTER (WHERE loading_ts IS NULL) AS unparseable_loading_ts,
         count(*) FILTER (WHERE customer IS NULL) AS missing_customer,
         {_dups('loading_id')} AS duplicate_loading_id
  FROM cl_l0
),
cl_l1 AS ({_keep_first("(SELECT * REPLACE (coalesce(customer, 'UNKNOWN CUSTOMER') AS customer), meter_end - meter_start AS meter_delta_litres FROM cl_l0)", 'loading_id')}),
cl_l_cnt2 AS (SELECT count(*) FILTER (WHERE NOT coalesce(volume_loaded_litres > 0, false)) AS non_positive_volume FROM cl_l1),
clean_loading_events AS (SELECT * EXCLUDE (_row) FROM cl_l1 WHERE coalesce(volume_loaded_litres > 0, false)),
cl_d0 AS (
  SELECT dispatch_id, loading_id, {_num('volume_dispatched_litres')} AS volume_dispatched_litres,
         {_dt('dispatch_ts')} AS dispatch_ts, status, _row
  FROM raw_dispatch_events
),
cl_d_cnt AS (
  SELECT count(*) FILTER (WHERE dispatch_ts IS NULL) AS unparseable_dispatch_ts, {_dups('dispatch_id')} AS duplicate_dispatch_id
  FROM cl_d0
),
cl_d1 AS ({_keep_first('cl_d0', 'dispatch_id')}),
cl_d_cnt2 AS (SELECT count(*) FILTER (WHERE NOT coalesce(volume_dispatched_litres > 0, false)) AS non_positive_volume FROM cl_d1),
clean_dispatch_events AS (SELECT * EXCLUDE (_row) FROM cl_d1 WHERE coalesce(volume_dispatched_litres > 0, false)),
cl_i0 AS (
  SELECT invoice_id, dispatch_id, product, {_num('volume_invoiced_litres')} AS volume_invoiced_litres,
         {_amount('unit_price_kes')} AS unit_price_kes, {_amount('amount_kes')} AS amount_kes,
         {_dt('invoice_date')} AS invoice_date, _row
  FROM raw_invoices
),
cl_i_cnt AS (
  SELECT count(*) FILTER (WHERE invoice_date IS NULL) AS unparseable_invoice_date,
         count(*) FILTER (WHERE unit_price_kes IS NULL) AS missing_unit_price_backfilled,
         count(*) FILTER (WHERE amount_kes IS NULL) AS missing_amount_backfilled,
         {_dups('invoice_id')} AS duplicate_invoice_id
  FROM cl_i0
),
cl_i1 AS (
  SELECT * REPLACE (coalesce(unit_price_kes,
                             CASE WHEN amount_kes IS NOT NULL AND coalesce(volume_invoiced_litres > 0, false)
                                  THEN amount_kes / volume_invoiced_litres END,
                             {sql_price('product')}) AS unit_price_kes)
  FROM cl_i0
),
cl_i2 AS (SELECT * REPLACE (coalesce(amount_kes, volume_invoiced_litres * unit_price_kes) AS amount_kes) FROM cl_i1),
cl_i3 AS ({_keep_first('cl_i2', 'invoice_id')}),
cl_i_cnt2 AS (
  SELECT coalesce(sum(n) FILTER (WHERE n > 1), 0) AS dispatch_with_multiple_invoices
  FROM (SELECT dispatch_id, count(*) AS n FROM cl_i3 GROUP BY dispatch_id)
),
clean_invoices AS (SELECT * EXCLUDE (_row) FROM cl_i3),
cl_p0 AS (
  SELECT payment_id, invoice_id, {_amount('amount_paid_kes')} AS amount_paid_kes, {_dt('payment_date')} AS payment_date, _row
  FROM raw_payments
),
cl_p_cnt AS (
  SELECT count(*) FILTER (WHERE payment_date IS NULL) AS unparseable_payment_date, {_dups('payment_id')} AS duplicate_payment_id
  FROM cl_p0
),
cl_p1 AS ({_keep_first('cl_p0', 'payment_id')}),
cl_p_cnt2 AS (SELECT count(*) FILTER (WHERE NOT coalesce(amount_paid_kes > 0, false)) AS non_positive_amount FROM cl_p1),
clean_payments AS (SELECT * EXCLUDE (_row) FROM cl_p1 WHERE coalesce(amount_paid_kes > 0, false))"""

_ISSUES = [
    ("loading_events", "cl_l_cnt", "unmapped_depot_alias", "warning"),
    ("loading_events", "cl_l_cnt", "unparseable_loading_ts", "critical"),
    ("loading_events", "cl_l_cnt", "missing_customer", "warning"),
    ("loading_events", "cl_l_cnt", "duplicate_loading_id", "critical"),
    ("loading_events", "cl_l_cnt2", "non_positive_volume", "critical"),
    ("dispatch_events", "cl_d_cnt", "unparseable_dispatch_ts", "critical"),
    ("dispatch_events", "cl_d_cnt", "duplicate_dispatch_id", "critical"),
    ("dispatch_events", "cl_d_cnt2", "non_positive_volume", "critical"),
    ("invoices", "cl_i_cnt", "unparseable_invoice_date", "critical"),
    ("invoices", "cl_i_cnt", "missing_unit_price_backfilled", "warning"),
    ("invoices", "cl_i_cnt", "missing_amount_backfilled", "warning"),
    ("invoices", "cl_i_cnt", "duplicate_invoice_id", "critical"),
    ("invoices", "cl_i_cnt2", "dispatch_with_multiple_invoices", "exception"),
    ("payments", "cl_p_cnt", "unparseable_payment_date", "critical"),
    ("payments", "cl_p_cnt", "duplicate_payment_id", "critical"),
    ("payments", "cl_p_cnt2", "non_positive_amount", "critical"),
]
ISSUES_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"check\", '{s}' AS severity, CAST({c} AS BIGINT) AS \"count\", '' AS detail "
    f"FROM {src} WHERE {c} > 0"
    for t, src, c, s in _ISSUES
)
CLEAN_CTES += f",\nissue_log AS ({ISSUES_SQL})"


# ----------------------------------------------------------------------------
# Q5 / U1 and the cleaned tables
# ----------------------------------------------------------------------------
@query("q5_issue_log", sql_finish("SELECT * FROM issue_log", ctes=CLEAN_CTES))
def q5_issue_log(spark, sf_dir):
    return finish(cleaned_bundle(spark, sf_dir)[1])


@query(
    "c9_clean_loading_events",
    sql_finish(
        "SELECT * FROM clean_loading_events",
        doubles=["volume_loaded_litres", "meter_start", "meter_end", "meter_delta_litres"],
        times=["loading_ts"], ctes=CLEAN_CTES,
    ),
)
def c9_clean_loading_events(spark, sf_dir):
    return finish(cleaned_bundle(spark, sf_dir)[0]["loading_events"])


@query(
    "c1_clean_dispatch_events",
    sql_finish(
        "SELECT * FROM clean_dispatch_events",
        doubles=["volume_dispatched_litres"], overrides={"volume_dispatched_litres": 6},
        times=["dispatch_ts"], ctes=CLEAN_CTES,
    ),
)
def c1_clean_dispatch_events(spark, sf_dir):
    return finish(cleaned_bundle(spark, sf_dir)[0]["dispatch_events"], overrides={"volume_dispatched_litres": 6})


@query(
    "c13_clean_invoices",
    sql_finish(
        "SELECT * FROM clean_invoices",
        doubles=["volume_invoiced_litres", "unit_price_kes", "amount_kes"],
        overrides={"volume_invoiced_litres": 6}, times=["invoice_date"], ctes=CLEAN_CTES,
    ),
)
def c13_clean_invoices(spark, sf_dir):
    return finish(cleaned_bundle(spark, sf_dir)[0]["invoices"], overrides={"volume_invoiced_litres": 6})


@query(
    "c2_clean_payments",
    sql_finish("SELECT * FROM clean_payments", doubles=["amount_paid_kes"], times=["payment_date"], ctes=CLEAN_CTES),
)
def c2_clean_payments(spark, sf_dir):
    return finish(cleaned_bundle(spark, sf_dir)[0]["payments"])


# ----------------------------------------------------------------------------
# Q1 / Q2 / Q3 / Q4
# ----------------------------------------------------------------------------
def _spec_sql(table: str, spec: qa.TableSpec) -> str:
    """Failure counts per check for one cleaned table (mirrors qa.rule_failures)."""
    parts = []
    src = f"clean_{table}"
    for col, rule in spec.columns.items():
        if rule.dtype is not None:
            parts.append(f"SELECT '{col}' AS col, 'dtype(''{rule.dtype}'')' AS chk, CAST(0 AS BIGINT) AS n")
        if not rule.nullable:
            parts.append(f"SELECT '{col}', 'not_nullable', count(*) FILTER (WHERE {col} IS NULL) FROM {src}")
        if rule.gt is not None:
            parts.append(f"SELECT '{col}', 'greater_than({qa._fmt_num(rule.gt)})', count(*) FILTER (WHERE {col} <= {rule.gt}) FROM {src}")
        if rule.isin is not None:
            lst = ", ".join(f"'{v}'" for v in rule.isin)
            label = f"isin({list(rule.isin)})".replace("'", "''")
            parts.append(
                f"SELECT '{col}', '{label}', count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({lst})) FROM {src}"
            )
        if rule.unique:
            parts.append(
                f"SELECT '{col}', 'field_uniqueness', coalesce(sum(n) FILTER (WHERE n > 1), 0) "
                f"FROM (SELECT {col}, count(*) AS n FROM {src} WHERE {col} IS NOT NULL GROUP BY {col})"
            )
    return " UNION ALL ".join(parts)


def _pct_text(expr: str, digits: int) -> str:
    return f"printf('%.{digits}f', {sround(expr, digits)})"


def _table_check_sql(table: str, spec: qa.TableSpec) -> str:
    return f"""
    SELECT 'schema:{table}' AS "check",
      CASE WHEN f.n_failed * 100.0 / greatest(r.n_rows, 1) > {qa.CRITICAL_ISSUE_MAX_PCT} THEN 'FAIL' ELSE 'PASS' END AS status,
      CASE WHEN f.n_failed = 0 THEN 'no violations'
           ELSE printf('%d rows (', f.n_failed) || {_pct_text('f.n_failed * 100.0 / greatest(r.n_rows, 1)', 2)}
                || '%) break rules: {{' || f.top || '}}' END AS detail,
      CAST(f.n_failed AS BIGINT) AS n_failed, CAST(r.n_rows AS BIGINT) AS n_rows,
      f.n_failed * 100.0 / greatest(r.n_rows, 1) AS pct_failed
    FROM (
      SELECT coalesce(sum(n), 0) AS n_failed,
             coalesce(string_agg('''' || chk || ''': ' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, chk)
                      FILTER (WHERE rk <= 3), '') AS top
      FROM (SELECT chk, n, row_number() OVER (ORDER BY n DESC, chk) AS rk
            FROM (SELECT chk, sum(n) AS n FROM ({_spec_sql(table, spec)}) x(col, chk, n) WHERE n > 0 GROUP BY chk))
    ) f, (SELECT count(*) AS n_rows FROM clean_{table}) r
    """


def _orphan_sql(name: str, child: str, fk: str, parent: str, pk: str) -> str:
    pct = "o.n * 100.0 / greatest(c.n, 1)"
    return f"""
    SELECT '{name}' AS "check", CASE WHEN {pct} > {qa.ORPHAN_FK_MAX_PCT} THEN 'FAIL' ELSE 'PASS' END AS status,
      printf('%d orphan rows (', o.n) || {_pct_text(pct, 3)} || '%) without a parent row' AS detail,
      CAST(o.n AS BIGINT) AS n_failed, CAST(c.n AS BIGINT) AS n_rows, {pct} AS pct_failed
    FROM (SELECT count(*) AS n FROM clean_{child} WHERE {fk} IS NULL OR {fk} NOT IN (SELECT {pk} FROM clean_{parent} WHERE {pk} IS NOT NULL)) o,
         (SELECT count(*) AS n FROM clean_{child}) c
    """


INTEGRITY_SQL = " UNION ALL ".join(
    [
        _orphan_sql("referential_integrity:dispatch_to_loading", "dispatch_events", "loading_id", "loading_events", "loading_id"),
        _orphan_sql("referential_integrity:invoice_to_dispatch", "invoices", "dispatch_id", "dispatch_events", "dispatch_id"),
        _orphan_sql("referential_integrity:payment_to_invoice", "payments", "invoice_id", "invoices", "invoice_id"),
    ]
)
_PCT_I = "i.\"count\" * 100.0 / greatest(coalesce(r.n_rows, 0), 1)"
THRESHOLD_SQL = f"""
SELECT 'critical_issue:' || i."table" || '.' || i."check" AS "check",
  CASE WHEN {_PCT_I} > {qa.CRITICAL_ISSUE_MAX_PCT} THEN 'FAIL' ELSE 'PASS' END AS status,
  printf('%d rows (', i."count") || {_pct_text(_PCT_I, 2)} || '%)' AS detail,
  CAST(i."count" AS BIGINT) AS n_failed, CAST(r.n_rows AS BIGINT) AS n_rows, {_PCT_I} AS pct_failed
FROM issue_log i LEFT JOIN (
  SELECT 'loading_events' AS t, count(*) AS n_rows FROM clean_loading_events UNION ALL
  SELECT 'dispatch_events', count(*) FROM clean_dispatch_events UNION ALL
  SELECT 'invoices', count(*) FROM clean_invoices UNION ALL
  SELECT 'payments', count(*) FROM clean_payments
) r ON i."table" = r.t
WHERE i.severity = 'critical'
"""
SCHEMA_SQL = " UNION ALL ".join(_table_check_sql(t, s) for t, s in DRIVER_SPECS.items())
GATE_SQL = f"{SCHEMA_SQL} UNION ALL {INTEGRITY_SQL} UNION ALL {THRESHOLD_SQL}"


@query("q1_schema_checks", sql_finish(SCHEMA_SQL, doubles=["pct_failed"], ctes=CLEAN_CTES))
def q1_schema_checks(spark, sf_dir):
    cleaned, _ = cleaned_bundle(spark, sf_dir)
    out = None
    for name, spec in DRIVER_SPECS.items():
        part = qa.table_check(cleaned[name], spec)
        out = part if out is None else out.unionByName(part)
    return finish(out)


# One segment is no longer allowed: all its loadings fail.
NARROW_SPECS = qa.with_allowed(qa.O2C_SPECS, "loading_events", "product", sorted(SEGMENT_PRICES)[1:])


@query("q1_allowed_products", sql_finish(_table_check_sql("loading_events", NARROW_SPECS["loading_events"]), doubles=["pct_failed"], ctes=CLEAN_CTES))
def q1_allowed_products(spark, sf_dir):
    cleaned, _ = cleaned_bundle(spark, sf_dir)
    return finish(qa.table_check(cleaned["loading_events"], NARROW_SPECS["loading_events"]))


@query("q2_referential_integrity", sql_finish(INTEGRITY_SQL, doubles=["pct_failed"], ctes=CLEAN_CTES))
def q2_referential_integrity(spark, sf_dir):
    return finish(qa.o2c_integrity(cleaned_bundle(spark, sf_dir)[0]))


@query("q3_issue_thresholds", sql_finish(THRESHOLD_SQL, doubles=["pct_failed"], ctes=CLEAN_CTES))
def q3_issue_thresholds(spark, sf_dir):
    cleaned, issues = cleaned_bundle(spark, sf_dir)
    return finish(qa.issue_thresholds(issues, cleaned))


@query(
    "q4_gate_status",
    sql_finish(
        f"SELECT CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS overall_status, "
        f"CAST(count(*) AS BIGINT) AS n_checks, CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS n_failed_checks "
        f"FROM ({GATE_SQL}) g",
        ctes=CLEAN_CTES,
    ),
)
def q4_gate_status(spark, sf_dir):
    cleaned, issues = cleaned_bundle(spark, sf_dir)
    return finish(qa.gate_status(qa.quality_gate(cleaned, issues, DRIVER_SPECS)))


# ----------------------------------------------------------------------------
# Raw exports -> clean -> reconcile -> leakage by depot (gate reported, not enforced here)
# ----------------------------------------------------------------------------
def _reconcile_over_clean() -> str:
    from opsanalytics.plans.driver_tables import O2C_CTES
    from opsanalytics.plans.q_o2c import RECONCILED_CTES

    tail = RECONCILED_CTES[len(O2C_CTES):]
    for a, b in [("FROM payments ", "FROM clean_payments "), ("FROM invoices i ", "FROM clean_invoices i "),
                 ("FROM loading_events l LEFT JOIN dispatch_events d", "FROM clean_loading_events l LEFT JOIN clean_dispatch_events d")]:
        assert a in tail, a
        tail = tail.replace(a, b)
    return CLEAN_CTES + tail


@query(
    "r15_clean_reconcile_by_depot",
    sql_finish(
        "SELECT depot, count(loading_id) AS loadings, "
        + ", ".join(f"coalesce(sum({c}), 0.0) AS {c}" for c in ["expected_revenue_kes", "collected_revenue_kes", "total_leakage_kes", *rc.LEAKAGE_CATEGORIES])
        + ", 100 * coalesce(sum(total_leakage_kes), 0.0) / coalesce(sum(expected_revenue_kes), 0.0) AS leakage_pct_of_expected "
        "FROM reconciled WHERE depot IS NOT NULL GROUP BY depot",
        doubles=["expected_revenue_kes", "collected_revenue_kes", "total_leakage_kes", *rc.LEAKAGE_CATEGORIES,
                 "leakage_pct_of_expected"],
        digits=2, overrides={"leakage_pct_of_expected": 6}, ctes=_reconcile_over_clean(),
    ),
)
def r15_clean_reconcile_by_depot(spark, sf_dir):
    cleaned, _ = cleaned_bundle(spark, sf_dir, persist=False)  # each table is read once here
    r = rc.reconcile(cleaned, prices=SEGMENT_PRICES)
    return finish(rc.summarize_by(r, "depot"), digits=2, overrides={"leakage_pct_of_expected": 6})


# ----------------------------------------------------------------------------
# The result document, written as JSON and read back
# ----------------------------------------------------------------------------
def _document_sql() -> str:
    from opsanalytics.plans.q_o2c import _facts_ctes, alerts_sql, narrative_sql

    seg = "coalesce(sum(total_leakage_kes), 0.0)"
    kpis = {"total_loadings": "s.n", "exception_count": "s.n_exc", "total_leakage_kes": "s.total", "total_expected_revenue_kes": "s.expected",
            "annualized_leakage_kes": "s.total / 45 * 365", **{c: f"s.{c}" for c in rc.LEAKAGE_CATEGORIES}}
    parts = [f"SELECT 'summary' AS part, '{k}' AS item, CAST({e} AS DOUBLE) AS amount, NULL AS text FROM s" for k, e in kpis.items()]
    for c in ("depot", "product", "customer"):
        cut = " LIMIT 10" if c == "customer" else ""
        parts.append(f"SELECT 'by_{c}', {c}, t, NULL FROM (SELECT {c}, {seg} AS t FROM reconciled WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY t DESC, {c}{cut})")
    parts += [
        "SELECT 'multi_invoice', NULL, CAST(count(*) AS DOUBLE), NULL FROM (SELECT dispatch_id FROM clean_invoices WHERE dispatch_id IS NOT NULL "
        "GROUP BY 1 HAVING count(*) > 1)",
        "SELECT 'data_quality', 'overall_status', NULL, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' ELSE 'PASS' END FROM gate",
        """SELECT 'check', "check", CAST(n_failed AS DOUBLE), status || ': ' || detail FROM gate""",
        """SELECT 'issue', "table" || '.' || "check", CAST("count" AS DOUBLE), severity FROM issue_log""",
        "SELECT 'roi', 'year1_realized_benefit_kes', year1_realized_benefit_kes, NULL FROM roi",
        "SELECT 'roi', 'payback_period_months', payback_period_months, NULL FROM roi",
        f"SELECT 'executive_narrative', NULL, NULL, narrative FROM ({narrative_sql(rc.CATEGORY_ACTIONS)})",
        f"SELECT 'alert', CAST(loading_id AS VARCHAR), total_leakage_kes, narrative FROM ({alerts_sql(rc.CATEGORY_ACTIONS)})",
    ]
    return sql_finish(" UNION ALL ".join(f"SELECT * FROM ({x})" for x in parts), doubles=["amount"], digits=2,
                      ctes=f"{_reconcile_over_clean()}, gate AS ({GATE_SQL}), {_facts_ctes()}")


@query("r15_result_document", _document_sql())
def r15_result_document(spark, sf_dir):
    """Raw exports to the result document; its parts as rows, read back from the JSON file."""
    from opsanalytics.session import checkpoint_dir
    from opsanalytics.sources import files as io

    cleaned, issues = cleaned_bundle(spark, sf_dir)
    made = stored_tables(spark, {"checks": qa.quality_gate(cleaned, issues, DRIVER_SPECS), "reconciled": rc.reconcile(cleaned, prices=SEGMENT_PRICES)})
    parts = stored_tables(spark, rc.result_parts(made["reconciled"], cleaned["invoices"]))
    doc = rc.result_document(parts, made["checks"], issues)
    path = f"{checkpoint_dir(spark)}/result-{uuid.uuid4().hex}"
    io.write_json_document(doc, path)
    d = io.read_json_document(spark, path, doc.schema)

    def part(name, item, amount, text=None):
        as_text = [c if c is not None else F.lit(None) for c in (item, text)]
        return F.struct(F.lit(name).alias("part"), as_text[0].cast("string").alias("item"),
                        (amount if amount is not None else F.lit(None)).cast("double").alias("amount"), as_text[1].cast("string").alias("text"))

    kpis = ["total_loadings", "exception_count", "total_leakage_kes", "total_expected_revenue_kes", "annualized_leakage_kes", *rc.LEAKAGE_CATEGORIES]
    single = [part("summary", F.lit(k), F.col(f"summary.{k}")) for k in kpis]
    single += [part("multi_invoice", None, F.col("multi_invoice_exception_count")),
               part("data_quality", F.lit("overall_status"), None, F.col("data_quality.overall_status")),
               *[part("roi", F.lit(k), F.col(f"roi.{k}")) for k in ("year1_realized_benefit_kes", "payback_period_months")],
               part("executive_narrative", None, None, F.col("executive_narrative"))]
    lists = [_segments(part, c) for c in ("depot", "product", "customer")]
    lists += [F.transform("data_quality.checks", lambda x: part("check", x["check"], x["n_failed"], F.concat(x["status"], F.lit(": "), x["detail"]))),
              F.transform("data_quality.issues", lambda x: part("issue", F.concat(x["table"], F.lit("."), x["check"]), x["count"], x["severity"])),
              F.transform("alert_narratives", lambda x: part("alert", x["loading_id"], x["total_leakage_kes"], x["narrative"]))]
    return finish(d.select(F.inline(F.concat(F.array(*single), *lists))), digits=2)


def _segments(part, c: str):
    return F.transform(f"by_{c}", lambda x: part(f"by_{c}", x[c], x["total_leakage_kes"]))


# ----------------------------------------------------------------------------
# J4 / U2 on the driver tables, Q6 rule suite on events
# ----------------------------------------------------------------------------
@query(
    "j4_lineitem_orphans",
    sql_finish(
        "SELECT CAST(count(*) AS BIGINT) AS n_orphans, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_orphan_orders, "
        "coalesce(sum(l_quantity), 0.0) AS orphan_quantity FROM lineitem l "
        "WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE CASE WHEN o.o_orderkey % 10 <> 0 THEN o.o_orderkey END = l.l_orderkey)",
        doubles=["orphan_quantity"], digits=2,
    ),
)
def j4_lineitem_orphans(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    # Every order is read; a tenth of them lose their key, which makes the orphans.
    parents = read_table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey")).alias("o_orderkey"))
    o = qa.orphans(li, "l_orderkey", parents, "o_orderkey")
    out = o.agg(
        F.count("*").cast("bigint").alias("n_orphans"),
        F.count_distinct("l_orderkey").cast("bigint").alias("n_orphan_orders"),
        F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("orphan_quantity"),
    )
    return finish(out, digits=2)


@query(
    "u2_orders_with_lineitems",
    "SELECT CAST(count(*) AS BIGINT) AS n_orders FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)",
)
def u2_orders_with_lineitems(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey")
    return o.join(li, o.o_orderkey == li.l_orderkey, "left_semi").agg(F.count("*").cast("bigint").alias("n_orders"))


EVENT_TYPES = ["click", "view", "purchase", "error", "signup"]


@query(
    "q6_event_rule_suite",
    f"""
    SELECT * FROM (
      SELECT bool_and(coalesce(ts IS NOT NULL, false)) AS not_null_ts,
             bool_and(coalesce(value BETWEEN 0 AND 200, false)) AS value_in_0_200,
             bool_and(coalesce(value > 0, false)) AS value_positive,
             bool_and(coalesce(event_type IN ({', '.join(repr(e) for e in EVENT_TYPES)}), false)) AS allowed_event_type,
             count(*) = count(DISTINCT event_id) AS unique_event_id,
             count(*) >= 1000 AS min_rows_1000
      FROM events
    ) UNPIVOT (passed FOR rule IN (not_null_ts, value_in_0_200, value_positive, allowed_event_type, unique_event_id, min_rows_1000))
    """,
)
def q6_event_rule_suite(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    v = F.col("value")
    return qa.rule_suite(
        ev,
        {
            "not_null_ts": F.col("ts").isNotNull(),
            "value_in_0_200": v.between(0, 200),
            "value_positive": v > 0,
            "allowed_event_type": F.col("event_type").isin(EVENT_TYPES),
        },
        unique=["event_id"],
        min_rows=1000,
    )
