"""Map the driver's TPC-H-style tables onto the order-to-cash exports.

loading  = orders x customer: id o_orderkey, depot o_orderpriority,
           product c_mktsegment, customer c_name, volume o_totalprice / 100,
           time o_orderdate.
dispatch = one per order that has line items: volume = loaded x (1 - min
           discount), time = first ship date, Cancelled when key % 97 = 0.
invoice  = finished line items (l_linestatus = 'F') per (order, return flag):
           id = key * 10 + {A 0, N 1, R 2}, volume = dispatched x flag quantity
           / order quantity, price = flag extended price / flag quantity,
           amount = volume x price, date = last ship date of those lines.
payment  = every invoice whose id % 11 != 0, 60 % paid when id % 5 = 0,
           dated 20 days after the invoice.

Spark plan: line items are aggregated once by ``l_orderkey`` (partial
aggregation map-side, then one shuffle); the three per-flag invoice sums are
conditional aggregates in that same pass and become rows with ``stack``.  The
join to orders reuses the aggregate's hash partitioning, so orders are the only
side shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default unit price per product (market segment); any fixed table works for
# the driver mapping.  Five entries -> an inline map literal, no join.
SEGMENT_PRICES = {
    "AUTOMOBILE": 165.50,
    "BUILDING": 155.20,
    "FURNITURE": 140.00,
    "HOUSEHOLD": 150.00,
    "MACHINERY": 160.00,
}
RETURN_FLAGS = {"A": 0, "N": 1, "R": 2}
CANCEL_MODULUS = 97
UNPAID_MODULUS = 11
PARTIAL_MODULUS = 5
PARTIAL_SHARE = 0.6
PAYMENT_DELAY_DAYS = 20

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def o2c_exports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four typed O2C tables built from the driver tables."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"
    )

    finished = F.col("l_linestatus") == "F"
    flag_aggs = []
    for flag in RETURN_FLAGS:
        hit = finished & (F.col("l_returnflag") == flag)
        flag_aggs += [
            F.sum(F.when(hit, F.col("l_quantity"))).alias(f"q_{flag}"),
            F.sum(F.when(hit, F.col("l_extendedprice"))).alias(f"x_{flag}"),
            F.max(F.when(hit, F.col("l_shipdate"))).alias(f"d_{flag}"),
        ]
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.min("l_discount").alias("min_disc"),
        F.min("l_shipdate").alias("first_ship"),
        F.sum("l_quantity").alias("qty_all"),
        *flag_aggs,
    )

    loading_events = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("loading_id"),
        F.col("o_orderpriority").alias("depot"),
        F.col("c_mktsegment").alias("product"),
        F.col("c_name").alias("customer"),
        (F.col("o_totalprice") / 100).alias("volume_loaded_litres"),
        F.col("o_orderdate").alias("loading_ts"),
    )

    shipped = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
    dispatched_vol = F.col("o_totalprice") / 100 * (1 - F.col("min_disc"))
    dispatch_events = shipped.select(
        F.col("o_orderkey").alias("dispatch_id"),
        F.col("o_orderkey").alias("loading_id"),
        dispatched_vol.alias("volume_dispatched_litres"),
        F.col("first_ship").alias("dispatch_ts"),
        F.when(F.col("o_orderkey") % CANCEL_MODULUS == 0, "Cancelled").otherwise("Dispatched").alias("status"),
    )

    stack_args = ", ".join(f"{code}, q_{flag}, x_{flag}, d_{flag}" for flag, code in RETURN_FLAGS.items())
    invoices = (
        shipped.select("o_orderkey", dispatched_vol.alias("vol"), "qty_all", *[
            c for flag in RETURN_FLAGS for c in (f"q_{flag}", f"x_{flag}", f"d_{flag}")
        ])
        .selectExpr("o_orderkey", "vol", "qty_all", f"stack({len(RETURN_FLAGS)}, {stack_args}) AS (code, q, x, d)")
        .filter(F.col("q").isNotNull())
        .select(
            (F.col("o_orderkey") * 10 + F.col("code")).alias("invoice_id"),
            F.col("o_orderkey").alias("dispatch_id"),
            # Rounded to 4 decimals so per-dispatch sums are exact decimals.
            F.round(F.col("vol") * F.col("q") / F.col("qty_all"), 4).alias("volume_invoiced_litres"),
            (F.col("x") / F.col("q")).alias("unit_price_kes"),
            F.col("d").alias("invoice_date"),
        )
        .withColumn("amount_kes", F.col("volume_invoiced_litres") * F.col("unit_price_kes"))
    )
    payments = invoices.filter(F.col("invoice_id") % UNPAID_MODULUS != 0).select(
        F.col("invoice_id").alias("payment_id"),
        F.col("invoice_id"),
        F.when(F.col("invoice_id") % PARTIAL_MODULUS == 0, F.col("amount_kes") * PARTIAL_SHARE)
        .otherwise(F.col("amount_kes"))
        .alias("amount_paid_kes"),
        (F.col("invoice_date") + F.expr(f"INTERVAL {PAYMENT_DELAY_DAYS} DAYS")).alias("payment_date"),
    )
    return {
        "loading_events": loading_events,
        "dispatch_events": dispatch_events,
        "invoices": invoices,
        "payments": payments,
    }


def _sround(expr: str, digits: int) -> str:
    from opsanalytics.plans.sqlkit import sround

    return sround(expr, digits)


def sql_price(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in SEGMENT_PRICES.items())
    return f"(CASE {col} {whens} END)"


# The same mapping as DuckDB CTEs (for oracle_sql).  Each CTE name matches the
# Spark dict key so oracle queries read like the Spark code.
O2C_CTES = f"""
li_order AS (
  SELECT l_orderkey, min(l_discount) AS min_disc, min(l_shipdate) AS first_ship, sum(l_quantity) AS qty_all
  FROM lineitem GROUP BY l_orderkey
),
li_flag AS (
  SELECT l_orderkey, l_returnflag, sum(l_quantity) AS q, sum(l_extendedprice) AS x, max(l_shipdate) AS d
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_returnflag
),
loading_events AS (
  SELECT o.o_orderkey AS loading_id, o.o_orderpriority AS depot, c.c_mktsegment AS product, c.c_name AS customer,
         o.o_totalprice / 100 AS volume_loaded_litres, o.o_orderdate AS loading_ts
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
dispatch_events AS (
  SELECT o.o_orderkey AS dispatch_id, o.o_orderkey AS loading_id,
         o.o_totalprice / 100 * (1 - p.min_disc) AS volume_dispatched_litres,
         p.first_ship AS dispatch_ts,
         CASE WHEN o.o_orderkey % {CANCEL_MODULUS} = 0 THEN 'Cancelled' ELSE 'Dispatched' END AS status
  FROM orders o JOIN li_order p ON o.o_orderkey = p.l_orderkey
),
invoices AS (
  SELECT f.l_orderkey * 10 + CASE f.l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS invoice_id,
         f.l_orderkey AS dispatch_id,
         {_sround('d.volume_dispatched_litres * f.q / p.qty_all', 4)} AS volume_invoiced_litres,
         f.x / f.q AS unit_price_kes,
         f.d AS invoice_date,
         {_sround('d.volume_dispatched_litres * f.q / p.qty_all', 4)} * (f.x / f.q) AS amount_kes
  FROM li_flag f JOIN li_order p ON f.l_orderkey = p.l_orderkey
  JOIN dispatch_events d ON d.dispatch_id = f.l_orderkey
),
payments AS (
  SELECT invoice_id AS payment_id, invoice_id,
         CASE WHEN invoice_id % {PARTIAL_MODULUS} = 0 THEN amount_kes * {PARTIAL_SHARE} ELSE amount_kes END AS amount_paid_kes,
         invoice_date + INTERVAL {PAYMENT_DELAY_DAYS} DAY AS payment_date
  FROM invoices WHERE invoice_id % {UNPAID_MODULUS} <> 0
)"""


# ---------------------------------------------------------------------------
# Raw (all-string) exports for the cleaning path.
# ---------------------------------------------------------------------------
# Order priorities play the depots; this alias table maps trimmed,
# lower-cased raw text to the canonical name.  '4-not specified' has no
# short alias on purpose, so some rows stay unmapped.
PRIORITY_ALIASES = {
    "1-urgent": "1-URGENT",
    "urgent": "1-URGENT",
    "2-high": "2-HIGH",
    "high": "2-HIGH",
    "3-medium": "3-MEDIUM",
    "medium": "3-MEDIUM",
    "4-not specified": "4-NOT SPECIFIED",
    "5-low": "5-LOW",
    "low": "5-LOW",
}
# Moduli that plant the mess (all keys are order keys, so every branch is hit).
MESS = {
    "unknown_depot": 250, "no_customer": 100, "negative_volume": 331, "zero_volume": 509, "bad_date": 211,
    "dup_loading": 53, "no_dispatch_volume": 401, "dup_dispatch": 61, "no_price": 13, "no_amount": 17,
    "thousands": 7, "dup_invoice": 59, "zero_paid": 97, "dup_payment": 67,
}


def fixed(c, digits: int):
    """Fixed-decimal text of a double (HALF_UP on the shortest decimal form)."""
    return F.format_string(f"%.{digits}f", F.round(c, digits))


def sfixed(expr: str, digits: int) -> str:
    from opsanalytics.plans.sqlkit import sround

    return f"printf('%.{digits}f', {sround(expr, digits)})"


def _lp(prefix: str, key, width: int):
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def _two_patterns(ts, key, modulus: int):
    slash = F.date_format(ts, "dd/MM/yyyy HH:mm")
    dash = F.date_format(ts, "yyyy-MM-dd HH:mm")
    return F.when(key % MESS["bad_date"] == 0, F.lit("not a date")).when(key % modulus == 0, slash).otherwise(dash)


def _with_dups(df, key, modulus: int, changed: dict):
    """Rows, and a changed copy after those that the modulus hits; one pass, so that ``df`` is derived once."""
    copies = F.when(key % modulus == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = df.withColumn("_copy", F.explode(copies))
    new = {c: F.when(F.col("_copy") == 1, v).otherwise(F.col(c)) for c, v in changed.items()}
    return both.withColumns(new | {"_row": key * 2 + F.col("_copy")}).drop("_copy")


def o2c_raw_exports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """String exports with the reference's mess planted by key modulus."""
    t = o2c_exports(spark, sf_dir)
    L, D, I, P = t["loading_events"], t["dispatch_events"], t["invoices"], t["payments"]
    lid = F.col("loading_id")
    name = F.substring_index(F.col("depot"), "-", -1)
    depot = (
        F.when(lid % MESS["unknown_depot"] == 0, F.lit("unknown place"))
        .when(lid % 4 == 0, F.upper("depot"))
        .when(lid % 4 == 1, F.concat(F.lit("  "), F.lower("depot"), F.lit(" ")))
        .when(lid % 4 == 2, F.lower(name))
        .otherwise(F.col("depot"))
    )
    vol = fixed(F.col("volume_loaded_litres"), 4)
    vol = (F.when(lid % MESS["negative_volume"] == 0, F.concat(F.lit("-"), vol))
           .when(lid % MESS["zero_volume"] == 0, F.lit("0")).otherwise(vol))
    loadings = L.select(
        lid,
        _lp("LD", lid, 8).alias("loading_id_text"),
        depot.alias("depot"),
        F.col("product"),
        F.when(lid % MESS["no_customer"] == 7, F.lit(None)).otherwise(F.col("customer")).alias("customer"),
        vol.alias("volume_loaded_litres"),
        F.lit("0.0").alias("meter_start"),
        fixed(F.col("volume_loaded_litres"), 4).alias("meter_end"),
        _two_patterns(F.col("loading_ts"), lid, 2).alias("loading_ts"),
    )
    loadings = _with_dups(loadings, lid, MESS["dup_loading"], {"volume_loaded_litres": F.lit("1.0")})
    loadings = loadings.drop("loading_id").withColumnRenamed("loading_id_text", "loading_id")

    did = F.col("dispatch_id")
    dispatches = D.select(
        did,
        _lp("DS", did, 8).alias("dispatch_id_text"),
        _lp("LD", F.col("loading_id"), 8).alias("loading_id"),
        F.when(did % MESS["no_dispatch_volume"] == 0, F.lit(None))
        .otherwise(fixed(F.col("volume_dispatched_litres"), 6)).alias("volume_dispatched_litres"),
        _two_patterns(F.col("dispatch_ts"), did, 3).alias("dispatch_ts"),
        F.col("status"),
    )
    dispatches = _with_dups(dispatches, did, MESS["dup_dispatch"], {"status": F.lit("Dispatched")})
    dispatches = dispatches.drop("dispatch_id").withColumnRenamed("dispatch_id_text", "dispatch_id")

    iid = F.col("invoice_id")
    amount = F.when(iid % MESS["no_amount"] == 0, F.lit(None)).when(
        iid % MESS["thousands"] == 0, F.format_number(F.round("amount_kes", 2), 2)
    ).otherwise(fixed(F.col("amount_kes"), 2))
    inv = I.join(L.select(F.col("loading_id").alias("dispatch_id"), "product"), "dispatch_id")
    invoices = inv.select(
        iid,
        _lp("INV", iid, 10).alias("invoice_id_text"),
        _lp("DS", F.col("dispatch_id"), 8).alias("dispatch_id"),
        F.col("product"),
        fixed(F.col("volume_invoiced_litres"), 6).alias("volume_invoiced_litres"),
        F.when(iid % MESS["no_price"] == 0, F.lit(None)).otherwise(fixed(F.col("unit_price_kes"), 4)).alias("unit_price_kes"),
        amount.alias("amount_kes"),
        _two_patterns(F.col("invoice_date"), iid, 2).alias("invoice_date"),
    )
    invoices = _with_dups(invoices, iid, MESS["dup_invoice"], {"amount_kes": F.lit("1.00")})
    invoices = invoices.drop("invoice_id").withColumnRenamed("invoice_id_text", "invoice_id")

    pid = F.col("payment_id")
    payments = P.select(
        pid,
        _lp("PMT", pid, 10).alias("payment_id_text"),
        _lp("INV", F.col("invoice_id"), 10).alias("invoice_id"),
        F.when(pid % MESS["zero_paid"] == 0, F.lit("0")).otherwise(fixed(F.col("amount_paid_kes"), 2)).alias("amount_paid_kes"),
        _two_patterns(F.col("payment_date"), pid, 2).alias("payment_date"),
    )
    payments = _with_dups(payments, pid, MESS["dup_payment"], {"amount_paid_kes": F.lit("1.00")})
    payments = payments.drop("payment_id").withColumnRenamed("payment_id_text", "payment_id")
    return {"loading_events": loadings, "dispatch_events": dispatches, "invoices": invoices, "payments": payments}


def _sql_lp(prefix: str, key: str, width: int) -> str:
    return f"('{prefix}' || lpad(CAST({key} AS VARCHAR), {width}, '0'))"


def _sql_two_patterns(ts: str, key: str, modulus: int) -> str:
    return (f"CASE WHEN {key} % {MESS['bad_date']} = 0 THEN 'not a date' "
            f"WHEN {key} % {modulus} = 0 THEN strftime({ts}, '%d/%m/%Y %H:%M') "
            f"ELSE strftime({ts}, '%Y-%m-%d %H:%M') END")


RAW_CTES = O2C_CTES + f""",
raw_l0 AS (
  SELECT loading_id AS k, {_sql_lp('LD', 'loading_id', 8)} AS loading_id,
    CASE WHEN loading_id % {MESS['unknown_depot']} = 0 THEN 'unknown place'
         WHEN loading_id % 4 = 0 THEN upper(depot)
         WHEN loading_id % 4 = 1 THEN '  ' || lower(depot) || ' '
         WHEN loading_id % 4 = 2 THEN lower(split_part(depot, '-', -1))
         ELSE depot END AS depot,
    product,
    CASE WHEN loading_id % {MESS['no_customer']} = 7 THEN NULL ELSE customer END AS customer,
    CASE WHEN loading_id % {MESS['negative_volume']} = 0 THEN '-' || {sfixed('volume_loaded_litres', 4)}
         WHEN loading_id % {MESS['zero_volume']} = 0 THEN '0'
         ELSE {sfixed('volume_loaded_litres', 4)} END AS volume_loaded_litres,
    '0.0' AS meter_start, {sfixed('volume_loaded_litres', 4)} AS meter_end,
    {_sql_two_patterns('loading_ts', 'loading_id', 2)} AS loading_ts
  FROM loading_events
),
raw_loading_events AS (
  SELECT * EXCLUDE (k), k * 2 AS _row FROM raw_l0
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ('1.0' AS volume_loaded_litres), k * 2 + 1 AS _row FROM raw_l0
  WHERE k % {MESS['dup_loading']} = 0
),
raw_d0 AS (
  SELECT dispatch_id AS k, {_sql_lp('DS', 'dispatch_id', 8)} AS dispatch_id, {_sql_lp('LD', 'loading_id', 8)} AS loading_id,
    CASE WHEN dispatch_id % {MESS['no_dispatch_volume']} = 0 THEN NULL
         ELSE {sfixed('volume_dispatched_litres', 6)} END AS volume_dispatched_litres,
    {_sql_two_patterns('dispatch_ts', 'dispatch_id', 3)} AS dispatch_ts, status
  FROM dispatch_events
),
raw_dispatch_events AS (
  SELECT * EXCLUDE (k), k * 2 AS _row FROM raw_d0
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ('Dispatched' AS status), k * 2 + 1 AS _row FROM raw_d0 WHERE k % {MESS['dup_dispatch']} = 0
),
raw_i0 AS (
  SELECT i.invoice_id AS k, {_sql_lp('INV', 'i.invoice_id', 10)} AS invoice_id, {_sql_lp('DS', 'i.dispatch_id', 8)} AS dispatch_id,
    l.product, {sfixed('i.volume_invoiced_litres', 6)} AS volume_invoiced_litres,
    CASE WHEN i.invoice_id % {MESS['no_price']} = 0 THEN NULL ELSE {sfixed('i.unit_price_kes', 4)} END AS unit_price_kes,
    CASE WHEN i.invoice_id % {MESS['no_amount']} = 0 THEN NULL
         WHEN i.invoice_id % {MESS['thousands']} = 0 THEN format('{{:,.2f}}', {__import__('opsanalytics.plans.sqlkit', fromlist=['sround']).sround('i.amount_kes', 2)})
         ELSE {sfixed('i.amount_kes', 2)} END AS amount_kes,
    {_sql_two_patterns('i.invoice_date', 'i.invoice_id', 2)} AS invoice_date
  FROM invoices i JOIN loading_events l ON i.dispatch_id = l.loading_id
),
raw_invoices AS (
  SELECT * EXCLUDE (k), k * 2 AS _row FROM raw_i0
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ('1.00' AS amount_kes), k * 2 + 1 AS _row FROM raw_i0 WHERE k % {MESS['dup_invoice']} = 0
),
raw_p0 AS (
  SELECT payment_id AS k, {_sql_lp('PMT', 'payment_id', 10)} AS payment_id, {_sql_lp('INV', 'invoice_id', 10)} AS invoice_id,
    CASE WHEN payment_id % {MESS['zero_paid']} = 0 THEN '0' ELSE {sfixed('amount_paid_kes', 2)} END AS amount_paid_kes,
    {_sql_two_patterns('payment_date', 'payment_id', 2)} AS payment_date
  FROM payments
),
raw_payments AS (
  SELECT * EXCLUDE (k), k * 2 AS _row FROM raw_p0
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ('1.00' AS amount_paid_kes), k * 2 + 1 AS _row FROM raw_p0 WHERE k % {MESS['dup_payment']} = 0
)"""
