"""Cleaning of the order-to-cash exports (C1-C16) with an auditable issue log.

Each cleaner takes the raw table (every column a string, plus an order column
that records file position) and returns ``(clean_df, issues_df)``.  Issue
counts follow the reference's sequence: parse -> count -> fill -> dedupe ->
count non-positive measures on the deduplicated rows -> drop them.

Scale notes
-----------
* Keep-first dedupe is ``groupBy(key).agg(min_by(struct(row), order))``: a
  partial (map-side) aggregate, so a hot key is combined before the shuffle
  instead of landing whole in one window task.
* Every count of one table comes from a single aggregate pass; the issue log is
  a handful of rows made by ``unpivot`` of that one-row aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsanalytics.functions.nulls import count_where, mask
from opsanalytics.functions.scalar import (
    amount_backfill,
    map_lookup,
    normalize_alias,
    parse_amount,
    parse_mixed_datetime,
    parse_numeric,
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Depot alias table: trimmed, lower-cased raw text -> canonical depot.
DEPOT_ALIASES = {
    "mombasa": "Mombasa",
    "msa": "Mombasa",
    "nairobi": "Nairobi",
    "nrb": "Nairobi",
    "nairobi depot": "Nairobi",
    "kisumu": "Kisumu",
    "ksm": "Kisumu",
    "eldoret": "Eldoret",
    "eld": "Eldoret",
    "nakuru": "Nakuru",
    "nku": "Nakuru",
    "kisii": "Kisii",
}
UNKNOWN_CUSTOMER = "UNKNOWN CUSTOMER"

ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("detail", T.StringType()),
    ]
)


Store = Callable[[str, DataFrame], DataFrame]


def duplicate_count(key: str | Column) -> Column:
    """Rows after the first of each key, missing keys equal to each other."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.count("*") - F.count_distinct(k) - F.max(k.isNull().cast("int"))).cast("bigint")


def keep_first(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key, the one with the smallest ``order_col``."""
    others = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*[F.col(c) for c in others]), F.col(order_col)).alias("_r")
    return df.groupBy(key).agg(best).select(key, "_r.*").select(*df.columns)


def issue_rows(table: str, agg_row: DataFrame, checks: Sequence[tuple[str, str]]) -> DataFrame:
    """One-row aggregate (columns named by check) -> issue rows with count > 0."""
    names = [c for c, _ in checks]
    sev = F.create_map(*[F.lit(x) for pair in checks for x in pair])
    long = agg_row.select(*[F.col(c).cast("bigint").alias(c) for c in names]).unpivot([], names, "check", "count")
    return long.filter(F.col("count") > 0).select(
        F.lit(table).alias("table"),
        "check",
        sev[F.col("check")].alias("severity"),
        "count",
        F.lit("").alias("detail"),
    )


def _raw_counts(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """One aggregate pass: every named count plus the row count ``_n``."""
    return df.agg(*[e.alias(n) for n, e in exprs.items()], F.count("*").alias("_n"))


def _with_dropped(before: DataFrame, dup_col: str, clean: DataFrame, name: str) -> DataFrame:
    """Rows dropped after dedupe = (rows - duplicates) - kept rows.

    Derived from the raw pass and a count of the returned table, so the dedupe
    is not computed a second time just to count what the filter removes.
    """
    kept = clean.agg(F.count("*")).scalar()
    return before.withColumn(name, F.col("_n") - F.col(dup_col) - kept)


def _kept(name: str, clean: DataFrame, order_col: str, store: Store | None) -> DataFrame:
    """The cleaned table, written once by ``store`` where given: what follows counts the stored rows."""
    return clean if store is None else store(name, clean.drop(order_col))


def clean_loading_events(
    raw: DataFrame, aliases: Mapping[str, str] = DEPOT_ALIASES, order_col: str = "_row", store: Store | None = None
) -> tuple[DataFrame, DataFrame]:
    df = raw.withColumns(
        {
            "depot": normalize_alias("depot", aliases),
            "volume_loaded_litres": parse_numeric("volume_loaded_litres"),
            "meter_start": parse_numeric("meter_start"),
            "meter_end": parse_numeric("meter_end"),
            "loading_ts": parse_mixed_datetime("loading_ts"),
        }
    )
    before = _raw_counts(
        df,
        {
            "unmapped_depot_alias": count_where(F.col("depot").isNull()),
            "unparseable_loading_ts": count_where(F.col("loading_ts").isNull()),
            "missing_customer": count_where(F.col("customer").isNull()),
            "duplicate_loading_id": duplicate_count("loading_id"),
        },
    )
    df = df.withColumns(
        {
            "customer": F.coalesce(F.col("customer"), F.lit(UNKNOWN_CUSTOMER)),
            "meter_delta_litres": F.col("meter_end") - F.col("meter_start"),
        }
    )
    df = keep_first(df, "loading_id", order_col)
    clean = df.filter(mask(F.col("volume_loaded_litres") > 0))
    clean = _kept("loading_events", clean, order_col, store)
    issues = issue_rows(
        "loading_events",
        _with_dropped(before, "duplicate_loading_id", clean, "non_positive_volume"),
        [("unmapped_depot_alias", "warning"), ("unparseable_loading_ts", "critical"),
         ("missing_customer", "warning"), ("duplicate_loading_id", "critical"), ("non_positive_volume", "critical")],
    )
    return clean, issues


def clean_dispatch_events(raw: DataFrame, order_col: str = "_row", store: Store | None = None) -> tuple[DataFrame, DataFrame]:
    df = raw.withColumns(
        {
            "volume_dispatched_litres": parse_numeric("volume_dispatched_litres"),
            "dispatch_ts": parse_mixed_datetime("dispatch_ts"),
        }
    )
    before = _raw_counts(
        df,
        {
            "unparseable_dispatch_ts": count_where(F.col("dispatch_ts").isNull()),
            "duplicate_dispatch_id": duplicate_count("dispatch_id"),
        },
    )
    df = keep_first(df, "dispatch_id", order_col)
    clean = df.filter(mask(F.col("volume_dispatched_litres") > 0))
    clean = _kept("dispatch_events", clean, order_col, store)
    issues = issue_rows(
        "dispatch_events",
        _with_dropped(before, "duplicate_dispatch_id", clean, "non_positive_volume"),
        [("unparseable_dispatch_ts", "critical"), ("duplicate_dispatch_id", "critical"), ("non_positive_volume", "critical")],
    )
    return clean, issues


def clean_invoices(
    raw: DataFrame, default_prices: Mapping[str, float], order_col: str = "_row", store: Store | None = None
) -> tuple[DataFrame, DataFrame]:
    df = raw.withColumns(
        {
            "volume_invoiced_litres": parse_numeric("volume_invoiced_litres"),
            "amount_kes": parse_amount("amount_kes"),
            "unit_price_kes": parse_amount("unit_price_kes"),
            "invoice_date": parse_mixed_datetime("invoice_date"),
        }
    )
    price, amount, vol = F.col("unit_price_kes"), F.col("amount_kes"), F.col("volume_invoiced_litres")
    before = _raw_counts(
        df,
        {
            "unparseable_invoice_date": count_where(F.col("invoice_date").isNull()),
            "missing_unit_price_backfilled": count_where(price.isNull()),
            "missing_amount_backfilled": count_where(amount.isNull()),
            "duplicate_invoice_id": duplicate_count("invoice_id"),
        },
    )
    # Amount / volume where derivable, else the product's default price.
    derived = F.when(amount.isNotNull() & mask(vol > 0), amount / vol)
    df = df.withColumn("unit_price_kes", F.coalesce(price, derived, map_lookup("product", default_prices)))
    # C14: missing amount <- volume x (filled) price.
    df = df.withColumn("amount_kes", amount_backfill("amount_kes", "volume_invoiced_litres", "unit_price_kes"))
    df = keep_first(df, "invoice_id", order_col)
    df = _kept("invoices", df, order_col, store)
    # Rows whose dispatch is billed by more than one invoice (all of them counted).
    per_dispatch = df.groupBy("dispatch_id").agg(F.count("*").alias("n"))
    after = per_dispatch.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("dispatch_with_multiple_invoices")
    )
    issues = issue_rows(
        "invoices",
        before,
        [("unparseable_invoice_date", "critical"), ("missing_unit_price_backfilled", "warning"),
         ("missing_amount_backfilled", "warning"), ("duplicate_invoice_id", "critical")],
    ).unionByName(issue_rows("invoices", after, [("dispatch_with_multiple_invoices", "exception")]))
    return df, issues


def clean_payments(raw: DataFrame, order_col: str = "_row", store: Store | None = None) -> tuple[DataFrame, DataFrame]:
    df = raw.withColumns(
        {
            "amount_paid_kes": parse_amount("amount_paid_kes"),
            "payment_date": parse_mixed_datetime("payment_date"),
        }
    )
    before = _raw_counts(
        df,
        {
            "unparseable_payment_date": count_where(F.col("payment_date").isNull()),
            "duplicate_payment_id": duplicate_count("payment_id"),
        },
    )
    df = keep_first(df, "payment_id", order_col)
    clean = df.filter(mask(F.col("amount_paid_kes") > 0))
    clean = _kept("payments", clean, order_col, store)
    issues = issue_rows(
        "payments",
        _with_dropped(before, "duplicate_payment_id", clean, "non_positive_amount"),
        [("unparseable_payment_date", "critical"), ("duplicate_payment_id", "critical"), ("non_positive_amount", "critical")],
    )
    return clean, issues


def clean_all(
    raw: Mapping[str, DataFrame],
    default_prices: Mapping[str, float],
    aliases: Mapping[str, str] = DEPOT_ALIASES,
    order_col: str = "_row",
    store: Store | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Q5 + U1: clean the four tables; the issue log is the union of their rows.

    ``store(name, table)`` writes a cleaned table and returns the stored one, so that the issue log
    counts its rows and cleaning runs once; the four run as concurrent jobs."""
    steps = [
        lambda: clean_loading_events(raw["loading_events"], aliases, order_col, store),
        lambda: clean_dispatch_events(raw["dispatch_events"], order_col, store),
        lambda: clean_invoices(raw["invoices"], default_prices, order_col, store),
        lambda: clean_payments(raw["payments"], order_col, store),
    ]
    with ThreadPoolExecutor(len(steps)) as pool:
        done = list(pool.map(lambda step: step(), steps))
    names = ("loading_events", "dispatch_events", "invoices", "payments")
    cleaned = {name: table.drop(order_col) for name, (table, _) in zip(names, done, strict=True)}
    return cleaned, reduce(DataFrame.unionByName, [issues for _, issues in done])
