"""Column -> Column functions for parsing, normalising and labelling.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsanalytics.functions.nulls import col_, mask

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Tokens read as missing when a CSV export is loaded as strings.
NULL_TOKENS = ["", "NA", "N/A", "null", "NULL", "NaN", "nan", "n/a", "#N/A", "None", "<NA>", "-NaN", "-nan"]
# Efficiency tiers: below 70 Critical, below 90 Warning, else Normal.
EFFICIENCY_CUTS = [70.0, 90.0]
EFFICIENCY_LABELS = ["Critical", "Warning", "Normal"]
# Shifts by hour: 6-14 Morning, 14-22 Afternoon, else Night.
SHIFT_MORNING = (6, 14)
SHIFT_AFTERNOON = (14, 22)
# Correlation strength cut-offs on |r| and labels.
CORR_STRENGTH_CUTS = [0.1, 0.3, 0.5]
CORR_STRENGTH_LABELS = ["negligible", "weak", "moderate", "strong"]
# Rain binning.
RAIN_THRESHOLD_MM = 0.1
RAIN_LABELS = ("Rainy (> 0.1 mm)", "Dry (≤ 0.1 mm)")
# Pump health rule: Warning if vibration > 3.0 or temperature > 76 or errors >= 2;
# Critical if vibration > 4.1 or temperature > 85 or pressure < 98 or errors >= 4.
HEALTH_WARNING = {"vibration": 3.0, "temperature": 76.0, "errors": 2}
HEALTH_CRITICAL = {"vibration": 4.1, "temperature": 85.0, "pressure": 98.0, "errors": 4}
# Failure look-ahead: remaining life <= 28 steps (x 6 hours) or status Critical.
FAILURE_HORIZON_HOURS = 28 * 6


# ---------------------------------------------------------------------------
# Parsing (C1-C4, C6, S1)
# ---------------------------------------------------------------------------
def null_tokens(c: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """A CSV cell equal to a null token becomes NULL."""
    c = col_(c)
    return F.when(~c.isin(list(tokens)), c)


def parse_mixed_datetime(c: str | Column) -> Column:
    """Route each row by separator: ``/`` -> day/month/year, else year-month-day.

    Both patterns carry hours and minutes; anything else (including a trailing
    seconds part) parses to NULL rather than failing the job.
    """
    c = F.trim(col_(c).cast("string"))
    slash = F.try_to_timestamp(c, F.lit("d/M/yyyy H:m"))
    dash = F.try_to_timestamp(c, F.lit("yyyy-M-d H:m"))
    return F.when(c.contains("/"), slash).otherwise(dash).cast("timestamp_ntz")


NUMERIC_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_numeric(c: str | Column) -> Column:
    """Coerce to double; anything that is not a plain number becomes NULL.

    ``try_cast`` alone accepts suffixed literals such as ``1d``; the regex guard
    keeps table-library coercion rules.
    """
    s = F.trim(col_(c).cast("string"))
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def parse_amount(c: str | Column) -> Column:
    """Strip thousands separators, trim, coerce to double."""
    return parse_numeric(F.regexp_replace(col_(c).cast("string"), ",", ""))


def map_lookup(c: str | Column, mapping: Mapping) -> Column:
    """J9 for a fixed, tiny mapping: an inline map literal (no join, no shuffle)."""
    if not mapping:
        return F.lit(None)
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, col_(c))


def normalize_alias(c: str | Column, aliases: Mapping[str, str]) -> Column:
    """C4: trim, lower-case and map through an alias table; unknown -> NULL."""
    return map_lookup(F.lower(F.trim(col_(c))), aliases)


def normalize_label(c: str | Column) -> Column:
    """Trim, upper-case, hyphen/underscore -> space."""
    return F.regexp_replace(F.upper(F.trim(col_(c))), "[-_]", " ")


def parse_utc_timestamp(c: str | Column) -> Column:
    """ISO text (with or without offset) -> timestamp; bad -> NULL."""
    return F.try_to_timestamp(F.trim(col_(c)))


def parse_dayfirst_date(c: str | Column) -> Column:
    """Day-first dates such as ``31/12/2026``."""
    return F.to_date(F.try_to_timestamp(F.trim(col_(c)), F.lit("d/M/yyyy")))


# ---------------------------------------------------------------------------
# Guards and fills
# ---------------------------------------------------------------------------
def range_guard(c: str | Column, low: float, high: float) -> Column:
    """A value outside [low, high] becomes NULL."""
    c = col_(c)
    return F.when(c.between(low, high), c)


def price_backfill(price: str | Column, amount: str | Column, volume: str | Column, default: Column) -> Column:
    """Missing price <- amount / volume (volume > 0), else the product default."""
    price, amount, volume = col_(price), col_(amount), col_(volume)
    derived = F.when(amount.isNotNull() & mask(volume > 0), amount / volume)
    return F.coalesce(price, derived, default)


def amount_backfill(amount: str | Column, volume: str | Column, price: str | Column) -> Column:
    """C14: missing amount <- volume x price."""
    return F.coalesce(col_(amount), col_(volume) * col_(price))


# ---------------------------------------------------------------------------
# KPIs and labels
# ---------------------------------------------------------------------------
def efficiency_pct(actual: str | Column, target: str | Column, on_zero: str = "null") -> Column:
    """C17: 100 * actual / target rounded to 2 dp; zero target -> NULL or a job error."""
    actual, target = col_(actual), col_(target)
    value = F.round(actual / target * 100, 2)
    if on_zero == "error":
        return F.when(target == 0, F.raise_error(F.lit("Target cannot be zero"))).otherwise(value)
    return F.when(target != 0, value)


def tier(c: str | Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """C18 generalised: label i for the first cut the value is below, else the last label.

    A missing value compares False everywhere and so lands in the last label,
    like an if-chain over a NaN.
    """
    c = col_(c)
    expr = None
    for cut, label in zip(cuts, labels):
        expr = F.when(c < cut, label) if expr is None else expr.when(c < cut, label)
    return expr.otherwise(labels[len(cuts)])


def efficiency_status(c: str | Column) -> Column:
    """Critical / Warning / Normal."""
    return tier(c, EFFICIENCY_CUTS, EFFICIENCY_LABELS)


def shift_of_hour(hour: str | Column) -> Column:
    """C20: Morning (6-14), Afternoon (14-22), Night otherwise."""
    h = col_(hour)
    return (
        F.when((h >= SHIFT_MORNING[0]) & (h < SHIFT_MORNING[1]), "Morning")
        .when((h >= SHIFT_AFTERNOON[0]) & (h < SHIFT_AFTERNOON[1]), "Afternoon")
        .otherwise("Night")
    )


def binary_bin(c: str | Column, threshold: float, above: str, other: str) -> Column:
    """``above`` when value > threshold; missing goes to ``other``."""
    return F.when(mask(col_(c) > threshold), above).otherwise(other)


def rain_bin(c: str | Column) -> Column:
    return binary_bin(c, RAIN_THRESHOLD_MM, *RAIN_LABELS)


def calendar_parts(ts: str | Column) -> dict[str, Column]:
    """Date, month period (yyyy-MM), month number, weekday name, day string, hour."""
    ts = col_(ts)
    return {
        "day": F.to_date(ts),
        "month_period": F.date_format(ts, "yyyy-MM"),
        "month": F.month(ts),
        "weekday_name": F.date_format(ts, "EEEE"),
        "day_str": F.date_format(ts, "yyyy-MM-dd"),
        "hour": F.hour(ts),
    }


def health_status(vibration, temperature, pressure, errors) -> Column:
    """Most severe rule wins (Critical checked first)."""
    v, t, p, e = col_(vibration), col_(temperature), col_(pressure), col_(errors)
    crit = (
        mask(v > HEALTH_CRITICAL["vibration"])
        | mask(t > HEALTH_CRITICAL["temperature"])
        | mask(p < HEALTH_CRITICAL["pressure"])
        | mask(e >= HEALTH_CRITICAL["errors"])
    )
    warn = (
        mask(v > HEALTH_WARNING["vibration"])
        | mask(t > HEALTH_WARNING["temperature"])
        | mask(e >= HEALTH_WARNING["errors"])
    )
    return F.when(crit, "Critical").when(warn, "Warning").otherwise("Healthy")


def failure_label(remaining_hours: str | Column, status: str | Column, horizon_hours: float = FAILURE_HORIZON_HOURS) -> Column:
    """1 when remaining life <= horizon or status is Critical."""
    return (mask(col_(remaining_hours) <= horizon_hours) | mask(col_(status) == "Critical")).cast("int")


def correlation_strength(r: str | Column) -> Column:
    """Negligible / weak / moderate / strong on |r|."""
    return tier(F.abs(col_(r)), CORR_STRENGTH_CUTS, CORR_STRENGTH_LABELS)


def correlation_label(r: str | Column, p: str | Column) -> Column:
    """C25: '<strength> <direction> correlation, <significance>' from r and its p-value."""
    r, p = col_(r), col_(p)
    direction = F.when(r < 0, "negative").otherwise("positive")
    sig = F.when(mask(p < 0.05), "statistically significant (p < 0.05)").otherwise(
        "not statistically significant (p ≥ 0.05)"
    )
    return F.concat(correlation_strength(r), F.lit(" "), direction, F.lit(" correlation, "), sig)


def currency_text(c: str | Column, prefix: str = "KES ", with_thousands: bool = False) -> Column:
    """B (2 dp) / M (1 dp) and, for the dashboard form, K (1 dp) and plain units."""
    v = col_(c)
    a = F.abs(v)

    def fmt(x: Column, dp: int) -> Column:
        return F.format_string(f"%.{dp}f", x)

    expr = F.when(a >= 1e9, F.concat(F.lit(prefix), fmt(v / 1e9, 2), F.lit("B")))
    if with_thousands:
        expr = (
            expr.when(a >= 1e6, F.concat(F.lit(prefix), fmt(v / 1e6, 1), F.lit("M")))
            .when(a >= 1e3, F.concat(F.lit(prefix), fmt(v / 1e3, 1), F.lit("K")))
            .otherwise(F.concat(F.lit(prefix), fmt(v, 0)))
        )
    else:
        expr = expr.otherwise(F.concat(F.lit(prefix), fmt(v / 1e6, 1), F.lit("M")))
    return expr
