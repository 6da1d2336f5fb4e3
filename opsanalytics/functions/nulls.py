"""Null and ordering rules as small Column helpers.

The operators follow table-library semantics where Spark's three-valued logic
would give a different answer; each helper names the rule it implements.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask(cond: Column) -> Column:
    """A comparison with a missing value is False, never NULL."""
    return F.coalesce(cond, F.lit(False))


def mask_not_equal(c: str | Column, value) -> Column:
    """``missing != value`` is True."""
    return F.coalesce(col_(c) != F.lit(value), F.lit(True))


def clip_low(c: str | Column, low: float = 0.0) -> Column:
    """Lower clip that keeps a missing value missing (``greatest`` would not)."""
    c = col_(c)
    return F.when(c < low, F.lit(low)).otherwise(c)


def clip_range(c: str | Column, low: float, high: float) -> Column:
    """Clip to [low, high], missing stays missing."""
    c = col_(c)
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def floor_days(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end``, floored (-1 h -> -1, 2 h over midnight -> 0).

    ``timestampdiff(SECOND)`` works for both timestamp and timestamp_ntz columns.
    """
    secs = F.timestamp_diff("SECOND", col_(start), col_(end))
    return F.floor(secs / F.lit(86400)).cast("bigint")


# Money and volume totals are summed as DECIMAL(38, 6): exact, so the total does
# not depend on the order partial sums are merged in (reproducible on any
# cluster size and across retries); the hash aggregate still applies.
SUM_SCALE = 6


def exact_sum(c: str | Column) -> Column:
    """Order-independent sum of a double column (values taken to 6 decimals)."""
    return F.sum(col_(c).cast(f"decimal(38,{SUM_SCALE})")).cast("double")


def sum0(c: str | Column) -> Column:
    """Sum where an all-missing group gives 0, not NULL (exact, see ``exact_sum``)."""
    return F.coalesce(exact_sum(c), F.lit(0.0))


def row_sum(cols: Iterable[str | Column]) -> Column:
    """Row-wise sum that skips missing values."""
    total = None
    for c in cols:
        term = F.coalesce(col_(c), F.lit(0.0))
        total = term if total is None else total + term
    return total


def all_true(cond: Column) -> Column:
    """``all()`` where a missing value counts as False (``bool_and`` skips NULL)."""
    return F.bool_and(mask(cond))


def count_where(cond: Column) -> Column:
    """Rows where the condition holds (missing counts as not holding)."""
    return F.count_if(mask(cond)).cast("bigint")
