"""Small helpers for writing the DuckDB oracle text so it mirrors :func:`registry.finish`."""

from __future__ import annotations

import re


def sround(expr: str, digits: int) -> str:
    """Spark's double rounding in DuckDB: HALF_UP on the shortest decimal text of the value.

    Spark rounds ``BigDecimal(Double.toString(x))``; DuckDB's ``round`` scales
    in binary, which disagrees exactly at .5 boundaries.  Going through the text
    form makes both engines agree.
    """
    return f"CAST(round(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 16)), {digits}) AS DOUBLE)"


def sql_finish(
    inner: str,
    doubles: list[str] | tuple[str, ...] = (),
    digits: int = 4,
    overrides: dict[str, int] | None = None,
    times: list[str] | tuple[str, ...] = (),
    dates: list[str] | tuple[str, ...] = (),
    bigints: list[str] | tuple[str, ...] = (),
    ctes: str | None = None,
) -> str:
    """``SELECT * REPLACE(...)`` over ``inner``: round doubles, render times, widen integers."""
    overrides = overrides or {}
    repl = [f"{sround(c, overrides.get(c, digits))} AS {c}" for c in doubles]
    repl += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times]
    repl += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    repl += [f"CAST({c} AS BIGINT) AS {c}" for c in bigints]
    inner = exact_sums(inner)
    head = f"WITH {exact_sums(ctes)}\n" if ctes else ""
    if not repl:
        return f"{head}SELECT * FROM (\n{inner}\n) q"
    return f"{head}SELECT * REPLACE ({', '.join(repl)}) FROM (\n{inner}\n) q"


# Columns the library totals with an exact DECIMAL(38, 6) sum (``nulls.exact_sum``).
EXACT_SUM_COLUMNS = {
    "expected_revenue_kes", "collected_revenue_kes", "total_leakage_kes", "dispatch_capture_gap_kes", "shrinkage_kes",
    "billing_gap_kes", "underbilling_kes", "collections_gap_kes", "amount_paid_kes", "amount_kes", "volume_invoiced_litres",
}
_SUM_RE = re.compile(r"(?<![\w.])sum\((\w+)\)")


def xsum(col: str) -> str:
    """DuckDB twin of ``exact_sum``: each value to 6 decimals (HALF_UP on its text form), summed as a decimal."""
    return f"CAST(sum(round(CAST(CAST(CAST({col} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 16)), 6)) AS DOUBLE)"


def exact_sums(sql: str) -> str:
    """Rewrite ``sum(<money column>)`` to :func:`xsum` (other sums untouched)."""
    return _SUM_RE.sub(lambda m: xsum(m.group(1)) if m.group(1) in EXACT_SUM_COLUMNS else m.group(0), sql)
