"""p-values from the regularised incomplete beta function.

``betainc`` is the Lentz continued fraction (Numerical Recipes form),
vectorised over numpy arrays so the same code serves a driver-side one-row
result and an Arrow-batched ``pandas_udf`` over many groups.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

_EPS = 1e-15
_TINY = 1e-300
_MAX_ITER = 300


def _lgamma(x):
    return np.vectorize(math.lgamma, otypes=[float])(x)


def _betacf(a, b, x):
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < _TINY, _TINY, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, _MAX_ITER + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        delta = d * c
        h = h * delta
        if np.all(np.abs(delta - 1.0) < _EPS):
            break
    return h


def betainc(a, b, x):
    """Regularised incomplete beta I_x(a, b), elementwise; NaN where undefined."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        am, bm, xm = a[mid], b[mid], x[mid]
        lbt = _lgamma(am + bm) - _lgamma(am) - _lgamma(bm) + am * np.log(xm) + bm * np.log1p(-xm)
        bt = np.exp(lbt)
        front = xm < (am + 1.0) / (am + bm + 2.0)
        res = np.empty_like(xm)
        if front.any():
            res[front] = bt[front] * _betacf(am[front], bm[front], xm[front]) / am[front]
        back = ~front
        if back.any():
            res[back] = 1.0 - bt[back] * _betacf(bm[back], am[back], 1.0 - xm[back]) / bm[back]
        out[mid] = res
    return out


def t_two_sided_p(t, dof):
    """Two-sided p of Student's t: I_{dof/(dof+t^2)}(dof/2, 1/2)."""
    t, dof = np.asarray(t, dtype=float), np.asarray(dof, dtype=float)
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def f_upper_p(f, d1, d2):
    """Upper-tail p of the F distribution: I_{d2/(d2+d1 f)}(d2/2, d1/2)."""
    f, d1, d2 = (np.asarray(v, dtype=float) for v in (f, d1, d2))
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


@pandas_udf(DoubleType())
def _t_p_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided_p(t.to_numpy(dtype=float, na_value=np.nan), dof.to_numpy(dtype=float, na_value=np.nan)))


@pandas_udf(DoubleType())
def _f_p_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(f_upper_p(f.to_numpy(dtype=float, na_value=np.nan), d1.to_numpy(dtype=float, na_value=np.nan),
                               d2.to_numpy(dtype=float, na_value=np.nan)))


def t_pvalue(t: Column, dof: Column) -> Column:
    """Column form (Arrow batches; runs on aggregated rows, one per group)."""
    return _t_p_udf(t.cast("double"), dof.cast("double"))


def f_pvalue(f: Column, d1: Column, d2: Column) -> Column:
    return _f_p_udf(f.cast("double"), d1.cast("double"), d2.cast("double"))


def normal_ppf(p: float) -> float:
    """Standard normal quantile (service-level Z) from the standard library."""
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)


def lit_z(p: float) -> Column:
    return F.lit(normal_ppf(p))
