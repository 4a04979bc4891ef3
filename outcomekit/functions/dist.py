"""Student-t tail probabilities.

Spark SQL has no t / F distribution functions.  The tests here all reduce to
a two-sided Student-t tail (F(1, v) = t^2 for a binary label).  Up to
``NORMAL_FROM`` degrees of freedom it is the regularised incomplete beta
I_x(v/2, 1/2), x = v / (v + t^2), from its continued fraction; beyond, where the
log-gamma difference would cancel, the normal tail of the transformed t.  It
runs as an Arrow-batched pandas UDF on the per-feature statistics table (one
row per feature), never per data row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_lgamma = np.frompyfunc(math.lgamma, 1, 1)
_erfc = np.frompyfunc(math.erfc, 1, 1)
NORMAL_FROM = 1e6            # degrees of freedom


def _fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, depth: int) -> np.ndarray:
    """1 / (1 + d_1 / (1 + d_2 / (1 + ...))) cut after ``depth`` terms, from the
    inside out, with d_2m = m (b - m) x / ((a + 2m - 1)(a + 2m)) and
    d_2m+1 = -(a + m)(a + b + m) x / ((a + 2m)(a + 2m + 1))."""
    inner = np.ones_like(x)
    for k in range(depth, 0, -1):
        m = k // 2
        if k % 2:
            d = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            d = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        inner = 1.0 + d / inner
    return 1.0 / inner


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The fraction, cut deeper until twice the depth changes nothing."""
    depth = 32
    value = _fraction(a, b, x, depth)
    while True:
        depth *= 2
        deeper = _fraction(a, b, x, depth)
        if np.all(np.abs(deeper - value) <= 1e-14 * np.abs(deeper)):
            return deeper
        if depth >= 1 << 17:
            raise ArithmeticError("incomplete beta: continued fraction did not settle")
        value = deeper


def betainc_reg(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b) for arrays (NaN where undefined)."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        a, b, x = a[mid], b[mid], x[mid]
        front = np.exp((_lgamma(a + b) - _lgamma(a) - _lgamma(b)).astype(float) + a * np.log(x) + b * np.log1p(-x))
        # the fraction converges fast below the mean; above it, use I_x(a, b) = 1 - I_1-x(b, a)
        low = x < (a + 1.0) / (a + b + 2.0)
        p, q, y = np.where(low, a, b), np.where(low, b, a), np.where(low, x, 1.0 - x)
        part = front * _beta_fraction(p, q, y) / p
        out[mid] = np.where(low, part, 1.0 - part)
    return out


def student_t_sf(t, nu) -> np.ndarray:
    """Two-sided tail P(|T_nu| >= |t|)."""
    t, nu = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(t, nu))
    with np.errstate(invalid="ignore", divide="ignore"):
        wide = nu > NORMAL_FROM
        p = betainc_reg(nu / 2.0, np.full(t.shape, 0.5), np.where(wide, np.nan, nu / (nu + t * t)))
        # t sqrt(log(1 + t^2/v) v / t^2) (1 - 3/(4 v)) is normal up to terms of order 1 / v^2
        z = np.sqrt(nu * np.log1p(t * t / nu)) * (1.0 - 0.75 / nu)
    if wide.any():
        p = np.where(wide & np.isfinite(t), np.asarray(_erfc(np.where(np.isfinite(z), z, 0.0) / math.sqrt(2.0)), float), p)
    return np.where(np.isinf(t) & (nu > 0), 0.0, p)


@F.pandas_udf(T.DoubleType())
def _t_two_sided_p_udf(t: pd.Series, nu: pd.Series) -> pd.Series:
    p = student_t_sf(t.astype(float).to_numpy(), nu.astype(float).to_numpy())
    return pd.Series(p)


def t_two_sided_p(t: Column, nu: Column) -> Column:
    """p-value of a two-sided t test; NULL when t or the degrees of freedom are."""
    p = _t_two_sided_p_udf(t.cast("double"), nu.cast("double"))
    return F.when(t.isNull() | nu.isNull() | (nu <= 0), F.lit(None).cast("double")).otherwise(F.nanvl(p, F.lit(None)))
