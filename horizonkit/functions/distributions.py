"""Student-t and chi-square tail probabilities without SciPy.

Both reduce to regularised incomplete beta / gamma functions evaluated with
the classic continued-fraction and series expansions (Numerical Recipes,
Press et al.). Used on tiny result tables (one row per method pair or lag)
through Arrow-batched pandas UDFs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_FPMIN = 1e-300


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _FPMIN else _FPMIN)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _FPMIN else _FPMIN)
        c = 1.0 + aa / c
        c = c if abs(c) > _FPMIN else _FPMIN
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _FPMIN else _FPMIN)
        c = 1.0 + aa / c
        c = c if abs(c) > _FPMIN else _FPMIN
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    bt = math.exp(lbt)
    if x < (a + 1.0) / (a + b + 2.0):
        return bt * _betacf(a, b, x) / a
    return 1.0 - bt * _betacf(b, a, 1.0 - x) / b


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def t_two_sided_p(t: float, dof: float) -> float:
    """P(|T| >= |t|) for Student-t with ``dof`` degrees of freedom."""
    if t is None or dof is None or not math.isfinite(t) or dof <= 0:
        return float("nan")
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(1000):
            ap += 1.0
            d *= x / ap
            s += d
            if abs(d) < abs(s) * _EPS:
                break
        return 1.0 - s * math.exp(-x + a * math.log(x) - gln)
    b = x + 1.0 - a
    c, d = 1.0 / _FPMIN, 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _FPMIN else _FPMIN)
        c = b + an / c
        c = c if abs(c) > _FPMIN else _FPMIN
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


def chi2_sf(q: float, dof: float) -> float:
    if q is None or dof is None or not math.isfinite(q) or dof <= 0:
        return float("nan")
    return gammainc_upper(dof / 2.0, q / 2.0)


def _vec(fn):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.array([fn(x, y) if pd.notna(x) and pd.notna(y) else np.nan for x, y in zip(a, b)], dtype="float64")
        return pd.Series(out)
    return run


t_pvalue_udf = F.pandas_udf(_vec(t_two_sided_p), T.DoubleType())
chi2_pvalue_udf = F.pandas_udf(_vec(chi2_sf), T.DoubleType())
