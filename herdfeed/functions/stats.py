"""Student-t intervals and safe percentages as column expressions.

Spark has no Student-t quantile. The degrees of freedom are ``n - 1`` (a positive
integer) and the confidence level is a scalar, so the driver computes the quantile for
``df = 1..TABLE_MAX`` once (pure Python: regularised incomplete beta + Newton), embeds
it as an array literal, and uses the Cornish-Fisher expansion in 1/df beyond the table
(error below 1e-12 at df = TABLE_MAX for the usual levels).
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .groups import sql_literal
from .text import col_of

TABLE_MAX = 300


def _beta_cf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return h


def _inc_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(ln_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_cf(a, b, x) / a
    return 1.0 - front * _beta_cf(b, a, 1.0 - x) / b


def t_cdf(t: float, df: float) -> float:
    """P(T <= t) for Student's t with ``df`` degrees of freedom."""
    tail = 0.5 * _inc_beta(df / 2.0, 0.5, df / (df + t * t))
    return 1.0 - tail if t >= 0 else tail


def _t_pdf(t: float, df: float) -> float:
    ln = (math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
          - (df + 1) / 2 * math.log1p(t * t / df))
    return math.exp(ln)


def _cornish_fisher_coefficients(p: float) -> tuple[float, float, float, float, float]:
    """z and the coefficients of 1/df .. 1/df^4 of the t quantile expansion."""
    z = NormalDist().inv_cdf(p)
    g1 = (z**3 + z) / 4
    g2 = (5 * z**5 + 16 * z**3 + 3 * z) / 96
    g3 = (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384
    g4 = (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160
    return z, g1, g2, g3, g4


def t_quantile(p: float, df: int) -> float:
    """Quantile of Student's t (p in (0.5, 1)), Newton steps safeguarded by bisection."""
    if not 0.5 < p < 1.0:
        raise ValueError("p must be in (0.5, 1)")
    z, g1, g2, g3, g4 = _cornish_fisher_coefficients(p)
    t = max(z + g1 / df + g2 / df**2 + g3 / df**3 + g4 / df**4, 1e-6)
    lo, hi = 0.0, max(2 * t, 1.0)
    while t_cdf(hi, df) < p:
        hi *= 2.0
    for _ in range(200):
        f = t_cdf(t, df) - p
        if f > 0:
            hi = t
        else:
            lo = t
        step = f / max(_t_pdf(t, df), 1e-300)
        nxt = t - step
        if not lo < nxt < hi:
            nxt = 0.5 * (lo + hi)
        if abs(nxt - t) <= 1e-15 * max(1.0, abs(t)):
            t = nxt
            break
        t = nxt
    return t


def _check_level(confidence_level: float) -> float:
    if not 0.0 < confidence_level < 1.0:
        raise ValueError("confidence level must be between 0 and 1, e.g. 0.80")
    return confidence_level


@lru_cache(maxsize=32)
def t_table(confidence_level: float, max_df: int = TABLE_MAX) -> tuple[float, ...]:
    """Two-sided critical values for df = 1..max_df."""
    p = 1.0 - (1.0 - _check_level(confidence_level)) / 2.0
    return tuple(t_quantile(p, df) for df in range(1, max_df + 1))


def t_value(n: Column | str, confidence_level: float = 0.80) -> Column:
    """C14: two-sided Student-t critical value for ``n`` observations; NULL when n < 2."""
    n = col_of(n)
    table = t_table(confidence_level)
    p = 1.0 - (1.0 - confidence_level) / 2.0
    z, g1, g2, g3, g4 = _cornish_fisher_coefficients(p)
    dof = (n - 1).cast("double")
    series = F.lit(z) + F.lit(g1) / dof + F.lit(g2) / dof**2 + F.lit(g3) / dof**3 + F.lit(g4) / dof**4
    lookup = F.element_at(F.expr("array(" + ", ".join(sql_literal(v) for v in table) + ")"), (n - 1).cast("int"))
    return F.when(n >= 2, F.when(n - 1 <= len(table), lookup).otherwise(series))


def standard_error(sd: Column | str, n: Column | str) -> Column:
    """``sd / sqrt(n)``."""
    return col_of(sd) / F.sqrt(col_of(n).cast("double"))


def add_t_interval(df: DataFrame, mean_col: str, se_col: str, n_col: str,
                   confidence_level: float = 0.80, prefix: str = "") -> DataFrame:
    """Add ``t_value``, ``ci_lower``, ``ci_upper`` (optionally prefixed)."""
    t_col, lo_col, hi_col = (f"{prefix}{name}" for name in ("t_value", "ci_lower", "ci_upper"))
    t = t_value(n_col, confidence_level)
    margin = t * F.col(se_col)
    return df.withColumns({
        t_col: t,
        lo_col: F.col(mean_col) - margin,
        hi_col: F.col(mean_col) + margin,
    })


def is_finite(c: Column | str) -> Column:
    c = col_of(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def safe_percent(numerator: Column | str, denominator: Column | str) -> Column:
    """C11: ``num / den * 100``; NULL when the denominator is 0, missing or infinite."""
    num, den = col_of(numerator), col_of(denominator)
    return F.when(is_finite(den) & (den != 0), num / den * 100.0)
