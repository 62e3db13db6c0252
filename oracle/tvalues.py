"""Student-t critical values for the oracle, computed independently of the engine:
Simpson integration of the t density plus bisection (numpy only)."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np

ORACLE_TABLE_MAX = 300


def _density(x: np.ndarray, df: int) -> np.ndarray:
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    return c * (1.0 + x * x / df) ** (-(df + 1) / 2)


def _cdf(t: float, df: int, n: int = 4000) -> float:
    x = np.linspace(0.0, t, n + 1)
    y = _density(x, df)
    h = t / n
    return 0.5 + h / 3.0 * (y[0] + y[-1] + 4.0 * y[1:-1:2].sum() + 2.0 * y[2:-1:2].sum())


@lru_cache(maxsize=8)
def oracle_t_table(confidence_level: float, max_df: int = ORACLE_TABLE_MAX) -> tuple[tuple[int, float], ...]:
    p = 1.0 - (1.0 - confidence_level) / 2.0
    out = []
    for df in range(1, max_df + 1):
        lo, hi = 0.0, 1.0
        while _cdf(hi, df) < p:
            hi *= 2.0
        for _ in range(60):
            mid = 0.5 * (lo + hi)
            if _cdf(mid, df) < p:
                lo = mid
            else:
                hi = mid
        out.append((df, 0.5 * (lo + hi)))
    return tuple(out)


def series_sql(n_expr: str, confidence_level: float) -> str:
    """Large-df t quantile (Abramowitz & Stegun 26.7.5) as a SQL expression."""
    z = NormalDist().inv_cdf(1.0 - (1.0 - confidence_level) / 2.0)
    g = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    v = f"CAST(({n_expr}) - 1 AS DOUBLE)"
    terms = " + ".join(f"{gi!r} / power({v}, {i + 1})" for i, gi in enumerate(g))
    return f"({z!r} + {terms})"


def t_table_cte(name: str, confidence_level: float) -> str:
    rows = ", ".join(f"({df}, {t!r})" for df, t in oracle_t_table(confidence_level))
    return f"{name} AS (SELECT * FROM (VALUES {rows}) AS v(df, t))"


def t_sql(n_expr: str, table: str, confidence_level: float) -> str:
    """t value for n observations: table lookup for n-1 <= 300, series beyond."""
    return (f"(CASE WHEN ({n_expr}) >= 2 THEN coalesce((SELECT {table}.t FROM {table} "
            f"WHERE {table}.df = ({n_expr}) - 1), {series_sql(n_expr, confidence_level)}) END)")
