"""Join helper: null-safe equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join where NULL keys match NULL keys (``<=>``); output carries the left
    key columns once. Spark plans ``<=>`` keys as ordinary hash/sort-merge join keys."""
    r = right.select([F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    joined = left.join(r, cond, how)
    return joined.drop(*[f"__r_{k}" for k in keys])
