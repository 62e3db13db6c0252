"""User ingredient mapping (S9) and its application as two lookup joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.groups import map_literal
from ..functions.ingredients import MAP_CODE_MAX_LEN, compact_key, name_key, normalise_map_key, rule_code
from ..functions.text import clean_text
from .headers import find_column

MAP_RAW_CANDIDATES = ("raw", "raw ingredient", "ingredient", "ingredient name", "ingredient_name")
MAP_CODE_CANDIDATES = ("code", "ingredient code", "ingredient_code")


def ingredient_map(raw: DataFrame, ordinal_col: str | None = None) -> DataFrame:
    """Mapping table -> ``map_key`` (upper case, single spaces) and ``map_code``
    (upper case, at most 10 characters); the last row per key wins.

    "Last" needs an order: ``ordinal_col`` when given, else the scan order of a single
    unsplit file (``monotonically_increasing_id``)."""
    raw_col = find_column(raw.columns, MAP_RAW_CANDIDATES, description="ingredient mapping raw/name column")
    code_col = find_column(raw.columns, MAP_CODE_CANDIDATES, description="ingredient mapping code column")
    ordinal = F.col(ordinal_col) if ordinal_col else F.monotonically_increasing_id()
    rows = raw.select(
        name_key(raw_col, raw.schema[raw_col].dataType).alias("map_key"),
        F.substring(F.upper(clean_text(code_col, raw.schema[code_col].dataType)), 1, MAP_CODE_MAX_LEN)
        .alias("map_code"),
        ordinal.alias("__ord"),
    ).dropna(subset=["map_key", "map_code"])
    return (rows.groupBy("map_key")
            .agg(F.max_by("map_code", "__ord").alias("map_code")))


def apply_ingredient_map(df: DataFrame, source_col: str, out_col: str = "ingredient_code",
                         mapping: DataFrame | Mapping[str, str] | None = None,
                         drop_missing: bool = False) -> DataFrame:
    """C13 + J6: look up the upper-cased text, then the compact text, in the user
    mapping, then fall back to the built-in rules.

    The upper-cased and compact keys are projected once as columns (the optimizer does
    not collapse projections that would duplicate them), so the rule chain only reads
    attributes and stays inside whole-stage codegen. Spark broadcasts a mapping table whose
    measured size is under the session's threshold; otherwise two shuffle joins.

    ``drop_missing`` drops rows whose code would be NULL. It filters on the equivalent
    cheap test (a user-map hit or a non-empty compact key) *before* the rule chain is
    built: a filter on the finished code would be pushed below the projections with
    the whole rule chain inlined into it. The rows left all have a code, and the column says
    so (it is not nullable): joins on it then add no such filter by themselves."""
    keyed = df.withColumn("__upper", name_key(source_col, df.schema[source_col].dataType))
    keyed = keyed.withColumn("__compact", compact_key(F.col("__upper")))
    rules = rule_code(F.col("__upper"), F.col("__compact"))
    if drop_missing:
        rules = F.coalesce(rules, F.lit(""))
    has_key = F.col("__compact").isNotNull() & (F.col("__compact") != "")
    if mapping is None or (not isinstance(mapping, DataFrame) and not mapping):
        out = keyed.filter(has_key) if drop_missing else keyed
        out = out.withColumn(out_col, rules)
    elif isinstance(mapping, DataFrame):
        m = mapping.select("map_key", "map_code")
        m1 = m.select(F.col("map_key").alias("__k1"), F.col("map_code").alias("__c1"))
        m2 = m.select(F.col("map_key").alias("__k2"), F.col("map_code").alias("__c2"))
        out = (keyed.join(m1, keyed["__upper"] == m1["__k1"], "left")
               .join(m2, F.col("__compact") == m2["__k2"], "left"))
        if drop_missing:
            out = out.filter(has_key | F.col("__c1").isNotNull() | F.col("__c2").isNotNull())
        out = out.withColumn(out_col, F.coalesce(F.col("__c1"), F.col("__c2"), rules))
    else:
        user = map_literal({normalise_map_key(k): str(v).upper()[:MAP_CODE_MAX_LEN]
                            for k, v in mapping.items()}, "string")
        keyed = keyed.withColumns({"__c1": F.try_element_at(user, F.col("__upper")),
                                   "__c2": F.try_element_at(user, F.col("__compact"))})
        if drop_missing:
            keyed = keyed.filter(has_key | F.col("__c1").isNotNull() | F.col("__c2").isNotNull())
        out = keyed.withColumn(out_col, F.coalesce(F.col("__c1"), F.col("__c2"), rules))
    return out.drop("__upper", "__compact", "__k1", "__c1", "__k2", "__c2")
