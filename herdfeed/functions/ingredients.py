"""Ingredient codes (C13) as one native column expression."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .groups import map_literal
from .text import clean_text, col_of

# Fixed values that must equal the reference's behaviour: ordered phrase rules
# (phrase -> code); the first phrase found in the upper-cased text, or whose compact
# form is found in the compact text, wins.
DEFAULT_INGREDIENT_CODE_RULES: tuple[tuple[str, str], ...] = (
    ("CORN SILAGE", "CSL"),
    ("HAYLAGE", "HLG"),
    ("TRITICALE", "TCL"),
    ("SOYBEAN MEAL", "SBM"),
    ("SOY MEAL", "SBM"),
    ("SOY HULL", "SOY"),
    ("SOYHULL", "SOY"),
    ("MOLASSES", "MOL"),
    ("SUPER MIX", "SMX"),
    ("SUPERMIX", "SMX"),
    ("PROTEIN MIX", "PRO"),
    ("DRY COW SUPPLEMENT", "LAC"),
    ("DRYCOW SUPPLEMENT", "LAC"),
    ("DRY COW MIX", "DCW"),
    ("DRYCOW MIX", "DCW"),
)

# Code aliases, looked up on the compact text and then on its first three
# characters (before the phrase rules).
DEFAULT_CODE_ALIASES: dict[str, str] = {
    "CSL": "CSL",
    "HLG": "HLG",
    "TCL": "TCL",
    "TRI": "TCL",
    "SBM": "SBM",
    "SOY": "SOY",
    "MOL": "MOL",
    "SMX": "SMX",
    "SUP": "SMX",
    "PRO": "PRO",
    "LAC": "LAC",
    "DCW": "DCW",
}

MAP_CODE_MAX_LEN = 10


def name_key(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Cleaned, upper-cased, whitespace-collapsed ingredient text (NULL when missing)."""
    text = clean_text(c, dtype)
    return F.regexp_replace(F.upper(text), r"(?U)\s+", " ")


def compact_key(upper_text: Column) -> Column:
    return F.regexp_replace(upper_text, "[^A-Z0-9]", "")


def rule_code(upper_text: Column, compact: Column) -> Column:
    """Alias lookups, phrase rules, then the first three characters.

    A text that holds a phrase holds the phrase's compact form in its own, so the rules look at
    the compact text alone: one plain search each, compiled with the rest of the projection."""
    aliases = map_literal(DEFAULT_CODE_ALIASES, "string")
    first_three = F.substring(compact, 1, 3)
    phrases: dict[str, str] = {}
    for text, code in DEFAULT_INGREDIENT_CODE_RULES:
        phrases.setdefault(re.sub("[^A-Z0-9]", "", text), code)
    phrase = None
    for text, code in phrases.items():
        hit = F.contains(compact, F.lit(text))
        phrase = F.when(hit, code) if phrase is None else phrase.when(hit, code)
    return F.when(upper_text.isNotNull(), F.coalesce(
        F.try_element_at(aliases, compact),
        F.try_element_at(aliases, first_three),
        phrase,
        F.when(first_three != "", first_three),
    ))


def ingredient_code(c: Column | str, dtype: T.DataType | None = None,
                    mapping: Mapping[str, str] | None = None) -> Column:
    """C13 with an in-memory user mapping (raw name -> code). For a mapping held in a
    table use :func:`herdfeed.sources.mapping.apply_ingredient_map` instead."""
    upper = name_key(c, dtype)
    compact = compact_key(upper)
    rules = rule_code(upper, compact)
    if not mapping:
        return rules
    user = map_literal({normalise_map_key(k): str(v).upper()[:MAP_CODE_MAX_LEN]
                        for k, v in mapping.items()}, "string")
    return F.coalesce(F.try_element_at(user, upper), F.try_element_at(user, compact), rules)


def normalise_map_key(raw: str) -> str:
    """Mapping keys are matched the way lookups are built: upper case, single spaces."""
    return re.sub(r"\s+", " ", str(raw).strip().upper())
