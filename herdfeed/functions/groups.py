"""Group labels and month numbers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col_of, strip_ws, whole_number

# Fixed values that must equal the reference's behaviour: group label -> group number
# (exact, case-sensitive match on the whole value).
DEFAULT_GROUP_MAPPING: dict[str, int] = {
    "pack": 15, "Pack": 15, "PACK": 15,
    "g1": 1, "G1": 1,
    "g2": 2, "G2": 2,
    "g3": 3, "G3": 3,
    "g4": 4, "G4": 4,
}

# English month names and abbreviations (lower case) -> month number.
MONTH_NAME_TO_NUM: dict[str, int] = {
    "january": 1, "jan": 1,
    "february": 2, "feb": 2,
    "march": 3, "mar": 3,
    "april": 4, "apr": 4,
    "may": 5,
    "june": 6, "jun": 6,
    "july": 7, "jul": 7,
    "august": 8, "aug": 8,
    "september": 9, "sep": 9, "sept": 9,
    "october": 10, "oct": 10,
    "november": 11, "nov": 11,
    "december": 12, "dec": 12,
}


def sql_literal(value: object) -> str:
    """A Python scalar as Spark SQL literal text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        text = repr(value)
        if "e" in text or "n" in text:  # exponent, inf or nan: spell through a cast
            return f"CAST('{text}' AS DOUBLE)"
        return text + "D"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal(mapping: Mapping[str, object], value_type: str) -> Column:
    """A small fixed dictionary as a ``MAP`` literal, built from one SQL expression (a
    single call into the JVM, however many entries)."""
    if not mapping:
        return F.expr(f"CAST(map() AS map<string,{value_type}>)")
    body = ", ".join(f"{sql_literal(str(k))}, {sql_literal(v)}" for k, v in mapping.items())
    return F.expr(f"CAST(map({body}) AS map<string,{value_type}>)")


def clean_group(c: Column | str, dtype: T.DataType | None = None,
                group_mapping: Mapping[str, int] | None = None) -> Column:
    """Label map (user entries override the defaults), else an integral number,
    else NULL."""
    mapping = dict(DEFAULT_GROUP_MAPPING)
    if group_mapping:
        mapping.update({str(k): v for k, v in group_mapping.items()})
    c = col_of(c)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        labelled = F.try_element_at(map_literal(mapping, "int"), c.cast("string"))
        return F.coalesce(labelled, c.try_cast("int"))
    labelled = F.try_element_at(map_literal(mapping, "int"), c.cast("string"))
    return F.coalesce(labelled, whole_number(c, dtype))


def month_number(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """C4: month number from a number or an English month name (any case)."""
    c = col_of(c)
    number = whole_number(c, dtype)
    named = F.try_element_at(map_literal(MONTH_NAME_TO_NUM, "int"), F.lower(strip_ws(c.cast("string"))))
    return F.coalesce(number, named)
