"""Column -> Column functions built only from ``pyspark.sql.functions``."""

from .dates import (
    calendar_parts,
    clean_date,
    clean_timestamp,
    date_from_filename,
    month_name,
    month_name_of,
)
from .groups import DEFAULT_GROUP_MAPPING, MONTH_NAME_TO_NUM, clean_group, month_number
from .ingredients import ingredient_code, name_key
from .stats import add_t_interval, safe_percent, standard_error, t_quantile, t_table, t_value
from .text import clean_id, clean_numeric, clean_text, nan_to_null, strip_ws, to_double


def session_yield(s1, s2, s1_type=None, s2_type=None):
    """Daily yield from two milking sessions; a missing session counts as 0, so
    two missing sessions give 0, not NULL."""
    from pyspark.sql import functions as F

    return F.coalesce(to_double(s1, s1_type), F.lit(0.0)) + F.coalesce(to_double(s2, s2_type), F.lit(0.0))


__all__ = [
    "add_t_interval", "calendar_parts", "clean_date", "clean_group", "clean_id",
    "clean_numeric", "clean_text", "clean_timestamp", "date_from_filename",
    "DEFAULT_GROUP_MAPPING", "ingredient_code", "month_name", "month_name_of",
    "month_number", "MONTH_NAME_TO_NUM", "name_key", "nan_to_null", "safe_percent",
    "session_yield", "standard_error", "strip_ws", "t_quantile", "t_table", "t_value",
    "to_double",
]
