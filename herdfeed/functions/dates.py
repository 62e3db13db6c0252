"""Dates from file names, messy text and spreadsheet serial numbers."""

from __future__ import annotations

import calendar

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col_of, is_numeric_type, parse_number_text, strip_ws, to_double

# Fixed values that must equal the reference's behaviour: file-name date patterns. The
# second is only tried when the first does not match at all.
FILENAME_DATE_COMPACT = r"(20\d{2}[01]\d[0-3]\d)"
FILENAME_DATE_SEPARATED = r"(20\d{2}[-_][01]?\d[-_][0-3]?\d)"

# Spreadsheet serial dates: day 0 is 1899-12-30; accepted range is inclusive.
EXCEL_EPOCH = "1899-12-30"
EXCEL_SERIAL_MIN, EXCEL_SERIAL_MAX = 20000, 80000

# Ordered (shape, format) pairs tried per value. A format is only applied to text of
# its shape: Spark's lenient parsers read '45000' as the year 45000. ``None`` means
# Spark's ISO reader (date, optional time, optional 'T').
DEFAULT_DATE_FORMATS: tuple[tuple[str, str | None], ...] = (
    (r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2})?$", None),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:m:s"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:m"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:m:s"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
)


def _try_ts(s: Column, fmt: str | None) -> Column:
    return F.try_to_timestamp(s) if fmt is None else F.try_to_timestamp(s, F.lit(fmt))


# A trailing UTC offset of ISO text: the wall-clock time written before it is kept (the
# date a pandas parse floors to), so results do not depend on the session time zone.
_ISO_OFFSET = r"(?<=\d)(Z|[+-]\d{2}:?\d{2})$"


def parse_timestamp_text(c: Column | str,
                         formats: Sequence[tuple[str, str | None]] = DEFAULT_DATE_FORMATS) -> Column:
    """Text -> timestamp (wall clock) by the first format whose shape matches and parses."""
    s = strip_ws(col_of(c).cast("string"))
    wall = F.regexp_replace(s, _ISO_OFFSET, "")
    return F.coalesce(*[F.when(s.rlike(shape), _try_ts(wall if fmt is None else s, fmt)) for shape, fmt in formats])


def excel_serial_date(x: Column) -> Column:
    """Serial day number -> date (fraction = time of day, floored away)."""
    return F.when(
        x.between(EXCEL_SERIAL_MIN, EXCEL_SERIAL_MAX),
        F.date_add(F.lit(EXCEL_EPOCH).cast("date"), F.floor(x).cast("int")),
    )


def clean_date(c: Column | str, dtype: T.DataType | None = None,
               formats: Sequence[tuple[str, str | None]] = DEFAULT_DATE_FORMATS) -> Column:
    """Parse a date; otherwise a number in [20000, 80000] is a spreadsheet serial;
    the result is floored to the day. Numeric and text serials both convert."""
    c = col_of(c)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    if is_numeric_type(dtype):
        return excel_serial_date(to_double(c, dtype))
    if dtype is not None and not isinstance(dtype, T.StringType):
        return F.lit(None).cast("date")
    return F.coalesce(F.to_date(parse_timestamp_text(c, formats)), excel_serial_date(parse_number_text(c)))


def clean_timestamp(c: Column | str, dtype: T.DataType | None = None,
                    formats: Sequence[tuple[str, str | None]] = DEFAULT_DATE_FORMATS) -> Column:
    """Timestamp without time zone (wall clock, like a pandas naive datetime)."""
    c = col_of(c)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    if dtype is not None and not isinstance(dtype, T.StringType):
        return F.lit(None).cast("timestamp_ntz")
    return parse_timestamp_text(c, formats).cast("timestamp_ntz")


def date_from_filename(name: Column | str) -> Column:
    """``YYYYMMDD`` anywhere in the name; only when that pattern does not match at
    all, ``YYYY-M-D`` / ``YYYY_M_D``. Invalid dates -> NULL."""
    name = col_of(name)
    compact = F.regexp_extract(name, FILENAME_DATE_COMPACT, 1)
    separated = F.regexp_replace(F.regexp_extract(name, FILENAME_DATE_SEPARATED, 1), "_", "-")
    return (
        F.when(compact != "", F.to_date(F.try_to_timestamp(compact, F.lit("yyyyMMdd"))))
        .when(separated != "", F.to_date(F.try_to_timestamp(separated, F.lit("yyyy-M-d"))))
    )


def _name_of_month(number: Column) -> Column:
    """English name of a month number 1-12; NULL otherwise. A lookup in a literal array: no
    date formatting per row."""
    return F.get(F.split(F.lit(",".join(calendar.month_name[1:])), ","), number - 1)


def month_name(day: Column | str) -> Column:
    """English month name of a date."""
    return _name_of_month(F.month(col_of(day)))


def calendar_parts(day: Column | str) -> dict[str, Column]:
    """Year, month number and month name of a date."""
    day = col_of(day)
    return {"year": F.year(day), "month_num": F.month(day), "month": month_name(day)}


def month_name_of(year: Column | str, month_num: Column | str) -> Column:
    """Month name from year and month integers; invalid -> NULL."""
    y, m = col_of(year), col_of(month_num)
    return F.when(y.between(1, 9999), _name_of_month(m))
