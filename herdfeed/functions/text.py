"""Text and number cleaning as native column expressions (no Python UDFs).

Every function takes a column (name or ``Column``) plus, optionally, the column's
Spark data type, because messy daily files deliver the same role sometimes as text
and sometimes as a number. With no type given the input is treated as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A plain decimal number with optional sign and exponent. Spark's string->double cast
# also accepts suffixes such as '5d' or '12f' and words such as 'Infinity'; pandas does
# not, so every text->number conversion is guarded by this shape first.
NUMERIC_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Fixed values that must equal the reference's behaviour:
# id values treated as missing after trimming (exact, case-sensitive)
ID_MISSING = ("", "nan", "None", "<NA>")
# text values treated as missing (case-insensitive, after trimming)
TEXT_MISSING = ("nan", "none", "null", "na", "n/a", "--", "—")
# substrings removed from numbers, applied one after the other in this order
NUMBER_NOISE = (",", "%", "—", "--")

_INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)


def col_of(c: Column | str) -> Column:
    """A column by exact name (quoted, so spaces and dots in headers are safe)."""
    if isinstance(c, str):
        return F.col("`" + c.replace("`", "``") + "`")
    return c


def is_numeric_type(dtype: T.DataType | None) -> bool:
    return isinstance(dtype, _INTEGRAL_TYPES + _FRACTIONAL_TYPES)


# Characters Python's ``str.strip()`` removes (``str.isspace``); Spark's one-argument
# ``trim`` removes only the space character.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
              "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c: Column | str) -> Column:
    """Strip leading/trailing whitespace of any kind (a single ``trim`` with the full
    whitespace set, cheap in generated code)."""
    return F.trim(col_of(c), F.lit(WHITESPACE))


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL. Spark keeps NaN distinct from NULL; pandas treats NaN as missing."""
    c = col_of(c)
    return F.when(~F.isnan(c), c)


def is_number_text(c: Column | str) -> Column:
    return col_of(c).rlike(NUMERIC_RE)


# The expressions below reference each regex / parse exactly once: the optimizer inlines
# cleaned columns into pushed-down filters, where common sub-expressions are not shared.
_NUMBER_CAPTURE = r"^(" + NUMERIC_RE[1:-1] + r")$"
# integer-valued text: optional sign, leading zeros, digits, optional ".000"
_INT_TEXT = r"^([+-]?\d+)(?:\.0*)?$"
# canonical integer text: "+5" -> "5", "0221" -> "221", "2201.0" -> "2201", "-0" -> "0"
_ID_INT = r"^(?:\+|(-)(?=0*[1-9])|-)?0*(\d+)(?:\.0*)?$"
# numbers written with an exponent (rare): decided by an exact decimal parse
_EXPONENT = r"^[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d+$"


def parse_number_text(c: Column | str) -> Column:
    """Guarded text -> double: NULL unless the trimmed text is a plain decimal number that a
    double can hold (one regex, one parse; ``1e400`` would be infinite)."""
    parsed = F.array(F.regexp_extract(strip_ws(c), _NUMBER_CAPTURE, 1).try_cast("double"))
    for endless in (float("inf"), float("-inf")):
        parsed = F.array_remove(parsed, F.lit(endless))
    return F.try_element_at(parsed, F.lit(1))


def to_double(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """``pd.to_numeric(errors='coerce')``: numbers pass, text is parsed, NaN -> NULL."""
    c = col_of(c)
    if is_numeric_type(dtype):
        return nan_to_null(c.cast("double"))
    if isinstance(dtype, T.BooleanType):
        return c.cast("double")
    if dtype is not None and not isinstance(dtype, T.StringType):
        return F.lit(None).cast("double")
    return parse_number_text(c)


def clean_numeric(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Remove ``,`` ``%`` ``—`` ``--`` anywhere (in that order), trim, parse or NULL."""
    c = col_of(c)
    if is_numeric_type(dtype):
        return nan_to_null(c.cast("double"))
    s = c.cast("string")
    for noise in NUMBER_NOISE:
        s = F.replace(s, F.lit(noise), F.lit(""))
    return parse_number_text(s)


def clean_text(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Trimmed text; empty or a missing-value word -> NULL."""
    c = col_of(c)
    if isinstance(dtype, _FRACTIONAL_TYPES):
        c = nan_to_null(c)
    s = strip_ws(c.cast("string"))
    return F.when((s != "") & ~F.lower(s).isin(*TEXT_MISSING), s)


def _exponent_whole(s: Column, as_text: bool) -> Column:
    """Exact decimal parse of exponent notation; integral values only."""
    dec = s.try_cast("decimal(38,10)")
    whole = dec.cast("decimal(38,0)")
    value = whole.cast("string") if as_text else whole.try_cast("int")
    return F.when(dec == F.floor(dec), value)


def clean_id(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Numeric-looking ids become integer text (2201.0 -> 2201, 0221 -> 221,
    1e3 -> 1000); other ids are trimmed; '', 'nan', 'None', '<NA>' -> NULL.
    Fractional ids keep their text (pandas would raise here)."""
    c = col_of(c)
    if isinstance(dtype, _INTEGRAL_TYPES):
        return c.cast("string")
    if isinstance(dtype, _FRACTIONAL_TYPES):
        d = nan_to_null(c.cast("double"))
        whole = F.when(d == F.floor(d), d.try_cast("decimal(38,0)").cast("string"))
        return F.coalesce(whole, d.cast("string"))
    s = strip_ws(c.cast("string"))
    out = (F.when(s.rlike(_EXPONENT), F.coalesce(_exponent_whole(s, True), s))
           .otherwise(F.regexp_replace(s, _ID_INT, "$1$2")))
    # a normalised number is never one of the missing-value words, so test the text
    return F.when(~s.isin(*ID_MISSING), out)


def id_present(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Cheap test equal to ``clean_id(c, dtype).isNotNull()``."""
    c = col_of(c)
    if isinstance(dtype, _INTEGRAL_TYPES):
        return c.isNotNull()
    if isinstance(dtype, _FRACTIONAL_TYPES):
        return c.isNotNull() & ~F.isnan(c.cast("double"))
    s = strip_ws(c.cast("string"))
    return s.isNotNull() & ~s.isin(*ID_MISSING)


def whole_number(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Integer value of a column, NULL when missing, non-numeric or fractional."""
    c = col_of(c)
    if isinstance(dtype, _INTEGRAL_TYPES):
        return c.try_cast("int")
    if is_numeric_type(dtype):
        d = nan_to_null(c.cast("double"))
        return F.when(d == F.floor(d), d.try_cast("int"))
    if dtype is not None and not isinstance(dtype, T.StringType):
        return F.lit(None).cast("int")
    s = strip_ws(c.cast("string"))
    plain = F.regexp_extract(s, _INT_TEXT, 1).try_cast("int")
    return F.coalesce(plain, F.when(s.rlike(_EXPONENT), _exponent_whole(s, False)))
