"""Literal fixtures for the column functions (expected values written from the spec)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from herdfeed.functions import (
    clean_date, clean_group, clean_id, clean_numeric, clean_text, date_from_filename, ingredient_code,
    month_number, safe_percent, session_yield, t_quantile, t_value,
)
from herdfeed.functions.dates import month_name_of


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("o")).collect()]


def test_clean_id(spark):
    vals = ["2201.0", "0221", "1e3", " A7 ", "840003123456789", "", "nan", "None", "<NA>", None, "22.5",
            "-0", "+5", "2.201e3", "\t77\n"]
    exp = ["2201", "221", "1000", "A7", "840003123456789", None, None, None, None, None, "22.5",
           "0", "5", "2201", "77"]
    assert one_col(spark, vals, clean_id) == exp


def test_clean_id_typed(spark):
    df = spark.createDataFrame([(2201.0,), (22.5,), (float("nan"),), (None,)], "v double")
    got = [r[0] for r in df.select(clean_id("v", df.schema["v"].dataType)).collect()]
    assert got == ["2201", "22.5", None, None]
    df = spark.createDataFrame([(7,), (None,)], "v bigint")
    assert [r[0] for r in df.select(clean_id("v", df.schema["v"].dataType)).collect()] == ["7", None]


def test_clean_group(spark):
    vals = ["G1", "pack", "3", "PaCk", "x", "1.5", "g4", "PACK", " 2 ", "3.0", None]
    assert one_col(spark, vals, clean_group) == [1, 15, 3, None, None, None, 4, 15, 2, 3, None]


def test_clean_group_user_map_overrides(spark):
    vals = ["G1", "view", "pack"]
    got = one_col(spark, vals, lambda c: clean_group(c, None, {"G1": 7, "view": 1}))
    assert got == [7, 1, 15]


def test_date_from_filename(spark):
    vals = ["x20240105.parquet", "x_2024-1-5.csv", "x20241935_2024-01-05.parquet", "x.parquet",
            "afi_2024_03_07.parquet"]
    exp = [dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None, dt.date(2024, 3, 7)]
    assert one_col(spark, vals, date_from_filename) == exp


def test_month_number(spark):
    vals = ["Jan", "sept", "3", "x", " December ", "MAR", "12.0", "3.5"]
    assert one_col(spark, vals, month_number) == [1, 9, 3, None, 12, 3, 12, None]


def test_month_name_of(spark):
    df = spark.createDataFrame([(2024, 3), (2024, 13), (None, 1)], "y int, m int")
    assert [r[0] for r in df.select(month_name_of("y", "m")).collect()] == ["March", None, None]


def test_clean_text(spark):
    vals = ["  Corn ", "", "NaN", "n/a", "--", "—", "NULL", "na", None, "x"]
    assert one_col(spark, vals, clean_text) == ["Corn", None, None, None, None, None, None, None, None, "x"]


def test_clean_numeric(spark):
    vals = ["1,234.5", "12%", "—", "--", "3--4", " 7 ", "5d", "inf", "nan", "-2.5e1", None]
    assert one_col(spark, vals, clean_numeric) == [1234.5, 12.0, None, None, 34.0, 7.0, None, None, None, -25.0, None]


def test_clean_date(spark):
    vals = ["2024-01-02", "3/5/2024", "25/03/2024", "45000.75", "45000", "19999", "20240105",
            "2024-01-02 13:45:00", "garbage", None]
    exp = [dt.date(2024, 1, 2), dt.date(2024, 3, 5), dt.date(2024, 3, 25), dt.date(2023, 3, 15),
           dt.date(2023, 3, 15), None, dt.date(2024, 1, 5), dt.date(2024, 1, 2), None, None]
    assert one_col(spark, vals, clean_date) == exp


def test_clean_date_numeric_serial(spark):
    df = spark.createDataFrame([(45000.0,), (19999.0,), (80000.0,)], "v double")
    got = [r[0] for r in df.select(clean_date("v", df.schema["v"].dataType)).collect()]
    assert got == [dt.date(2023, 3, 15), None, dt.date(2119, 1, 11)]


def test_safe_percent(spark):
    df = spark.createDataFrame([(5.0, 4.0), (1.0, 0.0), (1.0, None), (1.0, float("inf")), (None, 2.0)],
                               "n double, d double")
    assert [r[0] for r in df.select(safe_percent("n", "d")).collect()] == [125.0, None, None, None, None]


def test_session_yield(spark):
    df = spark.createDataFrame([(None, None), (2.0, None), (1.5, 2.5)], "a double, b double")
    got = [r[0] for r in df.select(session_yield("a", "b", df.schema["a"].dataType, df.schema["b"].dataType)).collect()]
    assert got == [0.0, 2.0, 4.0]


def test_ingredient_code_rules(spark):
    vals = ["CORN SILAGE", "Haylage 2", "Triticale", "SOYBEAN MEAL", "48 Soybean Meal", "DRY COW MIX", "Salt",
            "--", "soy hulls", "Super  Mix B", "dry cow supplement"]
    exp = ["CSL", "HLG", "TCL", "SOY", "SBM", "DCW", "SAL", None, "SOY", "SMX", "LAC"]
    assert one_col(spark, vals, ingredient_code) == exp


def test_ingredient_code_user_map_overrides(spark):
    mapping = {"corn silage": "xyz", "Salt": "NACL-PREMIUM-GRADE"}
    got = one_col(spark, ["CORN  SILAGE", "Salt", "Haylage"], lambda c: ingredient_code(c, None, mapping))
    assert got == ["XYZ", "NACL-PREMI", "HLG"]


@pytest.mark.parametrize("n,expected", [(1, None), (2, 3.077683537), (3, 1.885618083), (6, 1.475884049),
                                        (11, 1.372183641), (31, 1.310415025)])
def test_t_value_80(spark, n, expected):
    got = spark.range(1).select(t_value(F.lit(n), 0.80)).first()[0]
    if expected is None:
        assert got is None
    else:
        assert abs(got - expected) < 1e-9


def test_t_value_large_df_series_continuity(spark):
    # table (df <= 300) and series (df > 300) agree across the switch point
    got = [r[0] for r in spark.createDataFrame([(300,), (301,), (302,), (5000,)], "n long")
           .select(t_value("n", 0.95)).collect()]
    assert abs(got[0] - t_quantile(0.975, 299)) < 1e-12
    assert abs(got[1] - t_quantile(0.975, 300)) < 1e-11
    assert abs(got[2] - t_quantile(0.975, 301)) < 1e-11
    assert abs(got[3] - t_quantile(0.975, 4999)) < 1e-11


def test_t_value_rejects_bad_level():
    with pytest.raises(ValueError):
        t_value(F.lit(3), 1.2)


def test_iso_offsets_keep_wall_clock(spark):
    from herdfeed.functions import clean_timestamp

    vals = ["2024-01-02T23:30:00+02:00", "2024-01-02T23:30:00Z", "2024-01-02 23:30:00-0500", "2024-01-02"]
    assert one_col(spark, vals, clean_date) == [dt.date(2024, 1, 2)] * 4
    assert one_col(spark, vals[:1], clean_timestamp) == [dt.datetime(2024, 1, 2, 23, 30)]


def test_user_map_keys_with_quotes_and_backslashes(spark):
    mapping = {"it's": 3, "a\\b": 4, "x'); DROP TABLE t; --": 5}
    vals = ["it's", "a\\b", "x'); DROP TABLE t; --", "ab"]
    assert one_col(spark, vals, lambda c: clean_group(c, None, mapping)) == [3, 4, 5, None]
    codes = one_col(spark, ["o'brien mix"], lambda c: ingredient_code(c, None, {"O'BRIEN MIX": "ob'1"}))
    assert codes == ["OB'1"]


def test_numbers_beyond_a_double_are_missing(spark):
    values = ["1e400", "-1e400", "1e308", "-2.5", "9" * 400, "", None, "1e-400"]
    assert one_col(spark, values, clean_numeric) == [None, None, 1e308, -2.5, None, None, None, 0.0]
