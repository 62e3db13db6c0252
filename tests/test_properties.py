"""Property tests: each batch of generated examples is checked in one Spark job."""

import re
from decimal import Decimal, InvalidOperation

import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from herdfeed.functions import clean_id, clean_numeric

NUM = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")


def py_clean_numeric(v):
    if v is None:
        return None
    for noise in (",", "%", "—", "--"):
        v = v.replace(noise, "")
    v = v.strip()
    return float(v) if NUM.fullmatch(v) else None


def py_clean_id(v):
    if v is None:
        return None
    s = v.strip()
    if NUM.fullmatch(s):
        try:
            d = Decimal(s)
            if d == d.to_integral_value() and abs(d) < Decimal(10) ** 27:
                s = str(int(d))
        except InvalidOperation:
            pass
    return None if s in ("", "nan", "None", "<NA>") else s


texts = st.one_of(
    st.none(),
    st.from_regex(r"\A[ ]?[+-]?[0-9]{0,6}(\.[0-9]{0,3})?([eE][+-]?[0-9])?[%,]?[ ]?\Z"),
    st.sampled_from(["", "nan", "None", "<NA>", "--", "—", "3--4", "1,234", "A7", "5d", "inf", "0221", "2201.0"]),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_clean_numeric_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(clean_numeric("v")).collect()]
    assert got == [py_clean_numeric(v) for v in values]


@settings(max_examples=25, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_clean_id_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(clean_id("v")).collect()]
    assert got == [py_clean_id(v) for v in values]


@pytest.mark.parametrize("values", [[1e-7] * 1000, [4e-7, 3e-7], [1e14, 2.5, -1e14], [float("inf"), 1.0]])
def test_sums_and_means_keep_small_large_and_infinite_values(spark, values):
    from herdfeed.operators import feed, herd

    rows = [("2024-05-01", "R1", f"ing{i}", x, x) for i, x in enumerate(values)]
    raw = spark.createDataFrame(rows, "date string, recipe string, ingredient string, `dry call weight` double, `dry actual weight` double")
    got = feed.error_by_weight(feed.clean_feed_intake(raw)).first()
    finite = [x for x in values if math.isfinite(x)]
    assert got.dry_call_weight_sum == pytest.approx(math.fsum(finite), rel=1e-9) or got.dry_call_weight_sum == math.inf
    daily = spark.createDataFrame([(str(i), "G1", 5.0, x, "2024-05-01") for i, x in enumerate(values)],
                                  "cow string, grp string, dim double, milk double, date string")
    mean = herd.agg_group_day(herd.standardize_daily(daily)).first().avg_daily_yield
    assert mean == pytest.approx(math.fsum(finite) / len(values), rel=1e-6, abs=1e-3 if max(finite) > 1e6 else 1e-15) or mean == math.inf


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["R1", "R2"]), st.floats(min_value=0.1, max_value=500).map(lambda x: round(x, 2))),
                min_size=1, max_size=30))
def test_participation_sums_to_100(spark, rows):
    from herdfeed.operators import feed

    raw = spark.createDataFrame([("2024-05-01", r, f"ing{i}", str(w), str(w)) for i, (r, w) in enumerate(rows)],
                                "date string, recipe string, ingredient string, `dry call weight` string, "
                                "`dry actual weight` string")
    ff = feed.prepare_feed_intake(raw)
    for r in ff.groupBy("recipe_display_name").agg(F.sum("pct_participation").alias("s")).collect():
        assert abs(r.s - 100.0) < 1e-9
