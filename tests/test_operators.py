import datetime as dt

import pytest
from pyspark.sql import functions as F

from herdfeed.operators import feed, herd
from herdfeed.operators.joins import join_null_safe

D = dt.date


def afi_rows(spark, rows):
    raw = spark.createDataFrame(rows, "cow_id string, grp string, dim double, daily_yield double, date date")
    return herd.standardize_daily(raw)


def test_standardize_drops_missing_keys_and_filters_start(spark):
    afi = afi_rows(spark, [("1", "G1", 10.0, 20.0, D(2024, 5, 1)), ("", "G1", 10.0, 20.0, D(2024, 5, 1)),
                           ("2", "zz", 10.0, 20.0, D(2024, 5, 1)), ("3", "G2", 10.0, None, None),
                           ("4", "pack", 5.0, None, D(2024, 4, 30))])
    assert sorted(r.animal_id for r in afi.collect()) == ["1", "4"]
    late = herd.standardize_daily(spark.createDataFrame(
        [("1", "G1", 1.0, 2.0, D(2024, 5, 1)), ("4", "pack", 5.0, None, D(2024, 4, 30))],
        "cow_id string, grp string, dim double, daily_yield double, date date"), start_date="2024-05-01")
    assert [r.animal_id for r in late.collect()] == ["1"]
    r = afi.filter("animal_id = '4'").first()
    assert (r.group, r.year, r.month_num, r.month) == (15, 2024, 4, "April")


def test_one_animal_two_rows_sd_set_t_null(spark):
    # Sd over rows, n = distinct animals -> SE set, t and CI NULL
    afi = afi_rows(spark, [("1", "G1", 10.0, 20.0, D(2024, 5, 1)), ("1", "G1", 12.0, 22.0, D(2024, 5, 1))])
    r = herd.yield_group_day(afi).first()
    assert r["N Animals"] == 1 and abs(r["Yield STD"] - 2 ** 0.5) < 1e-12
    assert r["T Value"] is None and r["CI Lower"] is None and r["SE"] is not None


def test_yield_group_day_interval(spark):
    afi = afi_rows(spark, [("1", "G1", 10.0, 20.0, D(2024, 5, 1)), ("2", "G1", 12.0, 24.0, D(2024, 5, 1))])
    r = herd.yield_group_day(afi, 0.80).first()
    se = (8 ** 0.5) / (2 ** 0.5)
    assert abs(r["CI Lower"] - (22 - 3.077683537 * se)) < 1e-8
    assert abs((r["CI Upper"] + r["CI Lower"]) / 2 - r["Avg Daily Yield"]) < 1e-12


def test_mode_lowest_on_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 1), ("a", 3), ("b", None)], "k string, g int")
    got = {r.k: r.m for r in df.groupBy("k").agg(herd.mode_lowest("g").alias("m")).collect()}
    assert got == {"a": 1, "b": None}


def test_per_cow_collapses_duplicate_days(spark):
    afi = afi_rows(spark, [("1", "G1", 10.0, 20.0, D(2024, 5, 1)), ("1", "G2", 10.0, 30.0, D(2024, 5, 1)),
                           ("1", "G2", 12.0, 10.0, D(2024, 5, 2))])
    r = herd.per_cow_yield(afi).first()
    # day 1 groups {1, 2} -> mode 1 (lowest on a tie); day 2 -> 2; mode of {1, 2} -> 1
    assert r["N Days"] == 2 and r["Avg Daily Yield"] == 17.5 and r["Group"] == 1


def test_weights_month_only_uses_single_year(spark):
    afi = afi_rows(spark, [("1", "G1", 10.0, 20.0, D(2024, 5, 1))])
    raw = spark.createDataFrame([("1", "600", "May"), ("1", "700", "may"), ("2", "x", "May")],
                                "Cow string, BW string, Month string")
    w = herd.monthly_weights(raw, afi=afi).collect()
    assert [(r.animal_id, r.year, r.month_num, r.weight, r.month) for r in w] == [("1", 2024, 5, 650.0, "May")]


def test_merge_dim_weights(spark):
    afi = afi_rows(spark, [("1", "G1", 10.0, 20.0, D(2024, 5, 1)), ("1", "G1", 11.0, 21.0, D(2024, 5, 2)),
                           ("2", "G2", 11.0, 21.0, D(2024, 5, 2))])
    raw = spark.createDataFrame([("1", 600.0, D(2024, 5, 3), "4")], "cow_id string, weight double, date date, pen string")
    w = herd.monthly_weights(raw)
    daily, cmw = herd.merge_dim_weights(afi, w)
    assert daily.count() == 2  # J2: every daily row of the matched animal-month
    r = cmw.first()
    assert (r.animal_id, r.group, r.n_afi_days, r.weight, r.weight_group) == ("1", 1, 2, 600.0, 4)
    wg = herd.weight_group(cmw, assume_unique=True).first()
    assert wg["N Animals"] == 1 and wg["Weight STD"] is None


def feed_raw(spark, rows):
    return spark.createDataFrame(rows, "`Feeding Date` string, Recipe string, Ingredient string, Pen string, "
                                       "`Dry Call Weight` string, `Dry Actual Weight` string")


def test_participation_and_null_sums(spark):
    raw = feed_raw(spark, [
        ("2024-05-01", "R1", "Corn Silage", None, "60", "66"),
        ("2024-05-01", "R1", "Haylage", None, "40", "34"),
        ("2024-05-01", "R2", "Salt", "P1", None, "--"),        # both weights missing -> dropped
        ("2024-05-01", "R3", "Salt", "P1", "0", None),          # called 0, delivered missing
        ("n/a", "R1", "Salt", None, "1", "1"),                  # no date -> dropped
    ])
    ff = feed.prepare_feed_intake(raw, group_by_pen=True)
    rows = {(r.recipe_display_name, r.ingredient_code): r for r in ff.collect()}
    assert set(rows) == {("R1", "CSL"), ("R1", "HLG"), ("R3", "SAL")}
    csl = rows[("R1", "CSL")]
    assert csl.dry_actual_weight_sum == 100.0 and csl.pct_participation == 66.0 and csl.call_pct_participation == 60.0
    sal = rows[("R3", "SAL")]
    assert sal.dry_actual_weight_sum == 0.0 and sal.pct_participation is None  # A8: all-null sum = 0
    ebw = {r.recipe_display_name: r for r in feed.error_by_weight(ff, group_by_pen=True).collect()}
    assert ebw["R1"].error_by_weight_pct == 0.0 and ebw["R3"].error_by_weight_pct is None
    nut = spark.createDataFrame([("CSL", 8.0), ("SAL", None)], "code string, cp double")
    nt = feed.prepare_nutrient_table(nut)
    nd = feed.nutrient_delivery(ff, nt)
    ne = {r.recipe_display_name: r for r in feed.nutrient_error_by_formula(nd, group_by_pen=True).collect()}
    assert ne["R3"].call_protein is None  # A9: all-null sum stays NULL
    assert abs(ne["R1"].call_protein - 60 * 8 / 100) < 1e-12
    assert sorted(r.ingredient_code for r in feed.missing_nutrients(nd).collect()) == ["HLG", "SAL"]


def test_join_null_safe_matches_null_keys(spark):
    a = spark.createDataFrame([("x", None, 1), ("x", "p", 2)], "k string, pen string, v int")
    b = spark.createDataFrame([("x", None, 10), ("x", "p", 20)], "k string, pen string, w int")
    got = sorted((r.v, r.pen, r.w) for r in join_null_safe(a, b, ["k", "pen"]).collect())
    assert got == [(1, None, 10), (2, "p", 20)]


def test_two_table_and_fused_formula_error_agree(spark):
    raw = feed_raw(spark, [("2024-05-01", "R1", "Corn Silage", None, "60", "66"),
                           ("2024-05-01", "R1", "Corn Silage", "P2", "40", "44"),
                           ("2024-05-02", "R1", "Haylage", None, "40", "34")])
    ff = feed.prepare_feed_intake(raw, group_by_pen=True)
    nt = feed.prepare_nutrient_table(spark.createDataFrame([("CSL", 8.0, 40.0, 30.0)], "code string, cp double, ndf double, starch double"))
    nd = feed.nutrient_delivery(ff, nt)
    a = feed.nutrient_error_by_formula(nd, group_by_pen=True)
    b = feed.nutrient_error_by_formula(nd, feed.error_by_weight(ff, group_by_pen=True), group_by_pen=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == 3


def test_latest_per_key_nulls_and_ties(spark):
    df = spark.createDataFrame([
        ("A", D(2024, 1, 1), 1, 10.0), ("A", None, 2, 11.0), ("A", D(2024, 3, 1), 3, 12.0),
        ("B", D(2024, 1, 1), 1, 20.0), ("B", D(2024, 1, 1), 2, 21.0),
        ("C", None, 1, 30.0), ("C", None, 2, 31.0)], "k string, d date, o int, v double")
    win = {r.k: r.v for r in feed.latest_per_key(df, "k", "d", "o", "win").collect()}
    lose = {r.k: r.v for r in feed.latest_per_key(df, "k", "d", "o", "lose").collect()}
    assert win == {"A": 11.0, "B": 21.0, "C": 31.0}
    assert lose == {"A": 12.0, "B": 21.0, "C": 31.0}


def test_nutrient_table_code_from_name_and_d10(spark):
    raw = spark.createDataFrame([("SOYBEAN MEAL", "48"), ("48 Soybean Meal", "47"), ("x", None)],
                                "`Ingredient Name` string, `Crude Protein (%)` string")
    nt = {r.ingredient_code: r for r in feed.prepare_nutrient_table(raw).collect()}
    assert nt["SOY"].protein_pct == 48.0 and nt["SBM"].protein_pct == 47.0 and nt["X"].andfom_pct is None


def test_date_fallback_dataset_vs_row(spark):
    # With a date column present, rows lacking it are dropped unless date_fallback='row'
    raw = spark.createDataFrame([("1", "G1", 1.0, 2.0, None, D(2024, 5, 1)), ("2", "G1", 1.0, 2.0, D(2024, 5, 2), None)],
                                "cow string, grp string, dim double, milk double, date date, source_file_date date")
    assert herd.standardize_daily(raw).count() == 1
    assert herd.standardize_daily(raw, date_fallback="row").count() == 2


def test_materialize_modes(spark):
    from herdfeed.session import materialize

    afi = afi_rows(spark, [("1", "G1", 10.0, 20.0, D(2024, 5, 1)), ("2", "G2", 11.0, 21.0, D(2024, 5, 2))])
    assert spark.sparkContext.getCheckpointDir()  # set from the session (tests: a scratch folder)
    ck = materialize(afi, "checkpoint")
    assert ck.count() == 2 and "LogicalRDD" in ck._jdf.queryExecution().optimizedPlan().toString()
    p = materialize(afi, "persist")
    assert p.is_cached and p.count() == 2
    p.unpersist()
    assert materialize(afi, "none") is afi


def test_weight_year_needs_explicit_year_when_daily_spans_years(spark):
    import pytest

    afi = afi_rows(spark, [("1", "G1", 10.0, 20.0, D(2023, 12, 31)), ("1", "G1", 10.0, 20.0, D(2024, 1, 1))])
    raw = spark.createDataFrame([("1", "600", "Jan")], "cow string, weight string, month string")
    with pytest.raises(ValueError):
        herd.monthly_weights(raw, afi=afi)
    r = herd.monthly_weights(raw, afi=afi, weight_year=2024).first()
    assert (r.year, r.month_num, r.weight) == (2024, 1, 600.0)
    with_year = spark.createDataFrame([("1", "600", "Jan", "2023")], "cow string, weight string, month string, yr string")
    assert herd.monthly_weights(with_year, afi=afi).first().year == 2023


@pytest.mark.parametrize("seed", range(3))
def test_modes_and_deviations_by_hand(spark, seed):
    """A1, A2 and A7 against pandas: ties, NULL groups, repeated animal-days, equal values."""
    import random

    import pandas as pd

    rng = random.Random(seed)
    rows = [(f"c{rng.randint(0, 6)}", dt.date(2024, rng.randint(1, 2), rng.randint(1, 9)), rng.choice([None, 1, 2, 3, -4]), rng.choice([None, 1.0, 7.5]),
             rng.choice([20.0, 20.0, 31.5])) for _ in range(250)] + [("one", dt.date(2024, 1, 1), None, None, 5.0)] + [("same", dt.date(2024, 1, k), k % 2, 1.0, 0.1) for k in range(1, 8)]
    df = spark.createDataFrame(rows, "animal_id string, day date, group int, dim double, daily_yield double")
    df = df.withColumns({"year": F.year("day"), "month_num": F.month("day")})
    p = pd.DataFrame(rows, columns=["animal_id", "day", "group", "dim", "daily_yield"])
    mode = lambda x: x.mode().min() if x.notna().any() else None
    daily = p.groupby(["animal_id", "day"]).agg(y=("daily_yield", "mean"), dim=("dim", "mean"), group=("group", mode)).reset_index()
    want = daily.groupby("animal_id").agg(group=("group", mode), dim=("dim", "mean"), n=("day", "count"), mean=("y", "mean"), sd=("y", "std"))
    for r in herd.agg_per_animal(df).collect():
        w = want.loc[r.animal_id]
        assert (r.group, r.n_days) == (None if pd.isna(w.group) else w.group, w.n)
        for got, exact in ((r.avg_dim, w.dim), (r.avg_daily_yield, w["mean"]), (r.yield_std, w.sd)):
            assert (got is None and pd.isna(exact)) or got == pytest.approx(exact, abs=1e-9)
    assert [r.yield_std for r in herd.agg_per_animal(df).collect() if r.animal_id == "same"] == [pytest.approx(0, abs=1e-12)]
    p["ym"] = [d.year * 100 + d.month for d in p.day]
    want = p.groupby(["animal_id", "ym"]).agg(group=("group", mode), dim=("dim", "mean"), days=("day", "nunique"), first=("day", "min"), last=("day", "max"))
    got = herd.agg_animal_month_group(df).collect()
    assert len(got) == len(want)
    for r in got:
        w = want.loc[(r.animal_id, r.year * 100 + r.month_num)]
        assert (r.group, r.n_afi_days, r.first_day, r.last_day) == (None if pd.isna(w.group) else w.group, w.days, w["first"], w["last"])
        assert (r.avg_dim is None and pd.isna(w.dim)) or r.avg_dim == pytest.approx(w.dim)
