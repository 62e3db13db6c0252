"""End-to-end jobs on small files derived from the driver tables (sf0.001)."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from herdfeed.plans import bindings as B
from herdfeed.plans.jobs import load_outputs, run_feed_job, run_herd_job
from herdfeed.sinks import read_json


def test_herd_job_end_to_end(spark, tmp_dir):
    daily = os.path.join(tmp_dir, "afi")
    # one Parquet file per ship date, date only in the file name, headers in display form
    b = B.b_daily(spark, SF_SMALL).filter(F.col("file_date") < "1996-01-01")
    days = [r[0] for r in b.select("file_date").distinct().orderBy("file_date").limit(5).collect()]
    os.makedirs(daily)
    for d in days:
        pdf = (b.filter(F.col("file_date") == d).drop("file_date")
               .withColumnRenamed("animal_id", "Farm Animal ID").withColumnRenamed("daily_yield", "Daily Yield")
               .toPandas())
        # file names carry the day (the pattern only accepts 20xx years)
        pdf.to_parquet(os.path.join(daily, f"afi_{d.year + 30}{d:%m%d}.parquet"), index=False, coerce_timestamps="us")
    weights = os.path.join(tmp_dir, "weights.csv")
    (B.b_weights(spark, SF_SMALL).toPandas().to_csv(weights, index=False))
    out = os.path.join(tmp_dir, "out3")
    tables = run_herd_job(spark, daily, out, weights_path=weights)
    assert {"table_3_1_yield_and_dim", "table_3_3_yield_group_day", "table_3_4_yield_group_month",
            "table_3_5_weight_group", "per_cow_daily_yield_summary", "cow_month_weight"} <= set(tables)
    summary = read_json(spark, os.path.join(out, "run_summary.json"))
    n_rows = sum(1 for _ in tables["table_3_1_yield_and_dim"].collect())
    assert summary["clean_afi_rows"] == n_rows > 0
    assert summary["afi_start_day"] == str(days[0].replace(year=days[0].year + 30))
    assert summary["yield_and_dim_rows"] == n_rows and summary["weights_csv_used"] is True
    assert summary["per_cow_rows"] == tables["per_cow_daily_yield_summary"].count()
    assert set(summary["unique_groups"]) <= {1, 2, 15}
    ygd = spark.read.option("header", True).csv(os.path.join(out, "table_3_3_yield_group_day"))
    assert ygd.count() == tables["table_3_3_yield_group_day"].count()


def test_feed_job_and_loader(spark, tmp_dir):
    feed_dir = os.path.join(tmp_dir, "feed")
    os.makedirs(feed_dir)
    f = B.b_feed(spark, SF_SMALL).toPandas()
    f.columns = ["Feeding Date", "Recipe Display Name", "Ingredient Name", "Pen Name", "Dry Call Weight",
                 "Dry Actual Weight"]
    half = len(f) // 2
    f.iloc[:half].to_csv(os.path.join(feed_dir, "part1.csv"), index=False)
    f.iloc[half:].to_parquet(os.path.join(feed_dir, "part2.parquet"), index=False, coerce_timestamps="us")
    nutrient = os.path.join(tmp_dir, "nutrient.csv")
    B.b_nutrient(spark, SF_SMALL).drop("ordinal").toPandas().to_csv(nutrient, index=False)
    out = os.path.join(tmp_dir, "out4")
    tables = run_feed_job(spark, feed_dir, nutrient, out, group_by_pen=True)
    assert tables["filtered_feed_intake"].count() == len(f)
    shares = (tables["filtered_feed_intake"].groupBy("feeding_date", "recipe_display_name", "pen_name")
              .agg(F.sum("pct_participation").alias("s"), F.max("dry_actual_weight_sum").alias("t"))
              .filter("t > 0").collect())
    assert all(abs(r.s - 100.0) < 1e-6 for r in shares)
    written = load_outputs(spark, None, out, lambda df, name: None)
    assert "chapter4_nutrient_error_by_formula" in written and len(written) == 7  # six tables and the codes without nutrients


def test_herd_job_with_dated_files_and_weights(spark, tmp_dir):
    daily = os.path.join(tmp_dir, "afi")
    os.makedirs(os.path.join(daily, "1996"))
    b = B.b_daily(spark, SF_SMALL).filter(F.col("file_date").between("1996-01-01", "1996-03-31"))
    pdf = b.withColumnRenamed("file_date", "Date").toPandas()
    half = len(pdf) // 2
    pdf.iloc[:half].to_parquet(os.path.join(daily, "part_a.parquet"), index=False, coerce_timestamps="us")
    pdf.iloc[half:].to_parquet(os.path.join(daily, "1996", "part_b.parquet"), index=False, coerce_timestamps="us")
    weights = os.path.join(tmp_dir, "weights.csv")
    B.b_weights(spark, SF_SMALL).toPandas().to_csv(weights, index=False)
    flat = run_herd_job(spark, daily, None, weights_path=weights)
    deep = run_herd_job(spark, daily, None, weights_path=weights, recursive=True)
    assert flat["table_3_1_yield_and_dim"].count() == half          # S2: top level only
    assert deep["table_3_1_yield_and_dim"].count() == len(pdf)
    assert deep["cow_month_weight"].count() > 0
    wg = deep["table_3_5_weight_group"].collect()
    assert wg and all(r["N Animals"] >= 1 for r in wg)
    # one weight per animal-month: the daily join never multiplies daily rows
    assert deep["table_3_2_dim_weights_merged"].count() <= len(pdf)


def test_missing_dates_are_named(spark, tmp_dir):
    import pandas as pd
    import pytest
    pd.DataFrame({"cow": ["1"], "grp": ["G1"], "dim": [3.0], "milk": [4.0]}).to_parquet(os.path.join(tmp_dir, "undated.parquet"), index=False)
    with pytest.raises(ValueError, match="date is missing"):
        run_herd_job(spark, tmp_dir)


def test_feed_folder_with_a_dot_and_all_missing_codes(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "feed.2024")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("date,recipe,ingredient,dry call weight,dry actual weight\n" + "".join(f"2024-05-01,R1,{chr(65 + i // 26)}{chr(65 + i % 26)}x,1,1\n" for i in range(120)))
    nutrient = os.path.join(tmp_dir, "n.csv")
    open(nutrient, "w").write("ingredient,protein\nAAx,5\nAAx,\nABx,7\n")
    out = f"file://{tmp_dir}/out"
    run_feed_job(spark, folder, nutrient, out, formats=("parquet",))
    assert spark.read.parquet(f"{out}/missing_nutrient_codes.parquet").count() == 119
