"""Bindings: the driver's test tables projected into herd and feed record shapes.

The test tables are not dairy data; these projections give every operator realistic
input (duplicate animal-days, missing yields, null pens, zero called weights, undated
nutrient rows ...) while reading the whole tables, so the work grows with the scale
factor. Each binding has a SQL twin in ``oracle/sql.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def b_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily milk records: an animal per supplier, three group labels, duplicate animal-days and
    some missing yields."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("animal_id"),
        F.when(F.col("l_returnflag") == "A", "G1").when(F.col("l_returnflag") == "N", "G2")
        .otherwise("pack").alias("grp"),
        (F.col("l_partkey") % 400).cast("double").alias("dim"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_discount") == 0.0), None)
        .otherwise(F.col("l_quantity")).alias("daily_yield"),
        F.col("l_shipdate").cast("date").alias("file_date"),
        F.col("l_shipdate").alias("run_date_time"),
    )


def b_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body weights: about two weighings per animal-month, group as digit text."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("cow_id"),
        (F.col("o_totalprice") / 100.0).alias("weight"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.substring("o_orderpriority", 1, 1).alias("pen"),
    )


def b_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed deliveries: null pens, zero called weights, missing delivered weights."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    j = li.join(part, li["l_partkey"] == part["p_partkey"])
    return j.select(
        F.col("l_shipdate").cast("date").alias("feeding_date"),
        F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")).alias("recipe_display_name"),
        F.col("p_name").alias("ingredient_name"),
        F.when(F.col("l_linenumber") == 7, None)
        .otherwise(F.concat(F.lit("Pen "), F.col("l_linenumber").cast("string"))).alias("pen_name"),
        F.when(F.col("l_tax") == 0.08, 0.0).otherwise(F.col("l_quantity")).alias("dry_call_weight"),
        F.when(F.col("l_discount") == 0.1, None)
        .otherwise(F.col("l_quantity") * (F.lit(1) + F.col("l_tax") - F.col("l_discount")))
        .alias("dry_actual_weight"),
    )


def b_nutrient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nutrient table: many rows per code, undated rows, an all-null code, and one code of the
    feed absent (its rows are spelt otherwise)."""
    p = table(spark, sf_dir, "part")
    red = F.col("p_name").like("red%")
    name = F.col("p_name")
    return p.select(
        F.when(name.like("blue%"), F.concat(F.lit("x"), name)).otherwise(name).alias("ingredient"),
        F.when(red | (F.col("p_size") > 40), None).otherwise(F.col("p_size").cast("double")).alias("protein_pct"),
        F.when(red, None).otherwise(
            F.col("p_retailprice") - F.lit(10.0) * F.floor(F.col("p_retailprice") / 10.0)).alias("andfom_pct"),
        F.when(red, None).otherwise((F.col("p_size") % 7).cast("double")).alias("starch_pct"),
        F.when(F.col("p_partkey") % 97 == 0, None).otherwise(
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 90).cast("int")))
        .alias("nutrient_date"),
        F.col("p_partkey").alias("ordinal"),
    )


def b_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-session milk records (no daily total column); event types as group labels."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        F.col("user_id").cast("string").alias("cow"),
        et.alias("grp"),
        (F.col("event_id") % 300).cast("double").alias("days_in_milk"),
        F.when(et.isin("view", "signup"), None).otherwise(F.col("value")).alias("yield_s_1"),
        F.when(et.isin("click", "signup"), None).otherwise(F.col("value") / 2).alias("yield_s_2"),
        F.col("ts").cast("date").alias("day"),
    )


# Group labels of b_sessions (event types) as a user group mapping.
SESSION_GROUPS = {"view": 1, "click": 2, "purchase": 3, "error": 4, "signup": 5}
