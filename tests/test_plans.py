"""Plan-shape checks: the optimizer gets what the design promises."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from herdfeed.operators import feed, herd
from herdfeed.plans import bindings as B
from herdfeed.plans.registry import RAW_QUERIES, queries

PYTHON_NODES = re.compile(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(RAW_QUERIES))
def test_no_python_in_any_registered_plan(spark, key):
    assert not PYTHON_NODES.search(plan_of(RAW_QUERIES[key](spark, SF_SMALL)))


def test_nutrient_dimension_is_broadcast(spark):
    ff = feed.prepare_feed_intake(B.b_feed(spark, SF_SMALL))
    nt = feed.prepare_nutrient_table(B.b_nutrient(spark, SF_SMALL), ordinal_col="ordinal")
    plan = plan_of(feed.join_nutrient(ff, nt))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_nutrient_join_adds_no_filter_on_finished_codes(spark):
    raw = spark.createDataFrame([("corn silage", 1.0, "2024-01-01"), ("old hay", 2.0, None), ("--", 3.0, None)], "ingredient string, protein double, date string")
    fed = spark.createDataFrame([("2024-01-01", "r", "Corn Silage x", 1.0, 2.0), ("2024-01-01", "r", "wheat", 1.0, 2.0)],
                                "date string, recipe string, ingredient string, dry_call_weight double, dry_actual_weight double")
    ff, nt = feed.clean_feed_intake(fed), feed.prepare_nutrient_table(raw)
    joined = feed.join_nutrient(ff, nt)
    rules = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("keys: [CSL")
    assert rules(joined) == rules(ff) + rules(nt)
    assert sorted(tuple(r) for r in joined.select("ingredient_code", "protein_pct").collect()) == [("CSL", 1.0), ("WHE", None)]
    missing = feed.missing_nutrients(feed.nutrient_delivery(ff, nt))
    assert rules(missing) == rules(ff) + rules(nt) and [r[0] for r in missing.collect()] == ["WHE"]


def test_nutrient_table_of_built_in_codes_is_broadcast_whatever_its_source(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ff = feed.clean_feed_intake(B.b_feed(spark, SF_SMALL))
        nt = lambda **kw: feed.prepare_nutrient_table(B.b_nutrient(spark, SF_SMALL), ordinal_col="ordinal", **kw)
        own = spark.createDataFrame([("RED", "r")], "map_key string, map_code string")
        assert "BroadcastHashJoin" in plan_of(feed.join_nutrient(ff, nt()))
        assert "BroadcastHashJoin" not in plan_of(feed.join_nutrient(ff, nt(ingredient_mapping=own)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_queries_run_no_method_too_large_to_compile(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(limit)
    queries()["nutrient_delivery"](spark, SF_SMALL)
    assert spark.conf.get(limit) == "8000"


def test_fused_formula_error_has_no_join_of_its_own(spark):
    ff = feed.prepare_feed_intake(B.b_feed(spark, SF_SMALL), group_by_pen=True)
    nt = feed.prepare_nutrient_table(B.b_nutrient(spark, SF_SMALL), ordinal_col="ordinal")
    nd = feed.nutrient_delivery(ff, nt)
    fused = plan_of(feed.nutrient_error_by_formula(nd, group_by_pen=True))
    two = plan_of(feed.nutrient_error_by_formula(nd, feed.error_by_weight(ff, True), group_by_pen=True))
    joins = lambda p: len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", p))
    assert joins(fused) < joins(two)


def test_start_date_filter_reaches_the_scan(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").selectExpr(
        "cast(l_suppkey as string) as cow", "l_returnflag as grp", "cast(l_partkey as double) as dim",
        "l_quantity as milk", "l_shipdate as day")
    plan = plan_of(herd.standardize_daily(li, start_date="1998-01-01"))
    assert re.search(r"PushedFilters: \[[^\]]*l_shipdate", plan)
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate" in plan


def test_distinct_count_is_two_level_aggregation_not_expand(spark):
    afi = herd.standardize_daily(B.b_daily(spark, SF_SMALL))
    plan = plan_of(herd.agg_group_day(afi))
    assert "Expand" not in plan and plan.count("HashAggregate") >= 4


@pytest.mark.parametrize("key", ["standard_daily", "coerce_dates", "clean_date"])
def test_results_do_not_depend_on_session_time_zone(spark, key):
    seen = []
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            seen.append(sorted(map(str, RAW_QUERIES[key](spark, SF_SMALL).collect())))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen[0] == seen[1] == seen[2]


def scans(plan: str, table: str) -> int:
    return len(re.findall(rf"Scan parquet[^\n]*\n?[^\n]*{table}\.parquet|FileScan parquet[^\n]*{table}\.parquet", plan))


@pytest.mark.parametrize("key", ["error_by_weight", "error_by_weight_pen", "agg_formula_weight", "agg_nutrient_sum", "nutrient_delivery",
                                 "nutrient_error", "nutrient_error_pen", "missing_nutrients", "join_nutrient"])
def test_feed_tables_scan_the_feed_once(spark, key):
    assert scans(plan_of(RAW_QUERIES[key](spark, SF_SMALL)), "lineitem") == 1


def test_two_table_form_scans_the_feed_twice(spark):
    assert scans(plan_of(RAW_QUERIES["join_null_safe"](spark, SF_SMALL)), "lineitem") <= 2


def test_unique_animals_are_counted_without_a_distinct_level(spark):
    afi = herd.standardize_daily(B.b_daily(spark, SF_SMALL))
    months = herd.animal_month_yield(afi)
    levels = lambda unique: plan_of(herd.yield_group_month(months, assume_unique=unique)).count("HashAggregate(")
    assert levels(True) < levels(False)


@pytest.mark.parametrize("key", ["cow_month_weight", "per_cow_yield", "weight_group"])
def test_modes_are_plain_hash_aggregates(spark, key):
    plan = plan_of(RAW_QUERIES[key](spark, SF_SMALL))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "HashAggregate" in plan


def test_phrase_rules_are_compiled(spark):
    from herdfeed.functions.ingredients import ingredient_code

    plan = plan_of(spark.range(3).select(ingredient_code(F.concat(F.lit("corn silage "), F.col("id").cast("string")))))
    assert "lambda" not in plan.lower()
