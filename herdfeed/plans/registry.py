"""Registered queries: one per operator of the inventory, each over the whole driver
tables (via :mod:`herdfeed.plans.bindings`). Float columns are rounded to 6 decimals
(half away from zero, as DuckDB rounds) so the oracle comparison is insensitive to
summation order; everything else is the library's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    clean_date, clean_group, clean_id, clean_numeric, clean_text, date_from_filename,
    month_number, safe_percent, t_value,
)
from ..functions.dates import calendar_parts
from ..functions.stats import add_t_interval
from ..operators import feed, herd
from ..session import compiled_methods, scratch_path
from ..sinks import (
    coerce_dates, load_csv_directory, round_floats, run_profile, sort_nulls_last, with_position, write_tables,
)
from ..sources.files import read_feed_files, read_table_file, scan_daily, union_by_name, with_provenance
from ..sources.headers import find_column, find_first_existing, snake_case_columns
from ..sources.mapping import apply_ingredient_map, ingredient_map
from . import bindings as B

Query = Callable[[SparkSession, str], DataFrame]
CONFIDENCE = 0.80


def round_for_check(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns half away from zero (DuckDB's rule), first three digits finer,
    so that the last bits of a sum can't tip a tie; -0.0 becomes 0.0. The oracle rounds the
    same way; the library's own results are not rounded."""
    def half_away(c, places):
        y = c * float(10 ** places)
        return F.when(F.abs(y - F.rint(y)) == 0.5, y + F.signum(y) * 0.5).otherwise(F.rint(y)) / float(10 ** places)

    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            r = half_away(half_away(c.cast("double"), digits + 3), digits)
            c = F.when(r == 0, F.lit(0.0)).otherwise(r)
        cols.append(c.alias(f.name))
    return df.select(cols)


# ----------------------------------------------------------------- shared inputs

def _afi(spark, sf, **kw) -> DataFrame:
    return herd.standardize_daily(B.b_daily(spark, sf), **kw)


def _weights(spark, sf) -> DataFrame:
    return herd.monthly_weights(B.b_weights(spark, sf))


def _ff(spark, sf, by_pen=False, **kw) -> DataFrame:
    return feed.prepare_feed_intake(B.b_feed(spark, sf), group_by_pen=by_pen, **kw)


def _fc(spark, sf) -> DataFrame:
    """Cleaned feed rows without formula totals: all that the aggregates and joins read."""
    return feed.clean_feed_intake(B.b_feed(spark, sf))


def _nt(spark, sf, nulls="win") -> DataFrame:
    return feed.prepare_nutrient_table(B.b_nutrient(spark, sf), ordinal_col="ordinal", nulls=nulls)


def _cmw(spark, sf) -> DataFrame:
    afi = _afi(spark, sf)
    return herd.join_month_weight(herd.agg_animal_month_group(afi), _weights(spark, sf))


# ----------------------------------------------------------------- herd

def q_standard_daily(spark, sf):
    return _afi(spark, sf)


def q_yield_and_dim(spark, sf):
    return herd.yield_and_dim(_afi(spark, sf))


def q_yield_group_day(spark, sf):
    return herd.yield_group_day(_afi(spark, sf), CONFIDENCE)


def q_agg_group_day(spark, sf):
    return herd.agg_group_day(_afi(spark, sf))


def q_animal_month_yield(spark, sf):
    return herd.animal_month_yield(_afi(spark, sf))


def q_agg_animal_month(spark, sf):
    return herd.agg_animal_month(_afi(spark, sf))


def q_yield_group_month(spark, sf):
    return herd.yield_group_month(herd.animal_month_yield(_afi(spark, sf)), CONFIDENCE, assume_unique=True)


def q_agg_group_month(spark, sf):
    return herd.agg_group_month(herd.animal_month_yield(_afi(spark, sf)))


def q_per_cow_yield(spark, sf):
    return herd.per_cow_yield(_afi(spark, sf), CONFIDENCE)


def q_agg_per_animal(spark, sf):
    return herd.agg_per_animal(_afi(spark, sf))


def q_agg_animal_month_group(spark, sf):
    return herd.agg_animal_month_group(_afi(spark, sf))


def q_monthly_weights(spark, sf):
    return _weights(spark, sf)


def q_agg_month_weight(spark, sf):
    return herd.agg_month_weight(herd.standardize_weights(B.b_weights(spark, sf)))


def q_join_month_weight(spark, sf):
    return _cmw(spark, sf)


def q_cow_month_weight(spark, sf):
    return herd.cow_month_weight_table(_cmw(spark, sf))


def q_join_daily_weight(spark, sf):
    return herd.join_daily_weight(_afi(spark, sf), _weights(spark, sf))


def q_dim_weights_merged(spark, sf):
    afi = _afi(spark, sf)
    daily, _ = herd.merge_dim_weights(afi, _weights(spark, sf))
    return herd.dim_weights_merged(daily)


def q_dedupe_animal_month(spark, sf):
    """Daily rows: an animal has one for each day of a month."""
    daily = herd.join_daily_weight(_afi(spark, sf), _weights(spark, sf))
    return herd.dedupe_animal_month(daily.select("animal_id", "year", "month_num", "month", "group", "weight"))


def q_agg_weight_group(spark, sf):
    return herd.agg_weight_group(_cmw(spark, sf))


def q_weight_group(spark, sf):
    return herd.weight_group(_cmw(spark, sf), assume_unique=True)


def q_session_yield(spark, sf):
    return herd.standardize_daily(B.b_sessions(spark, sf), group_mapping=B.SESSION_GROUPS)


def q_drop_missing_keys(spark, sf):
    # only two of the five event types are mapped to groups: the rest lose their group
    return herd.standardize_daily(B.b_sessions(spark, sf), group_mapping={"view": 1, "click": 2})


def q_filter_start(spark, sf):
    return _afi(spark, sf, start_date="1998-01-01")


def q_weight_year(spark, sf):
    """C17: weights with a month name but no date or year; the year is the single year
    of the (session) daily data."""
    sessions = herd.standardize_daily(B.b_sessions(spark, sf), group_mapping=B.SESSION_GROUPS)
    o = B.table(spark, sf, "orders")
    raw = o.select(F.col("o_custkey").cast("string").alias("animal"),
                   (F.col("o_totalprice") / 100.0).alias("bw"),
                   F.date_format("o_orderdate", "MMMM").alias("month"))
    return herd.monthly_weights(raw, afi=sessions)


def q_mode_lowest(spark, sf):
    return _afi(spark, sf).groupBy("animal_id", "year").agg(herd.mode_lowest("group").alias("mode_group"))


def q_sd_samp(spark, sf):
    return (_afi(spark, sf).groupBy("animal_id", "year", "month_num")
            .agg(herd.sd_samp("daily_yield").alias("sd_yield"), F.count("daily_yield").alias("n")))


def q_t_value(spark, sf):
    g = herd.agg_group_day(_afi(spark, sf))
    return g.select("day", "group", "n_animals", t_value("n_animals", CONFIDENCE).alias("t_value"))


def q_t_interval(spark, sf):
    g = herd.agg_weight_group(_cmw(spark, sf))
    g = g.withColumn("se", F.col("weight_std") / F.sqrt("n_animals"))
    return add_t_interval(g, "avg_weight", "se", "n_animals", 0.95, prefix="weight_")


def q_calendar_parts(spark, sf):
    day = F.col("l_shipdate").cast("date")
    parts = calendar_parts(day)
    return (B.table(spark, sf, "lineitem")
            .select(day.alias("day"), *[c.alias(n) for n, c in parts.items()]).distinct())


def q_run_profile(spark, sf):
    raw = B.b_daily(spark, sf)
    return run_profile(raw, herd.standardize_daily(raw))


# ----------------------------------------------------------------- scalar functions

def q_clean_id(spark, sf):
    li = B.table(spark, sf, "lineitem")
    k = F.col("l_suppkey").cast("string")
    ln = F.col("l_linenumber")
    raw = (F.when(ln == 1, F.concat(k, F.lit(".0")))
           .when(ln == 2, F.concat(F.lit("0"), k))
           .when(ln == 3, F.concat(F.lit("  "), k, F.lit(" ")))
           .when(ln == 4, F.concat(F.lit("A"), k))
           .when(ln == 5, F.lit(""))
           .when(ln == 6, F.concat(k, F.lit("e1")))
           .otherwise(F.concat(k, F.lit(".5"))))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw_id")).withColumn(
        "animal_id", clean_id("raw_id"))


def q_clean_group(spark, sf):
    li = B.table(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    raw = (F.when(ln == 1, F.concat(F.lit("G"), (ln + F.col("l_suppkey") % 4).cast("string")))
           .when(ln == 2, F.lit("pack")).when(ln == 3, F.lit("PaCk"))
           .when(ln == 4, (F.col("l_suppkey") % 20).cast("string"))
           .when(ln == 5, F.lit("1.5")).when(ln == 6, F.concat(F.col("l_returnflag"), F.lit("x")))
           .otherwise(F.concat((F.col("l_suppkey") % 9).cast("string"), F.lit(".0"))))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw_group")).withColumn(
        "group", clean_group("raw_group"))


def q_month_parse(spark, sf):
    o = B.table(spark, sf, "orders")
    name = F.date_format("o_orderdate", "MMMM")
    v = F.col("o_orderkey") % 4
    raw = (F.when(v == 0, name).when(v == 1, F.lower(F.substring(name, 1, 3)))
           .when(v == 2, F.month("o_orderdate").cast("string"))
           .otherwise(F.concat(F.lit(" "), F.upper(name), F.lit(" "))))
    return o.select("o_orderkey", raw.alias("raw_month")).withColumn("month_num", month_number("raw_month"))


def q_clean_text(spark, sf):
    p = B.table(spark, sf, "part")
    v = F.col("p_partkey") % 6
    raw = (F.when(v == 0, F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
           .when(v == 1, F.lit("N/A")).when(v == 2, F.lit("--")).when(v == 3, F.lit("Null"))
           .when(v == 4, F.lit("   ")).otherwise(F.col("p_type")))
    return p.select("p_partkey", raw.alias("raw_text")).withColumn("text", clean_text("raw_text"))


def q_clean_numeric(spark, sf):
    li = B.table(spark, sf, "lineitem")
    pk = F.col("l_partkey")
    ln = F.col("l_linenumber")
    raw = (F.when(ln == 1, F.concat(pk.cast("string"), F.lit("%")))
           .when(ln == 2, F.concat(F.floor(pk / 1000).cast("string"), F.lit(","),
                                   F.lpad((pk % 1000).cast("string"), 3, "0"), F.lit(".5")))
           .when(ln == 3, F.lit("--"))
           .when(ln == 4, F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")))
           .when(ln == 5, F.concat(pk.cast("string"), F.lit("d")))
           .when(ln == 6, F.concat(pk.cast("string"), F.lit("--"), F.col("l_linenumber").cast("string")))
           .otherwise(F.lit("inf")))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw_number")).withColumn(
        "number", clean_numeric("raw_number"))


def q_clean_date(spark, sf):
    o = B.table(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    v = F.col("o_orderkey") % 7
    serial = F.datediff(d, F.lit("1899-12-30").cast("date"))
    raw = (F.when(v == 0, F.date_format(d, "yyyy-MM-dd"))
           .when(v == 1, F.date_format(d, "M/d/yyyy"))
           .when(v == 2, F.date_format(d, "dd/MM/yyyy"))
           .when(v == 3, F.date_format(d, "yyyyMMdd"))
           .when(v == 4, F.concat(serial.cast("string"), F.lit(".75")))
           .when(v == 5, F.lit("19999"))
           .otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 06:30:00"))))
    return o.select("o_orderkey", raw.alias("raw_date")).withColumn("date", clean_date("raw_date"))


def q_date_from_filename(spark, sf):
    e = B.table(spark, sf, "events")
    d = F.col("ts").cast("date")
    v = F.col("event_id") % 4
    name = (F.when(v == 0, F.concat(F.lit("afi_"), F.date_format(d, "yyyyMMdd"), F.lit(".parquet")))
            .when(v == 1, F.concat(F.lit("afi_"), F.date_format(d, "yyyy_M_d"), F.lit(".csv")))
            .when(v == 2, F.concat(F.lit("x"), F.date_format(d, "yyyy"), F.lit("1935_"),
                                   F.date_format(d, "yyyy-MM-dd"), F.lit(".parquet")))
            .otherwise(F.concat(F.col("event_type"), F.lit(".parquet"))))
    return e.select("event_id", name.alias("file_name")).withColumn("file_date", date_from_filename("file_name"))


def _ingredient_text(spark, sf) -> DataFrame:
    p = B.table(spark, sf, "part")
    v = F.col("p_size") % 6
    text = (F.when(v == 0, F.concat(F.col("p_type"), F.lit(" "), F.col("p_name")))
            .when(v == 1, F.concat(F.lit("corn silage "), F.col("p_name")))
            .when(v == 2, F.concat(F.col("p_size").cast("string"), F.lit(" Soybean Meal")))
            .when(v == 3, F.concat(F.lit("Dry  Cow Mix "), F.col("p_brand")))
            .when(v == 4, F.lit("--"))
            .otherwise(F.col("p_name")))
    return p.select("p_partkey", text.alias("ingredient"))


def q_ingredient_code(spark, sf):
    return apply_ingredient_map(_ingredient_text(spark, sf), "ingredient")


def q_ingredient_map(spark, sf):
    p = B.table(spark, sf, "part")
    raw = p.select(F.col("p_name").alias("Ingredient Name"),
                   F.concat(F.col("p_type"), F.lit("-"), F.col("p_brand")).alias("Code"),
                   F.col("p_partkey").alias("ord"))
    return ingredient_map(raw, ordinal_col="ord")


def q_safe_percent(spark, sf):
    li = B.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", safe_percent("l_tax", "l_discount").alias("pct"))


def q_round_floats(spark, sf):
    li = B.table(spark, sf, "lineitem")
    return round_floats(li.select("l_orderkey", "l_linenumber",
                                  (F.col("l_extendedprice") * F.col("l_discount")).alias("disc_value"),
                                  (F.col("l_quantity") / 8.0).alias("eighths")), 2)


# ----------------------------------------------------------------- headers and sources

def q_snake_headers(spark, sf):
    li = B.table(spark, sf, "lineitem")
    return snake_case_columns(li.select(
        F.col("l_suppkey").alias(" Farm Animal ID "), F.col("l_quantity").alias("Yield (kg)"),
        F.col("l_partkey").alias("Days-In-Milk"), F.col("l_shipdate").alias("Run.Date/Time"),
        F.col("l_tax").alias("Fat %")))


def q_resolve_exact(spark, sf):
    li = B.table(spark, sf, "lineitem")
    df = li.select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("cow_id"),
                   F.col("l_linenumber").alias("pen"), F.col("l_returnflag").alias("grp"),
                   F.col("l_quantity").alias("milk"), F.col("l_extendedprice").alias("total_yield"))
    roles = {r: find_first_existing(df.columns, herd.DAILY_CANDIDATES[r]) for r in ("animal", "group", "daily_yield")}
    return df.select([F.col(c).alias(r) for r, c in roles.items()])


def q_resolve_fuzzy(spark, sf):
    raw = B.b_feed(spark, sf).select(
        F.col("feeding_date").alias("Feeding Date"),
        F.date_add("feeding_date", 1).alias("Run Feeding Date"),
        F.col("recipe_display_name").alias("Recipe"),
        F.col("ingredient_name").alias("Feed Ingredient"),
        F.col("dry_call_weight").alias("DryCallWeight"),
        F.col("dry_actual_weight").alias("Total Dry Actual Weight (kg)"))
    roles = ("feeding_date", "recipe_display_name", "ingredient_name", "dry_call_weight", "dry_actual_weight")
    found = {r: find_column(raw.columns, feed.FEED_COLUMN_CANDIDATES[r]) for r in roles}
    return raw.select([F.col(f"`{c}`").alias(r) for r, c in found.items()])


def q_coerce_dates(spark, sf):
    o = B.table(spark, sf, "orders")
    text = o.select(F.col("o_orderkey").cast("string").alias("order"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                    F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 12:00:00")).alias("Run Date Time"),
                    F.lit("n/a").alias("notes_date"),
                    F.col("o_orderpriority").alias("priority"))
    return coerce_dates(text)


def q_scan_daily(spark, sf):
    return scan_daily(spark, f"{sf.rstrip('/')}/lineitem.parquet")


def q_file_provenance(spark, sf):
    df = with_provenance(B.table(spark, sf, "lineitem"), date_col="source_file_date")
    return df.groupBy("source_file", "source_file_date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_union_by_name_drift(spark, sf):
    li = B.table(spark, sf, "lineitem")
    a = li.filter(F.col("l_linenumber") <= 3).select(
        F.col("l_orderkey").alias("Order Key"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("qty"))
    b = li.filter(F.col("l_linenumber") > 3).select(
        F.concat(F.lit("K"), F.col("l_orderkey").cast("string")).alias("order_key"),
        F.col("l_linenumber").alias("line"), F.col("l_tax").alias("tax"))
    return union_by_name([a, b])


def q_feed_files_drift(spark, sf):
    """Delimited files of one folder that differ in suffix, separator, column order, columns
    and spelling of headers, with quotes and line breaks inside quoted fields and headers, and with
    blank lines before the header."""
    path = scratch_path(spark, "feed-files")
    li = B.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"), F.concat(F.lit("by "), F.col("l_returnflag")).alias("mode"),
        F.concat(F.lit('say "'), F.col("l_returnflag"), F.lit('", then'), F.lit("\n"), F.col("l_linestatus")).alias("note"))
    forms = (("csv", ",", ["order", "line", "mode"]), ("csv", ",", ["mode", "order", "line", "note"]),
             ("txt", ";", ["line", "order"]), ("txt", "|", ["order", "line", "note"]), ("tsv", "\t", ["line", "mode", "order"]),
             ("csv", ",", ["order AS Order", "mode AS `Mode\n`", "line AS `LINE `"]))
    for k, (suffix, sep, columns) in enumerate(forms):
        (li.filter(F.col("line") % 7 == k).selectExpr(*columns).write.option("header", True).option("sep", sep)
         .option("escape", '"').option("extension", suffix).csv(f"{path}/{k}"))
    rows = li.filter(F.col("line") % 7 == 6).select((F.col("order") % 4).alias("part"), F.lit(3).alias("at"), F.concat_ws(",", "line", "order", "mode").alias("value"))
    heads = spark.range(4).select(F.col("id").alias("part"), F.posexplode(F.array(F.lit(""), F.lit("  "), F.lit("line,order,mode"))).alias("at", "value"))
    (rows.union(heads).repartition("part").sortWithinPartitions("part", "at").drop("at")
     .write.partitionBy("part").option("extension", "csv").text(f"{path}/6"))
    read = read_feed_files(spark, path)
    return read.select(F.col("order").cast("long").alias("order"), F.col("line").cast("long").alias("line"), "mode", "note")


def q_daily_files_drift(spark, sf):
    """Nested Parquet files whose id column is int, bigint or text."""
    path = scratch_path(spark, "daily-files")
    li = B.table(spark, sf, "lineitem")
    key = F.col("l_orderkey") + F.lit(982000123456000000)
    forms = (("", key, "bigint"), ("/late", F.col("l_orderkey"), "int"), ("/late/text", key, "string"))
    for k, (folder, value, kind) in enumerate(forms):
        (li.filter(F.col("l_linenumber") % len(forms) == k).select(value.cast(kind).alias("Animal ID"), F.col("l_quantity").alias("Yield"))
         .write.mode("append").parquet(f"{path}{folder}"))
    return scan_daily(spark, path, recursive=True).select("animal_id", F.col("yield").alias("daily_yield"))


def q_daily_files_top_level(spark, sf):
    """Files of a folder itself, beside a sub-folder named like a partition."""
    path = scratch_path(spark, "daily-top")
    li = B.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("Animal ID"), F.col("l_quantity").alias("Yield"), "l_linenumber")
    for folder, keep in (("", "l_linenumber < 5"), ("/year=2023", "l_linenumber >= 5")):
        li.filter(keep).drop("l_linenumber").write.mode("append").parquet(f"{path}{folder}")
    return scan_daily(spark, path).drop("source_file")


def q_csv_tables_loaded(spark, sf):
    """Tables written as CSV folders, listed, typed and loaded."""
    path = scratch_path(spark, "csv-tables")
    o = B.table(spark, sf, "orders")
    write_tables({"Open Orders": o.filter("o_orderstatus = 'O'").select("o_orderkey", F.to_date("o_orderdate").alias("order_date")),
                  "2 other": o.filter("o_orderstatus <> 'O'").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))}, path)
    loaded: dict[str, DataFrame] = {}
    load_csv_directory(spark, path, "own", lambda df, name: loaded.__setitem__(name, df))
    parts = [df.select(F.lit(name).alias("table_name"), F.col("o_orderkey").cast("long").alias("o_orderkey"), "order_date")
             for name, df in sorted(loaded.items())]
    return parts[0].unionByName(parts[1])


def q_parquet_table_round_trip(spark, sf):
    """One table written as Parquet, rounded, and read as a table file."""
    path = scratch_path(spark, "tables")
    write_tables({"prices": B.table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") / 8).alias("eighth"))}, path,
                 ("parquet",), round_digits=2)
    return read_table_file(spark, f"{path}/prices.parquet").select("p_partkey", "eighth")


def q_user_map_codes(spark, sf):
    """A user's map, whose keys are found by the upper-case text or by the compact text,
    before the built-in rules."""
    p = B.table(spark, sf, "part")
    names = p.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(
        F.concat(F.upper("p_brand"), F.lit(" -"))).alias("ingredient"))
    own = F.when(F.col("p_partkey") % 2 == 0, F.lower("p_name")).otherwise(F.regexp_replace("p_brand", "[^A-Za-z0-9]", ""))
    # Names of small parts get a key that no ingredient has: the built-in rules stay for them.
    raw = p.select(
        F.when(F.col("p_size") > 25, own).otherwise(F.concat(F.lit("no such "), own)).alias("raw"),
        F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("code"), F.col("p_partkey").alias("at"))
    return apply_ingredient_map(names, "ingredient", mapping=ingredient_map(raw, ordinal_col="at"))


# ----------------------------------------------------------------- feed

def q_filtered_feed(spark, sf):
    return _ff(spark, sf)


def q_filter_range(spark, sf):
    return _ff(spark, sf, start_date="1996-01-01", end_date="1997-12-31")


def q_drop_all_missing(spark, sf):
    li = B.table(spark, sf, "lineitem")
    df = li.select("l_orderkey", "l_linenumber",
                   F.when(F.col("l_tax") == 0.08, None).otherwise(F.col("l_quantity")).alias("dry_call_weight"),
                   F.when(F.col("l_discount") == 0.1, None).otherwise(F.col("l_quantity")).alias("dry_actual_weight"))
    return feed.drop_all_missing(df)


def q_window_total(spark, sf):
    return _ff(spark, sf, by_pen=True).select(
        "feeding_date", "recipe_display_name", "pen_name", "ingredient_code", "dry_call_weight",
        "dry_actual_weight", "dry_call_weight_sum", "dry_actual_weight_sum")


def q_participation(spark, sf):
    return _ff(spark, sf, by_pen=True).select(
        "feeding_date", "recipe_display_name", "pen_name", "ingredient_code", "dry_actual_weight",
        "pct_participation", "call_pct_participation", "actual_pct_participation")


def q_dry_weight_participation(spark, sf):
    return feed.dry_weight_participation(_ff(spark, sf))


def q_weight_difference_ing(spark, sf):
    return feed.weight_difference_ing(_ff(spark, sf))


def q_agg_formula_weight(spark, sf):
    return feed.agg_formula_weight(_fc(spark, sf), feed.formula_keys(True))


def q_error_by_weight(spark, sf):
    return feed.error_by_weight(_fc(spark, sf), group_by_pen=False)


def q_error_by_weight_pen(spark, sf):
    return feed.error_by_weight(_fc(spark, sf), group_by_pen=True)


def q_sort_nulls_last(spark, sf):
    e = feed.error_by_weight(_fc(spark, sf), group_by_pen=True)
    return with_position(sort_nulls_last(e, ["feeding_date", "recipe_display_name", "pen_name"]))


def q_nutrient_table(spark, sf):
    return _nt(spark, sf)


def q_latest_per_key(spark, sf):
    return _nt(spark, sf, nulls="lose")


def q_join_nutrient(spark, sf):
    return feed.join_nutrient(_fc(spark, sf), _nt(spark, sf)).select(
        "feeding_date", "recipe_display_name", "ingredient_code", "pen_name", "dry_call_weight",
        "protein_pct", "andfom_pct", "starch_pct", "nutrient_date")


def q_nutrient_delivery(spark, sf):
    return feed.nutrient_delivery(_fc(spark, sf), _nt(spark, sf))


def q_missing_nutrients(spark, sf):
    return feed.missing_nutrients(feed.nutrient_delivery(_fc(spark, sf), _nt(spark, sf)))


def q_agg_nutrient_sum(spark, sf):
    nd = feed.nutrient_delivery(_fc(spark, sf), _nt(spark, sf))
    return feed.agg_nutrient_sum(nd, feed.formula_keys(True))


def q_nutrient_error(spark, sf):
    nd = feed.nutrient_delivery(_fc(spark, sf), _nt(spark, sf))
    return feed.nutrient_error_by_formula(nd, group_by_pen=False)


def q_nutrient_error_pen(spark, sf):
    nd = feed.nutrient_delivery(_fc(spark, sf), _nt(spark, sf))
    return feed.nutrient_error_by_formula(nd, group_by_pen=True)


def q_join_null_safe(spark, sf):
    ff = _fc(spark, sf)
    nd = feed.nutrient_delivery(ff, _nt(spark, sf))
    return feed.nutrient_error_by_formula(nd, feed.error_by_weight(ff, group_by_pen=True), group_by_pen=True)


RAW_QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def _checked(fn: Query) -> Query:
    def run(spark, sf):
        compiled_methods(spark)
        return round_for_check(fn(spark, sf))

    return run


def queries() -> dict[str, Query]:
    """Every registered query, with float columns rounded for the oracle check."""
    return {name: _checked(fn) for name, fn in RAW_QUERIES.items()}
