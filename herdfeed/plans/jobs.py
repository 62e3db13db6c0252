"""The two end-to-end jobs (T14a herd, T14b feed) and the table loader (K6).

Each job reads its sources once, materialises the one DataFrame every output depends on
(``persist`` by default, or a reliable checkpoint into ``spark.checkpoint.dir``), then
writes each output table. All outputs stay lazy DataFrames until their sink.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import feed, herd
from ..session import materialize
from ..sinks import (
    TABLE_NAMES, ensure_jdbc_schema, load_csv_directory, profile_values, run_profile, write_catalog, write_jdbc,
    write_json, write_tables,
)
from ..sources.files import is_folder, read_feed_files, read_table_file, scan_daily
from ..sources.mapping import ingredient_map

LOG = logging.getLogger(__name__)

# Sort orders of the outputs (applied only at the sink, if asked for).
HERD_SORT = {
    "table_3_1_yield_and_dim": ["Date", "Grp", "Farm Animal ID"],
    "table_3_2_dim_weights_merged": ["Farm Animal ID", "File Date"],
    "table_3_3_yield_group_day": ["Day", "Group"],
    "animal_month_yield": ["Year", "Month Num", "Group", "Farm Animal ID"],
    "table_3_4_yield_group_month": ["Year", "Month Num", "Group"],
    "table_3_5_weight_group": ["Year", "Month Num", "Group"],
    "per_cow_daily_yield_summary": ["Group", "Farm Animal ID"],
}
FEED_SORT = {
    "filtered_feed_intake": ["feeding_date", "recipe_display_name", "ingredient_code"],
    "error_by_weight": ["feeding_date", "recipe_display_name"],
    "nutrient_error_by_formula": ["feeding_date", "recipe_display_name"],
}
# Names of row counts in the run summary.
ROW_COUNTS = {
    "table_3_1_yield_and_dim": "yield_and_dim_rows",
    "table_3_3_yield_group_day": "yield_group_day_rows",
    "animal_month_yield": "animal_month_yield_rows",
    "table_3_4_yield_group_month": "yield_group_month_rows",
    "per_cow_daily_yield_summary": "per_cow_rows",
    "table_3_2_dim_weights_merged": "dim_weight_daily_rows",
    "cow_month_weight": "cow_month_weight_rows",
    "table_3_5_weight_group": "weight_group_rows",
}
#: Table of the codes without any nutrient value (J5), written like the others.
MISSING_CODES = "missing_nutrient_codes"


def _counted(tables: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
    """The tables with a row counter on each, filled when the table is written."""
    counters = {name: Observation(name) for name in tables}
    return {name: df.observe(counters[name], F.count(F.lit(1)).alias("rows")) for name, df in tables.items()}, counters


def run_herd_job(spark: SparkSession, daily_dir: str, output_dir: str | None = None,
                 weights_path: str | None = None, start_date: str | None = None,
                 confidence_level: float = 0.80, weight_year: int | None = None,
                 recursive: bool = False, formats: Sequence[str] = ("csv",),
                 group_mapping: Mapping[str, int] | None = None, keep: str = "persist",
                 sort_outputs: bool = False) -> dict[str, DataFrame]:
    """Daily Parquet files (+ optional weights CSV) -> the herd tables.

    Returns the output DataFrames; with ``output_dir`` also writes them (one directory
    per table) plus ``run_summary.json`` (see :func:`herdfeed.sinks.write_json`), any file
    system Spark reaches. ``sort_outputs`` orders the written files by the tables' usual sort
    keys (a range-partitioned global sort per table)."""
    if not 0.0 < confidence_level < 1.0:
        raise ValueError(f"confidence_level {confidence_level} is not between 0 and 1")
    raw = scan_daily(spark, daily_dir, recursive=recursive)
    afi = materialize(herd.standardize_daily(raw, start_date=start_date, group_mapping=group_mapping), keep)

    profile = run_profile(raw, afi).first().asDict()
    if not profile["clean_afi_rows"]:
        herd.check_has_dates(herd.observation_days(raw))
        raise ValueError(f"no daily row of {daily_dir} has an animal, a group and a day from {start_date or 'any date'} on")

    animal_month = herd.animal_month_yield(afi)
    tables: dict[str, DataFrame] = {
        "table_3_1_yield_and_dim": herd.yield_and_dim(afi),
        "table_3_3_yield_group_day": herd.yield_group_day(afi, confidence_level),
        "animal_month_yield": animal_month,
        "table_3_4_yield_group_month": herd.yield_group_month(animal_month, confidence_level, assume_unique=True),
        "per_cow_daily_yield_summary": herd.per_cow_yield(afi, confidence_level),
    }
    if weights_path:
        raw_w = read_feed_files(spark, weights_path) if is_folder(spark, weights_path) else read_table_file(spark, weights_path)
        weights = materialize(herd.monthly_weights(raw_w.drop("source_file"), afi, weight_year, group_mapping), keep)
        daily_w, cow_month_weight = herd.merge_dim_weights(afi, weights)
        tables["table_3_2_dim_weights_merged"] = herd.dim_weights_merged(daily_w)
        tables["cow_month_weight"] = herd.cow_month_weight_table(cow_month_weight)
        tables["table_3_5_weight_group"] = herd.weight_group(cow_month_weight, assume_unique=True)

    if output_dir:
        counted, counters = _counted(tables)
        written = write_tables(counted, output_dir, formats, sort_keys=HERD_SORT if sort_outputs else None)
        summary = profile_values(profile) | {
            "afi_dir": daily_dir, "output_dir": output_dir, "start_date": start_date,
            "confidence_level": confidence_level, "weights_csv_used": bool(weights_path),
        } | {ROW_COUNTS[name]: counters[name].get["rows"] for name in tables}
        if weights_path:
            summary |= {"weights_csv": weights_path, "weight_rows_after_cleaning": weights.count()}
        write_json(spark, summary | {"output_files": written}, f"{output_dir.rstrip('/')}/run_summary.json")
        release(afi, *([weights] if weights_path else []))
    return tables


def run_feed_job(spark: SparkSession, feed_path: str, nutrient_path: str, output_dir: str | None = None,
                 ingredient_map_path: str | None = None, start_date: str | None = None,
                 end_date: str | None = None, group_by_pen: bool = False,
                 formats: Sequence[str] = ("csv",), jdbc: Mapping[str, str] | None = None,
                 jdbc_if_exists: str = "replace", jdbc_schema: str | None = None,
                 catalog_database: str | None = None, keep: str = "persist",
                 sort_outputs: bool = False) -> dict[str, DataFrame]:
    """Feed-intake files + nutrient table (+ optional mapping) -> the feed tables, and
    the codes that have no nutrient value at all as a table of their own.

    ``jdbc`` = {"url": ..., "user": ..., "password": ..., "driver": ...} writes every
    table through JDBC (K4); ``catalog_database`` writes them as catalog tables."""
    mapping = ingredient_map(read_table_file(spark, ingredient_map_path, order_col="__at"), "__at") if ingredient_map_path else None
    raw_feed = read_feed_files(spark, feed_path) if is_folder(spark, feed_path) else read_table_file(spark, feed_path)
    # cache the cleaned rows (read twice by the totals), then the final table (read by
    # every output); the first cache is dropped once the second is filled
    cleaned = materialize(feed.clean_feed_intake(raw_feed, mapping, start_date, end_date), keep)
    filtered = materialize(feed.add_formula_totals(cleaned, group_by_pen), keep)
    if keep == "persist":
        filtered.count()
        release(cleaned)
    nutrient = feed.prepare_nutrient_table(read_table_file(spark, nutrient_path, order_col="__at").drop("source_file"),
                                           ingredient_mapping=mapping, ordinal_col="__at")
    # three tables read the joined rows: they are joined once
    delivery = materialize(feed.nutrient_delivery(filtered, nutrient), keep)
    missing = feed.missing_nutrients(delivery)
    if n_missing := missing.count():
        LOG.warning("%d ingredient code(s) have no nutrient value; the table %s names all of them", n_missing, MISSING_CODES)

    tables = {
        "filtered_feed_intake": filtered,
        "dry_weight_participation": feed.dry_weight_participation(filtered),
        "weight_difference_ing": feed.weight_difference_ing(filtered),
        "error_by_weight": feed.error_by_weight(filtered, group_by_pen=group_by_pen),
        "nutrient_delivery_by_ingredient": delivery,
        "nutrient_error_by_formula": feed.nutrient_error_by_formula(delivery, group_by_pen=group_by_pen),
        MISSING_CODES: missing,
    }
    if output_dir:
        write_tables(tables, output_dir, formats, sort_keys=FEED_SORT if sort_outputs else None)
    if jdbc:
        props = {k: v for k, v in jdbc.items() if k != "url"}
        if jdbc_schema:
            ensure_jdbc_schema(spark, jdbc["url"], jdbc_schema, props)
        for name, df in tables.items():
            write_jdbc(df, jdbc["url"], TABLE_NAMES.get(name, name), jdbc_if_exists, jdbc_schema, properties=props)
    if catalog_database:
        for name, df in tables.items():
            write_catalog(df, TABLE_NAMES.get(name, name), jdbc_if_exists, catalog_database)
    if output_dir or jdbc or catalog_database:
        release(filtered, delivery)
    return tables


def release(*frames: DataFrame) -> None:
    """Drop cached blocks once every output is written (checkpointed data stays in
    ``spark.checkpoint.dir`` and is cleaned by Spark's context cleaner when enabled)."""
    for df in frames:
        if df.is_cached:
            df.unpersist()


def load_outputs(spark: SparkSession, herd_dir: str | None, feed_dir: str | None, write,
                 herd_prefix: str = "chapter3", feed_prefix: str = "chapter4") -> list[str]:
    """K6: load the CSV output directories of both jobs into tables with prefixed names
    through ``write(df, table_name)``."""
    written: list[str] = []
    for directory, prefix in ((herd_dir, herd_prefix), (feed_dir, feed_prefix)):
        if directory:
            written += load_csv_directory(spark, directory, prefix, write)
    return written

