"""Herd tables: daily milk yield, days in milk (DIM) and body weight.

Every function is a lazy DataFrame -> DataFrame transformation. Aggregations are plain
``groupBy().agg()`` with built-in aggregate functions (partial aggregation before every
shuffle); distinct counts stay inside ``groupBy`` where Spark rewrites them into a
two-level aggregation. Nothing is sorted here: ordering is applied by the sinks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_parts, clean_date, clean_timestamp, month_name_of
from ..functions.groups import clean_group, month_number
from ..functions.stats import add_t_interval, standard_error
from ..functions.text import clean_id, id_present, to_double, whole_number
from ..sources.files import merge_header_spellings
from ..sources.headers import find_first_existing, require_columns, snake_case

# Fixed values that must equal the reference's behaviour: header synonyms (after
# snake-casing), first match wins.
DAILY_CANDIDATES: dict[str, tuple[str, ...]] = {
    "animal": ("farm_animal_id", "animal_id", "cow_id", "cowid", "cow", "id", "animal"),
    "group": ("grp", "group", "pen", "pen_group", "group_id"),
    "dim": ("dim", "days_in_milk", "days_milk", "dim_dart"),
    "date": ("file_date", "date", "day", "observation_date", "milk_date", "event_date"),
    "run_time": ("run_date_time", "run_datetime", "run_date", "run_time", "created_at", "timestamp"),
    "daily_yield": ("daily_yield", "yield", "milk_yield", "total_yield", "milk", "daily_milk_yield"),
    "session_1": ("yield_s_1", "yield_session_1", "yield_1", "milk_s_1"),
    "session_2": ("yield_s_2", "yield_session_2", "yield_2", "milk_s_2"),
}

WEIGHT_CANDIDATES: dict[str, tuple[str, ...]] = {
    "animal": ("farm_animal_id", "cow_id", "cowid", "cow", "animal_id", "animal", "id"),
    "weight": ("weight", "body_weight", "bw", "bodyweight"),
    "date": ("date", "file_date", "observation_date", "event_date"),
    "month": ("month", "month_num", "mo"),
    "year": ("year", "yr"),
    "group": ("grp", "group", "pen", "pen_group", "group_id"),
}

ANIMAL_MONTH = ["animal_id", "year", "month_num"]

AFI_COLUMNS = ["animal_id", "group", "dim", "daily_yield", "day", "run_date_time",
               "source_file", "year", "month_num", "month"]


def mode_lowest(c: Column | str) -> Column:
    """Most frequent non-null value, the smallest one on ties; NULL if none."""
    return F.mode(c, deterministic=True)


# The mode as a state that merges: values are counted by a plain aggregate over (keys, value); then
# one number a value, its count above the value's distance from the largest int, names the mode by
# its maximum. Both levels stay hash aggregates on fixed-width buffers. Counts stay under 2**31.
_LARGEST = 2147483647


def mode_rank(value: str, n: str) -> Column:
    """Rank of an int ``value`` that stands in ``n`` rows; NULL for a NULL value."""
    return F.shiftleft(F.col(n), 32) + (F.lit(_LARGEST).cast("long") - F.col(value))


def mode_of(rank: Column) -> Column:
    """The value of the largest :func:`mode_rank`: A11's :func:`mode_lowest` of its rows."""
    return (F.lit(_LARGEST).cast("long") - rank.bitwiseAND(F.lit(0xFFFFFFFF))).cast("int")


def sd_samp(c: Column | str) -> Column:
    """Sample standard deviation (NULL for a single value)."""
    return F.stddev_samp(c)


def pooled_sd(n: str, mean: str, spread: str) -> Column:
    """Sample standard deviation of values that come as parts with count, mean and population
    variance; NULL for a single value. Parts of equal means add nothing between them, exactly."""
    total = F.sum(n)
    between = F.sum(F.col(n) * F.col(mean) * F.col(mean)) - F.pow(F.sum(F.col(n) * F.col(mean)), F.lit(2)) / total
    squares = F.sum(F.col(n) * F.col(spread)) + F.when(F.min(mean) == F.max(mean), 0.0).otherwise(F.greatest(between, F.lit(0.0)))
    return F.when(total > 1, F.sqrt(squares / (total - 1)))


# Column-metadata flag for columns a standardising step guarantees to be non-NULL. Later
# null filters skip them: re-filtering would be pushed down to the scan with the
# cleaning expressions inlined, evaluating them again for every row.
NON_NULL = "herdfeed.non_null"


def mark_non_null(df: DataFrame, cols) -> DataFrame:
    """Flag ``cols`` as non-NULL in their column metadata (one projection)."""
    flagged = set(cols)
    return df.select([
        F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, NON_NULL: True}) if f.name in flagged
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def drop_missing(df: DataFrame, cols) -> DataFrame:
    """``dropna(subset=cols)`` restricted to columns that may still hold NULLs."""
    need = [c for c in cols if not df.schema[c].metadata.get(NON_NULL)]
    return df.dropna(subset=need) if need else df


def _dtype(df: DataFrame, name: str | None):
    return df.schema[name].dataType if name else None


def _snake(df: DataFrame) -> DataFrame:
    return merge_header_spellings(df, snake_case)


# --------------------------------------------------------------------------- T1

def _observation_day(df: DataFrame, date_col: str | None, date_fallback: str) -> Column:
    """Day of a daily record: from its date column or, without one, from the file's name."""
    if date_fallback not in ("dataset", "row"):
        raise ValueError("date_fallback must be 'dataset' or 'row'")
    named = F.to_date(F.col("source_file_date")) if "source_file_date" in df.columns else F.lit(None).cast("date")
    if date_col is None:
        return named
    own = clean_date(date_col, _dtype(df, date_col))
    return F.coalesce(own, named) if date_fallback == "row" else own


def observation_days(raw: DataFrame, date_fallback: str = "dataset") -> DataFrame:
    """``day`` of every raw daily record, none dropped (for :func:`check_has_dates`)."""
    df = _snake(raw)
    found = find_first_existing(df.columns, DAILY_CANDIDATES["date"])
    return df.select(_observation_day(df, found, date_fallback).alias("day"))


def standardize_daily(raw: DataFrame, start_date: str | None = None,
                      group_mapping: Mapping[str, int] | None = None,
                      date_fallback: str = "dataset") -> DataFrame:
    """Daily records -> ``animal_id, group, dim, daily_yield, day, run_date_time,
    source_file, year, month_num, month``; rows missing animal, group or day dropped;
    optional ``day >= start_date``.

    ``date_fallback='dataset'`` (reference behaviour): the file-name date is used only
    when no date column exists at all. ``'row'``: per row, whichever is present."""
    df = _snake(raw)
    cols = df.columns
    found = {role: find_first_existing(cols, cands) for role, cands in DAILY_CANDIDATES.items()}
    absent = [role for role in ("animal", "group", "dim") if found[role] is None]
    if absent:
        raise ValueError(f"daily records: no column plays the role {', '.join(absent)}; headers are {cols}")

    if found["daily_yield"] is not None:
        daily_yield = to_double(found["daily_yield"], _dtype(df, found["daily_yield"]))
    elif found["session_1"] is not None and found["session_2"] is not None:
        s1, s2 = found["session_1"], found["session_2"]
        daily_yield = (F.coalesce(to_double(s1, _dtype(df, s1)), F.lit(0.0))
                       + F.coalesce(to_double(s2, _dtype(df, s2)), F.lit(0.0)))
    else:
        raise ValueError(f"daily records: neither a daily yield nor two session yields among {cols}")

    day = _observation_day(df, found["date"], date_fallback)

    run_time = (clean_timestamp(found["run_time"], _dtype(df, found["run_time"]))
                if found["run_time"] else F.lit(None).cast("timestamp_ntz"))
    source = F.col("source_file").cast("string") if "source_file" in cols else F.lit(None).cast("string")

    # F1 first, on predicates equal to "cleaned key is not NULL" but cheaper to evaluate;
    # a filter on the cleaned columns would be pushed below the projection with the
    # cleaning expressions inlined, evaluating them twice per row.
    group = clean_group(found["group"], _dtype(df, found["group"]), group_mapping)
    df = df.filter(id_present(found["animal"], _dtype(df, found["animal"])) & group.isNotNull() & day.isNotNull())
    out = df.select(
        clean_id(found["animal"], _dtype(df, found["animal"])).alias("animal_id"),
        group.alias("group"),
        to_double(found["dim"], _dtype(df, found["dim"])).alias("dim"),
        daily_yield.alias("daily_yield"),
        day.alias("day"),
        run_time.alias("run_date_time"),
        source.alias("source_file"),
    )
    out = out.withColumns(calendar_parts("day"))
    if start_date:
        out = filter_start(out, start_date)
    return mark_non_null(out.select(AFI_COLUMNS), ["animal_id", "group", "day", "year", "month_num", "month"])


def drop_missing_keys(afi: DataFrame, keys=("animal_id", "group", "day")) -> DataFrame:
    """drop rows missing any analysis key."""
    return drop_missing(afi, list(keys))


def filter_start(afi: DataFrame, start_date: str, col: str = "day") -> DataFrame:
    """keep ``col >= start_date`` (a typed date comparison, pushed to the scan when
    the column is a stored date)."""
    return afi.filter(F.col(col) >= F.lit(start_date).cast("date"))


def check_has_dates(afi_raw_days: DataFrame, col: str = "day") -> None:
    """H9: raise when no row has a date (one aggregate action)."""
    if afi_raw_days.agg(F.max(col)).first()[0] is None:
        raise ValueError("daily records: every date is missing, both in the rows and in the file names")


def yield_and_dim(afi: DataFrame) -> DataFrame:
    """T2 (table 3.1): daily rows with display names; null yields kept."""
    return afi.select(
        F.col("animal_id").alias("Farm Animal ID"),
        F.col("group").alias("Grp"),
        F.col("dim").alias("DIM"),
        F.col("day").alias("Date"),
        F.col("run_date_time").alias("Run Date Time"),
        F.col("daily_yield").alias("Yield"),
    )


# --------------------------------------------------------------------------- weights

def resolve_weight_year(afi: DataFrame | None, weight_year: int | None) -> int:
    """C17: the explicit year, else the single year present in the daily data (one
    bounded ``distinct`` action), else an error."""
    if weight_year is not None:
        return int(weight_year)
    if afi is not None:
        years = [r[0] for r in afi.select("year").dropna().distinct().limit(2).collect()]
        if len(years) == 1:
            return int(years[0])
    raise ValueError("weights: months without years, and the daily records don't fall in one year; give weight_year")


def standardize_weights(raw: DataFrame, afi: DataFrame | None = None, weight_year: int | None = None,
                        group_mapping: Mapping[str, int] | None = None) -> DataFrame:
    """Weight records -> ``animal_id, weight, weight_date, year, month_num,
    weight_group`` with rows missing animal, weight, year or month dropped."""
    df = _snake(raw)
    cols = df.columns
    found = {role: find_first_existing(cols, cands) for role, cands in WEIGHT_CANDIDATES.items()}
    absent = [role for role in ("animal", "weight") if found[role] is None]
    if absent:
        raise ValueError(f"weights: no column plays the role {', '.join(absent)}; headers are {cols}")

    if found["date"] is not None:
        d = clean_date(found["date"], _dtype(df, found["date"]))
        weight_date, year, month_num = d, F.year(d), F.month(d)
    else:
        if found["month"] is None:
            raise ValueError(f"weights: neither a date nor a month among {cols}")
        weight_date = F.lit(None).cast("date")
        month_num = month_number(found["month"], _dtype(df, found["month"]))
        if found["year"] is not None:
            year = whole_number(found["year"], _dtype(df, found["year"]))
        else:
            year = F.lit(resolve_weight_year(afi, weight_year))
    group = (clean_group(found["group"], _dtype(df, found["group"]), group_mapping)
             if found["group"] else F.lit(None).cast("int"))
    weight = to_double(found["weight"], _dtype(df, found["weight"]))
    df = df.filter(id_present(found["animal"], _dtype(df, found["animal"])) & weight.isNotNull()
                   & year.isNotNull() & month_num.isNotNull())
    out = df.select(
        clean_id(found["animal"], _dtype(df, found["animal"])).alias("animal_id"),
        weight.alias("weight"),
        weight_date.alias("weight_date"),
        year.cast("int").alias("year"),
        month_num.cast("int").alias("month_num"),
        group.alias("weight_group"),
    )
    return mark_non_null(out, ["animal_id", "weight", "year", "month_num"])


def day_bits(day: Column | str) -> Column:
    """A bit for each day of the month that a group holds; NULL if every day is NULL."""
    day = F.col(day) if isinstance(day, str) else day
    return F.bit_or(F.call_function("shiftleft", F.lit(1), F.day(day) - 1))


def count_bits(bits: Column) -> Column:
    return F.coalesce(F.bit_count(bits), F.lit(0)).cast("long")


def days_in_month(day: Column | str) -> Column:
    """Number of distinct days, for groups that lie within one month: no distinct level is needed.
    0 if every day is NULL."""
    return count_bits(day_bits(day))


def agg_month_weight(weights: DataFrame) -> DataFrame:
    """A1: one row per animal-month: mean weight, latest weight date, most frequent
    group."""
    by_group = weights.groupBy(*ANIMAL_MONTH, "weight_group").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("total"), F.count("weight").alias("weighed"), F.max("weight_date").alias("weight_date"))
    return (by_group.groupBy(*ANIMAL_MONTH)
            .agg((F.sum("total") / F.nullif(F.sum("weighed"), F.lit(0))).alias("weight"),
                 F.max("weight_date").alias("weight_date"),
                 mode_of(F.max(mode_rank("weight_group", "n"))).alias("weight_group"))
            .withColumn("month", month_name_of("year", "month_num")))


def monthly_weights(raw: DataFrame, afi: DataFrame | None = None, weight_year: int | None = None,
                    group_mapping: Mapping[str, int] | None = None) -> DataFrame:
    """Standardised weights averaged to one row per animal-month."""
    return agg_month_weight(standardize_weights(raw, afi, weight_year, group_mapping))


def agg_animal_month_group(afi: DataFrame) -> DataFrame:
    """A2: one row per animal-month from the daily data: most frequent group, mean DIM,
    first/last day and number of distinct days."""
    require_columns(afi, ["animal_id", "year", "month_num", "group", "dim"], "afi")
    by_group = drop_missing(afi, ANIMAL_MONTH).groupBy(*ANIMAL_MONTH, "group").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dim").alias("total_dim"), F.count("dim").alias("n_dim"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), day_bits("day").alias("days"))
    return (by_group.groupBy(*ANIMAL_MONTH)
            .agg(mode_of(F.max(mode_rank("group", "n"))).alias("group"),
                 (F.sum("total_dim") / F.nullif(F.sum("n_dim"), F.lit(0))).alias("avg_dim"),
                 F.min("first_day").alias("first_day"),
                 F.max("last_day").alias("last_day"),
                 count_bits(F.bit_or("days")).alias("n_afi_days"))
            .withColumn("month", month_name_of("year", "month_num")))


def join_month_weight(animal_month: DataFrame, weights: DataFrame) -> DataFrame:
    """J1 + C19 + F6: animal-month groups x animal-month weights (1:1 inner join);
    group filled from the weight file, rows without group or weight dropped."""
    joined = animal_month.join(
        weights.select(*ANIMAL_MONTH, "weight", "weight_date", "weight_group"), ANIMAL_MONTH, "inner")
    joined = joined.withColumn("group", F.coalesce("group", "weight_group").cast("int"))
    return joined.dropna(subset=["group", "weight"]).select(
        "animal_id", "year", "month_num", "group", "avg_dim", "first_day", "last_day",
        "n_afi_days", "month", "weight", "weight_date", "weight_group")


def join_daily_weight(afi: DataFrame, weights: DataFrame) -> DataFrame:
    """Daily rows x animal-month weights (many:1 inner join)."""
    return (afi.select("animal_id", "day", "dim", "year", "month_num", "month", "group")
            .join(weights.select(*ANIMAL_MONTH, "weight"), ANIMAL_MONTH, "inner")
            .select("animal_id", "day", "dim", "year", "month_num", "month", "group", "weight"))


def merge_dim_weights(afi: DataFrame, weights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """T4: (daily rows with their monthly weight, one row per animal-month)."""
    return join_daily_weight(afi, weights), join_month_weight(agg_animal_month_group(afi), weights)


def cow_month_weight_table(cow_month_weight: DataFrame) -> DataFrame:
    """Display names of the animal-month weight table (``weight_group`` kept as is)."""
    names = {"animal_id": "Farm Animal ID", "year": "Year", "month_num": "Month Num",
             "month": "Month", "group": "Group", "avg_dim": "Avg DIM", "weight": "Weight",
             "weight_date": "Weight Date", "n_afi_days": "N AFI Days",
             "first_day": "First AFI Day", "last_day": "Last AFI Day"}
    return cow_month_weight.select([F.col(c).alias(names.get(c, c)) for c in cow_month_weight.columns])


def dim_weights_merged(dim_weights_daily: DataFrame) -> DataFrame:
    """T5 (table 3.2)."""
    return dim_weights_daily.select(
        F.col("animal_id").alias("Farm Animal ID"),
        F.col("day").alias("File Date"),
        F.col("dim").alias("DIM"),
        F.col("weight").alias("Weight"),
    )


# --------------------------------------------------------------------------- summaries

def agg_group_day(afi: DataFrame) -> DataFrame:
    """A3: per day and group: mean DIM, mean/sd of daily yield, distinct animals."""
    require_columns(afi, ["animal_id", "day", "month", "group", "dim", "daily_yield"], "afi")
    # Year and month follow from the day, so only the day and the group are shuffled.
    out = (drop_missing(afi, ["day", "group", "daily_yield"]).groupBy("day", "group")
           .agg(F.avg("dim").alias("avg_dim"),
                F.avg("daily_yield").alias("avg_daily_yield"),
                sd_samp("daily_yield").alias("yield_std"),
                F.countDistinct("animal_id").alias("n_animals")))
    return out.withColumns(calendar_parts("day")).select(
        "day", "year", "month_num", "month", "group", "avg_dim", "avg_daily_yield", "yield_std", "n_animals")


def yield_group_day(afi: DataFrame, confidence_level: float = 0.80) -> DataFrame:
    """T6 (table 3.3): daily group yield with Student-t confidence interval. The SE uses
    the row-level sd over the number of distinct animals."""
    g = agg_group_day(afi).withColumn("se", standard_error("yield_std", "n_animals"))
    g = add_t_interval(g, "avg_daily_yield", "se", "n_animals", confidence_level)
    return g.select(
        F.col("day").alias("Day"), F.col("year").alias("Year"), F.col("month").alias("Month"),
        F.col("month_num").alias("Month Num"), F.col("group").alias("Group"),
        F.col("avg_dim").alias("Avg DIM"), F.col("avg_daily_yield").alias("Avg Daily Yield"),
        F.col("yield_std").alias("Yield STD"), F.col("n_animals").alias("N Animals"),
        F.col("se").alias("SE"), F.col("t_value").alias("T Value"),
        F.col("ci_lower").alias("CI Lower"), F.col("ci_upper").alias("CI Upper"))


def agg_animal_month(afi: DataFrame) -> DataFrame:
    """A4: per animal, month and group: mean daily yield, distinct days, mean DIM,
    first/last day."""
    keys = [*ANIMAL_MONTH, "group"]
    out = (drop_missing(afi, ["day", "daily_yield"] + keys).groupBy(*keys)
           .agg(F.avg("daily_yield").alias("avg_monthly_yield"),
                days_in_month("day").alias("n_days"),
                F.avg("dim").alias("avg_dim"),
                F.min("day").alias("first_day"),
                F.max("day").alias("last_day")))
    return out.withColumn("month", month_name_of("year", "month_num")).select(
        *ANIMAL_MONTH, "month", "group", "avg_monthly_yield", "n_days", "avg_dim", "first_day", "last_day")


def animal_month_yield(afi: DataFrame) -> DataFrame:
    """First stage of table 3.4 with display names."""
    a = agg_animal_month(afi)
    names = {"animal_id": "Farm Animal ID", "year": "Year", "month_num": "Month Num",
             "month": "Month", "group": "Group", "avg_monthly_yield": "Avg Monthly Yield",
             "n_days": "N Days", "avg_dim": "Avg DIM", "first_day": "First Day", "last_day": "Last Day"}
    return a.select([F.col(c).alias(n) for c, n in names.items()])


def agg_group_month(animal_month: DataFrame, assume_unique: bool = False) -> DataFrame:
    """A5: second stage over animal means: mean/sd of the animal means and distinct
    animals per year, month and group (input uses display names). ``assume_unique``: each
    animal has one row a month and group, as from :func:`animal_month_yield`, so animals are
    counted as rows, without the second shuffle of a distinct count."""
    require_columns(animal_month, ["Farm Animal ID", "Year", "Month Num", "Month", "Group",
                                   "Avg Monthly Yield"], "animal_month_yield")
    keys = ["Year", "Month Num", "Group"]
    out = (drop_missing(animal_month, ["Avg Monthly Yield"] + keys).groupBy(*keys)
           .agg(F.avg("Avg Monthly Yield").alias("avg_monthly_yield"),
                sd_samp("Avg Monthly Yield").alias("yield_std"),
                (F.count if assume_unique else F.countDistinct)("Farm Animal ID").alias("n_animals")))
    return out.withColumn("Month", month_name_of("Year", F.col("Month Num"))).select(
        "Year", "Month Num", "Month", "Group", "avg_monthly_yield", "yield_std", "n_animals")


def yield_group_month(animal_month: DataFrame, confidence_level: float = 0.80, assume_unique: bool = False) -> DataFrame:
    """T7b (table 3.4): monthly group yield with Student-t confidence interval."""
    g = agg_group_month(animal_month, assume_unique).withColumn("se", standard_error("yield_std", "n_animals"))
    g = add_t_interval(g, "avg_monthly_yield", "se", "n_animals", confidence_level)
    return g.select(
        "Year", "Month Num", "Month", "Group",
        F.col("avg_monthly_yield").alias("Avg Monthly Yield"), F.col("yield_std").alias("Yield STD"),
        F.col("n_animals").alias("N Animals"), F.col("se").alias("SE"),
        F.col("t_value").alias("T Value"), F.col("ci_lower").alias("CI Lower"),
        F.col("ci_upper").alias("CI Upper"))


def dedupe_animal_month(cow_month_weight: DataFrame, assume_unique: bool = False) -> DataFrame:
    """One row per (animal, year, month, group). ``assume_unique`` skips the shuffle
    when the input comes from :func:`join_month_weight` (unique by construction)."""
    if assume_unique:
        return cow_month_weight
    return cow_month_weight.dropDuplicates(["animal_id", "year", "month_num", "group"])


def agg_weight_group(cow_month_weight: DataFrame, assume_unique: bool = False) -> DataFrame:
    """Per year, month and group: distinct animals, mean/sd weight."""
    require_columns(cow_month_weight, ["animal_id", "year", "month_num", "month", "group", "weight"],
                    "cow_month_weight")
    keys = ["year", "month_num", "group"]
    base = dedupe_animal_month(drop_missing(cow_month_weight, [*keys, "weight"]), assume_unique)
    # One row an animal, month and group by now: animals are counted as rows.
    out = base.groupBy(*keys).agg(F.count("animal_id").alias("n_animals"), F.avg("weight").alias("avg_weight"),
                                  sd_samp("weight").alias("weight_std"))
    return out.withColumn("month", month_name_of("year", "month_num")).select(
        "year", "month_num", "month", "group", "n_animals", "avg_weight", "weight_std")


def weight_group(cow_month_weight: DataFrame, assume_unique: bool = False) -> DataFrame:
    """T7c (table 3.5): monthly group body weight, SE but no interval."""
    g = agg_weight_group(cow_month_weight, assume_unique)
    return g.select(
        F.col("year").alias("Year"), F.col("month_num").alias("Month Num"),
        F.col("month").alias("Month"), F.col("group").alias("Group"),
        F.col("n_animals").alias("N Animals"), F.col("avg_weight").alias("Avg Weight"),
        F.col("weight_std").alias("Weight STD"),
        standard_error("weight_std", "n_animals").alias("SE"))


def agg_per_animal(afi: DataFrame) -> DataFrame:
    """Duplicate animal-days collapsed first (mean yield, mean DIM, most frequent
    group), then per animal: most frequent group, mean DIM, days, mean/sd of daily
    yield, first/last day."""
    by_group = drop_missing(afi, ["animal_id", "day", "daily_yield"]).groupBy("animal_id", "day", "group").agg(
        F.count(F.lit(1)).alias("n"), F.sum("daily_yield").alias("total"), F.sum("dim").alias("total_dim"), F.count("dim").alias("n_dim"))
    daily = by_group.groupBy("animal_id", "day").agg(
        (F.sum("total") / F.sum("n")).alias("daily_yield"), (F.sum("total_dim") / F.nullif(F.sum("n_dim"), F.lit(0))).alias("dim"),
        mode_of(F.max(mode_rank("group", "n"))).alias("group"))
    # Days of an animal by group, with their yields' count, mean and sum of squared deviations.
    groups = daily.groupBy("animal_id", "group").agg(
        F.count(F.lit(1)).alias("n"), F.avg("daily_yield").alias("mean"), F.var_pop("daily_yield").alias("spread"),
        F.sum("dim").alias("total_dim"), F.count("dim").alias("n_dim"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return groups.groupBy("animal_id").agg(
        mode_of(F.max(mode_rank("group", "n"))).alias("group"),
        (F.sum("total_dim") / F.nullif(F.sum("n_dim"), F.lit(0))).alias("avg_dim"),
        F.sum("n").alias("n_days"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("avg_daily_yield"),
        pooled_sd("n", "mean", "spread").alias("yield_std"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"))


def per_cow_yield(afi: DataFrame, confidence_level: float = 0.80) -> DataFrame:
    """T7d: per-animal daily yield summary with Student-t interval over days."""
    g = agg_per_animal(afi).withColumn("se", standard_error("yield_std", "n_days"))
    g = add_t_interval(g, "avg_daily_yield", "se", "n_days", confidence_level)
    return g.select(
        F.col("animal_id").alias("Farm Animal ID"), F.col("group").alias("Group"),
        F.col("avg_dim").alias("Avg DIM"), F.col("n_days").alias("N Days"),
        F.col("avg_daily_yield").alias("Avg Daily Yield"), F.col("yield_std").alias("Yield STD"),
        F.col("se").alias("SE"), F.col("t_value").alias("T Value"),
        F.col("ci_lower").alias("CI Lower"), F.col("ci_upper").alias("CI Upper"),
        F.col("first_day").alias("First Day"), F.col("last_day").alias("Last Day"))
