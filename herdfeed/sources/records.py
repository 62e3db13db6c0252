"""Records of delimited files whose quoted fields go over line breaks, without reading a file whole.

Whether a line begins a record depends on all lines before it. What one line does to that state is
known from the line alone: it leaves it, turns it round, or sets it. These effects are put together
within each split, then over the splits of a file (a row a split), so every line learns its state
from its own split and the state that the split begins in. Lines are shuffled by split, then by
record; Spark's own parser reads the records.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _opens(text: Column, seps: Sequence[str]) -> Column:
    """Whether an opening quote (at the beginning or behind a separator) is left when all quoted
    fields that end are taken away. Doubled quotes must have been taken away before."""
    begin = "(^|" + "|".join(re.escape(s) for s in seps) + ")"
    return F.regexp_like(F.regexp_replace(text, begin + '"[^"]*"', "$1"), F.lit(begin + '"'))


def ends_open(line: Column, seps: Sequence[str]) -> Column:
    """Whether a line that begins outside of quotes ends inside of them."""
    return F.when(F.contains(line, F.lit('"')), _opens(F.replace(line, F.lit('""'), F.lit("")), seps)).otherwise(False)


def stays_open(line: Column, seps: Sequence[str]) -> Column:
    """Whether a line that begins inside of quotes ends inside of them."""
    plain = F.replace(line, F.lit('""'), F.lit(""))
    close = F.instr(plain, '"')
    behind = F.concat(F.lit("x"), F.substr(plain, close + 1))
    return F.when(F.contains(line, F.lit('"')) & (close > 0), _opens(behind, seps)).otherwise(True)


def _put_together(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Effects of all rows up to each: ``sets`` (the state, whatever it was; NULL if none set it)
    and ``turns`` (whether it is turned round), and of all rows before it (``sets_before``,
    ``turns_before``)."""
    rows = Window.partitionBy(*by).orderBy(order)
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("turned", F.sum(F.col("turns").cast("int")).over(upto))
    df = df.withColumn("turned_then", F.last(F.when(F.col("sets").isNotNull(), F.col("turned")), True).over(upto))
    df = df.withColumns({"sets": F.last("sets", True).over(upto) != ((F.col("turned") - F.col("turned_then")) % 2 == 1), "turns": F.col("turned") % 2 == 1})
    return df.withColumns({"sets_before": F.lag("sets").over(rows), "turns_before": F.coalesce(F.lag("turns").over(rows), F.lit(False))}).drop("turned", "turned_then")


def _lines(spark: SparkSession, files: Sequence[str], first_splits: bool) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(list(files)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("row"), F.regexp_replace("value", "^\\ufeff", "").alias("value"))
    return lines.filter("at = 0") if first_splits else lines


def _shown() -> Column:
    """The row of a line that is not blank."""
    return F.when(F.rlike(F.col("value"), F.lit(r"\S")), F.col("row"))


def quoted_records(spark: SparkSession, files: Sequence[str], seps: Sequence[str], first_splits: bool = False) -> DataFrame:
    """``file, file_name, order, record, is_header, is_open``: all records of the files, or those of
    each file's first split. The header is the first record with a line that is not blank; ``is_open``
    says that a record ends inside of quotes, as the last one of a first split may.

    Line breaks inside quotes are kept as they are. A quote that is never closed makes the rest of
    its file one record, as for any reader of such files.
    """
    lines = _lines(spark, files, first_splits)
    opened, open_still = ends_open(F.col("value"), seps), stays_open(F.col("value"), seps)
    lines = lines.withColumns({"sets": F.when(opened == open_still, opened), "turns": opened & ~open_still})
    lines = _put_together(lines, ["file", "at"], "row")

    def begins(split_open: Column) -> Column:
        return ~F.coalesce("sets_before", split_open != F.col("turns_before"))

    splits = lines.groupBy("file", "at").agg(
        F.max_by(F.struct("sets", "turns"), "row").alias("effect"), F.max(F.when(begins(F.lit(False)), F.col("row"))).alias("last_if_closed"),
        F.max(F.when(begins(F.lit(True)), F.col("row"))).alias("last_if_open"),
        F.min(_shown()).alias("shown"))
    splits = _put_together(splits.select("file", "at", "effect.*", "last_if_closed", "last_if_open", "shown"), ["file"], "at")
    is_open = F.coalesce("sets_before", "turns_before")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(is_open, F.col("last_if_open")).otherwise(F.col("last_if_closed"))
    splits = splits.withColumns({"split_open": is_open, "last": last, "first": F.min(F.when(F.col("shown").isNotNull(), F.struct("at", F.col("shown").alias("row")))).over(Window.partitionBy("file"))}).withColumn(
        "earlier", F.last(F.when(F.col("last").isNotNull(), F.struct("at", F.col("last").alias("row"))), True).over(before))

    # Lines stay dealt by split; the hint keeps Spark from gathering a file's lines where its few splits are.
    lines = lines.join(splits.select("file", "at", "split_open", "earlier", "first").hint("merge"), ["file", "at"])
    upto = Window.partitionBy("file", "at").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.last(F.when(begins(F.col("split_open")), F.col("row")), True).over(upto)
    of = F.when(begun.isNotNull(), F.struct("at", begun.alias("row"))).otherwise(F.col("earlier"))
    lines = lines.withColumns({"of": of, "is_open": F.coalesce("sets", F.col("split_open") != F.col("turns"))})
    records = lines.groupBy("file", "of").agg(
        F.first("file_name").alias("file_name"), F.first(F.coalesce(F.col("of") == F.col("first"), F.lit(False))).alias("is_header"),
        F.max_by("is_open", F.struct("at", "row")).alias("is_open"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "row", "value"))), lambda x: x["value"]), "\n").alias("record"))
    return records.select("file", "file_name", F.struct("file", F.col("of.at").alias("at"), F.col("of.row").alias("row")).alias("order"),
                          F.regexp_replace("record", "\r$", "").alias("record"), "is_header", "is_open")


def header_records(spark: SparkSession, files: Sequence[str], seps: Sequence[str], as_path: Callable[[str], str] = str) -> list[tuple[str, str]]:
    """``(file, header record)`` of each file that has one, by its first split; all splits are read
    only of files whose header goes further. A row a file comes to the driver.

    Blank lines hold no quote, so the first line that is not blank begins outside of quotes. Where it
    ends outside of them as well it is the header, without putting any other line in its record."""
    paths = lambda: [*map(as_path, files)]
    heads = _lines(spark, paths(), True).groupBy("file").agg(F.min_by("value", _shown()).alias("line"))
    heads = heads.filter("line IS NOT NULL").filter(~ends_open(F.col("line"), seps)).select("file", F.regexp_replace("line", "\r$", "").alias("record"))
    found: dict[str, str] = dict(map(tuple, heads.collect()))
    for first_splits in (True, False):
        files = [f for f in files if f not in {unquote(file) for file in found}]
        if not files:
            break
        rows = quoted_records(spark, paths(), seps, first_splits).filter("is_header").select("file", "record", "is_open").collect()
        found |= {file: record for file, record, is_open in rows if not (first_splits and is_open)}
    return sorted(found.items())
