"""File sources: daily Parquet directories, CSV / delimited text, schema-drift unions.

Everything here is a Spark reader. File listing is done by Spark's own file index
(``pathGlobFilter`` / ``recursiveFileLookup``), schemas are merged by Spark, and the
only driver-side loop is over *distinct schemas*, never over rows.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_from_filename
from .headers import normalize_name, snake_case
from .records import ends_open, header_records, quoted_records

# Text that the CSV reader of the reference treats as missing.
CSV_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SUPPORTED_SUFFIXES = ("csv", "txt", "tsv", "parquet", "pq")
SNIFF_SEPARATORS = (",", "\t", ";", "|")
# Separator by suffix; None: each file's own.
SEPARATORS = {"csv": ",", "tsv": "\t", "txt": None}


def _ci_glob(suffix: str) -> str:
    """Case-insensitive glob for a suffix, e.g. ``*.[cC][sS][vV]``."""
    return "*." + "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in suffix)


def _escaped(path: str) -> str:
    """A path in which no character has a meaning for globs."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path.rstrip("/"))


def _plain_name(name: Column) -> Column:
    """A file's name from its URI, where a blank is %20, but + stands for itself."""
    return F.when(F.contains(name, F.lit("%")), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def with_provenance(df: DataFrame, file_col: str = "source_file", date_col: str | None = None) -> DataFrame:
    """File name of every row (from the scan's hidden metadata) and, optionally,
    the date encoded in that name (C3)."""
    df = df.withColumn(file_col, _plain_name(F.col("_metadata.file_name")))
    if date_col:
        df = df.withColumn(date_col, date_from_filename(F.col(file_col)))
    return df


def null_na_strings(df: DataFrame, na_values: Sequence[str] = CSV_NA_VALUES) -> DataFrame:
    """Map CSV missing-value words to NULL in every string column."""
    return df.select([
        F.when(~F.col(f"`{f.name}`").isin(*na_values), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def separator_of(header: str) -> str:
    """The separator that occurs most often in a header line; a comma if none does."""
    return max(SNIFF_SEPARATORS, key=header.count)


def scan_order() -> Column:
    """Where a row stands in its source: file, split, place in the split. Unlike a row id it
    doesn't depend on how splits are packed into tasks. Only usable right above a scan."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                    F.monotonically_increasing_id().alias("row"))


def header_lines(spark: SparkSession, path: str | Sequence[str], sep: str | None = None, glob: str | None = None,
                 recursive: bool = False) -> list[tuple[str, str, bool]]:
    """``(file, first line that is not blank, broken?)`` of each file, in the order of their names;
    broken says that a quoted field may break a line, or that the first split is blank. By one distributed pass over the lines; a row a file comes to the
    driver, where Spark's own file listing is as well. Files of blank lines are left out."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    lines = reader.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"), scan_order().alias("order"), F.regexp_replace("value", "^\\ufeff", "").alias("value"))
    line = F.col("value")
    odd = F.contains(line, F.lit('"')) & ((F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1)
    shown = F.when(F.rlike(line, F.lit(r"\S")), F.col("order"))
    files = lines.groupBy("file").agg(F.min_by("value", shown).alias("header"), F.max(odd | ends_open(line, (sep,) if sep else SNIFF_SEPARATORS)).alias("broken"), F.min(shown).alias("first"))
    # Spark's reader looks for a header in a file's first split only.
    files = files.select("file", "header", (F.col("broken") | (F.col("first.at") > 0)).alias("broken"))
    return [(unquote(file), header.rstrip("\r"), broken) for file, header, broken in sorted(files.filter("header IS NOT NULL").collect())]


def _column_names(header: str, sep: str) -> list[str]:
    """Names of a header record. An empty name is called by its place; of names that differ in
    case at most the later ones get ``.1``, ``.2``, ..., as Spark's names ignore case."""
    names: list[str] = []
    used: set[str] = set()
    for at, cell in enumerate(next(csv.reader([header], delimiter=sep), [])):
        name = plain = cell if cell.strip() else f"Unnamed: {at}"
        k = 0
        while name.lower() in used:
            k += 1
            name = f"{plain}.{k}"
        names.append(name)
        used.add(name.lower())
    return names


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)


def _grouped(keyed: Iterable[tuple[tuple, str]]) -> dict[tuple, list[str]]:
    groups: dict[tuple, list[str]] = {}
    for key, file in keyed:
        groups.setdefault(key, []).append(file)
    return groups


def read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str | None = ",",
                   glob: str | None = None, recursive: bool = False,
                   na_values: Sequence[str] | None = CSV_NA_VALUES, order_col: str | None = None) -> DataFrame:
    """Header CSV or delimited text, every column read as text (no inference pass);
    cleaning functions type the columns afterwards.

    Each file is read by its own header, the first record that is not blank, and with ``sep=None``
    by its own separator: files are grouped by header, a group is one scan, and groups are unioned
    by name. Files in which a quoted field may break a line are read by :func:`quoted_records`,
    so they are split as all others are. ``order_col`` adds :func:`scan_order`."""
    frames: list[DataFrame] = []
    # quotes inside quoted fields are doubled ("a ""b"" c"), as CSV writers do
    options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}

    def schema_of(header: str, own: str) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in _column_names(header, own)])

    def take(df: DataFrame) -> None:
        frames.append(null_na_strings(df, na_values) if na_values else df)

    found = header_lines(spark, path, sep, glob, recursive)
    for (header,), files in _grouped(((header,), file) for file, header, broken in found if not broken).items():
        own = sep or separator_of(header)
        df = spark.read.schema(schema_of(header, own)).options(header=True, sep=own, **options).csv([*map(_escaped, files)])
        take(with_provenance(df.withColumn(order_col, scan_order()) if order_col else df))
    for (own,), files in _grouped(((sep or separator_of(header),), file) for file, header, broken in found if broken).items():
        for (header,), files in _grouped(((header,), unquote(file)) for file, header in header_records(spark, files, (own,), _escaped)).items():
            schema = schema_of(header, own)
            df = quoted_records(spark, [*map(_escaped, files)], (own,)).filter(~F.col("is_header") & (F.trim("record") != ""))
            df = df.withColumn("record", F.from_csv("record", _ddl(schema), {**options, "sep": own}))
            df = df.select(*[F.col("record").getField(f.name).alias(f.name) for f in schema.fields],
                           *([F.col("order").alias(order_col)] if order_col else []), _plain_name(F.col("file_name")).alias("source_file"))
            take(df)
    if not frames:
        raise FileNotFoundError(f"no delimited file with a header in {path}")
    return _union_spellings(frames) if len(frames) > 1 else frames[0]


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def _plain(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", path).rstrip("/")


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, by the file system and not by its name."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_escaped(path)).select("path").limit(1).collect())
    return not listed or not _plain(unquote(listed[0][0])).endswith(_plain(path))


def _is_file(spark: SparkSession, path: str) -> bool:
    try:
        return not is_folder(spark, path)
    except AnalysisException as exc:
        if _nothing_there(exc):
            return False
        raise


def read_table_file(spark: SparkSession, path: str, sep: str | None = None, order_col: str | None = None) -> DataFrame:
    """One table file chosen by suffix, with a ``source_file`` column. ``order_col``
    adds :func:`scan_order`, for rules by which the last row wins."""
    suffix = _suffix(path)
    if suffix in ("parquet", "pq"):
        df = spark.read.parquet(path)
        return with_provenance(df.withColumn(order_col, scan_order()) if order_col else df)
    if suffix in SEPARATORS:
        return read_delimited(spark, path, sep or SEPARATORS[suffix], order_col=order_col)
    if suffix in ("xlsx", "xls"):
        raise ValueError(f"spreadsheets are not read by this library; convert {path} to CSV or Parquet")
    raise ValueError(f"{path}: not one of the file types {SUPPORTED_SUFFIXES}")


def _nothing_there(exc: Exception) -> bool:
    return any(word in str(exc) for word in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "does not exist"))


def _types_conflict(exc: Exception) -> bool:
    return "CANNOT_MERGE" in str(exc) or "Failed merging schema" in str(exc)


def _read_parquet_files(spark: SparkSession, path: str, glob: str, recursive: bool) -> list[DataFrame]:
    """All Parquet files of a folder (with ``recursive``, of its sub-folders too) or one file: one
    scan if Spark can merge their schemas, else one for each set of types. Empty if there are none.

    Without ``recursive`` the files themselves are handed to Spark, by a glob over the folder: a
    sub-folder named like a partition adds neither rows nor columns."""
    if recursive:
        reader, paths = (lambda: spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)), [_escaped(path)]
    else:
        reader, paths = (lambda: spark.read), [f"{_escaped(path)}/{glob}"]
    try:
        merged = reader().option("mergeSchema", True).parquet(*paths)
        merged.schema  # noqa: B018 - forces the schema merge now
        return [with_provenance(merged)]
    except Exception as exc:  # noqa: BLE001 - the merge conflict is no AnalysisException
        if _nothing_there(exc):
            return [with_provenance(spark.read.parquet(_escaped(path)))] if not recursive and _is_file(spark, path) else []
        if not _types_conflict(exc):
            raise
    files = sorted(unquote(f) for f in reader().schema("none string").parquet(*paths).inputFiles())
    return [with_provenance(spark.read.schema(schema).parquet(*map(_escaped, own))) for schema, own in files_by_types(spark, files)]


def files_by_types(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files in groups whose schemas Spark can merge, with the merged schemas. A list that it can't
    merge is halved; groups that agree on the types of the columns they share are joined again.
    Only Spark reads the footers, so any file system that it reaches will do."""
    groups: list[tuple[T.StructType, list[str]]] = []
    lists = [list(files)]
    while lists:
        own = lists.pop()
        try:
            schema = spark.read.option("mergeSchema", True).parquet(*map(_escaped, own)).schema
        except Exception as exc:  # noqa: BLE001 - the merge conflict is no AnalysisException
            if len(own) == 1 or not _types_conflict(exc):
                raise
            half = len(own) // 2
            lists += [own[half:], own[:half]]
            continue
        for k, (known, held) in enumerate(groups):
            types = {f.name.lower(): f.dataType for f in known}
            if all(types.get(f.name.lower(), f.dataType) == f.dataType for f in schema):
                groups[k] = (T.StructType(known.fields + [f for f in schema if f.name.lower() not in types]), held + own)
                break
        else:
            groups.append((schema, own))
    return groups


def read_feed_files(spark: SparkSession, path: str, txt_sep: str | None = None) -> DataFrame:
    """S3: every supported file under a directory (recursive, hidden files skipped by
    Spark's file index), unioned by name with drift handling. Each delimited file is read by
    its own header; a ``.txt`` file by ``txt_sep``, else by its own separator."""
    frames: list[DataFrame] = []
    for suffix in ("parquet", "pq"):
        frames += _read_parquet_files(spark, path, _ci_glob(suffix), recursive=True)
    for suffix, sep in SEPARATORS.items():
        try:
            frames.append(read_delimited(spark, _escaped(path), txt_sep if suffix == "txt" else sep, glob=_ci_glob(suffix), recursive=True))
        except (AnalysisException, FileNotFoundError) as exc:
            if isinstance(exc, AnalysisException) and not _nothing_there(exc):
                raise
    if not frames:
        raise FileNotFoundError(f"no file of the types {SUPPORTED_SUFFIXES} in {path}")
    return _union_spellings(frames)


def merge_header_spellings(df: DataFrame, rename) -> DataFrame:
    """Rename columns with ``rename``; columns that land on the same name are merged
    with ``coalesce`` (they came from different files, so at most one is set)."""
    groups: dict[str, list[T.StructField]] = {}
    for f in df.schema.fields:
        groups.setdefault(rename(f.name), []).append(f)
    cols: list[Column] = []
    for name, fields in groups.items():
        if len(fields) == 1:
            cols.append(F.col(f"`{fields[0].name}`").alias(name))
            continue
        types = {f.dataType.simpleString() for f in fields}
        target = fields[0].dataType if len(types) == 1 else _common_type([f.dataType for f in fields])
        cols.append(F.coalesce(*[F.col(f"`{f.name}`").cast(target) for f in fields]).alias(name))
    return df.select(cols)


def _common_type(types: Sequence[T.DataType]) -> T.DataType:
    """Type that holds all values of conflicting types: integers widen to the widest integer;
    integers of up to 32 bits and fractions to double; 64-bit integers (ids) and fractions to
    text, which keeps every digit; dates to timestamps; all else to text."""
    integers = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    fractions = (T.FloatType, T.DoubleType, T.DecimalType)
    if all(isinstance(t, integers) for t in types):
        return max(types, key=lambda t: [isinstance(t, kind) for kind in integers].index(True))
    if all(isinstance(t, integers[:3] + fractions) for t in types):
        return T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in types):
        return T.TimestampNTZType() if any(isinstance(t, T.TimestampNTZType) for t in types) else T.TimestampType()
    return T.StringType()


def union_by_name(frames: Sequence[DataFrame], snake: bool = True) -> DataFrame:
    """Snake-case each frame, widen conflicting column types, then
    ``unionByName(allowMissingColumns=True)``."""
    rename = snake_case if snake else (lambda n: n)
    frames = [merge_header_spellings(df, rename) for df in frames]
    seen: dict[str, list[T.DataType]] = {}
    for df in frames:
        for f in df.schema.fields:
            seen.setdefault(f.name, []).append(f.dataType)
    target = {
        name: (types[0] if len({t.simpleString() for t in types}) == 1 else _common_type(types))
        for name, types in seen.items()
    }
    aligned = [df.select([F.col(f"`{c}`").cast(target[c]).alias(c) for c in df.columns]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def _union_spellings(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, in which headers of the same words (``Feeding Date``, ``feeding_date``) are one
    column, spelt as in the first frame that has it. Two such headers of one frame stay apart: there
    the rule for one file decides which is meant."""
    spelt: dict[str, str] = {}
    out = []
    for df in frames:
        words = [normalize_name(c) for c in df.columns]
        names = [spelt.setdefault(w, c) if w and words.count(w) == 1 else c for w, c in zip(words, df.columns)]
        out.append(df.toDF(*names))
    return union_by_name(out, snake=False)


def scan_daily(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """Every ``*.parquet`` file of a directory as one DataFrame with
    snake-cased headers plus ``source_file`` and ``source_file_date``.

    Files whose headers differ only in spelling are merged by Spark's schema merge and
    the spellings coalesced. When a column's *type* differs between files (schema merge
    refuses), files are grouped by what Spark can merge (:func:`files_by_types`), and each
    group is read once and unioned with widened types."""
    frames = _read_parquet_files(spark, directory, "*.parquet", recursive)
    if not frames:
        raise FileNotFoundError(f"no *.parquet file in {directory}")
    out = merge_header_spellings(frames[0], snake_case) if len(frames) == 1 else union_by_name(frames)
    return out.withColumn("source_file_date", date_from_filename(F.col("source_file")))
