import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from herdfeed.sinks import coerce_dates, list_csv_tables, load_csv_directory, round_floats, write_jdbc, write_table
from herdfeed.sources.files import read_delimited, read_feed_files, read_table_file, scan_daily, union_by_name
from herdfeed.sources.mapping import apply_ingredient_map, ingredient_map


def test_scan_daily_type_drift_and_provenance(spark, tmp_dir):
    pd.DataFrame({"Farm Animal ID": [1, 2], "Grp": ["G1", "pack"], "DIM": [10.0, 20.0], "Yield": [30.0, 31.0]}
                 ).to_parquet(os.path.join(tmp_dir, "afi_20240105.parquet"), index=False)
    pd.DataFrame({"farm_animal_id": ["3", "A4"], "grp": ["2", "G2"], "dim": [1.0, 2.0]}
                 ).to_parquet(os.path.join(tmp_dir, "afi_2024-1-6.parquet"), index=False)
    open(os.path.join(tmp_dir, "notes.txt"), "w").write("ignored")
    df = scan_daily(spark, tmp_dir)
    assert set(df.columns) >= {"farm_animal_id", "grp", "dim", "yield", "source_file", "source_file_date"}
    got = sorted((r.farm_animal_id, r.source_file, r.source_file_date) for r in df.collect())
    assert got == [("1", "afi_20240105.parquet", dt.date(2024, 1, 5)), ("2", "afi_20240105.parquet", dt.date(2024, 1, 5)),
                   ("3", "afi_2024-1-6.parquet", dt.date(2024, 1, 6)), ("A4", "afi_2024-1-6.parquet", dt.date(2024, 1, 6))]
    from herdfeed.operators import herd
    afi = herd.standardize_daily(df)
    assert afi.count() == 4 and afi.filter(F.col("daily_yield").isNull()).count() == 2


def test_scan_daily_header_spelling_drift_merges(spark, tmp_dir):
    pd.DataFrame({"Cow ID": [1], "Grp": ["G1"], "DIM": [10.0], "Yield": [30.0]}).to_parquet(
        os.path.join(tmp_dir, "a_20240105.parquet"), index=False)
    pd.DataFrame({"cow_id": [2], "grp": ["G2"], "dim": [11.0], "yield": [31.0]}).to_parquet(
        os.path.join(tmp_dir, "b_20240106.parquet"), index=False)
    df = scan_daily(spark, tmp_dir)
    assert sorted(r.cow_id for r in df.collect()) == [1, 2]


def test_scan_daily_missing_dir(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        scan_daily(spark, os.path.join(tmp_dir, "nope"))


def test_union_by_name_widens(spark):
    a = spark.createDataFrame([(1, 2.0)], "Order_Key bigint, qty double")
    b = spark.createDataFrame([("K1", 1)], "order_key string, line int")
    u = union_by_name([a, b])
    assert dict(u.dtypes)["order_key"] == "string"
    assert sorted((r.order_key, r.qty, r.line) for r in u.collect()) == [("1", 2.0, None), ("K1", None, 1)]


def test_feed_directory_all_formats(spark, tmp_dir):
    sub = os.path.join(tmp_dir, "sub")
    os.makedirs(sub)
    base = {"Feeding Date": ["2024-05-01"], "Recipe": ["R1"], "Ingredient": ["Salt"],
            "Dry Call Weight": ["1,000"], "Dry Actual Weight": ["990"]}
    pd.DataFrame(base).to_csv(os.path.join(tmp_dir, "a.csv"), index=False)
    pd.DataFrame(base).to_csv(os.path.join(sub, "b.TSV"), index=False, sep="\t")
    pd.DataFrame(base).to_csv(os.path.join(sub, "c.txt"), index=False, sep=";")
    pd.DataFrame(base).to_parquet(os.path.join(tmp_dir, "d.parquet"), index=False)
    pd.DataFrame(base).to_csv(os.path.join(tmp_dir, ".hidden.csv"), index=False)
    raw = read_feed_files(spark, tmp_dir)  # ';' sniffed from the .txt file
    assert raw.count() == 4
    assert sorted(r.source_file for r in raw.collect()) == ["a.csv", "b.TSV", "c.txt", "d.parquet"]
    from herdfeed.operators import feed
    ff = feed.prepare_feed_intake(raw)
    assert {r.dry_call_weight for r in ff.collect()} == {1000.0}


def test_csv_na_words_become_null(spark, tmp_dir):
    p = os.path.join(tmp_dir, "w.csv")
    open(p, "w").write("cow,bw\n1,NA\n2,\n3,600\n")
    df = read_table_file(spark, p)
    assert [r.bw for r in df.orderBy("cow").collect()] == [None, None, "600"]


def test_csv_round_trip_and_sort(spark, tmp_dir):
    df = spark.createDataFrame([(2, None, 1.5), (1, "b", None)], "k int, s string, x double")
    out = os.path.join(tmp_dir, "t")
    write_table(df, out, "csv", sort_by=["k"], single_file=True)
    back = read_delimited(spark, out)
    assert [(r.k, r.s, r.x) for r in back.collect()] == [("1", "b", None), ("2", None, "1.5")]
    write_table(df, os.path.join(tmp_dir, "p"), "parquet")
    assert spark.read.parquet(os.path.join(tmp_dir, "p")).count() == 2


def test_round_floats_like_numpy(spark):
    df = spark.createDataFrame([(2.675, 1), (0.125, 2), (-0.375, 3)], "x double, k int")
    got = [r.x for r in round_floats(df, 2).orderBy("k").collect()]
    assert got == [2.68, 0.12, -0.38]  # numpy: 2.675 * 100 == 267.5 exactly, half to even


def test_coerce_dates(spark):
    df = spark.createDataFrame([("2024-01-02", "x", "3/5/2024 10:00", "a")], "date string, notes_date string, `Run Date Time` string, other string")
    out = coerce_dates(df)
    types = dict(out.dtypes)
    assert types["date"] == "timestamp_ntz" and types["Run Date Time"] == "timestamp_ntz"
    assert types["notes_date"] == "string" and types["other"] == "string"
    assert out.first()["Run Date Time"] == dt.datetime(2024, 3, 5, 10, 0)


def test_jdbc_modes_on_in_memory_derby(spark):
    url = "jdbc:derby:memory:herdfeed_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "k int, v double")
    write_jdbc(df, url, "T_OUT", "replace", properties=props)
    write_jdbc(df, url, "T_OUT", "append", properties=props)
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "T_OUT").options(**props).load()
    assert back.count() == 10
    with pytest.raises(Exception):
        write_jdbc(df, url, "T_OUT", "fail", properties=props)
    with pytest.raises(ValueError):
        write_jdbc(df, url, "T_OUT", "upsert", properties=props)


def test_load_csv_directory(spark, tmp_dir):
    out = os.path.join(tmp_dir, "chapter3")
    df = spark.createDataFrame([("2024-01-02", 1.0)], "`Date` string, v double")
    write_table(df, os.path.join(out, "table_3_1_yield_and_dim"), "csv")
    pd.DataFrame({"feeding_date": ["2024-01-03"], "x": [1]}).to_csv(os.path.join(out, "plain.csv"), index=False)
    assert set(list_csv_tables(spark, out)) == {"table_3_1_yield_and_dim", "plain"}
    seen = {}
    names = load_csv_directory(spark, out, "chapter3", lambda d, n: seen.__setitem__(n, d))
    assert sorted(names) == ["chapter3_plain", "chapter3_table_3_1_yield_and_dim"]
    assert dict(seen["chapter3_table_3_1_yield_and_dim"].dtypes)["Date"] == "timestamp_ntz"
    assert load_csv_directory(spark, os.path.join(tmp_dir, "missing"), "x", lambda d, n: None) == []


def test_ingredient_map_last_wins_and_join(spark):
    raw = spark.createDataFrame([("corn  silage", "abc", 1), ("Corn Silage", "longcodevalue", 2), ("--", "x", 3),
                                 ("Mix7", "m7", 4)], "`Ingredient Name` string, Code string, ord int")
    m = ingredient_map(raw, ordinal_col="ord")
    assert {r.map_key: r.map_code for r in m.collect()} == {"CORN SILAGE": "LONGCODEVA", "MIX7": "M7"}
    # "mix-7": no hit on the upper-cased text, hit on the compact text "MIX7"
    feed_rows = spark.createDataFrame([("corn silage",), ("mix-7",), ("Haylage",), ("--",)], "name string")
    got = {r.name: r.code for r in apply_ingredient_map(feed_rows, "name", "code", m).collect()}
    assert got == {"corn silage": "LONGCODEVA", "mix-7": "M7", "Haylage": "HLG", "--": None}


def test_catalog_writer_creates_database(spark):
    from herdfeed.sinks import write_catalog

    df = spark.createDataFrame([(1, "a")], "k int, v string")
    name = write_catalog(df, "chapter4_error_by_weight", "replace", "herd_out")
    write_catalog(df, "chapter4_error_by_weight", "append", "herd_out")
    assert spark.table(name).count() == 2
    with pytest.raises(ValueError):
        write_catalog(df, "t", "replace", "bad-name;")


def test_check_has_dates(spark):
    from herdfeed.operators.herd import check_has_dates

    df = spark.createDataFrame([(None,), (None,)], "day date")
    with pytest.raises(ValueError):
        check_has_dates(df)
    check_has_dates(spark.createDataFrame([(dt.date(2024, 1, 1),)], "day date"))


def test_scan_daily_fallback_keeps_every_spelling(spark, tmp_dir):
    # a type conflict forces the per-schema fallback; "Cow ID" and "cow_id" files must
    # not be read as one group (that would drop one spelling's values)
    pd.DataFrame({"Cow ID": [1], "Grp": ["G1"], "DIM": [1.0], "Yield": [1.0]}).to_parquet(
        os.path.join(tmp_dir, "a_20240101.parquet"), index=False)
    pd.DataFrame({"cow_id": [2], "grp": ["G1"], "dim": [1.0], "yield": [1.0]}).to_parquet(
        os.path.join(tmp_dir, "b_20240102.parquet"), index=False)
    pd.DataFrame({"cow_id": ["X3"], "grp": ["G1"], "dim": [1.0], "yield": [1.0]}).to_parquet(
        os.path.join(tmp_dir, "c_20240103.parquet"), index=False)
    df = scan_daily(spark, tmp_dir)
    assert sorted(r.cow_id for r in df.collect()) == ["1", "2", "X3"]


def test_groups_of_types_are_found_by_spark_alone(spark, tmp_dir):
    from herdfeed.sources.files import files_by_types

    kinds = ("int32", "int64", "str")
    for k in range(9):  # neighbours never agree
        kind = kinds[k % 3]
        pd.DataFrame({"Cow ID": pd.Series([k]).astype(kind), f"only {k}": [1.5]}).to_parquet(os.path.join(tmp_dir, f"{k} a+b.parquet"), index=False)
    groups = files_by_types(spark, sorted(f"file://{tmp_dir}/{f}" for f in os.listdir(tmp_dir) if f.endswith(".parquet")))
    assert sorted(len(files) for _, files in groups) == [3, 3, 3]
    df = scan_daily(spark, tmp_dir)
    assert sorted(r.cow_id for r in df.collect()) == [str(k) for k in range(9)] and "only_7" in df.columns


def test_top_level_files_only(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "x{1}[2]")
    os.makedirs(os.path.join(folder, "year=2023"))
    pd.DataFrame({"Cow ID": [1]}).to_parquet(os.path.join(folder, "a_20240105.parquet"), index=False)
    pd.DataFrame({"Cow ID": [9]}).to_parquet(os.path.join(folder, ".hidden.parquet"), index=False)
    pd.DataFrame({"Cow ID": [2]}).to_parquet(os.path.join(folder, "year=2023", "b_20240106.parquet"), index=False)
    top = scan_daily(spark, folder)
    assert [r.cow_id for r in top.collect()] == [1] and "year" not in top.columns
    assert sorted(r.cow_id for r in scan_daily(spark, folder, recursive=True).collect()) == [1, 2]
    inside = scan_daily(spark, os.path.join(folder, "year=2023"))
    assert [r.cow_id for r in inside.collect()] == [2] and "year" not in inside.columns
    assert [r.cow_id for r in scan_daily(spark, os.path.join(folder, "a_20240105.parquet")).collect()] == [1]


def test_jdbc_schema_created_before_write(spark):
    from herdfeed.sinks import ensure_jdbc_schema

    url = "jdbc:derby:memory:herdfeed_schema;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    ensure_jdbc_schema(spark, url, "HERD", props, ddl="CREATE SCHEMA HERD",
                       probe_query="SELECT 1 AS one FROM SYSIBM.SYSDUMMY1")
    with pytest.raises(Exception):  # the statement really ran: Derby refuses a second CREATE SCHEMA
        ensure_jdbc_schema(spark, url, "HERD", props, ddl="CREATE SCHEMA HERD",
                           probe_query="SELECT 1 AS one FROM SYSIBM.SYSDUMMY1")
    df = spark.createDataFrame([(1,)], "k int")
    write_jdbc(df, url, "T1", "replace", schema="HERD", properties=props)
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "HERD.T1").options(**props).load()
    assert back.count() == 1


def test_csv_doubled_quotes(spark, tmp_dir):
    p = os.path.join(tmp_dir, "q.csv")
    pd.DataFrame({"Ingredient": ['Corn "premium" silage', "a,b"], "w": [1, 2]}).to_csv(p, index=False)
    got = sorted(r.Ingredient for r in read_table_file(spark, p).collect())
    assert got == ['Corn "premium" silage', "a,b"]


def test_csv_writer_doubles_quotes(spark, tmp_dir):
    out = os.path.join(tmp_dir, "w")
    write_table(spark.createDataFrame([('say "hi"', 1)], "s string, k int"), out, "csv", single_file=True)
    part = [f for f in os.listdir(out) if f.endswith(".csv")][0]
    assert pd.read_csv(os.path.join(out, part))["s"].tolist() == ['say "hi"']


def test_csv_byte_order_mark_dropped(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bom.csv")
    with open(p, "w", encoding="utf-8-sig") as fh:
        fh.write("Cow,BW\n1,600\n")
    assert read_table_file(spark, p).columns[:2] == ["Cow", "BW"]


def test_feed_parquet_type_conflict(spark, tmp_dir):
    base = {"Feeding Date": ["2024-05-01"], "Recipe": ["R1"], "Ingredient": ["Salt"], "Dry Call Weight": [10.0],
            "Dry Actual Weight": [9.0]}
    pd.DataFrame(base).to_parquet(os.path.join(tmp_dir, "a.parquet"), index=False)
    text = dict(base, **{"Dry Call Weight": ["1,000"]})
    pd.DataFrame(text).to_parquet(os.path.join(tmp_dir, "b.parquet"), index=False)
    from herdfeed.operators import feed
    ff = feed.prepare_feed_intake(read_feed_files(spark, tmp_dir))
    assert sorted(r.dry_call_weight for r in ff.collect()) == [10.0, 1000.0]


def test_delimited_files_by_their_own_headers(spark, tmp_dir):
    files = {
        "a.csv": '\ufeffdate,recipe,ingredient,dry call weight,dry actual weight,pen\n2024-05-01,R1,"Salt ""fine""",10,9,P1\n',
        "b.csv": 'pen,dry actual weight,dry call weight,ingredient,recipe,date\nP2,8,7,"two\nlines",R1,2024-05-02\n',
        "sub/c d.txt": 'date;recipe;ingredient;dry call weight;dry actual weight\n2024-05-03;R2;Corn, cracked;6;5\n',
        "e.txt": 'recipe|date|ingredient|dry call weight|dry actual weight|extra\nR3|2024-05-04|Hay|4|3|x\n',
        "f.tsv": 'date\trecipe\tingredient\tdry call weight\tdry actual weight\n2024-05-05\tR4\tOats\t2\t1\n',
        "empty.csv": "",
    }
    for name, text in files.items():
        os.makedirs(os.path.dirname(os.path.join(tmp_dir, name)), exist_ok=True)
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            f.write(text)
    got = {r["source_file"]: r for r in read_feed_files(spark, tmp_dir).collect()}
    assert set(got) == {"a.csv", "b.csv", "c d.txt", "e.txt", "f.tsv"}
    assert [got[f][c] for f, c in (("a.csv", "pen"), ("b.csv", "pen"), ("b.csv", "dry call weight"), ("a.csv", "dry call weight"))] == ["P1", "P2", "7", "10"]
    assert got["a.csv"]["ingredient"] == 'Salt "fine"' and got["b.csv"]["ingredient"] == "two\nlines"
    assert got["c d.txt"]["ingredient"] == "Corn, cracked" and got["e.txt"]["extra"] == "x" and got["f.tsv"]["pen"] is None


def test_ids_keep_all_digits_over_types(spark, tmp_dir):
    long = 982000123456789123
    for k, (kind, value) in enumerate((("int32", 5), ("int64", long), ("str", str(long + 1)))):
        folder = os.path.join(tmp_dir, "x")
        os.makedirs(folder, exist_ok=True)
        pd.DataFrame({"Cow ID": pd.Series([value], dtype=kind if kind != "str" else object)}).to_parquet(os.path.join(folder, f"{k}.parquet"), index=False)
    assert sorted(r.cow_id for r in scan_daily(spark, os.path.join(tmp_dir, "x")).collect()) == ["5", str(long), str(long + 1)]
    a = spark.createDataFrame([(5,)], "id int")
    b = spark.createDataFrame([(long,)], "id bigint")
    assert dict(union_by_name([a, b]).dtypes)["id"] == "bigint"
    assert sorted(r.id for r in union_by_name([b, spark.createDataFrame([(1.5,)], "id double")]).collect()) == ["1.5", str(long)]


def test_last_row_of_a_file_wins(spark, tmp_dir):
    p = os.path.join(tmp_dir, "map.csv")
    with open(p, "w") as f:
        f.write("raw,code\n" + "".join(f"hay,c{i}\n" for i in range(50)))
    m = ingredient_map(read_table_file(spark, p, order_col="at"), "at").collect()
    assert [(r.map_key, r.map_code) for r in m] == [("HAY", "C49")]


def test_folder_is_told_by_the_file_system(spark, tmp_dir):
    from herdfeed.sources.files import is_folder
    folder = os.path.join(tmp_dir, "feed.2024")
    os.makedirs(folder)
    open(os.path.join(folder, "a.csv"), "w").write("a,b\n1,2\n")
    assert is_folder(spark, folder) and not is_folder(spark, os.path.join(folder, "a.csv"))


def test_json_goes_through_spark(spark, tmp_dir):
    from herdfeed.sinks import read_json, write_json
    path = f"file://{tmp_dir}/deep/run_summary.json"
    write_json(spark, {"rows": 3, "day": dt.date(2024, 1, 2)}, path)
    assert read_json(spark, path) == {"rows": 3, "day": "2024-01-02"}


def test_cut_names_may_not_meet(spark):
    from herdfeed.sources.headers import distinct_table_names
    with pytest.raises(ValueError):
        distinct_table_names(["x" * 70 + "a", "x" * 70 + "b"])
    assert distinct_table_names(["A b", "c"], "p") == {"A b": "p_a_b", "c": "p_c"}


def read_all(spark, tmp_dir, texts, **kw):
    for name, text in texts.items():
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return read_delimited(spark, tmp_dir, **kw)


HARD = {
    "blank first": "\n  \nAnimal,Weight\n1,2\n\n3,4\n",
    "blank first, CRLF": "\r\nAnimal,Weight\r\n1,2\r\n",
    "quoted header": '\n"Animal\nnumber","Weight, kg"\n1,2\n',
    "quoted header, mark": '\ufeff"Animal\r\nnumber",Weight\r\n"a\r\nb",2\r\n',
    "breaks": 'a,b,c\n"x\ny",1,"p ""q"" r"\n"\n\n","""","\n"""\nz,"",\n',
    "stray quotes": 'a,b\n5" pipe,"two\nlines"\n6" pipe,7"\n"8 ""in""",9\n',
    "quotes, no breaks": 'a,b\n"x,y","z"\n5",6"\n',
    "looks like fields": 'a,b\n"1\n2,""3\n4"",5\n6,""\n7",8\n9,"0"\n',
    "blank splits": "\n" * 30 + "a,b\n1,2\n",
    "blank splits, quotes": "\n" * 30 + 'a,"b\n\n\n\n\n\n\n\n\n\n\n\n\nc"\n1,2\n',
    "case": "Name,name,NAME,Name\n1,2,3,4\n",
}


@pytest.mark.parametrize("name", HARD)
@pytest.mark.parametrize("split", [None, 7, 20])
def test_delimited_like_the_reference_s_reader(spark, tmp_dir, name, split):
    import io

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = read_all(spark, tmp_dir, {"x.csv": HARD[name]})
        got = [tuple(r) for r in df.drop("source_file").collect()]
        want = pd.read_csv(io.StringIO(HARD[name].lstrip("\ufeff"), newline=""), dtype=str, lineterminator=None)
        columns = list(want.columns) if name != "case" else ["Name", "name.1", "NAME.2", "Name.3"]
        assert df.columns == [*columns, "source_file"]
        want = sorted([tuple(None if isinstance(v, float) else v for v in r) for r in want.itertuples(index=False)], key=str)
        assert sorted(got, key=str) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_large_file_with_quoted_breaks_is_split(spark, tmp_dir):
    rows = [(str(k), "line\n" * (k % 4) + f'"{k}",', "x" * (k % 50)) for k in range(4000)]
    pd.DataFrame(rows, columns=["k", "note\nof", "x"]).to_csv(os.path.join(tmp_dir, "x.csv"), index=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = read_delimited(spark, tmp_dir, order_col="at", na_values=None)
        from pyspark.sql.functions import input_file_block_start
        assert spark.read.text(os.path.join(tmp_dir, "x.csv")).select(input_file_block_start()).distinct().count() > 5
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert df.select(F.spark_partition_id()).distinct().count() > 1
        got = [(r.k, r["note\nof"], r.x or "") for r in df.orderBy("at").collect()]
        assert got == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_header_spellings_of_feed_files_are_one_column(spark, tmp_dir):
    read_all(spark, tmp_dir, {"a.csv": "Feeding Date,Recipe\n2024-05-01,R1\n", "b.csv": "feeding_date,RECIPE\n2024-05-02,R2\n", "c.tsv": "feeding-date\trecipe\n2024-05-03\tR3\n"})
    df = read_feed_files(spark, tmp_dir)
    assert sorted(df.columns) == ["Feeding Date", "Recipe", "source_file"]
    assert sorted((r["Feeding Date"], r["Recipe"]) for r in df.collect()) == [("2024-05-01", "R1"), ("2024-05-02", "R2"), ("2024-05-03", "R3")]
    read_all(spark, tmp_dir, {"d.csv": "Feeding Date,feeding_date,Recipe\nold,2024-05-04,R4\n"})
    assert {"Feeding Date", "feeding_date"} <= set(read_feed_files(spark, tmp_dir).columns)


def test_dates_are_typed_without_a_full_pass(spark, tmp_dir):
    """The first split decides: rows behind it that can't be read at all are never looked at."""
    from pyspark.sql import functions as F

    df = spark.range(0, 4000, 1, 40).select(
        F.when(F.col("id") < 4000, F.lit("2024-01-02")).alias("feeding_date"),
        F.when(F.col("id") >= 3, F.when(F.col("id") >= 200, F.raise_error(F.lit("read too far")).cast("string")).otherwise("2024-03-05 10:00")).alias("Run Date"),
        F.lit("n/a").alias("notes"))
    out = coerce_dates(df)
    assert dict(out.dtypes) == {"feeding_date": "timestamp_ntz", "Run Date": "timestamp_ntz", "notes": "string"}
    never = coerce_dates(spark.range(50).select(F.lit("x").alias("date"), F.lit("2024-01-02").alias("day")))
    assert dict(never.dtypes) == {"date": "string", "day": "timestamp_ntz"}
    assert dict(coerce_dates(df.limit(0)).dtypes)["feeding_date"] == "string"


def test_a_failed_run_leaves_the_published_tables(spark, tmp_dir):
    from pyspark.sql import functions as F

    from herdfeed.sinks import publish_tables, published_tables

    read = lambda: {k: spark.read.parquet(p).collect() for k, p in published_tables(spark, tmp_dir).items()}
    assert published_tables(spark, tmp_dir) == {}
    good = {"a": spark.range(3), "b": spark.range(2)}
    publish_tables(good, tmp_dir, formats=("parquet",))
    first = read()
    assert {k: len(v) for k, v in first.items()} == {"a.parquet": 3, "b.parquet": 2}
    bad = {"a": spark.range(7), "b": spark.range(5).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))}
    with pytest.raises(Exception, match="stop"):
        publish_tables(bad, tmp_dir, formats=("parquet",))
    assert read() == first
    publish_tables({"a": spark.range(4)}, tmp_dir, formats=("parquet",))
    assert {k: len(v) for k, v in read().items()} == {"a.parquet": 4}


def test_one_line_headers_are_found_without_putting_records_together(spark, tmp_dir, monkeypatch):
    from herdfeed.sources import records

    texts = {"a.csv": '\ufeff\n  \n"x, y",z\r\n1,"a\nb"\n', "b.csv": 'x,"z\nz"\n1,2\n', "c c.csv": '"p","q"\n"1\n\n",2\n', "d.csv": "\n \n"}
    for name, text in texts.items():
        with open(f"{tmp_dir}/{name}", "w", newline="") as f:
            f.write(text)
    asked, whole = [], records.quoted_records
    monkeypatch.setattr(records, "quoted_records", lambda s, files, *a: asked.append([os.path.basename(f) for f in files]) or whole(s, files, *a))
    files = [f"file:{tmp_dir}/{name}" for name in texts]
    found = {file.rsplit("/", 1)[1]: record for file, record in records.header_records(spark, files, (",",))}
    assert found == {"a.csv": '"x, y",z', "b.csv": 'x,"z\nz"', "c%20c.csv": '"p","q"'}
    assert [sorted(names) for names in asked] == [["b.csv", "d.csv"], ["d.csv"]]
