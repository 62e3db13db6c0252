"""Registered queries vs their DuckDB oracle SQL on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracle import TABLES, digest, norm

KEYS = ["yield_group_day", "per_cow_yield", "yield_group_month", "weight_group", "nutrient_error_pen",
        "filtered_feed", "clean_id", "clean_date", "ingredient_code", "latest_per_key", "t_interval"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from herdfeed.plans.registry import queries
    assert set(queries()) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    sp = E.queries()[key](spark, SF_SMALL).toPandas()
    dk = con.execute(E.oracle_sql()[key]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    kinds = {i: "int" for i, c in enumerate(sorted(dk.columns)) if str(dk[c].dtype).lower().startswith(("int", "uint"))}
    assert len(sp) == len(dk)
    assert digest(norm(sp, kinds)) == digest(norm(dk, kinds))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "CI Lower" in df.columns
