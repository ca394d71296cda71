"""Every query with SQL must return what DuckDB returns on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _key(row):
    return [(v is None, str(type(v)), v if v is not None else 0) for v in row]


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, duck, name):
    got = queries()[name](spark, sf_dir)
    want = duck.execute(ORACLE[name])
    columns = sorted(d[0] for d in want.description)
    assert sorted(got.columns) == columns
    order = [[d[0] for d in want.description].index(c) for c in columns]
    expected = sorted(([r[i] for i in order] for r in want.fetchall()), key=_key)
    actual = sorted((list(r) for r in got.select(*columns).collect()), key=_key)
    assert len(actual) == len(expected)
    for a, e in zip(actual, expected):
        assert all(map(_same, a, e)), (a, e)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("frame,sql", [
    ("class_distribution", "sql_class_share"), ("class_by_geo", "sql_class_by_geo")])
def test_dataframe_and_sql_reports_agree(spark, sf_dir, frame, sql):
    a, b = (queries()[n](spark, sf_dir).drop("class_other") for n in (frame, sql))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
