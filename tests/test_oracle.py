"""Every registered query against its DuckDB oracle SQL (what the driver checks)."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("customer", "nation", "region", "orders", "lineitem")
SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_oracle_sql():
    assert set(E.QUERY_NAMES) <= set(E.queries()) and set(E.QUERY_NAMES) <= set(E.oracle_sql())


def test_comparison_casts_match_models(spark, sf_small):
    from oracle.sql import COMPARISON_CASTS

    project = E.project(spark, sf_small)
    for name in E.QUERY_NAMES:
        model = project.model(name)
        casts = {f.name: E.comparison_type(f) for f in model.schema.fields
                 if E.comparison_type(f)}
        assert casts == COMPARISON_CASTS.get(name, {}), name


def test_exact_oracle_without_double_casts(spark, sf_small, duck):
    """The decimals themselves also match exactly (before the comparison casts)."""
    from oracle.sql import query

    project = E.project(spark, sf_small)
    for name in E.QUERY_NAMES:
        df = project.model(name)
        rel = duck.sql(query(name))
        order = [rel.columns.index(c) for c in df.columns]
        assert Counter(tuple(r) for r in df.collect()) == \
            Counter(tuple(r[i] for i in order) for r in rel.fetchall())


@pytest.mark.parametrize("name", list(E.QUERY_NAMES))
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = E.queries()[name](spark, sf_small)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for f in df.schema.fields:
        s = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(s, s.upper()) == duck_types[f.name], f.name
    order = [rel.columns.index(c) for c in df.columns]
    want = Counter(tuple(r[i] for i in order) for r in rel.fetchall())
    got = Counter(tuple(r) for r in df.collect())
    assert got == want
