"""Every query against the same query in SQL on the driver's tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from statlab.plans.table_queries import QUERIES
from statlab.plans.table_sql import SQL

FOLDER = os.environ.get("STATLAB_TEST_SF", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()
WITHOUT_SQL = {"kmeans_k4", "elbow", "pca_2d", "value_model"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def test_every_query_is_covered():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert not set(SQL) - set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    got = rows(frame.columns, frame.collect())
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    want = rows(columns, result.fetchall())
    assert sorted(frame.columns) == sorted(columns)
    assert len(got) == len(want)
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, wrong[:3]


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs_on_whole_table(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_has_a_row_per_group_and_the_total(spark):
    frame = contract.entry(spark)
    assert frame.columns[0] == "group" and len(frame.columns) == 13
    assert "all" in {r["group"] for r in frame.collect()}
