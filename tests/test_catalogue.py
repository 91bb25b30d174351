"""Every catalogue query against its SQL equivalent."""

import datetime
import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF

# the training-data operators have tests of their own
OWN = {n for n in contract.queries() if not (n.startswith("op") and n[2].isdigit()) and n != "pipeline"}
QUERIES, ORACLE = ({n: x for n, x in found.items() if n in OWN} for found in (contract.queries(), contract.oracle_sql()))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle_but_the_model():
    assert set(QUERIES) - set(ORACLE) == {"churn_model_scores"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    assert got == sorted((tuple(plain(v) for v in r) for r in expected), key=repr)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "account_id" and df.count() > 0


def test_model_scores(spark):
    scored = QUERIES["churn_model_scores"](spark, SF)
    assert scored.where("risk_tier NOT IN ('High', 'Medium', 'Low')").count() == 0
    assert scored.where("churn_probability NOT BETWEEN 0 AND 1").count() == 0
