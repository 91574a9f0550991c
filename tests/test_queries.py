"""Every query of the catalogue against its SQL, at the smallest size."""

import datetime
import decimal

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from ledgerloom import plans

from .conftest import SF
from .literal import cases, listed, proven, read, scenarios

#: Functions over a few literal rows and what they have to give: compiling their plans takes longer than interpreting them.
LITERAL = {n: (m.QUERIES[n], m.SQL[n]) for m in (cases, listed, proven, read, scenarios) for n in m.QUERIES}
INTERPRETED = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, bool) or type(v).__name__ in ("bool", "bool_"):
        return bool(v)
    if isinstance(v, decimal.Decimal) or hasattr(v, "dtype") and v.dtype.kind == "f" or isinstance(v, float):
        return float(f"{float(v):.9g}")
    if hasattr(v, "dtype") and v.dtype.kind in "iu":
        return int(v)
    if isinstance(v, datetime.date):
        return str(v)[:19].replace(" 00:00:00", "")
    return v


def content(frame):
    cols = sorted(frame.columns)
    return cols, sorted((tuple(plain(v) for v in r) for r in frame[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    for k in INTERPRETED:
        spark.conf.unset(k)
    assert content(plans.queries()[name](spark, SF).toPandas()) == content(duck.execute(plans.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(LITERAL))
def test_literal_cases(spark, duck, name):
    for k, v in INTERPRETED.items():
        spark.conf.set(k, v)
    query, want = LITERAL[name]
    assert content(query(spark, SF).toPandas()) == content(duck.execute(want).df())


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    for k in INTERPRETED:
        spark.conf.unset(k)
    assert plans.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(plans.queries()) <= set(entry.queries())
