"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import compare
from voltaflow.plans import registry
from voltaflow.sources.tables import TABLES

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    spdf = E.queries()[key](spark, SF_SMALL).toPandas()
    dpdf = con.execute(ORACLE[key]).df()
    status, msg = compare(spdf, dpdf)
    assert status in ("exact", "close"), msg


def test_every_query_registered_with_oracle_or_rows_only():
    assert set(registry.queries()) - set(ORACLE) == {"ml_metrics"}
    assert set(registry.queries()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 21 and df.count() > 0


@pytest.mark.parametrize("key", ["ml_metrics"])
def test_rows_only_queries_run(spark, key):
    assert E.queries()[key](spark, SF_SMALL).count() > 0
