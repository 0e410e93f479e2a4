"""Every query runs; those with SQL give its rows."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from cantoria import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows):
    def one(v):
        if isinstance(v, (float, Decimal)):
            return "nan" if math.isnan(v) else round(float(v), 5) + 0.0
        return v if isinstance(v, (int, type(None))) else str(v)

    return sorted((tuple(one(v) for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = df.select(*(f"`{c}`" for c in cols)).collect()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows or name == "code_switched_samples"
        return
    expected = duck.sql(sql)
    assert sorted(expected.columns) == cols
    listed = ", ".join(f'"{c}"' for c in cols)
    assert plain(rows) == plain(duck.sql(f"select {listed} from ({sql})").fetchall())


def test_entry_runs_without_the_subpackage(spark):
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
