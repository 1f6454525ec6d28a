"""Differential test: every registered query against its DuckDB SQL (sf0.001)."""
import pytest

import __spark_entry__ as E
from martlight import catalog
from tests.oracle_check import _types, digest, duck
from tests.conftest import SF_SMALL

KEYS = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(rows) >= 1
        return
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in ocols)
    assert _types(df.schema) == {d[0].lower(): str(d[1]) for d in cur.description}
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["customer_key", "name"]
