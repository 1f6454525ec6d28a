"""Every operator query against its DuckDB SQL, where it has one (sf0.001)."""
import pytest

from martlight.llm.queries import ORACLE_SQLS, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import _types, digest, duck


@pytest.mark.parametrize("key", sorted(ORACLE_SQLS))
def test_query_matches_oracle(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(ORACLE_SQLS[key])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _types(df.schema) == {d[0].lower(): str(d[1]) for d in cur.description}
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]


def test_ten_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 11))
