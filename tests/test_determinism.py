"""Every registered query gives the same rows under different partitionings
(ranking buckets, ties, ordered string aggregation are all layout-free)."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import digest


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_layout_independent(spark, key):
    digests = []
    try:
        for parts in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            df = E.queries()[key](spark, SF_SMALL)
            digests.append(digest(df.columns, [tuple(r) for r in df.collect()])[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert digests[0] == digests[1]
