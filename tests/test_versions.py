"""Versioned tables: one commit step, failing and racing writers; the fact refreshed part by part."""
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from martlight.operators.settings import SettingsStore
from martlight.operators.versions import Conflict, VersionedTable, publish_file
from martlight.plans.incremental import IncrementalFact, only_parts, ranges
from martlight.plans.marts import Marts, fct_orders
from tests.conftest import SF_SMALL


def fresh(name="t") -> str:
    return tempfile.mkdtemp(prefix="martlight-versions-") + f"/{name}"


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_failing_build_leaves_the_old_version(spark):
    t = VersionedTable(spark, fresh())
    t.rebuild(spark.range(10))
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("killed")).cast("long"))
                                     .otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        t.rebuild(broken)
    assert t.version().number == 1 and t.read().count() == 10
    assert t.rebuild(spark.range(3)).count() == 3
    assert t.read(1).count() == 10                    # older versions stay readable
    with pytest.raises(ValueError):
        t.read(9)


def test_a_writer_killed_before_it_publishes_is_not_seen(spark, monkeypatch):
    t = VersionedTable(spark, fresh())
    t.rebuild(spark.range(10))
    monkeypatch.setattr(VersionedTable, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        t.rebuild(spark.range(5))
    assert VersionedTable(spark, t.path).read().count() == 10


def test_two_writers_cannot_publish_one_number(spark):
    t = VersionedTable(spark, fresh())
    base = t.version()
    t.rebuild(spark.range(1), based_on=base)
    with pytest.raises(Conflict):
        t.rebuild(spark.range(2), based_on=base)
    assert t.read().count() == 1
    path, won = fresh("v/1.json"), []

    def race(i):
        try:
            publish_file(spark, path, f"{i}")
            won.append(i)
        except Conflict:
            pass
    threads = [threading.Thread(target=race, args=(i,)) for i in range(16)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert len(won) == 1 and open(path).read() == str(won[0])


def test_settings_updates_do_not_get_lost(spark):
    store = SettingsStore(spark, fresh())
    store.seed()
    base = store._stored.version()
    store.update({"drill_rows": "3"})
    with pytest.raises(Conflict):                     # a writer that read the version before
        store._write(store._at(base), base)
    assert store.settings().top_n == 3


def test_refreshed_fact_equals_a_full_rebuild(spark):
    m = Marts(spark, SF_SMALL)
    o, li = m.stg_orders, m.stg_lineitem
    fact = IncrementalFact(spark, fresh(), span=100)
    first = fact.refresh(o, li)
    assert len(first) > 5 and rows(fact.read()) == rows(fct_orders(o, li))
    before = fact.table.version()
    assert fact.refresh(o, li) == set() and fact.table.version() == before

    # one order deleted, one moved to another date, one line's price changed, one order added
    keys = [r[0] for r in o.select("order_key").orderBy("order_key").collect()]
    gone, moved, priced, new = keys[3], keys[40], keys[-5], keys[-1] + 10_000
    o2 = (o.where(F.col("order_key") != gone)
          .withColumn("order_date", F.when(F.col("order_key") == moved, F.date_add("order_date", 400)).otherwise(F.col("order_date"))))
    o2 = o2.unionByName(o.where(F.col("order_key") == moved).withColumn("order_key", F.lit(new).cast("bigint")))
    l2 = li.withColumn("extended_price", F.when(F.col("order_key") == priced, F.col("extended_price") + 1)
                       .otherwise(F.col("extended_price")).cast("decimal(12,2)"))
    l2 = l2.unionByName(li.where(F.col("order_key") == moved).withColumn("order_key", F.lit(new).cast("bigint")))
    touched = fact.refresh(o2, l2)
    assert touched == {k // 100 for k in (gone, moved, priced, new)}
    assert rows(fact.read()) == rows(fct_orders(o2, l2))
    after = fact.table.version()
    same = set(before.parts) - {str(p) for p in touched}
    assert same and all(after.parts[p] == before.parts[p] for p in same)      # untouched parts keep their files
    assert rows(fact.read(1)) == rows(fct_orders(o, li))

    # from a log of changed keys
    o3 = o2.where(F.col("order_key") != moved)
    assert fact.apply(o3, l2, spark.createDataFrame([(moved,), (moved,), (None,)], "order_key bigint")) == {moved // 100}
    assert rows(fact.read()) == rows(fct_orders(o3, l2))
    assert fact.refresh(o3, l2) == set()
    with pytest.raises(ValueError):
        IncrementalFact(spark, fact.table.path, span=7).refresh(o, li)


def test_refresh_from_and_to_nothing(spark):
    m = Marts(spark, SF_SMALL)
    fact = IncrementalFact(spark, fresh(), span=1000)
    none = m.stg_orders.limit(0)
    fact.refresh(none, m.stg_lineitem.limit(0))
    assert fact.read().count() == 0
    fact.refresh(m.stg_orders, m.stg_lineitem)
    assert fact.read().count() == m.fct_orders.count()
    fact.refresh(none, m.stg_lineitem.limit(0))
    assert fact.read().count() == 0


def test_touched_parts_are_pushed_ranges(spark):
    assert ranges([5, 1, 2, 3, 9]) == [(1, 3), (5, 5), (9, 9)]
    plan = only_parts(Marts(spark, SF_SMALL).stg_orders, {2}, 500)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey,1000)" in plan and "LessThanOrEqual(o_orderkey,1499)" in plan


def test_append_goes_on_after_a_conflict_and_refuses_other_columns(spark, monkeypatch):
    path = fresh()
    t = VersionedTable(spark, path)

    def batch(lo, n):
        return spark.range(1, n + 1).select(F.col("id").alias("rn"), (F.col("id") + lo).alias("x"))

    t.append(batch(100, 3), "a", number="rn")
    publish, beaten = VersionedTable.publish, []

    def late(self, *args):
        if not beaten:                           # another writer publishes first
            beaten.append(1)
            VersionedTable(spark, path).append(batch(200, 2), "b", number="rn")
        return publish(self, *args)

    monkeypatch.setattr(VersionedTable, "publish", late)
    got = t.append(batch(300, 4), "c", number="rn")
    assert sorted((r["rn"], r["x"]) for r in got.collect()) == [
        (1, 101), (2, 102), (3, 103), (4, 201), (5, 202), (6, 301), (7, 302), (8, 303), (9, 304)]
    assert t.version().number == 3 and t.version().facts == {"last_rn": 9}
    assert t.append(batch(0, 0), "d", number="rn").count() == 9       # an empty batch
    with pytest.raises(ValueError, match="other columns"):
        t.append(spark.range(1), "e")
