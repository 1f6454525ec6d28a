import datetime as dt

from pyspark.sql import functions as F

from martlight.operators import datagen


def _customers(spark):
    rows = [(i, ["Strategic", "Enterprise", "Growth"][i % 3], 40 + (i * 7) % 60,
             dt.date(2024, 1, 1) + dt.timedelta(days=37 * i)) for i in range(1, 31)]
    return spark.createDataFrame(rows, "customer_id long, arr_tier string, health_score int, "
                                       "onboarding_date date")


def test_spine(spark):
    s = datagen.month_spine(spark, dt.date(2025, 1, 1), 18).collect()
    assert [r["month"] for r in s][:2] == [dt.date(2025, 1, 1), dt.date(2025, 2, 1)]
    assert s[-1]["month"] == dt.date(2026, 6, 1) and len(s) == 18


def test_entity_months_theta(spark):
    c = _customers(spark)
    em = datagen.entity_months(c, "onboarding_date", dt.date(2025, 1, 1), 18)
    spine = datagen.month_spine(spark, dt.date(2025, 1, 1), 18)
    brute = c.crossJoin(spine).filter(F.col("onboarding_date") <= F.col("month"))
    key = ["customer_id", "month"]
    assert em.select(key).exceptAll(brute.select(key)).count() == 0
    assert brute.select(key).exceptAll(em.select(key)).count() == 0


def test_generator_invariants(spark):
    c = _customers(spark)
    g = datagen.monthly_revenue(c, dt.date(2025, 1, 1), 18)
    rows = g.collect()
    n = len(rows)
    assert sorted(r["revenue_id"] for r in rows) == list(range(1, n + 1))
    ordered = sorted(rows, key=lambda r: (r["month"], r["customer_id"]))
    assert [r["revenue_id"] for r in ordered] == list(range(1, n + 1))
    tiers = {r["customer_id"]: r["arr_tier"] for r in c.collect()}
    health = {r["customer_id"]: r["health_score"] for r in c.collect()}
    for r in rows:
        idx = (r["month"].year - 2025) * 12 + r["month"].month - 1
        base = float(r["mrr_usd"]) / (1 + 0.015 * idx)
        lo, hi = {"Strategic": (25000, 45000), "Enterprise": (12000, 28000)}.get(tiers[r["customer_id"]], (3000, 12000))
        assert lo - 0.01 <= base <= hi + 0.01
        assert r["expansion_usd"] == 0 or 1000 <= r["expansion_usd"] <= 8000
        assert not r["churn_flag"] or health[r["customer_id"]] < 65
        assert r["product_line"] == datagen.PRODUCT_BY_MOD4[r["customer_id"] % 4]
    # same output under a different layout
    again = datagen.monthly_revenue(c.repartition(7), dt.date(2025, 1, 1), 18)
    assert again.exceptAll(g).count() == 0


def test_append_generated_rows(spark):
    import os
    import tempfile

    from martlight.operators.versions import VersionedTable
    from martlight.sources import schemas
    path = os.path.join(tempfile.mkdtemp(prefix="martlight-gen-"), "mr")
    first = datagen.append_monthly_revenue(_customers(spark), dt.date(2025, 1, 1), 3, path)
    n = first.count()
    assert first.schema == schemas.MONTHLY_REVENUE and n > 0
    second = datagen.append_monthly_revenue(_customers(spark), dt.date(2025, 4, 1), 2, path)
    ids = [r["revenue_id"] for r in second.orderBy("month", "customer_id").collect()]
    assert ids == list(range(1, len(ids) + 1)) and len(ids) > n
    # a repeated batch changes nothing, the first one either
    for start, months in ((dt.date(2025, 4, 1), 2), (dt.date(2025, 1, 1), 3)):
        again = datagen.append_monthly_revenue(_customers(spark), start, months, path)
        assert again.exceptAll(second).count() == 0 and again.count() == len(ids)
    t = VersionedTable(spark, path)
    assert t.version().number == 2 and t.version().facts == {"last_revenue_id": len(ids)}
