from martlight.operators.versions import VersionedTable
from martlight.operators.quality import (Check, not_null_failures, relationship_failures,
                                         run_checks, summarize, unique_failures)


def test_failing_rows(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (2, None), (None, 99)], "k long, fk long")
    parent = spark.createDataFrame([(10,), (11,)], "pk long")
    assert [tuple(r) for r in unique_failures(child, "k").collect()] == [(2, 2)]
    assert not_null_failures(child, "k").count() == 1
    # NULL foreign keys are not failures; 99 has no parent
    assert [r["fk"] for r in relationship_failures(child, "fk", parent, "pk").collect()] == [99]


def test_run_checks_counts(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (2, None), (None, 99)], "k long, fk long")
    parent = spark.createDataFrame([(10,), (11,)], "pk long")
    res = run_checks({"c": child, "p": parent}, [
        Check("unique", "c", "k"), Check("not_null", "c", "k"), Check("not_null", "c", "fk"),
        Check("relationships", "c", "fk", "p", "pk"), Check("unique", "p", "pk"),
        Check("unique", "c", ("k", "fk"))])
    got = {(r["kind"], r["column_name"], r["model"]): r["failures"] for r in res.collect()}
    assert got == {("unique", "k", "c"): 1, ("not_null", "k", "c"): 1, ("not_null", "fk", "c"): 1,
                   ("relationships", "fk", "c"): 1, ("unique", "pk", "p"): 0,
                   ("unique", "k,fk", "c"): 0}
    s = summarize(res).first()
    assert (s["checks"], s["passed"], s["failed"], s["failing_rows"]) == (6, 2, 4, 4)


def test_build_then_test_on_written_marts(spark):
    import tempfile

    from martlight.plans.mart_checks import DECLARED, build_and_test
    from tests.conftest import SF_SMALL
    out = tempfile.mkdtemp(prefix="martlight-build-")
    res = build_and_test(spark, SF_SMALL, out)
    assert sorted(r.check_name for r in res) == sorted(c.name for c in DECLARED)
    assert {r.status for r in res} == {"pass"}
    assert VersionedTable(spark, f"{out}/dim_customers").read().count() > 0


def test_failing_test_stops_dependents(spark):
    import os
    import tempfile

    from martlight.operators.quality import Check
    from martlight.plans.mart_checks import DECLARED, build_and_test
    from tests.conftest import SF_SMALL
    out = tempfile.mkdtemp(prefix="martlight-build-")
    res = {r.check_name: r for r in build_and_test(
        spark, SF_SMALL, out, [*DECLARED, Check("unique", "stg_orders", "customer_key")])}
    assert res["unique_stg_orders_customer_key"].status == "fail"
    assert {r.status for r in res.values() if r.model in ("fct_orders", "dim_customers")} == {"skipped"}
    assert res["not_null_stg_orders_order_key"].status == "pass"
    assert not os.path.exists(f"{out}/fct_orders") and not os.path.exists(f"{out}/dim_customers")


def test_extra_checks_are_meant_to_fail(spark):
    from martlight.plans.mart_checks import EXTRA, run_mart_checks
    from tests.conftest import SF_SMALL
    res = {r["check_name"]: r["failures"] for r in run_mart_checks(spark, SF_SMALL, extra=True).collect()}
    assert len(res) == 19 and res["not_null_stg_customers_phone"] == 150
    assert [k for k, v in res.items() if v and k not in {c.name for c in EXTRA}] == []


def test_build_command_exit_codes(spark, monkeypatch, capsys):
    import tempfile

    from martlight.__main__ import main
    from martlight.operators.quality import Check
    from martlight.plans import mart_checks
    from tests.conftest import SF_SMALL
    args = ["build", "--sf-dir", SF_SMALL, "--out", tempfile.mkdtemp(prefix="martlight-build-")]
    assert main(args) == 0
    monkeypatch.setattr(mart_checks, "DECLARED", [Check("unique", "stg_lineitem", "order_key")] + mart_checks.DECLARED)
    assert main(args) == 1
    text = capsys.readouterr().out
    assert "fail" in text and "skipped" in text and text.count("\n") >= 33


def test_each_model_is_read_once_and_one_shuffle_counts_all(spark):
    from martlight.plans.mart_checks import DECLARED
    from martlight.plans.marts import Marts
    from tests.conftest import SF_SMALL
    m = Marts(spark, SF_SMALL)
    staged = {"stg_customers": m.stg_customers, "stg_orders": m.stg_orders, "stg_lineitem": m.stg_lineitem}
    checks = [c for c in DECLARED if {c.model, c.to_model or c.model} <= set(staged)]
    plan = run_checks(staged, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_key_types_empty_models_and_odd_values(spark):
    child = spark.createDataFrame([(1, 0.0, b"a", 7), (2, -0.0, b"b", None), (3, float("nan"), None, 8)],
                                  "k int, x double, b binary, s short")
    parent = spark.createDataFrame([(1, 1), (1, 1), (9, 2), (None, 2)], "k long, m int")
    empty = parent.limit(0)
    got = {c["check_name"]: c["failures"] for c in run_checks(
        {"c": child, "p": parent, "e": empty}, [
            Check("relationships", "c", "k", "p", "k"), Check("relationships", "p", "k", "c", "k"),
            Check("relationships", "p", "k", "e", "k"), Check("relationships", "e", "m", "p", "m"),
            Check("unique", "p", "k"), Check("unique", "p", ("k", "m")), Check("unique", "e", "k"),
            Check("unique", "c", "x"), Check("unique", "c", "b"), Check("not_null", "c", "b"),
            Check("not_null", "c", "s"), Check("not_null", "e", "m"), Check("not_null", "p", "k")]).collect()}
    assert got == {
        "relationships_c_k__p_k": 2, "relationships_p_k__c_k": 1, "relationships_p_k__e_k": 3,
        "relationships_e_m__p_m": 0, "unique_p_k": 1, "unique_p_k_m": 1, "unique_e_k": 0,
        "unique_c_x": 1, "unique_c_b": 0, "not_null_c_b": 1, "not_null_c_s": 1, "not_null_e_m": 0,
        "not_null_p_k": 1}


def test_counts_equal_the_failing_rows(spark):
    from pyspark.sql import functions as F
    df = spark.range(3000).select((F.col("id") % 700).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("fk"),
                                  F.when(F.col("id") % 11 > 0, F.concat(F.lit("n"), F.col("id") % 90)).alias("name"))
    parent = spark.createDataFrame([(0,), (2,), (4,)], "pk int")
    names = spark.createDataFrame([(f"n{i}",) for i in range(0, 90, 2)], "name string")
    got = {c["check_name"]: c["failures"] for c in run_checks(
        {"d": df, "p": parent, "n": names}, [
            Check("unique", "d", "k"), Check("unique", "d", ("k", "fk")), Check("not_null", "d", "fk"),
            Check("relationships", "d", "fk", "p", "pk"), Check("relationships", "d", "name", "n", "name")]).collect()}
    assert got == {
        "unique_d_k": unique_failures(df, "k").count(), "unique_d_k_fk": unique_failures(df, ["k", "fk"]).count(),
        "not_null_d_fk": not_null_failures(df, "fk").count(),
        "relationships_d_fk__p_pk": relationship_failures(df, "fk", parent, "pk").count(),
        "relationships_d_name__n_name": relationship_failures(
            df.withColumnRenamed("name", "cname"), "cname", names, "name").count()}
