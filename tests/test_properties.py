"""Property tests: custom operators against brute-force Python.

PROPERTY_EXAMPLES=<n> raises the number of generated cases per test."""
import os
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlight.operators.ranking import global_row_number
from martlight.operators.semantic import Entity, Metric, Relationship, SemanticModel, dim, fact
from martlight.operators.topn import SENTINEL_RANK, top_n_with_others

SETTINGS = settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "12")), deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

money = st.one_of(st.none(), st.decimals(min_value=-1000, max_value=1000, places=3,
                                         allow_nan=False, allow_infinity=False))


@SETTINGS
@given(values=st.lists(money, min_size=0, max_size=25), n=st.integers(min_value=0, max_value=6))
def test_top_n_matches_brute_force(spark, values, n):
    rows = [(f"l{i:02d}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "lbl string, cr decimal(38,9)")
    got = {(r["sort_rn"], r["lbl"]): r["cr"] for r in
           top_n_with_others(df, ["lbl"], "cr", n, {"lbl": "Others"}).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))
    exp = {(i + 1, lbl): v for i, (lbl, v) in enumerate(order[:n])}
    rest = order[n:]
    if rest:
        vals = [v for _, v in rest if v is not None]
        exp[(SENTINEL_RANK, "Others")] = sum(vals, Decimal(0)) if vals else None
    assert got == exp


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=0, max_size=60),
       desc=st.booleans(), partitions=st.integers(1, 9))
def test_global_row_number_is_sorted_enumeration(spark, keys, desc, partitions):
    rows = [(a, f"t{i:03d}") for i, a in enumerate(keys)]
    df = spark.createDataFrame(rows, "a int, t string")
    got = {r["t"]: r["rn"] for r in
           global_row_number(df, ["a", "t"], [desc, False], "rn", partitions=partitions).collect()}
    # NULL keys rank first in both directions
    order = sorted(rows, key=lambda r: (r[0] is not None,
                                        (-(r[0] or 0) if desc else (r[0] or 0)), r[1]))
    assert got == {t: i + 1 for i, (_, t) in enumerate(order)}


@SETTINGS
@given(facts=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from(["x", "y"]),
                                 st.integers(0, 500)), min_size=0, max_size=30))
def test_metric_layer_matches_pandas(spark, facts):
    parents = [(p, ["EU", "NA", None][p % 3]) for p in range(4)]   # parent 4 is missing
    pdf = spark.createDataFrame(parents, "pid long, region string")
    fdf = spark.createDataFrame([(i, p, s, Decimal(a)) for i, (p, s, a) in enumerate(facts)],
                                "fid long, pid long, stage string, amount decimal(15,2)")
    m = SemanticModel(
        [Entity("p", pdf, "pid"), Entity("f", fdf, "fid")], [Relationship("f", "pid", "p")],
        [dim("p", "region", "region"), dim("f", "stage", "stage"), fact("f", "amt", "amount")],
        [Metric.of("f", "n", "COUNT(fid)"), Metric.of("f", "total", "SUM(amt)"),
         Metric.of("f", "won", "COUNT_IF(stage = 'x')"), Metric.of("p", "parents", "COUNT(pid)")])
    got = {(r["region"], r["stage"]): (r["n"], r["total"], r["won"]) for r in
           m.query(["n", "total", "won"], ["region", "stage"]).collect()}
    frame = pd.DataFrame([(p, s, a) for p, s, a in facts], columns=["pid", "stage", "amount"])
    frame["region"] = frame["pid"].map(dict(parents))
    exp = {}
    for (reg, stg), g in frame.groupby(["region", "stage"], dropna=False):
        reg = None if isinstance(reg, float) else reg
        exp[(reg, stg)] = (len(g), Decimal(int(g["amount"].sum())).quantize(Decimal("0.01")),
                           int((g["stage"] == "x").sum()))
    assert got == exp
    # cross-entity: parent counts beside fact totals, no fan-out
    both = {r["region"]: (r["parents"], r["n"]) for r in m.query(["parents", "n"], ["region"]).collect()}
    for reg, (np_, nf) in both.items():
        assert np_ == sum(1 for _, r in parents if r == reg)
        assert (nf or 0) == sum(1 for p, _, _ in facts if dict(parents).get(p) == reg
                                and (p in dict(parents) or reg is None))


@SETTINGS
@given(groups=st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from(["x", "y", None, "w"]),
                                 st.sampled_from([None, Decimal("1.5"), Decimal("2"), Decimal("-1")])),
                       min_size=0, max_size=12, unique_by=lambda g: (g[0], g[1])),
       n=st.integers(min_value=0, max_value=5))
def test_top_n_two_labels_with_ties(spark, groups, n):
    df = spark.createDataFrame(groups, "t string, s string, cr decimal(38,9)")
    got = {(r["sort_rn"], r["t"], r["s"]): r["cr"] for r in
           top_n_with_others(df, ["t", "s"], "cr", n, {"t": "Others", "s": "(rest)"}).collect()}
    # value descending with NULLs first, then labels ascending with NULLs first
    order = sorted(groups, key=lambda g: (g[2] is not None, -(g[2] or 0),
                                          g[0] is not None, g[0] or "", g[1] is not None, g[1] or ""))
    exp = {(i + 1, t, s): v for i, (t, s, v) in enumerate(order[:n])}
    if order[n:]:
        vals = [v for _, _, v in order[n:] if v is not None]
        exp[(SENTINEL_RANK, "Others", "(rest)")] = sum(vals, Decimal(0)) if vals else None
    assert got == exp


@SETTINGS
@given(facts=st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["x", "y"]), st.integers(0, 50)),
                      min_size=0, max_size=30),
       region=st.sampled_from(["EU", "NA"]), stage=st.sampled_from(["x", "y"]))
def test_metric_layer_filters_match_pandas(spark, facts, region, stage):
    parents = [(p, ["EU", "NA"][p % 2]) for p in range(5)]          # parent 5 missing
    pdf = spark.createDataFrame(parents, "pid long, region string")
    fdf = spark.createDataFrame([(i, p, s, Decimal(a)) for i, (p, s, a) in enumerate(facts)],
                                "fid long, pid long, stage string, amount decimal(15,2)")
    m = SemanticModel(
        [Entity("p", pdf, "pid"), Entity("f", fdf, "fid")], [Relationship("f", "pid", "p")],
        [dim("p", "region", "region"), dim("f", "stage", "stage"), fact("f", "amt", "amount")],
        [Metric.of("f", "n", "COUNT(fid)"), Metric.of("f", "avg_amt", "AVG(amt)")])
    reg = dict(parents)
    # local filter + parent filter, grouped by the fact's own dimension
    got = {r["stage"]: (r["n"], r["avg_amt"]) for r in
           m.query(["n", "avg_amt"], ["stage"], where=[f"region = '{region}'",
                                                       f"stage = '{stage}'"]).collect()}
    sel = [a for p, s, a in facts if reg.get(p) == region and s == stage]
    from decimal import ROUND_HALF_UP
    exp = ({stage: (len(sel), (Decimal(sum(sel)) / len(sel)).quantize(Decimal("0.000001"),
                                                                       rounding=ROUND_HALF_UP))}
           if sel else {})
    assert got == exp
    # one mixed predicate spanning both entities
    got2 = m.query(["n"], where=f"region = '{region}' OR stage = '{stage}'").first()["n"]
    assert got2 == sum(1 for p, s, _ in facts if reg.get(p) == region or s == stage)


TYPES = ["web.click", "web.view", "Web.x", "Shop.lower", "batch.job", "shop.new",
         "account"]


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(TYPES), st.sampled_from([None, "", "a", "b", "c"]),
                               st.integers(0, 20 * 24 - 1),
                               st.one_of(st.none(), st.decimals(min_value=-5, max_value=50, places=2,
                                                                allow_nan=False, allow_infinity=False))),
                     min_size=1, max_size=40),
       sub_n=st.integers(1, 4))
def test_billed_report_matches_python(spark, rows, sub_n):
    import datetime as dt


    from martlight.functions.service import DEMO_FAMILY, DEMO_LABELS
    from martlight.operators.settings import ReportSettings
    from martlight.plans import usage as U
    base = dt.datetime(2026, 5, 22)
    recs = [(t, nm, base + dt.timedelta(hours=h), c) for t, nm, h, c in rows]
    ledger = spark.createDataFrame(recs, "service_type string, name string, start_time timestamp_ntz, "
                                         "credits_used decimal(28,9)")
    days = ledger.select(F.to_date("start_time").alias("usage_date")).distinct()
    as_of = dt.datetime(2026, 6, 8, 5)
    empty_log = (ledger.limit(0).withColumn("id", F.lit("x"))
                 .withColumn("user_id", F.lit(None).cast("bigint")))
    logs = [U.UsageLog(empty_log, "S", "start_time", "credits_used", "id", F.lit("S"))]
    users = spark.createDataFrame([], "user_id long, name string")
    r = U.UsageReport(spark, U.UsageInputs(ledger, days, logs, users, as_of),
                      ReportSettings(budget=10.0, subtype_top_n=sub_n))

    # plain-Python report semantics
    all_days = sorted({t.date() for _, _, t, _ in recs})
    before = [d for d in all_days if d < as_of.date()]
    rd = before[-1] if before else None
    assert r.window.report_day == rd
    if rd is None:
        return
    m0, w0 = rd.replace(day=1), rd - dt.timedelta(days=6)

    def fam(t):  # the demo family, written out
        assert DEMO_FAMILY.ci_prefixes == ("web.",) and DEMO_FAMILY.prefixes == ("shop.",)
        return t.lower().startswith("web.") or t.startswith("shop.") or t == "account"

    fr = [(t, nm, ts.date(), c) for t, nm, ts, c in recs if fam(t)]

    def total(pred):
        vals = [c for t, nm, d, c in fr if pred(d) and c is not None]
        return sum(vals, Decimal(0))

    b = r.billed().first()
    assert b["day_credits"] == total(lambda d: d == rd)
    assert b["mtd_credits"] == total(lambda d: m0 <= d <= rd)

    by_type = {}
    for t, nm, d, c in fr:
        if m0 <= d <= rd:
            by_type.setdefault(t, []).append(c)
    exp_type = {t: sum((c for c in cs if c is not None), Decimal(0)) for t, cs in by_type.items()
                if any(c is not None for c in cs)}
    exp_type = {t: v for t, v in exp_type.items() if v > 0}
    assert {x["service_type"]: x["credits"] for x in r.by_type().collect()} == exp_type

    trend = {}
    for t, nm, d, c in fr:
        if w0 <= d <= rd:
            trend.setdefault(d, []).append(c)
    exp_trend = {d: (sum((c for c in cs if c is not None), Decimal(0))
                     if any(c is not None for c in cs) else None) for d, cs in trend.items()}
    assert {x["day"]: x["credits"] for x in r.trend().collect()} == exp_trend

    groups = {}
    for t, nm, d, c in fr:
        if m0 <= d <= rd:
            key = (dict(DEMO_LABELS.mapping).get(t, t), nm if nm else "—")
            groups.setdefault(key, []).append(c)
    gsum = {k: (sum((c for c in cs if c is not None), Decimal(0)) if any(c is not None for c in cs)
                else None) for k, cs in groups.items()}
    order = sorted(gsum.items(), key=lambda kv: (kv[1] is not None, -(kv[1] or 0), kv[0]))
    exp_sub = {(i + 1, k[0], k[1]): v for i, (k, v) in enumerate(order[:sub_n])}
    if order[sub_n:]:
        vals = [v for _, v in order[sub_n:] if v is not None]
        exp_sub[(999999, "Others", "(remaining subtypes)")] = sum(vals, Decimal(0)) if vals else None
    got_sub = {(x["sort_rn"], x["type_label"], x["subtype"]): x["credits"] for x in r.by_type_subtype().collect()}
    assert got_sub == exp_sub


@SETTINGS
@given(fn_rows=st.lists(st.tuples(st.integers(0, 40 * 24), st.sampled_from(["F1", "F2", None]),
                                  st.sampled_from(["", "m1", "m2", None]),
                                  st.decimals(min_value=0, max_value=9, places=1, allow_nan=False,
                                              allow_infinity=False),
                                  st.integers(0, 6), st.integers(0, 5)), max_size=25),
       ag_rows=st.lists(st.tuples(st.integers(0, 40 * 24), st.sampled_from(["A", None]),
                                  st.decimals(min_value=0, max_value=9, places=1, allow_nan=False,
                                              allow_infinity=False),
                                  st.integers(0, 6), st.integers(0, 5),
                                  st.sampled_from([None, "", "raw"])), max_size=25),
       n=st.integers(1, 3))
def test_detail_report_matches_python(spark, fn_rows, ag_rows, n):
    import datetime as dt

    from martlight.operators.settings import ReportSettings
    from martlight.plans import usage as U
    base = dt.datetime(2026, 5, 10)
    fn = spark.createDataFrame(
        [(base + dt.timedelta(hours=h), f, m, c, f"q{q}", u) for h, f, m, c, q, u in fn_rows],
        "start_time timestamp_ntz, function_name string, model_name string, credits decimal(28,9), "
        "query_id string, user_id long")
    ag = spark.createDataFrame(
        [(base + dt.timedelta(hours=h), a, c, f"q{q}", u, raw) for h, a, c, q, u, raw in ag_rows],
        "start_time timestamp_ntz, agent_name string, token_credits decimal(28,9), request_id string, "
        "user_id long, user_name string")
    users = spark.createDataFrame([(1, "u1"), (1, "u1b"), (2, "u2"), (3, "u3"), (4, "u4")],
                                  "user_id long, name string")
    logs = [U.UsageLog(fn, "web.click", "start_time", "credits", "query_id",
                       function_name=F.col("function_name"),
                       model_name=F.nullif(F.col("model_name"), F.lit(""))),
            U.UsageLog(ag, "web.view", "start_time", "token_credits", "request_id",
                       function_name=F.lit("view"),
                       agent_name=F.coalesce(F.col("agent_name"), F.lit("(unknown)")),
                       user_name=F.col("user_name"))]
    ledger = spark.createDataFrame([], "service_type string, name string, start_time timestamp_ntz, "
                                       "credits_used decimal(28,9)")
    days = spark.createDataFrame([(dt.date(2026, 6, 10),)], "usage_date date")
    r = U.UsageReport(spark, U.UsageInputs(ledger, days, logs, users, dt.datetime(2026, 6, 12)),
                      ReportSettings(top_n=n))
    rd, m0 = dt.date(2026, 6, 10), dt.date(2026, 6, 1)
    dim = {1: "u1b", 2: "u2", 3: "u3", 4: "u4"}
    unified = [(f"q{q}", (base + dt.timedelta(hours=h)).date(), "web.click", f, m or None, None,
                c, dim.get(u, "(unknown)")) for h, f, m, c, q, u in fn_rows]
    unified += [(f"q{q}", (base + dt.timedelta(hours=h)).date(), "web.view", "view", None,
                 a or "(unknown)", c, raw if raw is not None else dim.get(u, "(unknown)"))
                for h, a, c, q, u, raw in ag_rows]
    mtd = [x for x in unified if m0 <= x[1] <= rd]
    d = r.detail().first()
    assert d["credits"] == sum((x[6] for x in mtd), Decimal(0))
    assert d["requests"] == len({x[0] for x in mtd})
    cur = r.currency().first()
    settled = [x[1] for x in unified if x[1] <= rd]
    assert cur["detail_max_day"] == (max(settled) if settled else rd)

    def topn(groups):
        order = sorted(groups.items(), key=lambda kv: (-kv[1], kv[0]))
        out = {(i + 1,) + k: v for i, (k, v) in enumerate(order[:n])}
        if order[n:]:
            out[(999999,) + tuple("Others" if i == 0 else "" for i in range(len(order[0][0])))] = \
                sum((v for _, v in order[n:]), Decimal(0))
        return out

    by_user = {}
    for x in mtd:
        by_user[(x[7],)] = by_user.get((x[7],), Decimal(0)) + x[6]
    assert {(y["sort_rn"], y["user_name"]): y["credits"] for y in r.by_user().collect()} == topn(by_user)
    by_model = {}
    for x in mtd:
        key = (x[4] or x[5] or x[2], "Model" if x[4] else ("Agent" if x[5] else "Service"))
        by_model[key] = by_model.get(key, Decimal(0)) + x[6]
    assert {(y["sort_rn"], y["name"], y["kind"]): y["credits"] for y in r.by_model().collect()} == \
        topn(by_model)


@SETTINGS
@given(orders=st.lists(st.tuples(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 4))),
                       max_size=10, unique_by=lambda o: o[0]),
       lines=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.integers(1, 99),
                                st.sampled_from([0, 5, 10]), st.sampled_from([0, 8])), max_size=25))
def test_marts_match_python(spark, orders, lines):
    import datetime as dt
    from decimal import ROUND_HALF_UP

    from martlight.plans.marts import dim_customers, fct_orders, stg_customers, stg_lineitem, stg_orders
    cust = spark.createDataFrame([(c, f"C{c}", 1, 10.0, "S") for c in range(4)],
                                 "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    o = spark.createDataFrame([(k, c, "F", 1.0, dt.datetime(2000, 1, 1) + dt.timedelta(days=k), "P")
                               for k, c in orders],
                              "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                              "o_orderdate timestamp_ntz, o_orderpriority string")
    li = spark.createDataFrame([(k, 1, 1, i, 1.0, float(p), d / 100, t / 100, "N", "O", dt.datetime(2000, 2, 1))
                                for i, (k, p, d, t) in enumerate(lines)],
                               "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                               "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                               "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    fct = fct_orders(stg_orders(o), stg_lineitem(li))
    got = {r["order_key"]: (r["order_revenue"], r["line_item_count"]) for r in fct.collect()}
    rev = {}
    for k, p, d, t in lines:
        if k is None:
            continue
        v = Decimal(p) * (1 - Decimal(d) / 100) * (1 + Decimal(t) / 100)
        a, n = rev.get(k, (Decimal(0), 0))
        rev[k] = (a + v, n + 1)
    q = Decimal("0.000001")
    exp = {k: (rev[k][0].quantize(q, ROUND_HALF_UP), rev[k][1]) for k, _ in orders if k in rev}
    assert got == exp
    dim = {r["customer_key"]: (r["total_orders"], r["total_revenue"], r["first_order_date"])
           for r in dim_customers(stg_customers(cust), fct).collect()}
    for c in range(4):
        mine = [k for k, cc in orders if cc == c and k in rev]
        tot = sum((rev[k][0] for k in mine), Decimal(0)).quantize(q, ROUND_HALF_UP)
        first = (dt.date(2000, 1, 1) + dt.timedelta(days=min(mine))) if mine else None
        assert dim[c] == (len(mine), tot, first)


@SETTINGS
@given(days=st.lists(st.one_of(st.none(), st.integers(-400, 800)), min_size=1, max_size=25),
       months=st.integers(1, 24))
def test_entity_months_matches_cross_join(spark, days, months):
    import datetime as dt

    from martlight.operators import datagen
    start = dt.date(2025, 1, 1)
    rows = [(i, None if d is None else start + dt.timedelta(days=d)) for i, d in enumerate(days)]
    c = spark.createDataFrame(rows, "customer_id long, onboarding_date date")
    got = {(r["customer_id"], r["month"]) for r in
           datagen.entity_months(c, "onboarding_date", start, months).collect()}
    spine = [dt.date(2025 + (m // 12), m % 12 + 1, 1) for m in range(months)]
    exp = {(i, m) for i, d in rows if d is not None for m in spine if d <= m}
    assert got == exp


@SETTINGS
@given(child=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)),
                                st.one_of(st.none(), st.integers(0, 6))), max_size=30),
       parent=st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=8))
def test_data_tests_match_python(spark, child, parent):
    from collections import Counter

    from martlight.operators.quality import Check, run_checks
    c = spark.createDataFrame(child, "k long, fk long")
    p = spark.createDataFrame([(x,) for x in parent], "pk long")
    res = {r["kind"] + ":" + r["column_name"]: r["failures"] for r in run_checks(
        {"c": c, "p": p},
        [Check("unique", "c", "k"), Check("not_null", "c", "fk"),
         Check("relationships", "c", "fk", "p", "pk"), Check("unique", "c", ("k", "fk"))]).collect()}
    counts = Counter(k for k, _ in child if k is not None)
    pairs = Counter((k, f) for k, f in child if k is not None and f is not None)
    pks = {x for x in parent if x is not None}
    assert res == {
        "unique:k": sum(1 for v in counts.values() if v > 1),
        "not_null:fk": sum(1 for _, f in child if f is None),
        "relationships:fk": sum(1 for _, f in child if f is not None and f not in pks),
        "unique:k,fk": sum(1 for v in pairs.values() if v > 1),
    }


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.sampled_from(
    ["12", " 7 ", "12.5", "+3", "-2", "abc", "", "3.00005", "0", ".5", "9999999"])), min_size=4, max_size=4))
def test_settings_python_and_spark_reads_agree(spark, vals):
    from martlight.operators import settings as S
    keys = ["price_per_credit", "monthly_budget", "drill_rows", "subtype_rows"]
    kv = dict(zip(keys, vals))
    cfg = spark.createDataFrame([(k, v, "") for k, v in kv.items()], "key string, value string, description string")
    typed = S.typed_settings(S.settings_object(cfg))
    try:
        py = S.ReportSettings.from_pairs(kv)
    except S.SettingsError:
        with pytest.raises(Exception, match="setting"):
            typed.collect()
        return
    row = typed.first()
    assert row["price_per_credit"] == float(py.credit_price)
    assert row["monthly_budget"] == py.budget
    assert (row["drill_rows"], row["subtype_rows"]) == (py.top_n, py.subtype_top_n)
