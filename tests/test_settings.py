import tempfile
from decimal import Decimal

import pytest

from martlight.operators import settings as S


def test_merge_is_insert_only(spark):
    cur = spark.createDataFrame([("drill_rows", "5", "tuned", None)], S.CONFIG_SCHEMA)
    merged = S.merge_insert_only(cur, S.seed_frame(spark))
    kv = {r["key"]: r["value"] for r in merged.collect()}
    assert kv["drill_rows"] == "5"                 # tuned value survives a re-seed
    assert kv["subtype_rows"] == "12" and len(kv) == len(S.SEED)
    again = S.merge_insert_only(merged, S.seed_frame(spark))
    assert again.count() == len(S.SEED)


def test_update_and_typed_reads(spark):
    cfg = S.merge_insert_only(S.empty_config(spark), S.seed_frame(spark))
    upd = spark.createDataFrame([("price_per_credit", "2.00"), ("drill_rows", "7"),
                                 ("no_such_key", "1"), ("monthly_budget", None)],
                                "key string, value string")
    cfg2 = S.update_values(cfg, upd)
    assert cfg2.count() == len(S.SEED)             # unknown keys are ignored
    typed = S.typed_settings(S.settings_object(cfg2)).first()
    assert typed["price_per_credit"] == 2.0
    assert typed["drill_rows"] == 7
    assert typed["monthly_budget"] == 0.0          # NULL value skipped: default
    assert typed["budget_warn_percent"] == 90.0
    rs = S.ReportSettings.from_table(cfg2)
    assert (rs.credit_price, rs.top_n, rs.budget, rs.subtype_top_n) == ("2.00", 7, 0.0, 12)


@pytest.mark.parametrize("key,value", [("drill_rows", "abc"), ("monthly_budget", "1OO"), ("price_per_credit", ""),
                                       ("price_per_credit", "NaN"), ("drill_rows", "2.5")])
def test_malformed_values_raise(spark, key, value):
    with pytest.raises(S.SettingsError, match=key):
        S.ReportSettings.from_pairs({key: value})
    if value not in ("NaN",):
        cfg = spark.createDataFrame([(key, value, "")], "key string, value string, description string")
        with pytest.raises(Exception, match=key):
            S.typed_settings(S.settings_object(cfg)).collect()


@pytest.mark.parametrize("price", ["1000000", "123456789.5", "2.00005", "0.0000001"])
def test_prices_keep_their_size_and_digits(price):
    assert Decimal(S.ReportSettings.from_pairs({"price_per_credit": price}).credit_price) == Decimal(price)


def test_listing_sorted(spark):
    cfg = S.merge_insert_only(S.empty_config(spark), S.seed_frame(spark))
    keys = [r["key"] for r in S.listing(cfg).collect()]
    assert keys == sorted(keys)


def test_stored_table_seed_update_and_reseed(spark):
    store = S.SettingsStore(spark, tempfile.mkdtemp(prefix="martlight-settings-") + "/t")
    assert store.table().count() == 0 and store.settings() == S.ReportSettings.from_pairs({})
    store.seed()
    assert store.settings() == S.ReportSettings.defaults()
    store.update({"drill_rows": "3", "price_per_credit": "2.5"})
    store.seed()                                   # a later seed keeps tuned values
    other = S.SettingsStore(spark, store.path).settings()
    assert (other.top_n, other.credit_price) == (3, "2.5")
    for bad in ({"drill_rows": "x"}, {"nothing": "1"}):
        with pytest.raises(S.SettingsError):
            store.update(bad)
    assert store.settings() == other and store.table().count() == len(S.SEED)


def test_report_command_reads_stored_settings_and_given_tables(spark, capsys):
    import json

    from martlight.__main__ import main
    from martlight.plans.usage_queries import demo_inputs
    from martlight.sources.bindings import DETAIL_LOGS
    from tests.conftest import SF_SMALL
    base = tempfile.mkdtemp(prefix="martlight-cli-")
    inp = demo_inputs(spark, SF_SMALL)
    spec = {"as_of": inp.as_of.isoformat(), "logs": []}
    for k in ("ledger", "ledger_days", "users"):
        spec[k] = f"{base}/{k}"
        getattr(inp, k).write.parquet(spec[k])
    for m, log in zip(DETAIL_LOGS, inp.logs):
        log.df.write.parquet(f"{base}/{m.table}")
        spec["logs"].append({"path": f"{base}/{m.table}", "service": m.service, "time": m.time,
                             "credits": m.credits, "usage_id": m.usage_id, "function": m.function,
                             "model": m.model, "agent": m.agent, "user": m.user})
    with open(f"{base}/inputs.json", "w") as f:
        json.dump(spec, f)
    assert main(["settings", "--store", f"{base}/set", "--set", "subject_prefix=Ours", "--set", "drill_rows=2"]) == 0
    assert "drill_rows = 2" in capsys.readouterr().out
    assert main(["report", "--inputs", f"{base}/inputs.json", "--store", f"{base}/set", "--out", f"{base}/a"]) == 0
    assert main(["report", "--sf-dir", SF_SMALL, "--store", f"{base}/set", "--out", f"{base}/b"]) == 0
    a, b = (spark.read.json(f"{base}/{x}").first() for x in "ab")
    assert a["subject"].startswith("Ours - ") and a == b
    with pytest.raises(S.SettingsError):
        main(["settings", "--store", f"{base}/set", "--set", "drill_rows=many"])
