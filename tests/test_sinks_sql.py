import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from martlight import catalog
from martlight.functions.sql_functions import register_sql_functions
from martlight.operators import settings as S
from martlight.sources import schemas, sinks
from tests.conftest import SF_SMALL


def test_create_conform_append(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="martlight-sink-"), "monthly_revenue")
    t = sinks.create_table(spark, schemas.MONTHLY_REVENUE, path)
    assert t.count() == 0 and t.schema == schemas.MONTHLY_REVENUE
    rows = spark.createDataFrame([(1, 7, dt.date(2025, 1, 1), "100.5", "AI/ML", 3)],
                                 "revenue_id int, customer_id int, month date, mrr_usd string, "
                                 "product_line string, license_count int")
    sinks.append(rows, path, schemas.MONTHLY_REVENUE)
    sinks.append(rows, path, schemas.MONTHLY_REVENUE)
    back = spark.read.parquet(path)
    assert back.count() == 2
    r = back.first()
    assert r["mrr_usd"] == Decimal("100.500") and r["expansion_usd"] is None


def test_conform_fails_loudly_on_bad_cast(spark):
    df = spark.createDataFrame([("x",)], "revenue_id string")
    with pytest.raises(Exception):
        sinks.conform(df, schemas.MONTHLY_REVENUE).collect()


def test_settings_errors(spark):
    cfg = S.merge_insert_only(S.empty_config(spark), S.seed_frame(spark))
    cfg = S.update_values(cfg, spark.createDataFrame([("drill_rows", "ten"), ("budget_warn_percent", "85")],
                                                     "key string, value string"))
    errs = [(r["key"], r["value"]) for r in S.settings_errors(S.settings_object(cfg)).collect()]
    assert errs == [("drill_rows", "ten")]


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("""select is_service_family('Web.x') a, is_service_family('Shop.x') b,
                            service_label('web.click') c, service_label('NEW') d,
                            fmt_credits(1234.56789) e, fmt_usd(2.665) f, fmt_credits2(null) g""").first()
    assert tuple(r) == (True, False, "Page clicks", "NEW", "1,234.5679", "$2.67", "0.00")


def test_register_views(spark):
    names = catalog.register_views(spark, SF_SMALL)
    assert {"ledger", "deals", "dim_customers"} <= set(names)
    n = spark.sql("select count(*) from dim_customers").first()[0]
    assert n == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()


def test_cli_list_and_query(spark, capsys):
    from martlight.__main__ import main
    assert main(["list"]) == 0
    assert "dim_customers" in capsys.readouterr().out.split()
    assert main(["query", "--sf-dir", SF_SMALL, "sem_pipeline_by_stage", "--show", "3"]) == 0
    assert "total_pipeline_value" in capsys.readouterr().out
