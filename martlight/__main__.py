"""Command line: ``python -m martlight <command> ...``

  build     --sf-dir DIR --out DIR      build the marts and test them; exit code 1 if a test fails
  settings  --store DIR [--set K=V ...] seed the stored settings if new, change values, list them
  report    --out DIR [--store DIR] and either
            --sf-dir DIR                the tables bound onto DIR (sources/bindings.py), or
            --inputs FILE               a JSON file that names the caller's own tables (below)
  query     --sf-dir DIR NAME [--show N]  run a registered query
  list                                  list registered queries

The inputs file: {"ledger": PATH, "ledger_days": PATH, "users": PATH, "as_of": "2026-06-07T00:00:00"
(optional: now), "logs": [{"path": PATH, "service": NAME, "time": COLUMN, "credits": COLUMN,
"usage_id": COLUMN, "function": SQL, "model": SQL, "agent": SQL, "user": SQL}, ...]}; PATHs are
Parquet, the SQL expressions but "function" are optional.  ledger: service_type, name, start_time,
credits_used; ledger_days: usage_date; users: user_id, name; every log also has user_id.
"""

from __future__ import annotations

import argparse
import sys


def read_inputs(spark, spec: dict):
    """:class:`~martlight.plans.usage.UsageInputs` of an inputs file."""
    import datetime as dt

    from pyspark.sql import functions as F

    from martlight.plans.usage import UsageInputs, UsageLog

    def expr(log: dict, key: str):
        return F.expr(log[key]) if log.get(key) else None

    logs = [UsageLog(spark.read.parquet(x["path"]), x["service"], x["time"], x["credits"], x["usage_id"],
                     function_name=F.expr(x["function"]), model_name=expr(x, "model"),
                     agent_name=expr(x, "agent"), user_name=expr(x, "user")) for x in spec["logs"]]
    as_of = dt.datetime.fromisoformat(spec["as_of"]) if spec.get("as_of") else None
    return UsageInputs(*(spark.read.parquet(spec[k]) for k in ("ledger", "ledger_days")), logs,
                       spark.read.parquet(spec["users"]), as_of)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="martlight", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("build")
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("settings")
    p.add_argument("--store", required=True)
    p.add_argument("--set", action="append", default=[], metavar="KEY=VALUE")
    p = sub.add_parser("report")
    p.add_argument("--out", required=True)
    p.add_argument("--store")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--sf-dir")
    source.add_argument("--inputs")
    q = sub.add_parser("query")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("name")
    q.add_argument("--show", type=int, default=20)
    sub.add_parser("list")
    a = ap.parse_args(argv)

    from martlight import catalog
    if a.cmd == "list":
        print("\n".join(sorted(catalog.queries())))
        return 0

    from pyspark.sql import SparkSession

    from martlight.session import configure
    spark = configure(SparkSession.builder.appName("martlight")
                      .config("spark.ui.enabled", "false").getOrCreate())
    if a.cmd == "build":
        from martlight.plans.mart_checks import build_and_test
        results = build_and_test(spark, a.sf_dir, a.out)
        for r in results:
            print(f"{r.status:8}{'' if r.failures is None else r.failures:>10}  {r.check_name}")
        return int(any(r.status != "pass" for r in results))
    if a.cmd == "settings":
        from martlight.operators.settings import SettingsStore, listing
        store = SettingsStore(spark, a.store)
        store.seed()
        if a.set:
            store.update(dict(x.split("=", 1) for x in a.set))
        for r in listing(store.table()).toLocalIterator():
            print(f"{r['key']} = {r['value']}  ({r['description']})")
        return 0
    if a.cmd == "report":
        import json

        from martlight.operators.settings import ReportSettings, SettingsStore
        from martlight.plans.report import report_html
        from martlight.plans.usage import UsageReport
        from martlight.plans.usage_queries import demo_inputs
        from martlight.sources.sinks import write_report
        settings = SettingsStore(spark, a.store).settings() if a.store else ReportSettings.defaults()
        if a.inputs:
            text = "\n".join(r["value"] for r in spark.read.text(a.inputs, wholetext=True).collect())
            inputs = read_inputs(spark, json.loads(text))
        else:
            inputs = demo_inputs(spark, a.sf_dir)
        write_report(report_html(UsageReport(spark, inputs, settings, write_cubes=True)), a.out)
        print(a.out)
        return 0
    df = catalog.queries()[a.name](spark, a.sf_dir)
    df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
