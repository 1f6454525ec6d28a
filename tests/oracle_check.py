"""Differential check: every ``queries()`` key against its ``oracle_sql()``.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH / ERROR, rows on both sides.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return str(v)                      # scale included: decimal(38,9) ≠ decimal(38,2)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR",
         "DateType": "DATE", "BooleanType": "BOOLEAN", "DoubleType": "DOUBLE",
         "TimestampNTZType": "TIMESTAMP"}


def _types(schema) -> dict:
    out = {}
    for f in schema.fields:
        t = type(f.dataType).__name__
        out[f.name.lower()] = (f"DECIMAL({f.dataType.precision},{f.dataType.scale})"
                               if t == "DecimalType" else _DUCK.get(t, t))
    return out


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from martlight.session import local_session
    spark = local_session()
    qs, ors = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            t1 = time.time() - t0
            if k not in ors:
                print(f"ROWS-ONLY {k}: spark={len(srows)} ({t1:.1f}s)")
                continue
            cur = con.execute(ors[k])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
            hs, ls = digest(scols, srows)
            ho, lo = digest(ocols, orows)
            same_cols = sorted(c.lower() for c in scols) == sorted(c.lower() for c in ocols)
            same_types = _types(df.schema) == {d[0].lower(): str(d[1]) for d in cur.description}
            if not same_types:
                print(f"TYPE-MISMATCH {k}: {_types(df.schema)} vs "
                      f"{ {d[0].lower(): str(d[1]) for d in cur.description} }")
            ok = same_cols and same_types and hs == ho
            if not ok:
                bad += 1
                print(f"MISMATCH {k}: spark={len(srows)} oracle={len(orows)} cols_ok={same_cols}")
                if not same_cols:
                    print("   spark:", scols, "\n   oracle:", ocols)
                else:
                    a, b = set(ls), set(lo)
                    for x in sorted(a - b)[:3]:
                        print("   spark-only :", x[:300])
                    for x in sorted(b - a)[:3]:
                        print("   oracle-only:", x[:300])
            else:
                print(f"OK {k}: rows={len(srows)} ({t1:.1f}s)")
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {k}: {type(e).__name__}: {str(e)[:500]}")
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
