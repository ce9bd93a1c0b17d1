"""Compare every registered Spark query with its DuckDB oracle.

Usable as a script (``python tests/oracle_check.py [sf_dir] [name ...]``)
and from the pytest suite.  Values are compared exactly, as canonical text
of each cell, order-insensitively.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
from collections import Counter

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def duck_rows(sql: str, sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    rel = con.sql(sql)
    cols = rel.columns
    return cols, rel.fetchall()


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def compare(name: str, spark, sf_dir: str, queries, oracle) -> dict:
    s_cols, s_rows = spark_rows(queries[name](spark, sf_dir))
    o_cols, o_rows = duck_rows(oracle[name], sf_dir)
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "columns_match": sorted(s_cols) == sorted(o_cols)}
    if res["columns_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_o = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
        cs = Counter(tuple(_canon(r[i]) for i in order_s) for r in s_rows)
        co = Counter(tuple(_canon(r[i]) for i in order_o) for r in o_rows)
        res["values_match"] = cs == co
        if cs != co:
            res["only_spark"] = list((cs - co).elements())[:3]
            res["only_oracle"] = list((co - cs).elements())[:3]
    else:
        res["values_match"] = False
        res["spark_cols"], res["oracle_cols"] = s_cols, o_cols
    res["ok"] = res["values_match"] and res["spark_rows"] == res["oracle_rows"]
    return res


def main(argv):
    import __spark_entry__ as entry
    from cardsentry.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    tz = os.environ.get("ORACLE_TZ")
    spark = get_session("local[8]", 8, extra={"spark.sql.session.timeZone": tz} if tz else None)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        if n not in oracle:
            print(f"{n:28s} (no oracle)")
            continue
        try:
            r = compare(n, spark, sf_dir, queries, oracle)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{n:28s} ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        bad += not r["ok"]
        print(f"{n:28s} {'OK ' if r['ok'] else 'BAD'} rows spark={r['spark_rows']} oracle={r['oracle_rows']}"
              + ("" if r["ok"] else f" {r}"))
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
