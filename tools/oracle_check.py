"""Run every catalog query against its DuckDB oracle (what the driver's
correctness gate does): column names, row count and order-insensitive
values.  Usage: python tools/oracle_check.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cardforge.plans.catalog import ORACLES, QUERIES  # noqa: E402
from cardforge.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "double": "DOUBLE", "smallint": "SMALLINT", "float": "FLOAT"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr), [cols[i] for i in order]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and "/" in sys.argv[1] else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if "/" not in a] or list(QUERIES)
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    ok = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            continue
        dt = time.time() - t0
        if name not in ORACLES:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {dt:.1f}s")
            continue
        try:
            res = con.execute(ORACLES[name])
            ocols = [c[0] for c in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: oracle error {str(e)[:300]}")
            continue
        a, ac = rows_of(scols, srows)
        b, bc = rows_of(ocols, orows)
        stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                  for f in df.schema.fields}
        otypes = {c[0]: str(c[1]) for c in res.description}
        tdiff = {k: (stypes.get(k), otypes.get(k)) for k in stypes if stypes.get(k) != otypes.get(k)}
        if tdiff:
            print(f"TYPE {name}: {tdiff}")
        if ac != bc:
            print(f"FAIL {name}: columns {ac} vs {bc}")
        elif len(a) != len(b):
            print(f"FAIL {name}: rows {len(a)} vs {len(b)}")
            sa, sb = set(a), set(b)
            print("   spark-only", list(sa - sb)[:3])
            print("   oracle-only", list(sb - sa)[:3])
        elif a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {name}: values differ, e.g. {diff}")
        else:
            ok += 1
            print(f"OK   {name}: {len(a)} rows {dt:.1f}s")
    print(f"{ok}/{len(names)} match")


if __name__ == "__main__":
    main()
