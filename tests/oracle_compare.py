"""Run registered queries in Spark and their SQL oracle in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: row counts, column match, value match.
PLAIN_SESSION=1 runs the queries in a default session (as a caller's own
session would be) instead of one built by cubewise.session; EXACT_FLOATS=1
compares doubles bit for bit instead of to 9 significant digits.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("EXACT_FLOATS") else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in data)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return f"{name:40s} spark={len(s_rows):7d} ({t1 - t0:5.1f}s) no-oracle"
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    cols_ok = sorted(s_cols) == sorted(d_cols)
    vals_ok = cols_ok and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    status = "OK " if (cols_ok and vals_ok and len(s_rows) == len(d_rows)) else "BAD"
    msg = (f"{status} {name:36s} spark={len(s_rows):7d} duck={len(d_rows):7d} cols={cols_ok} "
           f"vals={vals_ok} ({t1 - t0:5.1f}s)")
    if not cols_ok:
        msg += f"\n     spark cols {sorted(s_cols)}\n     duck  cols {sorted(d_cols)}"
    elif not vals_ok:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        only_s = list((a - b).items())[:3]
        only_d = list((b - a).items())[:3]
        msg += f"\n     cols {sorted(s_cols)}\n     only spark {only_s}\n     only duck  {only_d}"
    return msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from cubewise.session import get_session

    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            line = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as e:  # report and continue
            line = f"ERR {name}: {type(e).__name__}: {str(e)[:600]}"
        bad += not line.startswith(("OK", name))
        print(line, flush=True)
    print(f"done; problems={bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
