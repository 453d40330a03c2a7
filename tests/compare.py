"""``python tests/compare.py [--sf sf0.01] [NAME...]``: queries against their SQL on the test tables."""

import os
import sys
import time
from collections import Counter
from datetime import datetime
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings tasks state media metadata profiles checksums heldout_items mixture_targets split_targets shard_limits".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(n.lower() for n in names), Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, folder, query, sql):
    """The difference in words, empty if there is none."""
    df = query(spark, folder)
    got = bag(df.columns, df.collect())
    if sql is None:
        return "" if got[1] else "no rows"
    res = con.sql(sql)
    want = bag(res.columns, res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} {want[0]}"
    if got[1] != want[1]:
        return f"{sum(got[1].values())} rows, SQL {sum(want[1].values())}; only here {list((got[1] - want[1]).items())[:3]}; only SQL {list((want[1] - got[1]).items())[:3]}"
    return ""


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        at = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}{'/*.parquet' if os.path.isdir(at) else ''}'")
    return con


if __name__ == "__main__":
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    sf = args.pop(args.index("--sf") + 1) if "--sf" in args else "sf0.01"
    args = [a for a in args if a != "--sf"]
    folder = f"/root/testdata/{sf}"
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(folder), e.oracle_sql()
    bad = 0
    for name, q in e.queries().items():
        if args and name not in args and not any(a.endswith("*") and name.startswith(a[:-1]) for a in args):
            continue
        t = time.time()
        try:
            why = compare(spark, con, name, folder, q, sqls.get(name))
        except Exception as x:
            why = f"{type(x).__name__}: {str(x)[:1500]}"
        bad += bool(why)
        print(f"{'FAIL' if why else 'ok  '} {name} {time.time() - t:.1f}s {'' if name in sqls else '(rows only)'} {why}", flush=True)
    sys.exit(bool(bad))
