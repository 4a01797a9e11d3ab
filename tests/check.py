"""python tests/check.py [sf_dir] [name ...] : compare registered queries with their SQL."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry
from newslens.session import local_session
from oracle import compare, connect


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session("newslens-check", 8)
    con = connect(sf)
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                middle = time.time()
                diff = compare(df, con, sqls[name]) or "ok"
                took = f"{time.time() - start:.1f}s"
            else:
                diff, took = f"rows {df.count()}", f"{time.time() - start:.1f}s"
        except Exception as error:  # noqa: BLE001 - reported and counted
            diff, took = f"ERROR {type(error).__name__}: {str(error)[:600]}", "-"
        bad += diff.startswith("ERROR") or not (diff == "ok" or diff.startswith("rows"))
        print(f"{name:32s} {took:>7s} {diff}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
