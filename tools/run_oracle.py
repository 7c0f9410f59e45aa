"""Run catalog queries in Spark and their SQL in DuckDB; print one JSON line
per query.  Usage: python tools/run_oracle.py [sf_dir] [name-prefix ...]"""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from marketlens.plans.catalog import entries  # noqa: E402
from marketlens.session import build_session  # noqa: E402
import oracle  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    if "--bare" in sys.argv:
        # a plain session like the driver's; --tz=Zone sets a session time zone
        from pyspark.sql import SparkSession
        b = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        for a in sys.argv:
            if a.startswith("--tz="):
                b = b.config("spark.sql.session.timeZone", a[5:])
        spark = b.getOrCreate()
    else:
        spark = build_session("local[8]")
    con = oracle.duck(sf)
    for n, e in entries().items():
        if names and not any(n.startswith(x) for x in names):
            continue
        t = time.time()
        try:
            if e.sql is None:
                r = {"name": n, "rows_only": e.fn(spark, sf).count()}
            else:
                r = oracle.compare(spark, con, sf, e)
        except Exception as ex:  # report and go on with the next query
            r = {"name": n, "ok": False, "error": repr(ex)[:600]}
        r["sec"] = round(time.time() - t, 2)
        print(json.dumps(r, default=str), flush=True)


if __name__ == "__main__":
    main()
