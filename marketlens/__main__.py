r"""Job entry points for spark-submit (ship the package with --py-files)::

    spark-submit --py-files marketlens.zip marketlens/__main__.py \
        process --raw 's3://lake/raw/daily/*/*/*.csv' --out s3://lake
    spark-submit --py-files marketlens.zip marketlens/__main__.py \
        analyze --processed s3://lake/processed/daily_stocks --out s3://lake
    spark-submit --py-files marketlens.zip marketlens/__main__.py \
        ingest --landing 's3://lake/raw/daily/*/*/*.csv' --table s3://lake/tables/bars \
        --checkpoint s3://lake/_checkpoints/ingest

Locally: ``python -m marketlens process --raw ... --out ...``.

The session comes from the submit command; settings it leaves unset are
sized from ``--input-bytes`` (see ``session.cluster_conf``).  Off local mode
``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from marketlens.plans import jobs
from marketlens.session import apply_unset, cluster_conf, ensure_checkpoint_dir
from marketlens.streaming.incremental import MAX_FILES, ingest_available


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="marketlens")
    p.add_argument("--input-bytes", type=int, default=0,
                   help="approximate input size, sizes unset shuffle/scan settings")
    sub = p.add_subparsers(dest="cmd", required=True)
    pr = sub.add_parser("process", help="raw CSV -> daily_stocks + stock_aggregations (Q1)")
    pr.add_argument("--raw", required=True)
    pr.add_argument("--out", required=True)
    pr.add_argument("--dedupe", default="first", choices=("first", "last", "none"))
    pr.add_argument("--min-volume", type=int, default=0)
    pr.add_argument("--csv-copy", action="store_true")
    an = sub.add_parser("analyze", help="processed bars -> analysis + insights (Q2, Q3)")
    an.add_argument("--processed", required=True)
    an.add_argument("--out", required=True)
    an.add_argument("--start")
    an.add_argument("--end")
    ing = sub.add_parser("ingest", help="new landed files -> bar table (G1)")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--table", required=True)
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES)
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"marketlens-{a.cmd}").getOrCreate()
    if a.input_bytes:
        cores = spark.sparkContext.defaultParallelism
        apply_unset(spark, cluster_conf(a.input_bytes, cores))
    apply_unset(spark, {"spark.sql.session.timeZone": "UTC",
                        "spark.sql.adaptive.enabled": "true",
                        "spark.sql.adaptive.skewJoin.enabled": "true"})
    ensure_checkpoint_dir(spark)
    if a.cmd == "process":
        out = jobs.processing_job(spark, a.raw, a.out, dedupe=a.dedupe,
                                  min_volume=a.min_volume, csv_copy=a.csv_copy)
    elif a.cmd == "analyze":
        out = jobs.analysis_job(spark, a.processed, a.out, start=a.start, end=a.end)
    else:
        q = ingest_available(spark, a.landing, a.table, a.checkpoint,
                             max_files_per_trigger=a.max_files_per_trigger)
        out = {"table": a.table, "batches": len(q.recentProgress)}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
