"""Composite jobs: processing (Q1), analysis with insights (Q2, Q3), market
summary (Q4) and collection summary (Q8).

Every stage reads what the previous stage wrote, so a lost executor costs
one stage, never the lineage back to the raw files, and nothing is computed
twice for two sinks.  Emptiness guards (A17) stop at the first row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.operators import clean, collection, insights, profile
from marketlens.sources import ingest, sinks

BAR_COLUMNS = ("exchange", "symbol", "date", "open", "high", "low", "close", "volume",
               "download_timestamp")


def processing_job(spark: SparkSession, raw_glob: str, out_base: str, dedupe: str = "first",
                   min_volume: int = 0, high: int = 1_000_000, medium: int = 100_000,
                   csv_copy: bool = False, loaded_at=None) -> dict[str, str | int] | None:
    """Q1: raw CSV (both layouts) -> de-duplicated, typed, derived bars
    (``daily_stocks``, partitioned by year/month) -> symbol profiles
    (``stock_aggregations``).  Lines that do not fit their file's header are
    written to ``quarantine/raw_lines``.  Returns the written paths and the
    number of quarantined lines (``bad_lines``), None without good lines."""
    good, bad = ingest.split_ragged(spark, raw_glob)
    quarantine = f"{out_base.rstrip('/')}/quarantine/raw_lines"
    bad.write.mode("overwrite").parquet(quarantine)
    raw = ingest.parse_good_lines(good)
    if profile.is_empty(raw):
        return None
    # validity first: an invalid first download must not hide a later valid one
    valid = clean.valid_bars(raw.select(*BAR_COLUMNS), min_volume)
    bars = clean.dedupe_bars(valid, policy=dedupe)
    processed = clean.process_bars(bars, min_volume=min_volume, high=high, medium=medium,
                                   loaded_at=loaded_at)
    base = out_base.rstrip("/")
    daily = f"{base}/processed/daily_stocks"
    sinks.write_processed(processed, daily, csv_copy=csv_copy)
    aggs = f"{base}/processed/stock_aggregations"
    sinks.write_processed(profile.symbol_profile(spark.read.parquet(daily)), aggs,
                          csv_copy=csv_copy)
    return {"daily_stocks": daily, "stock_aggregations": aggs, "quarantine": quarantine,
            "bad_lines": spark.read.parquet(quarantine).count()}


def analysis_job(spark: SparkSession, processed_path: str, out_base: str,
                 start=None, end=None) -> dict[str, str] | None:
    """Q2 + Q3: processed bars (S2, month folders pruned by the date range)
    -> indicators, anomalies, signals written once as parquet, its CSV copy
    under ``analytics/technical_analysis`` (S8), and the one-row insights
    JSON under ``analytics/insights`` (S9) built from the written table."""
    df = ingest.read_bars(spark, processed_path, start=start, end=end)
    if profile.is_empty(df):
        return None
    base = out_base.rstrip("/")
    table = f"{base}/analytics/technical_analysis_parquet"
    insights.analysis(df).write.mode("overwrite").parquet(table)
    an = spark.read.parquet(table)
    csv = sinks.write_analysis(an, f"{base}/analytics", "technical_analysis")
    rep = insights.report(an, write_input=False)
    ins = f"{base}/analytics/insights"
    sinks.write_json_row(insights.report_json(rep), ins)
    return {"analysis": table, "technical_analysis": csv, "insights": ins}


def market_summary(bars: DataFrame) -> DataFrame:
    """Q4 (A5 + A6 + P26): one row - total symbols, records, latest date,
    symbols per exchange as a map, date range - and its JSON text.  The
    exchange map holds one entry per exchange (a small dimension)."""
    head = profile.market_summary(bars)
    per = profile.symbols_per_exchange(bars).agg(
        F.map_from_entries(F.collect_list(F.struct("exchange", "n_symbols"))).alias("exchanges"))
    u = head.unionByName(per, allowMissingColumns=True)
    cols = ["total_stocks", "total_records", "latest_update", "min_date", "max_date", "exchanges"]
    one = u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
    body = F.struct("total_stocks", "total_records",
                    C.iso_date("latest_update").alias("latest_update"), "exchanges",
                    F.struct(C.iso_date("min_date").alias("min_date"),
                             C.iso_date("max_date").alias("max_date")).alias("date_range"))
    return one.select(F.to_json(body).alias("summary"))


SUMMARY_SCHEMA = ("total_stocks bigint, total_records bigint, latest_update string, "
                  "exchanges map<string,bigint>, "
                  "date_range struct<min_date:string,max_date:string>")


def flatten_summary(summary: DataFrame) -> DataFrame:
    """Q4's JSON back as rows: one per exchange, summary values repeated."""
    d = summary.select(F.from_json("summary", SUMMARY_SCHEMA).alias("_s")).select("_s.*")
    return d.select("total_stocks", "total_records",
                    F.to_date("latest_update").alias("latest_update"),
                    F.to_date("date_range.min_date").alias("min_date"),
                    F.to_date("date_range.max_date").alias("max_date"),
                    F.explode("exchanges").alias("exchange", "n_symbols"))


REPORT_SCHEMA = ("exchange string, successful_symbols bigint, failed_symbols bigint, "
                 "data_points bigint, hdfs_upload_count bigint, files bigint, "
                 "database_success bigint, database_failed bigint, success_rate double")


def collection_job(attempts: DataFrame, out_base: str, exchanges: DataFrame | None = None,
                   top_n: int = 10, cycle: str | None = None) -> dict[str, str]:
    """Q8 + S11: per-exchange report with grand total (JSON detail), CSV
    summary, top exchanges and exchanges without data.  With ``cycle``, the
    per-exchange report is also published under that cycle's name (S12), next
    to those of the cycles before."""
    base = out_base.rstrip("/")
    rep_path = f"{base}/reports/collection_report"
    collection.report_with_totals(attempts).repartition(1).write.mode("overwrite").json(rep_path)
    spark = attempts.sparkSession
    full = spark.read.schema(REPORT_SCHEMA).json(rep_path)
    per = full.filter(F.col("exchange") != "ALL").drop("success_rate")
    csv = f"{base}/reports/collection_report_csv"
    per.repartition(1).write.mode("overwrite").option("header", True).csv(csv)
    top = f"{base}/reports/top_exchanges"
    sinks.write_json_row(collection.top(per, top_n), top)
    none = f"{base}/reports/exchanges_without_data"
    sinks.write_json_row(collection.without_data(per, exchanges), none)
    out = {"report": rep_path, "summary_csv": csv, "top": top, "without_data": none}
    if cycle is not None:
        out["published"] = f"{base}/published"
        sinks.publish_report(per, out["published"], f"collection_report_{cycle}")
    return out

