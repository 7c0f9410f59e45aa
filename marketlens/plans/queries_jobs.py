"""Catalog entries for the composite jobs (Q1, Q2+Q3, Q4, Q8) and the
presentation steps of the period gainers (P15, T10).  Job entries write into
fresh folders under the session's checkpoint folder and return what they
wrote, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators import insights, lookup, rankings
from marketlens.plans import jobs
from marketlens.plans import queries_reports as QR
from marketlens.plans.catalog import register, with_cte
from marketlens.plans.queries_bars import (
    AS_OF, LOADED_AT, PROFILE_SELECT, RAW_SQL, VOL_HIGH, VOL_MEDIUM, _period_gainers_sql,
    anomalies_sql, indicators_sql, processed_sql, shown_profile, signals_sql,
)
from marketlens.plans.queries_ingest import write_raw_landing
from marketlens.session import scratch_path
from marketlens.sources import sinks
from marketlens.sources import tables as T

DEDUPED_BARS_SQL = """
bars AS (
  SELECT exchange, symbol, date, r.open, r.high, r.low, r.close, r.volume
  FROM (SELECT exchange, symbol, date,
               arg_min({'open': open, 'high': high, 'low': low, 'close': close, 'volume': volume},
                       download_timestamp) AS r
        FROM raw GROUP BY exchange, symbol, date) t)"""


def _processing(spark, sf):
    root = write_raw_landing(spark, sf)
    out = scratch_path(spark, "jobs")
    paths = jobs.processing_job(spark, f"{root}/*/*/*.csv", out, high=VOL_HIGH,
                                medium=VOL_MEDIUM, loaded_at=LOADED_AT)
    return out, paths


@register("q1_processing_job", with_cte(
    T.BARS_SQL.replace("bars AS (", "ev_bars AS (", 1), RAW_SQL.replace("FROM bars", "FROM ev_bars"),
    DEDUPED_BARS_SQL, processed_sql()) + PROFILE_SELECT)
def q1_processing_job(spark, sf):
    """Raw landing -> daily_stocks -> stock_aggregations (read back)."""
    _, paths = _processing(spark, sf)
    return shown_profile(spark.read.parquet(paths["stock_aggregations"]))


JOB_BARS_CTES = (T.BARS_SQL.replace("bars AS (", "ev_bars AS (", 1),
                 RAW_SQL.replace("FROM bars", "FROM ev_bars"), DEDUPED_BARS_SQL)


@register("q2_analysis_job", QR.insights_flat_sql(
    JOB_BARS_CTES + (processed_sql(), indicators_sql("processed"), anomalies_sql("ind"),
                     signals_sql("flagged")),
    volume="CAST(volume AS DOUBLE)"))
def q2_analysis_job(spark, sf):
    """Raw landing -> processing -> analysis job; the insights JSON the job
    wrote is parsed back and flattened.  The processed reader casts volume
    to double (as the original reader does), hence the double volumes."""
    out, paths = _processing(spark, sf)
    res = jobs.analysis_job(spark, paths["daily_stocks"], out)
    rep = insights.parse_report_json(spark.read.json(res["insights"]), volume_type="double")
    return insights.flatten(rep)


@register("q4_market_summary", with_cte(T.BARS_SQL) + """
, s AS (SELECT count(DISTINCT symbol) AS total_stocks, count(*) AS total_records,
               max(date) AS latest_update, min(date) AS min_date, max(date) AS max_date FROM bars),
e AS (SELECT exchange, count(DISTINCT symbol) AS n_symbols FROM bars GROUP BY exchange)
SELECT s.*, e.exchange, e.n_symbols FROM s, e""")
def q4_market_summary(spark, sf):
    """The one-row JSON summary, parsed back: one row per exchange."""
    return jobs.flatten_summary(jobs.market_summary(T.bars(spark, sf)))


@register("q8_collection_job", with_cte(T.BARS_SQL, QR.attempts_sql()) + f"""
SELECT CASE WHEN g = 1 THEN 'ALL' ELSE exchange END AS exchange,
       successful_symbols, failed_symbols, data_points, hdfs_upload_count, files,
       database_success, database_failed,
       {QR._rate('successful_symbols', 'failed_symbols')} AS success_rate
FROM (SELECT exchange, GROUPING(exchange) AS g, {QR.REPORT_AGGS}
      FROM att GROUP BY ROLLUP (exchange)) t""")
def q8_collection_job(spark, sf):
    """Writes the collection reports; returns the JSON detail read back."""
    ex = T.read_table(spark, sf, "nation").select(T.exchange_of(F.col("n_nationkey")).alias("exchange"))
    paths = jobs.collection_job(QR.attempts(spark, sf), scratch_path(spark, "collection"), ex)
    return spark.read.schema(jobs.REPORT_SCHEMA).json(paths["report"])


@register("s11_collection_csv", "\nUNION ALL\n".join(
    f"SELECT * FROM ({with_cte(T.BARS_SQL, QR.attempts_sql(days), QR.REPORT_SQL)} SELECT '{source}' AS source, rep.* FROM rep) {a}"
    for a, source, days in (("x", "summary", 7), ("y", "collection_report_1", QR.CYCLE_DAYS),
                            ("z", "collection_report_2", 7))))
def s11_collection_csv(spark, sf):
    """Two cycles of the collection job: the CSV summary of the last and the
    published CSV reports of both, read back."""
    out = scratch_path(spark, "collection")
    for cycle, days in (("1", QR.CYCLE_DAYS), ("2", 7)):
        paths = jobs.collection_job(QR.attempts(spark, sf, days), out, cycle=cycle)
    summary = spark.read.schema(QR.PUBLISHED_SCHEMA).option("header", True).csv(paths["summary_csv"])
    reports = sinks.read_published(spark, paths["published"], "csv", QR.PUBLISHED_SCHEMA)
    return summary.withColumn("source", F.lit("summary")).unionByName(reports.withColumnRenamed("report", "source"))


GAINERS_SQL = _period_gainers_sql(T.BARS_SQL, AS_OF, 7, 10)


@register("p15_gainers_presented", "WITH g AS (" + GAINERS_SQL + """)
SELECT symbol, exchange, round(change_pct, 2) AS change, volume, start_price, end_price FROM g""")
def p15_gainers_presented(spark, sf):
    g = rankings.period_gainers(T.bars(spark, sf), AS_OF, days=7, n=10)
    return g.select("symbol", "exchange", F.round("change_pct", 2).alias("change"), "volume",
                    "start_price", "end_price")


@register("t10_chart_heads", "WITH g AS (" + GAINERS_SQL + """)
SELECT exchange, symbol, last_date AS date, change_pct AS change, abs(change_pct) AS abs_change,
       CASE WHEN change_pct >= 0 THEN 'Gainer' WHEN change_pct < 0 THEN 'Loser' END AS label,
       CAST(volume AS DOUBLE) / CAST(1000000.0 AS DOUBLE) AS volume_millions
FROM g ORDER BY change_pct DESC NULLS LAST, exchange, symbol LIMIT 5""")
def t10_chart_heads(spark, sf):
    """The first 5 period gainers as chart rows (P20 + T10)."""
    g = rankings.period_gainers(T.bars(spark, sf), AS_OF, days=7, n=10)
    rows = lookup.chart_rows(g.withColumnRenamed("last_date", "date"), change="change_pct")
    return rows.orderBy(F.col("change").desc_nulls_last(), "exchange", "symbol").limit(5)
