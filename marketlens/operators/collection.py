"""Collection reports.

An *attempt* is one listed (exchange, symbol) of a collection cycle; its
outcome comes from the bars that arrived for it in the cycle's window.  The
per-exchange report, grand totals, success rate, top exchanges and
exchanges without data are aggregations over attempts: partial aggregation
before the shuffle, one row per exchange after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.operators.rankings import in_period

SERIES = ("exchange", "symbol")
REPORT_COLUMNS = ("exchange", "successful_symbols", "failed_symbols", "data_points",
                  "hdfs_upload_count", "files", "database_success", "database_failed")


def attempts(symbols: DataFrame, bars: DataFrame, as_of, days: int = 30) -> DataFrame:
    """One row per attempted symbol: data points in [as_of - days, as_of],
    success (any data), one file per successful symbol, uploaded files, and
    whether every bar passes the bar table's validity rule (close and date
    present, volume > 0) - the database outcome."""
    p = in_period(bars, as_of, days)
    valid = F.col("close").isNotNull() & F.col("date").isNotNull() & (F.col("volume") > 0)
    per = p.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("_n"),
                                 F.count_if(~F.coalesce(valid, F.lit(False))).alias("_bad"))
    a = symbols.select(*SERIES).distinct().join(per, list(SERIES), "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    ok = n > 0
    return a.select(*SERIES,
                    n.alias("data_points"),
                    ok.alias("successful"),
                    F.when(ok, F.lit(1)).otherwise(F.lit(0)).alias("files"),
                    F.when(ok, F.lit(1)).otherwise(F.lit(0)).alias("hdfs_uploads"),
                    (ok & (F.coalesce(F.col("_bad"), F.lit(0)) == 0)).alias("db_ok"))


def _report_aggs():
    ok = F.col("successful")
    return [F.count_if(ok).alias("successful_symbols"),
            F.count_if(~ok).alias("failed_symbols"),
            F.sum("data_points").alias("data_points"),
            F.sum("hdfs_uploads").alias("hdfs_upload_count"),
            F.sum("files").alias("files"),
            F.count_if(ok & F.col("db_ok")).alias("database_success"),
            F.count_if(ok & ~F.col("db_ok")).alias("database_failed")]


def report(att: DataFrame) -> DataFrame:
    """Per-exchange summary (the CSV report's columns)."""
    return att.groupBy("exchange").agg(*_report_aggs()).select(*REPORT_COLUMNS)


def report_with_totals(att: DataFrame) -> DataFrame:
    """A8 with the grand total as an extra row (``exchange`` = 'ALL'),
    computed by ``rollup`` in the same aggregation, plus the success rate
    (A9) of every row."""
    r = att.rollup("exchange").agg(F.grouping("exchange").alias("_g"), *_report_aggs())
    return r.select(
        F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col("exchange")).alias("exchange"),
        *REPORT_COLUMNS[1:],
        success_rate(F.col("successful_symbols"), F.col("failed_symbols")).alias("success_rate"))


def success_rate(ok, failed):
    """Ok / (ok + failed) * 100, NULL when nothing was attempted."""
    return C.safe_div(ok.cast("double"), (ok + failed).cast("double")) * F.lit(100.0)


def totals(rep: DataFrame) -> DataFrame:
    """A8/A9 grand totals of a per-exchange report, one row."""
    t = rep.agg(F.count(F.lit(1)).alias("total_exchanges"),
                F.sum("successful_symbols").alias("total_successful"),
                F.sum("failed_symbols").alias("total_failed"),
                F.sum("data_points").alias("total_data_points"),
                F.sum("hdfs_upload_count").alias("total_hdfs_uploads"))
    return t.withColumn("success_rate", success_rate(F.col("total_successful"),
                                                     F.col("total_failed")))


def top(rep: DataFrame, n: int = 10) -> DataFrame:
    """Top n exchanges by data points (exchanges with data only)."""
    return (rep.filter(F.col("data_points") > 0)
            .select("exchange", F.col("successful_symbols").alias("symbols"), "data_points",
                    F.col("hdfs_upload_count").alias("hdfs_uploads"))
            .orderBy(F.col("data_points").desc(), "exchange").limit(n))


def without_data(rep: DataFrame, exchanges: DataFrame | None = None) -> DataFrame:
    """Exchanges whose cycle produced no data points, plus (when the
    attempted exchange list is given) exchanges with no report row at all."""
    none = rep.filter(F.col("data_points") == 0).select("exchange")
    if exchanges is None:
        return none
    missing = exchanges.select("exchange").join(rep.select("exchange"), "exchange", "left_anti")
    return none.unionByName(missing).distinct()
