"""Rankings and top-k reports.

Every top-k ends in ``orderBy(...).limit(n)`` over a *total* order (ties
broken by exchange, symbol), which Spark plans as TakeOrderedAndProject: each
partition keeps its own top n and only n rows per partition reach the final
merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.operators.clean import _as_date

SERIES = ("exchange", "symbol")


def in_period(bars: DataFrame, as_of, days: int) -> DataFrame:
    """as_of - days <= date <= as_of (pushed to the scan)."""
    end = _as_date(as_of)
    return bars.filter(F.col("date").between(F.date_sub(end, days), end))


def period_first_last(bars: DataFrame, as_of, days: int = 7) -> DataFrame:
    """A7 + J1-J3 in one aggregation: first/last date, price at each, volume
    on the last date.  Replaces the reference's two self-joins with
    min_by/max_by (partial aggregation, one shuffle)."""
    p = in_period(bars, as_of, days)
    return p.groupBy(*SERIES).agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min_by("close", "date").alias("start_price"),
        F.max_by("close", "date").alias("end_price"),
        F.max_by("volume", "date").alias("volume"))


def period_gainers(bars: DataFrame, as_of, days: int = 7, n: int = 10) -> DataFrame:
    """T4 / Q5: top n by change % between first and last close of the period."""
    fl = period_first_last(bars, as_of, days)
    out = fl.withColumn("change_pct", C.pct_change("end_price", "start_price"))
    return out.orderBy(F.col("change_pct").desc_nulls_last(), "exchange", "symbol").limit(n)


def high_volume(bars: DataFrame, meta: DataFrame, as_of, days: int = 7, n: int = 20) -> DataFrame:
    """T5 / Q6 (A10 + J4): top n by average volume in the period, with the
    company name (``Unknown`` when no metadata row matches).

    The lookup joins once, *after* the top-k, so the bars are derived once
    and n rows probe the metadata; of several names of a key the smallest
    counts.
    """
    p = in_period(bars, as_of, days)
    top = (p.groupBy(*SERIES)
           .agg(C.safe_div(F.sum("volume"), F.count("volume")).alias("avg_volume"))
           .orderBy(F.col("avg_volume").desc_nulls_last(), "exchange", "symbol").limit(n))
    j = (top.join(meta.select(*SERIES, "company_name"), list(SERIES), "left")
         .groupBy(*SERIES).agg(F.min("company_name").alias("company_name"),
                               F.max("avg_volume").alias("avg_volume")))
    return j.select(*SERIES,
                    F.coalesce(F.col("company_name"), F.lit("Unknown")).alias("company_name"),
                    "avg_volume",
                    F.coalesce(F.col("avg_volume").cast("long"), F.lit(0)).alias("avg_volume_int"))


def latest_date(bars: DataFrame) -> DataFrame:
    """A2: one-row frame holding the latest date (kept in the plan, not collected)."""
    return bars.agg(F.max("date").alias("latest_date"))


def top_of_latest_date(bars: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows of the latest date in ``order``, in one pass: the n
    newest rows in that order hold them, and the newest date is among these.
    The window sees n rows at most."""
    newest = bars.orderBy(F.col("date").desc_nulls_last(), *order).limit(n)
    last = F.max("date").over(Window.partitionBy(F.lit(0)))
    return newest.withColumn("_last", last).filter(F.col("date") == F.col("_last")).drop("_last")


def day_gainers(bars: DataFrame, n: int = 10) -> DataFrame:
    """Top n positive daily_return on the latest date."""
    order = [F.col("daily_return").desc_nulls_last(), "exchange", "symbol"]
    return (top_of_latest_date(bars, order, n).filter(F.col("daily_return") > 0)
            .select("symbol", "exchange", "daily_return", F.col("close").alias("price"), "volume")
            .orderBy(*order).limit(n))


def day_volume(bars: DataFrame, n: int = 10) -> DataFrame:
    """Top n by volume on the latest date."""
    order = [F.col("volume").desc_nulls_last(), "exchange", "symbol"]
    return (top_of_latest_date(bars, order, n)
            .select("symbol", "exchange", "volume", F.col("close").alias("price"))
            .orderBy(*order).limit(n))


def anomaly_list(flagged: DataFrame, n: int = 20) -> DataFrame:
    """Up to n distinct anomalous bars in a total order."""
    return (flagged.filter(F.col("has_anomaly"))
            .select("symbol", "exchange", "date", "anomaly_score").distinct()
            .orderBy(F.col("anomaly_score").desc(), F.col("date").desc(), "exchange", "symbol")
            .limit(n))
