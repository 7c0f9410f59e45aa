"""Symbol profiles and summaries.

All of these are single aggregations: Spark runs a partial aggregate per
input partition and shuffles one row per group, so a symbol holding a large
share of the rows costs no more network than a small one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.functions import exact as X
from marketlens.functions import windows as W
from marketlens.operators.clean import _as_date


def symbol_profile(processed: DataFrame) -> DataFrame:
    """A1 + P17 + P18 per (symbol, exchange), at the full precision of the
    prices.  Means are exactly summed, so they do not depend on partitions;
    the deviation is Spark's own, whose last digits follow the merge order."""
    agg = processed.groupBy("symbol", "exchange").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        X.mean("close").alias("avg_price"),
        F.stddev_samp("close").alias("price_volatility"),
        W.exact_mean("volume", dec="decimal(20,0)").alias("avg_volume"),
        F.max("volume").alias("max_volume"),
        F.min("volume").alias("min_volume"),
        X.mean("daily_return").alias("avg_daily_return"))
    return agg.withColumns({
        "data_span_days": F.datediff("last_date", "first_date"),
        "price_range_ratio": C.safe_div("price_volatility", "avg_price") * F.lit(100),
    })


def market_summary(bars: DataFrame) -> DataFrame:
    """A5: distinct symbols, rows, latest date and date range in one pass."""
    return bars.agg(
        F.countDistinct("symbol").alias("total_stocks"),
        F.count(F.lit(1)).alias("total_records"),
        F.max("date").alias("latest_update"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"))


def symbols_per_exchange(bars: DataFrame) -> DataFrame:
    """Distinct symbols per exchange."""
    return bars.groupBy("exchange").agg(F.countDistinct("symbol").alias("n_symbols"))


def table_stats(bars: DataFrame, name: str) -> DataFrame:
    """Rows, distinct symbols, date range of a bar table."""
    return bars.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.countDistinct("symbol").alias("n_symbols"),
                    F.min("date").alias("min_date"),
                    F.max("date").alias("max_date")).select(
        F.lit(name).alias("table_name"), "*")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table.  Each count reads only parquet footers'
    row counts (no columns are projected)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def is_empty(df: DataFrame) -> bool:
    """Emptiness guard - stops at the first row instead of counting."""
    return df.isEmpty()


SPANS = {"1w": ("days", 7), "1m": ("months", 1), "3m": ("months", 3),
         "6m": ("months", 6), "1y": ("months", 12)}


def span_start(as_of, span: str):
    """Start of a calendar range ending at ``as_of``."""
    unit, n = SPANS[span]
    end = _as_date(as_of)
    return F.date_sub(end, n) if unit == "days" else F.add_months(end, -n)


def period_stats(bars: DataFrame, as_of, span: str = "1m", symbol: str | None = None) -> DataFrame:
    """Per series over [span start, as_of] - first/latest price, change,
    change %, average volume, max/min close, latest as % of max/min, trading
    days.  Prices are taken in date order (fixes B9)."""
    end = _as_date(as_of)
    p = bars.filter(F.col("date").between(span_start(as_of, span), end))
    if symbol is not None:  # the page's single symbol (pushed to the scan)
        p = p.filter(F.col("symbol") == symbol)
    s = p.groupBy("exchange", "symbol").agg(
        F.min_by("close", "date").alias("first_price"),
        F.max_by("close", "date").alias("latest_price"),
        C.safe_div(F.sum("volume").cast("double"), F.count("volume")).alias("avg_volume"),
        F.max("close").alias("max_price"),
        F.min("close").alias("min_price"),
        F.count(F.lit(1)).alias("trading_days"))
    return s.withColumns({
        "price_change": F.col("latest_price") - F.col("first_price"),
        "price_change_pct": F.coalesce(C.pct_change("latest_price", "first_price"), F.lit(0.0)),
        "pct_of_max": C.safe_div("latest_price", "max_price") * F.lit(100),
        "pct_of_min": C.safe_div("latest_price", "min_price") * F.lit(100),
    })


def exchange_share(bars: DataFrame) -> DataFrame:
    """Bars per exchange and share of the total.  The total is a window
    over the already aggregated rows (one per exchange), not over the bars."""
    per = bars.groupBy("exchange").agg(F.count(F.lit(1)).alias("n_bars"))
    total = F.sum("n_bars").over(Window.partitionBy()).cast("double")
    return per.withColumn("share_pct", C.safe_div(F.col("n_bars").cast("double"), total) * F.lit(100))


def dimension_counts(meta: DataFrame) -> DataFrame:
    """Distinct exchanges, distinct non-empty sectors, symbols."""
    return meta.agg(
        F.countDistinct("exchange").alias("n_exchanges"),
        F.countDistinct(F.when(F.col("sector") != "", F.col("sector"))).alias("n_sectors"),
        F.count(F.lit(1)).alias("n_symbols"))
