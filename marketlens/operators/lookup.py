"""Symbol lookups: list/search/page (T6, P19, T9), detail with latest bar
(J8, W21, P14), price history (T7, P23, P24, W19), recent changes (W22),
chart rows (P20) and chronological order (T12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.functions import windows as W
from marketlens.operators.clean import _as_date

SERIES = ("exchange", "symbol")
SEARCH_COLS = ("symbol", "company_name", "exchange", "sector", "industry")


def symbols(meta: DataFrame, term: str | None = None, page: int = 0, size: int = 100) -> DataFrame:
    """Symbols in (exchange, symbol) order, optionally filtered by
    a case-insensitive search term, page ``page`` of ``size`` rows.
    offset+limit over a total order plans as a bounded top-(page+1)*size."""
    m = meta if term is None else meta.filter(C.text_search(term, SEARCH_COLS))
    out = m.select("symbol", F.col("company_name").alias("name"), "exchange", "sector", "industry")
    ordered = out.orderBy("exchange", "symbol")
    if page:
        ordered = ordered.offset(page * size)
    return ordered.limit(size)


def search(meta: DataFrame, term: str) -> DataFrame:
    """P19 on its own: every matching symbol."""
    return meta.filter(C.text_search(term, SEARCH_COLS))


def latest_bars(bars: DataFrame) -> DataFrame:
    """Latest bar per series as one aggregation (max_by on date), so a
    long history never needs sorting."""
    packed = F.struct("date", "open", "high", "low", "close", "volume")
    return (bars.groupBy(*SERIES).agg(F.max_by(packed, "date").alias("_b"))
            .select(*SERIES, "_b.*"))


def detail(meta: DataFrame, bars: DataFrame, symbol: str | None = None) -> DataFrame:
    """Metadata plus latest price/date/change/volume (NULL when the
    symbol has no bars).  With ``symbol`` the point filter is pushed into
    both scans (P24); without it every symbol is answered in one join."""
    if symbol is not None:
        meta = meta.filter(F.col("symbol") == symbol)
        bars = bars.filter(F.col("symbol") == symbol)
    lb = latest_bars(bars)
    j = meta.join(lb, list(SERIES), "left")
    return j.select("symbol", F.col("company_name").alias("name"), "exchange", "sector", "industry",
                    F.col("close").alias("price"), "date",
                    C.day_change().alias("change"), "volume")


def history(bars: DataFrame, symbol: str | None = None, start=None, end=None, n: int = 100) -> DataFrame:
    """Bars in [start, end], newest first, at most n per series.

    For one symbol this is a pushed-down filter plus a top-n; for all series
    a row_number over the shared series window (W19)."""
    b = bars
    if symbol is not None:
        b = b.filter(F.col("symbol") == symbol)
    if start is not None:
        b = b.filter(F.col("date") >= _as_date(start))
    if end is not None:
        b = b.filter(F.col("date") <= _as_date(end))
    cols = [*SERIES, "date", "open", "high", "low", "close", "volume"]
    if symbol is not None:
        return b.select(*cols).orderBy(F.col("date").desc(), "exchange").limit(n)
    return newest_per_series(b.select(*cols), n)


def newest_per_series(bars: DataFrame, n: int = 30) -> DataFrame:
    """Newest n bars of each series (date order kept in ``rank_desc``)."""
    w = Window.partitionBy(*SERIES).orderBy(F.col("date").desc())
    return (bars.withColumn("rank_desc", F.row_number().over(w))
            .filter(F.col("rank_desc") <= n))


def recent_changes(bars: DataFrame, n: int = 10) -> DataFrame:
    """Last n bars of each series with the change against the previous
    close (0 when there is no previous bar).  lag is taken over the whole
    series first, so the first kept row still sees its predecessor.  A
    series holds one bar per day, so the pass over it is bounded by the
    calendar."""
    w = W.ordered()
    # rank from the end on the same ascending order (one sort instead of a
    # second, descending one): series length - position + 1
    x = bars.withColumns({
        "_prev": F.lag("close").over(w),
        "rank_desc": (F.count(F.lit(1)).over(W.whole()) - F.row_number().over(w) + 1).cast("int"),
    })
    return (x.filter(F.col("rank_desc") <= n)
            .select(*SERIES, "date", "open", "close", "volume", "rank_desc",
                    F.coalesce(F.col("close") - F.col("_prev"), F.lit(0.0)).alias("change"),
                    F.coalesce(C.pct_change("close", "_prev"), F.lit(0.0)).alias("change_pct")))


def chart_rows(df: DataFrame, change: str = "daily_return") -> DataFrame:
    """P20: abs(change), Gainer/Loser, volume in millions."""
    return df.select(*SERIES, "date", F.col(change).alias("change"),
                     F.abs(change).alias("abs_change"),
                     C.gainer_label(change).alias("label"),
                     (F.col("volume") / F.lit(1_000_000.0)).alias("volume_millions"))


def chronological(bars: DataFrame) -> DataFrame:
    """Bars sorted by series and date.  A range-partitioned global sort;
    hot series are split across tasks by the sampled range bounds."""
    return bars.orderBy(*SERIES, "date")
