"""Window specifications and exact statistics of whole-number columns.

All per-series windows use one partitioning, ``(exchange, symbol)``, ordered
by ``date``.  Catalyst then plans a single hash exchange and a single sort
for every window column of a stage (checked in tests/test_plans.py).

Partition size is bounded by the calendar, not by data volume: bars are unique
per (exchange, symbol, date) after ``clean.dedupe_bars`` (or by construction
for bars aggregated from ticks), so a window partition holds at most one row
per day of history.  What can grow with the data - repeated snapshot copies,
ticks of a hot symbol - is collapsed by partial (map-side) aggregation before
any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from marketlens.functions.columns import VOLUME_COUNT_DEC, VOLUME_DEC, VOLUME_SQ_SUM_DEC, col_, safe_div

SERIES_KEYS = ("exchange", "symbol")


def series(keys=SERIES_KEYS) -> WindowSpec:
    """w0: whole series, no order."""
    return Window.partitionBy(*keys)


def ordered(keys=SERIES_KEYS, order="date") -> WindowSpec:
    """w: series in date order (frame defaults to range-unbounded-preceding)."""
    return Window.partitionBy(*keys).orderBy(order)


def whole(keys=SERIES_KEYS, order="date") -> WindowSpec:
    """The whole series, but with the ordered spec: it shares the sort of
    the date-ordered windows instead of needing a sort of its own."""
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def trailing(n: int, keys=SERIES_KEYS, order="date") -> WindowSpec:
    """ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW (partial frames allowed)."""
    return ordered(keys, order).rowsBetween(-(n - 1), 0)


def _over(e: Column, w: WindowSpec | None) -> Column:
    return e if w is None else e.over(w)


def exact_mean(c, w: WindowSpec | None = None, dec: str = VOLUME_DEC) -> Column:
    """Mean of a whole-number column over a frame (or as an aggregate when
    ``w`` is None): exact decimal sum, one conversion, one division.  Prices
    go through functions/exact.py."""
    x = col_(c).cast(dec)
    return safe_div(_over(F.sum(x), w).cast("double"), _over(F.count(x), w))


def exact_stddev(c, w: WindowSpec | None = None) -> Column:
    """Sample standard deviation of a whole-number column over a frame from
    exact decimal moments.

    var = (n*S2 - S1^2) / (n*(n-1)); NULL for fewer than two values, exact 0
    for a flat series (no negative round-off, no NaN).
    """
    x = col_(c).cast(VOLUME_DEC)
    s1 = _over(F.sum(x), w).cast(VOLUME_DEC)
    s2 = _over(F.sum(x * x), w).cast(VOLUME_SQ_SUM_DEC)
    n = _over(F.count(x), w)
    num = n.cast(VOLUME_COUNT_DEC) * s2 - s1 * s1
    return F.sqrt(safe_div(num.cast("double"), (n * (n - 1)).cast("double")))
