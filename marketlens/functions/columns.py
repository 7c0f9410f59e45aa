"""Scalar column expressions (JVM-side, codegen friendly).

Numeric policy: prices stay doubles at full precision and are summed exactly
(functions/exact.py), volumes as exact decimals, so results do not depend on
the order in which partial sums are merged (bit-identical across partitionings
and against the SQL oracle).  Every
division goes through ``try_divide``: a zero or NULL denominator gives NULL
under ANSI mode instead of an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VOLUME_DEC = "decimal(18,0)"
VOLUME_SQ_SUM_DEC = "decimal(31,0)"
VOLUME_COUNT_DEC = "decimal(6,0)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (``x / nullif(y, 0)`` in SQL)."""
    return F.try_divide(col_(num), col_(den))


def pct_change(new, old) -> Column:
    """(new - old) / old * 100 with a zero guard."""
    return safe_div(col_(new) - col_(old), col_(old)) * F.lit(100)


def epoch_micros(df, name: str) -> Column:
    """Microseconds since 1970-01-01 of a timestamp column, independent of
    the session time zone for ``timestamp_ntz`` (wall-clock) values, so
    differences never gain or lose an hour across a DST change."""
    from pyspark.sql.types import TimestampNTZType
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, F.col(name))
    return F.unix_micros(F.col(name).cast("timestamp"))


def significant(c, digits: int = 10) -> Column:
    """A double at so many significant digits."""
    c = col_(c)
    return F.when(c.isNotNull(), F.format_string(f"%.{digits - 1}e", c).cast("double"))


# --- bar-level scalars (P3-P8, P14, P17, P18, P20) -------------------------

def daily_return(open_="open", close="close") -> Column:
    """(close - open) / open * 100."""
    return pct_change(close, open_)


def price_range(high="high", low="low") -> Column:
    """High - low."""
    return col_(high) - col_(low)


def avg_price(high="high", low="low", close="close") -> Column:
    """P5: (high + low + close) / 3."""
    return (col_(high) + col_(low) + col_(close)) / F.lit(3)


def volume_category(volume="volume", high: int = 1_000_000, medium: int = 100_000) -> Column:
    """HIGH / MEDIUM / LOW by volume; NULL volume falls to LOW."""
    v = col_(volume)
    return (F.when(v > F.lit(high), F.lit("HIGH"))
            .when(v > F.lit(medium), F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def day_change(open_="open", close="close") -> Column:
    """Close - open of one bar."""
    return col_(close) - col_(open_)


def iso_date(c) -> Column:
    """Yyyy-MM-dd text."""
    return F.date_format(col_(c), "yyyy-MM-dd")


def gainer_label(change) -> Column:
    """P20: 'Gainer' when change >= 0, else 'Loser' (NULL stays NULL)."""
    ch = col_(change)
    return F.when(ch >= 0, F.lit("Gainer")).when(ch < 0, F.lit("Loser"))


def text_search(term: str, cols) -> Column:
    """Case-insensitive substring match over several nullable columns."""
    t = term.lower()
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(F.lower(col_(c)).contains(F.lit(t)), F.lit(False))
    return cond
