"""Catalog entries for lookups, calendar spine, sinks' join logic,
collection reports, alerts, insights and clusters (SURVEY steps 5-10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlens.operators import clean, lookup
from marketlens.plans import sqlgen as S
from marketlens.plans.catalog import register, with_cte
from marketlens.plans.queries_bars import AS_OF, processed, processed_sql, raw_snapshots, RAW_SQL
from marketlens.sources import sinks
from marketlens.sources import tables as T

SEARCH_TERM = "mach"
PAGE_TERM = "hold"   # matches the HOUSEHOLD segment: page 2 is a full page
MONTH_START = dt.date(2024, 1, 1)
HIST_START, HIST_END = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
EXISTING_UNTIL = dt.date(2024, 1, 20)


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _search_sql(term: str) -> str:
    return " OR ".join(f"coalesce(contains(lower({c}), '{term}'), false)"
                       for c in lookup.SEARCH_COLS)


SYMBOL_COLS = "symbol, company_name AS name, exchange, sector, industry"

# --------------------------------------------------------------------------
# Step 5: lookups
# --------------------------------------------------------------------------


@register("t6_symbol_list", with_cte(T.META_SQL) + f"""
SELECT {SYMBOL_COLS} FROM meta ORDER BY exchange, symbol LIMIT 100""")
def t6_symbol_list(spark, sf):
    return lookup.symbols(T.symbol_meta(spark, sf))


@register("p19_symbol_search", with_cte(T.META_SQL) + f"""
SELECT * FROM meta WHERE {_search_sql(SEARCH_TERM)}""")
def p19_symbol_search(spark, sf):
    return lookup.search(T.symbol_meta(spark, sf), SEARCH_TERM)


@register("t9_search_page", with_cte(T.META_SQL) + f"""
SELECT {SYMBOL_COLS} FROM meta WHERE {_search_sql(PAGE_TERM)}
ORDER BY exchange, symbol LIMIT 25 OFFSET 50""")
def t9_search_page(spark, sf):
    return lookup.symbols(T.symbol_meta(spark, sf), term=PAGE_TERM, page=2, size=25)


LATEST_SQL = """
latest AS (
  SELECT exchange, symbol, b.date, b.open, b.high, b.low, b.close, b.volume
  FROM (SELECT exchange, symbol,
               arg_max({'date': date, 'open': open, 'high': high, 'low': low, 'close': close,
                        'volume': volume}, date) AS b
        FROM bars GROUP BY exchange, symbol) t)"""


@register("w21_latest_bar", with_cte(T.BARS_SQL, LATEST_SQL) + "SELECT * FROM latest")
def w21_latest_bar(spark, sf):
    return lookup.latest_bars(T.bars(spark, sf))


@register("j8_symbol_detail", with_cte(T.BARS_SQL, T.META_SQL, LATEST_SQL) + """
SELECT m.symbol, m.company_name AS name, m.exchange, m.sector, m.industry, l.close AS price, l.date,
       l.close - l.open AS change, l.volume
FROM meta m LEFT JOIN latest l ON m.exchange = l.exchange AND m.symbol = l.symbol""")
def j8_symbol_detail(spark, sf):
    return lookup.detail(T.symbol_meta(spark, sf), T.bars(spark, sf))


@register("t7_price_history", with_cte(T.BARS_SQL) + f"""
SELECT * FROM (
  SELECT exchange, symbol, date, open, high, low, close, volume,
         CAST(row_number() OVER (PARTITION BY exchange, symbol ORDER BY date DESC) AS INTEGER) AS rank_desc
  FROM bars WHERE date >= {_d(HIST_START)} AND date <= {_d(HIST_END)}) t
WHERE rank_desc <= 5""")
def t7_price_history(spark, sf):
    return lookup.history(T.bars(spark, sf), start=HIST_START, end=HIST_END, n=5)


@register("w19_newest_bars_brand", with_cte(T.BRAND_BARS_SQL) + """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY exchange, symbol ORDER BY date DESC) AS INTEGER) AS rank_desc
  FROM bars) t WHERE rank_desc <= 30""")
def w19_newest_bars_brand(spark, sf):
    return lookup.newest_per_series(T.brand_bars(spark, sf), n=30)


@register("w22_recent_changes", with_cte(T.BARS_SQL) + f"""
SELECT exchange, symbol, date, open, close, volume, rank_desc,
       coalesce(close - _prev, {S.d(0.0)}) AS change,
       coalesce({S.pct('close', '_prev')}, {S.d(0.0)}) AS change_pct
FROM (SELECT *, lag(close) OVER {S.win()} AS _prev,
             CAST(row_number() OVER (PARTITION BY exchange, symbol ORDER BY date DESC) AS INTEGER) AS rank_desc
      FROM bars) t
WHERE rank_desc <= 10""")
def w22_recent_changes(spark, sf):
    return lookup.recent_changes(T.bars(spark, sf), n=10)


@register("p20_chart_rows", with_cte(T.BARS_SQL, processed_sql()) + """
SELECT exchange, symbol, date, daily_return AS change, abs(daily_return) AS abs_change,
       CASE WHEN daily_return >= 0 THEN 'Gainer' WHEN daily_return < 0 THEN 'Loser' END AS label,
       CAST(volume AS DOUBLE) / CAST(1000000.0 AS DOUBLE) AS volume_millions
FROM processed""")
def p20_chart_rows(spark, sf):
    return lookup.chart_rows(processed(spark, sf))


@register("t12_chronological_brand", with_cte(T.BRAND_BARS_SQL) + """
SELECT * FROM bars ORDER BY exchange, symbol, date""")
def t12_chronological_brand(spark, sf):
    return lookup.chronological(T.brand_bars(spark, sf))


# --------------------------------------------------------------------------
# U3/U4/J5 calendar spine and missing days; J6/J7 insert-if-absent
# --------------------------------------------------------------------------

SPINE_SQL = f"""
spine AS (
  SELECT exchange, symbol, CAST(unnest(generate_series({_d(MONTH_START)}, {_d(AS_OF)}, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT DISTINCT exchange, symbol FROM bars) s)"""


@register("u3_calendar_spine", with_cte(T.BARS_SQL, SPINE_SQL) + "SELECT * FROM spine")
def u3_calendar_spine(spark, sf):
    return clean.calendar_spine(T.bars(spark, sf), MONTH_START, AS_OF)


@register("u3_missing_days", with_cte(T.BARS_SQL, SPINE_SQL) + """
SELECT s.exchange, s.symbol, s.date FROM spine s
WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.exchange = s.exchange AND b.symbol = s.symbol AND b.date = s.date)""")
def u3_missing_days(spark, sf):
    return clean.missing_days(T.bars(spark, sf), start=MONTH_START, end=AS_OF)


# a window with bars on both sides of it
GAP_FROM, GAP_TO = AS_OF - dt.timedelta(days=20), AS_OF - dt.timedelta(days=12)
_WINDOW_GAPS = f"""
SELECT s.exchange, s.symbol, s.date FROM (
  SELECT exchange, symbol, CAST(unnest(generate_series({_d(GAP_FROM)}, {_d(GAP_TO)}, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT DISTINCT exchange, symbol FROM {{series}}) x) s
WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.exchange = s.exchange AND b.symbol = s.symbol AND b.date = s.date)"""


@register("u3_missing_days_window", with_cte(T.BARS_SQL) + _WINDOW_GAPS.format(series="bars"))
def u3_missing_days_window(spark, sf):
    return clean.missing_days(T.bars(spark, sf), start=GAP_FROM, end=GAP_TO)


@register("u3_missing_days_listed", with_cte(T.BARS_SQL, T.META_SQL) + _WINDOW_GAPS.format(series="meta"))
def u3_missing_days_listed(spark, sf):
    """Every listed symbol, also those that never traded."""
    return clean.missing_days(T.bars(spark, sf), start=GAP_FROM, end=GAP_TO,
                              listing=T.symbol_meta(spark, sf))


@register("u3_missing_days_brand", with_cte(T.BRAND_BARS_SQL) + """
, spine AS (
  SELECT exchange, symbol, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT exchange, symbol, min(date) AS lo, max(date) AS hi FROM bars GROUP BY exchange, symbol) s)
SELECT s.exchange, s.symbol, s.date FROM spine s
WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.exchange = s.exchange AND b.symbol = s.symbol AND b.date = s.date)""")
def u3_missing_days_brand(spark, sf):
    return clean.missing_days(T.brand_bars(spark, sf))


def _existing_and_new(spark, sf):
    existing = T.bars(spark, sf).filter(F.col("date") <= F.lit(EXISTING_UNTIL))
    new = raw_snapshots(spark, sf).filter(F.col("date") > F.lit(EXISTING_UNTIL - dt.timedelta(days=5)))
    return existing, new


@register("j6_insert_if_absent", with_cte(T.BARS_SQL, RAW_SQL) + f"""
SELECT exchange, symbol, date, r.open, r.high, r.low, r.close, r.volume, r.download_timestamp
FROM (SELECT exchange, symbol, date,
             arg_min({{'open': open, 'high': high, 'low': low, 'close': close, 'volume': volume,
                      'download_timestamp': download_timestamp}},
                     row(download_timestamp, open, high, low, close, volume)) AS r
      FROM raw WHERE date > {_d(EXISTING_UNTIL - dt.timedelta(days=5))}
      GROUP BY exchange, symbol, date) n
WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.date <= {_d(EXISTING_UNTIL)}
                  AND b.exchange = n.exchange AND b.symbol = n.symbol AND b.date = n.date)""")
def j6_insert_if_absent(spark, sf):
    existing, new = _existing_and_new(spark, sf)
    return sinks.rows_to_insert(existing, new)


@register("j7_new_metadata", with_cte(T.BRAND_BARS_SQL, T.META_SQL) + """
SELECT DISTINCT b.symbol, b.exchange FROM bars b
WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.symbol = b.symbol AND m.exchange = b.exchange)""")
def j7_new_metadata(spark, sf):
    return sinks.new_metadata(T.symbol_meta(spark, sf), T.brand_bars(spark, sf))
