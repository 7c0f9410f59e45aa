"""Catalog entries for bar analytics: cleaning, profiles, indicators,
anomalies, signals, rankings (SURVEY steps 1-4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.operators import anomalies, clean, indicators, profile, rankings, signals
from marketlens.plans import sqlgen as S
from marketlens.plans.catalog import register, with_cte
from marketlens.sources import tables as T

AS_OF = dt.date(2024, 1, 30)          # last day of the events month
BRAND_AS_OF = dt.date(1998, 6, 30)    # inside every scale's ship-date range
LOADED_AT = "2024-02-01 00:00:00"
# events bars carry tick counts (1-10) as volume: category cut-offs scaled down
VOL_HIGH, VOL_MEDIUM = 8, 4


def _lit_date(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


# --------------------------------------------------------------------------
# Step 1: P1-P8, T4 (flagship), U1
# --------------------------------------------------------------------------

def _period_gainers_sql(bars_cte: str, as_of: dt.date, days: int, n: int) -> str:
    start = as_of - dt.timedelta(days=days)
    return with_cte(bars_cte, f"""
fl AS (
  SELECT exchange, symbol, min(date) AS first_date, max(date) AS last_date,
         arg_min(close, date) AS start_price, arg_max(close, date) AS end_price,
         arg_max(volume, date) AS volume
  FROM bars WHERE date BETWEEN {_lit_date(start)} AND {_lit_date(as_of)}
  GROUP BY exchange, symbol)""") + f"""
SELECT *, {S.pct('end_price', 'start_price')} AS change_pct FROM fl
ORDER BY change_pct DESC NULLS LAST, exchange, symbol LIMIT {n}"""


@register("t4_period_gainers", _period_gainers_sql(T.BARS_SQL, AS_OF, 7, 10), bench=True)
def t4_period_gainers(spark, sf):
    return rankings.period_gainers(T.bars(spark, sf), AS_OF, days=7, n=10)


@register("t4_period_gainers_brand", _period_gainers_sql(T.BRAND_BARS_SQL, BRAND_AS_OF, 30, 10))
def t4_period_gainers_brand(spark, sf):
    return rankings.period_gainers(T.brand_bars(spark, sf), BRAND_AS_OF, days=30, n=10)


PROCESSED_SQL = f"""
processed AS (
  SELECT *, {S.pct('close', 'open')} AS daily_return, high - low AS price_range,
         (high + low + close) / 3 AS avg_price,
         CASE WHEN volume > {{high}} THEN 'HIGH' WHEN volume > {{medium}} THEN 'MEDIUM' ELSE 'LOW' END
           AS volume_category,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(day(date) AS INTEGER) AS day
  FROM (SELECT date, open, high, low, close, volume, exchange, symbol,
               TIMESTAMP '{LOADED_AT}' AS download_timestamp
        FROM bars WHERE close IS NOT NULL AND volume > {{min_volume}} AND date IS NOT NULL) t)"""


def processed_sql(high=VOL_HIGH, medium=VOL_MEDIUM, min_volume=0) -> str:
    return PROCESSED_SQL.format(high=high, medium=medium, min_volume=min_volume)


def processed(spark, sf, high=VOL_HIGH, medium=VOL_MEDIUM, min_volume=0):
    return clean.process_bars(T.bars(spark, sf), min_volume=min_volume, high=high,
                              medium=medium, loaded_at=LOADED_AT)


@register("p1_process_bars", with_cte(T.BARS_SQL, processed_sql()) + "SELECT * FROM processed",
          bench=True)
def p1_process_bars(spark, sf):
    return processed(spark, sf)


@register("p7_process_bars_min_volume",
          with_cte(T.BARS_SQL, processed_sql(min_volume=2)) + "SELECT * FROM processed")
def p7_process_bars_min_volume(spark, sf):
    return processed(spark, sf, min_volume=2)


@register("p1_process_brand_bars",
          with_cte(T.BRAND_BARS_SQL, processed_sql(1_000_000, 100_000))
          + "SELECT * FROM processed")
def p1_process_brand_bars(spark, sf):
    return clean.process_bars(T.brand_bars(spark, sf), loaded_at=LOADED_AT)


# Raw snapshots with overlap: every bar is downloaded the next day (first
# snapshot) and again five days later, when bars with volume >= 5 come back
# with a revised close.  U1 must keep exactly one row per key.
def snapshot_waves(spark, sf):
    """(first downloads, re-downloads) of every bar."""
    b = T.bars(spark, sf)
    first = b.withColumn("download_timestamp",
                         F.col("date").cast("timestamp_ntz") + F.expr("INTERVAL 30 HOURS"))
    second = (b.withColumn("close", F.when(F.col("volume") >= 5, F.col("close") + F.lit(0.5))
                           .otherwise(F.col("close")))
              .withColumn("download_timestamp",
                          F.col("date").cast("timestamp_ntz") + F.expr("INTERVAL 126 HOURS")))
    return first, second


def raw_snapshots(spark, sf):
    first, second = snapshot_waves(spark, sf)
    return first.unionByName(second)


RAW_SQL = """
raw AS (
  SELECT exchange, symbol, date, open, high, low, close, volume,
         CAST(date AS TIMESTAMP) + INTERVAL 30 HOUR AS download_timestamp FROM bars
  UNION ALL
  SELECT exchange, symbol, date, open, high, low,
         CASE WHEN volume >= 5 THEN close + 0.5 ELSE close END AS close, volume,
         CAST(date AS TIMESTAMP) + INTERVAL 126 HOUR AS download_timestamp FROM bars)"""


def _dedupe_sql(policy: str) -> str:
    agg = "arg_min" if policy == "first" else "arg_max"
    return with_cte(T.BARS_SQL, RAW_SQL) + f"""
SELECT exchange, symbol, date, r.open, r.high, r.low, r.close, r.volume, r.download_timestamp
FROM (SELECT exchange, symbol, date,
             {agg}({{'open': open, 'high': high, 'low': low, 'close': close, 'volume': volume,
                    'download_timestamp': download_timestamp}},
                   row(download_timestamp, open, high, low, close, volume)) AS r
      FROM raw GROUP BY exchange, symbol, date) t"""


@register("u1_dedupe_first", _dedupe_sql("first"))
def u1_dedupe_first(spark, sf):
    return clean.dedupe_bars(raw_snapshots(spark, sf), policy="first")


@register("u1_dedupe_last", _dedupe_sql("last"))
def u1_dedupe_last(spark, sf):
    return clean.dedupe_bars(raw_snapshots(spark, sf), policy="last")


# --------------------------------------------------------------------------
# Step 3: indicators W1-W8, W18
# --------------------------------------------------------------------------

def indicators_sql(src: str = "bars") -> str:
    w = S.win()
    mas = ",\n         ".join(f"{S.mean('close', S.win(n))} AS ma_{n}" for n in (5, 10, 20, 50))
    # deviations one by one from the frame's values (_frame)
    return f"""
ind1 AS (
  SELECT *, {mas},
         close - lag(close) OVER {w} AS price_change, list(close) OVER {S.win(20)} AS _frame
  FROM {src}),
ind2 AS (
  SELECT * EXCLUDE (_frame), {S.list_stddev('_frame')} AS std_20,
         CASE WHEN price_change > 0 THEN price_change ELSE {S.d(0.0)} END AS gain,
         CASE WHEN price_change < 0 THEN -price_change ELSE {S.d(0.0)} END AS loss
  FROM ind1),
ind3 AS (
  SELECT *, {S.mean('gain', S.win(14))} AS avg_gain,
         {S.mean('loss', S.win(14))} AS avg_loss,
         {S.mean('close', S.win(20))} AS _ma_bb,
         {S.mean('close', S.win(12))} AS ema_12,
         {S.mean('close', S.win(26))} AS ema_26,
         {S.mean('volume', S.win(10), 'DECIMAL(20,0)')} AS volume_ma_10
  FROM ind2),
ind4 AS (
  SELECT *, CASE WHEN avg_loss = 0 THEN {S.d(100.0)} ELSE {S.div('avg_gain', 'avg_loss')} END AS rs,
         _ma_bb + {S.d(2.0)} * std_20 AS bb_upper,
         _ma_bb - {S.d(2.0)} * std_20 AS bb_lower,
         ema_12 - ema_26 AS macd,
         {S.div('CAST(volume AS DOUBLE)', 'volume_ma_10')} AS volume_ratio
  FROM ind3),
ind AS (
  SELECT * EXCLUDE (_ma_bb),
         {S.d(100.0)} - {S.div(S.d(100.0), f"{S.d(1.0)} + rs")} AS rsi,
         {S.div('close - bb_lower', 'bb_upper - bb_lower')} AS bb_position
  FROM ind4)"""


@register("w1_moving_averages_brand", with_cte(T.BRAND_BARS_SQL, f"""
ma AS (SELECT *, {", ".join(f"{S.mean('close', S.win(n))} AS ma_{n}" for n in (5, 10, 20, 50))} FROM bars)""")
          + "SELECT * FROM ma")
def w1_moving_averages_brand(spark, sf):
    return indicators.add_moving_averages(T.brand_bars(spark, sf))


@register("w1_indicators", with_cte(T.BARS_SQL, indicators_sql()) + "SELECT * FROM ind",
          bench=True)
def w1_indicators(spark, sf):
    return indicators.add_indicators(T.bars(spark, sf))


@register("w1_indicators_brand", with_cte(T.BRAND_BARS_SQL, indicators_sql()) + "SELECT * FROM ind",
          bench=True)
def w1_indicators_brand(spark, sf):
    return indicators.add_indicators(T.brand_bars(spark, sf))


RETURNS_SQL = f"""
ret AS (
  SELECT *, {S.pct('close', 'prev_close')} AS daily_return_pct,
         {S.mean('close', S.win(5))} AS ma_5, {S.mean('close', S.win(20))} AS ma_20
  FROM (SELECT *, lag(close) OVER {S.win()} AS prev_close FROM bars) t)"""


@register("w18_returns_brand", with_cte(T.BRAND_BARS_SQL, RETURNS_SQL) + "SELECT * FROM ret")
def w18_returns_brand(spark, sf):
    return indicators.add_returns(T.brand_bars(spark, sf))


# --------------------------------------------------------------------------
# Step 4: anomalies W9-W12, signals W13-W17, A3, T1-T3
# --------------------------------------------------------------------------

def anomalies_sql(src: str = "bars") -> str:
    w0 = S.win(order=False)
    flag = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END"
    return f"""
an1 AS (
  SELECT *, {S.mean('volume', w0, 'DECIMAL(20,0)')} AS volume_mean,
         {S.volume_stddev('volume', w0)} AS volume_std,
         lag(close) OVER {S.win()} AS prev_close
  FROM {src}),
an2 AS (
  SELECT *, {S.div('volume - volume_mean', 'volume_std')} AS volume_zscore,
         {S.pct('close', 'prev_close')} AS price_change_pct,
         {S.pct('open', 'prev_close')} AS opening_gap_pct
  FROM an1),
an3 AS (
  SELECT *, abs(volume_zscore) > {S.d(3.0)} AS is_volume_anomaly,
         abs(price_change_pct) AS price_change_abs,
         abs(opening_gap_pct) > {S.d(5.0)} AS is_gap_anomaly
  FROM an2),
an4 AS (SELECT *, price_change_abs > {S.d(10.0)} AS is_price_anomaly FROM an3),
an AS (
  SELECT *, ({flag('is_volume_anomaly')} + {flag('is_price_anomaly')} + {flag('is_gap_anomaly')})
            AS anomaly_score
  FROM an4),
flagged AS (SELECT *, anomaly_score >= 2 AS has_anomaly FROM an)"""


@register("w9_anomalies", with_cte(T.BARS_SQL, anomalies_sql()) + "SELECT * FROM flagged")
def w9_anomalies(spark, sf):
    return anomalies.add_anomalies(T.bars(spark, sf))


@register("w9_anomalies_brand", with_cte(T.BRAND_BARS_SQL, anomalies_sql()) + "SELECT * FROM flagged")
def w9_anomalies_brand(spark, sf):
    return anomalies.add_anomalies(T.brand_bars(spark, sf))


def signals_sql(src: str = "ind") -> str:
    w = S.win()
    return f"""
sg1 AS (
  SELECT *,
    CASE WHEN ma_5 > ma_20 AND lag(ma_5) OVER {w} <= lag(ma_20) OVER {w} THEN 'BUY'
         WHEN ma_5 < ma_20 AND lag(ma_5) OVER {w} >= lag(ma_20) OVER {w} THEN 'SELL'
         ELSE 'HOLD' END AS ma_crossover,
    CASE WHEN rsi < {S.d(30.0)} THEN 'OVERSOLD' WHEN rsi > {S.d(70.0)} THEN 'OVERBOUGHT'
         ELSE 'NEUTRAL' END AS rsi_signal,
    CASE WHEN close < bb_lower THEN 'OVERSOLD' WHEN close > bb_upper THEN 'OVERBOUGHT'
         ELSE 'WITHIN_BANDS' END AS bb_signal,
    CASE WHEN volume_ratio > {S.d(2.0)} THEN 'HIGH_VOLUME'
         WHEN volume_ratio < {S.d(0.5)} THEN 'LOW_VOLUME' ELSE 'NORMAL_VOLUME' END AS volume_signal
  FROM {src}),
sig AS (
  SELECT *,
    CASE WHEN ma_crossover = 'BUY' AND rsi_signal = 'OVERSOLD' AND bb_signal = 'OVERSOLD' THEN 'STRONG_BUY'
         WHEN ma_crossover = 'SELL' AND rsi_signal = 'OVERBOUGHT' AND bb_signal = 'OVERBOUGHT' THEN 'STRONG_SELL'
         WHEN ma_crossover = 'BUY' THEN 'BUY' WHEN ma_crossover = 'SELL' THEN 'SELL'
         ELSE 'HOLD' END AS combined_signal
  FROM sg1)"""


def _signals(bars_df):
    return signals.add_signals(indicators.add_indicators(bars_df, prev=(5, 20)))


@register("w13_signals_brand", with_cte(T.BRAND_BARS_SQL, indicators_sql(), signals_sql())
          + "SELECT * FROM sig", bench=True)
def w13_signals_brand(spark, sf):
    return _signals(T.brand_bars(spark, sf))


@register("w13_signals", with_cte(T.BARS_SQL, indicators_sql(), signals_sql()) + "SELECT * FROM sig")
def w13_signals(spark, sf):
    return _signals(T.bars(spark, sf))


@register("a3_signal_counts_brand", with_cte(T.BRAND_BARS_SQL, indicators_sql(), signals_sql())
          + "SELECT combined_signal, count(*) AS n_rows FROM sig GROUP BY combined_signal")
def a3_signal_counts_brand(spark, sf):
    return signals.signal_counts(_signals(T.brand_bars(spark, sf)))


DAY_SQL = """
today AS (SELECT * FROM processed WHERE date = (SELECT max(date) FROM processed))"""


@register("t1_day_gainers", with_cte(T.BARS_SQL, processed_sql(), DAY_SQL) + """
SELECT symbol, exchange, daily_return, close AS price, volume FROM today WHERE daily_return > 0
ORDER BY daily_return DESC, exchange, symbol LIMIT 10""")
def t1_day_gainers(spark, sf):
    return rankings.day_gainers(processed(spark, sf), n=10)


@register("t2_day_volume", with_cte(T.BARS_SQL, processed_sql(), DAY_SQL) + """
SELECT symbol, exchange, volume, close AS price FROM today
ORDER BY volume DESC NULLS LAST, exchange, symbol LIMIT 10""")
def t2_day_volume(spark, sf):
    return rankings.day_volume(processed(spark, sf), n=10)


@register("t3_anomaly_list_brand", with_cte(T.BRAND_BARS_SQL, anomalies_sql()) + """
SELECT DISTINCT symbol, exchange, date, anomaly_score FROM flagged WHERE has_anomaly
ORDER BY anomaly_score DESC, date DESC, exchange, symbol LIMIT 20""")
def t3_anomaly_list_brand(spark, sf):
    return rankings.anomaly_list(anomalies.add_anomalies(T.brand_bars(spark, sf)), n=20)


# --------------------------------------------------------------------------
# Step 2: profiles and summaries
# --------------------------------------------------------------------------

# the sample deviation's last digits follow the merge order of partial results
PROFILE_SELECT = f"""
SELECT * EXCLUDE (price_volatility), CAST(datediff('day', first_date, last_date) AS INTEGER) AS data_span_days,
       {S.significant('price_volatility')} AS price_volatility,
       {S.significant(f"{S.div('price_volatility', 'avg_price')} * 100")} AS price_range_ratio
FROM (SELECT symbol, exchange, count(*) AS record_count, min(date) AS first_date,
             max(date) AS last_date, {S.mean('close')} AS avg_price,
             stddev_samp(close) AS price_volatility,
             {S.mean('volume', None, 'DECIMAL(20,0)')} AS avg_volume,
             max(volume) AS max_volume, min(volume) AS min_volume,
             {S.mean('daily_return')} AS avg_daily_return
      FROM processed GROUP BY symbol, exchange) t"""


def shown_profile(df):
    """A profile with its deviation columns at ten significant digits."""
    return df.withColumns({c: C.significant(c) for c in ("price_volatility", "price_range_ratio")})


@register("a1_symbol_profile", with_cte(T.BARS_SQL, processed_sql()) + PROFILE_SELECT)
def a1_symbol_profile(spark, sf):
    return shown_profile(profile.symbol_profile(processed(spark, sf)))


# Prices of 1e-5 to 1e-3: nothing is left of them at four decimals.
FINE = 100_000.0
FINE_SQL = f"""
fine AS (SELECT * REPLACE (open / {S.d(FINE)} AS open, high / {S.d(FINE)} AS high, low / {S.d(FINE)} AS low,
                           close / {S.d(FINE)} AS close) FROM bars)"""


def fine(bars_df):
    return bars_df.withColumns({c: F.col(c) / F.lit(FINE) for c in ("open", "high", "low", "close")})


@register("a1_profile_fine", with_cte(T.BARS_SQL, FINE_SQL, processed_sql().replace("FROM bars", "FROM fine"))
          + PROFILE_SELECT)
def a1_profile_fine(spark, sf):
    bars_df = fine(T.bars(spark, sf))
    return shown_profile(profile.symbol_profile(clean.process_bars(
        bars_df, min_volume=0, high=VOL_HIGH, medium=VOL_MEDIUM, loaded_at=LOADED_AT)))


@register("w1_indicators_fine", with_cte(T.BARS_SQL, FINE_SQL, indicators_sql("fine")) + "SELECT * FROM ind")
def w1_indicators_fine(spark, sf):
    return indicators.add_indicators(fine(T.bars(spark, sf)))


@register("a5_market_summary", with_cte(T.BARS_SQL) + """
SELECT count(DISTINCT symbol) AS total_stocks, count(*) AS total_records,
       max(date) AS latest_update, min(date) AS min_date, max(date) AS max_date FROM bars""")
def a5_market_summary(spark, sf):
    return profile.market_summary(T.bars(spark, sf))


@register("a6_symbols_per_exchange", with_cte(T.BARS_SQL) + """
SELECT exchange, count(DISTINCT symbol) AS n_symbols FROM bars GROUP BY exchange""")
def a6_symbols_per_exchange(spark, sf):
    return profile.symbols_per_exchange(T.bars(spark, sf))


@register("t5_high_volume", with_cte(T.BARS_SQL, T.META_SQL) + f"""
, top AS (
  SELECT exchange, symbol, {S.div('CAST(sum(volume) AS DOUBLE)', 'count(volume)')} AS avg_volume
  FROM bars WHERE date BETWEEN {_lit_date(AS_OF - dt.timedelta(days=7))} AND {_lit_date(AS_OF)}
  GROUP BY exchange, symbol ORDER BY avg_volume DESC NULLS LAST, exchange, symbol LIMIT 20),
names AS (SELECT exchange, symbol, min(company_name) AS company_name FROM meta GROUP BY exchange, symbol)
SELECT top.exchange, top.symbol, coalesce(names.company_name, 'Unknown') AS company_name, avg_volume,
       coalesce(CAST(trunc(avg_volume) AS BIGINT), 0) AS avg_volume_int
FROM top LEFT JOIN names ON top.exchange = names.exchange AND top.symbol = names.symbol""")
def t5_high_volume(spark, sf):
    return rankings.high_volume(T.bars(spark, sf), T.symbol_meta(spark, sf), AS_OF, days=7, n=20)


@register("a11_table_stats", with_cte(T.BARS_SQL) + """
SELECT 'bars' AS table_name, count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols,
       min(date) AS min_date, max(date) AS max_date FROM bars""")
def a11_table_stats(spark, sf):
    return profile.table_stats(T.bars(spark, sf), "bars")


@register("a12_table_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in T.TABLES))
def a12_table_row_counts(spark, sf):
    return profile.row_counts({t: T.read_table(spark, sf, t) for t in T.TABLES})


def _span_start_sql(as_of: dt.date, span: str) -> str:
    unit, n = profile.SPANS[span]
    return f"({_lit_date(as_of)} - INTERVAL {n} {'DAY' if unit == 'days' else 'MONTH'})"


def period_stats_sql(bars_cte: str, as_of: dt.date, span: str) -> str:
    return with_cte(bars_cte) + f"""
, p AS (SELECT * FROM bars WHERE date BETWEEN CAST({_span_start_sql(as_of, span)} AS DATE) AND {_lit_date(as_of)}),
s AS (
  SELECT exchange, symbol, arg_min(close, date) AS first_price, arg_max(close, date) AS latest_price,
         {S.div('CAST(sum(volume) AS DOUBLE)', 'count(volume)')} AS avg_volume,
         max(close) AS max_price, min(close) AS min_price, count(*) AS trading_days
  FROM p GROUP BY exchange, symbol)
SELECT *, latest_price - first_price AS price_change,
       coalesce({S.pct('latest_price', 'first_price')}, {S.d(0.0)}) AS price_change_pct,
       {S.div('latest_price', 'max_price')} * 100 AS pct_of_max,
       {S.div('latest_price', 'min_price')} * 100 AS pct_of_min
FROM s"""


@register("a15_period_stats", period_stats_sql(T.BARS_SQL, AS_OF, "1m"))
def a15_period_stats(spark, sf):
    return profile.period_stats(T.bars(spark, sf), AS_OF, span="1m")


@register("a15_period_stats_brand_3m", period_stats_sql(T.BRAND_BARS_SQL, BRAND_AS_OF, "3m"))
def a15_period_stats_brand_3m(spark, sf):
    return profile.period_stats(T.brand_bars(spark, sf), BRAND_AS_OF, span="3m")


@register("a15_period_stats_brand_1y", period_stats_sql(T.BRAND_BARS_SQL, BRAND_AS_OF, "1y"))
def a15_period_stats_brand_1y(spark, sf):
    return profile.period_stats(T.brand_bars(spark, sf), BRAND_AS_OF, span="1y")


@register("a15_period_stats_1w", period_stats_sql(T.BARS_SQL, AS_OF, "1w"))
def a15_period_stats_1w(spark, sf):
    return profile.period_stats(T.bars(spark, sf), AS_OF, span="1w")


@register("a16_exchange_share", with_cte(T.BARS_SQL) + f"""
SELECT exchange, n_bars, {S.div('CAST(n_bars AS DOUBLE)', 'CAST(sum(n_bars) OVER () AS DOUBLE)')} * 100 AS share_pct
FROM (SELECT exchange, count(*) AS n_bars FROM bars GROUP BY exchange) t""")
def a16_exchange_share(spark, sf):
    return profile.exchange_share(T.bars(spark, sf))


@register("a14_dimension_counts", with_cte(T.META_SQL) + """
SELECT count(DISTINCT exchange) AS n_exchanges,
       count(DISTINCT CASE WHEN sector <> '' THEN sector END) AS n_sectors,
       count(*) AS n_symbols FROM meta""")
def a14_dimension_counts(spark, sf):
    return profile.dimension_counts(T.symbol_meta(spark, sf))


@register("a18_distinct_exchange_dates", with_cte(T.BARS_SQL) + """
SELECT DISTINCT exchange, date FROM bars""")
def a18_distinct_exchange_dates(spark, sf):
    return T.bars(spark, sf).select("exchange", "date").distinct()
