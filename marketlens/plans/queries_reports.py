"""Catalog entries for collection reports, the analysis
pipeline and insights report (step 8), clustering (step 10) and the
report reader over three versions (S17)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.operators import clusters, collection, insights, profile
from marketlens.plans import sqlgen as S
from marketlens.plans.catalog import register, with_cte
from marketlens.plans.queries_bars import (
    AS_OF, PROFILE_SELECT, anomalies_sql, indicators_sql, processed, processed_sql, signals_sql,
)
from marketlens.session import scratch_path
from marketlens.sources import ingest, sinks
from marketlens.sources import tables as T

CYCLE_DAYS = 30


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


# Exchanges as boards of a nation: by market segment, or by the sign of the
# account balance.  kinds, then the kind of a customer in Spark and in SQL.
BOARDS = {
    "segment": (("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), "c_mktsegment"),
    "balance": (("CREDIT", "DEBIT"), "CASE WHEN c_acctbal < 0 THEN 'DEBIT' ELSE 'CREDIT' END"),
}


def listed_symbols(spark, sf, board: str | None = None):
    """The cycle's symbol list: every named customer, on the exchange of its
    nation or on a board of it."""
    exchange = T.exchange_of(F.col("c_nationkey"))
    if board:
        exchange = F.concat_ws("_", exchange, F.expr(BOARDS[board][1]))
    listed = T.read_table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("name"), exchange.alias("exchange"))
    return (ingest.clean_symbols(listed, per_exchange=None)
            .select("exchange", F.col("code").alias("symbol")))


def attempts(spark, sf, days=CYCLE_DAYS, board: str | None = None):
    listed, bars = listed_symbols(spark, sf, board), T.bars(spark, sf)
    if board:
        bars = bars.drop("exchange").join(listed, "symbol")
    return collection.attempts(listed, bars, AS_OF, days)


def attempts_sql(days=CYCLE_DAYS, board: str | None = None) -> str:
    exchange = "'NATION_' || CAST(c_nationkey AS VARCHAR)" + (f" || '_' || {BOARDS[board][1]}" if board else "")
    bars = ("(SELECT b.* REPLACE (l.exchange AS exchange) FROM bars b JOIN listed l ON l.symbol = b.symbol)"
            if board else "bars")
    return f"""
listed AS (
  SELECT CAST(c_custkey AS VARCHAR) AS symbol, {exchange} AS exchange FROM customer WHERE c_name <> ''),
per AS (
  SELECT exchange, symbol, count(*) AS _n,
         count(*) FILTER (WHERE NOT coalesce(close IS NOT NULL AND date IS NOT NULL AND volume > 0, false)) AS _bad
  FROM {bars} t WHERE date BETWEEN {_d(AS_OF - dt.timedelta(days=days))} AND {_d(AS_OF)}
  GROUP BY exchange, symbol),
att AS (
  SELECT s.exchange, s.symbol, coalesce(p._n, 0) AS data_points,
         coalesce(p._n, 0) > 0 AS successful,
         CASE WHEN coalesce(p._n, 0) > 0 THEN 1 ELSE 0 END AS files,
         CASE WHEN coalesce(p._n, 0) > 0 THEN 1 ELSE 0 END AS hdfs_uploads,
         coalesce(p._n, 0) > 0 AND coalesce(p._bad, 0) = 0 AS db_ok
  FROM (SELECT DISTINCT exchange, symbol FROM listed) s
  LEFT JOIN per p ON s.exchange = p.exchange AND s.symbol = p.symbol)"""


REPORT_AGGS = """
count(*) FILTER (WHERE successful) AS successful_symbols,
count(*) FILTER (WHERE NOT successful) AS failed_symbols,
CAST(sum(data_points) AS BIGINT) AS data_points,
CAST(sum(hdfs_uploads) AS BIGINT) AS hdfs_upload_count,
CAST(sum(files) AS BIGINT) AS files,
count(*) FILTER (WHERE successful AND db_ok) AS database_success,
count(*) FILTER (WHERE successful AND NOT db_ok) AS database_failed"""

REPORT_SQL = f"""
rep AS (SELECT exchange, {REPORT_AGGS} FROM att GROUP BY exchange)"""


def _rate(ok: str, failed: str) -> str:
    return f"{S.div(f'CAST({ok} AS DOUBLE)', f'CAST(({ok}) + ({failed}) AS DOUBLE)')} * {S.d(100.0)}"


@register("a8_collection_report", with_cte(T.BARS_SQL, attempts_sql(), REPORT_SQL)
          + "SELECT * FROM rep")
def a8_collection_report(spark, sf):
    return collection.report(attempts(spark, sf))


@register("a8_collection_report_totals", with_cte(T.BARS_SQL, attempts_sql()) + f"""
SELECT CASE WHEN g = 1 THEN 'ALL' ELSE exchange END AS exchange,
       successful_symbols, failed_symbols, data_points, hdfs_upload_count, files,
       database_success, database_failed,
       {_rate('successful_symbols', 'failed_symbols')} AS success_rate
FROM (SELECT exchange, GROUPING(exchange) AS g, {REPORT_AGGS}
      FROM att GROUP BY ROLLUP (exchange)) t""")
def a8_collection_report_totals(spark, sf):
    return collection.report_with_totals(attempts(spark, sf))


@register("a9_collection_totals", with_cte(T.BARS_SQL, attempts_sql(), REPORT_SQL) + f"""
SELECT *, {_rate('total_successful', 'total_failed')} AS success_rate
FROM (SELECT count(*) AS total_exchanges,
             CAST(sum(successful_symbols) AS BIGINT) AS total_successful,
             CAST(sum(failed_symbols) AS BIGINT) AS total_failed,
             CAST(sum(data_points) AS BIGINT) AS total_data_points,
             CAST(sum(hdfs_upload_count) AS BIGINT) AS total_hdfs_uploads FROM rep) t""")
def a9_collection_totals(spark, sf):
    return collection.totals(collection.report(attempts(spark, sf)))


@register("t8_top_exchanges", with_cte(T.BARS_SQL, attempts_sql(), REPORT_SQL) + """
SELECT exchange, successful_symbols AS symbols, data_points, hdfs_upload_count AS hdfs_uploads
FROM rep WHERE data_points > 0 ORDER BY data_points DESC, exchange LIMIT 10""")
def t8_top_exchanges(spark, sf):
    return collection.top(collection.report(attempts(spark, sf)), n=10)


def _without_data_sql(board: str) -> str:
    kinds = ", ".join(f"'{k}'" for k in BOARDS[board][0])
    return with_cte(T.BARS_SQL, attempts_sql(0, board), REPORT_SQL, f"""
boards AS (SELECT 'NATION_' || CAST(n_nationkey AS VARCHAR) || '_' || kind AS exchange
           FROM nation, (SELECT unnest([{kinds}]) AS kind))""") + """
SELECT exchange FROM rep WHERE data_points = 0
UNION
SELECT exchange FROM boards WHERE exchange NOT IN (SELECT exchange FROM rep)"""


def _without_data(spark, sf, board: str):
    kinds = F.explode(F.array(*map(F.lit, BOARDS[board][0])))
    boards = (T.read_table(spark, sf, "nation").select("n_nationkey", kinds.alias("kind"))
              .select(F.concat_ws("_", T.exchange_of(F.col("n_nationkey")), "kind").alias("exchange")))
    return collection.without_data(collection.report(attempts(spark, sf, days=0, board=board)), boards)


@register("j9_exchanges_without_data", _without_data_sql("segment"))
def j9_exchanges_without_data(spark, sf):
    """J9 for a cycle of one day over all listed symbols and all bars, a
    board per nation and market segment."""
    return _without_data(spark, sf, "segment")


@register("j9_exchanges_without_data_by_balance", _without_data_sql("balance"))
def j9_exchanges_without_data_by_balance(spark, sf):
    """J9 over all listed symbols and all bars, a board per nation and sign of
    the account balance."""
    return _without_data(spark, sf, "balance")


# --------------------------------------------------------------------------
# Reports of two cycles published, read back from JSON and CSV
# --------------------------------------------------------------------------

PUBLISHED_SCHEMA = ("exchange string, successful_symbols bigint, failed_symbols bigint, data_points bigint, "
                    "hdfs_upload_count bigint, files bigint, database_success bigint, database_failed bigint")


@register("s12_published_reports", "\nUNION ALL\n".join(
    f"SELECT * FROM ({with_cte(T.BARS_SQL, attempts_sql(days), REPORT_SQL)} "
    f"SELECT 'cycle_{name}' AS report, f.format, rep.* FROM rep, (VALUES ('json'), ('csv')) f(format)) c{name}"
    for name, days in (("a", CYCLE_DAYS), ("b", 7))))
def s12_published_reports(spark, sf):
    """Two cycles publish their reports; the first is published early and
    then again, an empty report and a staged one without a manifest entry
    stay unseen."""
    path = scratch_path(spark, "published")
    early = collection.report(attempts(spark, sf, days=0))
    whole = collection.report(attempts(spark, sf, days=CYCLE_DAYS))
    sinks.publish_report(early, path, "cycle_a")
    sinks.publish_report(collection.report(attempts(spark, sf, days=7)), path, "cycle_b")
    sinks.publish_report(early.where("false"), path, "cycle_c")
    sinks.publish_report(whole, path, "cycle_a")
    early.write.json(f"{path}/json/cycle_d-unfinished")
    parts = [sinks.read_published(spark, path, f, PUBLISHED_SCHEMA).withColumn("format", F.lit(f))
             for f in sinks.REPORT_FORMATS]
    return parts[0].unionByName(parts[1])


# --------------------------------------------------------------------------
# Step 8: analysis pipeline (Q2), insights report (Q3, P26), results
# --------------------------------------------------------------------------


ANALYSIS_CTES = (T.BARS_SQL, processed_sql(), indicators_sql("processed"),
                 anomalies_sql("ind"), signals_sql("flagged"))


def analysed(spark, sf):
    return insights.analysis(processed(spark, sf))


@register("q2_analysis_pipeline", with_cte(*ANALYSIS_CTES) + "SELECT * FROM sig", bench=True)
def q2_analysis_pipeline(spark, sf):
    return analysed(spark, sf)


def insights_flat_sql(ctes=ANALYSIS_CTES, volume: str = "volume") -> str:
    return with_cte(*ctes) + INSIGHTS_FLAT_TAIL.format(volume=volume)


INSIGHTS_FLAT_TAIL = """
, today AS (SELECT * FROM sig WHERE date = (SELECT max(date) FROM sig)),
g AS (SELECT symbol, exchange, daily_return, close AS price, {volume} AS volume FROM today
      WHERE daily_return > 0 ORDER BY daily_return DESC, exchange, symbol LIMIT 10),
v AS (SELECT symbol, exchange, {volume} AS volume, close AS price FROM today
      ORDER BY volume DESC NULLS LAST, exchange, symbol LIMIT 10),
a AS (SELECT DISTINCT symbol, exchange, date, anomaly_score FROM sig WHERE has_anomaly
      ORDER BY anomaly_score DESC, date DESC, exchange, symbol LIMIT 20)
SELECT 'top_gainers' AS section,
       CAST(row_number() OVER (ORDER BY daily_return DESC, exchange, symbol) AS INTEGER) AS rank,
       symbol, exchange, daily_return, price, volume, CAST(NULL AS DATE) AS date,
       CAST(NULL AS INTEGER) AS anomaly_score, CAST(NULL AS VARCHAR) AS signal,
       CAST(NULL AS BIGINT) AS n_rows FROM g
UNION ALL
SELECT 'top_volume', CAST(row_number() OVER (ORDER BY volume DESC NULLS LAST, exchange, symbol) AS INTEGER),
       symbol, exchange, NULL, price, volume, NULL, NULL, NULL, NULL FROM v
UNION ALL
SELECT 'anomaly_stocks',
       CAST(row_number() OVER (ORDER BY anomaly_score DESC, date DESC, exchange, symbol) AS INTEGER),
       symbol, exchange, NULL, NULL, NULL, date, anomaly_score, NULL, NULL FROM a
UNION ALL
SELECT 'trading_signals', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, combined_signal, count(*)
FROM sig GROUP BY combined_signal
UNION ALL
SELECT 'latest_date', NULL, NULL, NULL, NULL, NULL, NULL, max(date), NULL, NULL, NULL FROM sig"""


@register("q3_insights_flat", insights_flat_sql())
def q3_insights_flat(spark, sf):
    return insights.flatten(insights.report(analysed(spark, sf)))


@register("q3_insights_json")
def q3_insights_json(spark, sf):
    """The one-row JSON report (rows-only; its content is checked
    flattened by q3_insights_flat)."""
    return insights.report_json(insights.report(analysed(spark, sf)))


RESULTS_SQL = """
res AS (
  SELECT symbol, exchange, 'technical_analysis' AS analysis_type,
         arg_max(rsi, date) AS rsi, arg_max(macd, date) AS macd, arg_max(ma_50, date) AS sma_50,
         arg_max(combined_signal, date) AS signal, max(date) AS generated_at
  FROM sig GROUP BY symbol, exchange)"""


@register("p27_result_fields", with_cte(*ANALYSIS_CTES, RESULTS_SQL) + """
SELECT symbol, exchange, analysis_type, generated_at, rsi, macd, sma_50,
       CAST(NULL AS DOUBLE) AS sma_200, CAST(NULL AS DOUBLE) AS support,
       CAST(NULL AS DOUBLE) AS resistance, signal, CAST(NULL AS DOUBLE) AS confidence
FROM res""")
def p27_result_fields(spark, sf):
    return insights.parse_results(insights.analysis_results(analysed(spark, sf)))


@register("p27_result_signal", with_cte(*ANALYSIS_CTES, RESULTS_SQL) + """
SELECT symbol, exchange, analysis_type, signal FROM res""")
def p27_result_signal(spark, sf):
    return insights.result_field(insights.analysis_results(analysed(spark, sf)), "$.signal", "signal")


# --------------------------------------------------------------------------
# Step 10: clustering (M1-M4, A4): draws, moves and labels recomputed in SQL
# --------------------------------------------------------------------------

K, SEED = 5, 42
_D2 = "power(p.z0 - c.z0, 2) + power(p.z1 - c.z1, 2) + power(p.z2 - c.z2, 2)"


def cluster_ctes() -> tuple[str, ...]:
    """CTEs up to ``clustered``: one per drawn centre and one pair per move."""
    z = ", ".join(f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0) AS z{i}"
                  for i, c in enumerate(clusters.FEATURES))
    out = [f"""
pts AS MATERIALIZED (
  SELECT symbol, exchange, {', '.join(clusters.FEATURES)}, {z},
         md5('{SEED}|' || exchange || '|' || symbol) AS h
  FROM ({PROFILE_SELECT}) f
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in clusters.FEATURES)})""", """
draw0 AS MATERIALIZED (SELECT 0 AS i, z0, z1, z2 FROM pts ORDER BY h, exchange, symbol LIMIT 1)"""]
    for j in range(1, K):
        out.append(f"""
draw{j} AS MATERIALIZED (
  SELECT * FROM draw{j - 1} UNION ALL
  (SELECT {j}, z0, z1, z2 FROM (
     SELECT p.exchange, p.symbol, p.z0, p.z1, p.z2, min({_D2}) AS d2,
            (CAST('0x' || substr(p.h, 1, {clusters.HASH_DIGITS}) AS BIGINT) + 1) / {float(16 ** clusters.HASH_DIGITS)} AS u
     FROM pts p, draw{j - 1} c GROUP BY p.exchange, p.symbol, p.z0, p.z1, p.z2, p.h) t
   WHERE d2 > 0 ORDER BY -ln(u) / d2, exchange, symbol LIMIT 1))""")
    centres = f"draw{K - 1}"
    near = lambda n, centres: f"""
near{n} AS MATERIALIZED (
  SELECT p.*, c.i FROM pts p, {centres} c
  QUALIFY row_number() OVER (PARTITION BY p.exchange, p.symbol ORDER BY {_D2}, c.i) = 1)"""  # noqa: E731
    for n in range(clusters.ROUNDS):
        out += [near(n, centres), f"""
move{n} AS MATERIALIZED (
  SELECT c.i, coalesce(m.z0, c.z0) AS z0, coalesce(m.z1, c.z1) AS z1, coalesce(m.z2, c.z2) AS z2
  FROM {centres} c LEFT JOIN (SELECT i, avg(z0) AS z0, avg(z1) AS z1, avg(z2) AS z2 FROM near{n} GROUP BY i) m
  ON m.i = c.i)"""]
        centres = f"move{n}"
    texts = ", ".join(f"'{t}'" for t in clusters.DESCRIPTIONS)
    out += [near(clusters.ROUNDS, centres), f"""
clustered AS (
  SELECT n.i AS cluster, symbol, exchange, {', '.join(clusters.FEATURES)}, r.cluster_rank,
         ([{texts}])[r.cluster_rank + 1] AS cluster_description
  FROM near{clusters.ROUNDS} n
  JOIN (SELECT i, CAST(row_number() OVER (ORDER BY z1, z0, i) - 1 AS INTEGER) AS cluster_rank FROM {centres}) r
  ON r.i = n.i)"""]
    return tuple(out)


CLUSTER_SQL = with_cte(T.BARS_SQL, processed_sql(), *cluster_ctes())


def clustered(spark, sf):
    return clusters.cluster_symbols(profile.symbol_profile(processed(spark, sf)), k=K, seed=SEED)


@register("m1_cluster_symbols", CLUSTER_SQL + "SELECT * FROM clustered")
def m1_cluster_symbols(spark, sf):
    return clustered(spark, sf).withColumn("price_volatility", C.significant("price_volatility"))


@register("a4_cluster_distribution", CLUSTER_SQL + """
SELECT cluster, cluster_rank, cluster_description, count(*) AS n_rows FROM clustered
GROUP BY cluster, cluster_rank, cluster_description""")
def a4_cluster_distribution(spark, sf):
    return clusters.cluster_distribution(clustered(spark, sf))


# --------------------------------------------------------------------------
# The report in its three historical column versions, read back by name
# --------------------------------------------------------------------------


# Columns of the three report versions, in file order.
REPORT_V1 = ("exchange", "successful", "failed", "data_points", "files")
REPORT_V2 = ("exchange", "successful_symbols", "failed_symbols", "data_points", "files",
             "database_success", "database_failed")
REPORT_V3 = ("exchange", "successful_symbols", "failed_symbols", "data_points",
             "hdfs_upload_count", "files", "database_success", "database_failed")
REPORT_STAMPS = ("20240128_060000", "20240129_060000", "20240130_060000")


def write_report_versions(spark, sf) -> str:
    rep = collection.report(attempts(spark, sf))
    root = scratch_path(spark, "reports")
    v1 = rep.select("exchange", F.col("successful_symbols").alias("successful"),
                    F.col("failed_symbols").alias("failed"), "data_points", "files")
    for cols, stamp, df in ((REPORT_V1, REPORT_STAMPS[0], v1),
                            (REPORT_V2, REPORT_STAMPS[1], rep.select(*REPORT_V2)),
                            (REPORT_V3, REPORT_STAMPS[2], rep.select(*REPORT_V3))):
        name = "collection_report" if cols is REPORT_V1 else "collection_report_all"
        (df.select(*cols).repartition(1).write.option("header", True)
         .csv(f"{root}/{name}_{stamp}"))
    return root


def _ts(stamp: str) -> str:
    t = dt.datetime.strptime(stamp, "%Y%m%d_%H%M%S")
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


@register("s17_report_versions", with_cte(T.BARS_SQL, attempts_sql(), REPORT_SQL) + f"""
SELECT exchange, successful_symbols, failed_symbols, data_points,
       CAST(NULL AS BIGINT) AS hdfs_upload_count, files,
       CAST(NULL AS BIGINT) AS database_success, CAST(NULL AS BIGINT) AS database_failed,
       {_ts(REPORT_STAMPS[0])} AS report_time, CAST(0 AS BIGINT) AS n_bad_lines FROM rep
UNION ALL
SELECT exchange, successful_symbols, failed_symbols, data_points, CAST(NULL AS BIGINT), files,
       database_success, database_failed, {_ts(REPORT_STAMPS[1])}, 0 FROM rep
UNION ALL
SELECT exchange, successful_symbols, failed_symbols, data_points, hdfs_upload_count, files,
       database_success, database_failed, {_ts(REPORT_STAMPS[2])}, 0 FROM rep""")
def s17_report_versions(spark, sf):
    root = write_report_versions(spark, sf)
    return ingest.read_reports(spark, f"{root}/*/*.csv").drop("source_file")
