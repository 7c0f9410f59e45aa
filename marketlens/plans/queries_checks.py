"""Catalog entries that value-check what other entries only run: the CSV
copies read back (S7, S8), single-symbol lookups (P24, A15 for one symbol,
P22's 6m range), the emptiness guard (A17), what of the file audit does not
depend on the writer's partitioning (S14, A13), and the SQL-expressible part
of clustering (P25, M1, M2, A4 totals)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.operators import clusters, lookup, profile
from marketlens.plans import jobs
from marketlens.plans import queries_jobs as QJ
from marketlens.plans import queries_reports as QR
from marketlens.plans import sqlgen as S
from marketlens.plans.catalog import register, with_cte
from marketlens.plans.queries_bars import (
    AS_OF, BRAND_AS_OF, LOADED_AT, PROFILE_SELECT, RAW_SQL, VOL_HIGH, VOL_MEDIUM, anomalies_sql,
    indicators_sql, period_stats_sql, processed, processed_sql, signals_sql,
)
from marketlens.plans.queries_ingest import write_raw_landing
from marketlens.plans.queries_ops import LATEST_SQL
from marketlens.session import scratch_path
from marketlens.sources import ingest
from marketlens.sources import tables as T

SYMBOL = "5"            # a customer that every scale has


def read_csv_like(spark, path: str, like):
    """A headered CSV folder, columns by name with the types of ``like``."""
    text = spark.read.option("header", True).csv(path)
    return text.select(*[F.col(f.name).cast(f.dataType) for f in like.schema if f.name in text.columns])


@register("s7_csv_copy", with_cte(*QJ.JOB_BARS_CTES, processed_sql()) + "SELECT * FROM processed")
def s7_csv_copy(spark, sf):
    """The CSV copy of the processed bars: same rows and stamps as the
    Parquet files."""
    root = write_raw_landing(spark, sf)
    paths = jobs.processing_job(spark, f"{root}/*/*/*.csv", scratch_path(spark, "jobs"), high=VOL_HIGH,
                                medium=VOL_MEDIUM, loaded_at=LOADED_AT, csv_copy=True)
    daily = paths["daily_stocks"]
    return read_csv_like(spark, f"{daily}_csv", spark.read.parquet(daily))


@register("s8_analysis_csv", with_cte(*QJ.JOB_BARS_CTES, processed_sql(), indicators_sql("processed"),
                                      anomalies_sql("ind"), signals_sql("flagged")) + """
SELECT exchange, symbol, date, close, ma_5, ma_20, rsi, bb_position, ma_crossover, rsi_signal, bb_signal,
       volume_signal, combined_signal FROM sig""")
def s8_analysis_csv(spark, sf):
    """The analysis CSV read back."""
    out, paths = QJ._processing(spark, sf)
    res = jobs.analysis_job(spark, paths["daily_stocks"], out)
    return (read_csv_like(spark, res["technical_analysis"], spark.read.parquet(res["analysis"]))
            .select("exchange", "symbol", "date", "close", "ma_5", "ma_20", "rsi", "bb_position",
                    "ma_crossover", "rsi_signal", "bb_signal", "volume_signal", "combined_signal"))


@register("p24_symbol_detail", with_cte(T.BARS_SQL, T.META_SQL, LATEST_SQL) + f"""
SELECT m.symbol, m.company_name AS name, m.exchange, m.sector, m.industry, l.close AS price, l.date,
       l.close - l.open AS change, l.volume
FROM meta m LEFT JOIN latest l ON m.exchange = l.exchange AND m.symbol = l.symbol
WHERE m.symbol = '{SYMBOL}'""")
def p24_symbol_detail(spark, sf):
    return lookup.detail(T.symbol_meta(spark, sf), T.bars(spark, sf), symbol=SYMBOL)


@register("p24_symbol_history", with_cte(T.BARS_SQL) + f"""
SELECT exchange, symbol, date, open, high, low, close, volume FROM bars WHERE symbol = '{SYMBOL}'
ORDER BY date DESC, exchange LIMIT 100""")
def p24_symbol_history(spark, sf):
    return lookup.history(T.bars(spark, sf), symbol=SYMBOL)


@register("a15_period_stats_symbol", f"""
SELECT * FROM ({period_stats_sql(T.BARS_SQL, AS_OF, '1m')}) t WHERE symbol = '{SYMBOL}'""")
def a15_period_stats_symbol(spark, sf):
    return profile.period_stats(T.bars(spark, sf), AS_OF, span="1m", symbol=SYMBOL)


@register("a15_period_stats_brand_6m", period_stats_sql(T.BRAND_BARS_SQL, BRAND_AS_OF, "6m"))
def a15_period_stats_brand_6m(spark, sf):
    return profile.period_stats(T.brand_bars(spark, sf), BRAND_AS_OF, span="6m")


@register("a17_emptiness", with_cte(T.BARS_SQL) + """
SELECT (SELECT count(*) FROM bars) = 0 AS no_bars,
       (SELECT count(*) FROM bars WHERE close < 0 AND volume < 0) = 0 AS no_negative_bars""")
def a17_emptiness(spark, sf):
    """The guard over all bars and over a filter that finds none."""
    b = T.bars(spark, sf)
    flags = (profile.is_empty(b), profile.is_empty(b.filter("close < 0 AND volume < 0")))
    return spark.range(1).select(F.lit(flags[0]).alias("no_bars"), F.lit(flags[1]).alias("no_negative_bars"))


@register("s14_landing_directories", with_cte(T.BARS_SQL, RAW_SQL) + """
SELECT DISTINCT exchange AS path_exchange, CAST(download_timestamp AS DATE) AS snapshot_date FROM raw""")
def s14_landing_directories(spark, sf):
    """Directories with audited files: one per exchange and snapshot day."""
    audit = ingest.file_audit(spark, write_raw_landing(spark, sf), glob="*.csv")
    return audit.filter(F.col("size") > 0).select(
        F.regexp_extract("path", ingest.PATH_PARTS, 1).alias("path_exchange"),
        F.to_date(F.regexp_extract("path", ingest.PATH_PARTS, 2), "yyyyMMdd").alias("snapshot_date")).distinct()


@register("a13_exchange_directories", with_cte(T.BARS_SQL, RAW_SQL) + """
SELECT exchange AS path_exchange, count(DISTINCT CAST(download_timestamp AS DATE)) AS dir_count,
       CAST(0 AS BIGINT) AS file_count
FROM raw GROUP BY exchange""")
def a13_exchange_directories(spark, sf):
    """Per exchange directory: sub-directories (snapshot days) and files
    directly inside (none)."""
    root = write_raw_landing(spark, sf)
    totals = ingest.directory_totals(ingest.file_audit(spark, root, glob="*.csv"), root)
    name = F.regexp_extract("directory", r"/landing_exchange=([^/]+)$", 1)
    return (totals.withColumn("path_exchange", name).filter(F.col("path_exchange") != "")
            .select("path_exchange", "dir_count", "file_count"))


_LANDED = "CAST(exchange AS VARCHAR) AS x, strftime(date, '%Y%m%d') AS y, octet_length(encode(symbol || ',' || CAST(volume AS VARCHAR))) + 1 AS n"


@register("a13_directory_sizes", with_cte(T.BARS_SQL, f"l AS (SELECT {_LANDED} FROM bars)") + """
SELECT '' AS below, CAST(0 AS BIGINT) AS file_count, count(DISTINCT x) AS dir_count, CAST(0 AS BIGINT) AS total_size FROM l
UNION ALL SELECT '/x=' || x, 0, count(DISTINCT y), 0 FROM l GROUP BY x
UNION ALL SELECT '/x=' || x || '/y=' || y, 1, 0, CAST(sum(n) AS BIGINT) FROM l GROUP BY x, y""")
def a13_directory_sizes(spark, sf):
    """Sizes and counts of a landing of known files: a line per bar, one file
    per exchange and day."""
    root = scratch_path(spark, "lines")
    (T.bars(spark, sf).select(F.concat_ws(",", "symbol", F.col("volume").cast("string")).alias("value"),
                              F.col("exchange").alias("x"), F.date_format("date", "yyyyMMdd").alias("y"))
     .repartition("x").write.partitionBy("x", "y").text(root))
    totals = ingest.directory_totals(ingest.file_audit(spark, root, glob="*.txt"), root)
    return totals.select(F.substring_index("directory", root.split("://")[-1], -1).alias("below"),
                         "file_count", "dir_count", "total_size")


@register("p25_cluster_features", with_cte(T.BARS_SQL, processed_sql()) + f"""
SELECT symbol, exchange, avg_daily_return, price_volatility, avg_volume FROM ({PROFILE_SELECT}) p
WHERE avg_daily_return IS NOT NULL AND price_volatility IS NOT NULL AND avg_volume IS NOT NULL""")
def p25_cluster_features(spark, sf):
    """Profiles that enter clustering: rows with any missing feature go."""
    found = clusters.features(profile.symbol_profile(processed(spark, sf)))
    return found.withColumn("price_volatility", C.significant("price_volatility"))


_Z = ", ".join(f"round(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 6) AS z_{c}"
               for c in clusters.FEATURES)


@register("m1_scaled_features", with_cte(T.BARS_SQL, processed_sql()) + f"""
SELECT symbol, exchange, {_Z} FROM ({PROFILE_SELECT}) p
WHERE avg_daily_return IS NOT NULL AND price_volatility IS NOT NULL AND avg_volume IS NOT NULL""")
def m1_scaled_features(spark, sf):
    """M1 + M2: the assembled and standardised features, rounded (their
    moments are merged in any order)."""
    scaled = clusters.scaled_features(profile.symbol_profile(processed(spark, sf)))
    return scaled.select("symbol", "exchange", *[F.round(F.col("_z")[i], 6).alias(f"z_{c}")
                                                 for i, c in enumerate(clusters.FEATURES)])


@register("a4_cluster_totals", with_cte(T.BARS_SQL, processed_sql()) + f"""
SELECT CAST(5 AS BIGINT) AS n_clusters, count(*) AS n_symbols FROM ({PROFILE_SELECT}) p
WHERE avg_daily_return IS NOT NULL AND price_volatility IS NOT NULL AND avg_volume IS NOT NULL""")
def a4_cluster_totals(spark, sf):
    """The distribution adds up to all clustered symbols."""
    return clusters.cluster_distribution(QR.clustered(spark, sf)).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.sum("n_rows").alias("n_symbols"))
