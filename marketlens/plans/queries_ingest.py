"""Catalog entries for readers and input normalisation:
raw landing round trip (S5, S1, U2, S16, U1), landed quotes (S3, P9-P11,
W19), exchange and symbol lists (P12, P13, W20), file audit (S14, A13).

The landing entries write raw snapshots that Spark derives from ``events``
into a fresh folder under the session's checkpoint folder (shared storage
on a cluster) and read them back; their size grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators.clean import dedupe_bars
from marketlens.plans import jobs
from marketlens.plans.catalog import register, with_cte
from marketlens.plans.queries_bars import LOADED_AT, RAW_SQL, raw_snapshots, snapshot_waves
from marketlens.session import scratch_path
from marketlens.sources import ingest, sinks
from marketlens.sources import tables as T
from marketlens.streaming.incremental import ingest_available

# Exchange whose snapshots use the 13-column layout (like the crypto
# exchange in the original data).
WIDE_EXCHANGE = "NATION_1"


def land(raw, root: str, mode: str = "overwrite") -> str:
    """Raw snapshot rows as vendor CSV under ``root``: two header layouts,
    partitioned by exchange and snapshot day."""
    raw = raw.withColumns({
        "exchangeCode": F.col("exchange"), "symbolCode": F.col("symbol"),
        "interval": F.lit("d"), "adjusted_close": F.col("close")})
    wide = F.col("exchange") == F.lit(WIDE_EXCHANGE)
    sinks.write_landing(raw.filter(~wide), root, columns=ingest.RAW12, mode=mode)
    sinks.write_landing(raw.filter(wide), root, columns=ingest.RAW13, mode="append")
    return root


def write_raw_landing(spark, sf) -> str:
    """Both snapshots landed at once.  Returns the landing root."""
    return land(raw_snapshots(spark, sf), scratch_path(spark, "landing"))


def raw_landing_bars(spark, sf):
    root = write_raw_landing(spark, sf)
    return ingest.read_raw_bars(spark, f"{root}/*/*/*.csv")


@register("s1_raw_landing_roundtrip", with_cte(T.BARS_SQL, RAW_SQL) + f"""
SELECT exchange, symbol, date, r.open, r.high, r.low, r.close, r.adjusted_close, r.volume,
       r.interval, r.download_timestamp, r.path_exchange, r.snapshot_date
FROM (SELECT exchange, symbol, date,
             arg_min({{'open': open, 'high': high, 'low': low, 'close': close,
                      'adjusted_close': CASE WHEN exchange = '{WIDE_EXCHANGE}' THEN close END,
                      'volume': volume, 'interval': 'd', 'download_timestamp': download_timestamp,
                      'path_exchange': exchange,
                      'snapshot_date': CAST(download_timestamp AS DATE)}},
                     download_timestamp) AS r
      FROM raw GROUP BY exchange, symbol, date) t""")
def s1_raw_landing_roundtrip(spark, sf):
    bars = raw_landing_bars(spark, sf).drop("source_file")
    return dedupe_bars(bars, policy="first")


@register("s1_raw_landing_counts", with_cte(T.BARS_SQL, RAW_SQL) + """
SELECT exchange AS path_exchange, CAST(download_timestamp AS DATE) AS snapshot_date,
       count(*) AS n_rows
FROM raw GROUP BY 1, 2""")
def s1_raw_landing_counts(spark, sf):
    """Rows per landing partition read back (S16 path values)."""
    b = raw_landing_bars(spark, sf)
    return b.groupBy("path_exchange", "snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"))


def _vendor_quotes(spark, sf):
    """Landed vendor rows with vendor column names, text dates and volumes."""
    b = T.bars(spark, sf)
    return b.select(F.col("symbol").alias("ticker"), F.col("exchange").alias("venue"),
                    F.date_format("date", "yyyy-MM-dd").alias("Date"),
                    F.col("open").alias("Open"), F.col("high").alias("High"),
                    F.col("low").alias("Low"), F.col("close").alias("Close"),
                    F.col("close").alias("Adjusted_Close"),
                    F.col("volume").cast("string").alias("Volume"))


@register("s3_normalise_quotes", with_cte(T.BARS_SQL) + f"""
SELECT exchange, symbol, date, open, high, low, close, close AS adjusted_close,
       CAST(volume AS BIGINT) AS volume, 'd' AS interval,
       TIMESTAMP '{LOADED_AT}' AS download_timestamp
FROM bars""")
def s3_normalise_quotes(spark, sf):
    return ingest.normalise_quotes(_vendor_quotes(spark, sf), symbol_col="ticker",
                                   exchange_col="venue", keep_last=None,
                                   loaded_at=LOADED_AT)


@register("s3_quotes_json_roundtrip", with_cte(T.BARS_SQL) + f"""
SELECT exchange, symbol, date, open, high, low, close, close AS adjusted_close,
       CAST(volume AS BIGINT) AS volume, 'd' AS interval,
       TIMESTAMP '{LOADED_AT}' AS download_timestamp
FROM bars""")
def s3_quotes_json_roundtrip(spark, sf):
    """Vendor quotes landed as JSON files, read back as text, normalised."""
    root = scratch_path(spark, "quotes_json")
    _vendor_quotes(spark, sf).write.json(root)
    landed = ingest.read_quotes_json(spark, root, file_col="source_file")
    return ingest.normalise_quotes(landed, symbol_col="ticker", exchange_col="venue",
                                   keep_last=None, loaded_at=LOADED_AT, file_col="source_file")


@register("p12_clean_exchanges", """
SELECT 'NATION_' || CAST(n.n_nationkey AS VARCHAR) AS code, coalesce(n.n_name, '') AS name,
       coalesce(r.r_name, '') AS country, '' AS currency, '' AS timeZone
FROM (SELECT DISTINCT c_nationkey FROM customer) c
JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def p12_clean_exchanges(spark, sf):
    """The vendor's exchange list: every exchange that lists symbols (the
    customers' nations, one aggregation over the growing customer table),
    with name and country from the nation and region dimensions."""
    listed = T.read_table(spark, sf, "customer").select("c_nationkey").distinct()
    n = T.read_table(spark, sf, "nation")
    r = T.read_table(spark, sf, "region")
    j = (listed.join(n, listed.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey, "left"))
    return ingest.clean_exchanges(j.select(T.exchange_of(F.col("n_nationkey")).alias("code"),
                                           F.col("n_name").alias("name"),
                                           F.col("r_name").alias("country")))


@register("w20_first_symbols", """
SELECT code, name, exchange, type, '' AS currency, open, close, CAST(NULL AS DOUBLE) AS volume
FROM (SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name,
             'NATION_' || CAST(c_nationkey AS VARCHAR) AS exchange,
             coalesce(c_mktsegment, '') AS type, c_acctbal AS open, c_acctbal AS close,
             row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn
      FROM customer WHERE c_name <> '') t
WHERE rn <= 20""")
def w20_first_symbols(spark, sf):
    c = T.read_table(spark, sf, "customer")
    listed = c.select(F.col("c_custkey").cast("string").alias("code"),
                      F.col("c_name").alias("name"),
                      T.exchange_of(F.col("c_nationkey")).alias("exchange"),
                      F.col("c_mktsegment").alias("type"),
                      F.col("c_custkey").alias("list_pos"),
                      F.col("c_acctbal").alias("open"), F.col("c_acctbal").alias("close"))
    return ingest.clean_symbols(listed, per_exchange=20, order_col="list_pos")


@register("s14_file_audit")
def s14_file_audit(spark, sf):
    """Every file of the landing written from the tables (rows-only check:
    paths and times are run-specific)."""
    root = write_raw_landing(spark, sf)
    return ingest.file_audit(spark, root, glob="*.csv")


@register("a13_directory_totals")
def a13_directory_totals(spark, sf):
    root = write_raw_landing(spark, sf)
    return ingest.directory_totals(ingest.file_audit(spark, root, glob="*.csv"), root)


# --------------------------------------------------------------------------
# G1: incremental ingest (Structured Streaming, availableNow)
# --------------------------------------------------------------------------

@register("g1_incremental_ingest", with_cte(T.BARS_SQL, RAW_SQL) + f"""
SELECT exchange, symbol, date, r.open, r.high, r.low, r.close, r.adjusted_close, r.volume,
       r.download_timestamp, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
FROM (SELECT exchange, symbol, date,
             arg_min({{'open': open, 'high': high, 'low': low, 'close': close,
                      'adjusted_close': CASE WHEN exchange = '{WIDE_EXCHANGE}' THEN close END,
                      'volume': volume, 'download_timestamp': download_timestamp}},
                     download_timestamp) AS r
      FROM raw GROUP BY exchange, symbol, date) t""")
def g1_incremental_ingest(spark, sf):
    """Two collection cycles: the first downloads land and are ingested (in
    several micro-batches), then the re-downloads land in the same day
    folders and the job runs again, then once more with nothing new.  Insert
    if absent keeps each bar's first download."""
    first, second = snapshot_waves(spark, sf)
    root = scratch_path(spark, "landing")
    table = scratch_path(spark, "bar_table")
    ckpt = scratch_path(spark, "ingest_ckpt")
    glob = f"{root}/*/*/*.csv"
    land(first, root)
    ingest_available(spark, glob, table, ckpt, max_files_per_trigger=400)
    land(second, root, mode="append")
    ingest_available(spark, glob, table, ckpt, max_files_per_trigger=400)
    ingest_available(spark, glob, table, ckpt)
    return spark.read.parquet(table)


@register("g1_new_metadata", with_cte(T.BARS_SQL, RAW_SQL) + """
SELECT symbol, exchange, CAST(1 AS BIGINT) AS n_rows FROM raw GROUP BY symbol, exchange""")
def g1_new_metadata(spark, sf):
    """Metadata written by the ingest (J7): two cycles, the first one started
    again from nothing as after a lost checkpoint; every pair stands once."""
    first, second = snapshot_waves(spark, sf)
    root, table, meta = (scratch_path(spark, n) for n in ("landing", "bar_table", "metadata"))
    glob = f"{root}/*/*/*.csv"
    land(first, root)
    for ckpt in ("ingest_ckpt", "ingest_ckpt_again"):
        ingest_available(spark, glob, table, scratch_path(spark, ckpt), metadata_path=meta)
    land(second, root, mode="append")
    ingest_available(spark, glob, table, scratch_path(spark, "ingest_ckpt"), metadata_path=meta)
    return spark.read.parquet(meta).groupBy("symbol", "exchange").agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------------
# Ragged-line quarantine on the landing (a reader that accepts only the
# 12-field layout must quarantine every 13-field line)
# --------------------------------------------------------------------------

@register("s13_ragged_counts", with_cte(T.BARS_SQL, RAW_SQL) + f"""
SELECT exchange AS path_exchange, 13 AS n_fields, count(*) AS n_lines
FROM raw WHERE exchange = '{WIDE_EXCHANGE}' GROUP BY exchange""")
def s13_ragged_counts(spark, sf):
    root = write_raw_landing(spark, sf)
    _, bad = ingest.split_ragged(spark, f"{root}/*/*/*.csv", layouts=(ingest.RAW12,))
    b = bad.withColumn("path_exchange", F.regexp_extract("source_file", ingest.PATH_PARTS, 1))
    return b.groupBy("path_exchange", "n_fields").agg(F.count(F.lit(1)).alias("n_lines"))


# --------------------------------------------------------------------------
# S13 + Q1 on a landing with faults.  In the first downloads every third
# symbol's lines lost their last field (a 13-field line then has the width of
# the other layout), every fifth symbol's close is empty and every seventh
# symbol's download time is not a time; the re-downloads are whole.
# --------------------------------------------------------------------------

CUT, NO_CLOSE, NO_STAMP = 3, 5, 7


def write_faulty_landing(spark, sf) -> str:
    first, second = snapshot_waves(spark, sf)
    root = scratch_path(spark, "faulty")
    no = F.col("symbol").cast("long")
    raw = first.withColumn("_first", F.lit(True)).unionByName(second.withColumn("_first", F.lit(False)))
    stamp = F.date_format("download_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = raw.withColumns({
        "exchangeCode": F.col("exchange"), "symbolCode": F.col("symbol"), "interval": F.lit("d"),
        "adjusted_close": F.col("close").cast("string"),
        "close": F.when(F.col("_first") & (no % NO_CLOSE == 0), F.lit(""))
                  .otherwise(F.col("close").cast("string")),
        "snapshot_date": F.date_format("download_timestamp", "yyyyMMdd"),
        "download_timestamp": F.when(F.col("_first") & (no % NO_STAMP == 0), F.lit("soon")).otherwise(stamp)})
    wide = F.col("exchange") == F.lit(WIDE_EXCHANGE)
    for part, layout, mode in ((text.filter(~wide), ingest.RAW12, "overwrite"),
                               (text.filter(wide), ingest.RAW13, "append")):
        value = lambda cols: F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                for c in cols])
        line = F.when(F.col("_first") & (no % CUT == 0), value(layout[:-1])).otherwise(value(layout))
        # one column named like the header line: every file starts with it
        (part.select(line.alias(",".join(layout)), F.col("exchange").alias("landing_exchange"),
                     "snapshot_date", "symbol")
         .repartitionByRange("landing_exchange", "snapshot_date", "symbol").drop("symbol")
         .write.mode(mode).option("header", True).option("sep", "\u0001").option("quote", "")
         .partitionBy("landing_exchange", "snapshot_date").csv(root))
    return root


@register("s13_quarantine", with_cte(T.BARS_SQL, RAW_SQL) + f"""
, l AS (SELECT exchange, CASE WHEN exchange = '{WIDE_EXCHANGE}' THEN 13 ELSE 12 END AS width,
               row_number() OVER (PARTITION BY exchange, symbol, date ORDER BY download_timestamp) = 1
               AND CAST(symbol AS BIGINT) % {CUT} = 0 AS cut FROM raw)
SELECT exchange AS path_exchange, CAST(width - CASE WHEN cut THEN 1 ELSE 0 END AS INTEGER) AS n_fields,
       CAST(width AS INTEGER) AS expected_fields, cut AS quarantined, count(*) AS n_lines
FROM l GROUP BY ALL""")
def s13_quarantine(spark, sf):
    """Good and quarantined lines per exchange and width: together all data
    lines landed."""
    root = write_faulty_landing(spark, sf)
    good, bad = ingest.split_ragged(spark, f"{root}/*/*/*.csv")
    cols = ["source_file", "n_fields", "expected_fields"]
    lines = (good.select(*cols, F.lit(False).alias("quarantined"))
             .unionByName(bad.select(*cols, F.lit(True).alias("quarantined"))))
    return (lines.groupBy(F.regexp_extract("source_file", ingest.PATH_PARTS, 1).alias("path_exchange"),
                          "n_fields", "expected_fields", "quarantined")
            .agg(F.count(F.lit(1)).alias("n_lines")))


# what is left of the faulty landing, one row per bar: known stamps first
FAULTY_BARS_SQL = f"""
SELECT exchange, symbol, date, r.open, r.high, r.low, r.close, r.volume
FROM (SELECT exchange, symbol, date,
             arg_min({{'open': open, 'high': high, 'low': low, 'close': close, 'volume': volume}},
                     row(bad_stamp, download_timestamp)) AS r
      FROM (SELECT *, first AND CAST(symbol AS BIGINT) % {NO_STAMP} = 0 AS bad_stamp
            FROM (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, date
                                               ORDER BY download_timestamp) = 1 AS first FROM raw) f
            WHERE NOT (first AND (CAST(symbol AS BIGINT) % {CUT} = 0
                                  OR CAST(symbol AS BIGINT) % {NO_CLOSE} = 0))) k
      GROUP BY exchange, symbol, date) t"""


@register("q1_faulty_landing", with_cte(T.BARS_SQL, RAW_SQL) + FAULTY_BARS_SQL)
def q1_faulty_landing(spark, sf):
    """The processing job on the faulty landing: a cut or invalid first
    download does not hide the good re-download, an unknown download time
    loses against a known one."""
    root = write_faulty_landing(spark, sf)
    paths = jobs.processing_job(spark, f"{root}/*/*/*.csv", scratch_path(spark, "jobs"))
    return (spark.read.parquet(paths["daily_stocks"])
            .select("exchange", "symbol", "date", "open", "high", "low", "close", "volume"))


# Names with commas, quotes and line breaks: nothing of them is ragged.
_ODD_NAME = ("symbol || CASE CAST(symbol AS BIGINT) % 4 WHEN 0 THEN ', Inc' WHEN 1 THEN ', \"the\" firm' "
             "WHEN 2 THEN chr(10) || 'second line, of it' ELSE '' END")


@register("s1_quoted_landing", with_cte(T.BARS_SQL, RAW_SQL) + f"""
SELECT exchange, {_ODD_NAME} AS symbol, date, open, high, low, close, volume, download_timestamp,
       CAST(0 AS BIGINT) AS n_bad_lines
FROM raw""")
def s1_quoted_landing(spark, sf):
    """Raw snapshots whose symbols need quotes, landed and read back, with
    the number of quarantined lines."""
    no = F.col("symbol").cast("long") % 4
    name = (F.when(no == 0, F.concat("symbol", F.lit(", Inc"))).when(no == 1, F.concat("symbol", F.lit(', "the" firm')))
            .when(no == 2, F.concat("symbol", F.lit("\nsecond line, of it"))).otherwise(F.col("symbol")))
    root = land(raw_snapshots(spark, sf).withColumn("symbol", name), scratch_path(spark, "quoted"))
    good, bad = ingest.split_ragged(spark, f"{root}/*/*/*.csv")
    bars = ingest.parse_good_lines(good).select("exchange", "symbol", "date", "open", "high", "low", "close", "volume",
                                                "download_timestamp")
    return bars.withColumn("n_bad_lines", F.lit(bad.count()).cast("long"))
