"""Driver tables and the bar views derived from them.

The driver ships TPC-H-like parquet tables plus an ``events`` tick table.  The
engine's domain is daily OHLCV bars, so three derivations map them onto it:

* ``bars``        ticks of ``events`` rolled up per (user_id, day); the user is
                  the symbol and the customer's nation is the exchange.
* ``brand_bars``  ``lineitem`` joined to ``part``, rolled up per (brand, ship
                  day); long histories (about 1,500 days per brand).
* ``symbol_meta`` the customer dimension as symbol metadata.
* ``metrics``     ``events`` read as metric samples (series, instance, value).

Each derivation is a partial aggregation: hot keys are combined map-side
before the shuffle, and dimension joins are left to the planner (broadcast
only when the runtime size is under ``spark.sql.autoBroadcastJoinThreshold``,
sort-merge with AQE skew splitting otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

BAR_COLUMNS = ("exchange", "symbol", "date", "open", "high", "low", "close", "volume")
BRAND_EXCHANGE = "LINEITEM"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def exchange_of(nationkey) -> F.Column:
    return F.concat(F.lit("NATION_"), nationkey.cast("string"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars from ticks: open/close by first/last tick, volume = ticks."""
    ev = read_table(spark, sf_dir, "events").select("ts", "user_id", "value")
    daily = (ev.groupBy("user_id", F.to_date("ts").alias("date"))
             .agg(F.min_by("value", "ts").alias("open"),
                  F.max("value").alias("high"),
                  F.min("value").alias("low"),
                  F.max_by("value", "ts").alias("close"),
                  F.count(F.lit(1)).alias("volume")))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = daily.join(cust, daily.user_id == cust.c_custkey, "left")
    return joined.select(
        exchange_of(F.col("c_nationkey")).alias("exchange"),
        F.col("user_id").cast("string").alias("symbol"),
        "date", "open", "high", "low", "close", "volume")


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per part brand; price = l_extendedprice, volume = quantity."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    # (l_orderkey, l_linenumber) is not unique in the fixtures: order ties by
    # every column that can differ so first/last are deterministic.
    # The first/last tick is the min/max of one struct that carries its own
    # price (its price is open/close).  Struct buffers make this a sort-based
    # aggregate; grouping on (date, brand) lets the sort resolve most
    # comparisons on the integer date prefix (faster than "Brand#.." strings).
    tick = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    "l_extendedprice", "l_quantity")
    daily = (j.groupBy(F.to_date("l_shipdate").alias("date"), "p_brand")
             .agg(F.min(tick).alias("_first"),
                  F.max("l_extendedprice").alias("high"),
                  F.min("l_extendedprice").alias("low"),
                  F.max(tick).alias("_last"),
                  F.sum("l_quantity").cast("bigint").alias("volume")))
    return daily.select(F.lit(BRAND_EXCHANGE).alias("exchange"),
                        F.col("p_brand").alias("symbol"), "date",
                        F.col("_first.l_extendedprice").alias("open"), "high", "low",
                        F.col("_last.l_extendedprice").alias("close"), "volume")


def symbol_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol metadata (symbol, exchange, company_name, sector, industry)."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
    return j.select(F.col("c_custkey").cast("string").alias("symbol"),
                    exchange_of(F.col("c_nationkey")).alias("exchange"),
                    F.col("c_name").alias("company_name"),
                    F.col("c_mktsegment").alias("sector"),
                    F.col("n_name").alias("industry"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples: (ts, series, instance, value)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select("ts", F.col("event_type").alias("series"),
                     F.col("user_id").cast("string").alias("instance"), "value")


# SQL text of the same derivations, used by the DuckDB oracle.
BARS_SQL = """
bars AS (
  SELECT 'NATION_' || CAST(c.c_nationkey AS VARCHAR) AS exchange,
         CAST(d.user_id AS VARCHAR) AS symbol, d.date, d.open, d.high, d.low, d.close, d.volume
  FROM (SELECT user_id, CAST(ts AS DATE) AS date,
               arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, ts) AS close, count(*) AS volume
        FROM events GROUP BY user_id, CAST(ts AS DATE)) d
  LEFT JOIN customer c ON d.user_id = c.c_custkey)"""

BRAND_BARS_SQL = """
bars AS (
  SELECT 'LINEITEM' AS exchange, p.p_brand AS symbol, CAST(l.l_shipdate AS DATE) AS date,
         arg_min(l.l_extendedprice, row(l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity)) AS open,
         max(l.l_extendedprice) AS high, min(l.l_extendedprice) AS low,
         arg_max(l.l_extendedprice, row(l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity)) AS close,
         CAST(sum(l.l_quantity) AS BIGINT) AS volume
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY p.p_brand, CAST(l.l_shipdate AS DATE))"""

META_SQL = """
meta AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS symbol,
         'NATION_' || CAST(c.c_nationkey AS VARCHAR) AS exchange,
         c.c_name AS company_name, c.c_mktsegment AS sector, n.n_name AS industry
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

METRICS_SQL = """
metrics AS (
  SELECT ts, event_type AS series, CAST(user_id AS VARCHAR) AS instance, value FROM events)"""
