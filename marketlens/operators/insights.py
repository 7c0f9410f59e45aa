"""Analysis pipeline (Q2), insights report (Q3: A2, T1-T3, A3, P26, S9) and
analysis-result payloads (P27).

The report is one row: the latest date, three ranked top-k arrays and a
signal -> count map.  Each part is bounded by its k (or by the number of
signal values), so the single final aggregation that combines them holds at
most ~45 rows however large the input.  Parts are combined by a union and one
aggregate - no cross join - and arrays are ordered by a sort key packed into
each element (no un-partitioned window).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators import anomalies, indicators, rankings, signals
from marketlens.session import materialize


def analysis(processed: DataFrame) -> DataFrame:
    """Q2: indicators (W1-W8), anomaly flags (W9-W12) and signals
    (W13-W17) on processed bars.  Every window shares the (exchange, symbol)
    partitioning, so the whole pipeline plans one exchange."""
    ind = indicators.add_indicators(processed, prev=(5, 20))
    return signals.add_signals(anomalies.add_anomalies(ind))


def _ranked(keys: list[Column], fields: list[str]) -> Column:
    """Aggregate: elements sorted by ``keys`` (ascending), numbered from 1."""
    packed = F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(keys)],
                      *[F.col(f).alias(f) for f in fields])
    arr = F.sort_array(F.collect_list(packed))
    return F.transform(arr, lambda x, i: F.struct((i + 1).alias("rank"),
                                                  *[x[f].alias(f) for f in fields]))


GAINER_FIELDS = ["symbol", "exchange", "daily_return", "price", "volume"]
VOLUME_FIELDS = ["symbol", "exchange", "volume", "price"]
ANOMALY_FIELDS = ["symbol", "exchange", "date", "anomaly_score"]
REPORT_INPUT = ("symbol", "exchange", "date", "daily_return", "close", "volume", "has_anomaly",
                "anomaly_score", "combined_signal")


def report(analysed: DataFrame, n_gainers: int = 10, n_volume: int = 10,
           n_anomalies: int = 20, write_input: bool = True) -> DataFrame:
    """Q3 as one row: latest_date, top_gainers, top_volume, anomaly_stocks,
    trading_signals (map combined_signal -> rows).

    The five parts read different columns, so their plans differ and Spark
    cannot share one computation of ``analysed`` between them.  With
    ``write_input`` the nine columns they need are written once (shared
    checkpoint folder) and every part scans that copy."""
    if write_input:
        analysed = materialize(analysed.select(*REPORT_INPUT), "insights_input")
    desc = lambda c: -F.col(c)  # noqa: E731  (numeric keys, descending)
    gain = rankings.day_gainers(analysed, n_gainers).agg(
        _ranked([desc("daily_return"), F.col("exchange"), F.col("symbol")], GAINER_FIELDS)
        .alias("top_gainers"))
    vol = rankings.day_volume(analysed, n_volume).agg(
        _ranked([F.col("volume").isNull(), desc("volume"), F.col("exchange"), F.col("symbol")],
                VOLUME_FIELDS).alias("top_volume"))
    anom = rankings.anomaly_list(analysed, n_anomalies).agg(
        _ranked([desc("anomaly_score"), F.datediff(F.lit("1970-01-01").cast("date"), F.col("date")),
                 F.col("exchange"), F.col("symbol")], ANOMALY_FIELDS).alias("anomaly_stocks"))
    sig = signals.signal_counts(analysed).agg(
        F.map_from_entries(F.collect_list(F.struct("combined_signal", "n_rows")))
        .alias("trading_signals"))
    latest = rankings.latest_date(analysed)
    parts = [latest, gain, vol, anom, sig]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cols = ["latest_date", "top_gainers", "top_volume", "anomaly_stocks", "trading_signals"]
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def report_json(rep: DataFrame) -> DataFrame:
    """The report as one JSON text column ``insights`` (dates ISO)."""
    body = F.struct(F.date_format("latest_date", "yyyy-MM-dd").alias("latest_date"),
                    "top_gainers", "top_volume",
                    F.transform("anomaly_stocks", lambda x: x.withField(
                        "date", F.date_format(x["date"], "yyyy-MM-dd"))).alias("anomaly_stocks"),
                    "trading_signals")
    return rep.select(F.to_json(body).alias("insights"))


def report_schema(volume_type: str = "bigint") -> str:
    """DDL of the JSON report written by ``report_json``."""
    return (f"latest_date string, "
            f"top_gainers array<struct<rank:int,symbol:string,exchange:string,"
            f"daily_return:double,price:double,volume:{volume_type}>>, "
            f"top_volume array<struct<rank:int,symbol:string,exchange:string,"
            f"volume:{volume_type},price:double>>, "
            f"anomaly_stocks array<struct<rank:int,symbol:string,exchange:string,"
            f"date:string,anomaly_score:int>>, "
            f"trading_signals map<string,bigint>")


def parse_report_json(df: DataFrame, col: str = "insights", volume_type: str = "bigint") -> DataFrame:
    """The one-row report back from its JSON text (ISO dates -> dates)."""
    r = df.select(F.from_json(col, report_schema(volume_type)).alias("_r")).select("_r.*")
    return r.select(
        F.to_date("latest_date").alias("latest_date"), "top_gainers", "top_volume",
        F.transform("anomaly_stocks",
                    lambda x: x.withField("date", F.to_date(x["date"]))).alias("anomaly_stocks"),
        "trading_signals")


FLAT_FIELDS = ("rank", "symbol", "exchange", "daily_return", "price", "volume", "date",
               "anomaly_score", "signal", "n_rows")


def flatten(rep: DataFrame) -> DataFrame:
    """The report back as rows (section, rank, ...) for value checks.

    One pass over the one-row report: every section becomes an array of
    structs of one shape, the arrays are concatenated and inlined once (a
    union of five selects would evaluate the report plan five times)."""
    types = {f.name: f.dataType for f in rep.schema["top_gainers"].dataType.elementType.fields}
    types.update({f.name: f.dataType for f in rep.schema["anomaly_stocks"].dataType.elementType.fields})
    types.update({"signal": "string", "n_rows": "bigint"})
    date_type = rep.schema["latest_date"].dataType

    def row(section: str, **vals) -> Column:
        cols = [F.lit(section).alias("section")]
        for f in FLAT_FIELDS:
            t = date_type if f == "date" else types[f]
            cols.append((vals[f] if f in vals else F.lit(None)).cast(t).alias(f))
        return F.struct(*cols)

    def section(col: str, fields) -> Column:
        return F.transform(col, lambda x: row(col, **{f: x[f] for f in ("rank", *fields)}))

    entries = F.concat(
        section("top_gainers", GAINER_FIELDS),
        section("top_volume", VOLUME_FIELDS),
        section("anomaly_stocks", ANOMALY_FIELDS),
        F.transform(F.map_entries("trading_signals"),
                    lambda e: row("trading_signals", signal=e["key"], n_rows=e["value"])),
        F.array(row("latest_date", date=F.col("latest_date"))))
    return rep.select(F.inline(entries))


# --- analysis results (P27) ------------------------------------------------

# Fields of the technical-analysis payload.
TECHNICAL_SCHEMA = ("rsi double, macd double, sma_50 double, sma_200 double, support double, "
                    "resistance double, signal string, confidence double")


def analysis_results(analysed: DataFrame, analysis_type: str = "technical_analysis") -> DataFrame:
    """Latest analysed bar of each series as a stored result row: JSON text
    payload plus symbol, exchange, type and date (one aggregation)."""
    payload = F.to_json(F.struct("rsi", "macd", F.col("ma_50").alias("sma_50"),
                                 F.col("combined_signal").alias("signal")))
    last = analysed.groupBy("exchange", "symbol").agg(
        F.max_by(F.struct(F.col("date"), payload.alias("result")), "date").alias("_r"))
    return last.select("symbol", "exchange", F.lit(analysis_type).alias("analysis_type"),
                       F.col("_r.result").alias("result"),
                       F.col("_r.date").alias("generated_at"))


def parse_results(results: DataFrame, schema: str = TECHNICAL_SCHEMA) -> DataFrame:
    """Payload fields as typed columns (absent fields NULL)."""
    return results.select("symbol", "exchange", "analysis_type", "generated_at",
                          F.from_json("result", schema).alias("_p")).select(
        "symbol", "exchange", "analysis_type", "generated_at", "_p.*")


def result_field(results: DataFrame, path: str, alias: str) -> DataFrame:
    """One payload field by JSON path (``$.signal``) without a schema."""
    return results.select("symbol", "exchange", "analysis_type",
                          F.get_json_object("result", path).alias(alias))
