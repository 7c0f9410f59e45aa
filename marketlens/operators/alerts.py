"""Metric alerts over stored readings.

Readings are rows (ts, series, instance, value).  Threshold tables are
configuration - a handful of rows, broadcast by construction - and every
other step is an aggregation or a skew-safe ordered computation from
``functions/series.py``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.functions import series as SR

# Two-level bands (warning, critical) per resource, percent.
BANDS = (("cpu", 80.0, 90.0), ("memory", 85.0, 95.0), ("disk", 90.0, 95.0))

SEVERITY_RANK = {"critical": 2, "warning": 1}


def thresholds(spark: SparkSession, series_to_metric: dict[str, str], bands=BANDS) -> DataFrame:
    """Band table (series, metric, warning, critical) for the given series."""
    b = {m: (w, c) for m, w, c in bands}
    rows = [(s, m, *b[m]) for s, m in series_to_metric.items()]
    return spark.createDataFrame(rows, "series string, metric string, warning double, critical double")


def bands(readings: DataFrame, limits: DataFrame) -> DataFrame:
    """Critical above the upper band, else warning above the lower one;
    one alert row per breaching reading with its threshold and value.  The
    band table is a few configuration rows, so it is broadcast."""
    j = readings.join(F.broadcast(limits), "series")
    v = F.col("value")
    sev = (F.when(v > F.col("critical"), F.lit("critical"))
           .when(v > F.col("warning"), F.lit("warning")))
    thr = F.when(v > F.col("critical"), F.col("critical")).when(v > F.col("warning"), F.col("warning"))
    return (j.select("ts", "series", "instance", "metric", "value",
                     thr.alias("threshold"), sev.alias("severity"))
            .filter(F.col("severity").isNotNull())
            .withColumns({"id": F.concat_ws("_", "metric", "severity"),
                          "resolved": F.lit(False)}))


def service_status(readings: DataFrame, error_series: str = "error",
                   unhealthy: float = 30.0, warning: float = 25.0) -> DataFrame:
    """Service health per instance from its error share (R6 ratio):
    unhealthy above ``unhealthy`` %, warning above ``warning`` %."""
    agg = readings.groupBy("instance").agg(
        F.count_if(F.col("series") == error_series).alias("errors"),
        F.count(F.lit(1)).alias("samples"))
    pct = ratio(F.col("errors"), F.col("samples"))
    st = (F.when(pct > unhealthy, F.lit("unhealthy")).when(pct > warning, F.lit("warning"))
          .otherwise(F.lit("healthy")))
    return agg.select(F.col("instance").alias("name"), "errors", "samples",
                      pct.alias("error_pct"), st.alias("status"))


def status_alerts(services: DataFrame) -> DataFrame:
    """R2: unhealthy -> critical, warning -> warning; healthy raises none."""
    sev = (F.when(F.col("status") == "unhealthy", F.lit("critical"))
           .when(F.col("status") == "warning", F.lit("warning")))
    suffix = F.when(F.col("status") == "warning", F.lit("_warning")).otherwise(F.lit(""))
    ident = F.concat(F.lit("service_"), F.regexp_replace(F.lower("name"), " ", "_"), suffix)
    return (services.select(ident.alias("id"), F.col("name").alias("service"),
                            sev.alias("severity"), F.lit(False).alias("resolved"))
            .filter(F.col("severity").isNotNull()))


def summary(alerts: DataFrame, active_only: bool = True) -> DataFrame:
    """Totals and counts by severity (of active alerts when asked)."""
    a = alerts.filter(~F.col("resolved")) if active_only else alerts
    return a.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(~F.col("resolved")).alias("active"),
                 F.count_if(F.col("severity") == "critical").alias("critical"),
                 F.count_if(F.col("severity") == "warning").alias("warning"),
                 F.count_if(F.col("severity") == "info").alias("info"))


def rollup(alerts: DataFrame, services: DataFrame) -> DataFrame:
    """Worst-of status (critical > warning > healthy), active alerts,
    healthy/total services and the healthy share rounded to 0.1 %.  Two
    one-row aggregates combined by union + aggregate (no cross join)."""
    act = alerts.filter(~F.col("resolved"))
    a = act.agg(F.count(F.lit(1)).alias("active_alerts"),
                F.count_if(F.col("severity") == "critical").alias("critical_alerts"))
    s = services.agg(F.count_if(F.col("status") == "healthy").alias("healthy_services"),
                     F.count(F.lit(1)).alias("total_services"))
    u = a.unionByName(s, allowMissingColumns=True)
    cols = ["active_alerts", "critical_alerts", "healthy_services", "total_services"]
    one = u.agg(*[F.max(c).alias(c) for c in cols])
    status = (F.when(F.col("critical_alerts") > 0, F.lit("critical"))
              .when(F.col("active_alerts") > 0, F.lit("warning"))
              .otherwise(F.lit("healthy")))
    share = F.coalesce(F.round(ratio(F.col("healthy_services"), F.col("total_services")), 1),
                       F.lit(0.0))
    return one.select(status.alias("status"), *cols, share.alias("service_health_percentage"))


def sustained(readings: DataFrame, cond, for_seconds: int, keys=("series", "instance"),
              bucket_seconds: int | None = None, target_rows: int = SR.TARGET_ROWS) -> DataFrame:
    """Runs where ``cond`` held on consecutive readings, with their
    duration and whether they lasted ``for_seconds`` (the alert fired)."""
    runs = SR.islands(readings, keys, "ts", cond, bucket_seconds, target_rows=target_rows)
    dur = C.epoch_micros(runs, "end_ts") - C.epoch_micros(runs, "start_ts")
    return runs.withColumns({
        "duration_sec": dur / F.lit(1_000_000.0),
        "fired": dur >= F.lit(for_seconds * 1_000_000),
    })


def ratio(num, den):
    """Num / den * 100 with a zero guard (NULL)."""
    return C.safe_div(C.col_(num).cast("double"), C.col_(den).cast("double")) * F.lit(100.0)


@dataclass(frozen=True)
class Rule:
    """Alert when ``part / whole * 100`` of an instance is above ``above`` (or
    below ``below``) for ``for_seconds``.  A reading counts until the next one
    of its series, ``lookback_seconds`` at most; without a fresh reading of
    both series there is no value and no alert."""

    part: str
    whole: str
    for_seconds: int
    above: float | None = None
    below: float | None = None
    lookback_seconds: int = 300

    def breached(self, value):
        """Works on columns and on plain numbers."""
        return value > self.above if self.above is not None else value < self.below


def rule_runs(readings: DataFrame, rule: Rule, keys=("instance",), as_of_micros: int | None = None,
              target_rows: int = SR.TARGET_ROWS) -> DataFrame:
    """R6 ratio of two series, R5 duration: the alert's runs, one row each.

    The series are aligned as of every reading of either.  The value is a step
    function of time, so a run lasts from the reading that breaches to the
    first moment that does not: a later reading, or the moment at which one
    side is no longer fresh.  From ``pending_at`` the run is pending, from
    ``firing_at`` (NULL if it did not last) firing, at ``resolved_at`` over
    (NULL: still going at the last reading, or ``as_of_micros``).  Readings of
    one series at one moment count as the greatest of them; this also folds
    bursts before the shuffle."""
    keys = list(keys)
    both = (readings.filter(F.col("series").isin(rule.part, rule.whole))
            .groupBy(*keys, "ts").agg(F.max(F.when(F.col("series") == rule.part, F.col("value"))).alias("part"),
                                      F.max(F.when(F.col("series") == rule.whole, F.col("value"))).alias("whole")))
    if as_of_micros is None:
        as_of_micros = both.agg(F.max(C.epoch_micros(both, "ts"))).first()[0]
    as_of = F.lit(as_of_micros if as_of_micros is not None else 0)
    known = SR.last_known(both.filter(C.epoch_micros(both, "ts") <= as_of), keys, "ts", ["part", "whole"],
                          target_rows=target_rows)
    fresh = F.expr(f"INTERVAL '{rule.lookback_seconds}' SECOND")
    aligned = known.withColumns({
        "value": ratio("part_last", "whole_last"),
        "stale": F.least(F.col("part_ts") + fresh, F.col("whole_ts") + fresh)})
    aligned = aligned.select(
        *keys, "ts", "next_ts", "stale", "value", F.least("next_ts", "stale").alias("until"),
        F.coalesce((F.col("ts") < F.col("stale")) & rule.breached(F.col("value")), F.lit(False)).alias("on"))
    # a run also ends where a side goes stale before the next reading
    stale = aligned.filter(F.col("on") & (F.col("next_ts").isNull() | (F.col("stale") < F.col("next_ts"))))
    moments = aligned.select(*keys, "ts", "on", "until", "value").unionByName(
        stale.select(*keys, F.col("stale").alias("ts"), F.lit(False).alias("on")), allowMissingColumns=True)
    runs = SR.islands(moments, keys, "ts", F.col("on"), target_rows=target_rows,
                      largest={"until": F.col("until"), "peak": F.col("value")})
    start, until = C.epoch_micros(runs, "start_ts"), C.epoch_micros(runs, "until")
    due = start + F.lit(rule.for_seconds * 1_000_000)
    over = until <= as_of
    fired = F.when(over, due < until).otherwise(due <= as_of)
    return runs.select(
        *keys, F.col("start_ts").alias("pending_at"),
        F.when(fired, F.col("start_ts") + F.expr(f"INTERVAL '{rule.for_seconds}' SECOND")).alias("firing_at"),
        F.when(over, F.col("until")).alias("resolved_at"), "n_samples", "peak",
        F.when(over, F.lit("resolved")).when(fired, F.lit("firing")).otherwise(F.lit("pending")).alias("state"))


def counters(readings: DataFrame, keys=("series", "instance"), bucket_seconds: int | None = None,
             out: str = "counter", target_rows: int = SR.TARGET_ROWS) -> DataFrame:
    """Monotone counters from readings: running count of samples per key
    (skew-safe running total)."""
    x = readings.withColumn("_one", F.lit(1).cast("long"))
    return SR.running_total(x, keys, "ts", "_one", out, bucket_seconds,
                            target_rows=target_rows).drop("_one")


def counter_rate(cnt: DataFrame, window: str = "5 minutes", keys=("series", "instance"),
                 by=("instance",), value: str = "counter") -> DataFrame:
    """Irate per key and tumbling window - the change between the last
    two samples of the window per second, a drop (counter reset) counting
    as the new value - then averaged over the remaining labels by ``by``.

    Only the last two samples of each (key, window) matter: the
    ``row_number() <= 2`` filter is planned with a partial WindowGroupLimit
    before the shuffle, so a dense key sends at most two rows per group and
    map task, and the final step aggregates at most two rows per group."""
    keys = list(keys)
    x = cnt.withColumns({"_w": F.window("ts", window).start, "_us": C.epoch_micros(cnt, "ts")})
    w = Window.partitionBy(*keys, "_w").orderBy(F.col("ts").desc(), F.col(value).desc())
    top2 = x.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 2)
    pair = F.struct(F.col("_us").alias("us"), F.col(value).alias("v"))
    last = (top2.groupBy(*keys, "_w")
            .agg(F.max_by(pair, "_rn").alias("_p"), F.min_by(pair, "_rn").alias("_l"),
                 F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") == 2))
    lv, pv = F.col("_l.v"), F.col("_p.v")
    delta = F.when(lv < pv, lv).otherwise(lv - pv)
    secs = (F.col("_l.us") - F.col("_p.us")) / F.lit(1_000_000.0)
    rates = last.select(*keys, F.col("_w").alias("window_start"),
                        C.safe_div(delta.cast("double"), secs).alias("irate"))
    return (rates.groupBy(*by, "window_start")
            .agg(F.round(F.avg("irate"), 9).alias("avg_irate"),
                 F.count(F.lit(1)).alias("n_series")))


def hit_rate(hits, misses):
    """Hits / max(1, hits + misses) * 100, rounded to 2 decimals."""
    h, m = C.col_(hits), C.col_(misses)
    return F.round(h.cast("double") / F.greatest(F.lit(1), h + m).cast("double") * F.lit(100.0), 2)


def combine(frames: list[DataFrame]) -> DataFrame:
    """Union of alert frames with different columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
