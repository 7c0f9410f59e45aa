"""Catalog entries for metric alerts.  Readings are the
``events`` rows: series = event_type, instance = user, value."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.operators import alerts
from marketlens.plans import sqlgen as S
from marketlens.plans.catalog import register, with_cte
from marketlens.session import scratch_path
from marketlens.sources import tables as T
from marketlens.streaming import alerting

# Which event series plays which resource of the band table.
SERIES_TO_METRIC = {"view": "cpu", "click": "memory", "purchase": "disk"}
# The rules use minutes (a scrape every few seconds); an events user has
# about two readings a day, so the durations are scaled to that density:
# a breach must last 12 hours, and rates use 7-day windows so most windows
# hold the two samples irate needs.  The operators take any duration.
SUSTAIN_ABOVE = 80.0
SUSTAIN_FOR = 12 * 3600          # seconds
SUSTAIN_BUCKET = 6 * 3600        # fixed bucket here, so runs are stitched across buckets
RATE_WINDOW = "7 days"


def band_alerts(spark, sf):
    lim = alerts.thresholds(spark, SERIES_TO_METRIC)
    return alerts.bands(T.metrics(spark, sf), lim)


def services(spark, sf):
    return alerts.service_status(T.metrics(spark, sf))


def all_alerts(spark, sf):
    return alerts.combine([band_alerts(spark, sf), alerts.status_alerts(services(spark, sf))])


_BANDS = {m: (w, c) for m, w, c in alerts.BANDS}
LIMITS_SQL = "lim AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', '{m}', {S.d(_BANDS[m][0])}, {S.d(_BANDS[m][1])})" for s, m in SERIES_TO_METRIC.items()
) + ") t(series, metric, warning, critical))"

BAND_SQL = """
band AS (
  SELECT ts, m.series, instance, metric, value,
         CASE WHEN value > critical THEN critical WHEN value > warning THEN warning END AS threshold,
         CASE WHEN value > critical THEN 'critical' WHEN value > warning THEN 'warning' END AS severity,
         metric || '_' || CASE WHEN value > critical THEN 'critical' ELSE 'warning' END AS id,
         false AS resolved
  FROM metrics m JOIN lim ON m.series = lim.series WHERE value > warning)"""

SERVICES_SQL = f"""
svc AS (
  SELECT instance AS name, count(*) FILTER (WHERE series = 'error') AS errors, count(*) AS samples
  FROM metrics GROUP BY instance),
svc_st AS (
  SELECT *, CASE WHEN error_pct > {S.d(30.0)} THEN 'unhealthy'
                 WHEN error_pct > {S.d(25.0)} THEN 'warning' ELSE 'healthy' END AS status
  FROM (SELECT *, {S.div('CAST(errors AS DOUBLE)', 'CAST(samples AS DOUBLE)')} * {S.d(100.0)} AS error_pct
        FROM svc) t),
svc_alerts AS (
  SELECT 'service_' || replace(lower(name), ' ', '_')
           || CASE WHEN status = 'warning' THEN '_warning' ELSE '' END AS id,
         name AS service,
         CASE WHEN status = 'unhealthy' THEN 'critical' ELSE 'warning' END AS severity,
         false AS resolved
  FROM svc_st WHERE status <> 'healthy'),
all_alerts AS (
  SELECT severity, resolved FROM band UNION ALL SELECT severity, resolved FROM svc_alerts)"""


@register("r1_band_alerts", with_cte(T.METRICS_SQL, LIMITS_SQL, BAND_SQL) + "SELECT * FROM band")
def r1_band_alerts(spark, sf):
    return band_alerts(spark, sf)


@register("r2_status_alerts", with_cte(T.METRICS_SQL, LIMITS_SQL, BAND_SQL, SERVICES_SQL)
          + "SELECT * FROM svc_alerts")
def r2_status_alerts(spark, sf):
    return alerts.status_alerts(services(spark, sf))


@register("r3_alert_summary", with_cte(T.METRICS_SQL, LIMITS_SQL, BAND_SQL, SERVICES_SQL) + """
SELECT count(*) AS total, count(*) FILTER (WHERE NOT resolved) AS active,
       count(*) FILTER (WHERE severity = 'critical') AS critical,
       count(*) FILTER (WHERE severity = 'warning') AS warning,
       count(*) FILTER (WHERE severity = 'info') AS info
FROM all_alerts WHERE NOT resolved""")
def r3_alert_summary(spark, sf):
    return alerts.summary(all_alerts(spark, sf))


@register("r4_status_rollup", with_cte(T.METRICS_SQL, LIMITS_SQL, BAND_SQL, SERVICES_SQL) + f"""
, a AS (SELECT count(*) AS active_alerts, count(*) FILTER (WHERE severity = 'critical') AS critical_alerts
        FROM all_alerts WHERE NOT resolved),
s AS (SELECT count(*) FILTER (WHERE status = 'healthy') AS healthy_services, count(*) AS total_services
      FROM svc_st)
SELECT CASE WHEN critical_alerts > 0 THEN 'critical' WHEN active_alerts > 0 THEN 'warning'
            ELSE 'healthy' END AS status,
       active_alerts, critical_alerts, healthy_services, total_services,
       coalesce(round({S.div('CAST(healthy_services AS DOUBLE)', 'CAST(total_services AS DOUBLE)')}
                      * {S.d(100.0)}, 1), {S.d(0.0)}) AS service_health_percentage
FROM a, s""")
def r4_status_rollup(spark, sf):
    return alerts.rollup(all_alerts(spark, sf), services(spark, sf))


@register("r5_sustained_high", with_cte(T.METRICS_SQL) + f"""
, x AS (
  SELECT instance, ts, value > {S.d(SUSTAIN_ABOVE)} AS f,
         sum(CASE WHEN value > {S.d(SUSTAIN_ABOVE)} THEN 0 ELSE 1 END)
           OVER (PARTITION BY instance ORDER BY ts, value > {S.d(SUSTAIN_ABOVE)} ROWS UNBOUNDED PRECEDING) AS g
  FROM metrics)
SELECT instance, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_samples,
       CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / {S.d(1e6)} AS duration_sec,
       epoch_us(max(ts)) - epoch_us(min(ts)) >= {SUSTAIN_FOR * 1_000_000} AS fired
FROM x WHERE f GROUP BY instance, g""")
def r5_sustained_high(spark, sf):
    m = T.metrics(spark, sf)
    return alerts.sustained(m, F.col("value") > SUSTAIN_ABOVE, SUSTAIN_FOR, keys=("instance",),
                            bucket_seconds=SUSTAIN_BUCKET)


@register("r6_error_ratio", with_cte(T.METRICS_SQL) + f"""
SELECT instance, CAST(ts AS DATE) AS date,
       {S.div("CAST(count(*) FILTER (WHERE series = 'error') AS DOUBLE)", 'CAST(count(*) AS DOUBLE)')}
         * {S.d(100.0)} AS error_pct
FROM metrics GROUP BY instance, CAST(ts AS DATE)""")
def r6_error_ratio(spark, sf):
    m = T.metrics(spark, sf)
    agg = m.groupBy("instance", F.to_date("ts").alias("date")).agg(
        F.count_if(F.col("series") == "error").alias("_e"), F.count(F.lit(1)).alias("_n"))
    return agg.select("instance", "date", alerts.ratio("_e", "_n").alias("error_pct"))


@register("r7_counter_rate", with_cte(T.METRICS_SQL) + f"""
, c AS (
  SELECT series, instance, ts,
         count(*) OVER (PARTITION BY series, instance ORDER BY ts ROWS UNBOUNDED PRECEDING) AS counter,
         time_bucket(INTERVAL '{RATE_WINDOW}', ts, TIMESTAMP '1970-01-01') AS window_start
  FROM metrics),
l AS (
  SELECT *, lag(counter) OVER (PARTITION BY series, instance, window_start ORDER BY ts) AS pv,
         lag(ts) OVER (PARTITION BY series, instance, window_start ORDER BY ts) AS pts
  FROM c
  QUALIFY row_number() OVER (PARTITION BY series, instance, window_start ORDER BY ts DESC) = 1),
r AS (
  SELECT instance, window_start,
         {S.div('CAST(CASE WHEN counter < pv THEN counter ELSE counter - pv END AS DOUBLE)',
                f'CAST(epoch_us(ts) - epoch_us(pts) AS DOUBLE) / {S.d(1e6)}')} AS irate
  FROM l WHERE pv IS NOT NULL)
SELECT instance, window_start, round(avg(irate), 9) AS avg_irate, count(*) AS n_series
FROM r GROUP BY instance, window_start""")
def r7_counter_rate(spark, sf):
    cnt = alerts.counters(T.metrics(spark, sf))
    return alerts.counter_rate(cnt, window=RATE_WINDOW)


@register("r8_hit_rate", with_cte(T.METRICS_SQL) + f"""
SELECT instance, hits, misses,
       round(CAST(hits AS DOUBLE) / CAST(greatest(1, hits + misses) AS DOUBLE) * {S.d(100.0)}, 2)
         AS hit_rate
FROM (SELECT instance, count(*) FILTER (WHERE series = 'purchase') AS hits,
             count(*) FILTER (WHERE series = 'view') AS misses
      FROM metrics GROUP BY instance) t""")
def r8_hit_rate(spark, sf):
    m = T.metrics(spark, sf)
    agg = m.groupBy("instance").agg(F.count_if(F.col("series") == "purchase").alias("hits"),
                                    F.count_if(F.col("series") == "view").alias("misses"))
    return agg.withColumn("hit_rate", alerts.hit_rate("hits", "misses"))


# A whole rule: a used/total ratio above a limit for five minutes.  Readings
# of a user are hours apart, so they stay fresh for two days.
RULE = alerts.Rule(part="click", whole="view", above=80.0, for_seconds=300, lookback_seconds=2 * 86_400)
STREAM_DELAY = 6 * 3600          # seconds that readings may arrive late
KEYS_PER_SLOT = 256              # keys that share a row of the stream's state

_UNTIL = f"INTERVAL {RULE.lookback_seconds} SECOND"
_RULE_SQL = f"""
both_sides AS (
  SELECT instance, ts, max(value) FILTER (series = '{RULE.part}') AS part, max(value) FILTER (series = '{RULE.whole}') AS whole
  FROM metrics WHERE series IN ('{RULE.part}', '{RULE.whole}') GROUP BY instance, ts),
now AS (SELECT %s AS as_of FROM both_sides),
known AS (
  SELECT *, last_value(part IGNORE NULLS) OVER w AS part_last, last_value(whole IGNORE NULLS) OVER w AS whole_last,
         last_value(CASE WHEN part IS NOT NULL THEN ts END IGNORE NULLS) OVER w + {_UNTIL} AS part_until,
         last_value(CASE WHEN whole IS NOT NULL THEN ts END IGNORE NULLS) OVER w + {_UNTIL} AS whole_until,
         lead(ts) OVER (PARTITION BY instance ORDER BY ts) AS next_ts
  FROM both_sides WINDOW w AS (PARTITION BY instance ORDER BY ts ROWS UNBOUNDED PRECEDING)),
aligned AS (
  SELECT *, value > {S.d(RULE.above)} AND ts < stale AS breach FROM (
    SELECT *, {S.div('part_last', 'whole_last')} * {S.d(100.0)} AS value, least(part_until, whole_until) AS stale
    FROM known) t),
moments AS (
  SELECT instance, ts, coalesce(breach, false) AS breach, least(next_ts, stale) AS until, value FROM aligned
  UNION ALL
  SELECT instance, stale, false, NULL, NULL FROM aligned WHERE breach AND (next_ts IS NULL OR stale < next_ts)),
runs AS (
  SELECT instance, min(ts) AS pending_at, max(until) AS until, count(*) AS n_samples, max(value) AS peak
  FROM (SELECT *, sum(CASE WHEN breach THEN 0 ELSE 1 END) OVER (PARTITION BY instance ORDER BY ts, breach
                                                             ROWS UNBOUNDED PRECEDING) AS g FROM moments) t
  WHERE breach GROUP BY instance, g),
ended AS (
  SELECT runs.*, as_of, until <= as_of AS done, pending_at + INTERVAL {RULE.for_seconds} SECOND AS due,
         CASE WHEN until <= as_of THEN due < until ELSE due <= as_of END AS fired FROM runs, now)"""


@register("r9_alert_rule", with_cte(T.METRICS_SQL, _RULE_SQL % "max(ts)") + """
SELECT instance, pending_at, CASE WHEN fired THEN due END AS firing_at, CASE WHEN done THEN until END AS resolved_at,
       n_samples, peak, CASE WHEN done THEN 'resolved' WHEN fired THEN 'firing' ELSE 'pending' END AS state
FROM ended""")
def r9_alert_rule(spark, sf):
    return alerts.rule_runs(T.metrics(spark, sf), RULE)


def _changes(name: str, at: str, when: str) -> str:
    return f"SELECT instance, '{name}' AS state, {at} AS at FROM ended WHERE {when} AND {at} < as_of"


@register("r9_alert_transitions", with_cte(T.METRICS_SQL, _RULE_SQL % (
    f"CAST(epoch_ms(epoch_ms(max(ts)) - {STREAM_DELAY * 1000}) AS TIMESTAMP)")) + " UNION ALL ".join([
        _changes("pending", "pending_at", "true"), _changes("firing", "due", "due < until"),
        _changes("resolved", "until", "true")]))
def r9_alert_transitions(spark, sf):
    """The rule as a stream: readings land in three steps of time, and the
    job runs after each, as a scheduler would start it.  What the last
    watermark has not passed is still open."""
    m = T.metrics(spark, sf)
    landed, out, progress = (scratch_path(spark, f"rule-{x}") for x in ("readings", "transitions", "progress"))
    us = C.epoch_micros(m, "ts")
    lo, hi, n_keys = m.agg(F.min(us), F.max(us), F.approx_count_distinct("instance")).first()
    slots = max(256, n_keys // KEYS_PER_SLOT)
    step = (hi - lo) // 3 + 1
    for k in range(3):
        (m.filter(us.between(lo + k * step, lo + (k + 1) * step - 1))
         .repartitionByRange("ts").write.mode("append").parquet(landed))
        stream = spark.readStream.schema(m.schema).parquet(landed)
        found = alerting.rule_transitions(stream, RULE, delay=f"{STREAM_DELAY} seconds", slots=slots)
        (found.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
         .trigger(availableNow=True).start().awaitTermination())
    rows = spark.read.schema(found.schema).parquet(out)
    return rows.select("instance", "state", "at")
