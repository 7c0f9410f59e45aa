"""Alerts: bands, status, rollup, sustained runs across buckets, counter
resets, running totals (FIXTURES: breach shorter/longer than its duration,
counter reset)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlens.functions import series as SR
from marketlens.operators import alerts

T0 = dt.datetime(2024, 1, 1)
RSCHEMA = "ts timestamp, series string, instance string, value double"


def readings(spark, rows):
    return spark.createDataFrame(rows, RSCHEMA)


def test_bands_two_levels(spark):
    lim = alerts.thresholds(spark, {"c": "cpu", "d": "disk"})
    r = readings(spark, [(T0, "c", "h1", 85.0), (T0, "c", "h1", 95.0), (T0, "c", "h1", 10.0),
                         (T0, "d", "h1", 92.0), (T0, "d", "h1", 96.0), (T0, "x", "h1", 99.0)])
    got = sorted((a.metric, a.severity, a.threshold) for a in alerts.bands(r, lim).collect())
    assert got == [("cpu", "critical", 90.0), ("cpu", "warning", 80.0),
                   ("disk", "critical", 95.0), ("disk", "warning", 90.0)]


def test_status_summary_rollup(spark):
    svc = spark.createDataFrame([("Web A", "healthy"), ("DB", "unhealthy"), ("Cache", "warning")],
                                "name string, status string")
    st = alerts.status_alerts(svc)
    assert sorted((r.id, r.severity) for r in st.collect()) == [
        ("service_cache_warning", "warning"), ("service_db", "critical")]
    s = alerts.summary(st).first()
    assert (s.total, s.critical, s.warning, s.info) == (2, 1, 1, 0)
    r = alerts.rollup(st, svc).first()
    assert r.status == "critical" and r.service_health_percentage == pytest.approx(33.3)
    quiet = alerts.rollup(st.limit(0), svc.filter("status = 'healthy'")).first()
    assert quiet.status == "healthy" and quiet.service_health_percentage == 100.0
    empty = alerts.rollup(st.limit(0), svc.limit(0)).first()
    assert empty.service_health_percentage == 0.0


def plain_islands(rows, thr):
    """Reference: runs over the whole history of each key."""
    out, by = [], {}
    for ts, _, inst, v in rows:
        by.setdefault(inst, []).append((ts, v))
    for inst, xs in by.items():
        xs.sort()
        run = []
        for ts, v in xs + [(None, None)]:
            if v is not None and v > thr:
                run.append(ts)
            elif run:
                out.append((inst, run[0], run[-1], len(run)))
                run = []
    return sorted(out)


@pytest.mark.parametrize("bucket,target", [(600, None), (3600, None), (86_400, None),
                                           (None, 7), (None, 50), (None, 10_000)])
def test_islands_match_whole_history(spark, bucket, target):
    rnd = random.Random(7)
    rows = []
    for inst in ("hot", "b", "c"):
        n = 400 if inst == "hot" else 40
        for i in range(n):
            rows.append((T0 + dt.timedelta(seconds=137 * i + rnd.randint(0, 60)), "s", inst,
                         float(rnd.choice([10, 90, 90, 95]))))
    df = readings(spark, rows)
    got = sorted((r.instance, r.start_ts, r.end_ts, r.n_samples) for r in
                 SR.islands(df, ["instance"], "ts", F.col("value") > 80, bucket,
                            target_rows=target or SR.TARGET_ROWS).collect())
    assert got == plain_islands(rows, 80)


def test_sustained_shorter_and_longer(spark):
    rows = [(T0 + dt.timedelta(minutes=m), "cpu", "h", float(v)) for m, v in
            [(0, 95), (2, 96), (4, 97), (6, 10), (8, 91), (9, 92), (20, 93)]]
    s = {r.start_ts.minute: r for r in alerts.sustained(
        readings(spark, rows), F.col("value") > 90, for_seconds=300, keys=("instance",),
        bucket_seconds=300).collect()}
    assert s[0].fired is False and s[0].duration_sec == 240.0   # 4 min < 5 min
    assert s[8].fired is True and s[8].n_samples == 3          # 12 min run


def test_counter_rate_reset(spark):
    rows = [(T0 + dt.timedelta(seconds=s), "cpu0", "h", v) for s, v in
            [(0, 100.0), (10, 150.0), (20, 30.0)]] + \
           [(T0 + dt.timedelta(seconds=s), "cpu1", "h", v) for s, v in [(0, 0.0), (20, 40.0)]]
    df = readings(spark, rows).withColumnRenamed("value", "counter")
    r = alerts.counter_rate(df, window="5 minutes").first()
    # cpu0: reset -> 30 / 10 s = 3.0; cpu1: 40 / 20 s = 2.0; average 2.5
    assert r.avg_irate == pytest.approx(2.5) and r.n_series == 2


def test_running_total_across_buckets(spark):
    rows = [(T0 + dt.timedelta(hours=h), "s", "h", 1.0) for h in range(0, 100, 7)]
    df = readings(spark, rows).withColumn("one", F.lit(1).cast("long"))
    out = SR.running_total(df, ["instance"], "ts", "one", "n", bucket_seconds=3600 * 10)
    assert [r.n for r in out.orderBy("ts").collect()] == list(range(1, len(rows) + 1))
    ada = SR.running_total(df, ["instance"], "ts", "one", "n", target_rows=3)
    assert [r.n for r in ada.orderBy("ts").collect()] == list(range(1, len(rows) + 1))


def test_ratio_and_hit_rate(spark):
    df = spark.createDataFrame([(3, 1), (0, 0)], "h int, m int")
    got = [(r.hr, r.ra) for r in df.select(alerts.hit_rate("h", "m").alias("hr"),
                                           alerts.ratio("h", F.col("h") + F.col("m")).alias("ra")).collect()]
    assert got == [(75.0, 75.0), (0.0, None)]


def test_durations_ignore_session_zone_dst(spark):
    """Wall-clock (timestamp_ntz) readings across the US DST change keep
    their true spacing whatever the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [(dt.datetime(2024, 3, 10, 1, 30), "cpu", "h", 95.0),
                (dt.datetime(2024, 3, 10, 3, 30), "cpu", "h", 96.0)]
        df = spark.createDataFrame(rows, "ts timestamp_ntz, series string, instance string, value double")
        r = alerts.sustained(df, F.col("value") > 90, for_seconds=7200, keys=("instance",),
                             bucket_seconds=1800).first()
        assert r.duration_sec == 7200.0 and r.fired
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_hot_key_is_spread_over_tasks(spark):
    """One instance holding most readings: after bucketing, no task holds
    more than a small share of it, and results still match brute force."""
    hot = [(T0 + dt.timedelta(seconds=7 * i), "s", "hot", float((i * 37) % 100)) for i in range(6000)]
    cold = [(T0 + dt.timedelta(seconds=11 * i), "s", f"c{i % 4}", float((i * 53) % 100))
            for i in range(240)]
    df = readings(spark, hot + cold)
    x = SR.with_buckets(df, ["instance"], "ts", None, target_rows=500)
    # AQE would merge these toy-sized partitions into one (it only merges
    # partitions below the advisory size); switch that off to see the spread
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        per_task = [r["n"] for r in x.filter(F.col("instance") == "hot")
                    .groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set(key, old)
    assert len(per_task) >= 4 and max(per_task) < len(hot) / 2, per_task
    got = sorted((r.instance, r.start_ts, r.end_ts, r.n_samples) for r in
                 SR.islands(df, ["instance"], "ts", F.col("value") > 80, target_rows=500).collect())
    assert got == plain_islands(hot + cold, 80)
