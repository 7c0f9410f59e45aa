"""Bursts in ordered computations, and the alert rule in batch and stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from marketlens.functions import series as SR
from marketlens.operators import alerts
from marketlens.streaming import alerting

T0 = dt.datetime(2024, 1, 1, 12)
RULE = alerts.Rule(part="used", whole="total", above=80.0, for_seconds=300, lookback_seconds=900)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, series string, instance string, value double")


def plain_runs(rows, threshold):
    """Runs per instance over (ts, failing first)."""
    out, run, last = [], None, None
    for inst, ts, ok in sorted((i, t, v > threshold) for t, _, i, v in rows):
        if inst != last or not ok:
            if run:
                out.append(tuple(run))
            run = None
        if ok:
            run = [inst, ts, ts, 1] if run is None else [inst, run[1], ts, run[3] + 1]
        last = inst
    return sorted(out + ([tuple(run)] if run else []))


def burst_rows():
    """5,000 samples at one moment amid an ordinary hot and a cold key."""
    rng = random.Random(1)
    rows = [(at(7 * i), "s", "hot", float(rng.randrange(100))) for i in range(1500)]
    rows += [(at(5000), "s", "hot", float(rng.randrange(60, 100))) for i in range(5000)]
    return rows + [(at(11 * i), "s", f"c{i % 4}", float(rng.randrange(100))) for i in range(240)]


def task_sizes(cut):
    """Rows of each task of a window over the buckets."""
    inside = cut.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("instance", "_bucket")))
    return [r["n"] for r in inside.groupBy(F.spark_partition_id().alias("p")).agg(F.sum((F.col("n") > 0).cast("int")).alias("n")).collect()]


def test_a_burst_is_spread_and_gives_the_same_runs(spark):
    rows = burst_rows()
    df = frame(spark, rows)
    cut = SR.with_buckets(df.withColumn("_f", F.col("value") > 80), ["instance"], "ts", None, 100, ("_f",))
    sizes = task_sizes(cut)
    assert max(sizes) < 700 and sum(sizes) == len(rows)
    per_bucket = [r["count"] for r in cut.groupBy("_bucket").count().collect()]
    assert max(per_bucket) < 400
    got = sorted((r.instance, r.start_ts, r.end_ts, r.n_samples) for r in
                 SR.islands(df, ["instance"], "ts", F.col("value") > 80, target_rows=100).collect())
    assert got == plain_runs(rows, 80)


def test_windows_on_buckets_need_no_exchange(spark):
    df = frame(spark, burst_rows()[:2000])
    cut = SR.with_buckets(df, ["instance"], "ts", None, 200)
    plan = cut.groupBy("instance", "_bucket").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_totals_of_a_burst(spark):
    rows = burst_rows()
    df = frame(spark, rows)
    got = sorted((r.instance, r.ts, r.value, r.n) for r in
                 SR.running_total(df, ["instance"], "ts", "value", "n", target_rows=100).collect())
    want, total, last = [], 0.0, None
    for inst, ts, v in sorted((i, t, v) for t, _, i, v in rows):
        total = v if inst != last else total + v
        last = inst
        want.append((inst, ts, v, total))
    assert got == sorted(want)


@pytest.mark.parametrize("target", [3, 1000])
def test_last_known_across_buckets(spark, target):
    rng = random.Random(2)
    rows = [(at(i), "k", rng.choice([None, None, float(i)]), rng.choice([None, float(-i)])) for i in range(60)]
    df = spark.createDataFrame(rows, "ts timestamp, k string, a double, b double")
    got = SR.last_known(df, ["k"], "ts", ["a", "b"], target_rows=target).orderBy("ts").collect()
    last = {}
    for i, (r, (ts, _, a, b)) in enumerate(zip(got, rows)):
        for c, v in (("a", a), ("b", b)):
            if v is not None:
                last[c] = (ts, v)
            assert (r[f"{c}_ts"], r[f"{c}_last"]) == last.get(c, (None, None))
        assert r.next_ts == (rows[i + 1][0] if i + 1 < len(rows) else None)


def runs(df, rule=RULE, **kw):
    return sorted((tuple(r[c] for c in ("instance", "pending_at", "firing_at", "resolved_at", "state"))
                   for r in alerts.rule_runs(df, rule, **kw).collect()), key=str)


def test_rule_runs(spark):
    def h(name, *readings):
        return [(at(s), series, name, v) for s, series, v in readings]

    rows = (
        # fires after five minutes, ends with the reading that is below
        h("fires", (0, "total", 100.0), (10, "used", 90.0), (400, "used", 95.0), (500, "used", 10.0), (501, "total", 100.0))
        # below again before five minutes; exactly five minutes does not fire
        + h("short", (0, "total", 100.0), (0, "used", 90.0), (300, "used", 70.0), (310, "total", 100.0))
        # the total goes stale: the run ends there, and the ratio is gone
        + h("stale", (0, "total", 100.0), (0, "used", 90.0), (800, "used", 90.0), (2000, "used", 99.0))
        # a larger total ends the run although the used side is unchanged
        + h("grown", (0, "total", 100.0), (5, "used", 90.0), (350, "total", 200.0))
        # still going at the last reading: pending and firing
        + h("open", (1500, "total", 10.0), (1510, "used", 9.0), (1990, "used", 9.5))
        + h("late", (1900, "total", 10.0), (1910, "used", 9.0))
        # no total, a zero total, readings of other series, two readings at one moment
        + h("none", (0, "used", 90.0), (5, "other", 1.0)) + h("zero", (0, "total", 0.0), (1, "used", 5.0))
        + h("twice", (0, "total", 100.0), (0, "used", 10.0), (0, "used", 90.0), (10, "used", 5.0)))
    want = sorted([
        ("fires", at(10), at(310), at(500), "resolved"), ("short", at(0), None, at(300), "resolved"),
        ("stale", at(0), at(300), at(900), "resolved"), ("grown", at(5), at(305), at(350), "resolved"),
        ("open", at(1510), at(1810), None, "firing"), ("late", at(1910), None, None, "pending"),
        ("twice", at(0), None, at(10), "resolved")], key=str)
    assert runs(frame(spark, rows)) == want
    assert runs(frame(spark, rows), target_rows=2) == want
    assert runs(frame(spark, rows).limit(0)) == []
    below = alerts.Rule(part="used", whole="total", below=10.0, for_seconds=0, lookback_seconds=900)
    assert [r[0] for r in runs(frame(spark, rows), below)] == ["twice"]


def random_readings(seed):
    rng = random.Random(seed)
    rows, t = [], {i: 0.0 for i in "abc"}
    for _ in range(400):
        i = rng.choice("abc")
        t[i] += rng.choice([0, 1, 20, 100, 200, 1200])
        rows.append((at(t[i]), rng.choice(["used", "used", "total"]), i, float(rng.choice([50, 85, 90, 100]))))
    return rows


def test_stream_equals_batch_with_late_readings(spark, tmp_dir):
    rows = random_readings(4)
    end = max(r[0] for r in rows)
    # files roughly in time order; inside the delay readings come out of order
    rng = random.Random(6)
    rows.sort(key=lambda r: r[0] + dt.timedelta(seconds=rng.randrange(500)))
    for k in range(8):
        part = rows[k * len(rows) // 8:(k + 1) * len(rows) // 8]
        frame(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in/{k:02d}")
    stream = (spark.readStream.schema("ts timestamp, series string, instance string, value double")
              .option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/in"))
    found = alerting.rule_transitions(stream, RULE, delay="600 seconds")
    (found.writeStream.format("parquet").option("path", f"{tmp_dir}/out")
     .option("checkpointLocation", f"{tmp_dir}/progress").trigger(availableNow=True).start().awaitTermination())
    got = sorted((r.instance, r.state, r.at) for r in spark.read.schema(found.schema).parquet(f"{tmp_dir}/out").collect())
    passed = end - dt.timedelta(seconds=600)
    want = []
    for inst, pending, firing, resolved, _ in runs(frame(spark, rows)):
        want += [(inst, s, x) for s, x in (("pending", pending), ("firing", firing), ("resolved", resolved))
                 if x and x < passed]
    assert got == sorted(want) and len(want) > 30


def test_state_machine_equals_batch(spark):
    rows = random_readings(9)
    got = []
    for inst in "abc":
        alert = alerting.Alert(RULE)
        mine = [(int((r[0] - T0).total_seconds() * 1e6), r[3] if r[1] == "used" else None,
                 r[3] if r[1] == "total" else None) for r in rows if r[2] == inst]
        moments = alerting._moments(*zip(*mine))
        for t in sorted(moments):
            alert.take(t, *moments[t])
        got += [(inst, s, T0 + dt.timedelta(microseconds=x)) for s, x, _ in alert.out]
    want = []
    for inst, pending, firing, resolved, _ in runs(frame(spark, rows)):
        want += [(inst, s, x) for s, x in (("pending", pending), ("firing", firing), ("resolved", resolved)) if x]
    last = {i: max(r[0] for r in rows if r[2] == i) for i in "abc"}
    assert sorted(got) == sorted(w for w in want if w[2] <= last[w[0]] and (w[1] != "firing" or w[2] < last[w[0]]))


def test_stream_state_is_one_row_a_slot(spark, tmp_dir):
    """Many keys (of two columns, some null) share the calls and state rows."""
    rng = random.Random(8)
    rows = [(at(rng.randrange(4000)), rng.choice(["used", "used", "total"]), rng.choice([None, "a", 'b "c"', "d"]),
             rng.choice([None, *range(40)]), float(rng.choice([50, 85, 90, 100]))) for _ in range(3000)]
    schema = "ts timestamp, series string, instance string, port long, value double"
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(f"{tmp_dir}/in")
    keys = ("instance", "port")
    found = alerting.rule_transitions(spark.readStream.schema(schema).parquet(f"{tmp_dir}/in"), RULE, delay="600 seconds",
                                      keys=keys, slots=8)
    run = (found.writeStream.format("parquet").option("path", f"{tmp_dir}/out")
           .option("checkpointLocation", f"{tmp_dir}/progress").trigger(availableNow=True).start())
    run.awaitTermination()
    assert 0 < run.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
    got = spark.read.schema(found.schema).parquet(f"{tmp_dir}/out").collect()
    passed = int((max(r[0] for r in rows) - T0).total_seconds() * 1e6) - 600_000_000
    want = []
    for key in {r[2:4] for r in rows}:
        alert = alerting.Alert(RULE)
        moments = alerting._moments(*zip(*[(int((r[0] - T0).total_seconds() * 1e6), r[4] if r[1] == "used" else None,
                                            r[4] if r[1] == "total" else None) for r in rows if r[2:4] == key]))
        for t in sorted(t for t in moments if t < passed):
            alert.take(t, *moments[t])
        alert.pass_to(passed)
        want += [(*key, s, T0 + dt.timedelta(microseconds=x)) for s, x, _ in alert.out]
    assert sorted([(r.instance, r.port, r.state, r.at) for r in got], key=str) == sorted(want, key=str) and len(want) > 300
