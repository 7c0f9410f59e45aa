"""Physical plan checks: one exchange for all series windows, filters and
column pruning reach the parquet scan, partial top-n before shuffles."""

import re

from marketlens.operators import clean, indicators, insights
from marketlens.plans import queries_bars as QB
from marketlens.plans import queries_ingest as QI
from marketlens.plans import queries_ops as QO
from marketlens.sources import tables as T

from conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.count()  # AQE: materialise the adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_indicator_windows_share_one_exchange(spark):
    b = T.brand_bars(spark, SMALL)
    ind = indicators.add_indicators(b)
    p, base = plan(ind), plan(b)
    # the windows add exactly one exchange, on the series key (the brand
    # bars' exchange column is a constant, so Catalyst keys on symbol alone)
    assert p.count("Exchange") - base.count("Exchange") == 1
    assert re.search(r"Exchange hashpartitioning\((exchange#\d+, )?symbol#\d+", p), p
    assert len(re.findall(r"\bSort \[symbol", p)) == 1


def test_analysis_pipeline_single_window_exchange(spark):
    proc = QB.processed(spark, SMALL)
    an = insights.analysis(proc)
    assert plan(an).count("Exchange") - plan(proc).count("Exchange") <= 1


def test_filters_and_pruning_reach_scan(spark):
    df = QB.t4_period_gainers(spark, SMALL)
    p = plan(df)
    scan = [line for line in p.split("\n") if "FileScan parquet" in line and "events" in line][0]
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint,value:double>" in scan \
        or "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in scan
    assert "TakeOrderedAndProject" in p
    hist = QO.t7_price_history(spark, SMALL)
    # the date range itself reaches the scan of events
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThanOrEqual\(ts,2024-01-10", plan(hist))


def test_top_n_per_group_is_partial_before_shuffle(spark):
    df = QI.w20_first_symbols(spark, SMALL)
    p = plan(df)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_dedupe_is_partial_aggregation(spark):
    df = clean.dedupe_bars(QB.raw_snapshots(spark, SMALL), policy="first")
    p = plan(df)
    assert "HashAggregate" in p or "ObjectHashAggregate" in p or "SortAggregate" in p
    assert "Window" not in p


def test_series_windows_split_hot_keys_by_bucket(spark):
    """Input already hash-partitioned by the key alone must still be
    re-shuffled on (key, bucket) before the ordered windows, or a hot key's
    whole history would run in one task."""
    import datetime as dt

    from pyspark.sql import functions as F

    from marketlens.functions import series as SR

    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=i), "hot", float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp, instance string, value double").repartition("instance")
    for out in (SR.islands(df, ["instance"], "ts", F.col("value") > 3, target_rows=20),
                SR.running_total(df.withColumn("one", F.lit(1)), ["instance"], "ts", "one", "n",
                                 target_rows=20)):
        p = plan(out)
        assert re.search(r"Exchange hashpartitioning\(instance#\d+, _bucket#\d+L?", p), p


def test_bar_derivations_combine_map_side(spark):
    """Ticks of a hot user or brand are combined before the shuffle: the
    first exchange of each bar derivation sits on top of a partial aggregate."""
    for df in (T.bars(spark, SMALL), T.brand_bars(spark, SMALL)):
        p = plan(df)
        lines = p.split("\n")
        i = next(k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line)
        below = "\n".join(lines[i + 1:i + 4])
        assert re.search(r"(Hash|Sort)Aggregate\(keys?=.*functions=\[partial_", below), p
