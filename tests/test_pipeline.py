"""Collection reports, insights, clusters, incremental ingest."""

import datetime as dt
import json

from pyspark.sql import functions as F

from marketlens.operators import clusters, collection, insights, profile
from marketlens.plans import queries_bars as QB
from marketlens.plans import queries_ingest as QI
from marketlens.session import scratch_path
from marketlens.streaming.incremental import ingest_available

from conftest import SMALL

D0 = dt.date(2024, 1, 1)


def test_collection_report(spark):
    syms = spark.createDataFrame([("X", "A"), ("X", "B"), ("Y", "C")], "exchange string, symbol string")
    b = spark.createDataFrame([("X", "A", D0, 1.0, 5), ("X", "A", D0 + dt.timedelta(days=1), 1.0, 0)],
                              "exchange string, symbol string, date date, close double, volume bigint")
    att = collection.attempts(syms, b, D0 + dt.timedelta(days=1), days=30)
    rep = {r.exchange: r for r in collection.report(att).collect()}
    assert (rep["X"].successful_symbols, rep["X"].failed_symbols, rep["X"].data_points) == (1, 1, 2)
    assert rep["X"].database_failed == 1                      # a zero-volume bar fails validity
    tot = collection.totals(collection.report(att)).first()
    assert abs(tot.success_rate - 100.0 / 3) < 1e-9
    roll = {r.exchange: r for r in collection.report_with_totals(att).collect()}
    assert roll["ALL"].failed_symbols == 2
    assert [r.exchange for r in collection.without_data(collection.report(att)).collect()] == ["Y"]
    assert [r.exchange for r in collection.top(collection.report(att)).collect()] == ["X"]


def test_insights_report_shape(spark):
    an = insights.analysis(QB.processed(spark, SMALL))
    rep = insights.report(an)
    row = rep.first()
    assert len(row.top_gainers) <= 10 and len(row.anomaly_stocks) <= 20
    assert [g["rank"] for g in row.top_gainers] == list(range(1, len(row.top_gainers) + 1))
    rets = [g["daily_return"] for g in row.top_gainers]
    assert rets == sorted(rets, reverse=True)
    assert sum(row.trading_signals.values()) == an.count()
    doc = json.loads(insights.report_json(rep).first().insights)
    assert set(doc) == {"latest_date", "top_gainers", "top_volume", "anomaly_stocks",
                        "trading_signals"}


def test_clusters_labels_by_rank(spark):
    prof = profile.symbol_profile(QB.processed(spark, SMALL))
    cl = clusters.cluster_symbols(prof, k=5, seed=42)
    assert cl.count() == prof.dropna(subset=list(clusters.FEATURES)).count()
    dist = clusters.cluster_distribution(cl).collect()
    assert sorted(r.cluster_rank for r in dist) == list(range(len(dist)))
    by_rank = {r.cluster_rank: r.cluster_description for r in dist}
    assert by_rank[0] == clusters.DESCRIPTIONS[0]
    # rank 0 holds the least volatile centroid
    vol = {r.cluster_rank: r.v for r in cl.groupBy("cluster_rank").agg(
        F.avg("price_volatility").alias("v")).collect()}
    assert vol[0] <= max(vol.values())


def test_incremental_ingest_idempotent(spark):
    first, second = QB.snapshot_waves(spark, SMALL)
    root = QI.land(first, scratch_path(spark, "land"))
    table, ckpt = scratch_path(spark, "t"), scratch_path(spark, "c")
    ingest_available(spark, f"{root}/*/*/*.csv", table, ckpt, max_files_per_trigger=100)
    QI.land(second, root, mode="append")
    ingest_available(spark, f"{root}/*/*/*.csv", table, ckpt, max_files_per_trigger=100)
    first = spark.read.parquet(table)
    n = first.count()
    assert n == first.select("exchange", "symbol", "date").distinct().count()
    ingest_available(spark, f"{root}/*/*/*.csv", table, ckpt)
    assert spark.read.parquet(table).count() == n
    # a fresh checkpoint replays every file: the anti join keeps the table as is
    ingest_available(spark, f"{root}/*/*/*.csv", table, scratch_path(spark, "c2"))
    assert spark.read.parquet(table).count() == n
    want = QB.u1_dedupe_first(spark, SMALL).select("exchange", "symbol", "date", "close")
    assert spark.read.parquet(table).select(*want.columns).exceptAll(want).count() == 0


def test_insert_if_absent(spark, tmp_dir):
    from marketlens.sources import sinks
    schema = ("exchange string, symbol string, date date, close double, "
              "download_timestamp timestamp")
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 5)
    table = f"{tmp_dir}/bars"
    first = spark.createDataFrame([("X", "A", D0, 1.0, t1), ("X", "B", D0, 2.0, t1)], schema)
    assert sinks.insert_if_absent(first, table) == 2
    later = spark.createDataFrame([("X", "A", D0, 9.0, t2),                     # present: kept as is
                                   ("X", "C", D0, 3.0, t2), ("X", "C", D0, 4.0, t1),  # new: first wins
                                   ("X", "A", D0 + dt.timedelta(days=40), 5.0, t2)], schema)
    sinks.insert_if_absent(later, table)
    sinks.insert_if_absent(later, table)                                          # replay: no change
    got = {(r.symbol, r.date.month): r.close for r in spark.read.parquet(table).collect()}
    assert got == {("A", 1): 1.0, ("B", 1): 2.0, ("C", 1): 4.0, ("A", 2): 5.0}
    assert sinks.insert_if_absent(later.limit(0), table) == 0


def test_clusters_against_brute_force(spark):
    """Standardisation, assignment and centres recomputed with numpy on the
    small fixture: every symbol sits in its nearest centre, centres are the
    means of their rows, ranks follow the centres' volatility."""
    import numpy as np
    prof = profile.symbol_profile(QB.processed(spark, SMALL))
    model = clusters.fit_clusters(prof, k=5, seed=42, rounds=100)
    rows = model.assigned().collect()
    x = np.array([[r[f] for f in clusters.FEATURES] for r in rows], dtype=float)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    assert np.allclose(z, [[r._z0, r._z1, r._z2] for r in rows])
    centres = np.array(model.centres)
    ids = np.array([r.cluster for r in rows])
    assert list(((z[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)) == list(ids)
    assert np.allclose(centres, [z[ids == i].mean(axis=0) for i in range(5)])
    vols = [centres[i][1] for i in sorted(range(5), key=model.ranks().__getitem__)]
    assert vols == sorted(vols)


def test_clusters_do_not_depend_on_partitions(spark):
    prof = spark.createDataFrame(profile.symbol_profile(QB.processed(spark, SMALL)).toPandas())
    got = [clusters.fit_clusters(prof.repartition(n), k=5, seed=42) for n in (1, 16)]
    assert got[0].centres == got[1].centres
    a, b = (sorted(m.assigned().collect(), key=lambda r: (r.exchange, r.symbol)) for m in got)
    assert a == b
    assert clusters.fit_clusters(prof, k=5, seed=7).centres != got[0].centres


def test_clusters_of_few_equal_and_invalid_rows(spark):
    schema = "symbol string, exchange string, avg_daily_return double, price_volatility double, avg_volume double"
    make = lambda rows: spark.createDataFrame(rows, schema)
    same = clusters.cluster_symbols(make([("A", "X", 1.0, 2.0, 3.0), ("B", "X", 1.0, 2.0, 3.0), ("C", "X", None, 2.0, 3.0),
                                          ("D", "X", float("nan"), 2.0, 3.0), ("E", "X", float("inf"), 2.0, 3.0)]))
    assert sorted((r.symbol, r.cluster, r.cluster_rank) for r in same.collect()) == [("A", 0, 0), ("B", 0, 0)]
    two = clusters.cluster_symbols(make([("A", "X", 1.0, 9.0, 3.0), ("B", "", 1.0, 2.0, 3.0),
                                         ("C", None, 1.0, 5.0, 3.0)]))  # P25: missing keys go as well
    assert {r.symbol: r.cluster_rank for r in two.collect()} == {"A": 1, "B": 0}
    assert clusters.cluster_symbols(make([])).count() == 0


def test_incremental_ingest_quarantines_ragged_lines(spark, tmp_dir):
    import os
    from marketlens.sources import ingest
    d = f"{tmp_dir}/land/X/20240102"
    os.makedirs(d)
    with open(f"{d}/A.csv", "w") as f:
        f.write(",".join(ingest.RAW12) + "\n"
                "X,A,d,2024-01-01,1,2,0.5,1.5,10,A,X,2024-01-02 06:00:00\n"
                "X,A,d,2024-01-02,1,2\n"                                   # ragged: quarantined
                "X,A,d,2024-01-03,1,2,0.5,1.7,12,A,X,2024-01-04 06:00:00\n")
    table = f"{tmp_dir}/bars"
    ingest_available(spark, f"{tmp_dir}/land/*/*/*.csv", table, f"{tmp_dir}/ck")
    got = sorted((r.date.day, r.close) for r in spark.read.parquet(table).collect())
    assert got == [(1, 1.5), (3, 1.7)]
    bad = spark.read.parquet(f"{table}_quarantine").collect()
    assert [(r.value, r.n_fields, r.expected_fields) for r in bad] == [("X,A,d,2024-01-02,1,2", 6, 12)]


def test_job_entry_points(spark, tmp_dir, capsys):
    import marketlens.__main__ as cli
    root = QI.write_raw_landing(spark, SMALL)
    glob = f"{root}/*/*/*.csv"
    cli.main(["process", "--raw", glob, "--out", f"{tmp_dir}/lake", "--csv-copy"])
    cli.main(["analyze", "--processed", f"{tmp_dir}/lake/processed/daily_stocks",
              "--out", f"{tmp_dir}/lake", "--start", "2024-01-10"])
    cli.main(["ingest", "--landing", glob, "--table", f"{tmp_dir}/lake/tables/bars",
              "--checkpoint", f"{tmp_dir}/lake/_ck", "--max-files-per-trigger", "300"])
    out = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert {"daily_stocks", "stock_aggregations"} <= set(out[0]) and "insights" in out[1]
    daily = spark.read.parquet(f"{tmp_dir}/lake/processed/daily_stocks")
    assert daily.count() == spark.read.parquet(f"{tmp_dir}/lake/tables/bars").count()
    assert spark.read.json(f"{tmp_dir}/lake/analytics/insights").count() == 1
    assert spark.read.option("header", True).csv(f"{tmp_dir}/lake/processed/daily_stocks_csv").count() \
        == daily.count()
