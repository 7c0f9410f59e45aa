"""Writers: processed layout, analysis CSV, JSON rows, one-exchange publish."""

import datetime as dt
import glob
import json
import os
import re

from pyspark.sql import functions as F

from marketlens.sources import ingest, sinks


def _bars(spark):
    rows = [("X" if i % 2 else "Y", f"S{i % 3}", dt.date(2024, 1 + i % 2, 1 + i % 27), float(i), i + 1)
            for i in range(60)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, date date, close double, volume bigint")
    return df.withColumns({"year": F.year("date"), "month": F.month("date")})


def test_write_processed_layout_and_csv_copy(spark, tmp_dir):
    df = _bars(spark)
    sinks.write_processed(df, f"{tmp_dir}/p", csv_copy=True)
    dirs = sorted(os.path.relpath(d, f"{tmp_dir}/p") for d in glob.glob(f"{tmp_dir}/p/year=*/month=*"))
    assert dirs == ["year=2024/month=1", "year=2024/month=2"]
    back = spark.read.parquet(f"{tmp_dir}/p")
    assert back.count() == 60 and back.exceptAll(df.select(*back.columns)).count() == 0
    csv = spark.read.option("header", True).csv(f"{tmp_dir}/p_csv")
    assert csv.count() == 60 and "close" in csv.columns
    flat = df.drop("year", "month")
    sinks.write_processed(flat, f"{tmp_dir}/flat")
    assert not glob.glob(f"{tmp_dir}/flat/year=*") and spark.read.parquet(f"{tmp_dir}/flat").count() == 60


def test_write_analysis_and_json_row(spark, tmp_dir):
    df = _bars(spark)
    out = sinks.write_analysis(df.limit(5), f"{tmp_dir}/analytics", "technical_analysis")
    assert out.endswith("/technical_analysis")
    assert spark.read.option("header", True).csv(out).count() == 5
    one = df.agg(F.to_json(F.struct(F.count(F.lit(1)).alias("n"))).alias("doc"))
    sinks.write_json_row(one, f"{tmp_dir}/j")
    files = glob.glob(f"{tmp_dir}/j/*.json")
    assert len(files) == 1
    assert json.loads(json.loads(open(files[0]).read())["doc"]) == {"n": 60}


def test_landing_one_exchange_keeps_others(spark, tmp_dir):
    df = _bars(spark).select(
        "exchange", "symbol", "date", F.col("close").alias("open"), F.col("close").alias("high"),
        F.col("close").alias("low"), "close", "volume",
        (F.col("date").cast("timestamp_ntz") + F.expr("INTERVAL 30 HOURS")).alias("download_timestamp"),
        F.col("exchange").alias("exchangeCode"), F.col("symbol").alias("symbolCode"),
        F.lit("d").alias("interval"))
    root = f"{tmp_dir}/land"
    sinks.write_landing(df, root, columns=ingest.RAW12)
    before = ingest.read_raw_bars(spark, f"{root}/*/*/*.csv").count()
    # republish only exchange X with one changed close: Y's folders stay
    sinks.write_landing(df.withColumn("close", F.col("close") + 1), root, columns=ingest.RAW12,
                        exchange="X")
    after = ingest.read_raw_bars(spark, f"{root}/*/*/*.csv")
    assert after.count() == before == 60
    x = after.filter("exchange = 'X'").agg(F.sum("close")).first()[0]
    want = df.filter("exchange = 'X'").agg(F.sum("close")).first()[0] + 30
    assert x == want


def test_cluster_conf_and_apply_unset(spark):
    from marketlens.session import apply_unset, cluster_conf
    c = cluster_conf(100 * (1 << 40), 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert int(cluster_conf(1 << 20, 64)["spark.sql.shuffle.partitions"]) == 3 * 64
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    try:
        apply_unset(spark, {key: "123456"})           # not set at launch: applied
        assert spark.conf.get(key) == "123456"
        master = spark.sparkContext.master
        apply_unset(spark, {"spark.master": "yarn"})  # set at launch: left alone
        assert spark.sparkContext.master == master
    finally:
        spark.conf.set(key, old)


def test_read_bars_prunes_both_ends(spark, tmp_dir):
    rows = [("X", "A", dt.date(2024, m, 15), float(m), m) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, date date, close double, volume bigint")
    df = df.withColumns({"year": F.year("date"), "month": F.month("date")})
    sinks.write_processed(df, f"{tmp_dir}/p")
    b = ingest.read_bars(spark, f"{tmp_dir}/p", start=dt.date(2024, 3, 20), end=dt.date(2024, 6, 10))
    assert sorted(r.close for r in b.collect()) == [4.0, 5.0]
    assert dict(b.dtypes)["volume"] == "double"          # the reader casts numerics to double
    p = b._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*year", p), p         # month folders pruned


def test_valid_row_survives_an_invalid_or_unstamped_first_download(spark):
    import datetime as dt

    from marketlens.operators import clean
    t = [None, dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)]
    df = spark.createDataFrame(
        [("X", "A", "2024-01-02", None, 5, t[1]), ("X", "A", "2024-01-02", "2.0", 5, t[2]),
         ("X", "B", "2024-01-02", "9.0", 5, t[0]), ("X", "B", "2024-01-02", "3.0", 5, t[1])],
        "exchange string, symbol string, date string, close string, volume bigint, download_timestamp timestamp_ntz")
    got = clean.dedupe_bars(clean.valid_bars(df)).collect()
    assert {(r.symbol, r.close) for r in got} == {("A", "2.0"), ("B", "3.0")}


def test_one_hot_month_has_many_writers(spark, tmp_dir):
    import os

    from pyspark.sql import functions as F

    from marketlens.sources import sinks
    new = spark.range(20_000).select(
        F.lit("X").alias("exchange"), F.col("id").cast("string").alias("symbol"),
        F.lit("2024-01-05").cast("date").alias("date"), F.lit(1.0).alias("close"),
        F.lit("2024-02-01").cast("timestamp_ntz").alias("download_timestamp"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sinks.insert_if_absent(new, f"{tmp_dir}/t") == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for _, _, fs in os.walk(f"{tmp_dir}/t") for f in fs if f.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(f"{tmp_dir}/t").count() == 20_000


def test_published_reports_are_whole_or_unseen(spark, tmp_dir):
    schema = "exchange string, n bigint"
    make = lambda rows: spark.createDataFrame(rows, schema)
    path = f"{tmp_dir}/published"
    assert sinks.read_published(spark, path, "json", schema) is None
    assert sinks.publish_report(make([]), path, "a") == 0 and not os.path.exists(path)
    assert sinks.publish_report(make([("X", 1), ('Y, "z"', None)]), path, "a") == 2
    assert sinks.publish_report(make([("W", 5)]), path, "b", formats=("csv",)) == 1
    make([("lost", 0)]).write.json(f"{path}/json/c-0")    # a writer that died before its entry
    read = lambda f: sorted((r.report, r.exchange, r.n) for r in sinks.read_published(spark, path, f, schema).collect())
    assert read("json") == [("a", "X", 1), ("a", 'Y, "z"', None)]
    assert read("csv") == [("a", "X", 1), ("a", 'Y, "z"', None), ("b", "W", 5)]
    assert sinks.publish_report(make([("X", 2)]), path, "a") == 1
    assert read("json") == [("a", "X", 2)] and read("csv") == [("a", "X", 2), ("b", "W", 5)]


def test_report_files_are_published_as_they_are(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/reports/old")
    for name, text in (("r1.json", '{"a": 1}\n'), ("old/r2.csv", "x,y\n1,2\n"), ("r3.csv", ""), ("note.txt", "no")):
        with open(f"{tmp_dir}/reports/{name}", "w") as f:
            f.write(text)
    path = f"{tmp_dir}/published"
    read = lambda: {r.report: r.content for r in sinks.read_published(
        spark, path, "files", "name string, content string").collect()}
    assert sinks.publish_report_files(spark, f"{tmp_dir}/reports", path) == 2
    assert read() == {"r1.json": '{"a": 1}\n', "r2.csv": "x,y\n1,2\n"}
    with open(f"{tmp_dir}/reports/r1.json", "w") as f:
        f.write('{"a": 2}')
    os.makedirs(f"{tmp_dir}/next")
    with open(f"{tmp_dir}/next/r1.json", "w") as f:
        f.write('{"a": 2}')
    assert sinks.publish_report_files(spark, f"{tmp_dir}/next", path) == 1
    assert read() == {"r1.json": '{"a": 2}', "r2.csv": "x,y\n1,2\n"}


def test_insert_reads_only_what_may_hold_a_key(spark, tmp_dir):
    """The batch's key bounds reach the table scan; metadata stays unique."""
    schema = "symbol string, exchange string, date date, close double, download_timestamp timestamp"
    at = dt.datetime(2024, 1, 5)
    batch = lambda rows: spark.createDataFrame([(*r, at) for r in rows], schema)
    day = dt.date(2024, 1, 2)
    first = batch([("A", "X", day, 1.0), ("B", "X", day, 2.0), ("A", "X", day, 3.0), ("N", None, day, 4.0)])
    table, meta = f"{tmp_dir}/bars", f"{tmp_dir}/meta"
    for _ in range(2):
        sinks.insert_if_absent(first.where("exchange is not null"), table)
        sinks.insert_metadata(first.where("exchange is not null"), meta)
    sinks.insert_if_absent(batch([("B", "X", day, 9.0), ("C", "Y", dt.date(2024, 2, 1), 5.0)]), table)
    sinks.insert_metadata(batch([("C", "Y", day, 5.0), ("B", "X", day, 5.0)]), meta)
    got = sorted((r.symbol, r.exchange, r.date.month) for r in spark.read.parquet(table).collect())
    assert got == [("A", "X", 1), ("B", "X", 1), ("C", "Y", 2)]
    assert sorted(map(tuple, spark.read.parquet(meta).collect())) == [("A", "X"), ("B", "X"), ("C", "Y")]
