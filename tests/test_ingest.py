"""Readers: two CSV layouts side by side, ragged lines, empty files,
non-numeric prices, report versions, quote normalisation, file audit."""

import datetime as dt
import os

from pyspark.sql import functions as F

from marketlens.sources import ingest, sinks

H12 = ",".join(ingest.RAW12)
H13 = ",".join(ingest.RAW13)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_layouts_by_name_ragged_and_bad_values(spark, tmp_dir):
    write(f"{tmp_dir}/raw/AMEX/20260114/AAA.csv",
          H12 + "\nAMEX,AAA,d,2025-12-15,11.5,12.25,11.0,12.0,7300,AAA,AMEX,2026-01-14 06:30:15.250000\n"
          "AMEX,AAA,d,2025-12-16,x,12.5,11.75,12.25,7300.0,AAA,AMEX,2026-01-14 06:30:15.250000\n"
          "AMEX,AAA,d,2025-12-17,1,2\n\n")
    write(f"{tmp_dir}/raw/CC/20260104/QQQ-USD.csv",
          H13 + "\nCC,QQQ-USD,d,2025-12-03,3.25,3.75,3.0,3.5,3.375,0,QQQ-USD,CC,"
          "2026-01-04 11:05:07.125000\n")
    write(f"{tmp_dir}/raw/CC/20260104/EMPTY.csv", "")
    glob = f"{tmp_dir}/raw/*/*/*.csv"
    rows = {(r.symbol, r.date): r for r in ingest.read_raw_bars(spark, glob).collect()}
    assert len(rows) == 3
    aaa = rows[("AAA", dt.date(2025, 12, 15))]
    assert aaa.exchange == "AMEX" and aaa.volume == 7300 and aaa.adjusted_close is None
    assert aaa.path_exchange == "AMEX" and aaa.snapshot_date == dt.date(2026, 1, 14)
    bad = rows[("AAA", dt.date(2025, 12, 16))]
    assert bad.open is None and bad.volume == 7300          # "x" -> NULL, "7300.0" -> 7300
    btc = rows[("QQQ-USD", dt.date(2025, 12, 3))]
    assert btc.exchange == "CC" and btc.adjusted_close == 3.375 and btc.volume == 0
    assert btc.download_timestamp == dt.datetime(2026, 1, 4, 11, 5, 7, 125000)
    good, ragged = ingest.split_ragged(spark, glob)
    assert good.count() == 3
    r = ragged.collect()
    assert len(r) == 1 and r[0].n_fields == 6
    assert ingest.ragged_sample(ragged, 50).count() == 1


def test_lines_are_judged_by_their_own_header(spark, tmp_dir):
    swapped = list(ingest.RAW12)
    swapped[4], swapped[7] = swapped[7], swapped[4]         # close before high, open last
    write(f"{tmp_dir}/raw/X/20240102/CUT.csv",
          H13 + "\nX,A,d,2024-01-01,1,2,0.5,1.5,1.4,10,A,X\n"   # 12 of 13 fields: bad, not RAW12
          "X,A,d,2024-01-02,1,2,0.5,1.5,1.4,10,A,X,2024-01-03 06:00:00\n")
    write(f"{tmp_dir}/raw/X/20240102/ORDER.csv",
          ",".join(swapped) + "\nX,B,d,2024-01-01,1.5,2,0.5,1,10,B,X,2024-01-02 06:00:00\n")
    write(f"{tmp_dir}/raw/X/20240102/NOHEAD.csv",
          "X,C,d,2024-01-01,1,2,0.5,1.5,10,C,X,2024-01-02 06:00:00\n")
    glob = f"{tmp_dir}/raw/*/*/*.csv"
    good, bad = ingest.split_ragged(spark, glob)
    got = {r.symbol: (r.open, r.close, r.adjusted_close) for r in ingest.parse_good_lines(good).collect()}
    assert got == {"A": (1.0, 1.5, 1.4), "B": (1.0, 1.5, None)}
    assert sorted((r.n_fields, r.expected_fields or 0) for r in bad.collect()) == [(12, 0), (12, 13)]


def test_landing_round_trip(spark, tmp_dir):
    df = spark.createDataFrame(
        [("X", "A", dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 1.5, 10, dt.datetime(2024, 1, 2, 6))],
        "exchange string, symbol string, date date, open double, high double, low double, "
        "close double, volume bigint, download_timestamp timestamp_ntz")
    df = df.withColumns({"exchangeCode": F.col("exchange"), "symbolCode": F.col("symbol"),
                         "interval": F.lit("d")})
    sinks.write_landing(df, f"{tmp_dir}/land", columns=ingest.RAW12)
    back = ingest.read_raw_bars(spark, f"{tmp_dir}/land/*/*/*.csv").first()
    assert (back.exchange, back.symbol, back.close, back.volume) == ("X", "A", 1.5, 10)
    assert back.snapshot_date == dt.date(2024, 1, 2) and back.path_exchange == "X"
    # dynamic overwrite replaces only the touched partition
    sinks.write_landing(df, f"{tmp_dir}/land", columns=ingest.RAW12)
    assert ingest.read_raw_bars(spark, f"{tmp_dir}/land/*/*/*.csv").count() == 1


def test_reports_of_three_versions(spark, tmp_dir):
    write(f"{tmp_dir}/rep/collection_report_20260102_101500.csv",
          "exchange,successful,failed,data_points,files\nALPHA,7,3,91,7\n")
    write(f"{tmp_dir}/rep/collection_report_all_20260103_102000.csv",
          "exchange,successful_symbols,failed_symbols,data_points,files,database_success,"
          "database_failed\nALPHA,12,1,156,12,9,3\n")
    write(f"{tmp_dir}/rep/collection_report_all_20260104_103000.csv",
          "exchange,successful_symbols,failed_symbols,data_points,hdfs_upload_count,files,"
          "database_success,database_failed\nALPHA,15,2,195,14,15,13,2\nBAD,1\n")
    rows = {r.report_time.day: r for r in ingest.read_reports(spark, f"{tmp_dir}/rep/*.csv").collect()}
    assert len(rows) == 3
    assert rows[2].successful_symbols == 7 and rows[2].database_success is None
    assert rows[3].database_failed == 3 and rows[3].hdfs_upload_count is None
    assert rows[4].hdfs_upload_count == 14 and rows[4].files == 15
    _, bad = ingest.split_reports(spark, f"{tmp_dir}/rep/*.csv")
    assert [r.value for r in bad.collect()] == ["BAD,1"]


def test_read_bars_csv_fallback_and_pruning(spark, tmp_dir):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 1.0, "X", "A"), (dt.date(2024, 3, 5), 2.0, "X", "A")],
                               "date date, close double, exchange string, symbol string")
    df = df.withColumns({"year": F.year("date"), "month": F.month("date")})
    sinks.write_processed(df, f"{tmp_dir}/proc", csv_copy=True)
    b = ingest.read_bars(spark, f"{tmp_dir}/proc", start=dt.date(2024, 3, 1))
    assert [r.close for r in b.collect()] == [2.0]
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    # no parquet folder: the headered CSV copy is read instead
    df.write.option("header", True).csv(f"{tmp_dir}/only_csv_csv")
    fb = ingest.read_bars(spark, f"{tmp_dir}/only_csv")
    assert sorted(r.close for r in fb.collect()) == [1.0, 2.0]


def test_standard_names_and_quotes(spark):
    assert ingest.standard_names(["Date", "OPEN", "adjustedClose", "Volume", "x"]) == {
        "Date": "date", "OPEN": "open", "adjustedClose": "adjusted_close", "Volume": "volume"}
    assert ingest.standard_names(["timestamp", "close"]) == {"close": "close", "timestamp": "date"}
    df = spark.createDataFrame([
        ("A", "X", "2024-01-01", "1.5", "10"), ("A", "X", "2024-01-02", "oops", "11"),
        ("A", "X", "2024-01-03", "2.5", "12"),
        ("B", "X", "2024-01-01", "1.0", "1"), ("B", "X", "not a date", "1.0", "1")],
        "symbol string, exchange string, Date string, Close string, Volume string")
    out = ingest.normalise_quotes(df, keep_last=2, loaded_at="2024-02-01 00:00:00").collect()
    assert {r.symbol for r in out} == {"A"}                 # B has an unparseable date
    assert [r.date.day for r in sorted(out, key=lambda r: r.date)] == [2, 3]
    assert [r.close for r in sorted(out, key=lambda r: r.date)] == [None, 2.5]
    none = spark.createDataFrame([("A", "X", 1.0)], "symbol string, exchange string, close double")
    assert ingest.normalise_quotes(none).count() == 0


def test_exchange_and_symbol_lists(spark):
    ex = spark.createDataFrame([("US", "United", None), ("", "NoCode", "x"), (None, "n", None)],
                               "code string, name string, country string")
    out = ingest.clean_exchanges(ex).collect()
    assert [(r.code, r.country, r.timeZone) for r in out] == [("US", "", "")]
    sy = spark.createDataFrame([("A", "a", "X", 1), ("B", "", "X", 2), ("C", "c", "X", 3),
                                ("D", "d", "X", 4), ("E", "e", "Y", 1)],
                               "code string, name string, exchange string, list_pos int")
    got = sorted((r.exchange, r.code) for r in ingest.clean_symbols(sy, per_exchange=2).collect())
    assert got == [("X", "A"), ("X", "C"), ("Y", "E")]


def test_file_audit_and_directory_totals(spark, tmp_dir):
    write(f"{tmp_dir}/lake/a/1.csv", "x" * 10)
    write(f"{tmp_dir}/lake/a/b/2.csv", "y" * 20)
    write(f"{tmp_dir}/lake/3.csv", "z" * 5)
    write(f"{tmp_dir}/lake/skip.txt", "nope")
    audit = ingest.file_audit(spark, f"{tmp_dir}/lake", glob="*.csv", small_bytes=15)
    rows = {r.name: r for r in audit.collect()}
    assert set(rows) == {"1.csv", "2.csv", "3.csv"}
    assert rows["2.csv"].size == 20 and rows["1.csv"].is_small and not rows["2.csv"].is_small
    tot = {r.directory.split("/lake")[-1]: r
           for r in ingest.directory_totals(audit, f"{tmp_dir}/lake").collect()}
    assert (tot[""].file_count, tot[""].dir_count, tot[""].total_size) == (1, 1, 5)
    assert (tot["/a"].file_count, tot["/a"].dir_count, tot["/a"].total_size) == (1, 1, 10)
    assert (tot["/a/b"].file_count, tot["/a/b"].dir_count, tot["/a/b"].total_items) == (1, 0, 1)


def test_quotes_json_array_any_order(spark, tmp_dir):
    write(f"{tmp_dir}/q/a.json",
          '[{"close": 2.5, "Date": "2024-01-02", "symbol": "A", "exchange": "X", "Volume": 7},\n'
          ' {"exchange": "X", "symbol": "A", "Date": "2024-01-01", "close": "1.5", "Volume": null}]')
    landed = ingest.read_quotes_json(spark, f"{tmp_dir}/q/*.json", multi_line=True)
    out = sorted(ingest.normalise_quotes(landed, loaded_at="2024-02-01 00:00:00").collect(),
                 key=lambda r: r.date)
    assert [(r.date.day, r.close, r.volume) for r in out] == [(1, 1.5, None), (2, 2.5, 7)]


def test_bad_date_drops_only_its_file(spark):
    rows = [("X", "S", "2024-01-02", "1", "a"), ("X", "S", "never", "2", "b"),
            ("X", "S", "2024-01-03", "3", "b"), ("X", "T", "2024-01-03", "4", "b")]
    df = spark.createDataFrame(rows, "exchange string, symbol string, date string, close string, src string")
    got = ingest.normalise_quotes(df, keep_last=None, file_col="src")
    assert sorted((r.symbol, r.close) for r in got.collect()) == [("S", 1.0), ("T", 4.0)]
    whole = ingest.normalise_quotes(df.drop("src"), keep_last=None)
    assert [(r.symbol, r.close) for r in whole.collect()] == [("T", 4.0)]


def test_symbol_list_without_a_cap(spark):
    sy = spark.createDataFrame([(str(i), "n", "E", i) for i in range(50)], "code string, name string, exchange string, list_pos int")
    assert ingest.clean_symbols(sy, per_exchange=None).count() == 50
