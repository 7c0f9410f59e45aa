"""Quoted fields: commas, doubled quotes and line breaks, across the blocks
of a file; listing of directories in tasks."""

import csv
import io
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.sources import ingest

from test_ingest import H12, write

fields = st.lists(st.text(alphabet='ab ,"\n', max_size=8), min_size=2, max_size=4)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(fields, min_size=1, max_size=6))
def test_fields_of_a_line_equal_the_csv_module(spark, records):
    lines = []
    for r in records:
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(r)
        lines.append(out.getvalue())
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    got = ingest.with_fields(df).withColumn("open", ingest._opens(F.col("value"))).orderBy("i").collect()
    for r, want in zip(got, records):
        assert r._fields == want and r.n_fields == len(want) and not r.open


def test_open_and_malformed_quotes(spark):
    lines = ['a,"b', 'a,"b""', '"', 'a,b"', 'a,"b"c,d', 'a,5" pipe,x', '"a,b",c', '""', 'a,""', 'a,"b","c']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    got = ingest.with_fields(df).withColumn("open", ingest._opens(F.col("value"))).orderBy("i").collect()
    assert [r.open for r in got] == [True, True, True, False, False, False, False, False, False, True]
    assert [r.n_fields for r in got][3:9] == [2, 3, 3, 2, 1, 2]
    assert got[5]._fields == ["a", '5" pipe', "x"]


@pytest.mark.parametrize("block", ["128m", "200"])
def test_records_over_many_lines_and_blocks(spark, tmp_dir, block):
    """Files cut into blocks of 200 bytes give the records of whole files."""
    rng = random.Random(3)
    want = []
    for f in range(4):
        rows = [["".join(rng.choice('ab,"\n ') for _ in range(rng.randrange(12))) + "x" for _ in range(3)]
                for _ in range(60)]
        if f == 3:  # no quotes at all
            rows = [[c.replace("\n", "").replace('"', "").replace(",", "") for c in r] for r in rows]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(rows)
        write(f"{tmp_dir}/{f}.csv", out.getvalue())
        want += [(f"{f}.csv", r) for r in rows]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = ingest._lines(spark, f"{tmp_dir}/*.csv")
        if block == "200":
            assert lines.select("_block").distinct().count() >= 8
        got = [(os.path.basename(r.source_file), r._fields) for r in ingest.with_fields(ingest.whole_records(lines)[0]).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert sorted(got) == sorted(want)


def test_a_quote_that_never_closes_spoils_only_its_line(spark, tmp_dir):
    line = "X,{0},d,2024-01-01,1,2,0.5,1.5,10,{0},X,2024-01-02 06:00:00\n"
    write(f"{tmp_dir}/raw/X/20240102/A.csv", H12 + "\n" + line.format('"A, ""1"""') + line.format('"two\nlines"')
          + 'X,A,d,2024-01-01,"1,2,0.5,1.5,10,A,X,2024-01-02 06:00:00\n' + line.format("B") + line.format('"C, Inc"'))
    good, bad = ingest.split_ragged(spark, f"{tmp_dir}/raw/*/*/*.csv")
    assert sorted(r.symbol for r in ingest.parse_good_lines(good).collect()) == ['A, "1"', "B", "C, Inc", "two\nlines"]
    assert [r.value[:8] for r in bad.collect()] == ["X,A,d,20"]
    assert [r.n_bad_lines for r in ingest.faults(bad).collect()] == [1]


def test_reports_tell_their_bad_lines(spark, tmp_dir):
    write(f"{tmp_dir}/collection_report_20260102_095107.csv",
          'exchange,successful,failed,data_points,files\n"A, B",1,0,5,1\nC,1,0\nD,2,0,6,1\n')
    got = sorted((r.exchange, r.successful_symbols, r.n_bad_lines) for r in ingest.read_reports(spark, f"{tmp_dir}/*.csv").collect())
    assert got == [("A, B", 1, 1), ("D", 2, 1)]


def test_listing_runs_in_tasks(spark, tmp_dir):
    want = {}
    for k in range(3):
        for j in range(k + 1):
            path = f"{tmp_dir}/lake/x=d{k}/e{j}/f {j}.csv"
            write(path, "y" * (10 * k + j))
            want[f"file:{path}"] = 10 * k + j
    write(f"{tmp_dir}/lake/_SUCCESS", "")
    write(f"{tmp_dir}/lake/.hidden/a.csv", "z")
    os.makedirs(f"{tmp_dir}/lake/empty")
    for root in (f"{tmp_dir}/lake", f"file:{tmp_dir}/lake/", f"file://{tmp_dir}/lake"):
        got = {r.path.replace("file://", "file:", 1): (r.length, r.modificationTime)
               for r in ingest.list_files(spark, root).collect()}
        assert {p: n for p, (n, _) in got.items()} == want
        assert all(t is not None for _, t in got.values())
    audit = ingest.file_audit(spark, f"{tmp_dir}/lake", glob="f*.csv")
    assert audit.count() == 6 and audit.where("name like 'f 2%'").first().size == 22


def test_quoted_records_are_joined_and_judged_once(spark, tmp_dir):
    """Readers of both results neither sort the lines nor match them again;
    files without quotes are still judged."""
    line = "X,{0},d,2024-01-01,1,2,0.5,1.5,10,{0},X,2024-01-02 06:00:00\n"
    write(f"{tmp_dir}/raw/X/20240102/A.csv", H12 + "\n" + line.format('"two\nlines"') + line.format('"a\n""b"",\nc"')
          + 'X,A,d,"cut\nhere"\n' + line.format("B"))
    write(f"{tmp_dir}/raw/Y/20240102/A.csv", H12 + "\n" + line.format("D") + "X,D,d\n")
    good, bad = ingest.split_ragged(spark, f"{tmp_dir}/raw/*/*/*.csv")
    for df in (good, bad):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Join" not in plan and "RLIKE" not in plan
    assert sorted(r.symbol for r in ingest.parse_good_lines(good).collect()) == ["B", "D", 'a\n"b",\nc', "two\nlines"]
    assert sorted((r.value, r.n_fields, r.expected_fields) for r in bad.collect()) == [
        ('X,A,d,"cut', 4, 12), ("X,D,d", 3, 12), ('here"', 1, 12)]
