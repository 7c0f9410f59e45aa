"""Sinks: processed/analysis/insights/landing writers (S5-S9, S11, S12),
published reports (S12), idempotent inserts into the bar table (S10/J6) and
new metadata (J7).

Writers lay files out for the readers: processed bars are range-partitioned
on (year, month, exchange, symbol, date) before a partitioned write, so a hot
month is split across tasks by sampled bounds, each task writes few
directories, and files come out sorted by date (tight parquet min/max stats
for date-range pruning).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from marketlens.operators.clean import BAR_KEYS, dedupe_bars
from marketlens.session import materialize


def rows_to_insert(existing: DataFrame, new: DataFrame, keys=BAR_KEYS,
                   order_col: str = "download_timestamp") -> DataFrame:
    """Rows of ``new`` whose key is absent from ``existing``, one per
    key (first download wins).  ``left_anti`` replaces the per-row existence
    probe; only the key columns of ``existing`` are read."""
    fresh = dedupe_bars(new, keys=keys, policy="first", order_col=order_col)
    return fresh.join(existing.select(*keys), list(keys), "left_anti")


def insert_if_absent(new: DataFrame, table_path: str, keys=BAR_KEYS,
                     order_col: str = "download_timestamp",
                     partition_by=("year", "month")) -> int:
    """Append to the parquet bar table at ``table_path`` the rows of
    ``new`` whose key it does not hold yet (first download wins; a missing
    table is created).  Only the table's (year, month) folders within the
    new rows' date range are read, and only their key columns.  Returns the
    number of distinct keys in ``new`` (0: nothing was written).

    ``new`` is de-duplicated and written once (shared checkpoint folder) for
    the three uses below: key bounds, anti join, insert.  The bounds of date,
    exchange and symbol reach the scan, which skips files and row groups of
    the sorted table outside them."""
    fresh = materialize(dedupe_bars(new, keys=keys, policy="first", order_col=order_col), "insert-batch")
    bounds = fresh.agg(F.count(F.lit(1)).alias("n"), *[
        f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    if not bounds["n"]:
        return 0
    rows, t = fresh, _table(new.sparkSession, table_path)
    if t is not None:
        lo, hi = bounds["min_date"], bounds["max_date"]
        if lo is not None:
            ym = F.col("year") * 100 + F.col("month")
            t = t.filter(ym.between(lo.year * 100 + lo.month, hi.year * 100 + hi.month))
        for k in keys:  # a null key is in no table row's range and joins nothing
            if bounds[f"min_{k}"] is not None:
                t = t.filter(F.col(k).between(F.lit(bounds[f"min_{k}"]), F.lit(bounds[f"max_{k}"])))
        rows = fresh.join(t.select(*keys), list(keys), "left_anti")
    (rows.withColumns({"year": F.year("date"), "month": F.month("date")})
     .repartitionByRange(*partition_by, *keys)  # a month is split over many tasks
     .write.mode("append").partitionBy(*partition_by).parquet(table_path))
    return bounds["n"]


def _table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame | None:
    """The table at ``path``; None before its first write."""
    try:
        r = spark.read.format(fmt)
        return (r.schema(schema) if schema else r).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def new_metadata(meta: DataFrame, bars: DataFrame, keys=("symbol", "exchange")) -> DataFrame:
    """(symbol, exchange) pairs seen in bars but missing from metadata."""
    return bars.select(*keys).distinct().join(meta.select(*keys), list(keys), "left_anti")


def insert_metadata(bars: DataFrame, path: str, keys=("symbol", "exchange")) -> None:
    """J7 as a sink: appends the pairs of ``bars`` that the metadata table at
    ``path`` does not hold (a missing table is created).  Run again with the
    same bars it adds nothing, so a replayed batch is safe."""
    meta = _table(bars.sparkSession, path)
    rows = bars.select(*keys).distinct() if meta is None else new_metadata(meta, bars, keys)
    rows.write.mode("append").parquet(path)


def write_processed(df: DataFrame, path: str, partition_by=("year", "month"),
                    csv_copy: bool = False, mode: str = "overwrite") -> None:
    """Parquet partitioned by year/month when present, else flat;
    optional headered CSV copy next to it (``{path}_csv``)."""
    parts = [c for c in partition_by if c in df.columns]
    order = parts + [c for c in ("exchange", "symbol", "date") if c in df.columns]
    laid = df.repartitionByRange(*order) if order else df
    w = laid.write.mode(mode)
    (w.partitionBy(*parts) if parts else w).parquet(path)
    if csv_copy:  # from the files just written: one computation, equal stamps
        (df.sparkSession.read.parquet(path).select(*df.columns)
         .write.mode(mode).option("header", True).csv(f"{path}_csv"))


def write_analysis(df: DataFrame, base: str, analysis_type: str) -> str:
    """Headered CSV at ``{base}/{analysis_type}``, overwritten."""
    out = f"{base.rstrip('/')}/{analysis_type}"
    df.write.mode("overwrite").option("header", True).csv(out)
    return out


def write_json_row(df: DataFrame, path: str) -> None:
    """A one-row (or small) frame as JSON lines."""
    df.repartition(1).write.mode("overwrite").json(path)


def write_landing(df: DataFrame, path: str, columns=None,
                  snapshot_col: str = "download_timestamp", exchange: str | None = None,
                  mode: str = "overwrite", max_records_per_file: int = 5_000_000) -> None:
    """Raw snapshot layout
    ``{path}/landing_exchange=X/snapshot_date=YYYYMMDD/part-*.csv``.

    Files keep every raw column in ``columns`` order (the partition columns
    are copies), timestamps as ``yyyy-MM-dd HH:mm:ss.SSSSSS``.  Only the
    touched partitions are replaced (dynamic partition overwrite), empty
    inputs write nothing, and ``exchange`` limits the publish to one
    exchange.  Rows are range-partitioned by (exchange, day, symbol): each
    task writes few directories, and a hot exchange-day is split across
    tasks by sampled symbol bounds instead of landing in one writer;
    ``max_records_per_file`` caps file sizes."""
    d = df if exchange is None else df.filter(F.col("exchange") == exchange)
    cols = list(columns or d.columns)
    stamp = F.col(snapshot_col)
    body = [F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if c == snapshot_col
            else F.col(c) for c in cols]
    d = d.select(*body, F.col("exchange").alias("landing_exchange"),
                 F.date_format(stamp, "yyyyMMdd").alias("snapshot_date"))
    (d.repartitionByRange("landing_exchange", "snapshot_date", "symbol")
     .write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .option("header", True).option("escape", '"')  # a quote in a field is doubled
     .partitionBy("landing_exchange", "snapshot_date")
     .csv(path))


# --- published reports (S12) -------------------------------------------------

COMMIT_SCHEMA = "name string, format string, folder string, n_rows bigint, version bigint"
REPORT_FORMATS = ("json", "csv")


def _commit(entries: DataFrame, path: str) -> None:
    """Manifest entries become visible together, as one file; the next
    version number makes them the latest of their reports."""
    spark = entries.sparkSession
    old = _table(spark, f"{path}/commits", "json", COMMIT_SCHEMA)
    last = None if old is None else old.agg(F.max("version")).first()[0]
    (entries.withColumn("version", F.lit((last or 0) + 1).cast("bigint")).repartition(1)
     .write.mode("append").json(f"{path}/commits"))


def publish_report(report: DataFrame, path: str, name: str, formats=REPORT_FORMATS) -> int:
    """Publishes one report under ``path`` as JSON lines and headered
    CSV.  Files are staged in a folder of their own; only the manifest entry
    written after them makes them visible, so readers see whole reports only
    and the earlier version until then.  A report published again replaces the
    earlier version.  Empty reports are skipped.  Returns the rows published."""
    wrong = set(formats) - set(REPORT_FORMATS)
    if wrong:
        raise ValueError(f"reports are published as {REPORT_FORMATS}, not {sorted(wrong)}")
    report = materialize(report, "report")
    n = report.count()
    if not n:
        return 0
    folder = f"{name}-{uuid.uuid4().hex[:12]}"
    for fmt in formats:
        (report.write.option("header", True).option("escape", '"').format(fmt).save(f"{path}/{fmt}/{folder}"))
    _commit(report.sparkSession.createDataFrame([(name, f, folder, n) for f in formats],
                                                "name string, format string, folder string, n_rows bigint"), path)
    return n


def publish_report_files(spark: SparkSession, source: str, path: str) -> int:
    """Publishes the JSON and CSV files found under ``source`` (report
    files of collection cycles; other kinds and empty files are skipped) as
    they are, one row per file, all visible together.  Returns their number.
    A report file is read whole: it is one summary, not a table."""
    r = spark.read.option("pathGlobFilter", "*.{json,csv}").option("recursiveFileLookup", True)
    files = r.text(source, wholetext=True).where(F.trim("value") != "").select(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"), F.col("value").alias("content"))
    folder = f"files-{uuid.uuid4().hex[:12]}"
    files.write.parquet(f"{path}/files/{folder}")
    staged = spark.read.parquet(f"{path}/files/{folder}")
    n = staged.count()
    if n:
        _commit(staged.select("name", F.lit("files").alias("format"), F.lit(folder).alias("folder"),
                              F.lit(1).cast("bigint").alias("n_rows")), path)
    return n


def published(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    """The latest manifest entry per report of one format; None if nothing
    was published yet."""
    commits = _table(spark, f"{path}/commits", "json", COMMIT_SCHEMA)
    if commits is None:
        return None
    latest = Window.partitionBy("name").orderBy(F.desc("version"), F.desc("folder"))
    return (commits.where(F.col("format") == fmt).withColumn("_n", F.row_number().over(latest))
            .where("_n = 1").drop("_n", "format"))


def read_published(spark: SparkSession, path: str, fmt: str, schema: str) -> DataFrame | None:
    """Rows of the published reports of a format (``json``, ``csv``, or
    ``files`` with columns name, content) and ``report``, the name.  Folders
    without a manifest entry, or with an older one, are not read."""
    seen = published(spark, path, fmt)
    if seen is None or seen.isEmpty():
        return None
    r = spark.read.schema(schema).option("header", True).option("escape", '"')
    rows = r.format("parquet" if fmt == "files" else fmt).load(f"{path}/{fmt}/*")
    rows = rows.withColumn("_folder", F.element_at(F.split("_metadata.file_path", "/"), -2))
    seen = seen.select(F.col("name").alias("report"), F.col("folder").alias("_folder"))
    if fmt == "files":  # one folder holds many reports
        return rows.join(seen, (rows["_folder"] == seen["_folder"]) & (rows["name"] == seen["report"])).select(
            *rows.drop("_folder").columns, "report")
    return rows.join(seen, "_folder").drop("_folder")
