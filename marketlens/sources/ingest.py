"""Readers and input normalisation: raw vendor CSV (S1, U2, S16), processed
bars (S2), landed vendor quotes (S3, P9-P11, W19), exchange / symbol lists
(P12, P13, W20), ragged-line quarantine (S13), lake file audit (S14, A13) and
collection reports of several schema versions (S17).

Raw CSV snapshots come in two layouts (12 fields; 13 with ``adjusted_close``
before ``volume``).  A headered glob read maps columns by position and
shifts one group (B5).  Here every line is judged by the header of its own
file: one header row per file, joined to the file's lines on the path (the
planner picks the join).  Columns are mapped by that header's names; a line
whose field count differs from it, or whose file has no known header, is
quarantined instead of silently mis-mapped or dropped.  Fields may be quoted
(commas, doubled quotes and line breaks inside); a line whose quote never
closes is quarantined on its own.
"""

from __future__ import annotations

import fnmatch

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from marketlens.session import materialize

# Raw vendor CSV headers, in file order.
RAW12 = ("exchangeCode", "symbolCode", "interval", "date", "open", "high", "low", "close",
         "volume", "symbol", "exchange", "download_timestamp")
RAW13 = ("exchangeCode", "symbolCode", "interval", "date", "open", "high", "low", "close",
         "adjusted_close", "volume", "symbol", "exchange", "download_timestamp")

RAW_COLUMNS = ("exchange", "symbol", "date", "open", "high", "low", "close", "adjusted_close",
               "volume", "interval", "download_timestamp")
PRICE_COLS = ("open", "high", "low", "close", "adjusted_close")

# Exchange directory and snapshot day in the landing path, with or without
# ``key=`` prefixes: raw/{exchange}/{yyyymmdd}/{file} or .../x=EX/y=yyyymmdd/...
PATH_PARTS = r"/(?:[^/=]+=)?([^/]+)/(?:[^/=]+=)?(\d{8})/[^/]+$"


# Quote-aware fields, on a line with a comma put before it, so that every
# field starts with one.  A quote opens a field only at its start; within it a
# doubled quote is a quote.
_CLOSED = r'"[^"]*+(?:""[^"]*+)*+"(?=,|\z)'
_FIELD = rf",({_CLOSED}|[^,]*+)"
_OPENS = rf'^(?:,(?:{_CLOSED}|[^",][^,]*+|(?=,|\z)))*+,"[^"]*+(?:""[^"]*+)*+\z'


def _quoted(line: Column) -> Column:
    return F.contains(line, F.lit('"'))


def _opens(line: Column) -> Column:
    """Whether a line ends inside a quoted field."""
    return _quoted(line) & F.concat(F.lit(","), line).rlike(_OPENS)


def _split(line: Column) -> Column:
    """Fields of a line, without their quotes."""
    def plain(f: Column) -> Column:
        inner = F.replace(f.substr(F.lit(2), F.length(f) - F.lit(2)), F.lit('""'), F.lit('"'))
        return F.when(f.startswith('"') & f.endswith('"') & (F.length(f) > 1), inner).otherwise(f)

    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1)), plain)
    return F.when(_quoted(line), quoted).otherwise(F.split(line, ",", -1))


def _n_fields(line: Column) -> Column:
    commas = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit("")))
    quoted = F.regexp_count(F.concat(F.lit(","), line), F.lit(_FIELD))
    return F.when(_quoted(line), quoted).otherwise(commas + F.lit(1))


def text_lines(df: DataFrame) -> DataFrame:
    """Lines of a text-source frame (batch or streaming) with their source
    file and the block of it that they were read with."""
    return df.select("value", F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.file_block_start").alias("_block"))


def whole_records(lines: DataFrame) -> tuple[DataFrame, bool]:
    """Non-empty lines of one record each (batch): a record whose quoted
    field holds line breaks is put together again, with ``\\n`` between.

    A line maps the state before it (outside or inside quotes) to the state
    after it; maps compose, so the state before a line is the last line that
    sets it whatever came before, turned over by the lines since that swap it.
    They are composed within each block of a file (lines of a block are read
    in order), for either state before the block, and across blocks by one row
    per block, so a large file is many tasks.  The lines are sorted once and
    the records written once: readers of the result repeat none of it.  Only
    files with a line that opens a quote take this path; the flag tells
    whether there are any.  A quote that no later line closes joins nothing."""
    opening = lines.filter(_opens(F.col("value")))
    written = lines.filter(F.length(F.trim("value")) > 0)
    if opening.isEmpty():
        return written.select("value", "source_file"), False
    files = materialize(opening.select("source_file").distinct().withColumn("_file", F.monotonically_increasing_id()), "files")
    plain = written.join(files, "source_file", "left_anti").select("value", "source_file")
    after = F.struct(_opens(F.col("value")).cast("int").alias("out"),
                     F.when(_quoted(F.col("value")), _opens(F.concat(F.lit('"'), F.col("value"))).cast("int"))
                     .otherwise(1).alias("inside"))
    x = lines.withColumn("_line", F.monotonically_increasing_id())  # in order within a block
    x = x.join(files, "source_file").drop("source_file").withColumn("_to", after).select(
        "_file", "_block", "_line", "value",
        F.when(F.col("_to.out") == F.col("_to.inside"), F.col("_to.out")).alias("_set"),
        (F.col("_to.out") > F.col("_to.inside")).cast("int").alias("_swap"))
    block = Window.partitionBy("_file", "_block").orderBy("_line")
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("_swaps", F.sum("_swap").over(upto))
    last = F.last(F.when(F.col("_set").isNotNull(), F.struct("_set", "_swaps")), ignorenulls=True)
    x = x.withColumn("_last", last.over(upto))

    def state(start: Column) -> Column:
        """After a line, of the state before its block."""
        return F.when(F.col("_last").isNull(), (start + F.col("_swaps")) % 2).otherwise(
            (F.col("_last._set") + F.col("_swaps") - F.col("_last._swaps")) % 2)

    # for a block that starts outside (0) and inside (1) quotes: the state
    # after each line, whether it starts a record, which line starts its
    # record (none: one of an earlier block), whether it is a whole record
    both = (0, 1)
    x = x.withColumns({f"_after{s}": state(F.lit(s)) for s in both})
    x = x.withColumns({f"_first{s}": F.coalesce(F.lag(f"_after{s}").over(block), F.lit(s)) == 0 for s in both})
    x = x.withColumns({f"_record{s}": F.last(F.when(F.col(f"_first{s}"), F.col("_line")), ignorenulls=True).over(upto)
                       for s in both} | {f"_whole{s}": F.col(f"_first{s}") & F.lead(f"_first{s}").over(block) for s in both})
    x = materialize(x.select("_file", "_block", "_line", "value", *[f"_{c}{s}" for c in ("after", "record", "whole")
                                                                     for s in both]), "quoted-lines")
    ends = x.groupBy("_file", "_block").agg(
        F.max_by(F.struct(F.col("_after0").alias("out"), F.col("_after1").alias("inside")), "_line").alias("_to"),
        F.max("_record0").alias("_in0"), F.max("_record1").alias("_in1"))
    blocks = Window.partitionBy("_file").orderBy("_block")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    of_file = blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.withColumns({
        "_set": F.when(F.col("_to.out") == F.col("_to.inside"), F.col("_to.out")),
        "_swaps": F.sum((F.col("_to.out") > F.col("_to.inside")).cast("int")).over(blocks)})
    ends = ends.withColumn("_last", last.over(blocks)).withColumn("_after", state(F.lit(0)))
    ends = ends.withColumn("_start", F.coalesce(F.lag("_after").over(blocks), F.lit(0)))

    def taken(name: str) -> Column:
        return F.when(F.col("_start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    ends = ends.withColumn("_in", taken("_in"))
    ends = materialize(ends.select(
        "_file", "_block", "_start", F.last("_in", ignorenulls=True).over(earlier).alias("_before"),
        F.last("_in", ignorenulls=True).over(of_file).alias("_final"),
        (F.last("_after").over(of_file) == 1).alias("_open_end")), "blocks")
    x = x.join(ends, ["_file", "_block"]).withColumn("_record", F.coalesce(taken("_record"), "_before"))
    unclosed = F.col("_open_end") & (F.col("_record") == F.col("_final"))
    whole = unclosed | F.coalesce(taken("_whole"), F.lit(False))
    parts = F.sort_array(F.collect_list(F.struct("_block", "_line", "value")))
    joined = x.filter(~whole).groupBy("_file", "_record").agg(parts.alias("_parts"))
    joined = joined.select(F.array_join(F.col("_parts.value"), "\n").alias("value"), "_file")
    records = x.filter(whole).select("value", "_file").unionByName(joined).filter(F.length(F.trim("value")) > 0)
    records = records.join(files, "_file").select("value", "source_file")
    return materialize(plain.unionByName(records), "records"), True


def with_fields(records: DataFrame) -> DataFrame:
    """Field count and fields (``_fields``) of every record.  Filters are
    pushed below projections, so counts use cheap string functions where no
    quote occurs and the array is built once."""
    return records.withColumns({"n_fields": _n_fields(F.col("value")), "_fields": _split(F.col("value"))})


def _lines(spark: SparkSession, path) -> DataFrame:
    return text_lines(spark.read.text(path))


def _is_header(first_field: str) -> Column:
    head = F.lower(F.trim(F.translate(F.substring_index(F.col("value"), ",", 1), '"', "")))
    return head == F.lit(first_field.lower())


def _typed(raw: Column, kind: str) -> Column:
    if kind == "double":
        return raw.try_cast("double")
    if kind == "long":
        # "10500" and "10500.0" (pandas float columns) both become 10500
        return raw.try_cast("double").try_cast("long")
    if kind == "date":
        return raw.try_cast("date")
    if kind == "timestamp":
        return raw.try_cast("timestamp_ntz")
    return raw


def split_ragged(spark: SparkSession, path, layouts=(RAW12, RAW13),
                 header_first: str = "exchangeCode") -> tuple[DataFrame, DataFrame]:
    """(good, bad) lines.  Good lines have the field count of their own
    file's header, and that header holds the names of one of the ``layouts``
    (in any order).  Header lines and empty lines are in neither.  ``bad``
    keeps the source file, the line, its field count and the expected one
    (NULL: the file has no known header)."""
    return split_ragged_lines(_lines(spark, path), layouts, header_first)


def split_ragged_lines(lines: DataFrame, layouts=(RAW12, RAW13),
                       header_first: str = "exchangeCode") -> tuple[DataFrame, DataFrame]:
    """``split_ragged`` on a batch frame of ``text_lines``.  Of several
    header lines in a file the smallest text counts.  A record of several
    lines that does not fit comes apart, and its lines are judged one by one:
    a stray quote spoils its own line only."""
    records, joined = whole_records(lines)
    records = with_fields(records)
    is_head = _is_header(header_first)
    names = F.transform("_header", lambda c: F.lower(F.trim(c)))
    known = F.lit(False)
    for layout in layouts:
        known = known | (F.sort_array("_names") == F.array(*[F.lit(c) for c in sorted(map(str.lower, layout))]))
    wanted = sorted({c for layout in layouts for c in layout})
    heads = (records.filter(is_head).groupBy("source_file").agg(F.min_by("_fields", "value").alias("_header"))
             .withColumn("_names", names).filter(known)
             # 0-based position of every column, -1 where the layout lacks it
             .select("source_file", F.size("_names").alias("expected_fields"),
                     F.struct(*[(F.array_position("_names", F.lit(c.lower())) - 1).cast("int").alias(c)
                                for c in wanted]).alias("_at")))
    judged = records.filter(~is_head).join(heads, "source_file", "left")

    def fits(n_fields: Column) -> Column:
        return F.coalesce((n_fields == F.col("expected_fields")) & ~_opens(F.col("value")), F.lit(False))

    ok = fits(F.col("n_fields"))
    if joined:  # judged once, for both results; the fields are counted as they are cut
        spoilt = F.when(F.contains(F.col("value"), F.lit("\n")), ~fits(_n_fields(F.col("value"))))
        apart = F.explode(F.when(spoilt, F.split("value", "\n")).otherwise(F.array("value")))
        judged = judged.drop("n_fields", "_fields").withColumn("value", apart).filter(F.length(F.trim("value")) > 0)
        judged = judged.withColumn("_fields", _split(F.col("value"))).withColumn("n_fields", F.size("_fields"))
        judged = materialize(judged.withColumn("_ok", ok), "judged")
        return judged.filter("_ok").drop("_ok"), judged.filter("NOT _ok").drop("_ok", "_fields", "_at")
    return judged.filter(ok), judged.filter(~ok).drop("_fields", "_at")


def faults(bad: DataFrame) -> DataFrame:
    """Quarantined lines per file."""
    return bad.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_bad_lines"))


def ragged_sample(bad: DataFrame, n: int = 50) -> DataFrame:
    """First n quarantined lines in a stable order (a sample, by design)."""
    return bad.orderBy("source_file", "value").limit(n)


def read_raw_bars(spark: SparkSession, path, layouts=(RAW12, RAW13),
                  types=None) -> DataFrame:
    """S1 + U2 + S16: raw bars of every layout under ``path`` with columns
    mapped by name, typed with try_cast (bad values -> NULL), plus the
    exchange directory and snapshot day taken from the file path.  The
    vendor's download time is naive local time (``timestamp_ntz``)."""
    return parse_raw_lines(_lines(spark, path), layouts, types)


def parse_raw_lines(lines: DataFrame, layouts=(RAW12, RAW13), types=None) -> DataFrame:
    """``read_raw_bars`` on a batch frame of ``text_lines``."""
    return parse_good_lines(split_ragged_lines(lines, layouts)[0], types)


def parse_good_lines(good: DataFrame, types=None) -> DataFrame:
    """Bars of the good lines of ``split_ragged``."""
    types = types or {"date": "date", "volume": "long", "download_timestamp": "timestamp",
                      **{c: "double" for c in PRICE_COLS}}
    at = good.schema["_at"].dataType.fieldNames()

    def field(name: str) -> Column:
        if name not in at:
            return F.lit(None).cast("string")
        return F.nullif(F.trim(F.get("_fields", F.col(f"_at.{name}"))), F.lit(""))

    cols = [_typed(field(c), types.get(c, "string")).alias(c) for c in RAW_COLUMNS]
    return good.select(
        *cols,
        F.col("source_file"),
        F.regexp_extract("source_file", PATH_PARTS, 1).alias("path_exchange"),
        F.to_date(F.regexp_extract("source_file", PATH_PARTS, 2), "yyyyMMdd").alias("snapshot_date"))


def read_bars(spark: SparkSession, path: str, start=None, end=None,
              numeric=("open", "high", "low", "close", "volume", "daily_return")) -> DataFrame:
    """Processed bars from parquet (CSV copy ``{path}_csv`` when the
    parquet folder is missing); numeric columns present are cast to double.

    A date range also filters the ``year``/``month`` partition columns, so
    only the touched month folders are listed and read."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.read.option("header", True).csv(f"{path}_csv")
    df = df.withColumns({c: F.col(c).try_cast("double") for c in numeric if c in df.columns})
    ym = (F.col("year") * 100 + F.col("month")) if {"year", "month"} <= set(df.columns) else None
    if start is not None:
        s = F.lit(start).cast("date")
        df = df.filter(F.col("date").cast("date") >= s)
        if ym is not None:
            df = df.filter(ym >= F.year(s) * 100 + F.month(s))
    if end is not None:
        e = F.lit(end).cast("date")
        df = df.filter(F.col("date").cast("date") <= e)
        if ym is not None:
            df = df.filter(ym <= F.year(e) * 100 + F.month(e))
    return df


# --- landed vendor quotes (S3, P9-P11, W19) -------------------------------

def standard_names(columns) -> dict[str, str]:
    """Vendor column -> standard name.  Contains "date" -> date; exact
    open/high/low/close/volume (any case); contains "adjusted" ->
    adjusted_close; without a date column the first one containing "stamp"
    or "time" becomes the date.  The first column claiming a name wins.
    Works on the schema only (driver metadata, no data)."""
    out: dict[str, str] = {}
    taken: set[str] = set()
    exact = ("open", "high", "low", "close", "volume")
    for c in columns:
        lc = c.lower()
        target = ("date" if "date" in lc else lc if lc in exact
                  else "adjusted_close" if "adjusted" in lc else None)
        if target and target not in taken:
            out[c] = target
            taken.add(target)
    if "date" not in taken:
        for c in columns:
            lc = c.lower()
            if c not in out and ("stamp" in lc or "time" in lc):
                out[c] = "date"
                break
    return out


def read_quotes_json(spark: SparkSession, path, schema=None, multi_line: bool = False,
                     sampling_ratio: float = 1.0, file_col: str | None = None) -> DataFrame:
    """S3: landed vendor quote files, one record per line (or a JSON array
    per file with ``multi_line``), fields in any order.  Values are read as
    text (``primitivesAsString``) and typed by ``normalise_quotes``.  Pass a
    ``schema`` on large landings: inference is an extra pass over the data
    (or a sample of it with ``sampling_ratio``).  ``file_col`` names a column
    to add for the source file of each row."""
    r = spark.read.option("multiLine", multi_line).option("primitivesAsString", True)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("samplingRatio", sampling_ratio)
    df = r.json(path)
    return df if file_col is None else df.select("*", F.col("_metadata.file_path").alias(file_col))


QUOTE_COLUMNS = ("exchange", "symbol", "date", "open", "high", "low", "close", "adjusted_close",
                 "volume", "interval", "download_timestamp")


def normalise_quotes(df: DataFrame, symbol_col: str = "symbol", exchange_col: str = "exchange",
                     interval: str = "d", keep_last: int | None = 30, loaded_at=None,
                     file_col: str | None = None) -> DataFrame:
    """S3 + P9-P11 + W19 over landed quote rows of many series.

    Dates are parsed per row; a series' response with any unparseable date is
    dropped whole, found by an aggregation + anti join.  With ``file_col`` a
    response is a series within a file, without it the series.  Prices are coerced (bad -> NULL).  Only the
    newest ``keep_last`` bars of each series are kept: ``row_number <= n``
    plans a partial WindowGroupLimit before the shuffle, so each map task
    sends at most n rows per series however long the history."""
    names = standard_names([c for c in df.columns if c not in (symbol_col, exchange_col, file_col)])
    if "date" not in names.values():
        return df.sparkSession.createDataFrame([], _quote_schema())
    renamed = df.withColumnsRenamed(names)
    keys = [F.col(exchange_col).cast("string").alias("exchange"),
            F.col(symbol_col).cast("string").alias("symbol")]
    response = ["exchange", "symbol"]
    if file_col is not None:
        keys.append(F.col(file_col).alias("_file"))
        response.append("_file")
    raw_date = F.col("date").cast("string")
    parsed = F.coalesce(F.to_date(F.try_to_timestamp(raw_date)), raw_date.try_cast("date"))
    stamp = (F.localtimestamp() if loaded_at is None
             else F.lit(loaded_at).cast("timestamp_ntz"))

    def num(c: str, kind: str = "double") -> Column:
        if c not in renamed.columns:
            return F.lit(None).cast(kind)
        x = F.col(c).cast("string").try_cast("double")
        return x.try_cast("long") if kind == "long" else x

    rows = renamed.select(
        *keys, parsed.alias("date"), F.col("date").isNotNull().alias("_has_raw_date"),
        num("open").alias("open"), num("high").alias("high"), num("low").alias("low"),
        num("close").alias("close"), num("adjusted_close").alias("adjusted_close"),
        num("volume", "long").alias("volume"),
        F.lit(interval).alias("interval"), stamp.alias("download_timestamp"))
    bad = (rows.groupBy(*response)
           .agg(F.count_if(F.col("date").isNull() & F.col("_has_raw_date")).alias("_bad"))
           .filter(F.col("_bad") > 0))
    ok = rows.join(bad.select(*response), response, "left_anti")
    if keep_last is None:  # every bar
        return ok.select(*QUOTE_COLUMNS)
    w = Window.partitionBy("exchange", "symbol").orderBy(F.col("date").desc())
    return (ok.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= keep_last)
            .select(*QUOTE_COLUMNS))


def _quote_schema() -> str:
    return ("exchange string, symbol string, date date, open double, high double, low double, "
            "close double, adjusted_close double, volume bigint, interval string, "
            "download_timestamp timestamp_ntz")


# --- exchange and symbol lists (P12, P13, W20) ----------------------------

EXCHANGE_FIELDS = ("code", "name", "country", "currency", "timeZone")


def clean_exchanges(df: DataFrame) -> DataFrame:
    """The five exchange fields, missing or NULL -> '', rows without a
    code dropped."""
    cols = [F.coalesce(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string"),
                       F.lit("")).alias(c) for c in EXCHANGE_FIELDS]
    return df.select(*cols).filter(F.col("code") != "")


def clean_symbols(df: DataFrame, per_exchange: int | None = 20,
                  order_col: str = "list_pos") -> DataFrame:
    """P13 + W20: symbols with a code and a name, the first ``per_exchange``
    of each exchange in list order (``order_col``; None keeps all).  The
    row_number filter is planned with a partial WindowGroupLimit: a huge
    exchange is cut to n rows per map task before the shuffle."""
    ok = df.filter(F.coalesce(F.col("code") != "", F.lit(False))
                   & F.coalesce(F.col("name") != "", F.lit(False)))
    if per_exchange is not None:
        w = Window.partitionBy("exchange").orderBy(order_col, "code")
        ok = ok.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= per_exchange)
    opt = lambda c, t="string": (F.col(c).cast(t) if c in df.columns
                                 else F.lit(None).cast(t))
    return ok.select("code", "name", "exchange",
                     F.coalesce(opt("type"), F.lit("")).alias("type"),
                     F.coalesce(opt("currency"), F.lit("")).alias("currency"),
                     opt("open", "double").alias("open"), opt("close", "double").alias("close"),
                     opt("volume", "double").alias("volume"))


# --- lake file audit (S14, A13) -------------------------------------------

_LISTED = "path string, is_file boolean, length long, micros long"


def _list_directories(frontier: DataFrame) -> DataFrame:
    """Children of each directory (column ``path``), listed in tasks."""
    def run(batches):
        from pyarrow import fs

        for b in batches:
            for path in b.column(0).to_pylist():
                store, inner = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1)
                                                      if path.startswith("file:/") and path[6:7] != "/" else path)
                prefix = path[:len(path) - len(inner)]
                found = [f for f in store.get_file_info(fs.FileSelector(inner))
                         if not f.base_name.startswith(".") and ("=" in f.base_name or not f.base_name.startswith("_"))]
                for s in range(0, len(found), 10_000):
                    part = found[s:s + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([prefix + f.path for f in part], pa.string()),
                         pa.array([f.is_file for f in part], pa.bool_()),
                         pa.array([f.size if f.is_file else None for f in part], pa.int64()),
                         pa.array([f.mtime_ns // 1000 if f.mtime_ns else None for f in part], pa.int64())],
                        names=["path", "is_file", "length", "micros"])

    return frontier.select("path").mapInArrow(run, _LISTED)


def list_files(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """(path, length, modificationTime) of every file under ``root``: the
    directories of one level are listed by as many tasks as there are cores,
    the level is written, and its directories are the next frontier.  Nothing
    but the root's name passes through the driver.  Names that start with
    ``_`` or ``.`` are skipped, as Spark's readers do."""
    root = root if ":/" in root else f"file:{root}"
    frontier = spark.createDataFrame([(root.rstrip("/"),)], "path string")
    levels = []
    while True:
        level = materialize(_list_directories(
            frontier.repartition(tasks or spark.sparkContext.defaultParallelism)), "listing")
        levels.append(level.where("is_file"))
        frontier = level.where("not is_file")
        if frontier.isEmpty():
            break
    files = levels[0]
    for level in levels[1:]:
        files = files.unionByName(level)
    return files.select("path", "length", F.timestamp_micros("micros").alias("modificationTime"))


def _pyarrow_lists(path: str) -> bool:
    """Whether tasks can list this store; others leave it to Spark's index."""
    return ":/" not in path or path.split(":", 1)[0] in ("file", "s3", "s3a", "gs", "gcs")


def file_audit(spark: SparkSession, path: str, glob: str | None = None,
               small_bytes: int = 1 << 20, stale_before=None) -> DataFrame:
    """One row per file under ``path`` (recursive): path, name, parent
    directory, size, modification time, small/stale flags.  Directories are
    listed level by level in tasks (``list_files``); where the tasks' library
    has no client for the store, by the binaryFile source, whose index is on
    the driver."""
    if _pyarrow_lists(path):
        files = list_files(spark, path)
        if glob:
            files = files.where(F.element_at(F.split("path", "/"), -1).rlike(fnmatch.translate(glob)))
    else:
        r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        files = (r.option("pathGlobFilter", glob) if glob else r).load(path).select("path", "length", "modificationTime")
    stale = (F.lit(False) if stale_before is None
             else F.col("modificationTime") < F.lit(stale_before).cast("timestamp"))
    return files.select(
        F.col("path"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("directory"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modification_time"),
        (F.col("length") < F.lit(small_bytes)).alias("is_small"),
        stale.alias("is_stale"))


def directory_totals(audit: DataFrame, root: str) -> DataFrame:
    """For every directory under ``root``: files directly inside, their
    total bytes, distinct sub-directories, total items.  Each file's path
    below ``root`` is exploded into (directory, child) pairs, then one
    aggregation - no driver-side tree walk."""
    root = root.rstrip("/")
    marker = root.split("://")[-1]
    rel = F.substring_index(F.col("path"), marker + "/", -1)
    pairs = (audit.select("size", F.split(rel, "/").alias("_parts"))
             .select("size", "_parts", F.posexplode("_parts").alias("_pos", "_child"))
             .select("size",
                     F.when(F.col("_pos") == 0, F.lit(root))
                     .otherwise(F.concat(F.lit(root + "/"),
                                         F.array_join(F.slice("_parts", F.lit(1), F.col("_pos")), "/")))
                     .alias("directory"),
                     "_child",
                     (F.col("_pos") == F.size("_parts") - 1).alias("_is_file")))
    agg = pairs.groupBy("directory").agg(
        F.count_if("_is_file").alias("file_count"),
        F.countDistinct(F.when(~F.col("_is_file"), F.col("_child"))).alias("dir_count"),
        F.coalesce(F.sum(F.when(F.col("_is_file"), F.col("size"))), F.lit(0)).alias("total_size"))
    return agg.withColumn("total_items", F.col("file_count") + F.col("dir_count"))


# --- collection reports of several schema versions (S17) ------------------

# Report columns of the three versions and the old names
# that map onto the current ones.
REPORT_COLUMNS = ("exchange", "successful_symbols", "failed_symbols", "data_points",
                  "hdfs_upload_count", "files", "database_success", "database_failed")
REPORT_RENAMES = {"successful_symbols": "successful", "failed_symbols": "failed"}
# report time from the file name, or from the folder a Spark writer made
REPORT_TIME = r"_(\d{8}_\d{6})(?:\.csv)?/(?:[^/]*)$|_(\d{8}_\d{6})\.csv$"


def split_reports(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(good, bad) data lines of report CSVs, judged by the header row of
    their own file (a small join: one header row per report file)."""
    lines = with_fields(whole_records(_lines(spark, path))[0])
    is_head = _is_header("exchange")
    heads = (lines.filter(is_head).groupBy("source_file")
             .agg(F.min_by("_fields", "value").alias("_names")))
    j = lines.filter(~is_head).withColumnRenamed("_fields", "_vals").join(heads, "source_file", "left")
    ok = F.coalesce((F.size("_names") == F.size("_vals")) & ~_opens(F.col("value")), F.lit(False))
    return j.filter(ok), j.filter(~ok).select("source_file", "value", "n_fields")


def read_reports(spark: SparkSession, path) -> DataFrame:
    """Report CSVs of any version, columns matched by *name*.

    The fields of each good line (``split_reports``, which also returns the
    others) are zipped into a name -> value map and the current columns are
    read from it, falling back to the old names.  Columns a version lacks
    are NULL.  ``n_bad_lines`` is the number of lines of the file that do not
    fit its header (``faults`` also has files without a good line)."""
    j, bad = split_reports(spark, path)
    j = j.join(faults(bad), "source_file", "left")
    m = F.map_from_arrays(F.transform("_names", lambda c: F.trim(c)), "_vals")

    def get(name: str) -> Column:
        v = F.try_element_at(m, F.lit(name))
        if name in REPORT_RENAMES:
            v = F.coalesce(v, F.try_element_at(m, F.lit(REPORT_RENAMES[name])))
        return v

    cols = [get("exchange").alias("exchange")] + [
        get(c).try_cast("long").alias(c) for c in REPORT_COLUMNS[1:]]
    raw_time = F.concat(F.regexp_extract("source_file", REPORT_TIME, 1),
                        F.regexp_extract("source_file", REPORT_TIME, 2))
    # naive wall-clock time (parsed and read back in the same session zone)
    stamp = F.try_to_timestamp(raw_time, F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")
    return j.select(*cols, stamp.alias("report_time"), "source_file",
                    F.coalesce("n_bad_lines", F.lit(0)).alias("n_bad_lines"))
