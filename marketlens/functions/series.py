"""Skew-safe ordered computations over per-key time series of raw samples.

A plain window ``partitionBy(key).orderBy(ts)`` puts every sample of a key
in one task; a key holding a third of all samples would then be sorted and
scanned by a single task.  These helpers cut each key's history into
buckets, run the ordered part inside each (key, bucket) partition, and stitch
buckets together with small per-bucket summaries (one row per key and
bucket), so no task holds more than a bucket's worth of one key.  Buckets are

* time buckets of a fixed width, or
* cuts at quantiles of the full order key (keys, ts, tie columns, row): Spark
  samples the order and deals rows by ranges of about ``target_rows``, however
  unevenly the samples lie in time.  A burst of samples at one moment is cut
  like any other stretch.

Samples of one moment come in the order of ``order``, then (``islands``)
those that fail the condition first, (``running_total``) by value; samples
equal in all of these are interchangeable.

* ``running_total`` - cumulative sum per key in time order.
* ``islands``       - maximal runs of consecutive samples where a condition
                      holds (gaps and islands), merged across buckets.
* ``last_known``    - the latest value of each of several columns at or
                      before every sample (as-of alignment).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.columns import epoch_micros
from marketlens.session import materialize_bucketed

TARGET_ROWS = 1_000_000      # rows per (key, bucket) in adaptive mode


def bucket_of(micros: Column, seconds: int) -> Column:
    """Bucket number of a timestamp: floor(epoch micros / bucket size)."""
    return F.floor(micros / F.lit(seconds * 1_000_000)).cast("long")


def with_buckets(df: DataFrame, keys, ts: str, bucket_seconds: int | None,
                 target_rows: int = TARGET_ROWS, order=()) -> DataFrame:
    """Adds ``_bucket``: fixed-width time buckets, or (``bucket_seconds``
    None) ranges of about ``target_rows`` rows of the order (keys, ts, order,
    row number).

    Ranges are written bucketed by ``_bucket``, so what is grouped by
    (keys, _bucket) afterwards reads them without another exchange, and every
    use sees the same cuts; ``islands`` and ``running_total`` deal them by
    (keys, _bucket) before their windows.  With fixed widths the result is explicitly
    hash-partitioned on (keys, _bucket): rows partitioned by the keys alone
    would satisfy a window's clustering requirement and put every bucket of a
    hot key in one task."""
    keys = list(keys)
    if bucket_seconds is not None:
        return (df.withColumn("_bucket", bucket_of(epoch_micros(df, ts), bucket_seconds))
                .repartition(*keys, "_bucket"))
    parts = max(1, -(-df.count() // target_rows))
    cut = (df.withColumn("_row", F.monotonically_increasing_id())
           .repartitionByRange(parts, *keys, ts, *order, "_row").drop("_row")
           .withColumn("_bucket", F.spark_partition_id().cast("long")))
    return materialize_bucketed(cut, "series", parts, "_bucket")


def _dealt(xb: DataFrame, kb, bucket_seconds: int | None) -> DataFrame:
    """Rows dealt by (keys, _bucket) for the ordered windows.  Ranges get a
    partition number, or adaptive execution could merge a hot key's ranges
    into one task."""
    if bucket_seconds is not None:
        return xb                                   # as with_buckets left them
    return xb.repartition(int(xb.sparkSession.conf.get("spark.sql.shuffle.partitions")), *kb)


def _previous(xb: DataFrame, keys, aggregates: dict, carried: dict) -> DataFrame:
    """One row per (key, bucket): ``carried`` expressions over the
    ``aggregates`` of the key's earlier buckets, and ``_before``, the key's
    previous bucket."""
    w = Window.partitionBy(*keys).orderBy("_bucket")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    per = xb.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"), *[e.alias(c) for c, e in aggregates.items()])
    return per.select(*keys, "_bucket", F.lag("_bucket").over(w).alias("_before"),
                      *[e.over(earlier).alias(c) for c, e in carried.items()])


def running_total(df: DataFrame, keys, ts: str, value: str, out: str,
                  bucket_seconds: int | None = None, order=(),
                  target_rows: int = TARGET_ROWS) -> DataFrame:
    """``out`` = sum of ``value`` over all earlier-or-equal samples of the key.

    Inside-bucket running sums come from a window on (key, bucket); the
    totals of earlier buckets come from a prefix sum over one row per
    (key, bucket), joined back on (key, bucket)."""
    keys, order = list(keys), [*order, value]
    kb = keys + ["_bucket"]
    xb = with_buckets(df, keys, ts, bucket_seconds, target_rows, order)
    w_in = (Window.partitionBy(*kb).orderBy(ts, *order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pre = _previous(xb, keys, {"_bt": F.sum(value)}, {"_pre": F.sum("_bt")})
    return (_dealt(xb, kb, bucket_seconds).withColumn("_in", F.sum(value).over(w_in)).join(pre, kb)
            .withColumn(out, F.coalesce("_pre", F.lit(0)) + F.col("_in"))
            .drop("_bucket", "_in", "_pre", "_before"))


def last_known(df: DataFrame, keys, ts: str, columns, bucket_seconds: int | None = None,
               target_rows: int = TARGET_ROWS, order=()) -> DataFrame:
    """For every sample and each of ``columns``: ``{c}_ts`` and ``{c}_last``,
    time and value of the key's latest non-NULL ``c`` at or before it, and
    ``next_ts``, the time of the key's next sample.  Earlier buckets
    contribute their last values, later ones their first time."""
    keys = list(keys)
    kb = keys + ["_bucket"]
    xb = with_buckets(df, keys, ts, bucket_seconds, target_rows, order)
    w = Window.partitionBy(*kb).orderBy(ts, *order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(ts).alias("ts"), F.col(c).alias("v"))) for c in columns}
    inside = xb.withColumns({**{f"_in_{c}": F.last(e, ignorenulls=True).over(upto) for c, e in known.items()},
                             "_next": F.lead(ts).over(w)})
    # the last value of a bucket: the greatest time, and of one moment the last in order
    rank = {c: F.struct(F.col(ts).alias("ts"), *[F.col(o) for o in order], F.col(c).alias("v")) for c in columns}
    pre = _previous(xb, keys, {f"_b_{c}": F.max(F.when(F.col(c).isNotNull(), e)) for c, e in rank.items()},
                    {f"_pre_{c}": F.last(f"_b_{c}", ignorenulls=True) for c in columns})
    after = Window.partitionBy(*keys).orderBy("_bucket")
    first = xb.groupBy(*kb).agg(F.min(ts).alias("_first"))
    following = first.select(*kb, F.lead("_first").over(after).alias("_after"))
    joined = inside.join(pre, kb).join(following, kb)
    out = {"next_ts": F.coalesce("_next", "_after")}
    for c in columns:
        out[f"{c}_ts"] = F.coalesce(F.col(f"_in_{c}.ts"), F.col(f"_pre_{c}.ts"))
        out[f"{c}_last"] = F.coalesce(F.col(f"_in_{c}.v"), F.col(f"_pre_{c}.v"))
    return joined.withColumns(out).select(*df.columns, *out)


def islands(df: DataFrame, keys, ts: str, cond: Column, bucket_seconds: int | None = None,
            order=(), target_rows: int = TARGET_ROWS, largest: dict | None = None) -> DataFrame:
    """Runs of consecutive samples (per key, ordered by ``ts``, ``order``,
    failing samples first) where ``cond`` is true (NULL counts as false).

    Returns keys, start_ts, end_ts, n_samples and per entry of ``largest``
    (name -> column) the largest value within the run - one row per run.

    Step 1, per (key, bucket): run number = false samples seen so far; a
    run touches the bucket start when no false sample precedes it and the
    bucket end when none follows.  Step 2, only edge-touching runs (at most
    two per bucket) are ordered per key; a run that touches its bucket's
    start continues the previous edge run when that one touches the end of
    the key's previous non-empty bucket.  Interior runs pass through."""
    keys, largest = list(keys), largest or {}
    kb = keys + ["_bucket"]
    x = with_buckets(df.select(*keys, F.col(ts).alias("_ts"), *[F.col(c) for c in order],
                               F.coalesce(cond, F.lit(False)).alias("_f"), *[e.alias(c) for c, e in largest.items()]),
                     keys, "_ts", bucket_seconds, target_rows, (*order, "_f"))
    is_false = F.when(F.col("_f"), F.lit(0)).otherwise(F.lit(1))
    w_run = (Window.partitionBy(*kb).orderBy("_ts", *order, "_f")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_all = w_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    flagged = _dealt(x, kb, bucket_seconds).withColumns({
        "_grp": F.sum(is_false).over(w_run), "_nfalse": F.sum(is_false).over(w_all)})
    most = [F.max(c).alias(c) for c in largest]
    seg = (flagged.filter(F.col("_f")).groupBy(*kb, "_grp")
           .agg(F.min("_ts").alias("start_ts"), F.max("_ts").alias("end_ts"),
                F.count(F.lit(1)).alias("n_samples"), F.max("_nfalse").alias("_nfalse"), *most)
           .withColumns({"_ts0": F.col("_grp") == 0,
                         "_ts1": F.col("_grp") == F.col("_nfalse")}))
    cols = [*keys, "start_ts", "end_ts", "n_samples", *largest]
    interior = seg.filter(~(F.col("_ts0") | F.col("_ts1"))).select(*cols)

    # left join: no inferred filter on ``seg``, so both uses of it share one
    # exchange (ReusedExchange) - the readings are scanned and shuffled once
    edge = seg.filter(F.col("_ts0") | F.col("_ts1")).join(_previous(x, keys, {}, {}), kb, "left")
    wk = Window.partitionBy(*keys).orderBy("_bucket", "_grp")
    cont = (F.col("_ts0") & F.lag("_ts1").over(wk)
            & (F.lag("_bucket").over(wk) == F.col("_before")))
    starts = F.when(F.coalesce(cont, F.lit(False)), F.lit(0)).otherwise(F.lit(1))
    chained = edge.withColumn("_chain", F.sum(starts).over(
        wk.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = (chained.groupBy(*keys, "_chain")
              .agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"),
                   F.sum("n_samples").alias("n_samples"), *most)
              .select(*cols))
    return merged.unionByName(interior)
