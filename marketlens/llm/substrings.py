"""Exact removal of repeated substrings by bucket-pointer refinement.

A byte goes when it lies in a string of ``LENGTH`` (400) bytes that also
starts anywhere else, in the same document or another; strings never cross
documents.

A suffix array orders all suffixes; only the classes of equal 400-byte
prefixes matter here, so the refinement stops at that depth and, since equal
strings choose equal anchors, it sorts anchors instead of all positions: of
the 320 q-grams (81 bytes) that lie in a 400-byte string, the one with the
least hash (the first of equal ones) is its anchor, and the strings that share
an anchor position form a range of starts before it.

Initial buckets hold the anchors with one q-gram.  Rows are sorted by
(bucket, hull): the hull is the identifier of all bytes that the row's strings
cover.  Where two rows agree in it, all their strings repeat and they are
done; a bucket with a single hull needs no more.  What stays open is refined:
a row's range of starts is cut into parts (of 64, then 8, then 1), the bytes
that all strings of a part share reach further to both sides of the q-gram
than those of the whole, and the part's bucket is identified by the bucket it
comes from and the bytes at the earlier and later offsets.  The new buckets
are sorted in the same way, until a part is one string and its hull the string
itself.  A class of equal rows goes on with one row, which stands for all, so
a passage with a million copies is refined once.

Sorting is Spark's: rows are dealt by ranges of (bucket, hull, row), so one
bucket may fill many tasks, and each task sweeps its sorted rows with a few
values in memory.  Classes at the edges of a task (two at most) are settled by
a second, small aggregation.

Texts do not cross the network: a copy of the table is written bucketed by
scan task, and the rows of every round and the final spans are shuffled to it.

A null text is empty; texts under 400 bytes lose nothing.  Repeated rows are
documents of their own (so both lose everything that fits).  Null ids stay.  A
very long text is cut into anchors in pieces of ``CHUNK`` bytes that overlap.
Other columns are not read and cannot clash.  An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marketlens.llm.common import map_rows, worker_cache
from marketlens.session import materialize, scratch_path

LENGTH = 400
WIDTHS = (320, 64, 8, 1)        # starts that share a row, round by round
CHUNK = 1 << 19
_BITS = 9                       # of a start's distance to its anchor
_LOW = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15      # odd: has an inverse modulo 2^64
DONE, OPEN, EDGE, EDGE_OPEN = range(4)

_ROWS = "core long, hull long, rid long, at long, weight int"
_SWEPT = f"kind int, {_ROWS}"


# --- anchors ----------------------------------------------------------------

def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random odd value per byte, and the powers of the base and of its inverse."""
    cache = worker_cache()
    if "substring tables" not in cache:
        n = CHUNK + LENGTH + 1
        values = np.random.default_rng(42).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        powers = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, b, np.uint64)])
                  for b in (_BASE, pow(_BASE, -1, 1 << 64))]
        cache["substring tables"] = values, *powers
    return cache["substring tables"]


def _anchors(data: np.ndarray, length: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, the first and last start that choose each, and the
    hashes of the q-grams there."""
    values, powers, inverse = _tables()
    q = length - width + 1
    sums = np.r_[np.uint64(0), np.cumsum(values[data] * powers[:len(data)])]
    grams = (sums[q:] - sums[:-q]) * inverse[:len(data) - q + 1]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    # least hash of each window of ``width`` q-grams, the first of equal ones:
    # running minima from both ends of blocks of that width
    keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    blocks = np.r_[keys, np.full(-len(keys) % width, ~np.uint64(0))].reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    starts = len(grams) - width + 1
    least = np.minimum(behind[:starts], ahead[width - 1:width - 1 + starts])
    chosen = (least & _LOW).astype(np.int64)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    last = np.r_[first[1:], starts] - 1
    return chosen[first], first, last, grams[chosen[first]].view(np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _pack(anchor: int, lo: int, hi: int) -> int:
    """An anchor and the least and greatest distance of its starts."""
    return (anchor << _BITS | lo) << _BITS | hi


def _unpack(at: int) -> tuple[int, int, int]:
    mask = (1 << _BITS) - 1
    return at >> 2 * _BITS, at >> _BITS & mask, at & mask


def covered(at: int, length: int = LENGTH) -> tuple[int, int]:
    """The bytes that the strings of a row cover."""
    anchor, lo, hi = _unpack(at)
    return anchor - hi, anchor - lo + length


def _hull(data, at: int, length: int) -> int:
    start, end = covered(at, length)
    return _signed(xxhash.xxh3_64_intdigest(data[start:end], at & (1 << 2 * _BITS) - 1))


def first_rows(rid: int, data: bytes, length: int = LENGTH, width: int = WIDTHS[0]):
    """Rows of a document's anchors: initial buckets."""
    view = memoryview(data)
    for base in range(0, len(data) - length + 1, CHUNK):
        piece = np.frombuffer(view[base:base + CHUNK + length - 1], np.uint8)
        for anchor, first, last, core in zip(*(x.tolist() for x in _anchors(piece, length, width))):
            at = _pack(base + anchor, anchor - last, anchor - first)
            yield core, _hull(view, at, length), rid, at, 1


def finer_rows(core: int, rid: int, at: int, weight: int, data, width: int, part: int, length: int = LENGTH):
    """Rows of the parts (of ``part`` starts) of a row of ``width`` starts.
    A part's bucket is that of the row and the bytes that it adds before and
    after those which identify the row's bucket."""
    anchor, lo, hi = _unpack(at)
    near = lo // width * width
    known = anchor - near, anchor - (near + width - 1) + length
    for d in range(lo // part * part, hi + 1, part):
        own = anchor - d, anchor - (d + part - 1) + length
        finer = _pack(anchor, max(lo, d), min(hi, d + part - 1))
        earlier = xxhash.xxh3_64_intdigest(data[own[0]:known[0]], core & (1 << 64) - 1)
        later = xxhash.xxh3_64_intdigest(data[known[1]:own[1]], earlier)
        yield _signed(later), _hull(data, finer, length), rid, finer, weight


# --- refinement ---------------------------------------------------------------

def sweep(rows):
    """Rows (core, hull, rid, at, weight) sorted by core and hull -> (kind,
    ...): DONE rows, whose strings repeat (rows of weight 2 were done
    before), one OPEN row per class of a bucket that holds several, and the
    first and last class as EDGE rows (EDGE_OPEN: its bucket holds several)."""
    key = first = rest = None                  # the class: rows seen, one not yet known to repeat
    weight, at_edge = 0, True
    bucket = held = None                       # the bucket, its only class so far

    def closed(edge):
        nonlocal bucket, held
        item = (*first[:4], min(weight, 2)), edge
        if first[0] != bucket:
            if held and held[1]:
                yield EDGE, *held[0]
            bucket, held = first[0], item
            return
        for row, is_edge in filter(None, (held, item)):
            yield (EDGE_OPEN if is_edge else OPEN), *row
        held = None

    for row in rows:
        if row[:2] != key:
            if key is not None:
                yield from closed(at_edge)
                at_edge = False
            key, first, rest, weight = row[:2], row, None, 0
        weight += row[4]
        if weight < 2:
            rest = row
            continue
        if rest is not None:
            yield DONE, *rest
            rest = None
        if row[4] == 1:
            yield DONE, *row
    if key is not None:
        yield from closed(True)
        if held and held[1]:
            yield EDGE, *held[0]


def refine(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(done, open) rows of one round; a class goes on as one open row."""
    order = ["core", "hull", "rid", "at"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    swept = materialize(map_rows(dealt, _SWEPT, sweep), name)
    # at most two classes per task: total weight and one row of each class,
    # and whether the bucket has another
    edges = swept.where(F.col("kind") >= EDGE)
    same, bucket = Window.partitionBy("core", "hull"), Window.partitionBy("core")
    edges = edges.withColumns({
        "total": F.sum("weight").over(same), "n": F.row_number().over(same.orderBy("rid", "at")),
        "several": F.max((F.col("kind") == EDGE_OPEN).cast("int")).over(bucket),
        "least": F.min("hull").over(bucket), "most": F.max("hull").over(bucket)})
    more = edges.where((F.col("n") == 1) & ((F.col("several") == 1) | (F.col("least") != F.col("most"))))
    found = edges.where((F.col("weight") == 1) & (F.col("total") > 1))
    cols = ["core", "hull", "rid", "at"]
    done = swept.where(F.col("kind") == DONE).select("rid", "at").unionByName(found.select("rid", "at"))
    left = swept.where(F.col("kind") == OPEN).select(*cols, "weight").unionByName(
        more.select(*cols, F.least("total", F.lit(2)).cast("int").alias("weight")))
    return done, left


# --- Spark --------------------------------------------------------------------

@contextmanager
def _joins_on_bucket(spark: SparkSession):
    """Joins on (part, rid) may use the copy's bucketing, which is on part."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _copy(docs: DataFrame, id_col: str, text_col: str, table: str) -> DataFrame:
    """A copy with row ids, bucketed by the task that wrote it: each task
    writes one file, nothing is shuffled."""
    spark = docs.sparkSession
    rows = docs.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("rid"),
                       F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.write.bucketBy(buckets, "part").option("compression", "zstd")
     .option("path", scratch_path(spark, "texts")).saveAsTable(table))
    return spark.table(table)


def _with_part(rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", F.shiftright("rid", 33).cast("int"))  # how row ids are numbered


def _finer(copy: DataFrame, left: DataFrame, width: int, part: int) -> DataFrame:
    """The next round's rows: open rows meet their text."""
    per_doc = _with_part(left.groupBy("rid").agg(F.collect_list(F.struct("core", "at", "weight")).alias("rows")))

    def run(rows):
        for rid, data, found in rows:
            view = memoryview(data)
            for r in found:
                yield from finer_rows(r["core"], rid, r["at"], r["weight"], view, width, part)

    met = copy.select("part", "rid", "data").join(per_doc.hint("shuffle_hash"), ["part", "rid"])
    return map_rows(met.select("rid", "data", "rows"), _ROWS, run)


def union_of(spans) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes, ascending."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    spans (the removed runs of bytes) and, with ``keep_text``, kept (the other
    bytes, joined)."""
    spark = docs.sparkSession
    table = f"marketlens_texts_{uuid.uuid4().hex}"
    copy = _copy(docs, id_col, text_col, table)
    long_enough = copy.where(F.octet_length("data") >= LENGTH).select("rid", "data")

    def first(rows):
        for rid, data in rows:
            yield from first_rows(rid, data)

    rows = materialize(map_rows(long_enough, _ROWS, first), "anchors")
    done = []
    with _joins_on_bucket(spark):
        for width, part in zip(WIDTHS, WIDTHS[1:]):
            found, left = refine(rows, f"refined-{width}")
            done.append(found)
            rows = materialize(_finer(copy, left, width, part), f"rows-{part}")
        done.append(refine(rows, "refined-1")[0])
        spans = done[0]
        for d in done[1:]:
            spans = spans.unionByName(d)
        per_doc = _with_part(spans.groupBy("rid").agg(F.collect_list("at").alias("ats")))
        met = copy.join(per_doc.hint("shuffle_hash"), ["part", "rid"], "left").select("doc_id", "data", "ats")
        out = materialize(_removed(met, keep_text), "kept")
    spark.sql(f"DROP TABLE {table}")
    return out


def _removed(met: DataFrame, keep_text: bool) -> DataFrame:
    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 256):
                rows = []
                for doc_id, data, ats in zip(*(c.to_pylist() for c in b.slice(s, 256).columns)):
                    spans = union_of(map(covered, ats or ()))
                    at, pieces, view = 0, [], memoryview(data)
                    for start, end in spans:
                        pieces.append(view[at:start])
                        at = end
                    kept = b"".join([*pieces, view[at:]])
                    rows.append({"doc_id": doc_id, "n_bytes": len(data), "n_removed": len(data) - len(kept),
                                 "n_spans": len(spans), "kept_sha256": hashlib.sha256(kept).hexdigest(),
                                 "spans": [{"start": x, "end": y} for x, y in spans], "kept": kept})
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in schema.names} for r in rows], schema)

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(span)),
                        *([("kept", pa.binary())] if keep_text else [])])
    return met.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                               "spans array<struct<start: long, end: long>>" + (", kept binary" if keep_text else ""))
