"""Helpers shared by the operators: Arrow batches, written intermediate
tables and connected components."""

from __future__ import annotations

import ctypes
import pickle
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marketlens.session import materialize, materialize_bucketed


def map_rows(df: DataFrame, schema: str | T.StructType,
             fn: Callable[[Iterator[tuple]], Iterable[tuple]],
             flush_rows: int = 4096) -> DataFrame:
    """Run ``fn`` (iterator of row tuples -> iterable of row tuples) over each
    partition through Arrow.  Input batches are walked row by row and output
    is flushed every ``flush_rows`` rows, so a task holds one batch at a time."""
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(out)

    def run(batches):
        def rows():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns)) if b.num_rows else ()

        buf: list[tuple] = []

        def flush():
            cols = list(zip(*buf))
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=f.type) for c, f in zip(cols, arrow)], schema=arrow)

        for r in fn(rows()):
            buf.append(r)
            if len(buf) >= flush_rows:
                yield flush()
                buf.clear()
        if buf:
            yield flush()

    return df.mapInArrow(run, out)


def worker_cache() -> dict:
    """A dictionary of this Python worker process that outlives its tasks.
    (Shipped functions get fresh module globals with every task.)"""
    name = "marketlens_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def share(spark: SparkSession, value):
    """Broadcast a (bounded) object of this package by value: the executors
    need no copy of the repository.  Tasks get it with ``shared``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(broadcast):
    return pickle.loads(broadcast.value)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, made of ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name)
    return out


@dataclass
class Rows:
    """A written copy of a table whose rows have numbers.

    Each task writes one file, bucketed by the task's number, so decisions on
    rows (small tables with a row number) join the copy without moving its
    texts, whatever the sizes: only the decisions are shuffled."""

    table: DataFrame
    part: str
    row: str
    columns: list[str]

    def select(self, *columns) -> DataFrame:
        """Columns of the rows, with their number."""
        return self.table.select(F.col(self.row).alias("row"), *columns)

    def join(self, decided: DataFrame, how: str = "inner") -> DataFrame:
        """The table's columns with those of ``decided`` (by its column ``row``)."""
        # row numbers are made of the task's number and a count
        decided = decided.withColumnRenamed("row", self.row).withColumn(
            self.part, F.shiftright(self.row, 33).cast("int"))
        return self.table.join(decided.hint("shuffle_hash"), [self.part, self.row], how).drop(self.part, self.row)


def numbered(df: DataFrame, name: str) -> Rows:
    part, row = fresh_names(df, "part", "row")
    copy = df.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()})
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # joins on (part, row) may use the bucketing, which is on part alone; the
    # setting only chooses between plans, so it stays for the lazy result
    df.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return Rows(materialize_bucketed(copy, name, buckets, part), part, row, df.columns)


def free_memory() -> None:
    """Give memory that this process freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def slices(batches, rows: int = 512):
    """Pieces of Arrow batches, so that few texts are Python objects at once.
    Workers live on from stage to stage: what another operator keeps in this
    one is dropped first, and freed memory goes back to the system at the end."""
    worker_cache().clear()
    for b in batches:
        for s in range(0, b.num_rows, rows):
            yield b.slice(s, rows)
    free_memory()


def checksum(df: DataFrame) -> tuple:
    """Row count and an order-free hash sum: equal for equal tables."""
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame) -> DataFrame:
    """(a long, b long) links -> (node, root): the smallest node each linked
    node can reach.  Nodes without links do not appear.

    Alternating large-star/small-star rounds.  Minima per node are partial
    aggregates, so a hub costs one row per task; each round's tables are
    written and read back, which cuts lineage and lets both inputs of the
    joins be shuffled (and a hub's partition be split) by the planner."""
    e = (edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
         .where("a < b").distinct())
    e = materialize(e, "cc-edges")
    state = checksum(e)
    while state[0]:
        sym = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = materialize(sym.groupBy("u").agg(F.min("v").alias("m"))
                          .select("u", F.least("u", "m").alias("m")), "cc-low")
        large = sym.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = materialize(large.distinct(), "cc-large")
        low = materialize(large.groupBy("b").agg(F.min("a").alias("m")), "cc-low")
        small = (large.join(low, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .union(low.select(F.col("m").alias("a"), "b")))
        e = materialize(small.distinct(), "cc-edges")
        now = checksum(e)
        if now == state:
            break
        state = now
    return e.select(F.col("b").alias("node"), F.col("a").alias("root"))


def with_roots(nodes: DataFrame, key: str, links: DataFrame) -> DataFrame:
    """``nodes`` plus ``root``: the component of ``key`` (itself if unlinked)."""
    cc = connected_components(links)
    return (nodes.join(cc.withColumnRenamed("node", key), key, "left")
            .withColumn("root", F.coalesce("root", key)))
