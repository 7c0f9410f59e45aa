"""Sharding by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair has a pseudo-random number u in (0, 1) from XXH64; a
record goes to the shard with the highest score -weight / ln(u).  The scores
of other shards do not change when a shard is added, so a record moves only
into the added shard (an expected share of its weight), and when one is
removed only that shard's records move.  The choice depends on the key, the
shard ids and their weights alone: no state, no shuffle.

Slots number the records of a shard from 0 without gaps.  A shard may hold a
large part of all rows, so it is cut into hash bins first: bin sizes are
summed, and a record's slot is its bin's offset plus its rank in the bin.

A null key is hashed as a key of its own; a null text counts as empty;
repeated rows get one shard and different slots; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.session import materialize

ROWS_PER_BIN = 50_000
_TWO53 = float(1 << 53)


def _score(key: Column, shard: int, weight: float) -> Column:
    h = F.xxhash64(F.coalesce(key.cast("string"), F.lit("\0null")), F.lit(shard))
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(_TWO53)
    return F.lit(-float(weight)) / F.ln(u)


def shard_of(key: Column, weights: list[float]) -> Column:
    """Shard 0..n-1 with the highest score (ties: the lowest number)."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    scored = [F.struct(_score(key, s, w).alias("score"), F.lit(-s).alias("low")) for s, w in enumerate(weights)]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["low"]).cast("int")


def with_slots(df: DataFrame, shard: str, order: list[str], slot: str = "slot",
               rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Add gapless numbers within each shard, in (hash bin, ``order``) order.
    The input is written once: it is both counted and numbered."""
    df = materialize(df, "shard-rows")
    total = df.count()
    bins = max(1, -(-total // rows_per_bin))
    binned = df.withColumn("_bin", F.pmod(F.xxhash64(*order), F.lit(bins)))
    sizes = binned.groupBy(shard, "_bin").count()
    before = Window.partitionBy(shard).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "_bin", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(shard, "_bin").orderBy(*order)
    ranked = binned.withColumn("_rank", F.row_number().over(inside))
    return (ranked.join(offsets, [shard, "_bin"])
            .withColumn(slot, F.col("_before") + F.col("_rank") - 1)
            .drop("_bin", "_before", "_rank"))


def assign(df: DataFrame, weights: list[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard): size is the text's UTF-8 bytes plus 1."""
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(
        F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), shard_of(F.col(key), weights).alias("shard"))


def write_shards(df: DataFrame, path: str, weights: list[float], key: str = "doc_id",
                 max_rows_per_file: int = 1_000_000) -> None:
    """Write the rows to one folder per shard (``shard=N``).  Rows are dealt
    by shard and a hash of the key, so that a heavy shard has many writers."""
    out = df.withColumn("shard", shard_of(F.col(key), weights))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(F.col(key)), F.lit(max(1, parts // len(weights))))
    (out.repartition("shard", spread).write.option("maxRecordsPerFile", max_rows_per_file)
     .partitionBy("shard").parquet(path))
