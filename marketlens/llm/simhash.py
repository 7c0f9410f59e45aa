"""SimHash near-dedup: pigeonhole blocks over 64-bit fingerprints.

Fingerprint: ASCII letters are lower-cased, words are runs of characters
other than space and tab..carriage return, shingles are ``k`` consecutive
words joined by one space (a shorter text is one shingle, a text without
words has fingerprint zero), each hashed with XXH64 (seed 42); a bit is set
if it is set in more than half of the hashes, repeats counted.

Links: two fingerprints at most ``max_bits`` apart.  The 64 bits are cut into
``max_bits + 3`` blocks; such a pair agrees on at least three of them, so it
shares one of the C(max_bits + 3, 3) keys "these blocks' bits".  Keys are
joined on distinct fingerprints only.  A bucket with more than ``cap``
members is split by the same argument on its remaining bits: eight-bit-wide
regions are cut into four-bit sub-blocks, all but ``max_bits`` of which must
agree, leaving at most 4 * max_bits free bits, so that no final bucket can
exceed 2 ** (4 * max_bits) members (4,096 at three bits).  Inside a bucket a
breadth-first search verifies distances and emits only a spanning forest.

Nulls: a null text has no words (fingerprint zero); a null doc_id takes part
in the links but never names a component unless all its members are null.
Repeated rows share fingerprint and component.  An empty table gives an
empty result.  Columns other than the two named are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.common import numbered, slices, with_roots
from marketlens.session import materialize

SEED = 42
_UPPER = bytes(range(65, 91))
_LOWER_TABLE = bytes.maketrans(_UPPER, _UPPER.lower())
_STEP = 1 << 15  # shingles hashed before their bits are added up


def fingerprint(text: str | None, k: int = 3) -> int:
    """Unsigned 64-bit SimHash of one text."""
    # bytes.split() cuts at exactly 0x20 and 0x09-0x0D
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER_TABLE).split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for s in range(0, n, _STEP):
        h = np.array([digest(join(words[i:i + k]), SEED) for i in range(s, min(n, s + _STEP))], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3) -> DataFrame:
    """(id, fp long) per row; ``fp`` is the fingerprint as a signed long."""
    def run(batches):
        for b in slices(batches):
            fp = np.array([fingerprint(t, k) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["id", "fp"])

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _key_masks(max_bits: int) -> list[tuple[int, list[int]]]:
    """Per choice of three agreeing blocks: its mask, and the refined masks
    that also hold all but ``max_bits`` four-bit sub-blocks of the rest."""
    n = max_bits + 3
    edges = [64 * i // n for i in range(n + 1)]
    out = []
    for chosen in combinations(range(n), 3):
        bits = [p for b in chosen for p in range(edges[b], edges[b + 1])]
        rest = [p for p in range(64) if p not in set(bits)]
        subs = [rest[i:i + 4] for i in range(0, len(rest), 4)]
        mask = sum(1 << p for p in bits)
        finer = [mask | sum(1 << p for s in held for p in s)
                 for held in combinations(subs, len(subs) - max_bits)]
        out.append((mask, finer))
    return out


def _keys(fps: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """(fp, mask number, masked bits): one row per fingerprint and mask."""
    pairs = F.array(*[F.struct(F.lit(n).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                      for n, m in masks])
    return fps.select("fp", F.explode(pairs).alias("k")).select("fp", "k.m", "k.key")


def _forest(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among the fingerprints of one bucket."""
    left, edges = fp, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                edges += [(x, y) for y in found]
                queue.extend(found)
    return edges


def _links_in_buckets(rows: DataFrame, max_bits: int) -> DataFrame:
    """(m, key, fp) rows -> forest links.  Rows are dealt and sorted by
    bucket; a task walks bucket after bucket, holding one at a time."""
    def run(batches):
        held, last = [], None

        def emit(edges):
            e = np.array(edges, np.uint64).view(np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["a", "b"])

        out: list[tuple[int, int]] = []
        for b in batches:
            m, key, fp = (b.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((np.diff(m) != 0) | (np.diff(key) != 0)) + 1
            for part in np.split(np.arange(len(m)), cuts):
                if not len(part):
                    continue
                at = (m[part[0]], key[part[0]])
                if at != last:
                    if held:
                        out += _forest(np.concatenate(held), max_bits)
                    held, last = [], at
                held.append(fp[part].view(np.uint64))
            if len(out) > 50_000:
                yield emit(out)
                out = []
        if held:
            out += _forest(np.concatenate(held), max_bits)
        if out:
            yield emit(out)

    dealt = rows.select("m", "key", "fp").repartition("m", "key").sortWithinPartitions("m", "key")
    return dealt.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, max_bits: int = 3, cap: int = 4096) -> DataFrame:
    """Forest links (a, b) whose components are those of all fingerprint pairs
    at most ``max_bits`` apart.  ``fps``: distinct ``fp``."""
    masks = _key_masks(max_bits)
    keys = _keys(fps, [(n, m) for n, (m, _) in enumerate(masks)])
    sizes = materialize(keys.groupBy("m", "key").count().where("count > 1"), "simhash-buckets")
    found = _links_in_buckets(keys.join(sizes.where(F.col("count") <= cap), ["m", "key"]), max_bits)
    if sizes.where(F.col("count") > cap).isEmpty():
        return found
    big = keys.join(sizes.where(F.col("count") > cap), ["m", "key"])
    finer = F.create_map(*[x for n, (_, fine) in enumerate(masks)
                           for x in (F.lit(n), F.array(*[F.lit(_signed(f)) for f in fine]))])
    fine = big.select("fp", F.col("m").alias("coarse"), F.posexplode(F.element_at(finer, F.col("m"))).alias("i", "mask"))
    fine = fine.select("fp", (F.col("coarse") * 100_000 + F.col("i")).alias("m"),
                       F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sizes = materialize(fine.groupBy("m", "key").count().where("count > 1"), "simhash-fine")
    return found.union(_links_in_buckets(fine.join(sizes, ["m", "key"]), max_bits))


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
               max_bits: int = 3, cap: int = 4096) -> DataFrame:
    """(id, fp, component_id) per row: the smallest id reachable by links."""
    fp = materialize(fingerprints(df, id_col, text_col, k), "simhash-fp")
    classes = materialize(fp.groupBy("fp").agg(F.min("id").alias("first")), "simhash-classes")
    rooted = with_roots(classes, "fp", links(classes.select("fp"), max_bits, cap))
    rooted = materialize(rooted, "simhash-roots")
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(names, "root").select("fp", "component_id"), "simhash-named")
    return fp.join(named, "fp")


def hex_fp(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_dedup(docs: DataFrame, k: int = 3, max_bits: int = 3) -> DataFrame:
    """One document of each group stays: a row with the smallest doc_id (null
    last).  Rows are told apart by their place, not by doc_id: rows that
    repeat a doc_id with other texts are documents of their own.  All columns
    are kept, whatever their names; texts are not shuffled."""
    rows = numbered(docs, "near-dedup")
    fp = materialize(fingerprints(rows.select(F.col("doc_id"), F.col("text")), "row", "text", k), "simhash-fp")
    named = fp.withColumnRenamed("id", "row").join(rows.select(F.col("doc_id").alias("doc")), "row")
    first = F.min(F.struct(F.col("doc").isNull().alias("null"), "doc", "row")).alias("first")
    classes = materialize(named.groupBy("fp").agg(first), "simhash-classes")
    rooted = with_roots(classes, "fp", links(classes.select("fp"), max_bits))
    keep = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    return rows.join(keep).select(*docs.columns)
