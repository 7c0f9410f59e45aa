"""Ranked lexical search: hybrid TAAT-DAAT over a segmented inverted index.

``build_index`` writes an inverted index of every term of every text: tasks
cut their documents into segments of about ``SEGMENT_BYTES`` and write one row
per (segment, term) with its postings, and one row per segment with the
document table (term ``''``).  ``search`` ranks all documents for a table of
queries: per segment, the postings of a query's short lists are summed into
accumulators (term at a time); the accumulators then act as one more list,
whose bound per window of documents is known exactly, beside the long lists
in a document-at-a-time pass that skips windows which cannot reach the k-th
best score found so far.  Each segment returns its k best per query, Spark
keeps the k best of all.

Queries go in blocks of at most ``QUERY_BYTES`` of text (and at least one
query), so what is broadcast is bounded however many there are.

Score.  Terms are runs of ASCII letters, digits and non-ASCII characters,
only A-Z lower-cased.  With N documents that hold a term, L terms in all, df
documents with the term, tf occurrences and n terms in the document:
w = floor(1000 ln((2N+2)/(2df+1))), m = 25 + 75nN div L, and a document's
score is the sum of w * (10^9 tf div (1000 tf + 8m)) over the query's terms,
repeats included.

Nulls and empty texts hold no term and are never returned; a query without
terms returns no row.  Repeated documents and repeated queries are rows of
their own.  Equal scores rank by ascending document id, null ids last.  A
very long text is one segment.  An empty table returns no row.  Only the id
and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marketlens.session import materialize, scratch_path

SEGMENT_BYTES = 8 << 20
SEGMENT_DOCS = 1 << 16
QUERY_BYTES = 1 << 20
WINDOW = 256            # documents whose bounds are compared at once
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
                   for b in range(256))

_INDEX = "seg long, term binary, n_docs long, n_terms long, docs binary, freqs binary, nulls binary"
_INDEX_TYPES = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())


def terms_of(data: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text."""
    return data.translate(TERM_BYTES).split() if data else []


# --- index ------------------------------------------------------------------

class _Segment:
    def __init__(self):
        self.ids, self.lengths, self.vocabulary = [], [], {}
        self.terms, self.freqs, self.sizes, self.n_bytes = [], [], [], 0

    def add(self, doc_id, data: bytes | None) -> None:
        counts = Counter(terms_of(data))
        known = self.vocabulary
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        self.sizes.append(len(counts))
        self.terms += [known.setdefault(t, len(known)) for t in counts]
        self.freqs += counts.values()
        self.n_bytes += len(data or b"")

    def rows(self, seg: int) -> pa.RecordBatch:
        """Documents in id order (null last), terms in byte order; postings
        are steps between document numbers and frequencies (uint32)."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        names = sorted(self.vocabulary)
        place = np.empty(len(names), np.int64)
        place[[self.vocabulary[t] for t in names]] = np.arange(len(names))
        term = place[np.array(self.terms, np.int64)]
        doc = np.repeat(number, self.sizes)
        by = np.lexsort((doc, term))
        term, doc, freq = term[by], doc[by], np.array(self.freqs, "<u4")[by]
        held = np.bincount(term, minlength=len(names))
        first = np.cumsum(held) - held
        step = np.diff(doc, prepend=0)
        step[first] = doc[first]
        ids = np.array([self.ids[i] or 0 for i in order], "<i8")
        nulls = np.array([self.ids[i] is None for i in order], np.uint8)
        lengths = np.array(self.lengths, "<i8")[order]

        def column(table: bytes, values: np.ndarray) -> pa.Array:
            """The document table's cell, then one cell of postings per term."""
            ends = len(table) + 4 * np.r_[0, np.cumsum(held)]
            data = table + values.astype("<u4").tobytes()
            return pa.Array.from_buffers(pa.binary(), len(names) + 1, [
                None, pa.py_buffer(np.r_[0, ends].astype("<i4").tobytes()), pa.py_buffer(data)])

        rows = len(names) + 1
        with_terms, total = int((lengths > 0).sum()), int(lengths.sum())
        table_only = pa.array([nulls.tobytes()] + [None] * len(names), pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(rows, seg)), pa.array([b"", *names], pa.binary()),
            pa.array(np.r_[with_terms, held]), pa.array(np.r_[total, np.zeros(len(names), np.int64)]),
            column(ids.tobytes(), step), column(lengths.tobytes(), freq), table_only],
            schema=pa.schema(list(zip(("seg", "term", "n_docs", "n_terms", "docs", "freqs", "nulls"), _INDEX_TYPES))))


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """Write the index of ``docs`` to ``path`` and return it.  Every document
    is in exactly one segment; a task holds one segment at a time."""
    def run(batches):
        seg, held = TaskContext.get().partitionId() << 32, _Segment()
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                for doc_id, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    held.add(doc_id, data)
                    if held.n_bytes >= segment_bytes or len(held.ids) >= segment_docs:
                        yield held.rows(seg)
                        seg, held = seg + 1, _Segment()
        if held.ids:
            yield held.rows(seg)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    rows.mapInArrow(run, _INDEX).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


# --- search in one segment --------------------------------------------------

class Postings:
    """One term's list in a segment: documents ascending, impacts, and per
    window of documents where it starts and its largest impact."""

    def __init__(self, docs: np.ndarray, impacts: np.ndarray, windows: int):
        self.docs, self.impacts = docs, impacts
        self.at = np.searchsorted(docs, np.arange(windows + 1) * WINDOW)
        self.most = np.zeros(windows, np.int64)
        full = np.flatnonzero(np.diff(self.at))
        self.most[full] = np.maximum.reduceat(impacts, self.at[full])


def top_k(lists: list[tuple[Postings, int]], n_docs: int, k: int, short: int | None = None) -> list[tuple[int, int]]:
    """(score, document number) of the ``k`` best documents with a score
    above 0, best first, equal scores by ascending number.  ``lists`` pairs
    postings with their weight; lists of up to ``short`` documents (a
    sixteenth, at least 64) are summed first."""
    short = max(64, n_docs // 16) if short is None else short
    lists = [(p, w) for p, w in lists if w > 0 and len(p.docs)]
    sums = np.zeros(n_docs, np.int64)
    for p, w in lists:
        if len(p.docs) <= short:
            sums[p.docs] += w * p.impacts
    long = [(p, w) for p, w in lists if len(p.docs) > short]
    windows = -(-n_docs // WINDOW)
    bound = np.maximum.reduceat(sums, np.arange(windows) * WINDOW) if n_docs else sums
    for p, w in long:
        bound = bound + w * p.most
    # k documents score at least the k-th sum: less is out, as much may tie
    floor = int(np.partition(sums, n_docs - k)[n_docs - k]) - 1 if n_docs >= k else 0
    floor, best = max(floor, 0), []
    for win in range(windows):
        if bound[win] <= floor:
            continue
        start = win * WINDOW
        scores = sums[start:start + WINDOW].copy()
        here = sorted(((w * int(p.most[win]), p, w) for p, w in long if p.most[win]), key=lambda x: -x[0])
        left = sum(most for most, _, _ in here)
        for most, p, w in here:
            if int(scores.max()) + left <= floor:
                break
            a, b = p.at[win], p.at[win + 1]
            scores[p.docs[a:b] - start] += w * p.impacts[a:b]
            left -= most
        else:
            for i in np.flatnonzero(scores > floor).tolist():
                entry = (int(scores[i]), -(start + i))
                if len(best) < k:
                    heappush(best, entry)
                else:
                    heappushpop(best, entry)
                if len(best) == k:
                    floor = max(floor, best[0][0])
    return [(s, -d) for s, d in sorted(best, reverse=True)]


def _norms(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """m of each document, exact also where 75 n N leaves 64 bits."""
    if len(lengths) and 75 * int(lengths.max()) * n >= 1 << 63:
        return np.array([25 + 75 * int(x) * n // total for x in lengths], np.int64)
    return 25 + 75 * lengths.astype(np.int64) * n // max(total, 1)


def _search_segment(table: tuple, postings: dict, queries: list, n: int, total: int, k: int):
    """Rows (query, doc_id, score, place in segment) of one segment."""
    ids = np.frombuffer(table[0], "<i8")
    nulls = np.frombuffer(table[2], np.uint8)
    norms = _norms(np.frombuffer(table[1], "<i8"), n, total)
    windows = -(-len(ids) // WINDOW)
    lists = {}
    for tid, (steps, freqs) in postings.items():
        docs = np.cumsum(np.frombuffer(steps, "<u4"), dtype=np.int64)
        tf = np.frombuffer(freqs, "<u4").astype(np.int64)
        lists[tid] = Postings(docs, 1_000_000_000 * tf // (1000 * tf + 8 * norms[docs]), windows)
    for number, terms in queries:
        found = [(lists[t], w) for t, w in terms if t in lists]
        for score, d in top_k(found, len(ids), k) if found else ():
            yield number, None if nulls[d] else int(ids[d]), score, d


# --- search -----------------------------------------------------------------

def _blocks(queries: DataFrame, id_col: str, text_col: str):
    """Lists of (id, term counts) of bounded size, one after the other."""
    rows = queries.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    block, size = [], 0
    for item, data in rows.toLocalIterator():
        counts = Counter(terms_of(bytes(data) if data is not None else None))
        if block and size + len(data or b"") > QUERY_BYTES:
            yield block
            block, size = [], 0
        block.append((item, counts))
        size += len(data or b"")
    if block:
        yield block


def _search_block(spark: SparkSession, index: DataFrame, n: int, total: int, block: list, k: int) -> DataFrame:
    numbers: dict[bytes, int] = {}
    for _, counts in block:
        for t in counts:
            numbers.setdefault(t, len(numbers))
    wanted = spark.createDataFrame([(t, i) for t, i in numbers.items()], "term binary, tid int")
    # the terms of a block of queries: at most QUERY_BYTES of text
    hits = index.join(F.broadcast(wanted), "term")
    held = {r.tid: r.df for r in hits.groupBy("tid").agg(F.sum("n_docs").alias("df")).collect()}
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for t, df in held.items()}
    queries = [(q, [(numbers[t], weight[numbers[t]] * times) for t, times in counts.items() if numbers[t] in held])
               for q, (_, counts) in enumerate(block)]
    queries = [q for q in queries if q[1]]

    def run(batches):
        seg, table, postings = None, None, {}

        def best():
            if not postings:
                return
            rows = list(_search_segment(table, postings, queries, n, total, k))
            q, doc, score, place = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64()),
                 pa.array([seg] * len(q), pa.int64()), pa.array(place, pa.int64())],
                names=["q", "doc_id", "score", "seg", "place"])

        for b in batches:
            for s, tid, *cells in zip(*(c.to_pylist() for c in b.columns)):
                if s != seg:
                    yield from best()
                    seg, table, postings = s, cells, {}
                else:
                    postings[tid] = cells[:2]
        yield from best()

    tables = index.where(F.col("term") == F.lit(b"")).select("seg", F.lit(-1).alias("tid"), "docs", "freqs", "nulls")
    rows = tables.unionByName(hits.select("seg", "tid", "docs", "freqs", "nulls"))
    rows = rows.repartition("seg").sortWithinPartitions("seg", "tid")
    found = rows.mapInArrow(run, "q int, doc_id long, score long, seg long, place long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "seg", "place")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], "q int, item_id long")
    return ranked.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")


_RESULT = "item_id long, rank int, doc_id long, score long"


def search(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each query.
    One job per block of queries reads the index; the blocks' results are
    written and united."""
    spark = index.sparkSession
    n, total = index.where(F.col("term") == F.lit(b"")).agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not total:
        return spark.createDataFrame([], _RESULT)
    found = [materialize(_search_block(spark, index, n, total, block, k), "lexical")
             for block in _blocks(queries, id_col, text_col)]
    out = spark.createDataFrame([], _RESULT)
    for part in found:
        out = out.unionByName(part)
    return out


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Index ``docs`` and search them."""
    index = build_index(docs, scratch_path(docs.sparkSession, "lexical-index"))
    return search(index, queries, k)


def oracle_sql(k: int = 10) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def terms(text: str) -> str:
        cut = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
        return f"[x FOR x IN regexp_split_to_array(translate({text}, '{upper}', '{lower}'), '{cut}') IF x <> '']"

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms("coalesce(text, '')")} AS terms FROM documents),
s AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d),
items AS (SELECT row_number() OVER () AS q, item_id, {terms("coalesce(text, '')")} AS terms FROM benchmark),
wanted AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(terms) AS term FROM items) t GROUP BY q, term),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) t
         WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
            FROM (SELECT term, count(*) AS df FROM held GROUP BY term) t, s),
norms AS (SELECT r, doc_id, 25 + (75 * len(terms) * n_docs) // n_terms AS norm FROM d, s),
scored AS (SELECT wanted.q, norms.r, norms.doc_id,
                  CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * norm))) AS BIGINT) AS score
           FROM wanted JOIN weights ON wanted.term = weights.term JOIN held ON held.term = wanted.term
                JOIN norms ON norms.r = held.r
           GROUP BY wanted.q, norms.r, norms.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place
           FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, ranked.doc_id, score
FROM ranked JOIN items ON items.q = ranked.q WHERE place <= {k}"""
