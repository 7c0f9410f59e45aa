"""Benchmark decontamination by latent semantic retrieval.

1. Benchmark items are cut into passages of at most ``PASSAGE`` words.  Words
   are runs of letters and digits, ASCII-lower-cased (other punctuation
   separates); their document frequencies are counted over all documents.
2. A distributed randomised SVD of the passages' TF-IDF matrix gives every
   word a position in a latent space of ``RANK`` dimensions.  Only matrices
   of RANK x RANK reach the driver.
3. Every document is covered with windows of 16, 32, 64 words, each a quarter
   of its length after the one before; a window's latent vector is the sum of
   its words' positions.  Windows with a cosine of at least ``COSINE`` to a passage of their size class are its
   candidates.  The latent space is an approximation of fixed rank, so a word
   search stands beside it: every stretch of one and a half passage lengths
   with as many of the passage's words as step 4 asks for is a candidate too,
   whatever its cosine (a passage of fewer than ``SHORT`` words: if it stands
   there verbatim).  Both skip passages of whose rarer words too few occur
   nearby for step 4 to hold, found by an inverted index; this loses nothing.
4. A candidate is confirmed in the text around it by the longest common
   subsequence of words (at least ``LCS`` of the passage) and an answer check:
   the item's answer, if the benchmark has one, must occur in order; without
   one, at least ``ANSWER`` of the rarer half of the passage's words must
   occur (in a paraphrase the exchanged words are among the rarest).  Both
   survive inserted, dropped and exchanged words, so paraphrases are found.

The benchmark is the stated query set: it is processed in blocks of at most
``BLOCK`` passages, so what is broadcast is bounded (BLOCK x PASSAGE words,
RANK floats each), however large the benchmark.  Documents are scanned in
place, once per block for frequencies and once for the search; no text is
shuffled.

Null and empty texts have no hits; a null item text is skipped; null ids pass
through; repeated documents repeat their hits.  Without items there are no
hits.  Other columns are untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.common import fresh_names, share, shared, slices
from marketlens.session import materialize

PASSAGE = 64
SIZES = (16, 32, 64)     # window lengths; a passage uses the first that holds it
RANK, OVERSAMPLE, POWER = 64, 8, 1
COSINE, LCS, ANSWER = 0.5, 0.6, 0.4
STRETCH, SHORT = 3, 8    # the word search takes stretches of STRETCH/2 passage lengths; verbatim below SHORT words
BLOCK = 5000
_CHUNK = 512             # words of a document looked at together
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


def passages(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
             answer_col: str | None = None) -> DataFrame:
    """(pid, item_id, words, answer) per passage; items of more than PASSAGE
    words are cut into equal parts.  pid hashes item and part."""
    def run(batches):
        for b in batches:
            rows = []
            for item, text, answer in zip(*(c.to_pylist() for c in b.columns)):
                w = words(text)
                n = -(-len(w) // PASSAGE)
                for k in range(n):
                    part = w[k * len(w) // n:(k + 1) * len(w) // n]
                    rows.append((item, k, part, words(answer) if answer else None))
            item, k, part, answer = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, b.column(0).type), pa.array(k, pa.int32()), pa.array(part, pa.list_(pa.binary())),
                 pa.array(answer, pa.list_(pa.binary()))], names=["item_id", "part", "words", "answer"])

    item_type = benchmark.schema[id_col].dataType.simpleString()
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    got = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"), answer.alias("answer")).mapInArrow(
        run, f"item_id {item_type}, part int, words array<binary>, answer array<binary>")
    return got.withColumn("pid", F.xxhash64("item_id", "part", F.transform("words", F.hex)))


def document_frequencies(docs: DataFrame, text_col: str, vocabulary) -> DataFrame:
    """(word, df) over all documents for the words of a broadcast set; every
    task sends one row per word at most."""
    def run(batches):
        known, got = vocabulary.value, {}
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                for w in known.intersection(words(t)):
                    got[w] = got.get(w, 0) + 1
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.binary()), pa.array(list(got.values()), pa.int64())],
                                             names=["word", "df"])

    return docs.select(text_col).mapInArrow(run, "word binary, df long").groupBy("word").agg(F.sum("df").alias("df"))


# --- randomised SVD over (row, col, val) entries ------------------------------

def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of v v^T over the rows: one small matrix per task."""
    def run(batches):
        g = np.zeros((width, width))
        for b in batches:
            if b.num_rows:
                m = np.array(b.column(0).to_pylist())
                g += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array([g.ravel().tolist()])], names=["g"])

    out = np.zeros(width * width)
    for r in vectors.select("v").mapInArrow(run, "g array<double>").toLocalIterator():
        out += np.array(r["g"])
    return out.reshape(width, width)


def _times(vectors: DataFrame, key: str, m: np.ndarray) -> DataFrame:
    """Every vector times a small matrix."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                v = np.array(b.column(1).to_pylist()) @ m
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(v.tolist(), pa.list_(pa.float64()))], names=[key, "v"])

    return vectors.select(key, "v").mapInArrow(run, f"{key} long, v array<double>")


def _summed(rows: DataFrame, key: str) -> DataFrame:
    """Sum val * v per key, dimension by dimension with partial aggregates."""
    parts = rows.select(key, "val", F.posexplode("v").alias("i", "x"))
    sums = parts.groupBy(key, "i").agg(F.sum(F.col("val") * F.col("x")).alias("x"))
    return sums.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v"))


def _whitener(gram: np.ndarray) -> np.ndarray:
    """M with (Y M)^T (Y M) = I on the range of Y."""
    s, u = np.linalg.eigh(gram)
    ok = s > max(s.max(), 0) * 1e-10
    return u[:, ok] / np.sqrt(s[ok])


def randomised_svd(entries: DataFrame, rank: int = RANK, oversample: int = OVERSAMPLE, power: int = POWER,
                   seed: int = 11) -> DataFrame:
    """(col, v): right singular vectors of the sparse matrix (row, col, val).
    The random test matrix is generated per column from its number, so it is
    nowhere stored; products are joins and sums."""
    width = rank + oversample

    def gaussian(batches):
        for b in batches:
            v = [np.random.default_rng([seed, c & (1 << 63) - 1]).standard_normal(width).tolist() for c in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(v, pa.list_(pa.float64()))],
                                             names=["row", "val", "v"])

    y = _summed(entries.select("row", "col", "val").mapInArrow(gaussian, "row long, val double, v array<double>"), "row")
    for step in range(power + 1):
        y = materialize(y, "svd-y")
        if y.isEmpty():
            return entries.select("col", F.array().cast("array<double>").alias("v"))
        q = materialize(_times(y, "row", _whitener(_gram(y, len(y.first()["v"])))), "svd-q")
        b = materialize(_summed(entries.join(q, "row"), "col"), "svd-b")
        if step < power:
            y = _summed(entries.join(b, "col"), "row")
    s, u = np.linalg.eigh(_gram(b, len(b.first()["v"])))
    order = [i for i in np.argsort(-s)[:rank] if s[i] > max(s.max(), 0) * 1e-10]
    return _times(b, "col", u[:, order] / np.sqrt(s[order]))


# --- search -------------------------------------------------------------------

def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & at.get(y, 0)
        if u:
            v = (v + u | v - u) & full
    return len(a) - v.bit_count()


class Searcher:
    """Everything one block of passages needs inside a task."""

    def __init__(self, vocabulary: dict[bytes, int], positions: np.ndarray, idf: np.ndarray, items: list[tuple]):
        # items: (item_id, words, answer or None)
        self.vocabulary, self.items = vocabulary, items
        self.folded = (positions * idf[:, None]).astype(np.float32)
        vectors = np.array([self._fold(w) for _, w, _ in items], np.float32).reshape(len(items), -1)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        self.unit = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
        self.size = np.array([next(s for s in SIZES if len(w) <= s) for _, w, _ in items], np.int64)
        self.rare = [frozenset(sorted(set(w), key=lambda x: (-idf[vocabulary[x]], x))[:-(-len(set(w)) // 2)])
                     for _, w, _ in items]
        self.least = [next(k for k in range(len(w) + 1) if k / len(w) >= LCS) for _, w, _ in items]
        self.coded = [np.array([vocabulary[x] for x in w], np.int64) for _, w, _ in items]
        # rare words that any confirmed text has: those of the answer check, and
        # those that a subsequence of ``least`` words cannot leave out
        self.need = np.array([max(0 if answer else next(k for k in range(len(r) + 1) if k / len(r) >= ANSWER),
                                  len(r) - (len(w) - least))
                              for (_, w, answer), r, least in zip(items, self.rare, self.least)], np.int64)
        self.postings: list = [[] for _ in vocabulary]
        for row, r in enumerate(self.rare):
            for x in r:
                self.postings[vocabulary[x]].append(row)
        self.postings = [np.array(rows, np.int32) for rows in self.postings]

    def _fold(self, w):
        return self.folded[[self.vocabulary[x] for x in w]].sum(axis=0)

    def _alive(self, ids: np.ndarray) -> np.ndarray:
        """Rows of the passages with enough rare words among ``ids``; no other
        passage can be confirmed within them."""
        rows = [self.postings[i] for i in np.unique(ids[ids >= 0])]
        found = np.bincount(np.concatenate(rows) if rows else np.zeros(0, np.int32), minlength=len(self.items))
        return np.flatnonzero(found >= self.need)

    def _latent(self, part: np.ndarray, base: int, alive: np.ndarray, out: dict[int, dict[int, float]]) -> None:
        """Adds windows near a passage in latent space: item row -> {window start: cosine}"""
        e = self.folded[part]
        e[part < 0] = 0
        sums = np.zeros((len(part) + 1, e.shape[1]), np.float32)
        np.cumsum(e, axis=0, out=sums[1:])
        for size in SIZES:
            rows = alive[self.size[alive] == size]
            if not len(rows):
                continue
            starts = np.arange(0, max(1, len(part) - size + size // 4), size // 4)
            windows = sums[np.minimum(starts + size, len(part))] - sums[starts]
            norms = np.linalg.norm(windows, axis=1)
            live = np.flatnonzero(norms > 1e-6)
            cos = windows[live] @ self.unit[rows].T / norms[live, None]
            for i, j in zip(*np.nonzero(cos >= COSINE)):
                out.setdefault(int(rows[j]), {})[base + int(starts[live[i]])] = float(cos[i, j])

    def _lexical(self, row: int, part: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, int]:
        """Starts (on a word of the passage) and length of the stretches with
        at least as many words of the passage as a confirmed one has."""
        n = len(self.coded[row])
        length, least = (-(-STRETCH * n // 2), self.least[row]) if n >= SHORT else (n, n)
        flags[self.coded[row]] = True
        at = np.flatnonzero(flags[part])
        flags[self.coded[row]] = False
        inside = np.searchsorted(at, at + length) - np.arange(len(at))
        return at[inside >= least], length

    def _confirm(self, row: int, region: list, around: list) -> tuple[float, float]:
        """(LCS share or 0, answer share); the cheaper check first, both must hold."""
        _, passage, answer = self.items[row]
        if answer:
            found = lcs(answer, around) / len(answer)
            ok = found == 1
        else:
            found = len(self.rare[row].intersection(region)) / len(self.rare[row])
            ok = found >= ANSWER
        return (lcs(passage, region) / len(passage) if ok else 0.0), found

    def hits(self, text: str | None) -> list[dict]:
        """Confirmed items of one whole text, each with its best passage."""
        w = words(text)
        if not w or not self.items:
            return []
        get = self.vocabulary.get
        ids = np.array([get(x, -1) for x in w], np.int64)
        flags = np.zeros(len(self.vocabulary) + 1, bool)  # the last is that of unknown words (-1)
        near: dict = {}
        stretches: dict = {}
        for base in range(0, len(ids), _CHUNK):
            # as far as regions around windows of this part reach
            alive = self._alive(ids[max(0, base - 2 * SIZES[-1]):base + _CHUNK + 4 * SIZES[-1]])
            if not len(alive):
                continue
            self._latent(ids[base:base + _CHUNK + SIZES[-1]], base, alive, near)
            part = ids[base:base + _CHUNK + 2 * SIZES[-1]]
            for row in alive.tolist():
                starts, length = self._lexical(row, part, flags)
                if len(starts):
                    stretches.setdefault(row, (length, set()))[1].update((starts + base).tolist())
        best: dict = {}

        def keep(row, share, cosine, found):
            item = self.items[row][0]
            if item not in best or share > best[item]["lcs"]:
                best[item] = {"item_id": item, "cosine": cosine, "lcs": share, "answer": found}

        for row, at in near.items():
            size = int(self.size[row])
            starts = sorted(at)
            j = 0
            for i, start in enumerate(starts):
                # windows that overlap are looked at together, two sizes at a time
                while j + 1 < len(starts) and starts[j + 1] - start <= size:
                    j += 1
                region = w[max(0, start - size // 2):starts[j] + size + size // 2]
                share, found = self._confirm(row, region, region)
                if share >= LCS:
                    keep(row, share, max(at[s] for s in starts[i:j + 1]), found)
                    if share == 1:
                        break
        for row, (length, starts) in stretches.items():
            half = int(self.size[row]) // 2
            limit = LCS if len(self.coded[row]) >= SHORT else 1
            for start in sorted(starts):
                known = best.get(self.items[row][0])
                if known and known["lcs"] == 1:
                    break
                region = w[start:start + length]
                share, found = self._confirm(row, region, w[max(0, start - half):start + length + half])
                if share >= limit and (not known or share > known["lcs"]):
                    inner = ids[start:start + length]
                    vector = self.folded[inner[inner >= 0]].sum(axis=0)
                    norm = float(np.linalg.norm(vector))
                    keep(row, share, float(vector @ self.unit[row]) / norm if norm > 1e-6 else 0.0, found)
        return [best[k] for k in sorted(best, key=str)]


def _blocks(docs: DataFrame, benchmark: DataFrame, text_col: str, rank: int, **names):
    """Broadcast searchers, one per block of the benchmark."""
    spark = docs.sparkSession
    parts = materialize(passages(benchmark, **names), "passages")
    total, n_docs = parts.count(), docs.count()
    if not total or not n_docs:
        return []
    n = -(-total // BLOCK)
    parts = parts.withColumn("block", F.pmod("pid", F.lit(n)))
    collected, frequencies = [], []
    for k in range(n):  # a block is bounded: BLOCK passages of PASSAGE words
        block = parts.where(F.col("block") == k).select("pid", "item_id", "words", "answer").collect()
        vocabulary = spark.sparkContext.broadcast(frozenset(bytes(x) for r in block for x in r["words"]))
        frequencies.append(materialize(document_frequencies(docs, text_col, vocabulary), "frequencies"))
        collected.append(block)
    known = frequencies[0]
    for f in frequencies[1:]:
        known = known.union(f)
    known = known.distinct()
    idf = lambda df: F.log1p(F.lit(float(n_docs)) / (1 + df))
    terms = parts.select("pid", F.explode("words").alias("word")).groupBy("pid", "word").agg(F.count(F.lit(1)).alias("tf"))
    weighted = terms.join(known, "word", "left").select(
        F.col("pid").alias("row"), F.xxhash64("word").alias("col"),
        (F.col("tf") * idf(F.coalesce("df", F.lit(0)))).alias("val"))
    norms = weighted.groupBy("row").agg(F.sqrt(F.sum(F.col("val") ** 2)).alias("norm"))
    entries = materialize(weighted.join(norms, "row").select("row", "col", F.try_divide("val", F.col("norm")).alias("val")), "tfidf")
    space = materialize(randomised_svd(entries, rank), "latent")
    searchers = []
    for block, freq in zip(collected, frequencies):
        df = {bytes(r["word"]): r["df"] for r in freq.collect()}
        vocabulary = sorted({bytes(x) for r in block for x in r["words"]})
        mine = spark.createDataFrame([(i, w) for i, w in enumerate(vocabulary)], "i long, word binary")
        rows = mine.select("i", F.xxhash64("word").alias("col")).join(space, "col").select("i", "v").collect()
        positions = np.zeros((len(vocabulary), len(rows[0]["v"]) if rows else 1))
        for r in rows:
            positions[r["i"]] = r["v"]
        weights = np.log1p(n_docs / (1 + np.array([df.get(w, 0) for w in vocabulary], float)))
        items = [(r["item_id"], [bytes(x) for x in r["words"]], r["answer"] and [bytes(x) for x in r["answer"]])
                 for r in sorted(block, key=lambda r: r["pid"])]
        searchers.append(share(spark, Searcher({w: i for i, w in enumerate(vocabulary)}, positions, weights, items)))
    return searchers


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rank: int = RANK,
               out_col: str = "leaks", **names) -> DataFrame:
    """``docs`` plus ``out_col`` (replaced if present): confirmed items with
    cosine, LCS share and answer share, per whole text.  Without documents, or
    without passages, nothing is found."""
    searchers = _blocks(docs, benchmark, text_col, rank, **names)
    out = docs.drop(out_col)
    columns, at = out.columns, out.columns.index(text_col)
    item = benchmark.schema[names.get("id_col", "item_id")].dataType
    kind = f"array<struct<item_id:{item.simpleString()},cosine:double,lcs:double,answer:double>>"

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        leak = pa.list_(pa.struct([("item_id", to_arrow_type(item)), *((c, pa.float64()) for c in ("cosine", "lcs", "answer"))]))
        found = [shared(s) for s in searchers]
        for b in slices(batches):
            hits = [[h for s in found for h in s.hits(t)] for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hits, leak)], names=[*columns, out_col])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema), f"`{out_col}` {kind}"])
    return out.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a confirmed benchmark item, with all their
    columns, whatever their names."""
    (leaks,) = fresh_names(docs, "leaks")
    return find_leaks(docs, benchmark, out_col=leaks).where(F.size(leaks) == 0).select(*docs.columns)
