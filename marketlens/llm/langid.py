"""Language identification with error-correcting output codes.

Each language has a codeword of bits (all distinct two-way splits for few
languages, a seeded dense random code with well separated words for many).
Every bit has a binary classifier over hashed byte n-grams (one to four bytes
of the lower-cased text, digits and punctuation folded to a space): the
log-odds of the languages whose bit is one against the others, from n-gram
counts.  A text's margin on a bit is its summed log-odds, damped for length.

Decoding is loss-weighted: language k costs the sum over bits of
weight_b * log(1 + exp(-margin_b)) with the margin signed by its codeword;
bits that err more often on the training texts weigh less.  The cheapest
language is predicted; the score is the logistic of the cost gap to the
second, from 0.5 (tied) to 1; below ``AMBIGUOUS`` the row is flagged.

Training uses a bounded sample of labelled rows: at most about
``TRAIN_DOCS`` texts per language, chosen by a hash of the doc_id among all
labelled training rows (whole texts).  Prediction reads every whole text and
nothing but the text.

A null text, or one without a letter, is ``und`` with score 0.  Rows with a
null doc_id or lang are never trained on.  Without training rows everything
is ``und``.  Repeated rows repeat their result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.common import fresh_names, share, shared, slices

TRAIN_DOCS = 2000        # bound on the training texts per language
BUCKETS = 1 << 16        # hashed n-grams
AMBIGUOUS = 0.6
UND = "und"
_LETTER = re.compile(r"[^\W\d_]")
_STEP = 1 << 20          # bytes of text whose features are held at once
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def held_out(doc_id) -> F.Column:
    """True where crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(_FOLD) + b" ", np.uint8)


def _buckets(a: np.ndarray) -> list[np.ndarray]:
    """Bucket numbers of the 1- to 4-grams of a byte array."""
    x = a.astype(np.uint32)
    code, out = x.copy(), []
    for n in range(1, 5):
        if n > 1:
            if len(x) < n:
                break
            code = (code[:-1] << np.uint32(8)) | x[n - 1:]
        out.append(((code + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(16))
    return out


def counts(text: str) -> np.ndarray:
    """n-gram counts of one whole text, taken in steps that overlap by three."""
    total, a = np.zeros(BUCKETS, np.int64), _bytes(text)
    for s in range(0, max(1, len(a) - 3), _STEP):
        part = a[s:s + _STEP + 3]
        last = s + _STEP + 3 >= len(a)
        for n, b in enumerate(_buckets(part), 1):
            total += np.bincount(b if last else b[:_STEP], minlength=BUCKETS)
    return total


def codebook(k: int, seed: int = 7) -> np.ndarray:
    """(k, bits) of -1 and 1; every two words differ in many bits."""
    if k <= 1:
        return np.ones((k, 1), np.int8)
    if k <= 6:  # every way to split the languages in two
        bits = [[(1 if (m >> i) & 1 else -1) for i in range(k)] for m in range(1, 1 << (k - 1))]
        return np.array(bits, np.int8).T
    bits = 15 + int(np.ceil(10 * np.log2(k)))
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(20):  # keep the draw whose closest words are farthest apart
        m = np.where(rng.random((k, bits)) < 0.5, -1, 1).astype(np.int8)
        d = (bits - m.astype(np.int32) @ m.T) // 2 + bits * np.eye(k, dtype=np.int32)
        balanced = (np.abs(m.sum(axis=0)) < k).all()
        if balanced and d.min() > far:
            best, far = m, int(d.min())
    return best if best is not None else m


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray          # (k, bits)
    log_odds: np.ndarray      # (BUCKETS, bits)
    weight: np.ndarray        # (bits,)

    def margins(self, text: str) -> np.ndarray:
        a, total, n = _bytes(text), np.zeros(self.code.shape[1]), 0
        for s in range(0, max(1, len(a) - 3), _STEP // 8):
            part = a[s:s + _STEP // 8 + 3]
            last = s + _STEP // 8 + 3 >= len(a)
            for b in _buckets(part):
                b = b if last else b[:_STEP // 8]
                total += self.log_odds[b].sum(axis=0, dtype=np.float64)
                n += len(b)
        return total / (1 + n / 200)  # like 200 n-grams at most, however long the text is

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Cost of every language, for one or more rows of margins."""
        signed = margins[..., None, :] * self.code
        return (np.logaddexp(0, -signed) * self.weight).sum(axis=-1) / self.weight.sum() * len(self.weight)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        if not self.languages or not text or not _LETTER.search(text):
            return UND, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        cost = self.losses(self.margins(text))
        first, second = np.argsort(cost, kind="stable")[:2]
        score = float(1 / (1 + np.exp(-min(50.0, cost[second] - cost[first]))))
        return self.languages[first], score, score < AMBIGUOUS


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from labelled, not held-out rows.  The counts of the sample are
    summed per task and language; the driver receives one bounded vector per
    task and language, the size of the model."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                      & ~held_out(F.col("id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    languages = sorted(sizes)
    code = codebook(len(languages))
    if not languages:
        return Model([], code, np.zeros((BUCKETS, 1), np.float32), np.ones(1))
    rate = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, train_docs / sizes[k])]), F.col("lang"))
    u = F.pmod(F.xxhash64("id"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    sample = rows.where(u < rate).select("lang", "text")
    number = {k: i for i, k in enumerate(languages)}

    def count(batches):
        got: dict[str, np.ndarray] = {}
        for b in slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got[lang] = got.get(lang, 0) + counts(text)
        for lang, c in got.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(c[at])],
                                             names=["lang", "bucket", "n"])

    summed = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.zeros((len(languages), BUCKETS))
    for r in summed.toPandas().itertuples():
        table[number[r.lang], r.bucket] = r.n
    share = table / np.maximum(1, table.sum(axis=1, keepdims=True))  # every language counts alike
    log_odds = np.zeros((BUCKETS, code.shape[1]), np.float32)
    floor = 1e-6
    for b in range(code.shape[1]):
        one, zero = (share[code[:, b] == s].mean(axis=0) if (code[:, b] == s).any() else np.zeros(BUCKETS) for s in (1, -1))
        log_odds[:, b] = np.log((one + floor) / (zero + floor))
    model = Model(languages, code, log_odds, np.ones(code.shape[1]))
    if len(languages) == 1:
        return model

    def errors(batches):
        wrong, n = np.zeros(code.shape[1], np.int64), 0
        for b in slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                wrong += model.margins(text) * code[number[lang]] <= 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([wrong.tolist()])], names=["n", "wrong"])

    per_task = sample.mapInArrow(errors, "n long, wrong array<long>")
    per_bit = per_task.select("n", F.posexplode("wrong").alias("b", "w")).groupBy("b").agg(
        F.sum("w").alias("w"), F.sum("n").alias("n")).collect()  # one row per bit
    for r in per_bit:
        error = (r["w"] + 1) / (r["n"] + 2)
        model.weight[r["b"]] = np.clip(np.log((1 - error) / error), 0.05, 10)
    return model


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             names=("lang_pred", "score", "ambiguous")) -> DataFrame:
    """``df`` plus language, score and ambiguity, in columns of these
    ``names`` (such columns of ``df`` are replaced)."""
    model_bytes = share(df.sparkSession, model)  # BUCKETS x bits floats, whatever the input
    out = df.drop(*names)
    columns, at = out.columns, out.columns.index(text_col)

    def run(batches):
        m = shared(model_bytes)
        for b in slices(batches):
            got = [m.predict(t) for t in b.column(at).to_pylist()]
            lang, score, unsure = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                names=[*columns, *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema),
                        *(f"`{n}` {k}" for n, k in zip(names, ("string", "double", "boolean")))])
    return out.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """Drop the documents that language ID rejects: no letters (``und``), or
    the two cheapest languages cost the same.  All columns are kept, whatever
    their names."""
    names = fresh_names(docs, "lang_pred", "score", "ambiguous")
    found = identify(docs, model, names=names)
    return found.where((F.col(names[0]) != UND) & (F.col(names[1]) > 0.5)).select(*docs.columns)
