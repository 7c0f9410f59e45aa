"""Removal of repeated substrings against a table of all 400-byte strings."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from marketlens.llm import queries, substrings

SF = "/root/testdata/sf0.001"


def plain(docs, length=400):
    """(doc_id, bytes, removed, spans, sha256) from every string's count."""
    docs = [(d, t.encode() if isinstance(t, str) else t or b"") for d, t in docs]
    counts = Counter(hash(b[i:i + length]) for _, b in docs for i in range(len(b) - length + 1))
    out = []
    for d, b in docs:
        spans = []
        for i in range(len(b) - length + 1):
            if counts[hash(b[i:i + length])] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        at, kept = 0, b""
        for s, e in spans:
            kept, at = kept + b[at:s], e
        kept += b[at:]
        out.append((d, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def words(rng, n):
    return " ".join(rng.choice(("de", "la", "ñandú", "house", "of", "x")) + str(rng.randrange(1000)) for _ in range(n))


def test_query_equals_the_table_of_strings(spark, small):
    docs = [(r.doc_id, r.text) for r in small("documents").select("doc_id", "text").collect()]
    assert found(queries.op12_repeated_substrings(spark, SF)) == plain(docs)


@pytest.fixture(scope="module")
def mixed_texts():
    """Copies, near copies, shared passages of many lengths, runs of one byte
    and of a period, strings at both ends, a repetition inside one text."""
    rng = random.Random(5)
    passage, other = words(rng, 400), words(rng, 90)
    docs = [words(rng, 300), passage, passage, other * 2, "a" * 2500, "ab" * 700, "b" + "a" * 399, "a" * 400, "a" * 399]
    for n in (380, 399, 400, 401, 463, 464, 465, 520, 719, 720, 1200):
        s = rng.randrange(len(passage) - n)
        docs.append(words(rng, rng.randrange(40)) + "|" + passage[s:s + n] + "|" + words(rng, rng.randrange(60)))
    for k in (37, 450, 900):  # near copies: one byte in k changed
        docs.append("".join("#" if i % k == k - 1 else c for i, c in enumerate(passage)))
    docs += [passage[:500], passage[-500:], words(rng, 5) + passage[100:600] + other[:450] + passage[50:700]]
    return [(i, t) for i, t in enumerate(docs)]


def test_planted_repeats(spark, mixed_texts):
    docs = spark.createDataFrame(mixed_texts, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(docs)
    assert found(got) == plain(mixed_texts)
    texts = dict(mixed_texts)
    for r in got.collect():
        data, at, kept = texts[r.doc_id].encode(), 0, b""
        for s in r.spans:
            kept, at = kept + data[at:s.start], s.end
        assert bytes(r.kept) == kept + data[at:]


def test_long_texts_are_cut_without_loss(spark, monkeypatch, mixed_texts):
    long = words(random.Random(9), 3000)
    docs = mixed_texts + [(100, long), (101, "head " + long[5000:14_000]), (102, "c" * 3000)]
    assert [*substrings.first_rows(0, long.encode())]
    monkeypatch.setattr(substrings, "CHUNK", 1000)
    rows = [r for i, (_, t) in enumerate(docs) for r in substrings.first_rows(i, t.encode())]
    assert local_removal(docs, rows) == plain(docs)


def local_removal(docs, rows):
    """The rounds of the operator on one machine."""
    data = [t.encode() for _, t in docs]
    done = []
    for k, width in enumerate(substrings.WIDTHS):
        left = []
        for kind, core, hull, rid, at, weight in substrings.sweep(sorted(rows)):
            (done if kind == substrings.DONE else left).append((core, hull, rid, at, weight))
        if k + 1 < len(substrings.WIDTHS):
            rows = [r for core, _, rid, at, weight in left for r in substrings.finer_rows(
                core, rid, at, weight, data[rid], width, substrings.WIDTHS[k + 1])]
    out = []
    for i, (d, _) in enumerate(docs):
        spans = substrings.union_of(substrings.covered(at) for _, _, rid, at, _ in done if rid == i)
        kept, at = b"", 0
        for s, e in spans:
            kept, at = kept + data[i][at:s], e
        kept += data[i][at:]
        out.append((d, len(data[i]), len(data[i]) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([1, 2, 40]))
def test_random_cuts(seed, letters):
    rng = random.Random(seed)
    base = "".join(chr(97 + rng.randrange(letters)) for _ in range(2500))
    docs = []
    for i in range(rng.randrange(2, 8)):
        parts = [base[s:s + rng.randrange(100, 900)] for s in (rng.randrange(2000) for _ in range(rng.randrange(1, 4)))]
        docs.append((i, rng.choice("#%&").join(parts)))
    rows = [r for i, (_, t) in enumerate(docs) for r in substrings.first_rows(i, t.encode())]
    assert local_removal(docs, rows) == plain(docs)


def test_sweeps_of_pieces_agree_with_one_sweep(spark):
    """Wherever the sorted rows are cut into tasks, the same rows are done and
    the same classes go on."""
    rng = random.Random(3)
    rows = sorted({(rng.randrange(4), rng.randrange(3), rng.randrange(40), rng.randrange(9)) for _ in range(60)})
    rows = [(*r, rng.choice((1, 1, 2))) for r in rows]
    df = spark.createDataFrame(rows, substrings._ROWS)

    def result(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        done, left = substrings.refine(df, "test")
        return (sorted(map(tuple, done.collect())),
                sorted((r.core, r.hull, r.weight) for r in left.collect()))

    try:
        want = result(1)
        assert len(want[0]) > 20 and len(want[1]) == len({r[:2] for r in want[1]})
        for parts in (3, 8, 40):
            assert result(parts) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumns({"rid": F.lit("x"), "data": F.lit(1), "part": F.lit(2.5), "at": F.lit(None)})
    assert found(substrings.remove_repeats(docs)) == plain([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert substrings.remove_repeats(no_docs).count() == 0
