"""Ranked lexical search against a plain ranking of all documents."""

import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import oracle
from marketlens.llm import lexical, queries
from marketlens.session import scratch_path

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranking(docs, items, k=10):
    """(item, rank, doc, score) by scoring every document for every item."""
    docs = [(d, Counter(words(t))) for d, t in docs]
    n, total = sum(bool(c) for _, c in docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for place, (d, c) in enumerate(docs):
            m = 25 + 75 * c.total() * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, place))
        for rank, (score, null, d, _) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if null else d, -score))
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=key)


def pairs(df, a):
    return [(r[a], r.text) for r in df.select(a, "text").collect()]


def test_terms():
    text = "Ab9_c-é.Ñandú\t日本 X1\x1cY\x7fz\xa0w"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == words(text)
    assert lexical.terms_of(None) == lexical.terms_of(b"") == []


def test_query_equals_the_plain_ranking_and_its_sql(spark, small):
    got = found(queries.op11_ranked_search(spark, SF))
    assert got == sorted(plain_ranking(pairs(small("documents"), "doc_id"), pairs(small("benchmark"), "item_id")), key=key)
    con = oracle.duck(SF)
    rel = con.sql(queries.ORACLE_SQL["op11_ranked_search"])
    at = [rel.columns.index(c) for c in ("item_id", "rank", "doc_id", "score")]
    assert got == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=key)


def test_many_segments_blocks_and_ties(spark, small, monkeypatch):
    """Small segments and query blocks give the same ranking; copies tie by id."""
    docs = small("documents").unionByName(small("documents").withColumn("doc_id", F.col("doc_id") + 1000))
    items = small("benchmark").limit(12)
    monkeypatch.setattr(lexical, "QUERY_BYTES", 700)
    index = lexical.build_index(docs, scratch_path(spark, "t"), segment_bytes=20_000, segment_docs=9)
    assert index.select("seg").distinct().count() > 20
    got = found(lexical.search(index, items, k=7))
    assert got == sorted(plain_ranking(pairs(docs, "doc_id"), pairs(items, "item_id"), 7), key=key)


def test_odd_rows(spark, odd_docs, no_docs):
    """Null, empty, repeated and very long texts, null ids, clashing columns."""
    docs = odd_docs.withColumns({"rank": F.lit("x"), "score": F.lit(1), "seg": F.lit(2), "term": F.lit("t")})
    items = spark.createDataFrame(
        [(1, "the QUICK word7 fox fox"), (1, "the QUICK word7 fox fox"), (2, None), (3, ""), (4, "..."),
         (None, "row id"), (5, "word3 " * 50), (6, "nowhere")], "item_id long, text string")
    got = found(lexical.rank_documents(docs, items))
    assert got == sorted(plain_ranking(pairs(docs, "doc_id"), pairs(items, "item_id")), key=key)
    assert lexical.rank_documents(no_docs, items).count() == 0
    assert lexical.rank_documents(docs, items.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 1500), st.integers(1, 12), st.integers(0, 6), st.integers(0, 2**32 - 1))
def test_top_k_is_that_of_all_sums(n_docs, k, n_lists, seed):
    rng = np.random.default_rng(seed)
    lists, scores = [], np.zeros(n_docs, np.int64)
    for _ in range(n_lists):
        held = np.flatnonzero(rng.random(n_docs) < rng.choice([0.01, 0.1, 0.6]))
        impacts, w = rng.integers(1, 5, len(held)), int(rng.integers(0, 4))
        lists.append((lexical.Postings(held, impacts, -(-n_docs // lexical.WINDOW)), w))
        scores[held] += w * impacts
    want = sorted(((-int(s), d) for d, s in enumerate(scores) if s > 0))[:k]
    for short in (0, 64, n_docs):
        assert lexical.top_k(lists, n_docs, k, short) == [(-s, d) for s, d in want]


def test_norms_beyond_64_bits():
    lengths = np.array([0, 7, 10**7], np.int64)
    assert lexical._norms(lengths, 10**13, 10**16).tolist() == [25 + 75 * int(x) * 10**13 // 10**16 for x in lengths]
