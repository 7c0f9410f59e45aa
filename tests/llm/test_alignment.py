"""Cross-tokenizer alignment against plain loops over whole encodings."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from marketlens.llm import alignment, queries

SF = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tok():
    return alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def plain_groups(tok, text):
    """[(A ids, B ids)] of a text encoded whole, None without tokens."""
    if not text:
        return None
    (a,), (b,) = tok.encode([text])
    if not tok.spells(a, b, text):
        return None
    ends_a, ends_b = ([sum(map(len, map(table.__getitem__, ids[:i + 1]))) for i in range(len(ids))] if len(ids) < 300
                      else _running(table, ids) for ids, table in ((a, tok.a_bytes), (b, tok.b_bytes)))
    cuts = sorted(set(ends_a) & set(ends_b))
    out, i, j = [], 0, 0
    for c in cuts:
        ga, gb = [], []
        while i < len(a) and ends_a[i] <= c:
            ga.append(a[i])
            i += 1
        while j < len(b) and ends_b[j] <= c:
            gb.append(b[j])
            j += 1
        out.append((ga, gb))
    return out


def _running(table, ids):
    at, out = 0, []
    for i in ids:
        at += len(table[i])
        out.append(at)
    return out


def plain_figures(tok, docs):
    groups = [(d, plain_groups(tok, t)) for d, t in docs]
    counts = Counter()
    for _, g in groups:
        counts.update({(a, b) for ga, gb in g or () for a in ga for b in gb})
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for d, g in groups:
        links = [(a, b) for ga, gb in g or () for a in ga for b in gb]
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g or ())
        out.append((d, sum(len(x) for x, _ in g or ()), sum(len(x) for _, x in g or ()), len(g or ()), len(links),
                    sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def figures(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_query_equals_whole_encodings(spark, small, tok):
    docs = [(r.doc_id, r.text) for r in small("documents").select("doc_id", "text").collect()]
    assert figures(queries.op13_cross_tokenizer(spark, SF)) == plain_figures(tok, docs)


def test_odd_rows_in_many_segments(spark, odd_docs, no_docs, tok):
    """Null, empty, repeated and very long texts, null ids, clashing columns,
    special tokens in texts, and texts that B does not spell."""
    more = spark.createDataFrame([
        (20, "<|endoftext|> <s> <unk> <0x41> x"), (21, "U+2581 ▁ here"), (22, " two  spaces \n and more "),
        (23, "日本語 テキスト ñandú \U0001f600"), (24, "nul \0 byte"), (25, " "), (26, "a  b　c"),
        (27, "x " * 40_000)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(more)
    clash = docs.withColumns({"seg": F.lit("x"), "pair": F.lit(1.5), "a": F.lit("b"), "kind": F.lit("segment")})
    want = plain_figures(tok, [(r.doc_id, r.text) for r in docs.collect()])
    assert figures(alignment.align_documents(clash)) == want
    assert figures(alignment.align_documents(clash, segment_chars=50)) == want
    assert alignment.align_documents(no_docs).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n ▁日'1. ", max_size=25), min_size=1, max_size=6))
def test_units_equal_whole_texts(tok, texts):
    found = alignment.align(tok, texts)
    for i, t in enumerate(texts):
        groups = plain_groups(tok, t)
        assert found["n_groups"][i] == len(groups or ())
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups or ())
        assert found["groups_sha256"][i] == (hashlib.sha256(shown.encode()).hexdigest() if groups else "")


def test_token_bytes(tok):
    assert b"".join(tok.a_bytes[i] for i in tok.encode(["né\n日"])[0][0]) == " né\n日".encode()
    assert tok.b_bytes[tok.b.piece_to_id("<0x0A>")] == b"\n"
    assert len(tok.a_bytes) == tok.a.get_vocab_size()


def test_figures_drop_what_the_alignment_kept():
    """Workers that aligned segments sum them up without their vocabularies and known words."""
    tok = alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    found = alignment.align(tok, ["some words, some more", None])
    cache = alignment.worker_cache()
    cache["alignment"] = tok
    n = len(found["a"])
    out = alignment._figures(pa.table({"seg": [0], "blob": [alignment._pack([1, 2], found)]}),
                             pa.table({"pair": np.arange(n), "n_docs": found["n_docs"], "best": np.ones(n, bool)}))
    assert out.column("n_best").to_pylist() == found["n_links"].tolist() and out.column("doc_id").to_pylist() == [1, 2]
    assert "alignment" not in cache


def test_known_words_are_kept_as_one_record():
    tok = alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    words = ["a", "naïve", "日本語", "x-ray,", "\x0bq", "ünter.\nAnd"]
    alignment._learn(tok, words)
    for word, a, b in zip(words, *tok.encode(words)):
        record = np.frombuffer(tok.known[word], "<u4").tolist()
        assert record == [len(a), *a, *b]
