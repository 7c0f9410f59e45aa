"""The corpus pipeline: each stage against what it promises for its own input."""

import random
import subprocess
import sys
import tempfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlens.llm import decontam, langid, mixing, simhash
from marketlens.llm.common import share
from marketlens.session import materialize

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], SF), f"test-{name}"))
        if name != "tokens":
            assert seen[-1].columns == columns
    texts = [[(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()] for d in seen[:-1]]
    start, named, deduped, clean, mixed = texts

    assert set(named) <= set(start)
    assert all(any(c.isalpha() for c in t or "") for _, t in named)
    assert len(named) >= 0.98 * sum(any(c.isalpha() for c in t or "") for _, t in start)

    fps = {d: simhash.fingerprint(t) for d, t in named}
    up = {d: d for d in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(fps)
    a = np.array([fps[d] for d in ids], np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 3) + i + 1:
            p, q = top(ids[i]), top(ids[j])
            up[max(p, q)] = min(p, q)
    assert sorted(d for d, _ in deduped) == sorted({top(d) for d in ids})

    items = [b" ".join(decontam.words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, t in deduped if any(i in b" ".join(decontam.words(t)) for i in items)}
    assert {d for d, _ in clean} == {d for d, _ in deduped} - leaked

    assert set(mixed) <= set(clean) and max(Counter(mixed).values()) <= 2
    assert seen[-1].count() == len(mixed)


def test_run_reads_the_documents(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "n_tokens", "ids_crc32"} == set(out.columns) and out.count() > 0
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


CLASHES = ("score", "ambiguous", "lang_pred", "leaks", "times", "copy", "k", "rows", "row", "part", "rid", "size", "h", "s")


@pytest.fixture(scope="module")
def benchmark_dir(spark):
    path = tempfile.mkdtemp()
    items = [(1, "what is the airspeed velocity of an unladen swallow in level flight"), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def odd_pipeline_docs(spark):
    """Null ids and texts, empty texts, ids that repeat with other texts,
    repeated rows, a very long text, a leak, columns with clashing names."""
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("haus", "wind", "stone", "river", "lumi") for b in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    same = prose(60)
    rows = [(1, prose(80), "s1"), (1, prose(90), "s1"), (1, prose(70), None), (2, same, "s1"), (3, same, "s2"),
            (4, same + " x", "s2"), (5, same, None), (5, same, None), (None, prose(50), "s1"), (None, prose(55), "s2"),
            (None, same, "s1"), (6, None, "s1"), (7, "", None), (8, " \t ", "s2"), (9, "12345 678", "s1"),
            (10, prose(60_000), "s1"),
            (11, prose(30) + " what is the airspeed velocity of an unladen swallow in level flight " + prose(30), "s2")]
    rows += [(20 + i, prose(40 + i), f"s{i % 3}") for i in range(20)]
    df = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for i, c in enumerate(CLASHES):
        df = df.withColumn(c, F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id"), F.lit(-1)).cast("string")) if i % 2
                           else F.col("n_chars") * -1.5)
    return df.repartition(3)


def as_rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_on_odd_rows(spark, benchmark_dir):
    docs = materialize(odd_pipeline_docs(spark), "odd")
    before = as_rows(docs)
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, benchmark_dir)
        assert out.columns == docs.columns, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        by_stage[name] = as_rows(out)
        if name != "mix":
            assert by_stage[name] <= before, name     # every kept row is as it came
    text = docs.columns.index("text")
    gone = before - by_stage["language"]
    assert sorted((r[0], r[text]) for r in gone) == [(6, None), (7, ""), (8, " \t "), (9, "12345 678")]
    kept = by_stage["near_dedup"]
    fps = np.array(sorted({simhash.fingerprint(r[text]) for r in before}), np.uint64)
    assert not any(0 < np.bitwise_count(a ^ b) <= 3 for a in fps for b in fps)  # so fingerprints are the groups
    assert Counter(simhash.fingerprint(r[text]) for r in kept.elements()) == Counter(fps.tolist())
    assert sorted(r[text] for r in kept if r[0] == 1) == sorted(r[text] for r in before if r[0] == 1)
    assert [r[0] for r in kept if r[text] == next(r[text] for r in before if r[0] == 2)] == [2]
    assert sum(r[0] is None for r in kept) == 2
    assert [r[0] for r in before - by_stage["decontaminate"]] == [11]
    assert set(by_stage["mix"]) <= set(before) and max(by_stage["mix"].values()) <= 2 * max(before.values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, benchmark_dir)
    assert last.count() == docs.count()


def test_stages_on_an_empty_table(spark, no_docs, benchmark_dir):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, no_docs, benchmark_dir)
        assert out.count() == 0, name
        if name != "tokens":
            assert out.columns == no_docs.columns


def test_a_repeated_id_fills_several_bins(spark):
    rows = [(7, f"word{i} a b c", "s") for i in range(900)] + [(i, "x y", "s") for i in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = as_rows(mixing.mixed_documents(docs, rows_per_bin=20))
    taken = sum(n * len(r[1].split()) for r, n in got.items())
    assert abs(taken - 1.5 * (900 * 4 + 200)) <= 4 and max(got.values()) == 2


def test_results_of_objects_shared_by_value(spark, small):
    """What the stages broadcast loads where this package is missing."""
    model = langid.fit(small("documents"))
    code = ("import pickle, sys; sys.modules['marketlens'] = None; "
            "m = pickle.load(open(sys.argv[1], 'rb')); print(m.predict('the house and the river')[0])")
    with tempfile.NamedTemporaryFile() as f:
        f.write(share(spark, model).value)
        f.flush()
        done = subprocess.run([sys.executable, "-c", code, f.name], capture_output=True, text=True, cwd="/")
    assert done.returncode == 0 and done.stdout.strip() == model.predict("the house and the river")[0], done.stderr
