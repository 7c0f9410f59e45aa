"""Embedding near-dedup: cover trees and dual traversal.

Vectors are compared within equal labels by cosine; on unit vectors
cos >= c is euclidean distance <= sqrt(2 - 2c), a metric, so cover trees
apply.  Equal vectors of a label form one class first, so copies cost one
row each and no pairs.

1. Top levels.  A label's classes are split into cells by nested centres
   with halving radii: a cell's centres are a greedy net over a bounded
   sample of its members (``SAMPLE``), every member goes to its nearest
   centre, and cells above ``LEAF`` members are split again at half the
   radius.  What a sample misses makes a cell's true covering radius larger,
   and it is the true radius that is used, so nothing is lost.  A cell that
   is much smaller than the threshold is cut by a hash.
2. Pairs of cells.  Two leaves of a label can hold a link only if their
   centres are within both covering radii plus the threshold; the others are
   pruned.
3. Inside a pair, both leaves get a local cover tree (radii halving from the
   covering radius) and the trees are walked together: a pair of nodes whose
   distance exceeds both radii plus the threshold is pruned, the others are
   opened down to small blocks, which are compared exactly in double
   precision by the cosine itself.

A pair of leaves returns its link counts per class and a spanning forest of
its links, never the pairs.  A class's links are summed, its copies added,
and components are built from the forests.

Vectors that are null, empty, zero or hold null or non-finite components, and
vectors with a null label, link with nothing: they keep a component of their
own.  Vectors of different lengths never link.  A null id never names a
component and is not kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.common import with_roots
from marketlens.session import materialize

LEAF = 4096          # members of a leaf cell
SAMPLE = 256         # members of a cell that centres are chosen from
CENTRES = 64         # children of a cell
_BLOCK = 128          # nodes up to this size are compared directly
_SLACK = 1e-7        # covers rounding in the pruning bounds; checks are exact


def _clean(v) -> np.ndarray | None:
    if v is None or not len(v) or any(x is None for x in v):
        return None
    a = np.array(v, np.float64)
    if not np.isfinite(a).all() or not a.any():
        return None
    return a


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow in the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def classify(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, grp, cls, vec): grp is the label and length, cls a 128-bit hash of
    label and components, both null for vectors that link with nothing."""
    def run(batches):
        for b in batches:
            out = []
            for v, label in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                a = None if label is None else _clean(v)
                if a is None:
                    out.append((None, None, None))
                else:
                    raw = (a + 0.0).astype("<f8").tobytes()  # -0 counts as 0
                    grp = f"{label}/{len(a)}"
                    out.append((grp, hashlib.blake2b(grp.encode() + b"\0" + raw, digest_size=16).hexdigest(), raw))
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary())],
                names=["id", "grp", "cls", "vec"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"),
                     F.col(label_col).cast("string").alias("l"))
    return rows.mapInArrow(run, "id long, grp string, cls string, vec binary")


def _matrix(blobs) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1).copy())


def _net(x: np.ndarray, radius: float, most: int) -> np.ndarray:
    """Indices of a greedy net: each next centre is the farthest member,
    until all are within ``radius`` or there are ``most`` centres."""
    chosen = [0]
    far = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < most and far.max() > radius:
        i = int(far.argmax())
        chosen.append(i)
        far = np.minimum(far, np.linalg.norm(x - x[i], axis=1))
    return np.array(chosen)


def _split(classes: DataFrame, leaf: int, reach: float) -> DataFrame:
    """Top levels: the class rows with their leaf cell."""
    todo, done, level = classes.withColumn("cell", F.col("grp")), [], 0
    columns = [*classes.columns, "cell"]
    while True:
        sizes = materialize(todo.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "cells")
        small = todo.join(sizes.where(F.col("n") <= leaf), "cell")
        done.append(materialize(small.select(*columns), "cell-rows"))
        if sizes.where(F.col("n") > leaf).isEmpty():
            break
        big = todo.join(sizes.where(F.col("n") > leaf), "cell")
        # bounded sample per cell -> centres (one row per cell)
        u = F.pmod(F.xxhash64("no", F.lit(level)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = big.where(u < F.lit(float(SAMPLE)) / F.col("n")).select("cell", "n", "vec")

        def choose(pdf):
            blobs = sorted(pdf["vec"].map(bytes))
            x = _matrix(blobs)
            radius = float(np.linalg.norm(x - x[0], axis=1).max()) / 2
            most = min(CENTRES, 2 * -(-int(pdf["n"].iloc[0]) // leaf))
            at = _net(x, radius, most) if radius > reach / 16 else []
            return pdf.iloc[:1][["cell"]].assign(centres=[[blobs[i] for i in at]])

        nets = materialize(sample.groupBy("cell").applyInPandas(choose, "cell string, centres array<binary>"), "nets")

        def deal(batches):
            for b in batches:
                cells, n, nos, vecs = (b.column(i).to_pylist() for i in range(4))
                out, nets = [], {}
                for i, cell in enumerate(cells):
                    if cell not in nets:
                        known = b.column(4)[i].as_py()
                        nets[cell] = _matrix(known) if known and len(known) > 1 else None
                    if nets[cell] is None:  # too dense (or no sample): cut by a hash
                        out.append(f"{cell}.h{hash((nos[i], level)) % (2 * -(-n[i] // leaf))}")
                    else:
                        out.append(f"{cell}.{int((nets[cell] @ _matrix([vecs[i]])[0]).argmax())}")
                yield pa.RecordBatch.from_arrays([*b.columns[5:], b.column(2), b.column(3), pa.array(out, pa.string())],
                                                 names=[*rest, "no", "vec", "cell"])

        rest = [c for c in classes.columns if c not in ("no", "vec")]
        schema = ", ".join([*(f"{c} {classes.schema[c].dataType.simpleString()}" for c in rest),
                            "no long, vec binary, cell string"])
        dealt = big.join(nets, "cell", "left").select("cell", "n", "no", "vec", "centres", *rest)
        todo = materialize(dealt.mapInArrow(deal, schema).select(*columns), "cells-dealt")
        level += 1
    rows = done[0]
    for d in done[1:]:
        rows = rows.union(d)
    return rows


def _blocks(rows: DataFrame) -> DataFrame:
    """One row per leaf: grp, cell, its class numbers, copies and vectors (at
    most ``LEAF``), centre (the mean direction) and covering radius."""
    def pack(pdf):
        pdf = pdf.sort_values("no")
        blobs = [bytes(v) for v in pdf["vec"]]
        x = _matrix(blobs)
        centre = x.mean(axis=0)
        far = float(np.linalg.norm(x - centre, axis=1).max())
        return pdf.iloc[:1][["grp", "cell"]].assign(
            nos=[pdf["no"].to_numpy()], copies=[pdf["copies"].to_numpy()], vecs=[b"".join(blobs)],
            centre=[centre.astype("<f8").tobytes()], radius=far)

    return rows.groupBy("cell").applyInPandas(
        pack, "grp string, cell string, nos array<long>, copies array<long>, vecs binary, centre binary, radius double")


class Tree:
    """Cover tree over the rows of ``x``: levels of centres with halving
    radii; a node keeps its members, centre and true covering radius."""

    __slots__ = ("rows", "centre", "radius", "children")

    def __init__(self, x: np.ndarray, rows: np.ndarray, centre: np.ndarray, scale: float):
        self.rows, self.centre = rows, centre
        d = np.linalg.norm(x[rows] - centre, axis=1)
        self.radius = float(d.max())
        self.children: list[Tree] = []
        if len(rows) > _BLOCK and self.radius > 0:
            scale = min(scale, self.radius) / 2
            own = x[rows]
            net = _net(own, scale, 32)
            near = (own @ own[net].T).argmax(axis=1)
            parts = [rows[near == j] for j in range(len(net))]
            if max(map(len, parts)) < len(rows):
                self.children = [Tree(x, p, own[net[j]], scale) for j, p in enumerate(parts) if len(p)]


def _pairs(a: Tree, b: Tree, reach: float):
    """Row blocks of both trees that may hold pairs within ``reach``."""
    stack = [(a, b)]
    while stack:
        p, q = stack.pop()
        if np.linalg.norm(p.centre - q.centre) > p.radius + q.radius + reach + _SLACK:
            continue
        if not p.children and not q.children:
            yield p.rows, q.rows
        elif p is q:  # both children of one pair, each pair once
            stack += [(p.children[i], p.children[j]) for i in range(len(p.children)) for j in range(i, len(p.children))]
        elif p.children and (not q.children or p.radius >= q.radius):
            stack += [(c, q) for c in p.children]
        else:
            stack += [(p, c) for c in q.children]


def dual_join(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with cosine >= threshold; ``y is x``: pairs i < j."""
    same, reach = y is x, float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    tx = Tree(x, np.arange(len(x)), x.mean(axis=0), 2.0)
    ty = tx if same else Tree(y, np.arange(len(y)), y.mean(axis=0), 2.0)
    left, right = [], []
    for r, s in _pairs(tx, ty, reach):
        i, j = np.nonzero(x[r] @ y[s].T >= cosine)
        i, j = r[i], s[j]
        if same:
            if r is s:
                i, j = i[i < j], j[i < j]
            else:
                i, j = np.minimum(i, j), np.maximum(i, j)
        left.append(i)
        right.append(j)
    if not left:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate(left), np.concatenate(right)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links a[k]-b[k]."""
    up: dict[int, int] = {}

    def top(v):
        while up.setdefault(v, v) != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    out = []
    for p, q in zip(a.tolist(), b.tolist()):
        r, s = top(p), top(q)
        if r != s:
            up[max(r, s)] = min(r, s)
            out.append((p, q))
    return out


def _links(blocks: DataFrame, cosine: float) -> DataFrame:
    """(a, b, n): forest links a-b, and rows (a, null, n) that add n links of
    class a, the copies of its partners counted."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    index = blocks.select("grp", "cell", "centre", "radius")

    def near(batches):
        for t in batches:
            gap = np.array([np.linalg.norm(np.frombuffer(u, "<f8") - np.frombuffer(v, "<f8"))
                            for u, v in zip(t.column(2).to_pylist(), t.column(3).to_pylist())])
            ok = pa.array(gap <= t.column(4).to_numpy() + t.column(5).to_numpy() + reach + _SLACK)
            yield pa.RecordBatch.from_arrays([t.column(0).filter(ok), t.column(1).filter(ok)], names=["p", "q"])

    # pairs of leaves of one group, each once: their number is that of the leaves, not of the vectors
    a = index.select("grp", F.col("cell").alias("p"), F.col("centre").alias("pc"), F.col("radius").alias("pr"))
    b = index.select("grp", F.col("cell").alias("q"), F.col("centre").alias("qc"), F.col("radius").alias("qr"))
    cells = a.join(b, "grp").where("p <= q").select("p", "q", "pc", "qc", "pr", "qr")
    pairs = materialize(cells.mapInArrow(near, "p string, q string"), "leaf-pairs")
    side = lambda c: blocks.select(*(F.col(x).alias(c + x) for x in ("cell", "nos", "copies", "vecs")))
    tasks = (pairs.withColumnRenamed("p", "pcell").withColumnRenamed("q", "qcell")
             .join(side("p"), "pcell").join(side("q"), "qcell")
             .select("pcell", "pnos", "pcopies", "pvecs", "qcell", "qnos", "qcopies", "qvecs"))

    def run(batches):
        for t in batches:
            for i in range(t.num_rows):
                p, pno, pcopies, pvecs, q, qno, qcopies, qvecs = (c[i].as_py() for c in t.columns)
                pno, pcopies = np.array(pno), np.array(pcopies)
                x = _unit(np.frombuffer(pvecs, "<f8").reshape(len(pno), -1))
                qno, qcopies, y = (pno, pcopies, x) if p == q else (
                    np.array(qno), np.array(qcopies), _unit(np.frombuffer(qvecs, "<f8").reshape(len(qno), -1)))
                u, v = dual_join(x, y, cosine)
                if not len(u):
                    continue
                forest = _forest(pno[u], qno[v])
                of_p = np.bincount(u, qcopies[v], len(pno)).astype(np.int64)
                of_q = np.bincount(v, pcopies[u], len(qno)).astype(np.int64)
                a = np.concatenate([pno[of_p > 0], qno[of_q > 0]])
                n = np.concatenate([of_p[of_p > 0], of_q[of_q > 0]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*a.tolist(), *(f[0] for f in forest)], pa.int64()),
                     pa.array([*[None] * len(a), *(f[1] for f in forest)], pa.int64()),
                     pa.array([*n.tolist(), *[0] * len(forest)], pa.int64())], names=["a", "b", "n"])

    return tasks.mapInArrow(run, "a long, b long, n long")


def near_duplicates(df: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", leaf: int = LEAF) -> DataFrame:
    """(id, n_links, component_id, kept) per row."""
    rows = materialize(classify(df, id_col, vec_col, label_col), "vectors")
    linked = rows.where("cls is not null")
    # one row per class: its number (60 bits of the hash), copies, smallest id
    classes = linked.groupBy("grp", "cls").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"), F.min("vec").alias("vec"))
    number = F.conv(F.substring("cls", 1, 15), 16, 10).cast("long")
    classes = materialize(classes.withColumn("no", number), "vector-classes")
    cells = _split(classes.select("grp", "copies", "no", "vec"), leaf, float(np.sqrt(max(0.0, 2 - 2 * cosine))))
    blocks = materialize(_blocks(cells), "leaves")
    found = materialize(_links(blocks, cosine), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("no")).agg(F.sum("n").alias("others"))
    roots = materialize(with_roots(classes.select("no", "first"), "no", found.where("b is not null").select("a", "b")),
                        "vector-roots")
    names = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(names, "root").select("no", "component_id")
    result = (classes.select("no", "cls", "copies").join(named, "no").join(counts, "no", "left")
              .select("cls", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))
    result = materialize(result, "vector-result")
    done = linked.join(result, "cls").select("id", "n_links", "component_id")
    alone = rows.where("cls is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return done.union(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
