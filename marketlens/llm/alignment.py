"""Cross-tokenizer alignment as an Arrow-native pipeline.

Every text is encoded by a byte-level BPE vocabulary (A, on space + text) and
a sentencepiece vocabulary (B).  Byte offsets where a token of either ends cut
both sequences into groups; every A token links to every B token of its group.
``aligned`` writes, per segment of texts, the links and per id pair the number
of the segment's documents that hold it; Spark adds these partial counts over
all segments and hands each segment the totals of its own pairs, from which
the documents' figures follow.

Neither vocabulary has a token that spans a non-space followed by a space, so
a text with single spaces between words is a sequence of units (a word with
the space before it) that are encoded and aligned on their own: each different
unit of a segment is a document of the alignment step, once.  Other texts
(leading, trailing or repeated white space, U+2581, NUL) are one unit, whole.
``list_flatten`` and ``list_parent_indices`` turn texts into (document, unit)
rows, segmented cumulative sums of token lengths give ends, an Acero hash join
on (unit, end) finds the offsets where both sides end, one on (unit, group)
makes the links, and ``Table.group_by`` the counts.

Nulls, empty texts and texts whose tokens do not spell space + text have no
tokens: zeros and an empty ``groups_sha256``.  Repeated rows and null ids are
documents of their own.  A text longer than a segment is a segment.  Only the
id and text columns are read, so other columns cannot clash.  An empty table
gives no row.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.common import free_memory, worker_cache
from marketlens.session import scratch_path

SEGMENT_CHARS = 3 << 20
LEARN_UNITS = 256        # units encoded in one call
KNOWN_UNITS = 400_000    # words whose ids a worker keeps from segment to segment
EXPAND_ROWS = 1_000_000  # (document, pair) rows counted at once

_SPACES = tuple(c + " " for c in " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f")
_MARK = chr(0x2581)     # B's space
_WIDE = re.compile("[" + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F,
                                           0x3000))) + "] |" + _MARK)


def simple(text: str) -> bool:
    """Whether the text may be cut at its spaces."""
    return (text[0] != " " and text[-1] != " " and "\0" not in text and not any(s in text for s in _SPACES)
            and (text.isascii() or not _WIDE.search(text)))


def byte_values() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1
    stands for itself, the other bytes follow from U+0100 in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both vocabularies: ids of many texts, and the bytes of every id."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        values = byte_values()
        special = {t["id"]: t["content"].encode() for t in json.loads(self.a.to_str()).get("added_tokens") or []}
        entries = sorted((i, t) for t, i in self.a.get_vocab(True).items())
        self.a_bytes = [special[i] if i in special else bytes(map(values.__getitem__, t)) for i, t in entries]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode()
                        for i, p in enumerate(names)]
        self.a_size = np.array([*map(len, self.a_bytes)], np.int64)
        self.b_size = np.array([*map(len, self.b_bytes)], np.int64)
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}

    def encode(self, texts: list[str]) -> tuple[list, list]:
        return ([e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)],
                self.b.encode(texts, num_threads=1))

    def spells(self, a: list[int], b: list[int], text: str) -> bool:
        want = (" " + text).encode()
        return (b"".join(map(self.a_bytes.__getitem__, a)) == want
                and b"".join(map(self.b_bytes.__getitem__, b)) == want)


def _record(a: list[int], b: list[int]) -> bytes:
    """A unit's ids in one piece: how many A ids, those, the B ids."""
    return np.array([len(a), *a, *b], "<u4").tobytes()


def _learn(tok: Tokenizers, words: list[str]) -> None:
    """Keep the records of ``words``, None where the tokens do not spell the
    word.  Words go through the tokenizers many at a time, joined by spaces:
    token ends tell where a word's tokens end."""
    for s in range(0, len(words), LEARN_UNITS):
        part = words[s:s + LEARN_UNITS]
        joined = " ".join(part)
        (a,), (b,) = tok.encode([joined])
        if not tok.spells(a, b, joined):
            for w, a, b in zip(part, *tok.encode(part)):
                tok.known[w] = _record(a, b) if tok.spells(a, b, w) else None
            continue
        word_ends = np.cumsum([1 + len(w.encode()) for w in part])
        a, b, heads = np.array(a), np.array(b), np.arange(len(part))
        a_at = np.r_[0, np.searchsorted(np.cumsum(tok.a_size[a]), word_ends, side="right")]
        b_at = np.r_[0, np.searchsorted(np.cumsum(tok.b_size[b]), word_ends, side="right")]
        records = np.empty(len(part) + len(a) + len(b), "<u4")
        at = heads + a_at[:-1] + b_at[:-1]
        records[at] = np.diff(a_at)
        records[np.arange(len(a)) + np.repeat(heads + 1 + b_at[:-1], np.diff(a_at))] = a
        records[np.arange(len(b)) + np.repeat(heads + 1 + a_at[1:], np.diff(b_at))] = b
        data, at = records.tobytes(), [*(4 * at).tolist(), 4 * len(records)]
        tok.known.update(zip(part, [data[i:j] for i, j in zip(at, at[1:])]))


def _encode_units(tok: Tokenizers, words: list[str], wholes: list[str]):
    """Flat A ids, their units, flat B ids, their units, and which units the
    tokens do not spell.  The ids of words stay known to the worker (in two
    halves: words of the older half that are met again come back)."""
    if len(tok.known) > KNOWN_UNITS // 2:
        tok.older, tok.known = tok.known, {}
    new = []
    for w in words:
        if w not in tok.known:
            if w in tok.older:
                tok.known[w] = tok.older[w]
            else:
                new.append(w)
    _learn(tok, new)
    units = [*map(tok.known.__getitem__, words)]
    for s in range(0, len(wholes), 16):
        part = wholes[s:s + 16]
        units += [_record(a, b) if tok.spells(a, b, t) else None for t, a, b in zip(part, *tok.encode(part))]
    bad = np.array([u is None for u in units], bool)
    data = [u or b"" for u in units]
    rows = np.fromiter(map(len, data), np.int64, len(data)) // 4
    flat, first = np.frombuffer(b"".join(data), "<u4").astype(np.int64), np.cumsum(rows) - rows
    n_a = np.zeros(len(data), np.int64)
    n_a[~bad] = flat[first[~bad]]
    unit = np.repeat(np.arange(len(data)), rows)
    place, last_a = np.arange(len(flat)) - first[unit], n_a[unit]
    in_b = place > last_a
    in_a = (place > 0) & ~in_b
    return flat[in_a], unit[in_a], flat[in_b], unit[in_b], bad


def _segmented_cumsum(values: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """Running sums that start again with every parent (ascending)."""
    total = np.cumsum(values)
    before = np.r_[0, total][np.searchsorted(parents, parents)]
    return total - before


def _side(ids: np.ndarray, units: np.ndarray, size: np.ndarray, row: str) -> pa.Table:
    return pa.table({"unit": units, "end": _segmented_cumsum(size[ids], units), row: np.arange(len(ids))})


def _groups(side: pa.Table, cuts: np.ndarray) -> np.ndarray:
    """Number of each token's group: the cuts before it, over all units."""
    cut = np.zeros(len(side), np.int64)
    cut[cuts] = 1
    return np.cumsum(cut) - cut


def _joined(values: np.ndarray, parents: np.ndarray, n: int, by: str) -> pa.Array:
    """Per parent, its values joined by ``by``."""
    offsets = np.searchsorted(parents, np.arange(n + 1))
    strings = values if isinstance(values, pa.Array) else pa.array(values).cast(pa.large_string())
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), strings)
    return pc.binary_join(lists, pa.scalar(by, pa.large_string()))


def align(tok: Tokenizers, texts: list[str | None]) -> dict:
    """Align a segment.  Arrays per document (n_a, n_b, n_groups, n_links,
    groups_sha256, units as offsets and values), per unit (its links' pair
    numbers as offsets and values) and per pair (a, b, n_docs)."""
    given = [t or "" for t in texts]
    cut = np.array([bool(t) and simple(t) for t in given], bool)
    rows_cut = np.flatnonzero(cut)
    rows_whole = np.array([i for i, t in enumerate(given) if t and not cut[i]], np.int64)
    lists = pc.split_pattern(pa.array([given[i] for i in rows_cut], pa.large_string()), " ")
    words = pc.list_flatten(lists).dictionary_encode()
    doc_of = rows_cut[pc.list_parent_indices(lists).to_numpy()] if len(rows_cut) else np.zeros(0, np.int64)
    unit_of = words.indices.to_numpy().astype(np.int64)
    names = words.dictionary.to_pylist()
    a_ids, a_unit, b_ids, b_unit, bad = _encode_units(tok, names, [given[i] for i in rows_whole])
    n_units, n_words = len(bad), len(names)
    if bad[:n_words].any():  # a text with such a word: the whole decides
        spoilt = np.unique(doc_of[bad[unit_of]])
        fine = ~np.isin(doc_of, spoilt)
        doc_of, unit_of = doc_of[fine], unit_of[fine]
        more = _encode_units(tok, [], [given[i] for i in spoilt])
        a_ids, b_ids = np.r_[a_ids, more[0]], np.r_[b_ids, more[2]]
        a_unit, b_unit = np.r_[a_unit, more[1] + n_units], np.r_[b_unit, more[3] + n_units]
        bad, rows_whole = np.r_[bad, more[4]], np.r_[rows_whole, spoilt]
        n_units = len(bad)
    whole_units = np.arange(n_words, n_units)
    doc_of = np.r_[doc_of, rows_whole[~bad[n_words:]]]
    unit_of = np.r_[unit_of, whole_units[~bad[n_words:]]]
    by = np.argsort(doc_of, kind="stable")
    doc_of, unit_of = doc_of[by], unit_of[by]

    # the offsets where tokens of both sides end
    side_a, side_b = _side(a_ids, a_unit, tok.a_size, "a_row"), _side(b_ids, b_unit, tok.b_size, "b_row")
    cuts = side_a.join(side_b, ["unit", "end"], join_type="inner", use_threads=False)
    group_a, group_b = (_groups(side, cuts.column(row).to_numpy()) for side, row in ((side_a, "a_row"), (side_b, "b_row")))
    del side_a, side_b, cuts
    n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
    group_unit = np.zeros(n_groups, np.int64)
    group_unit[group_a] = a_unit

    # links, and the pairs that they are of
    links = pa.table({"group": group_a, "a": a_ids}).join(
        pa.table({"group": group_b, "b": b_ids}), "group", join_type="inner", use_threads=False)
    link_unit = group_unit[links.column("group").to_numpy()]
    pair_key = links.column("a").to_numpy() << 32 | links.column("b").to_numpy()
    by = np.argsort(link_unit, kind="stable")
    keys, link_pair = np.unique(pair_key[by], return_inverse=True)
    link_at = np.searchsorted(link_unit[by], np.arange(n_units + 1))

    # documents that hold each pair: distinct (document, unit), then (document, pair)
    held = pa.table({"doc": doc_of, "unit": unit_of}).group_by(["doc", "unit"], use_threads=False).aggregate([])
    held_doc, held_unit = held.column("doc").to_numpy(), held.column("unit").to_numpy()
    by = np.argsort(held_doc, kind="stable")
    held_doc, held_unit = held_doc[by], held_unit[by]
    rows = np.diff(link_at)[held_unit] if len(held_unit) else np.zeros(0, np.int64)
    ends = np.cumsum(rows)
    counts = np.zeros(len(keys), np.int64)
    start = 0
    while start < len(rows):  # whole documents, about EXPAND_ROWS rows at a time
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + EXPAND_ROWS, side="right"))
        stop = int(np.searchsorted(held_doc, held_doc[min(max(stop, start + 1), len(rows)) - 1], side="right"))
        n, first = rows[start:stop], link_at[held_unit[start:stop]]
        at = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        held_pair = pa.table({"doc": np.repeat(held_doc[start:stop], n), "pair": link_pair[at]})
        distinct = held_pair.group_by(["doc", "pair"], use_threads=False).aggregate([])
        part = distinct.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        counts[part.column("pair").to_numpy()] += part.column("count_all").to_numpy()
        start = stop

    # groups as text, joined per unit and then per document
    shown = pc.binary_join_element_wise(_joined(a_ids, group_a, n_groups, ","), _joined(b_ids, group_b, n_groups, ","),
                                          pa.scalar("|", pa.large_string()))
    unit_text = _joined(shown, group_unit, n_units, ";").to_pylist()
    at = np.searchsorted(doc_of, np.arange(len(given) + 1))
    sha = []
    for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
        digest = hashlib.sha256()
        for p in range(s, e, 4096):
            text = ";".join(map(unit_text.__getitem__, unit_of[p:min(e, p + 4096)].tolist()))
            digest.update((text if p == s else ";" + text).encode())
        sha.append(digest.hexdigest() if e > s else "")

    def per_doc(unit_values: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(unit_values[unit_of])][at])

    return {"n_a": per_doc(np.bincount(a_unit, minlength=n_units)), "n_b": per_doc(np.bincount(b_unit, minlength=n_units)),
            "n_groups": per_doc(np.bincount(group_unit, minlength=n_units)), "n_links": per_doc(np.diff(link_at)),
            "groups_sha256": sha, "unit_at": at, "units": unit_of, "link_at": link_at, "links": link_pair,
            "a": keys >> 32, "b": keys & 0xFFFFFFFF, "n_docs": counts}


# --- Spark ------------------------------------------------------------------

_ROWS = "kind string, seg long, pair int, a int, b int, n_docs long, blob binary"
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def _pack(ids: list, found: dict) -> bytes:
    """A segment's documents and its units' links, as one Arrow stream each."""
    docs = pa.table({"doc_id": pa.array(ids, pa.int64()), **{k: found[k] for k in ("n_a", "n_b", "n_groups", "n_links")},
                     "groups_sha256": pa.array(found["groups_sha256"], pa.string()),
                     "units": pa.LargeListArray.from_arrays(pa.array(found["unit_at"], pa.int64()),
                                                            pa.array(found["units"], pa.int32()))})
    units = pa.table({"links": pa.LargeListArray.from_arrays(pa.array(found["link_at"], pa.int64()),
                                                             pa.array(found["links"], pa.int32()))})
    sink = pa.BufferOutputStream()
    for table in (docs, units):
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> tuple[pa.Table, pa.Table]:
    source = pa.BufferReader(blob)
    return tuple(pa.ipc.open_stream(source).read_all().combine_chunks() for _ in range(2))


def aligned(docs: DataFrame, path: str, byte_level: str | None = None, pieces: str | None = None,
            id_col: str = "doc_id", text_col: str = "text", segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Write segments (kind ``segment``: blob) and their pairs (kind ``pair``:
    number in the segment, ids, documents that hold it) to ``path``."""
    import public_tokenizers

    files = (byte_level or public_tokenizers.path("byte_bpe_50k.json"),
             pieces or public_tokenizers.path("piece_bpe_32k.model"))

    def run(batches):
        cache = worker_cache()
        tok = cache.get(("alignment", files)) or cache.setdefault(("alignment", files), Tokenizers(*files))
        seg = TaskContext.get().partitionId() << 32

        def segment(ids, texts):
            found = align(tok, texts)
            n = len(found["a"])
            yield pa.RecordBatch.from_pydict(
                {"kind": ["segment"], "seg": [seg], "pair": [None], "a": [None], "b": [None], "n_docs": [None],
                 "blob": [_pack(ids, found)]}, schema=schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(["pair"] * n, pa.string()), pa.array(np.full(n, seg)), pa.array(np.arange(n, dtype=np.int32)),
                 pa.array(found["a"].astype(np.int32)), pa.array(found["b"].astype(np.int32)),
                 pa.array(found["n_docs"]), pa.nulls(n, pa.binary())], schema=schema)

        schema = pa.schema([("kind", pa.string()), ("seg", pa.int64()), ("pair", pa.int32()), ("a", pa.int32()),
                            ("b", pa.int32()), ("n_docs", pa.int64()), ("blob", pa.binary())])
        ids, texts, size = [], [], 0
        for b in batches:
            for s in range(0, b.num_rows, 64):
                part = b.slice(s, 64)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids.append(doc)
                    texts.append(text)
                    size += len(text or "")
                    if size >= segment_chars:
                        yield from segment(ids, texts)
                        seg, ids, texts, size = seg + 1, [], [], 0
                        free_memory()
        if ids:
            yield from segment(ids, texts)
        free_memory()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows.mapInArrow(run, _ROWS).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_ROWS).parquet(path)


def pair_counts(segments: DataFrame) -> DataFrame:
    """(a, b, n_docs, best): documents corpus-wide that hold each linked id
    pair, and whether no other pair of its A id is in more."""
    pairs = segments.where("kind = 'pair'")
    counts = pairs.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"))
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))  # one row per id of the vocabulary
    return counts.join(F.broadcast(most), "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _figures(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a segment, with the counts of its pairs."""
    worker_cache().clear()  # the workers that aligned the segments still hold the vocabularies and known words
    names = [c.split()[0] for c in _RESULT.split(", ")]
    count = np.zeros(len(right), np.int64)
    best = np.zeros(len(right), np.int64)
    number = right.column("pair").to_numpy()
    count[number] = right.column("n_docs").to_numpy()
    best[number] = right.column("best").to_numpy(zero_copy_only=False)
    parts = []
    for blob in left.column("blob").to_pylist():
        docs, units = _unpack(blob)
        links, used = units.column("links").chunk(0), docs.column("units").chunk(0)
        sums = []
        for values in (best, count):
            per_unit = np.diff(np.r_[0, np.cumsum(values[links.values.to_numpy()])][links.offsets.to_numpy()])
            sums.append(np.diff(np.r_[0, np.cumsum(per_unit[used.values.to_numpy()])][used.offsets.to_numpy()]))
        parts.append(docs.drop_columns(["units"]).append_column("n_best", pa.array(sums[0], pa.int64()))
                     .append_column("count_sum", pa.array(sums[1], pa.int64())).select(names))
    free_memory()
    return pa.concat_tables(parts)


def documents(segments: DataFrame) -> DataFrame:
    """The documents' figures, each segment with the counts of its own pairs."""
    pairs = segments.where("kind = 'pair'").select("seg", "pair", "a", "b")
    known = pairs.join(pair_counts(segments), ["a", "b"]).select(
        F.col("seg").alias("of"), "pair", "n_docs", "best")
    blobs = segments.where("kind = 'segment'").select("seg", "blob")

    return blobs.groupBy("seg").cogroup(known.groupBy("of")).applyInArrow(_figures, _RESULT)


def align_documents(docs: DataFrame, **options) -> DataFrame:
    """Align ``docs`` and return one row of figures per document."""
    return documents(aligned(docs, scratch_path(docs.sparkSession, "alignment"), **options))
