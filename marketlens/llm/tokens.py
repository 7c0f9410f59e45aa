"""Token-ID output: one wavelet matrix per shard.

Documents are dealt by ranges of doc_id, sorted, encoded and written in
shards of about ``SHARD_TOKENS`` ids (a longer document is one shard).  A
shard file holds, zstd-compressed, its document table and the bit-planes of a
wavelet matrix: plane 0 has the top bit of every id in order, plane l + 1 the
next bit after a stable partition by the one before, zeros first.  With rank
and select over the planes one file answers access (which id stands at i),
count (how often does an id occur) and occurrence lookup (where is its k-th
copy) in one step per plane, and decodes whole.

Files: a Parquet table with one row per shard, so that Spark's commit
protocol covers lost executors and any store Spark can reach will do.
Columns: part (range number), seq (shard within the part), before (ids of
earlier shards of the part), n_tokens, n_docs, blob (the shard file).

Blob: magic "WVM1"; uint32 header length; header (little-endian uint64: ids,
documents, planes, then a zero count per plane, then byte lengths of the
sections); sections: doc ids (int64), flags of null ids (uint8), ids before
each document (int64), planes (packed, first bit highest).

Nulls: a null text counts as empty (end id only); null doc_ids come first and
stay null.  Repeated rows are written as often as they occur, ordered by
text hash.  An empty table writes no shard and reads back empty.
"""

from __future__ import annotations

import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marketlens.llm.common import worker_cache

SHARD_TOKENS = 4_000_000
CACHE_PIECES = 600_000
GROUP_CHARS = 4 << 20    # texts encoded together: each different piece is looked up once
END_ID = 0
_MAGIC = b"WVM1"


def public_vocabulary() -> str:
    """Path of the default tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# --- encoding ---------------------------------------------------------------

class Encoder:
    """Ids of whole texts as packed little-endian integers.

    A byte-level BPE vocabulary without normalizer never merges across a
    space that follows a non-space, so such a text is cut there, each
    different piece is encoded once by the tokenizers library and kept, and
    the ids of the pieces are joined.  Marks that end a piece after a letter or
    digit are tokens of their own, and so is a line break between two
    characters that are no space: such a piece has the ids of its parts.  Parts
    are encoded many at a time, one after the other, with spaces or line
    breaks between them: the tokens that start with a space, or are a line
    break, tell where parts begin.  Other texts (and vocabularies) are encoded
    whole."""

    # a space after a space, or a character that starts texts here
    _UNCUT = ("[ \\t\\n\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
              "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}] |\\x00")

    _MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")  # 's, 't, ... are tokens
    _LAST = pa.array([c for c in map(chr, range(0x250)) if c.isalnum()], pa.large_string())  # of the Latin blocks

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        conf = json.loads(self.tok.to_str())
        pre, added = conf.get("pre_tokenizer") or {}, conf.get("added_tokens") or []
        self.width = 2 if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.planes = max(1, (self.tok.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.uncut = "|".join([self._UNCUT, *(re.escape(a["content"]) for a in added)])
        self.cut = conf.get("normalizer") is None and pre.get("type") == "ByteLevel" and bool(
            pre.get("use_regex", True)) and not pre.get("add_prefix_space")
        # byte-level vocabularies write the space byte as U+0120
        self.opens = np.zeros(1 << 8 * self.width if self.width == 2 else self.tok.get_vocab_size(True), bool)
        self.opens[[i for t, i in self.tok.get_vocab(True).items() if t.startswith("\u0120")]] = True
        self.line = self.tok.token_to_id("\u010a")  # a line break
        self.limit, self.cache, self.old = cache_pieces // 2, {}, {}

    def _pack(self, ids) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._pack(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _cuttable(self, texts: pa.Array) -> pa.Array:
        if not self.cut:
            return pa.repeat(pa.scalar(False), len(texts))
        return pc.invert(pc.match_substring_regex(texts, self.uncut))

    def _encoded(self, parts: list[str], by: str) -> list[bytes]:
        """Ids of parts in one call, ``by`` between them: spaces belong to the
        part that follows, line breaks to none."""
        text = " " + " ".join(parts) if by == " " else by.join(parts)
        ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, f"<u{self.width}")
        if by == " ":
            starts = np.flatnonzero(self.opens[ids])
            ends = np.r_[starts[1:], len(ids)]
        else:
            breaks = np.flatnonzero(ids == self.line)
            starts, ends = np.r_[0, breaks + 1], np.r_[breaks, len(ids)]
        if len(starts) != len(parts) or starts[0]:
            raise ValueError("a space or line break stands inside a token of the vocabulary")
        data = ids.tobytes()
        return [data[i:j] for i, j in zip((starts * self.width).tolist(), (ends * self.width).tolist())]

    def _learn(self, keys: list[str]) -> None:
        """Encode pieces: a key is a piece after a space, or "\0" + a text's (or line's) start."""
        after, starts, others = [], [], []
        for k in keys:
            if not k or k[-1].isspace():
                others.append(k)
            elif k[0] != "\0":
                after.append(k)
            elif len(k) > 1 and not k[1].isspace() and "\n" not in k and self.line is not None:
                starts.append(k)
            else:
                others.append(k)
        for s in range(0, len(after), 512):
            part = after[s:s + 512]
            self.cache.update(zip(part, self._encoded(part, " ")))
        for s in range(0, len(starts), 512):
            part = starts[s:s + 512]
            self.cache.update(zip(part, self._encoded([k[1:] for k in part], "\n")))
        if others:
            texts = [k[1:] if k[:1] == "\0" else " " + k for k in others]
            self.cache.update(zip(others, self._whole(texts)))

    def _kept(self, keys: list[str]) -> list[bytes]:
        """Ids of keys, from the cache where it has them."""
        found = [*map(self.cache.get, keys)]
        lost = [i for i, ids in enumerate(found) if ids is None]
        if lost:
            new = []
            for k in dict.fromkeys([keys[i] for i in lost]):
                if (ids := self.old.get(k)) is None:
                    new.append(k)
                else:
                    self.cache[k] = ids
            self._learn(new)
            for i in lost:
                found[i] = self.cache[keys[i]]
        return found

    def _ids(self, keys: pa.Array) -> pa.Array:
        """Ids of keys; each different one is looked up once."""
        keys = keys.dictionary_encode()
        names = keys.dictionary.to_numpy(zero_copy_only=False).tolist()
        return pa.array(self._kept(names), pa.large_binary()).take(keys.indices)

    def _marked(self, keys: pa.Array) -> pa.Array:
        """Ids of keys, those of the marks that end them looked up apart."""
        words = pc.ascii_rtrim(keys, self._MARKS)
        cut = pc.is_in(pc.utf8_slice_codeunits(words, -1), self._LAST)
        words = pc.if_else(cut, words, keys)
        ends, n = np.frombuffer(keys.buffers()[1], np.int64, len(keys) + 1, 8 * keys.offset)[1:], pc.binary_length(keys)
        n = pc.subtract(n, pc.binary_length(words)).to_numpy()
        at, marked = np.r_[0, np.cumsum(n)], np.flatnonzero(n)
        if not len(marked):
            return self._ids(words)
        chars = np.frombuffer(keys.buffers()[2], np.uint8)[np.arange(at[-1]) + np.repeat(ends - at[1:], n)]
        marks = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(at), pa.py_buffer(chars))
        marks = self._ids(pc.binary_join_element_wise(pa.scalar("\0", marks.type), marks, pa.scalar("", marks.type)))
        return pc.binary_join_element_wise(self._ids(words), marks, pa.scalar(b"", marks.type))

    def _lines(self, key: str) -> list[str] | None:
        """A piece's parts as keys, if line breaks between non-spaces cut it."""
        first, *more = key.split("\n")
        parts = [first.removeprefix("\0"), *more]
        if self.line is None or any(not p or p[0].isspace() or p[-1].isspace() for p in parts):
            return None
        return [first, *("\0" + p for p in more)]

    def _pieces(self, keys: pa.Array) -> pa.Array:
        """Ids of different pieces."""
        rows = np.flatnonzero(pc.match_substring(keys, "\n"))
        broken = [(i, parts) for i, k in zip(rows.tolist(), keys.take(rows).to_pylist()) if (parts := self._lines(k))]
        if not broken:
            return self._marked(keys)
        flat = pa.array([p for _, parts in broken for p in parts], keys.type)
        whole = np.ones(len(keys), bool)
        whole[[i for i, _ in broken]] = False
        ids = self._marked(pa.concat_arrays([keys.filter(whole), flat]))
        n = int(whole.sum())
        lists = pa.LargeListArray.from_arrays(np.cumsum([0, *(len(parts) for _, parts in broken)]), ids.slice(n))
        joined = pc.binary_join(lists, pa.scalar(self._pack([self.line]), ids.type))
        place = np.empty(len(keys), np.int64)
        place[whole], place[~whole] = np.arange(n), np.arange(n, len(keys))
        return pa.concat_arrays([ids.slice(0, n), joined]).take(place)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > self.limit:  # pieces of the older half that are met again come back
            self.old, self.cache = self.cache, {}
        out: list[bytes] = [b""] * len(texts)
        given = [i for i, t in enumerate(texts) if t]
        strings = pa.array([texts[i] for i in given], pa.large_string())
        fits = self._cuttable(strings)
        cut, whole = ([given[i] for i in np.flatnonzero(m).tolist()] for m in (fits, pc.invert(fits)))
        if cut:
            start = pa.scalar("\0", strings.type)
            strings = pc.binary_join_element_wise(start, strings.filter(fits), pa.scalar("", strings.type))
            lists = pc.split_pattern(strings, " ")
            pieces = lists.values.dictionary_encode()
            ids = self._pieces(pieces.dictionary).take(pieces.indices)
            at = np.frombuffer(ids.buffers()[1], np.int64)[lists.offsets.to_numpy()].tolist()
            data = memoryview(ids.buffers()[2] or b"")
            for i, start, end in zip(cut, at, at[1:]):
                out[i] = data[start:end].tobytes()
        for i, ids in zip(whole, self._whole([texts[i] for i in whole]) if whole else []):
            out[i] = ids
        return out


# --- wavelet matrix ---------------------------------------------------------

class WaveletMatrix:
    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self._ranks: list[np.ndarray] | None = None

    @staticmethod
    def build(ids: np.ndarray, planes: int) -> "WaveletMatrix":
        out, zeros, x, y = [], [], ids, np.empty_like(ids)
        for level in range(planes - 1, -1, -1):
            bit = (x & x.dtype.type(1 << level)) != 0
            out.append(np.packbits(bit))
            low = len(x) - np.count_nonzero(bit)
            zeros.append(low)
            np.compress(bit, x, out=y[low:])
            np.compress(np.logical_not(bit, out=bit), x, out=y[:low])
            x, y = y, np.empty_like(ids) if x is ids else x
        return WaveletMatrix(len(ids), out, zeros)

    def decode(self) -> np.ndarray:
        """All ids in order: the partitions undone from the last plane up."""
        x = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        y = np.empty_like(x)
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n).view(bool)
            x[self.zeros[k]:] |= x.dtype.type(1 << (len(self.planes) - 1 - k))
            y[np.flatnonzero(bit)] = x[self.zeros[k]:]
            y[np.flatnonzero(np.logical_not(bit, out=bit))] = x[:self.zeros[k]]
            x, y = y, x
        return x.astype(np.uint32, copy=False)

    def _ones(self, k: int, i: int) -> int:
        """Ones of plane k before position i."""
        if self._ranks is None:  # cumulative ones per byte
            self._ranks = [np.r_[0, np.cumsum(np.bitwise_count(p), dtype=np.int64)] for p in self.planes]
        byte, rest = divmod(i, 8)
        more = int(self.planes[k][byte] >> (8 - rest)).bit_count() if rest else 0
        return int(self._ranks[k][byte]) + more

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i >> 3]) >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        out = 0
        for k in range(len(self.planes)):
            bit, ones = self._bit(k, i), self._ones(k, i)
            out = out << 1 | bit
            i = self.zeros[k] + ones if bit else i - ones
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the copies of ``token`` among the first ``end`` ids lie below
        the last plane."""
        lo, hi = 0, end
        for k in range(len(self.planes)):
            a, b = self._ones(k, lo), self._ones(k, hi)
            if token >> (len(self.planes) - 1 - k) & 1:
                lo, hi = self.zeros[k] + a, self.zeros[k] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, end: int) -> int:
        """Copies of ``token`` among the first ``end`` ids."""
        if not 0 <= token < 1 << len(self.planes):
            return 0
        lo, hi = self._range(token, end)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, k: int, bit: int, nth: int) -> int:
        """Position of the nth (from 0) one or zero of plane k."""
        self._ones(k, 0)
        ranks = self._ranks[k]
        before = ranks if bit else 8 * np.arange(len(ranks)) - ranks
        byte = int(np.searchsorted(before, nth, side="right")) - 1
        left = nth - int(before[byte])
        for j in range(8):
            if int(self.planes[k][byte]) >> (7 - j) & 1 == bit:
                if not left:
                    return 8 * byte + j
                left -= 1
        raise IndexError(nth)

    def select(self, token: int, nth: int) -> int:
        """Position of the nth (from 0) copy of ``token``."""
        if not 0 <= nth < self.count(token):
            raise IndexError(nth)
        i = self._range(token, self.n)[0] + nth
        for k in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - k) & 1
            i = self._select_bit(k, bit, i - self.zeros[k] if bit else i)
        return i


def pack_shard(ids: np.ndarray, doc_ids: list, starts: list[int], planes: int) -> bytes:
    w = WaveletMatrix.build(ids, planes)
    null = np.array([d is None for d in doc_ids], np.uint8)
    parts = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(),
             np.array(starts, "<i8").tobytes(), *(p.tobytes() for p in w.planes)]
    packer = zstandard.ZstdCompressor(level=1)
    parts = [packer.compress(p) for p in parts]
    head = struct.pack(f"<{3 + planes + len(parts)}Q", w.n, len(doc_ids), planes, *w.zeros, *map(len, parts))
    return b"".join([_MAGIC, struct.pack("<I", len(head)), head, *parts])


def unpack_shard(blob: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """(matrix, doc ids, ids before each document with the total last)."""
    if blob[:4] != _MAGIC:
        raise ValueError("not a shard file")
    (size,) = struct.unpack_from("<I", blob, 4)
    head = struct.unpack_from(f"<{size // 8}Q", blob, 8)
    n, docs, planes = head[:3]
    at, parts = 8 + size, []
    for length in head[3 + planes:]:
        parts.append(zstandard.ZstdDecompressor().decompress(blob[at:at + length]))
        at += length
    ids = np.frombuffer(parts[0], "<i8").tolist()
    null = np.frombuffer(parts[1], np.uint8)
    starts = np.r_[np.frombuffer(parts[2], "<i8"), n]
    matrix = WaveletMatrix(n, [np.frombuffer(p, np.uint8) for p in parts[3:]], list(head[3:3 + planes]))
    return matrix, [None if x else d for d, x in zip(ids, null)][:docs], starts


# --- Spark ------------------------------------------------------------------

_SHARD = "part int, seq int, before long, n_tokens long, n_docs long, blob binary"


def write_tokens(df: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS,
                 cache_pieces: int = CACHE_PIECES, group_chars: int = GROUP_CHARS) -> None:
    """Encode every text (plus the end id) and write shard files to ``path``.
    A worker keeps at most about ``cache_pieces`` encoded pieces and encodes
    texts of ``group_chars`` together: smaller values save memory and cost
    time, the ids are the same."""
    vocabulary = tokenizer or public_vocabulary()

    def run(batches):
        key = ("encoder", vocabulary, cache_pieces)
        enc = worker_cache().get(key) or Encoder(vocabulary, cache_pieces)
        worker_cache()[key] = enc
        end = np.array([END_ID], f"<u{enc.width}").tobytes()
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        data, docs, starts, n = [], [], [], 0

        def shard():
            ids = np.frombuffer(b"".join(data), f"<u{enc.width}")
            row = [[part], [seq], [before], [n], [len(docs)], [pack_shard(ids, docs, starts, enc.planes)]]
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)],
                                              names=["part", "seq", "before", "n_tokens", "n_docs", "blob"])

        def groups():
            ids, texts, size = [], [], 0
            for b in batches:
                for s in range(0, b.num_rows, 64):
                    piece = b.slice(s, 64)
                    ids += piece.column(0).to_pylist()
                    texts += [t or "" for t in piece.column(1).to_pylist()]
                    size += sum(map(len, texts[-piece.num_rows:]))
                    if size >= group_chars:
                        yield ids, texts
                        ids, texts, size = [], [], 0
            yield ids, texts

        for group, texts in groups():
            for doc, ids in zip(group, enc.encode(texts)):
                docs.append(doc)
                starts.append(n)
                data.append(ids + end)
                n += len(data[-1]) // enc.width
                if n >= shard_tokens:
                    yield shard()
                    seq, before = seq + 1, before + n
                    data, docs, starts, n = [], [], [], 0
        if docs:
            yield shard()

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")
    dealt.select("id", "text").mapInArrow(run, _SHARD).write.option("compression", "none").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SHARD).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, decoded from the
    shard files; start counts all ids before it."""
    shards = read_shards(spark, path)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def run(batches):
        for b in batches:
            for first, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                matrix, docs, starts = unpack_shard(blob)
                ids = memoryview(matrix.decode().astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(ids[4 * s:4 * e]) for s, e in zip(starts[:-1].tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(starts[:-1] + first), pa.array(np.diff(starts)),
                     pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row per range, as many as the write had partitions: a bounded broadcast
    base = shards.join(F.broadcast(offset), "part").select((F.col("offset") + F.col("before")).alias("base"), "blob")
    return base.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def occurrences(spark: SparkSession, path: str, token: int, most: int | None = None) -> DataFrame:
    """(part, seq, n, positions) per shard: how often ``token`` occurs and, up
    to ``most`` per shard, where (positions within the shard)."""
    def run(batches):
        for b in batches:
            rows = []
            for part, seq, blob in zip(*(c.to_pylist() for c in b.columns)):
                matrix = unpack_shard(blob)[0]
                n = matrix.count(token)
                rows.append((part, seq, n, [matrix.select(token, k) for k in range(n if most is None else min(n, most))]))
            types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                                             names=["part", "seq", "n", "positions"])

    return read_shards(spark, path).select("part", "seq", "blob").mapInArrow(
        run, "part int, seq int, n long, positions array<long>")
