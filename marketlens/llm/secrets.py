"""Secret scans through a trigram inverted index.

Every rule is a regular expression.  Its syntax tree yields a Boolean trigram
query: literal runs must contribute all their trigrams (AND), alternatives
any of theirs (OR).  Texts are indexed segment by segment (a segment is a run
of rows of one Arrow batch, bounded by ``SEGMENT_BYTES`` or one longer text):
for the trigrams that any rule asks for, the sorted list of texts holding it.
The postings of a rule are intersected and united as its query says, and the
rule's regex verifies only the remaining texts.  A rule without mandatory
trigrams (runs of hex digits) scans every text.

Index and queries work on UTF-8 with ASCII letters lower-cased, so that a
case-insensitive rule needs no variants; folding can only add candidates.

Spans are leftmost and non-overlapping per kind, in code points, end
exclusive, sorted by start, then by the order of the rules.  Null and empty
texts have no spans; null ids pass through; repeated rows repeat their
result; columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as C, _parser as P

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SEGMENT_BYTES = 4 << 20
_MAX_EXACT = 64  # literal alternatives carried along before trigrams are taken
_UPPER = bytes(range(65, 91))
_FOLD = bytes.maketrans(_UPPER, _UPPER.lower())


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0        # the group whose length counts
    min_chars: int = 0    # shorter matches are dropped after matching


#: Base rules: fixed by contract, in their listed order.  A run of 24 or more
#: hex digits starts where the run starts, so {24,} finds the runs that
#: "[0-9a-f]+ of 24 or more" finds, without stopping at every short run.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Further well-known public token formats.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("vcs", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pay", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("url", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{1,64}@"),
)

# --- trigram queries: True, ("tri", bytes), ("and", [...]), ("or", [...]) ---


def _both(a, b):
    if a is True:
        return b
    if b is True:
        return a
    return ("and", [a, b])


def _either(parts):
    return True if any(p is True for p in parts) else parts[0] if len(parts) == 1 else ("or", parts)


def _of_strings(strings: set[bytes]):
    """All trigrams of one of the strings."""
    parts = []
    for s in sorted(strings):
        tris = sorted({s[i:i + 3] for i in range(len(s) - 2)})
        parts.append(("and", [("tri", t) for t in tris]) if tris else True)
    return _either(parts)


def _chars(items) -> set[bytes] | None:
    """The folded single characters of a set node, or None if there are many."""
    out = set()
    for op, arg in items:
        if op is C.LITERAL:
            out.add(chr(arg))
        elif op is C.RANGE and arg[1] - arg[0] < 8:
            out.update(map(chr, range(arg[0], arg[1] + 1)))
        else:
            return None
    return {c.encode().translate(_FOLD) for c in out}


def _walk(nodes) -> tuple[object, set[bytes] | None]:
    """(query, exact strings or None) of a sequence of syntax nodes."""
    query, exact, whole = True, {b""}, True

    def flush():
        nonlocal query, exact, whole
        query, exact, whole = _both(query, _of_strings(exact)), {b""}, False

    for op, arg in nodes:
        sub, strings = True, None
        if op is C.LITERAL:
            strings = {chr(arg).encode().translate(_FOLD)}
        elif op is C.IN:
            strings = _chars(arg)
        elif op is C.SUBPATTERN:
            sub, strings = _walk(arg[3])
        elif op is C.BRANCH:
            parts = [_walk(p) for p in arg[1]]
            if all(s is not None for _, s in parts):
                strings = set().union(*(s for _, s in parts))
            else:
                sub = _either([_both(q, _of_strings(s or {b""})) for q, s in parts])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, body = arg
            q, s = _walk(body)
            if (low, high) == (0, 1) and s is not None and q is True:
                strings = s | {b""}
            elif low and s is not None:
                # at least one copy stands here; what follows it is open
                query = _both(query, q)
                exact = {a + b for a in exact for b in s}
                flush()
                continue
            elif low:
                sub = q
        elif op is C.AT:
            continue
        query = _both(query, sub)
        if strings is None or len(exact) * len(strings) > _MAX_EXACT:
            flush()
            if strings is not None and len(strings) <= _MAX_EXACT:
                exact = strings
        else:
            exact = {a + b for a in exact for b in strings}
    if whole:
        return query, exact
    return _both(query, _of_strings(exact)), None


def trigram_query(pattern: str):
    """Boolean trigram query that every matching text fulfils (True: none)."""
    query, exact = _walk(P.parse(pattern))
    return query if exact is None else _both(query, _of_strings(exact))


def _trigrams_in(query) -> set[bytes]:
    if query is True:
        return set()
    if query[0] == "tri":
        return {query[1]}
    return set().union(*map(_trigrams_in, query[1]))


def _code(t: bytes) -> int:
    return t[0] << 16 | t[1] << 8 | t[2]


class Index:
    """Inverted index of one segment: trigram code -> ordinals of its texts."""

    def __init__(self, texts: list[bytes], wanted: np.ndarray):
        joined = np.frombuffer(b"\0\0\0".join(texts), np.uint8)
        self.n, self.postings = len(texts), {}
        if len(joined) < 3:
            return
        a = joined.astype(np.int32)
        codes = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
        at = np.flatnonzero(wanted[codes])
        ends = np.cumsum([len(t) + 3 for t in texts])
        pairs = np.unique(codes[at].astype(np.int64) << 32 | np.searchsorted(ends, at, side="right"))
        tri, text = pairs >> 32, pairs & 0xFFFFFFFF
        cuts = np.flatnonzero(np.diff(tri)) + 1
        for t, rows in zip(tri[np.r_[0, cuts]] if len(tri) else [], np.split(text, cuts)):
            self.postings[int(t)] = rows

    def candidates(self, query) -> np.ndarray:
        if query is True:
            return np.arange(self.n)
        if query[0] == "tri":
            return self.postings.get(_code(query[1]), np.empty(0, np.int64))
        parts = [self.candidates(q) for q in query[1]]
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, True) if query[0] == "and" else np.union1d(out, p)
        return out


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        # re.A: "either case" means the ASCII letters only
        self.rules = [(r, re.compile(r.pattern, re.A), trigram_query(r.pattern)) for r in rules]
        self.wanted = np.zeros(1 << 24, bool)
        for _, _, q in self.rules:
            for t in _trigrams_in(q):
                self.wanted[_code(t)] = True

    def segment(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text its spans (start, end, rule number)."""
        index = Index([t.encode("utf-8", "surrogatepass").translate(_FOLD) for t in texts], self.wanted)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for n, (rule, regex, query) in enumerate(self.rules):
            for i in index.candidates(query):
                out[i] += [(m.start(), m.end(), n) for m in regex.finditer(texts[i])
                           if m.end(rule.group) - m.start(rule.group) >= rule.min_chars]
        for spans in out:
            spans.sort(key=lambda s: (s[0], s[2]))
        return out

    def scan(self, texts: list[str]):
        part, size = [], 0
        for t in texts:
            part.append(t)
            size += len(t)
            if size >= SEGMENT_BYTES:
                yield from self.segment(part)
                part, size = [], 0
        if part:
            yield from self.segment(part)


def find_secrets(df: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) per row."""
    kinds = [r.kind for r in rules]
    id_type = df.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        scanner = Scanner(rules)
        for b in batches:
            found = scanner.scan([t or "" for t in b.column(1).to_pylist()])
            rows = [[{"kind": kinds[n], "start": s, "end": e} for s, e, n in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, span)], names=["id", "spans"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, spans array<struct<kind:string,start:int,end:int>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a hash of the base spans and all spans as text."""
    base = [r.kind for r in BASE_RULES]
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    own = F.filter("spans", lambda s: s["kind"].isin(base))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(text(own).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"))


def brute_force(text: str | None, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> tuple[str, str]:
    """(base_sha256, spans) of one text without an index, for tests."""
    found = [(m.start(), n, m.end()) for n, r in enumerate(rules) for m in re.finditer(r.pattern, text or "", re.A)
             if m.end(r.group) - m.start(r.group) >= r.min_chars]
    shown = [(rules[n].kind, s, e) for s, n, e in sorted(found)]
    join = lambda x: ",".join(f"{k}:{s}:{e}" for k, s, e in x)
    base = {r.kind for r in BASE_RULES}
    return hashlib.sha256(join([x for x in shown if x[0] in base]).encode()).hexdigest(), join(shown)
