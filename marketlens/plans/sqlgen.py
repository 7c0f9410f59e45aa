"""SQL text for the DuckDB oracle, mirroring functions/columns.py and
functions/windows.py expression by expression (same casts, same operation
order) so doubles come out bit-identical."""

from __future__ import annotations

from marketlens.functions.exact import SCALES

KEYS = "exchange, symbol"


def win(n: int | None = None, order: bool = True, keys: str = KEYS) -> str:
    if not order:
        return f"(PARTITION BY {keys})"
    frame = f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW" if n else ""
    return f"(PARTITION BY {keys} ORDER BY date{frame})"


def div(num: str, den: str) -> str:
    return f"({num}) / nullif({den}, 0)"


def pct(new: str, old: str) -> str:
    return f"({div(f'{new} - {old}', old)} * 100)"


def _over(w: str | None) -> str:
    return "" if w is None else f" OVER {w}"


def mean(col: str, w: str | None = None, dec: str | None = None) -> str:
    """Mean of doubles from sums of whole numbers (see functions/exact.py),
    over the frame itself; with ``dec`` of a whole-number column."""
    o = _over(w)
    if dec:
        x = f"CAST({col} AS {dec})"
        return div(f"CAST(sum({x}){o} AS DOUBLE)", f"count({x}){o}")
    rest, terms = f"CAST({col} AS DOUBLE)", []
    for s in SCALES:
        limb = f"CAST(trunc({rest} * {d(2.0 ** -s)}) AS BIGINT)"
        rest = f"({rest} - CAST({limb} AS DOUBLE) * {d(2.0 ** s)})"
        terms.append(f"CAST(CAST(sum({limb}){o} AS BIGINT) AS DOUBLE) * {d(2.0 ** s)}")
    total = terms[-1]
    for t in reversed(terms[:-1]):
        total = f"({total} + {t})"
    return div(total, f"count({col}){o}")


def volume_stddev(col: str, w: str | None = None) -> str:
    # DuckDB multiplies int64-backed decimals (width <= 18) in 64 bits and
    # raises on overflow; widening the operands keeps every product exact
    # and equal to Spark's (which promotes to the full product precision).
    o = _over(w)
    x = f"CAST({col} AS DECIMAL(18,0))"
    xw = f"CAST({col} AS DECIMAL(20,0))"
    s1 = f"CAST(CAST(sum({x}){o} AS DECIMAL(18,0)) AS DECIMAL(20,0))"
    s2 = f"CAST(sum({xw} * {xw}){o} AS DECIMAL(31,0))"
    n = f"count({x}){o}"
    num = f"CAST(CAST({n} AS DECIMAL(6,0)) * {s2} - {s1} * {s1} AS DOUBLE)"
    return f"sqrt({div(num, f'CAST(({n}) * (({n}) - 1) AS DOUBLE)')})"


def list_stddev(values: str) -> str:
    """Sample standard deviation of a list of doubles, by the running update
    of mean and squared differences, first value first."""
    zero, step = d(0.0), "(b.x - a.mean)"
    state = f"{{'n': {zero}, 'mean': {zero}, 'm2': {zero}, 'x': %s}}"
    end = (f"list_reduce([{state % 'CAST(v AS DOUBLE)'} FOR v IN {values} IF v IS NOT NULL], "
           f"lambda a, b: {{'n': a.n + 1, 'mean': a.mean + {step} / (a.n + 1), "
           f"'m2': a.m2 + {step} * ({step} - {step} / (a.n + 1)), 'x': b.x}}, {state % zero})")
    return f"CASE WHEN {end}.n > 1 THEN sqrt({end}.m2 / ({end}.n - 1)) END"


def significant(x: str, digits: int = 10) -> str:
    return f"CAST(printf('%.{digits - 1}e', {x}) AS DOUBLE)"


def d(x: float) -> str:
    """A double literal (DuckDB reads 2.0 as DECIMAL)."""
    return f"CAST({x!r} AS DOUBLE)"
