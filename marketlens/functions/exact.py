"""Exact sums of doubles at full precision.

A sum of doubles depends on the order of its additions, and a difference of
two running sums loses what they share.  Here every value is cut, without
rounding, into four whole numbers of at most 40 bits (``limbs``), worth 2^30,
2^-10, 2^-50 and 2^-90.  Whole numbers add and subtract exactly, in any order:

* a group's sum does not depend on partitions or merge order,
* the sum of the last n rows of a series is a running sum minus its value n
  rows earlier, whatever came before: one pass for all frame lengths,

and one conversion to double at the end rounds to about one unit in the last
place.  Sums are primitive longs throughout, so plans stay in generated code.

Exact for magnitudes from 2^-37 (7e-12) to 2^70 (1e21); smaller values keep
all bits down to 2^-90 (8e-28).  A frame that holds NaN, an infinity or more
than 2^70 has the statistic NaN.  Up to 2^23 (8 million) rows per series or
group: bars are unique per day, so the calendar bounds them far below.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlens.functions.columns import col_, safe_div

SCALES = (30, -10, -50, -90)    # powers of two that a unit of each limb is worth
LARGEST = 2.0 ** 70
_COUNT_BITS = 32


def limbs(x) -> list[Column]:
    """The four whole numbers of a double; 0 for NULL and out-of-range values.
    Casting to bigint drops the fraction, so every remainder is exact."""
    x = col_(x).cast("double")
    rest = F.when(F.abs(x) < F.lit(LARGEST), x).otherwise(F.lit(0.0))
    out = []
    for s in SCALES:
        limb = (rest * F.lit(2.0 ** -s)).cast("bigint")
        rest = rest - limb.cast("double") * F.lit(2.0 ** s)
        out.append(limb)
    return out


def _tally(x) -> Column:
    """1 for a value in range, 2^32 for one out of range, 0 for NULL."""
    x = col_(x).cast("double")
    return (F.when(F.abs(x) < F.lit(LARGEST), F.lit(1)).when(x.isNotNull(), F.lit(1 << _COUNT_BITS))
            .otherwise(F.lit(0)).cast("bigint"))


def joined(parts: list[Column]) -> Column:
    """The double of summed limbs, smallest first."""
    total = None
    for s, p in reversed(list(zip(SCALES, parts))):
        term = p.cast("double") * F.lit(2.0 ** s)
        total = term if total is None else total + term
    return total


def _mean(parts: list[Column], tally: Column) -> Column:
    count = tally.bitwiseAND(F.lit((1 << _COUNT_BITS) - 1))
    return F.when(tally >= F.lit(1 << _COUNT_BITS), F.lit(math.nan)).otherwise(safe_div(joined(parts), count))


def mean(x, w: WindowSpec | None = None) -> Column:
    """Mean of a group (``w`` None) or of a window frame; NULL without values."""
    over = (lambda e: e) if w is None else (lambda e: e.over(w))
    return _mean([over(F.sum(p)) for p in limbs(x)], over(F.sum(_tally(x))))


def with_trailing_means(df: DataFrame, cols: dict, ns, keys=("exchange", "symbol"), order="date",
                        prev=None) -> DataFrame:
    """Means over the last n rows (fewer at the start of a series), in O(1)
    per row and exactly summed: for every ``name -> double column`` and every n
    adds ``_tm_{name}_{n}``.  ``ns`` is one list of frame lengths or a dict
    ``name -> lengths``; ``prev`` (a dict) adds the same means for the frame
    that ends one row earlier (``_tmp_{name}_{n}``, NULL on the first row).
    One window spec serves all: one exchange, one sort, one running pass and
    one lag pass."""
    w = Window.partitionBy(*keys).orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = prev or {}
    fields = [f"s{k}" for k in range(len(SCALES))] + ["n"]
    step = df.withColumns({f"_cum_{name}": F.struct(*[
        F.sum(p).over(run).alias(f) for f, p in zip(fields, [*limbs(c), _tally(c)])]) for name, c in cols.items()})
    lengths = {name: sorted(set(ns[name] if isinstance(ns, dict) else ns)) for name in cols}
    back = {name: sorted({*lengths[name], *(n + 1 for n in prev.get(name, ())), *((1,) if prev.get(name) else ())})
            for name in cols}
    step = step.withColumns({f"_lag_{name}_{n}": F.lag(f"_cum_{name}", n).over(w) for name in cols for n in back[name]})

    def between(name: str, end: str, n: int) -> Column:
        parts = [F.col(f"{end}.{f}") - F.coalesce(F.col(f"_lag_{name}_{n}.{f}"), F.lit(0).cast("bigint")) for f in fields]
        return _mean(parts[:-1], parts[-1])

    out = {}
    for name in cols:
        for n in lengths[name]:
            out[f"_tm_{name}_{n}"] = between(name, f"_cum_{name}", n)
        for n in sorted(set(prev.get(name, ()))):
            out[f"_tmp_{name}_{n}"] = between(name, f"_lag_{name}_1", n + 1)
    return step.withColumns(out).drop(*[f"_cum_{name}" for name in cols],
                                      *[f"_lag_{name}_{n}" for name in cols for n in back[name]])


def trailing_mean(name: str, n: int, previous: bool = False) -> Column:
    return F.col(f"_tm{'p' if previous else ''}_{name}_{n}")


def drop_trailing(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(("_tm_", "_tmp_"))])
