"""Technical indicators (W1-W8) and return columns.

All columns come from windows over one spec family - partition by
(exchange, symbol), order by date - so the stage has one exchange and one
sort.  Moving means are exactly summed doubles (see functions/exact.py), at
the full precision of the prices.
The reference's "EMA" is a simple trailing mean and RSI averages use a
simple 14-row mean; both are kept as the default semantics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.functions import exact as X
from marketlens.functions import windows as W


def add_moving_averages(bars: DataFrame, ma=(5, 10, 20, 50)) -> DataFrame:
    """ma_n = mean close over the trailing n rows (partial frames)."""
    x = X.with_trailing_means(bars, {"c": F.col("close")}, ma)
    return X.drop_trailing(x.withColumns({f"ma_{n}": X.trailing_mean("c", n) for n in ma}))


def add_indicators(bars: DataFrame, ma=(5, 10, 20, 50), rsi: int = 14,
                   bb=(20, 2.0), macd=(12, 26), vol: int = 10, prev=()) -> DataFrame:
    """Moving averages, RSI, Bollinger bands, MACD, volume ratio.
    ``prev`` lists moving-average lengths whose previous-row value is also
    kept (``_prev_ma_n``, consumed and dropped by ``signals.add_signals``).

    Trailing means come from exact running sums (one pass per series), the
    Bollinger deviation from Spark's own sliding sample deviation, which is
    exactly 0 over a flat frame."""
    w = W.ordered()
    bb_n, bb_k = bb
    fast, slow = macd
    chg, zero = F.col("price_change"), F.lit(0.0)
    # The first row has no change -> gain = loss = 0
    step1 = bars.withColumn("price_change", F.col("close").cast("double") - F.lag("close").over(w)).withColumns({
        "gain": F.when(chg > 0, chg).otherwise(zero),
        "loss": F.when(chg < 0, -chg).otherwise(zero),
    })
    sums = X.with_trailing_means(
        step1, {"c": F.col("close"), "g": F.col("gain"), "l": F.col("loss"), "v": F.col("volume")},
        {"c": set(ma) | {bb_n, fast, slow}, "g": [rsi], "l": [rsi], "v": [vol]}, prev={"c": prev})
    step2 = sums.withColumns({
        **{f"ma_{n}": X.trailing_mean("c", n) for n in ma},
        # previous row's means (``prev``), for signals: no extra window pass
        **{f"_prev_ma_{n}": X.trailing_mean("c", n, previous=True) for n in prev},
        # Simple trailing means of gain and loss
        "avg_gain": X.trailing_mean("g", rsi),
        "avg_loss": X.trailing_mean("l", rsi),
        # W6
        f"std_{bb_n}": F.stddev_samp("close").over(W.trailing(bb_n)),
        "_ma_bb": X.trailing_mean("c", bb_n),
        # W7
        f"ema_{fast}": X.trailing_mean("c", fast),
        f"ema_{slow}": X.trailing_mean("c", slow),
        # W8
        f"volume_ma_{vol}": X.trailing_mean("v", vol),
    })
    std = F.col(f"std_{bb_n}")
    out = step2.withColumns({
        # avg_loss = 0 -> rs = 100 (all-gain series gives rsi 99.0099...)
        "rs": F.when(F.col("avg_loss") == 0, F.lit(100.0))
               .otherwise(C.safe_div("avg_gain", "avg_loss")),
        "bb_upper": F.col("_ma_bb") + F.lit(bb_k) * std,
        "bb_lower": F.col("_ma_bb") - F.lit(bb_k) * std,
        "macd": F.col(f"ema_{fast}") - F.col(f"ema_{slow}"),
        "volume_ratio": C.safe_div(F.col("volume").cast("double"), F.col(f"volume_ma_{vol}")),
    }).withColumns({
        "rsi": F.lit(100.0) - C.safe_div(F.lit(100.0), F.lit(1.0) + F.col("rs")),
        "bb_position": C.safe_div(F.col("close") - F.col("bb_lower"),
                                  F.col("bb_upper") - F.col("bb_lower")),
    })
    return X.drop_trailing(out).drop("_ma_bb")


def add_returns(bars: DataFrame) -> DataFrame:
    """prev_close, daily_return_pct from the previous close, ma_5, ma_20."""
    w = W.ordered()
    x = X.with_trailing_means(bars.withColumn("prev_close", F.lag("close").over(w)), {"c": F.col("close")}, (5, 20))
    return X.drop_trailing(x.withColumns({
        "daily_return_pct": C.pct_change("close", "prev_close"),
        "ma_5": X.trailing_mean("c", 5),
        "ma_20": X.trailing_mean("c", 20),
    }))
