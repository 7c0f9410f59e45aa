"""Trading signals (W13-W17) and their distribution (A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import windows as W


def add_signals(ind: DataFrame, rsi=(30.0, 70.0), vol=(0.5, 2.0),
                fast: str = "ma_5", slow: str = "ma_20") -> DataFrame:
    """Needs the columns of ``indicators.add_indicators``."""
    w = W.ordered()
    lo, hi = rsi
    vlo, vhi = vol
    # previous-row averages from add_indicators(prev=...) when present (same
    # values as lag(), computed in the indicators' lag pass), else a lag
    prev_fast = F.col(f"_prev_{fast}") if f"_prev_{fast}" in ind.columns else F.lag(fast).over(w)
    prev_slow = F.col(f"_prev_{slow}") if f"_prev_{slow}" in ind.columns else F.lag(slow).over(w)
    cross = (F.when((F.col(fast) > F.col(slow)) & (prev_fast <= prev_slow), F.lit("BUY"))
             .when((F.col(fast) < F.col(slow)) & (prev_fast >= prev_slow), F.lit("SELL"))
             .otherwise(F.lit("HOLD")))
    step = ind.withColumns({
        "ma_crossover": cross,
        "rsi_signal": F.when(F.col("rsi") < F.lit(lo), F.lit("OVERSOLD"))
                       .when(F.col("rsi") > F.lit(hi), F.lit("OVERBOUGHT"))
                       .otherwise(F.lit("NEUTRAL")),
        "bb_signal": F.when(F.col("close") < F.col("bb_lower"), F.lit("OVERSOLD"))
                      .when(F.col("close") > F.col("bb_upper"), F.lit("OVERBOUGHT"))
                      .otherwise(F.lit("WITHIN_BANDS")),
        "volume_signal": F.when(F.col("volume_ratio") > F.lit(vhi), F.lit("HIGH_VOLUME"))
                          .when(F.col("volume_ratio") < F.lit(vlo), F.lit("LOW_VOLUME"))
                          .otherwise(F.lit("NORMAL_VOLUME")),
    })
    x, r, b = F.col("ma_crossover"), F.col("rsi_signal"), F.col("bb_signal")
    combined = (F.when((x == "BUY") & (r == "OVERSOLD") & (b == "OVERSOLD"), F.lit("STRONG_BUY"))
                .when((x == "SELL") & (r == "OVERBOUGHT") & (b == "OVERBOUGHT"), F.lit("STRONG_SELL"))
                .when(x == "BUY", F.lit("BUY"))
                .when(x == "SELL", F.lit("SELL"))
                .otherwise(F.lit("HOLD")))
    out = step.withColumn("combined_signal", combined)
    return out.drop(*[c for c in out.columns if c.startswith("_prev_ma_")])


def signal_counts(sig: DataFrame, col: str = "combined_signal") -> DataFrame:
    """A3: rows per signal value; the count is named ``n_rows``."""
    return sig.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
