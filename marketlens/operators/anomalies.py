"""Anomaly flags.

Whole-series volume statistics (w0) and date-ordered price changes (w) share
the (exchange, symbol) partitioning, so Catalyst feeds both Window operators
from one exchange.  Stats of a single bar are NULL, which makes the z-score
NULL and the flag "not anomalous" (NULL counts as 0 in the score).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import columns as C
from marketlens.functions import windows as W


def add_anomalies(bars: DataFrame, z: float = 3.0, pct: float = 10.0, gap: float = 5.0,
                  min_score: int = 2) -> DataFrame:
    w0 = W.whole()
    w = W.ordered()
    prev_close = F.lag("close").over(w)
    step = bars.withColumns({
        "volume_mean": W.exact_mean("volume", w0, dec="decimal(20,0)"),
        "volume_std": W.exact_stddev("volume", w0),
        "prev_close": prev_close,
    }).withColumns({
        "volume_zscore": C.safe_div(F.col("volume") - F.col("volume_mean"), F.col("volume_std")),
        "price_change_pct": C.pct_change("close", "prev_close"),
        "opening_gap_pct": C.pct_change("open", "prev_close"),
    }).withColumns({
        "is_volume_anomaly": F.abs("volume_zscore") > F.lit(z),
        "price_change_abs": F.abs("price_change_pct"),
        "is_gap_anomaly": F.abs("opening_gap_pct") > F.lit(gap),
    }).withColumn("is_price_anomaly", F.col("price_change_abs") > F.lit(pct))
    flag = lambda c: F.when(F.col(c), F.lit(1)).otherwise(F.lit(0))
    return (step.withColumn("anomaly_score", flag("is_volume_anomaly") + flag("is_price_anomaly")
                            + flag("is_gap_anomaly"))
            .withColumn("has_anomaly", F.col("anomaly_score") >= F.lit(min_score)))
