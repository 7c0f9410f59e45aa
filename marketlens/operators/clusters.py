"""Symbol clustering (M1-M4) and cluster distribution (A4).

Symbol profiles (one row per series) become three features, rows with an
invalid one skipped; features are standardised to mean 0 / sd 1 and clustered
by k-means.  Every step is a function of the set of rows, not of their order
or partitions:

* the first centre is the row with the smallest keyed hash; each further one
  is drawn with probability in proportion to its squared distance from the
  centres so far (the largest ``ln(u) / d2``, u the row's keyed hash in (0, 1]),
* centres move to exactly summed means (whole-number parts of the doubles),
* a row equally near to two centres joins the first.

Cluster ids are the order of the draws and mean nothing (B11), so centroids
are ranked by (volatility, return) in scaled space and descriptions are bound
to ranks.  Only the k centres reach the driver (model parameters); rows are
written once and each round is one scan with a partial aggregate of k groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import exact
from marketlens.session import materialize

FEATURES = ("avg_daily_return", "price_volatility", "avg_volume")
ROUNDS = 20             # moves of the centres, fewer once they stand still
HASH_DIGITS = 12        # hexadecimal digits of a row's keyed hash

# Cluster descriptions, from the least to the most volatile
# centroid (M4).
DESCRIPTIONS = ("Blue Chip, Stable", "Low Risk, Low Return", "Stable, Moderate Return",
                "High Risk, High Return", "Volatile, Speculative")


def features(profile: DataFrame) -> DataFrame:
    """P25: the clustering features; rows without one of them, or without a
    symbol or exchange, are dropped."""
    return profile.select("symbol", "exchange", *FEATURES).dropna()


def scaled_features(profile: DataFrame) -> DataFrame:
    """M1 + M2: (symbol, exchange, ``_z`` array of standardised features)."""
    feats = features(profile)
    steps = [VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="skip"),
             StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)]
    out = Pipeline(stages=steps).fit(feats).transform(feats)
    return out.select("symbol", "exchange", vector_to_array("scaled").alias("_z"))


# --- k-means (M3) ------------------------------------------------------------

def _exact_sum(x) -> Column:
    """Exact sum of doubles of a group, in any order and of any size: the
    parts are added as decimals, which hold 10^18 rows."""
    return exact.joined([F.sum(part.cast("decimal(20,0)")) for part in exact.limbs(x)])


def _means(names) -> list[Column]:
    return [(_exact_sum(n) / F.count(F.lit(1))).alias(n) for n in names]


def _standardised(feats: DataFrame) -> DataFrame:
    """``feats`` with ``_z0``.. (0 where a feature is constant), by exactly
    summed moments."""
    m = feats.agg(F.count(F.lit(1)).alias("n"), *_means(FEATURES)).first()
    centred = feats.select("*", *[(F.col(f) - F.lit(m[f])).alias(f"_c{i}") for i, f in enumerate(FEATURES)])
    s = centred.agg(*[_exact_sum(F.col(f"_c{i}") * F.col(f"_c{i}")).alias(f"s{i}")
                      for i in range(len(FEATURES))]).first()
    sd = [(s[f"s{i}"] / (m["n"] - 1)) ** 0.5 if m["n"] > 1 else 0.0 for i in range(len(FEATURES))]
    return centred.select(*feats.columns, *[(F.col(f"_c{i}") / F.lit(d) if d else F.lit(0.0)).alias(f"_z{i}")
                                            for i, d in enumerate(sd)])


def _distance(centre) -> Column:
    """Squared distance of a row from one centre."""
    gaps = [F.col(f"_z{i}") - F.lit(c) for i, c in enumerate(centre)]
    total = gaps[0] * gaps[0]
    for g in gaps[1:]:
        total = total + g * g
    return total


def _nearest(centres) -> Column:
    """Number of the nearest centre, the first of equally near ones."""
    return F.expr("aggregate(_d, struct(0 AS at, 0 AS i, _d[0] AS low), (a, d) -> struct("
                  "if(d < a.low, a.i, a.at) AS at, a.i + 1 AS i, if(d < a.low, d, a.low) AS low), a -> a.at)"
                  ) if len(centres) > 1 else F.lit(0)


def _row_hash(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), "exchange", "symbol").cast("binary"))


def _seeds(rows: DataFrame, k: int, seed: int) -> list[list[float]]:
    """k rows as first centres; fewer if there are fewer different rows."""
    z = [f"_z{i}" for i in range(len(FEATURES))]
    point = F.array(*z)
    order = [F.col("exchange"), F.col("symbol"), *map(F.col, z)]
    first = rows.agg(F.min_by(point, F.struct(_row_hash(seed), *order)).alias("p")).first()["p"]
    centres = [first] if first is not None else []
    u = ((F.conv(F.substring(_row_hash(seed), 1, HASH_DIGITS), 16, 10).cast("bigint") + 1).cast("double")
         / F.lit(float(16 ** HASH_DIGITS)))
    while centres and len(centres) < k:
        d = F.least(*map(_distance, centres)) if len(centres) > 1 else _distance(centres[0])
        far = rows.select(*z, "exchange", "symbol", d.alias("_d2")).where("_d2 > 0")
        pick = far.agg(F.min_by(point, F.struct(-F.ln(u) / F.col("_d2"), *order)).alias("p")).first()["p"]
        if pick is None:
            break
        centres.append(pick)
    return centres


@dataclass
class Clusters:
    """A fitted model: the scaled rows (written), the centres in scaled space
    in the order of their ids, and the rank of each."""

    rows: DataFrame
    centres: list[list[float]]

    def ranks(self) -> list[int]:
        """M4: rank per id, by (volatility, return)."""
        order = sorted(range(len(self.centres)), key=lambda i: (self.centres[i][1], self.centres[i][0], i))
        return [order.index(i) for i in range(len(order))]

    def assigned(self) -> DataFrame:
        """The rows with ``cluster``, the id of the nearest centre."""
        d = F.array(*map(_distance, self.centres)) if self.centres else F.array(F.lit(0.0))
        return self.rows.withColumn("_d", d).withColumn("cluster", _nearest(self.centres)).drop("_d")


def fit_clusters(profile: DataFrame, k: int = 5, seed: int = 42, rounds: int = ROUNDS) -> Clusters:
    """M1-M3: the model of all valid rows of ``profile`` (finite features
    below 1e21).  A centre without rows stays where it is; an empty profile
    has no centres."""
    feats = features(profile)
    for f in FEATURES:
        feats = feats.where(F.abs(F.col(f).cast("double")) < F.lit(exact.LARGEST))
    feats = materialize(feats, "cluster-features")
    if feats.isEmpty():
        return Clusters(feats.select("*", *[F.lit(0.0).alias(f"_z{i}") for i in range(len(FEATURES))]), [])
    rows = materialize(_standardised(feats), "cluster-rows")
    z = [f"_z{i}" for i in range(len(FEATURES))]
    model = Clusters(rows, [list(c) for c in _seeds(rows, k, seed)])
    for _ in range(rounds):
        moved = {r["cluster"]: [r[c] for c in z] for r in model.assigned().groupBy("cluster").agg(*_means(z)).collect()}
        centres = [moved.get(i, c) for i, c in enumerate(model.centres)]
        if centres == model.centres:
            break
        model = Clusters(rows, centres)
    return model


def cluster_symbols(profile: DataFrame, k: int = 5, seed: int = 42,
                    descriptions=DESCRIPTIONS) -> DataFrame:
    """M1-M4: (cluster, symbol, exchange, features..., cluster_rank,
    cluster_description)."""
    model = fit_clusters(profile, k, seed)
    ranks = model.ranks() or [0]
    texts = [descriptions[min(r, len(descriptions) - 1)] for r in ranks]
    at = F.col("cluster") + 1
    return model.assigned().select(
        "cluster", "symbol", "exchange", *FEATURES,
        F.element_at(F.array(*map(F.lit, ranks)), at).alias("cluster_rank"),
        F.element_at(F.array(*map(F.lit, texts)), at).alias("cluster_description"))


def cluster_distribution(clustered: DataFrame) -> DataFrame:
    """A4: symbols per cluster and description."""
    return (clustered.groupBy("cluster", "cluster_rank", "cluster_description")
            .agg(F.count(F.lit(1)).alias("n_rows")))
