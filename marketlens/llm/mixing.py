"""Mixing sources to target weights: capped water-filling.

Sizes are word counts.  The mix's budget (a share of all words) is split over
the sources by weight; a source is clamped at ``max_epochs`` times its own
size and the excess goes to the others by weight until none is above.  In
closed form: order the sources by cap / weight; those before the first one
whose share of the remaining budget fits under its cap are clamped, the rest
share by weight.

Sampling: a source at rate r = target / size takes every document floor(r)
times, and once more the documents that come first in a seeded hash order
until the fractional part of the rate is reached (the document across the
boundary is taken if at least half of it lies before it), so that the words
taken differ from the target by half a document at most.  Ordering a source
needs no single task: documents go to hash bins, bins are summed, and a
document's place is its bin's offset plus the running sum within the bin.

Nulls: a null text has no words; the null source is a source of its own, last
in order.  Documents without words take nothing.  Rows that repeat a doc_id
are ordered by size.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.llm.common import fresh_names, numbered
from marketlens.session import materialize

WEIGHTS = (5, 2, 1)      # by source in code-point order, repeating
BUDGET = 1.5             # of all words
MAX_EPOCHS = 2
SEED = "mix-1"
ROWS_PER_BIN = 5_000
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> with ``target``.  One row per source, so the
    windows below see as many rows as there are sources."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("total", F.lit(float(budget)) * F.sum("source_size").over(everything))
         .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("rest", F.sum("weight").over(after))
         .withColumn("fits", F.col("cap") * F.col("rest") >= F.col("weight") * F.col("left"))
         .withColumn("open", F.max(F.col("fits").cast("int")).over(by_level.rowsBetween(Window.unboundedPreceding, 0))))
    # the level is that of the first source that fits
    first = F.first(F.when(F.col("fits"), F.struct("left", "rest")), ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, 0))
    s = s.withColumn("level", first)
    target = F.when(F.col("open") == 1, F.col("weight") * F.col("level.left") / F.col("level.rest")).otherwise(F.col("cap"))
    return s.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document; taken counts
    the words of all its copies in the mix."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.lit(None).cast("long").alias("row"),
                        F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")).alias("h"))
    return _taken(materialize(sized, "mix-sizes"), weights, budget, max_epochs, rows_per_bin).select(
        "doc_id", "size", "source_size", "target", "taken")


def _taken(sized: DataFrame, weights, budget: float, max_epochs: int, rows_per_bin: int,
           split: bool = False) -> DataFrame:
    """(row, doc_id, size, source_size, target, taken) of written (row,
    doc_id, source, size, hash) rows."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    planned = targets(sources.select("source", "source_size"), weights, budget, max_epochs)
    planned = (planned.join(sources.select(F.col("source").alias("s"), "rows"), F.col("source").eqNullSafe(F.col("s")))
               .withColumn("whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long"))
               .withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size"))
               .withColumn("bins", F.ceil(F.col("rows") / rows_per_bin).cast("long"))
               .select("source", "source_size", "target", "whole", "quota", "bins"))
    planned = materialize(planned, "mix-plan")
    plan = planned.withColumnRenamed("source", "s")
    # the leading 32 bits of the hash as a fraction choose the bin, so bins follow hash order
    lead = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    placed = (sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
              .withColumn("bin", F.floor(lead * F.col("bins"))))
    if split:  # rows of one doc_id share a hash: over-full bins are cut by row number
        full = placed.groupBy(F.col("source").alias("s"), F.col("bin").alias("b")).agg(
            F.ceil(F.count(F.lit(1)) / (4 * rows_per_bin)).cast("long").alias("parts"))
        placed = (placed.join(full, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))).drop("s", "b")
                  .withColumn("sub", F.pmod(F.xxhash64("row"), F.col("parts"))))
    else:
        placed = placed.withColumn("sub", F.lit(0).cast("long"))
    bins = placed.groupBy("source", "bin", "sub").agg(F.sum("size").alias("bin_size"))
    running = Window.partitionBy("source").orderBy("bin", "sub").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(F.col("source").alias("s"), F.col("bin").alias("b"), F.col("sub").alias("u"),
                       F.coalesce(F.sum("bin_size").over(running), F.lit(0)).alias("before"))
    inside = (Window.partitionBy("source", "bin", "sub").orderBy("h", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    taken = (placed.withColumn("in_bin", F.coalesce(F.sum("size").over(inside), F.lit(0)))
             .join(bins, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))
                   & (F.col("sub") == F.col("u"))))
    extra = (F.col("before") + F.col("in_bin") + F.col("size") / 2 <= F.col("quota")).cast("long")
    return taken.select("row", "doc_id", "size", "source_size", "target",
                        (F.col("size") * (F.col("whole") + F.when(F.col("size") > 0, extra).otherwise(0))).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS,
                    seed: str = SEED, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; rows without
    words, which weigh nothing, once.  A bin that rows of one doc_id fill is
    cut by row number.  All columns are kept, whatever their names; texts are
    not shuffled."""
    rows = numbered(docs, "mix")
    sized = rows.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                        F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")).alias("h"))
    taken = _taken(materialize(sized, "mix-sizes"), weights, budget, max_epochs, rows_per_bin, split=True)
    times, copy = fresh_names(docs, "times", "copy")
    times_of = F.when(F.col("size") > 0, F.expr("taken div greatest(size, 1)")).otherwise(F.lit(1))
    found = taken.select("row", times_of.cast("int").alias(times)).where(F.col(times) > 0)
    out = rows.join(found).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return out.select(*docs.columns)


def oracle_sql() -> str:
    """The same mix in DuckDB, one window per source instead of bins."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}' || coalesce('|' || doc_id::VARCHAR, '')) AS h FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([{', '.join(f'{w}.0::DOUBLE' for w in WEIGHTS)}])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (source_size * {MAX_EPOCHS})::DOUBLE AS cap FROM sources),
filled AS (
  SELECT *, {BUDGET}::DOUBLE * (sum(source_size) OVER ())::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS n
  FROM levels),
level AS (
  SELECT n AS first_n, remaining AS l, rest AS r FROM filled WHERE cap * rest >= weight * remaining ORDER BY n LIMIT 1),
planned AS (
  SELECT source, source_size, CASE WHEN first_n IS NOT NULL AND n >= first_n THEN weight * l / r ELSE cap END AS target
  FROM filled LEFT JOIN level ON true),
rated AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM planned),
placed AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS quota,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN rated p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN size > 0 AND before + size / 2.0 <= quota THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed"""
