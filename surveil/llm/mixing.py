"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every source gets a target in words: the whole corpus is shared out by source
weight, no target exceeds ``max_epochs`` times its source, and the excess goes
to the other sources by weight.  A source first passes through completely as
often as its target allows; the rest is a weighted sample without replacement:
each document draws an exponential key ``-ln(u) / weight`` and the smallest keys
are taken until the prefix sum of the sizes reaches the remaining budget.

The prefix sums need no sort of a whole source: keys are cut into ranges, the
sizes are summed per (source, range), and only inside a range are documents
sorted.  The ranges follow the law of the keys, so a source that holds a third
of all rows is spread over all of them.  The answer does not depend on their
number.

Defined cases: a null text has size 0 and is never counted; a null source is a
source (the last one); ties and repeated rows are ordered by id and text hash;
a source of size 0 has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveil.llm.common import WORD, shuffle_partitions, stage

SEED = 42
MAX_EPOCHS = 3
#: Weight of a document by its quality label; documents without one weigh 1.
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5}


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_col: str, seed: int = SEED) -> Column:
    """A number in (0, 1) that depends on the id and the seed only."""
    digest = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(rows: DataFrame, source: str, size: str, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source_size``, ``weight`` and ``target``.

    A target is ``min(max_epochs * size, level * weight)`` with the one level
    that shares out everything.  Sorted by ``size / weight``, the capped sources
    come first, so running sums over the (small) table of sources find it.
    """
    sources = rows.groupBy(source).agg(F.sum(size).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last()))
    sources = sources.withColumn("weight", (F.pmod(place - 1, F.lit(3)) + 1).cast("double"))
    sources = sources.withColumn("_cap", F.col("source_size").cast("double") * max_epochs)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), F.col(source).asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = (sources
               .withColumn("_total", F.sum("source_size").over(whole).cast("double"))
               .withColumn("_weights", F.sum("weight").over(whole))
               .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
               .withColumn("_used", F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    level = (F.col("_total") - F.col("_capped")) / (F.col("_weights") - F.col("_used"))
    # the level of the first source that its cap does not bind; where all are bound there is none
    sources = sources.withColumn("_level", F.when(level * F.col("weight") <= F.col("_cap"), level))
    sources = sources.withColumn("_level", F.first("_level", ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap")))
    return sources.select(source, "source_size", "weight", target.alias("target"))


def mix(rows: DataFrame, key: Column, source: str = "source", size: str = "size", order_by: list[str] | None = None,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``rows`` with ``source_size``, ``target``, ``copies`` (how often the mix takes the row) and ``taken`` (words).

    ``key`` is the exponential key.  ``rows`` is read three times; stage it if it is dear.
    """
    ranges = 8 * shuffle_partitions(rows.sparkSession)
    rows = rows.withColumn("_key", key).withColumn("_range", F.floor((1 - F.exp(-F.col("_key"))) * ranges))
    targets = source_targets(rows, source, size, max_epochs)
    targets = targets.withColumn("_epochs", F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0))
    targets = targets.withColumn("_budget", F.col("target") - F.col("_epochs") * F.col("source_size"))
    ranged = rows.groupBy(source, "_range").agg(F.sum(size).alias("_sum"))
    before = Window.partitionBy(source).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    small = (ranged.alias("r").join(targets.alias("t"), F.col(f"r.{source}").eqNullSafe(F.col(f"t.{source}")))
             .select(F.col(f"r.{source}").alias("_source"), F.col("_range").alias("_of"), "_before", "source_size", "target", "_epochs", "_budget"))
    joined = rows.join(small, F.col(source).eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_of")))
    inside = Window.partitionBy("_source", "_of").orderBy("_key", *(order_by or [])).rowsBetween(Window.unboundedPreceding, 0)
    joined = joined.withColumn("_middle", F.col("_before") + F.sum(size).over(inside) - F.col(size) / 2)
    chosen = ((F.col("_middle") <= F.col("_budget")) & (F.col("_budget") > 0)).cast("long")
    joined = joined.withColumn("copies", (F.col("_epochs") + chosen).cast("long")).withColumn("taken", F.col(size) * F.col("copies"))
    return joined.drop("_key", "_range", "_source", "_of", "_before", "_epochs", "_budget", "_middle")


def quality_weight(quality: Column) -> Column:
    out = F.lit(1.0)
    for label, weight in QUALITY_WEIGHTS.items():
        out = F.when(quality == label, weight).otherwise(out)
    return out


def mix_documents(docs: DataFrame, labels: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: doc_id, source, size, tie (hash of the text), source_size, target, taken."""
    quality = labels.groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    rows = stage(rows.join(quality, "doc_id", "left"), "mix-sizes")
    key = -F.log(uniform("doc_id")) / quality_weight(F.col("_quality"))
    return mix(rows, key, order_by=["doc_id", "tie"], max_epochs=max_epochs).drop("_quality")
