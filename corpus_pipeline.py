"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame.  ``run`` applies them to the documents table; each stage's
result is written as Parquet to the cluster's shared folder and read again as
the next stage's input, so a lost executor never reaches back over a stage.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.llm import decontaminate, mixing, quality, sharding, simhash
from surveil.llm.common import bound_batches, join_decisions, stage, table, with_row_key
from surveil.llm.queries import N_SHARDS, held_out
from surveil.session import ensure_checkpoint_dir, ship_package

#: The quality classifier and the trained steps cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    bound_batches(spark)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.3)."""
    _ready(spark)
    weights = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out(5, 0))
    return quality.score(docs, weights, into="__score").filter(F.col("__score") >= quality.THRESHOLD).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id (of repeated rows, one)."""
    _ready(spark)
    rows = with_row_key(docs).select("doc_id", "__tie", "__id", simhash.fingerprint_column(F.col("text")).alias("fp"))
    grouped = simhash.near_duplicates(stage(rows, "pipeline-fingerprints"))
    first = grouped.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = first.groupBy("root").agg(F.min(F.struct("__tie", "__id")).alias("k")).select("k.*").distinct()
    return join_decisions(docs, stays).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: hit spans are cut out, documents that are mostly benchmark go."""
    _ready(spark)
    return decontaminate.decontaminate(docs, decontaminate.build_blocks(table(spark, sf_dir, "benchmark")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target takes it (0 to 3 times)."""
    _ready(spark)
    rows = with_row_key(docs).select("doc_id", "__tie", "__id", "source", mixing.word_count(F.col("text")).alias("size"))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    rows = stage(rows.join(labels, "doc_id", "left"), "pipeline-sizes")
    key = -F.log(mixing.uniform("doc_id")) / mixing.quality_weight(F.col("_quality"))
    mixed = mixing.mix(rows, key, order_by=["doc_id", "__tie"])
    times = mixed.groupBy("__tie", "__id").agg(F.sum("copies").alias("__copies")).filter("__copies > 0")
    taken = join_decisions(docs, times).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return taken.select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its ``shard`` (0 to 15) and ``slot``; columns of these names are replaced."""
    _ready(spark)
    return sharding.shard_rows(docs, N_SHARDS)


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("decontaminate", decontamination_stage),
    ("mix", mixing_stage),
    ("shard", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    _ready(spark)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
