"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveil.session import stage_table as stage  # noqa: F401

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
#: A word of the whitespace tokenisation (Java regular expression).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


#: Rows of texts that a Python worker is sent at a time, unless the session says otherwise.
BATCH_ROWS = "1000"


def bound_batches(spark: SparkSession) -> None:
    """Lower Spark's default number of rows in an Arrow batch, which is meant for numbers, to one for texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, BATCH_ROWS)


def with_ids(rows: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with their ``__id`` (ids travel to Python as text, as pandas turns longs with nulls into floats) as in ``docs``."""
    return rows.withColumn("__id", F.col("__id").cast(docs.schema[id_col].dataType)).withColumnRenamed("__id", id_col)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------------------
# Decisions per row (columns that start with two underscores are ours).  A row is named by the hash of all its columns and its id;
# rows that agree in both are repeats of one another.
# ---------------------------------------------------------------------------

ROW_KEY = ["__tie", "__id"]


def with_row_key(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.withColumn("__tie", F.xxhash64(*docs.columns)).withColumn("__id", F.coalesce(id_col, F.lit(-1)))


def join_decisions(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One of the rows of ``docs`` for every row key in ``decisions`` (unique by ``ROW_KEY``), with its other columns."""
    joined = with_row_key(docs, id_col).join(decisions, ROW_KEY)
    first = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy("__id"))
    return joined.withColumn("__first", first).filter("__first = 1").drop("__first", *ROW_KEY)
