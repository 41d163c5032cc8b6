"""S3/S4/S5 — case, metadata, candidate and listing readers (CSV / pipe text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.schemas import CANDIDATES, LISTING_LAYOUTS, METADATA


def normalise_cases(df: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Accept either ``d_date`` or the scraper's ``case_date`` and coerce to DATE."""
    if "d_date" not in df.columns and "case_date" in df.columns:
        df = df.withColumnRenamed("case_date", "d_date")
    if "d_date" not in df.columns or "ticker" not in df.columns:
        raise ValueError("cases need 'ticker' and 'd_date' (or 'case_date')")
    # unparsable dates become NULL (coerced), never an ANSI error
    return df.withColumn("d_date", F.try_to_date(F.col("d_date").cast("string"), date_format))


def read_cases(spark: SparkSession, path: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """S3: CSV with header; dates parsed; ``case_date`` aliased to ``d_date``."""
    return normalise_cases(spark.read.option("header", True).csv(path), date_format)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata CSV with the fixed schema (extra columns ignored; values that do not parse become NULL)."""
    raw = spark.read.option("header", True).csv(path)
    cols = []
    for field in METADATA.fields:
        if field.name in raw.columns:
            cols.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    extra = [c for c in ("label", "d_date") if c in raw.columns]
    return raw.select(*cols, *[F.col(c) for c in extra])


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(CANDIDATES).csv(path)


def parse_listing(lines: DataFrame, layout: str, value: str = "value") -> DataFrame:
    """S5 over raw pipe-delimited lines (column ``value``), in any order.

    The header is the line that starts with the layout's symbol column; the
    ``File Creation`` trailer and blank lines are dropped; the flags
    ``Test Issue``/``ETF`` are kept as columns for U2.
    """
    spec = LISTING_LAYOUTS[layout]
    is_header = F.startswith(value, F.lit(spec["symbol"] + "|"))
    header = lines.filter(is_header).agg(F.split(F.min(value), r"\|").alias("_names"))  # one row
    cells = lines.filter(~is_header & (F.trim(value) != "")).select(F.split(value, r"\|", -1).alias("_cells")).crossJoin(F.broadcast(header))
    wanted = [spec["symbol"], "Security Name", *spec["flags"]]
    cell = lambda n: F.nullif(F.try_element_at("_cells", F.nullif(F.array_position("_names", n), F.lit(0)).cast("int")), F.lit(""))
    return _listing_from_frame(cells.select(*[cell(n).alias(n) for n in wanted]), spec, layout)


def _listing_from_frame(df: DataFrame, spec: dict, layout: str) -> DataFrame:
    sym = spec["symbol"]
    if sym not in df.columns:
        raise ValueError(f"listing layout {layout!r} needs column {sym!r}")
    flags = [F.col(f"`{f}`").alias(f.lower().replace(" ", "_")) for f in spec["flags"] if f in df.columns]
    out = df.filter(~F.coalesce(F.col(f"`{sym}`").startswith("File Creation"), F.lit(False))).select(
        F.col(f"`{sym}`").alias("ticker"),
        F.col("`Security Name`").alias("security_name") if "Security Name" in df.columns else F.lit(None).cast("string").alias("security_name"),
        *flags,
        F.lit(layout).alias("source"),
    )
    return out.filter(F.col("ticker").isNotNull())


def read_listing(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Pipe text listing with a header line and a ``File Creation`` trailer."""
    raw = spark.read.option("header", True).option("sep", "|").option("nullValue", "").csv(path)
    return _listing_from_frame(raw, LISTING_LAYOUTS[layout], layout)
