"""Fixed schemas of the tables the operators exchange."""

from pyspark.sql import types as T

BAR_VALUE_COLS = ["open", "high", "low", "close", "volume"]

BARS = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

CASES = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("d_date", T.DateType()),
    T.StructField("case_type", T.StringType()),
    T.StructField("scheme_description", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("notes", T.StringType()),
])

SCRAPED_CASES = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("case_date", T.DateType()),
    T.StructField("case_url", T.StringType()),
])

CANDIDATES = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("security_name", T.StringType()),
    T.StructField("source", T.StringType()),
])

METADATA = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("quote_type", T.StringType()),
    T.StructField("short_name", T.StringType()),
])

SEARCH_HIT = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("_source", T.StructType([
        T.StructField("file_date", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("display_names", T.ArrayType(T.StringType())),
        T.StructField("entity_names", T.ArrayType(T.StringType())),
    ])),
])

# listing layouts: source column -> normalised column
LISTING_LAYOUTS = {
    "nasdaq": {"symbol": "Symbol", "flags": ["Test Issue", "ETF"]},
    "other": {"symbol": "ACT Symbol", "flags": ["Test Issue", "ETF"]},
}
