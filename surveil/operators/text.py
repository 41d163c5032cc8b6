"""A1–A6 — case sourcing from a corpus: HTML to text, symbol extraction, hits, cases.

Each operator is a column expression over whole documents (``regexp_replace``,
``regexp_extract_all``, higher-order array functions, ``from_json``); the only
shuffle is the final de-duplication of ``(ticker, case_date)``.
"""

from __future__ import annotations

import html.entities
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.functions.constants import DOCUMENT_BASE_URL, TICKER_PATTERNS, TICKER_STOPWORDS
from surveil.schemas import SEARCH_HIT

#: Code points that numeric references between 128 and 159 stand for (as in windows-1252).
_C1 = {n: bytes([n]).decode("cp1252") for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def _named_entities() -> Column:
    """All named character references of HTML that end in a semicolon, as a map column."""
    names = sorted((k[:-1], v) for k, v in html.entities.html5.items() if k.endswith(";"))
    keys, values = zip(*names)
    return F.map_from_arrays(F.split(F.lit("\u0001".join(keys)), "\u0001"), F.split(F.lit("\u0001".join(values)), "\u0001"))


def decode_entities(text: Column) -> Column:
    """Decode named, decimal and hexadecimal character references; unknown ones stay as they are.

    The text is cut at ``&`` and every piece is decoded once, so ``&amp;lt;`` becomes ``&lt;``.
    """
    named = _named_entities()
    c1 = F.create_map(*[F.lit(x) for pair in _C1.items() for x in pair])

    def one(piece: Column) -> Column:
        body = F.substring_index(piece, ";", 1)
        rest = F.substring(piece, F.char_length(body) + 2, F.char_length(piece))
        number = F.when(body.rlike(r"^#[0-9]{1,7}$"), F.substring(body, 2, 7).cast("long")).when(
            body.rlike(r"^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(body, 3, 6), 16, 10).cast("long"))
        valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        spelt = F.coalesce(F.try_element_at(c1, number.cast("int")), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        char = F.when(valid, spelt).when(F.startswith(body, F.lit("#")), F.lit(None)).otherwise(F.try_element_at(named, body))
        known = F.contains(piece, F.lit(";")) & char.isNotNull()
        return F.when(known, F.concat(char, rest)).otherwise(F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&", -1)
    decoded = F.concat(F.element_at(pieces, 1), F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one), ""))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def html_to_text(df: DataFrame, col: str = "html", out: str = "text") -> DataFrame:
    """A1: drop script/style/template bodies, comments and declarations; tags → ``' '``; decode entities."""
    x: Column = F.col(col)
    for tag in ("script", "style", "template"):
        x = F.regexp_replace(x, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    x = F.regexp_replace(x, r"(?s)<!--.*?-->", " ")
    x = F.regexp_replace(x, r"(?s)<![^>]*>", " ")
    x = F.regexp_replace(x, r"(?s)<[^>]*>", " ")
    return df.withColumn(out, x).withColumn(out, decode_entities(F.col(out)))


def extract_symbols(
    df: DataFrame,
    text_col: str = "text",
    patterns: Sequence[str] = TICKER_PATTERNS,
    stopwords: Sequence[str] = TICKER_STOPWORDS,
    max_len: int = 5,
    ignore_case: bool = True,
    out: str = "symbols",
) -> DataFrame:
    """A2: per document, the sorted distinct upper-cased first groups of every pattern, minus stopwords.

    ``ignore_case`` reproduces the reference quirk that ``[A-Z]`` then also
    matches lower-case words.
    """
    flag = "(?i)" if ignore_case else ""
    found = [F.regexp_extract_all(F.col(text_col), F.lit(flag + p), 1) for p in patterns]
    allm = F.flatten(F.array(*found)) if found else F.array().cast("array<string>")
    stop = F.array(*[F.lit(s) for s in stopwords]) if stopwords else F.array().cast("array<string>")
    cleaned = F.filter(F.transform(allm, lambda s: F.upper(s)), lambda s: (F.length(s) >= 1) & (F.length(s) <= max_len))
    return df.withColumn(out, F.array_sort(F.array_distinct(F.array_except(cleaned, stop))))


def extract_tokens(
    df: DataFrame,
    text_col: str = "text",
    token: str = r"[A-Z]{2,5}",
    stopwords: Sequence[str] = TICKER_STOPWORDS,
    out: str = "symbols",
) -> DataFrame:
    """A2 variant: whole ASCII words matching ``token`` (word = run of ``[A-Za-z0-9_]``)."""
    words = F.split(F.col(text_col), r"[^A-Za-z0-9_]+")
    hits = F.filter(words, lambda w: w.rlike(f"^(?:{token})$"))
    stop = F.array(*[F.lit(s) for s in stopwords]) if stopwords else F.array().cast("array<string>")
    return df.withColumn(out, F.array_sort(F.array_distinct(F.array_except(hits, stop))))


def search_documents(df: DataFrame, phrase: str, text_col: str = "text", date_col: str | None = None,
                     start: str | None = None, end: str | None = None) -> DataFrame:
    """A3: documents containing ``phrase`` (case-insensitive), optionally within ``[start, end]``."""
    cond = F.lower(F.col(text_col)).contains(phrase.lower())
    if date_col and start:
        cond = cond & (F.col(date_col) >= F.lit(start).cast("date"))
    if date_col and end:
        cond = cond & (F.col(date_col) <= F.lit(end).cast("date"))
    return df.filter(cond)


def parse_hits(df: DataFrame, json_col: str = "hit") -> DataFrame:
    """A4: ``_id``, ``file_date``, ``file_path`` and company = first display name, else first entity name, else ''."""
    h = F.from_json(F.col(json_col), SEARCH_HIT)
    src = h["_source"]
    first_nonempty = F.coalesce(
        F.when(F.size(src["display_names"]) > 0, F.try_element_at(src["display_names"], F.lit(1))),
        F.when(F.size(src["entity_names"]) > 0, F.try_element_at(src["entity_names"], F.lit(1))),
        F.lit(""),
    )
    return df.select(
        "*",
        h["_id"].alias("hit_id"),
        src["file_date"].alias("file_date"),
        src["file_path"].alias("file_path"),
        first_nonempty.alias("company"),
    )


def document_url(df: DataFrame, base: str = DOCUMENT_BASE_URL, out: str = "case_url") -> DataFrame:
    """A5: ``file_path`` (else ``hit_id``), prefixed with ``base`` unless it already starts with ``http``."""
    path = F.coalesce(F.nullif(F.col("file_path"), F.lit("")), F.col("hit_id"), F.lit(""))
    url = F.when(path == "", F.lit("")).when(path.startswith("http"), path).otherwise(F.concat(F.lit(base), path))
    return df.withColumn(out, url)


def build_cases(df: DataFrame, symbols_col: str = "symbols", order_col: str = "hit_order") -> DataFrame:
    """One row per symbol; first hit per ``(ticker, case_date)``; sorted by date.

    Unparsable dates are dropped, and so are hits without a document URL: there is no document to find symbols in.
    """
    rows = df.filter(F.coalesce(F.col("case_url"), F.lit("")) != "").select(
        F.explode(F.col(symbols_col)).alias("ticker"),
        "company",
        F.try_to_date(F.col("file_date")).alias("case_date"),
        "case_url",
        F.col(order_col).alias("_o"),
    ).filter(F.col("case_date").isNotNull())
    # first hit per (ticker, case_date) as a partial aggregate (hot keys reduce map-side)
    first = rows.groupBy("ticker", "case_date").agg(
        F.min_by(F.struct("company", "case_url"), F.struct("_o", "case_url", "company")).alias("_b")
    ).select("ticker", F.col("_b.company").alias("company"), "case_date", F.col("_b.case_url").alias("case_url"))
    return first.orderBy("case_date", "ticker")
