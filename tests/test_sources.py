"""Readers, text and label rules."""

import datetime as dt
import html

from pyspark.sql import functions as F

from helpers import BAR_SCHEMA, day, one
from surveil import sources as src
from surveil.operators import features as feat
from surveil.operators import text as tx
from surveil.session import scratch_path
from surveil.sources.bars import clean_bars


def test_bars_with_some_values_missing_stay(spark):
    rows = [("A", day(0), 1.0, 1.0, 1.0, 1.0, None), ("A", day(1), None, None, None, None, None), ("A", day(2), None, 1.0, 1.0, 1.0, 5.0),
            (None, day(3), 1.0, 1.0, 1.0, 1.0, 1.0), ("A", None, 1.0, 1.0, 1.0, 1.0, 1.0), ("A", day(4), float("nan"), 1.0, 1.0, 1.0, 1.0)]
    got = clean_bars(spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double"))
    assert sorted(r["date"] for r in got.collect()) == [day(0), day(2), day(4)]
    assert got.filter("isnan(open)").count() == 0


def test_case_dates_follow_the_given_format(spark):
    path = scratch_path(spark, "cases")
    spark.createDataFrame([("A", "03/30/2012"), ("B", "soon")], "ticker string, case_date string").write.option("header", True).csv(path)
    got = {r["ticker"]: r["d_date"] for r in src.read_cases(spark, path, "MM/dd/yyyy").collect()}
    assert got == {"A": dt.date(2012, 3, 30), "B": None}


def test_unreadable_numbers_become_null(spark):
    path = scratch_path(spark, "meta")
    spark.createDataFrame([("A", "N/A"), ("B", "12.5")], "ticker string, market_cap string").write.option("header", True).csv(path)
    assert {r["ticker"]: r["market_cap"] for r in src.read_metadata(spark, path).collect()} == {"A": None, "B": 12.5}


def test_listing_lines_in_any_order(spark):
    lines = ["AAA|Alpha Inc|N|N|x", "File Creation Time: 0101|||", "ACT Symbol|Security Name|ETF|Test Issue|Exchange", "", "|No symbol|N|N|x", "BBB|Beta|Y||"]
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)
    got = sorted((r["ticker"], r["security_name"], r["etf"], r["test_issue"], r["source"]) for r in src.parse_listing(df, "other").collect())
    assert got == [("AAA", "Alpha Inc", "N", "N", "other"), ("BBB", "Beta", "Y", None, "other")]


def test_entities_decode_as_in_html(spark):
    texts = ["a &mdash; b", "&#8217;&#x27;&#X1F600;", "&copy; &middot;&nbsp;x", "&amp;lt; &amp;amp;", "&unknown; & &; &#; &#xZZ;", "&#150;&#128;", "no entity", "&amp",
             "", "a&b;c", "&lt;&gt;&quot;&apos;&AMP;", "&notin; x", "&#1114112;", "tail &", "&&amp;&"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", tx.decode_entities(F.col("t")).alias("t"))
    got = [r["t"] for r in df.orderBy("i").collect()]
    # only references that end in a semicolon are decoded; invalid numbers stay as written
    want = [html.unescape(t) for t in texts]
    want[4], want[7], want[12] = texts[4], texts[7], texts[12]
    assert got == want


def test_hits_without_a_document_have_no_cases(spark):
    hits = spark.createDataFrame([(1, '{"_id":"","_source":{"file_date":"2020-05-01"}}'), (2, '{"_id":"/x","_source":{"file_date":"2020-05-02"}}')], "hit_order int, hit string")
    cases = tx.build_cases(tx.document_url(tx.parse_hits(hits)).withColumn("symbols", F.array(F.lit("ZZ"))))
    assert [r["case_date"] for r in cases.collect()] == [dt.date(2020, 5, 2)]


def test_search_within_dates(spark):
    df = spark.createDataFrame([(i, "Pump and DUMP", day(i)) for i in range(5)] + [(9, "other", day(2))], "i int, text string, d date")
    got = tx.search_documents(df, "pump and dump", date_col="d", start=str(day(1)), end=str(day(3)))
    assert sorted(r["i"] for r in got.collect()) == [1, 2, 3]


def test_the_label_is_that_of_the_first_bar(spark):
    rows = [("T", dt.date(2024, 2, 1), day(i), 1.0, 1.0, 1.0, 1.0, 1.0, int(i > 0)) for i in range(8)]
    w = spark.createDataFrame(rows, BAR_SCHEMA + ", label int")
    assert one(feat.transform(w))["label"] == 0


def test_sparse_metadata_terms(spark):
    meta = spark.createDataFrame([("A", 5e8, "US", None), ("B", None, None, "CAD")], "ticker string, market_cap double, country string, currency string")
    got = {(r["ticker"], r["term"]) for r in feat.metadata_terms(meta).collect()}
    assert got == {("A", "mktcap_small"), ("A", "country_US"), ("A", "currency_unknown"), ("B", "mktcap_micro"), ("B", "country_unknown"), ("B", "currency_CAD")}
