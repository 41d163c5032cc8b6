"""URL filters: rules first, then logistic regression on hashed character n-grams (DataFrame functions and MLlib only).

A rule names a host and a path prefix; it fits the host and all subdomains, and
the longest fitting rule wins.  URLs that no rule fits are judged by a logistic
regression over hashed character n-grams of host and path, trained from a small
labelled table of URLs.

A short list of rules travels inside the expression, so no URL is shuffled,
whatever host is the most common one.  A longer list, or a table of rules of any
size, is joined: each distinct (host, path) probes the suffixes of its host with
the prefixes of its path that are as long as some rule's, so neither all rules of
a host nor all its URLs ever meet in one row.

Defined cases: a null URL and one without ``://`` have an empty host and path
(judged by the model's intercept); repeated rows are judged alike; null page ids
are kept; an empty table gives an empty result; extra columns are kept, but for any
named like a result, which are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.llm.common import ascii_lower, stage

ALLOW, BLOCK = "allow", "block"
NGRAMS = (2, 3, 4, 5)
DIMENSIONS = 1 << 14
#: Most labelled URLs of each verdict that the model is fitted to.
MAX_LABELLED = 1000
#: So many rules are part of the expression; more are joined.  The results are the same.
INLINE_RULES = 50


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; empty if there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as a struct (name, verdict), or null."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict))
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in reversed(ranked):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def joined_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` with ``__rule`` as ``matching_rule`` names it, from a table of rules (``verdict``, ``host``, ``path``; nulls fit nothing)."""
    known = rules.dropna(subset=["verdict", "host", "path"]).groupBy(F.col("host").alias("__on"), F.col("path").alias("__prefix")).agg(
        F.min("verdict").alias("__says"))
    lengths = known.groupBy("__on").agg(F.collect_set(F.char_length("__prefix")).alias("__lengths"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probes = urls.select("host", "path").distinct().withColumn("__on", F.explode(suffixes)).join(lengths, "__on")
    fitting = F.filter("__lengths", lambda n: n <= F.char_length("path"))
    probes = probes.withColumn("__length", F.explode(fitting)).withColumn("__prefix", F.col("path").substr(F.lit(1), F.col("__length")))
    name = F.concat("__on", "__prefix")
    ranked = F.struct((-F.char_length(name)).alias("rank"), name.alias("name"), F.col("__says").alias("verdict"))
    best = probes.join(known, ["__on", "__prefix"]).groupBy("host", "path").agg(F.min(ranked).alias("__rule"))
    # a table of its own, so that the planner knows its size and can split the join of a hot URL
    best = stage(best.withColumn("__rule", F.struct("__rule.name", "__rule.verdict")), "url-rules")
    return urls.join(best, ["host", "path"], "left").select(*urls.columns, "__rule")


def with_rules(urls: DataFrame, rules: list[Rule] | DataFrame) -> DataFrame:
    """``urls`` with ``__rule``: the longest fitting rule, or null."""
    if isinstance(rules, list) and len(rules) <= INLINE_RULES:
        return urls.withColumn("__rule", matching_rule(F.col("host"), F.col("path"), rules))
    if isinstance(rules, list):
        rules = urls.sparkSession.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    return joined_rules(urls, rules)


def char_ngrams(text: Column, tag: str) -> Column:
    """All character n-grams of a text with its ends marked, prefixed by ``tag``."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    parts = []
    for n in NGRAMS:
        starts = F.sequence(F.lit(1), F.greatest(F.char_length(marked) - (n - 1), F.lit(1)))
        parts.append(F.transform(starts, lambda i, n=n: F.concat(F.lit(tag), F.substring(marked, i, F.lit(n)))))
    return F.concat(*parts)


def _features(urls: DataFrame) -> DataFrame:
    grams = F.concat(char_ngrams(F.col("host"), "h"), char_ngrams(F.col("path"), "p"))
    hashing = HashingTF(numFeatures=DIMENSIONS, binary=True, inputCol="__grams", outputCol="__features")
    return hashing.transform(urls.withColumn("__grams", grams)).drop("__grams")


def labelled_sample(urls: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """At most ``max_labelled`` distinct (host, path, verdict) of each verdict, in hash order.

    ``weight`` is how many of its verdict a row stands for, so that the mix of the
    verdicts is that of all rows whatever the sample leaves out.
    """
    known = stage(urls.filter(F.col("verdict").isin(ALLOW, BLOCK)).select("host", "path", "verdict").distinct(), "url-verdicts")
    order = [F.xxhash64("host", "path"), "host", "path"]
    sample = known.filter(F.col("verdict") == ALLOW).orderBy(*order).limit(max_labelled).unionByName(
        known.filter(F.col("verdict") == BLOCK).orderBy(*order).limit(max_labelled))
    counts = known.groupBy("verdict").agg(F.greatest(F.count("*") / max_labelled, F.lit(1.0)).alias("weight"))
    return stage(sample.join(F.broadcast(counts), "verdict"), "url-sample")


def train(labelled: DataFrame) -> LogisticRegressionModel | None:
    """Fit the bounded labelled sample by its weights, in a fixed order so that reruns agree; None if there is nothing to fit."""
    rows = labelled.withColumn("label", (F.col("verdict") == BLOCK).cast("double"))
    rows = _features(rows).repartition(1).sortWithinPartitions("host", "path", "verdict")
    if rows.isEmpty():
        return None
    return LogisticRegression(featuresCol="__features", labelCol="label", weightCol="weight", probabilityCol="__probability", rawPredictionCol="__raw",
                              predictionCol="__prediction", maxIter=100, regParam=0.001).fit(rows)


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, url: str = "url", labelled: DataFrame | None = None,
          max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``block_score``.

    ``rules``: a list, or a table (verdict, host, path) of any size.
    ``labelled`` (host, path, verdict) trains the model; without it, the URLs
    that a rule decides do.
    """
    urls = pages.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
    urls = with_rules(urls, rules)
    ruled = labelled if labelled is not None else urls.select("host", "path", F.col("__rule.verdict").alias("verdict"))
    model = train(labelled_sample(ruled, max_labelled))
    if model is None:
        scored = urls.withColumn("block_score", F.lit(0.0))
    else:
        scored = model.transform(_features(urls)).withColumn("block_score", vector_to_array("__probability")[1])
        scored = scored.drop("__features", "__probability", "__raw", "__prediction")
    guess = F.when(F.col("block_score") >= 0.5, BLOCK).otherwise(ALLOW)
    return (scored.withColumn("rule", F.col("__rule.name"))
            .withColumn("verdict", F.coalesce(F.col("__rule.verdict"), guess)).drop("__rule"))
