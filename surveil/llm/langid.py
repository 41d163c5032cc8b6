"""Language identification by nearest centroid.

Texts are lower-cased, everything that is not a letter becomes a space, and the
hashed character trigrams become a TF-IDF vector of length 1 (term frequencies
damped by a logarithm).  Every language has several centroids, found by
clustering its training vectors by cosine; a text gets the language of the
closest centroid of all, and its score is that cosine.

Centroids that drew few texts of their language, or mostly texts of others, are
dropped: they stand for mixed or odd texts.

Rejection by distance: each centroid keeps the cosine that all but
``REJECT_SHARE`` of its training texts reach; a text farther from its closest
centroid than ``SLACK`` times that is reported as ``rejected``, with the
language that is still the closest.  A text without any letter is ``und``.

The model is fitted to a bounded sample of labelled rows (``max_per_language``
for each language, in hash order).  Trigram counts, clustering per language and
scoring run in tasks; the driver only sees vectors of fixed size.

Defined cases: null texts and texts without letters are ``und`` with score 0;
texts of which no trigram is known to the model have score 0; null ids are
predicted but never learned from; rows with a null language are never learned
from; repeated rows are treated alike; without training rows everything is
``und``; an empty table gives an empty result; extra columns are kept, but for any
named ``lang_pred``, ``score``, ``rejected`` or ``_found``, which are replaced or dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from surveil.llm.common import stage

UNKNOWN = "und"
BITS = 14
DIMENSIONS = 1 << BITS
CENTROIDS = 4
#: Labelled documents of each language that the model is fitted to, at most.
MAX_PER_LANGUAGE = 800
ROUNDS = 10
REJECT_SHARE = 0.01
#: A centroid is kept if it drew at least this share of its language's training texts, most of all the texts it drew.
LEAST_SHARE = 0.05
SLACK = 0.5
#: Code points that are counted at a time; trigrams do not cross such pieces.
SLICE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLANK = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def trigram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed trigrams, or None if the text has no letter."""
    counts, seen = np.zeros(DIMENSIONS, dtype=np.int64), False
    for i in range(0, len(text or ""), SLICE):
        code = np.frombuffer(text[i:i + SLICE].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letter = _letters()[code]
        if not letter.any():
            continue
        seen = True
        code = np.concatenate([[_BLANK], np.where(letter, code, _BLANK), [_BLANK]]).astype(np.uint64)
        code = code[np.concatenate([[True], (code[1:] != _BLANK) | (code[:-1] != _BLANK)])]  # one space between words
        gram = code[:-2] << np.uint64(42) | code[1:-1] << np.uint64(21) | code[2:]
        counts += np.bincount(((gram * _MIX) >> np.uint64(64 - BITS)).astype(np.int64), minlength=DIMENSIONS)
    return counts if seen else None


def unit_vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vector = np.log1p(counts) * idf
    size = np.sqrt(vector @ vector)
    return vector / size if size else vector


def cluster(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from the first vector and the farthest ones in turn."""
    centres = vectors[:1]
    while len(centres) < min(k, len(vectors)):
        nearest = (vectors @ centres.T).max(axis=1)
        if nearest.min() > 1 - 1e-9:
            break
        centres = np.vstack([centres, vectors[nearest.argmin()]])
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.vstack([vectors[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def labelled_sample(docs: DataFrame, trainable: Column, max_per_language: int = MAX_PER_LANGUAGE) -> DataFrame:
    """``doc_id``, ``lang``, ``text``, ``place``: at most ``max_per_language`` ids of each language.

    A hash below a rate that follows the language's count thins the rows where
    they are read; only those are ranked.
    """
    rows = docs.filter(trainable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    rate = stage(rows.groupBy("lang").count().select("lang", (F.lit(2.0 * max_per_language) / F.col("count")).alias("rate")), "lang-rates")
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    thin = (rows.select("doc_id", "lang", "text").join(rate, "lang").filter(spread < F.col("rate"))
            .withColumn("place", F.xxhash64("doc_id", "lang")))
    rank = F.dense_rank().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    first = F.row_number().over(Window.partitionBy("lang", "doc_id").orderBy(F.xxhash64("text")))
    thin = thin.withColumn("_first", first).filter("_first = 1").withColumn("_rank", rank)
    return thin.filter(F.col("_rank") <= max_per_language).drop("_rank", "_first", "rate")


class Model:
    """Inverse document frequencies, centroids with their languages, and the cosine below which each rejects."""

    def __init__(self, idf: np.ndarray, languages: list[str], centres: np.ndarray, limits: np.ndarray):
        self.idf, self.languages, self.centres, self.limits = idf, languages, centres, limits

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = trigram_counts(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, True
        at = np.flatnonzero(counts)
        weights = np.log1p(counts[at]) * self.idf[at]
        size = np.sqrt(weights @ weights)
        cosine = self.centres[:, at] @ weights / size if size else np.zeros(len(self.languages))
        best = int(cosine.argmax())
        return self.languages[best], float(min(max(cosine[best], 0.0), 1.0)), bool(cosine[best] < self.limits[best])


def train(docs: DataFrame, trainable: Column, max_per_language: int = MAX_PER_LANGUAGE, k: int = CENTROIDS) -> Model:
    sample = labelled_sample(docs, trainable, max_per_language)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [trigram_counts(t) for t in pdf["text"]]
            at = [np.flatnonzero(c) if c is not None else np.zeros(0, dtype=int) for c in got]
            yield pd.DataFrame({"lang": pdf["lang"], "place": pdf["place"], "doc_id": pdf["doc_id"], "slots": [a.tolist() for a in at],
                                "found": [c[a].tolist() if c is not None else [] for c, a in zip(got, at)]})

    rows = stage(sample.mapInPandas(counted, "lang string, place long, doc_id long, slots array<int>, found array<int>")
                 .filter(F.size("slots") > 0), "lang-sample")
    n = rows.count()
    frequency = np.zeros(DIMENSIONS)
    for slot, c in rows.select(F.explode("slots").alias("slot")).groupBy("slot").count().collect():  # DIMENSIONS rows at most
        frequency[slot] = c
    idf = np.where(frequency > 0, np.log((n + 1) / (frequency + 1)) + 0.1, 0.0)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "doc_id"])
        vectors = np.zeros((len(pdf), DIMENSIONS), dtype=np.float32)
        for row, (slots, found) in zip(vectors, zip(pdf["slots"], pdf["found"])):
            slots = np.asarray(slots, dtype=np.int64)
            row[slots] = np.log1p(np.asarray(found)) * idf[slots]
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        centres = cluster(vectors, k)
        cosine = vectors @ centres.T
        own = cosine.argmax(axis=1)
        limits = [SLACK * float(np.quantile(cosine[own == j, j], REJECT_SHARE)) if (own == j).any() else 0.0 for j in range(len(centres))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "number": range(len(centres)),
                             "centre": [c.astype(np.float32).tobytes() for c in centres], "least": limits})

    fitted = rows.groupBy("lang").applyInPandas(fit, "lang string, number int, centre binary, least double")
    found = fitted.orderBy("lang", "number").collect()  # k vectors of fixed size a language
    found = [found[i] for i in _sound(rows, found, idf)]
    centres = np.array([np.frombuffer(r["centre"], dtype=np.float32) for r in found]).reshape(len(found), DIMENSIONS)
    return Model(idf, [r["lang"] for r in found], centres, np.array([r["least"] for r in found]))


def _sound(rows: DataFrame, found: list, idf: np.ndarray) -> list[int]:
    """The places of the centroids to keep, at least one for each language, by the training texts that each draws."""
    languages = [r["lang"] for r in found]
    centres = np.array([np.frombuffer(r["centre"], dtype=np.float32) for r in found]).reshape(len(found), DIMENSIONS)

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            best = []
            for slots, counts in zip(pdf["slots"], pdf["found"]):
                slots = np.asarray(slots, dtype=np.int64)
                best.append(int((centres[:, slots] @ (np.log1p(np.asarray(counts)) * idf[slots])).argmax()))
            yield pd.DataFrame({"lang": pdf["lang"], "best": best})

    if not found:
        return []
    draws = {(r["best"], r["lang"]): r["count"] for r in
             rows.mapInPandas(drawn, "lang string, best int").groupBy("best", "lang").count().collect()}
    sizes = {lang: sum(n for (_, of), n in draws.items() if of == lang) for lang in languages}
    own = [draws.get((i, lang), 0) for i, lang in enumerate(languages)]
    whole = [sum(n for (j, _), n in draws.items() if j == i) for i in range(len(found))]
    good = [2 * own[i] > whole[i] and own[i] >= LEAST_SHARE * sizes[lang] for i, lang in enumerate(languages)]
    best = {lang: max((i for i, of in enumerate(languages) if of == lang), key=own.__getitem__) for lang in languages}
    return [i for i, lang in enumerate(languages) if good[i] or i == best[lang]]


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double, rejected boolean")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return docs.withColumn("_found", predicted(F.col(text))).withColumns(
        {c: F.col(f"_found.{c}") for c in ("lang_pred", "score", "rejected")}).drop("_found")
