"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text is read as words and punctuation runs.  Its features are the hashed 1-
and 2-grams of the words and the 1- to 3-grams of their shapes (lower case,
title case, upper case, digits, the punctuation run itself, same word again), with
their share of all n-grams as value.  The score is the logistic function of the
sparse dot product with the weights.

Training runs on a bounded sample of the labelled rows (``max_labelled`` in hash
order, both labels at one rate, so that their mix does not change with the table).  The sample is dealt over ``shards`` tasks; each
makes ``epochs`` FTRL passes and the weights are averaged.  Only the weight
vector, of fixed size, comes to the driver and is broadcast.

Defined cases: null and empty texts score by the intercept; rows with a null id
are scored but never trained on; ids with contradicting or null labels are not
trained on; repeated rows score alike; an empty table, or one without labels of
both kinds, gives score 0.5; extra columns are kept, but for one named like the score,
which is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

BITS = 18
DIMENSIONS = 1 << BITS
#: Labelled documents that the model is fitted to, at most.
MAX_LABELLED = 6000
SHARDS = 4
EPOCHS = 3
#: Follow-the-regularised-leader: learning rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.5
#: Value of a feature that makes up all n-grams of a text.
SCALE = 30.0
THRESHOLD = 0.3
#: Code points that are read at a time; n-grams do not cross such pieces.
SLICE = 1 << 20
CACHE = 100_000

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_SAME, _PUNCTUATION = 6, 7
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(token: str) -> int:
    """1 lower case, 2 title case, 3 upper case, 4 digits, 5 anything else."""
    return 1 if token.islower() else 4 if token.isdigit() else 3 if token.isupper() and len(token) > 1 else 2 if token[0].isupper() else 5


class _Codes(dict):
    """token -> hash of its lower-cased form << 8 | shape."""

    def __missing__(self, token: str) -> int:
        h = zlib.crc32(token.lower().encode("utf-8", "surrogatepass"))
        word = token[0].isalnum() or token[0] == "_"
        # a punctuation run has the shape 8 + its hash: "!!" and "###" differ, the shape says what is written
        code = self[token] = h << 8 | (_shape(token) if word else _PUNCTUATION + 1 + h % 240)
        return code


def _slots(grams: np.ndarray, salt: int) -> np.ndarray:
    return ((grams + np.uint64(salt)) * _MIX) >> np.uint64(64 - BITS)


def ngram_slots(text: str | None, codes: dict[str, int]) -> Iterator[np.ndarray]:
    """The hashed n-grams of a text, repeats included, piece by piece."""
    for i in range(0, len(text or ""), SLICE):
        code = np.array([codes[t] for t in _TOKEN.findall(text[i:i + SLICE])], dtype=np.uint64)
        if not len(code):
            continue
        word, shape = code >> np.uint64(8), code & np.uint64(255)
        shape[1:][(word[1:] == word[:-1]) & (shape[1:] <= 5)] = _SAME
        pair = word[:-1] * np.uint64(1000003) + word[1:]
        two = shape[:-1] << np.uint64(8) | shape[1:]
        three = two[:-1] << np.uint64(8) | shape[2:]
        yield np.concatenate([_slots(word, 1), _slots(pair, 2), _slots(shape, 3), _slots(two, 4), _slots(three, 5)]).astype(np.int64)


def sparse_vector(text: str | None, codes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and their values."""

    found = [np.unique(s, return_counts=True) for s in ngram_slots(text, codes)]
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    slots, places = np.unique(np.concatenate([s for s, _ in found]), return_inverse=True)
    values = np.bincount(places, weights=np.concatenate([c for _, c in found]))
    return slots, values * (SCALE / values.sum())


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the intercept) after ``epochs`` passes over the rows in their order."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(epochs):
        for slots, values, label in rows:
            at, x = np.append(slots, DIMENSIONS), np.append(values, 1.0)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(np.arange(DIMENSIONS + 1))


def labelled_sample(docs: DataFrame, labels: DataFrame, trainable: Column, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``label``, ``text`` and ``place`` (hash order) of the bounded training sample."""
    agreed = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id")
              .agg(F.min("quality").alias("label"), F.max("quality").alias("_high")).filter("label = _high").drop("_high")
              .filter(trainable).withColumn("place", F.xxhash64("doc_id")))
    # at most max_labelled rows: a bounded broadcast
    ids = agreed.orderBy("place", "doc_id").limit(max_labelled)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def train(docs: DataFrame, labels: DataFrame, trainable: Column, max_labelled: int = MAX_LABELLED, shards: int = SHARDS,
          epochs: int = EPOCHS) -> np.ndarray:
    """The averaged weights of the shards' models.  ``trainable`` is a condition on ``doc_id``."""
    sample = labelled_sample(docs, labels, trainable, max_labelled)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = _Codes()
        for pdf in batches:
            got = [sparse_vector(t, codes) for t in pdf["text"]]
            yield pd.DataFrame({"shard": pdf["place"] % shards, "place": pdf["place"], "doc_id": pdf["doc_id"], "label": pdf["label"],
                                "slots": [s.tolist() for s, _ in got], "found": [v.tolist() for _, v in got]})
            if len(codes) > CACHE:
                codes.clear()

    rows = sample.mapInPandas(vectors, "shard long, place long, doc_id long, label int, slots array<int>, found array<double>")
    # repeated rows of a sampled id count once, which keeps the sample bounded
    rows = rows.dropDuplicates(["doc_id"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "doc_id"])
        model = ftrl([(np.asarray(s, dtype=np.int64), np.asarray(v, dtype=float), int(y))
                      for s, v, y in zip(pdf["slots"], pdf["found"], pdf["label"])], epochs)
        both = pdf["label"].nunique() == 2
        return pd.DataFrame({"weights": [(model if both else np.zeros_like(model)).astype(np.float32).tobytes()], "rows": [len(pdf)]})

    fitted = rows.groupBy("shard").applyInPandas(fit, "weights binary, rows long").collect()  # `shards` vectors of fixed size
    if not fitted:
        return np.zeros(DIMENSIONS + 1, dtype=np.float32)
    return np.mean([np.frombuffer(r["weights"], dtype=np.float32) for r in sorted(fitted, key=lambda r: bytes(r["weights"]))], axis=0)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a score (0 to 1, higher: label 1 is likelier) in column ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, codes = shared.value, _Codes()
        for texts in batches:
            out = np.empty(len(texts))
            for i, t in enumerate(texts):
                total, n = 0.0, 0
                for slots in ngram_slots(t, codes):
                    total += float(model[slots].sum(dtype=np.float64))
                    n += len(slots)
                out[i] = model[-1] + (total * SCALE / n if n else 0.0)
                if len(codes) > CACHE:
                    codes.clear()
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -500, 500))))

    return docs.withColumn(into, scored(F.col(text)))
