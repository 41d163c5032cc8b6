"""Periodic runs of words: stretches that repeat with a period, found by multi-scale minimizers.

A run is a maximal stretch of at least ``MIN_WORDS`` words and two periods that is
identical to itself a period further on; its period is the smallest such.

Periods below ``2 * BASE`` are found by comparing the words with themselves at every
lag.  Longer periods q are found at the scale w (``BASE`` times a power of two) with
``2 w <= q < 4 w``: of every w neighbouring blocks of w words, those with the smallest
hash are kept.  Windows a period apart hold the same words inside a run, so they keep
the same blocks; pairs of equal kept blocks between 2 w and 4 w apart are seeds, which
are extended word by word in both directions.

Blocks with a period of at most w / 3 are never kept, so equal kept blocks are over
w / 3 words apart and a block has few partners, even in texts of one word.  A run all
of whose blocks are such has a first period that lies in a run of the small period, and
a second one that lies in the next run of the same period, which touches the first; so
its periods follow from pairs of touching runs, found before.  Nothing is lost: the
result is exact, whatever the hashes.

The documents of an Arrow batch are searched together, separated by words that occur
once.  ``collapsed`` is the text without the words that any run holds after its first
period, joined by single spaces.

Defined cases: null and empty texts have no words and no runs; a null id is kept;
repeated rows get equal results; texts of any length are searched whole, in one task
at about 100 bytes a word; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import compress, count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from surveil.llm.common import with_ids
from surveil.llm.words import word_slices

MIN_WORDS = 12
#: Words of a block at the first scale; lags below twice as many are scanned.
BASE = 16
#: Words that are searched together, unless one document has more.
TOGETHER = 1 << 20
#: Seeds of one period from which on the whole array is compared at that lag.
MANY_SEEDS = 64
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)))

Run = tuple[int, int, int]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(29))) * _ODD[0]
        return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over every ``width`` (a power of two) neighbours."""
    step = 1
    while step < width:
        x = best(x[:-step], x[step:])
        step *= 2
    return x


def _equal_ahead(a: np.ndarray, i: int, lag: int) -> int:
    """How many words from ``i`` on equal those ``lag`` further."""
    n, step = 0, 64
    while i + lag + n < len(a):
        far = a[i + lag + n:i + lag + n + step]
        differ = a[i + n:i + n + len(far)] != far
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + len(far), step * 2
    return n


def _equal_behind(a: np.ndarray, i: int, lag: int) -> int:
    """How many words before ``i`` equal those ``lag`` further."""
    n, step = 0, 64
    while i - n > 0:
        low = max(i - n - step, 0)
        differ = (a[low:i - n] != a[low + lag:i - n + lag])[::-1]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + len(differ), step * 2
    return n


class _Search:
    """The runs of an array of words whose documents are in order of falling length."""

    def __init__(self, a: np.ndarray):
        self.a = a
        self.seen: set[tuple[int, int]] = set()
        self.runs: list[Run] = []
        #: Touching runs of one period: (period, remainder of the periods that they make, starts and ends).
        self.touching: list[tuple[int, int, int, int, int, int]] = []

    def add(self, start: int, end: int, period: int) -> None:
        """A stretch of this period; one that a divisor of it made before is the same run."""
        if (start, end) not in self.seen:
            self.seen.add((start, end))
            self.runs.append((start, end, period))

    def scan_lag(self, n: int, lag: int) -> None:
        """All runs of a period in the first ``n`` words, by comparing them at its lag."""
        equal = np.zeros(max(n - lag, 0) + 2, dtype=np.int8)
        equal[1:-1] = self.a[:max(n - lag, 0)] == self.a[lag:n]
        edges = np.flatnonzero(np.diff(equal))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= max(MIN_WORDS, 2 * lag) - lag
        for s, e in zip(starts[long].tolist(), ends[long].tolist()):
            self.add(s, e + lag, lag)

    def note_touching(self, runs: list[Run]) -> None:
        """Remember pairs of touching runs of one period and one content."""
        a, last = self.a, {}
        for start, end, p in sorted(r for r in runs if r[1] - r[0] >= 2 * BASE):
            if p in last and start <= last[p][1]:
                s1, e1 = last[p]
                root = np.concatenate([a[s1:s1 + p]] * 2).tobytes()
                turned = a[start:start + p].tobytes()
                at = root.find(turned)
                while at >= 0 and at % a.itemsize:
                    at = root.find(turned, at + 1)
                if at >= 0:
                    self.touching.append((p, (start - s1 - at // a.itemsize) % p, s1, e1, start, end))
            last[p] = (start, end)

    def runs_of_touching(self, w: int) -> None:
        """Runs of periods from 2 w up to 4 w whose first and second period lie in two touching runs."""
        for p, rest, s1, e1, s2, e2 in self.touching:
            if 3 * p > w:
                continue
            most = min(e1 - s1, e2 - s2, 4 * w - 1)
            for q in range(2 * w + (rest - 2 * w) % p, most + 1, p):
                low, high = max(s1, s2 - q), min(e1, e2 - q)
                if low < high:
                    self.extend(low, high, q)

    def extend(self, low: int, high: int, lag: int) -> int:
        """Extend words ``low`` to ``high`` that equal those ``lag`` further; the end of the equal words."""
        end = high + _equal_ahead(self.a, high, lag)
        start = low - _equal_behind(self.a, low, lag)
        if end - start >= lag:
            self.add(start, end + lag, lag)
        return end

    def seeds(self, hashes: np.ndarray, w: int, known: list[Run]) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances (2 w to 4 w) of equal kept blocks of w words."""
        ids = (hashes >> np.uint64(1)).copy()
        periodic = np.zeros(len(ids) + 1, dtype=np.int32)
        for start, end, p in known:
            if 3 * p <= w and end - start >= w and start < len(ids):
                periodic[start] += 1
                periodic[min(end - w + 1, len(ids))] -= 1
        ids[np.cumsum(periodic[:-1]) > 0] = _NONE
        smallest = _sliding(ids, w, np.minimum)
        edge = np.zeros(w - 1, dtype=np.uint64)
        kept = np.flatnonzero((ids == _sliding(np.concatenate([edge, smallest, edge]), w, np.maximum)) & (ids != _NONE))
        order = np.argsort(ids[kept], kind="stable")
        at, block = kept[order], ids[kept][order]
        places, lags = [], []
        for t in range(1, len(at)):
            lag = at[t:] - at[:-t]
            near = (block[t:] == block[:-t]) & (lag < 4 * w)
            if not near.any():
                break
            near &= lag >= 2 * w
            places.append(at[:-t][near])
            lags.append(lag[near])
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *places]), np.concatenate([none, *lags])

    def extend_seeds(self, places: np.ndarray, lags: np.ndarray, n: int) -> None:
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        cuts = np.flatnonzero(np.diff(lags)) + 1
        for at, lag in zip(np.split(places, cuts), lags[np.concatenate([[0], cuts])[:len(cuts) + 1]].tolist() if len(lags) else []):
            if len(at) > MANY_SEEDS:
                self.scan_lag(n, lag)
                continue
            done = -1
            for i in at.tolist():
                if i >= done:
                    done = self.extend(i, i, lag)


def _doubled(hashes: np.ndarray, w: int) -> np.ndarray:
    """Hashes of blocks of 2 w words from those of w words."""
    far = hashes[w:]
    with np.errstate(over="ignore"):
        return _mixed(hashes[:-w] * _ODD[0] + (far ^ (far >> np.uint64(31))) * _ODD[1])


def find_runs(a: np.ndarray, reach: Callable[[int], int]) -> list[Run]:
    """(start, end, period) of all runs; ``reach(n)`` is where the documents of at least n words end."""
    search = _Search(a)
    for lag in range(1, 2 * BASE):
        search.scan_lag(reach(max(MIN_WORDS, 2 * lag)), lag)
    search.note_touching(search.runs)
    done, w = len(search.runs), 1
    if not reach(4 * BASE):
        return search.runs
    with np.errstate(over="ignore"):
        hashes = _mixed(a[:reach(4 * BASE)].astype(np.int64).view(np.uint64) * _ODD[1])
    while w < BASE:
        hashes, w = _doubled(hashes, w), 2 * w
    while n := reach(4 * w):
        hashes = hashes[:n - w + 1]
        search.extend_seeds(*search.seeds(hashes, w, search.runs), n)
        search.runs_of_touching(w)
        search.note_touching(search.runs[done:])
        done = len(search.runs)
        hashes, w = _doubled(hashes, w), 2 * w
    return search.runs


Prepare = Callable[[list[bytes], str | None], list[bytes]]


def _searched(ids: list, texts: list[list[bytes]]) -> list[tuple]:
    """(id, words, runs, collapsed) of some documents, in their order."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(texts[i]) for i in order], dtype=np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes + 1)])
    a = np.empty(edges[-1], dtype=np.int64)
    for k, i in enumerate(order):
        a[edges[k]:edges[k + 1] - 1] = [number[w] for w in texts[i]]
        a[edges[k + 1] - 1] = -1 - k  # ends a document
    falling = -sizes
    runs = find_runs(a, lambda n: int(edges[np.searchsorted(falling, -n, side="right")]))

    found: list[list[Run]] = [[] for _ in texts]
    drops = np.zeros(len(a) + 1, dtype=np.int32)
    owners = np.searchsorted(edges, [r[0] for r in runs], side="right") - 1
    for (start, end, period), k in zip(runs, owners.tolist()):
        drops[start + period] += 1
        drops[end] -= 1
        found[order[k]].append((start - int(edges[k]), end - start, period))
    kept = np.cumsum(drops[:-1]) == 0
    out: list[tuple] = [()] * len(texts)
    for k, i in enumerate(order):
        words = texts[i]
        if found[i]:
            words = compress(words, kept[edges[k]:edges[k + 1] - 1].tolist())
        rows = [{"start": s, "length": n, "period": p} for s, n, p in sorted(found[i], key=lambda r: (r[0], r[2]))]
        out[i] = (ids[i], len(texts[i]), rows, b" ".join(words).decode("utf-8", "surrogatepass"))
    return out


def periodic_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id", prepare: Prepare | None = None) -> DataFrame:
    """One row per document: id, ``n_words``, ``runs`` (start, length and period, by start) and ``collapsed``.

    ``prepare`` may change a document's words, given with its id as text, before the search.
    """
    run = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
    schema = StructType([StructField("__id", StringType()), StructField("n_words", LongType()), StructField("runs", ArrayType(run)),
                         StructField("collapsed", StringType())])

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=schema.names)

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, texts, n = [], [], 0
            for doc_id, body in zip(pdf["__id"], pdf["__text"]):
                words = [w for part in word_slices(body, lower=False) for w in part]
                ids.append(doc_id)
                texts.append(words if prepare is None else prepare(words, doc_id))
                n += len(words)
                if n >= TOGETHER:
                    yield frame(_searched(ids, texts))
                    ids, texts, n = [], [], 0
            if ids:
                yield frame(_searched(ids, texts))

    rows = docs.select(F.col(id_col).cast("string").alias("__id"), F.col(text).alias("__text"))
    return with_ids(rows.mapInPandas(searched, schema), docs, id_col)
