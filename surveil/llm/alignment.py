"""Alignment of two tokenizers over a corpus, with the corpus-wide count of every linked pair of ids.

Both tokenizers encode a space and the text; a byte offset where tokens of both end
cuts the tokens into groups, and two tokens are linked where their bytes overlap.

1. Every text is encoded once; the ids are staged, packed.
2. First pass: tokens are aligned and the distinct pairs of linked ids collected, by
   task and then by Spark.
3. A minimal perfect hash function of the pairs is built bucket by bucket in tasks.
4. The tokens are aligned again: every task adds its links to one dense vector of
   counts, indexed by the hash; keys are verified.  The vectors, cut at the buckets,
   are summed in a tree of two levels.
5. Second pass: documents are aligned once more and look their pairs' counts up.

Only the functions, the pairs and the counts travel to all tasks, in blocks of at most
``BLOCK_KEYS`` pairs (about 17 bytes each); more pairs take more passes, one a block, whose
sums are added by row.  The highest count of every id of B is a vector as long as B's vocabulary.

Staged ids take two bytes where a vocabulary fits, else four.  A's merges are run by tiktoken (built from the same file)
where its pattern's classes of characters cannot differ between libraries, that is on texts of
Latin letters and common punctuation, and by the tokenizers library on all others.

Defined cases: texts that are null or empty, or whose tokens' bytes are not the space and the
text, have no tokens, zeros and an empty group string; null ids are kept; repeated rows count
each and get a row each; an empty table gives an empty result; extra columns are ignored.
A text is aligned whole in one task, at about 150 bytes a token.
"""

from __future__ import annotations

import json
import math
import os
import re
from collections.abc import Iterator
from functools import cache, cached_property, reduce

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.llm.common import stage, with_ids
from surveil.llm.perfect_hash import PerfectHash, bucket_of, build

#: Pairs of a block, which travels to all tasks, at most; and of a bucket on average.
BLOCK_KEYS = 2_000_000
BUCKET_KEYS = 8_192
#: Distinct pairs that a task remembers before it hands them on.
REMEMBERED = 1_000_000
#: Code points that are encoded, and tokens that are aligned, together, unless one text has more.
ENCODED = 1 << 18
ALIGNED = 1 << 16
#: Characters outside Latin letters, their accents and common punctuation, whose classes might differ between libraries.
_UNSTABLE = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")
#: Fixed value: the pattern that byte-level vocabularies split texts by.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_character() -> dict[str, int]:
    """The bytes behind the characters of byte-level vocabularies: printable ones stand for themselves, others follow U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def packed_type(n_ids: int) -> str:
    """The type of packed ids: two bytes where they suffice."""
    return "<u2" if n_ids <= 1 << 16 else "<u4"


class ByteLevel:
    """A byte-level vocabulary (a ``tokenizers`` JSON file); strings of special tokens are ordinary text."""

    def __init__(self, source: str):
        self.source, whole = source, json.loads(source)
        byte, model = _byte_of_character(), whole["model"]
        vocab = model["vocab"]
        added = {t["id"]: t["content"].encode() for t in whole["added_tokens"]}
        self.bytes = [b""] * (max([*vocab.values(), *added]) + 1)
        for token, i in vocab.items():
            self.bytes[i] = added.get(i) or bytes(byte[c] for c in token)
        for i, raw in added.items():
            self.bytes[i] = raw
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.n_ranks = 256 + len(model["merges"])
        self.ranked = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and all(
            len(raw) == 1 for raw in self.bytes[:256])

    @cached_property
    def whole(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task a core
        from tokenizers import Tokenizer
        whole = Tokenizer.from_str(self.source)
        whole.encode_special_tokens = True
        return whole

    @cached_property
    def fast(self):
        """The same merges by rank."""
        import tiktoken
        ranks = {raw: i for i, raw in enumerate(self.bytes[:self.n_ranks])}
        return tiktoken.Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        slow = [not self.ranked or bool(_UNSTABLE.search(t)) for t in texts]
        given = [t for t, s in zip(texts, slow) if s]
        found = iter(self.whole.encode_batch_fast(given, add_special_tokens=False) if given else ())
        return [next(found).ids if s else self.fast.encode_ordinary(t) for t, s in zip(texts, slow)]


class PieceLevel:
    """A sentencepiece vocabulary, which puts the space before the text itself."""

    def __init__(self, proto: bytes):
        self.model = lib = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.bytes = [bytes([int(lib.id_to_piece(i)[3:-1], 16)]) if lib.is_byte(i)
                      else lib.id_to_piece(i).replace("▁", " ").encode() for i in range(lib.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Tokenizers:
    """Both tokenizers, loaded once a worker from what the driver read."""

    def __init__(self, a_source: str, b_proto: bytes):
        self.sources = a_source, b_proto

    def __getstate__(self):
        return self.sources

    def __setstate__(self, state):
        self.sources = state

    @cached_property
    def a(self) -> ByteLevel:
        return ByteLevel(self.sources[0])

    @cached_property
    def b(self) -> PieceLevel:
        return PieceLevel(self.sources[1])

    def lengths(self) -> list[np.ndarray]:
        """The bytes of every id of A and of B."""
        return [np.array(list(map(len, t.bytes)), dtype=np.int64) for t in (self.a, self.b)]

    def encode(self, texts: list[str]) -> Iterator[list[bytes]]:
        """Packed ids of both; nothing where a tokenizer does not give the text back."""
        for a, b, text in zip(self.a.encode([" " + t for t in texts]), self.b.encode(texts), texts):
            body = b" " + text.encode()
            same = text and all(b"".join(map(t.bytes.__getitem__, ids)) == body for t, ids in ((self.a, a), (self.b, b)))
            yield [np.array(ids if same else [], dtype=packed_type(len(t.bytes))).tobytes() for t, ids in ((self.a, a), (self.b, b))]


@cache
def _numerals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of 0 to n - 1 as rows of bytes with room for a mark behind them, and how long each is with it."""
    width = len(str(n)) + 1
    digits = np.array([b"%d" % i for i in range(n)], dtype=f"S{width}")
    return digits.view(np.uint8).reshape(n, width), np.char.str_len(digits) + 1


class Aligned:
    """The links of some documents' tokens, laid end to end; a document's tokens have as many bytes in A as in B.

    Stretches between neighbouring ends of tokens, of either side, are the links.
    """

    def __init__(self, lengths: list[np.ndarray], a, b):
        self.lengths = lengths
        types = [np.dtype(packed_type(len(n))) for n in lengths]
        self.a, self.b = (np.frombuffer(b"".join(x), dtype=t).astype(np.int64) for x, t in zip((a, b), types))
        self.a_edges, self.b_edges = (np.cumsum([0, *[len(x) // t.itemsize for x in side]]) for side, t in zip((a, b), types))
        ends = [np.cumsum(n[ids]) for n, ids in zip(lengths, (self.a, self.b))]
        flags = np.zeros((2, int(ends[0][-1]) + 1 if len(self.a) else 1), dtype=bool)
        flags[0, ends[0]] = flags[1, ends[1]] = True
        at = np.flatnonzero(flags[0] | flags[1])
        #: Whether a token of A, or of B, ends with the link.
        self.a_here, self.b_here = flags[0, at], flags[1, at]
        a_of, b_of = (np.cumsum(here) - here for here in (self.a_here, self.b_here))
        self.keys = self.a[a_of] << 32 | self.b[b_of]
        #: Where each document's links begin.
        self.edges = np.concatenate([[0], np.flatnonzero(self.a_here) + 1])[self.a_edges]

    def sums(self, per_link: np.ndarray) -> np.ndarray:
        """The sum of a number per link for every document."""
        total = np.concatenate([[0], np.cumsum(per_link)])
        return np.diff(total[self.edges])

    def n_groups(self) -> np.ndarray:
        return self.sums((self.a_here & self.b_here).astype(np.int64))

    def groups(self) -> list[str]:
        """Every document's groups, ``a1,a2|b1;a3|b2,b3``: a token's place is behind all tokens of the groups before, A first."""
        both = self.a_here & self.b_here
        group = np.cumsum(both) - both
        ends_a, ends_b = both[self.a_here], both[self.b_here]  # the last of their group
        before_a = np.concatenate([[0], np.flatnonzero(ends_a) + 1])
        before_b = np.concatenate([[0], np.flatnonzero(ends_b) + 1])
        place_a = np.arange(len(self.a)) + before_b[group[self.a_here]]
        place_b = np.arange(len(self.b)) + before_a[group[self.b_here] + 1]
        ids, marks = (np.empty(len(self.a) + len(self.b), dtype=t) for t in (np.int64, np.uint8))
        ids[place_a], ids[place_b] = self.a, self.b
        marks[place_a], marks[place_b] = np.where(ends_a, ord("|"), ord(",")), np.where(ends_b, ord(";"), ord(","))
        digits, sizes = _numerals(max(map(len, self.lengths)))
        rows, sizes = digits[ids], sizes[ids]
        rows[np.arange(len(ids)), sizes - 1] = marks
        flat = rows[np.arange(rows.shape[1]) < sizes[:, None]].tobytes().decode("ascii")
        cuts = np.concatenate([[0], np.cumsum(sizes)])[self.a_edges + self.b_edges].tolist()
        return [flat[i:max(j - 1, i)] for i, j in zip(cuts, cuts[1:])]


def _portions(pdf: pd.DataFrame, size, limit: int) -> Iterator[pd.DataFrame]:
    """Parts of a batch of about ``limit``, unless one row has more."""
    begin = np.cumsum(size) - size
    for _, part in pdf.groupby(begin // limit, sort=True):
        yield part


def _parts(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    return _portions(pdf, (pdf["a"].str.len() + pdf["b"].str.len()) // 2, ALIGNED)


def tokenized(docs: DataFrame, tokens: Tokenizers, text: str, id_col: str) -> DataFrame:
    """``__row``, ``__id`` and both packed ids of every row."""
    given = docs.sparkSession.sparkContext.broadcast(tokens)

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in _portions(pdf, pdf["__text"].str.len(), ENCODED):
                found = list(given.value.encode(part["__text"].tolist()))
                yield pd.DataFrame({"__row": part["__row"], "__id": part["__id"],
                                    "a": [f[0] for f in found], "b": [f[1] for f in found]})

    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).cast("string").alias("__id"),
                       F.coalesce(text, F.lit("")).alias("__text"))
    return rows.mapInPandas(encoded, "__row long, __id string, a binary, b binary")


def distinct_pairs(tokens: DataFrame, lengths) -> DataFrame:
    """Every pair of linked ids once: ``key`` (A's id in the upper half)."""
    def collected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.zeros(0, dtype=np.int64)
        for pdf in batches:
            for part in _parts(pdf):
                fresh = pd.unique(Aligned(lengths.value, part["a"], part["b"]).keys)
                fresh = np.setdiff1d(fresh, known, assume_unique=True)
                if len(fresh):
                    yield pd.DataFrame({"key": fresh})
                    known = np.union1d(known, fresh) if len(known) < REMEMBERED else fresh

    return tokens.select("a", "b").mapInPandas(collected, "key long").distinct()


def hash_buckets(keys: DataFrame, n_buckets: int) -> DataFrame:
    """The function of every bucket of keys, and its keys in the order of their index."""
    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(bucket=bucket_of(pdf["key"].to_numpy(), n_buckets))

    def built(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes, words, placed = build(pdf["key"].to_numpy())
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "sizes": [sizes], "words": [words.tobytes()],
                             "keys": [placed.astype("<i8").tobytes()]})

    return keys.mapInPandas(dealt, "key long, bucket long").groupBy("bucket").applyInPandas(
        built, "bucket long, sizes array<long>, words binary, keys binary")


def read_block(buckets: DataFrame, n_buckets: int, first: int, end: int) -> PerfectHash:
    """The functions of some buckets (their keys are bounded by BLOCK_KEYS, give or take chance)."""
    rows = {r["bucket"]: r for r in buckets.filter(F.col("bucket").between(first, end - 1)).collect()}
    mine = [rows.get(k) for k in range(first, end)]
    return PerfectHash(n_buckets, first, [r["sizes"] if r else [] for r in mine],
                       [np.frombuffer(r["words"] if r else b"", dtype="<u8") for r in mine],
                       [np.frombuffer(r["keys"] if r else b"", dtype="<i8") for r in mine])


def count_links(tokens: DataFrame, lengths, block) -> DataFrame:
    """``bucket`` and its vector of counts: dense vectors of the tasks, summed in a tree of two levels."""
    spread = max(math.isqrt(len(tokens.inputFiles())), 1)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table: PerfectHash = block.value
        counts, seen = np.zeros(len(table), dtype=np.int64), 0
        for pdf in batches:
            seen = int(pdf["__row"].max()) if len(pdf) else seen
            for part in _parts(pdf):
                codes, keys = pd.factorize(Aligned(lengths.value, part["a"], part["b"]).keys)
                at = table.index(keys)
                counts[at[at >= 0]] += np.bincount(codes, minlength=len(keys))[at >= 0]
        for i in range(len(table.sizes)):
            piece = counts[table.edges[i]:table.edges[i + 1]]
            if piece.any():
                yield pd.DataFrame({"bucket": [table.first + i], "branch": [(seen >> 33) % spread], "counts": [piece.tobytes()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = reduce(np.add, (np.frombuffer(c, dtype="<i8") for c in pdf["counts"]))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "counts": [total.tobytes()]})

    leaves = tokens.select("__row", "a", "b").mapInPandas(counted, "bucket long, branch long, counts binary")
    branches = leaves.groupBy("bucket", "branch").applyInPandas(added, "bucket long, counts binary")
    return branches.groupBy("bucket").applyInPandas(added, "bucket long, counts binary")


def pair_counts(vectors: DataFrame, buckets: DataFrame) -> DataFrame:
    """The counts as a table: ``a``, ``b``, ``n``."""
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for keys, counts in zip(pdf["keys"], pdf["counts"]):
                keys = np.frombuffer(keys, dtype="<i8")
                yield pd.DataFrame({"a": (keys >> 32).astype(np.int32), "b": (keys & 0xFFFFFFFF).astype(np.int32),
                                    "n": np.frombuffer(counts, dtype="<i8")})

    return vectors.join(buckets, "bucket").select("keys", "counts").mapInPandas(listed, "a int, b int, n long")


def look_up(tokens: DataFrame, lengths, block, counts, best, first_block: bool) -> DataFrame:
    """What every document has of the block's pairs: links that are their B id's most frequent, and the sum of counts."""
    def looked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, number, most = block.value, counts.value, best.value
        for pdf in batches:
            for part in _parts(pdf):
                links = Aligned(lengths.value, part["a"], part["b"])
                back, keys = pd.factorize(links.keys)
                at = table.index(keys)
                n = np.where(at >= 0, number[at], 0) if len(table) else np.zeros(len(keys), dtype=np.int64)
                is_best = (at >= 0) & (n == most[keys & 0xFFFFFFFF])
                out = {"__row": part["__row"], "__id": part["__id"], "n_a": np.diff(links.a_edges),
                       "n_b": np.diff(links.b_edges), "n_groups": links.n_groups(), "n_links": np.diff(links.edges),
                       "n_best": links.sums(is_best[back].astype(np.int64)), "count_sum": links.sums(n[back]),
                       "groups": links.groups() if first_block else ""}
                yield pd.DataFrame(out)

    return tokens.mapInPandas(looked, "__row long, __id string, n_a long, n_b long, n_groups long, n_links long, "
                                      "n_best long, count_sum long, groups string")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", id_col: str = "doc_id",
          block_keys: int = BLOCK_KEYS) -> tuple[DataFrame, DataFrame]:
    """(one row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups``;
    the pairs: ``a``, ``b``, ``n``).  The vocabulary files are read on the driver."""
    sc = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        both = Tokenizers(f.read(), g.read())
    lengths = sc.broadcast(both.lengths())
    tokens = stage(tokenized(docs, both, text, id_col), "align-tokens")
    keys = stage(distinct_pairs(tokens, lengths), "align-pairs")
    n_keys = keys.count()
    n_buckets = max(-(-n_keys // BUCKET_KEYS), 1)
    buckets = stage(hash_buckets(keys, n_buckets), "align-hash")
    step = max(block_keys // BUCKET_KEYS, 1)
    blocks, vectors = [], []
    for first in range(0, n_buckets, step):
        block = sc.broadcast(read_block(buckets, n_buckets, first, min(first + step, n_buckets)))
        vectors.append(stage(count_links(tokens, lengths, block), "align-counts"))
        blocks.append((first, block))
    pairs = reduce(DataFrame.unionByName, [pair_counts(v, buckets) for v in vectors])
    most = np.zeros(len(lengths.value[1]), dtype=np.int64)  # one number for each id of B
    for b, n in pairs.groupBy("b").agg(F.max("n")).collect():
        most[b] = n
    best = sc.broadcast(most)
    found = []
    for (first, block), vector in zip(blocks, vectors):
        table = block.value
        counts = np.zeros(len(table), dtype=np.int64)
        for bucket, packed in vector.select("bucket", "counts").collect():
            counts[table.edges[bucket - first]:table.edges[bucket - first + 1]] = np.frombuffer(packed, dtype="<i8")
        found.append(look_up(tokens, lengths, block, sc.broadcast(counts), best, not found))
    rows = found[0]
    if len(found) > 1:
        same = [F.max(c).alias(c) for c in ("__id", "n_a", "n_b", "n_groups", "n_links", "groups")]
        rows = reduce(DataFrame.unionByName, [stage(f, "align-part") for f in found]).groupBy("__row").agg(
            *same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return with_ids(rows.drop("__row"), docs, id_col), pairs
