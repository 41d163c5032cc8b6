"""Exact deduplication by composable polynomial fingerprints.

A text is normalised (runs of ASCII white space become one space) and hashed
chunk by chunk.  A chunk's fingerprint is its polynomial value modulo two
primes, with its length; two neighbouring chunks combine by shifting the left
value by the right one's length.  Documents of more than ``SLICE`` code points are
cut into parts that different tasks hash; an aggregate combines them in order.
(The SHA-256 of the result can't be combined: it is streamed over a whole text.)

Texts with equal fingerprints are then compared chunk by chunk: per
(fingerprint, chunk number) the smallest and the largest chunk must be the same
bytes.  That comparison is an ordinary partial aggregate, so a group of copies
holding a third of all rows leaves one row per chunk and map task, and no task
ever holds a group.  A group in which two chunks differ is split by SHA-256.

Defined cases: a null text counts as empty; a null ``doc_id`` is never the one
that stays unless its whole group has none; of repeated rows with one
``doc_id`` one stays; extra columns are ignored by the decision; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from surveil.llm.common import stage

#: Two primes below 2**31, so that products of residues fit a signed long.
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 69069069)
ROW = 1024
CHUNK = 1 << 16
#: Code points of a text that are normalised and hashed at a time.
SLICE = 1 << 20

_POWERS = [np.array([pow(b, ROW - 1 - i, p) for i in range(ROW)], dtype=np.int64) for b, p in zip(BASES, PRIMES)]
_SPACE = b" \t\n\x0b\x0c\r"

Fingerprint = tuple[int, int, int]
EMPTY: Fingerprint = (0, 0, 0)


def chunk_fingerprint(data: bytes) -> Fingerprint:
    """The fingerprint (value mod p1, value mod p2, length) of some bytes.

    The bytes are laid out as rows of ROW (zeros in front do not change the
    value); all rows are hashed at once by a product with the powers of the base.
    """
    n = len(data)
    if not n:
        return EMPTY
    rows = -(-n // ROW)
    grid = np.zeros(rows * ROW, dtype=np.int64)
    grid[rows * ROW - n:] = np.frombuffer(data, dtype=np.uint8)
    grid = grid.reshape(rows, ROW)
    out = []
    for base, prime, powers in zip(BASES, PRIMES, _POWERS):
        step, value = pow(base, ROW, prime), 0
        for part in (grid @ powers % prime).tolist():
            value = (value * step + part) % prime
        out.append(value)
    return out[0], out[1], n


def combine(left: Fingerprint, right: Fingerprint) -> Fingerprint:
    """The fingerprint of two neighbouring pieces from theirs (associative)."""
    a, b = ((x * pow(base, right[2], p) + y) % p for x, y, base, p in zip(left, right, BASES, PRIMES))
    return a, b, left[2] + right[2]


def normalised_piece(raw: bytes, blank: bool) -> bytes:
    """A part of a text, normalised; ``blank``: the part before it ended in white space (and gave its space)."""
    core = b" ".join(raw.split())
    if not core:
        return b"" if blank or not raw else b" "
    return (b" " if raw[:1] in _SPACE_SET and not blank else b"") + core + (b" " if raw[-1:] in _SPACE_SET else b"")


def normalised_pieces(text: str | None) -> Iterator[bytes]:
    """The normalised text in UTF-8, piece by piece, for texts of any length."""
    blank = False
    for i in range(0, len(text or ""), SLICE):
        raw = text[i:i + SLICE].encode("utf-8", "surrogatepass")
        if piece := normalised_piece(raw, blank):
            yield piece
        blank = raw[-1:] in _SPACE_SET


_SPACE_SET = {_SPACE[i:i + 1] for i in range(len(_SPACE))}


def polynomial_of(text: str | None) -> tuple[int, int]:
    """(packed value, length in bytes) of the normalised text."""
    whole = EMPTY
    for piece in normalised_pieces(text):
        whole = combine(whole, chunk_fingerprint(piece)) if whole[2] else chunk_fingerprint(piece)
    return whole[0] << 31 | whole[1], whole[2]


def digest_of(text: str | None) -> str:
    """SHA-256 of the normalised text."""
    sha = hashlib.sha256()
    for piece in normalised_pieces(text):
        sha.update(piece)
    return sha.hexdigest()


def fingerprint_of(text: str | None) -> tuple[int, int, str]:
    """(packed value, length in bytes, SHA-256) of the normalised text, which is normalised once."""
    whole, sha = EMPTY, hashlib.sha256()
    for piece in normalised_pieces(text):
        sha.update(piece)
        whole = combine(whole, chunk_fingerprint(piece)) if whole[2] else chunk_fingerprint(piece)
    return whole[0] << 31 | whole[1], whole[2], sha.hexdigest()


#: A long document's part: its fingerprint, and the powers that shift what stands before it.
_PART = StructType([StructField(n, LongType()) for n in ("row", "part", "a", "b", "n", "shift_a", "shift_b")])


def combined_parts(parts: DataFrame) -> DataFrame:
    """(``row``, ``fp``, ``fp_len``) of documents that lie in parts (``row``, ``part``, raw ``piece``, ``blank``), hashed wherever they are."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for row, part, piece, blank in zip(*(batch.column(c).to_pylist() for c in ("row", "part", "piece", "blank"))):
                a, b, n = chunk_fingerprint(normalised_piece(piece, blank))
                got.append((row, part, a, b, n, *(pow(base, n, p) for base, p in zip(BASES, PRIMES))))
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.int64()) for i in range(len(_PART))], _PART.names)

    zero = F.lit(0).cast("long")

    def after(left: Column, right: Column) -> Column:
        values = [((left[v] * right["shift_" + v] + right[v]) % p).alias(v) for v, p in zip("ab", PRIMES)]
        return F.struct(*values, (left["n"] + right["n"]).alias("n"))

    one = parts.repartition("row", "part").mapInArrow(hashed, _PART).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct(*_PART.names[1:]))).alias("parts"))
    whole = one.select("row", F.aggregate("parts", F.struct(zero.alias("a"), zero.alias("b"), zero.alias("n")), after).alias("w"))
    return whole.select("row", F.shiftleft("w.a", 31).bitwiseOR(F.col("w.b")).alias("fp"), F.col("w.n").alias("fp_len"))


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", part_chars: int = SLICE) -> DataFrame:
    """One row per document: id, ``row`` (a number), ``fp`` (62-bit value), ``fp_len``, ``text_sha256``.

    Texts of more than ``part_chars`` code points are staged in parts and hashed by all tasks.
    """
    rows = docs.select(F.col(id_col), F.col(text).alias("__text"), F.monotonically_increasing_id().alias("row"))
    schema = StructType([docs.schema[id_col], StructField("row", LongType()), StructField("fp", LongType()), StructField("fp_len", LongType()),
                         StructField("text_sha256", StringType()), StructField("part", LongType()), StructField("piece", BinaryType()),
                         StructField("blank", BooleanType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got: list[tuple] = []

            def frame(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                at = pa.array([g[0] for g in got], pa.int64())
                columns = [pa.array([g[i] for g in got], kind) for i, kind in
                           enumerate((pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.bool_()), 1)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), *columns], schema.names)

            for at, t in enumerate(batch.column(1).to_pylist()):
                if len(t or "") <= part_chars:
                    got.append((at, *fingerprint_of(t), None, None, None))
                    continue
                sha, blank = digest_of(t), False
                for part, i in enumerate(range(0, len(t), part_chars)):
                    raw = t[i:i + part_chars].encode("utf-8", "surrogatepass")
                    got.append((at, None, None, None if part else sha, part, raw, blank))
                    blank = raw[-1:] in _SPACE_SET
                    if len(got) * part_chars >= SLICE:  # few parts at a time
                        yield frame()
                        got.clear()
            if got:
                yield frame()

    # the numbers tell repeated rows apart; they are fixed by writing the table
    staged = stage(rows.mapInArrow(hashed, schema), "exact-fingerprints")
    heads = staged.filter("part = 0").select(id_col, "row", "text_sha256")
    long = stage(heads.join(combined_parts(staged.filter("part is not null")), "row"), "exact-long")
    names = [id_col, "row", "fp", "fp_len", "text_sha256"]
    return staged.filter("part is null").select(*names).unionByName(long.select(*names))


def differing_fingerprints(docs: DataFrame, groups: DataFrame, text: str = "text") -> DataFrame:
    """The fingerprints among ``groups`` under which two texts differ, by comparing the bytes chunk by chunk."""
    schema = StructType([StructField("fp", LongType()), StructField("fp_len", LongType()), StructField(text, StringType())])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [polynomial_of(t) for t in pdf[text]]
            yield pd.DataFrame({"fp": [g[0] for g in got], "fp_len": [g[1] for g in got], text: pdf[text]})

    members = docs.select(text).mapInPandas(hashed, schema).join(groups, ["fp", "fp_len"], "left_semi")
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ").cast("binary")
    cuts = F.sequence(F.lit(0), F.greatest(F.octet_length("body") - 1, F.lit(0)), F.lit(CHUNK))
    chunks = members.select("fp", "fp_len", body.alias("body")).select(
        "fp", "fp_len", F.posexplode(F.transform(cuts, lambda i: F.substring(F.col("body"), i + 1, F.lit(CHUNK)))).alias("part", "chunk"))
    compared = chunks.groupBy("fp", "fp_len", "part").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    return compared.filter(F.col("low") != F.col("high")).select("fp", "fp_len").distinct()


def group_copies(rows: DataFrame, differ: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Name every row's group (``row`` numbers the rows).  ``differ``: fingerprints that cover several texts, to be split by digest."""
    split = rows.join(differ.withColumn("_split", F.lit(True)), ["fp", "fp_len"], "left")
    split = split.withColumn("_digest", F.when(F.col("_split"), F.col("text_sha256")).otherwise(F.lit(""))).drop("_split")
    key = ["fp", "fp_len", "_digest"]
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("row").alias("row"))).alias("first")
    # no window over a group, and the groups in a table of their own: so the planner can split the join of a hot one
    groups = stage(split.groupBy(*key).agg(first, F.count("*").alias("group_size")), "exact-groups")
    return split.join(groups, key).select(
        id_col, F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", part_chars: int = SLICE) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    rows = fingerprints(docs, text, id_col, part_chars)
    copies = stage(rows.groupBy("fp", "fp_len").count().filter("count > 1").select("fp", "fp_len"), "exact-copies")
    differ = stage(differing_fingerprints(docs, copies, text), "exact-differ")
    return group_copies(rows, differ, id_col)
