"""SentencePiece encoding and decoding of merge-type vocabularies by a score-ordered agenda.

A text is read as symbols, one a character.  The agenda holds every pair of
neighbouring symbols that together are a piece of the vocabulary; the pair of the
best score, of equal ones the leftmost, is merged, its new neighbours join the
agenda, and so on until it is empty.  Symbols that are no piece become their bytes.

Merges never reach over a place where no piece of the vocabulary has its inside,
so a text is cut there first (before spaces, around characters that stand alone)
and each cut is encoded once: a bounded table remembers what frequent ones became.
A text of any length is read in slices that end at such a place.

Every Arrow batch is checked: the sentencepiece library encodes and decodes the
same texts, and ``agrees`` says whether ids and decoded text are the same.

Defined cases: a null text counts as empty; an empty text has the begin and end
ids only; a null id is kept; repeated rows are encoded alike; strings of control
pieces inside texts are ordinary text; U+2581 in a text is read as a space, as the
library does; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import heapq
import re
import sys
from array import array
from collections import defaultdict
from collections.abc import Iterator
from operator import add

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from surveil.llm.common import with_ids

#: Code points that are encoded at a time.
SLICE = 1 << 20
#: Cuts of texts that a worker remembers, and as many older ones.
REMEMBERED = 600_000
SPACE_SYMBOL = "▁"
#: A text that any normalisation but the identity would change.
_PROBE = "  a\tﬁ Ω Ａ́ "

codecs.register_error("replace-each-byte", lambda e: ("\ufffd", e.start + 1))


def packed(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit integers, little-endian."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Vocabulary(dict):
    """The pieces of a model: scores, ids and bytes, with a space for the space symbol.

    As a dictionary it remembers the packed ids of cuts.
    """

    def __init__(self, proto: bytes):
        super().__init__()
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=proto)
        if lib.normalize(_PROBE) != SPACE_SYMBOL + _PROBE.replace(" ", SPACE_SYMBOL):
            raise ValueError("only models that keep texts as they are and put a space before them are supported")
        ids = range(lib.get_piece_size())
        self.special = {i for i in ids if lib.is_control(i) or lib.is_unknown(i)}
        self.byte_ids = [i for i in ids if lib.is_byte(i)]
        if len(self.byte_ids) != 256 or any(lib.is_unused(i) for i in ids):
            raise ValueError("only models with byte fallback and without unused pieces are supported")
        byte_ids = set(self.byte_ids)
        normal = [i for i in ids if i not in byte_ids and i not in self.special]
        self.ids = {lib.id_to_piece(i).replace(SPACE_SYMBOL, " "): i for i in normal}
        scores = sorted({lib.get_score(i) for i in normal}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        #: The agenda's order: 0 is the best score; equal scores share a place.
        self.order = {p: place[lib.get_score(i)] for p, i in self.ids.items()}
        self.bytes = [b"" if i in self.special else lib.id_to_piece(i).replace(SPACE_SYMBOL, " ").encode() for i in ids]
        for i in self.byte_ids:
            self.bytes[i] = bytes([int(lib.id_to_piece(i)[3:-1], 16)])
        self.of_byte = {self.bytes[i][0]: i for i in self.byte_ids}
        self.bytes[lib.unk_id()] = " \u2047 ".encode()
        self.spaced = {i for i in normal if self.bytes[i][:1] == b" "}
        self.cuts = self._cuts()
        self._older: dict[str, bytes] = {}

    def _cuts(self) -> re.Pattern | None:
        """A pattern of stretches that no piece reaches out of, or None if pieces hold spaces inside.

        ASCII characters are cut off that stand beside no other in any piece, and those that never stand beside letters.
        """
        long = [p.lstrip(" ") for p in self.ids if len(p) > 1]
        if any(" " in p for p in long):
            return None
        beside: dict[str, set[str]] = defaultdict(set)
        for p in long:
            for c, d in zip(p, p[1:]):
                beside[c].add(d)
                beside[d].add(c)
        letters, todo = {"a"}, ["a"]
        while todo:
            fresh = beside[todo.pop()] - letters
            letters |= fresh
            todo += fresh
        starts = {p[0] for p in long if p} | {" "}  # some follow a space in a piece
        others = [chr(c) for c in range(128) if chr(c) not in letters and c != 32]
        alone = "".join(re.escape(c) for c in others if not beside[c] and c not in starts)
        marks = "".join(re.escape(c) for c in others if beside[c] or c in starts)
        parts = [f" *[^ {alone}{marks}]+", *[f" *[{marks}]+"] * bool(marks), " +", *[f"[{alone}]+"] * bool(alone)]
        return re.compile("|".join(parts))

    def merged(self, text: str) -> list[str | None]:
        """The symbols that remain when the agenda is empty, each at the place of its first character."""
        n = len(text)
        symbols: list[str | None] = list(text)
        begins = list(range(n))  # at a symbol's last character: where it begins
        order, push, shift = self.order.get, heapq.heappush, n.bit_length()
        places = (1 << shift) - 1
        pairs = map(order, map(add, text, text[1:]))
        agenda = [k << shift | i for i, k in enumerate(pairs) if k is not None]
        heapq.heapify(agenda)
        while agenda:
            best = heapq.heappop(agenda)
            i = best & places
            left = symbols[i]
            if left is None:
                continue
            j = i + len(left)
            if j >= n:
                continue
            both = left + symbols[j]
            if order(both) != best >> shift:  # one of the two has been merged since
                continue
            symbols[i], symbols[j] = both, None
            j = i + len(both)
            begins[j - 1] = i
            if j < n and (k := order(both + symbols[j])) is not None:
                push(agenda, k << shift | i)
            if i and (k := order(symbols[h := begins[i - 1]] + both)) is not None:
                push(agenda, k << shift | h)
        return symbols

    def __missing__(self, cut: str) -> bytes:
        """Packed ids of a cut that is not remembered."""
        ids = self._older.get(cut)
        if ids is None:
            symbols = self.merged(cut)
            try:
                ids = [self.ids[s] for s in symbols if s]
            except KeyError:  # characters that are no piece become their bytes
                ids = [i for s in symbols if s for i in ([self.ids[s]] if s in self.ids else map(self.of_byte.get, s.encode()))]
            ids = packed(ids)
        self[cut] = ids
        return ids

    def slice_ids(self, text: str) -> bytes:
        """Packed ids of a slice with a space before it."""
        text = " " + text.replace(SPACE_SYMBOL, " ")
        if len(self) > REMEMBERED:  # what is used again moves back from the older ones
            self._older = dict(self)
            self.clear()
        return b"".join([self[cut] for cut in (self.cuts.findall(text) if self.cuts else [text])])

    def slices(self, text: str) -> Iterator[str]:
        """Pieces of the text, each to be encoded with a space before it: a text is cut at, and without, single spaces."""
        start = 0
        while self.cuts and len(text) - start > SLICE:
            cut = text.find(" ", start + SLICE)
            while cut > 0 and text[cut - 1] in " " + SPACE_SYMBOL:
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[start:cut]
            start = cut + 1
        yield text[start:]

    def encode(self, text: str) -> bytes:
        """Packed little-endian ids with begin and end."""
        body = b"".join(map(self.slice_ids, self.slices(text))) if text else b""
        return packed([self.library.bos_id()]) + body + packed([self.library.eos_id()])

    def decode(self, ids: bytes) -> str:
        """The text of packed ids: each byte that is no UTF-8 becomes U+FFFD, the space put in front goes."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        out = b"".join(map(self.bytes.__getitem__, numbers)).decode("utf-8", "replace-each-byte")
        first = next((i for i in numbers if self.bytes[i]), None)
        return out[1:] if first in self.spaced else out

    def library_agrees(self, text: str, ids: bytes, decoded: str) -> bool:
        """Whether the library encodes and decodes alike (slice by slice, as it keeps about 100 bytes a token)."""
        lib, at, back = self.library, 4, []
        for part in self.slices(text) if text else ():
            theirs = lib.encode(part, num_threads=1) if part else [self.ids[" "]]
            mine = packed(theirs)
            if ids[at:at + len(mine)] != mine:
                return False
            at += len(mine)
            back.append(lib.decode(theirs))
        return len(ids) == at + 4 and " ".join(back) == decoded


_LOADED: dict[int, Vocabulary] = {}


def vocabulary(proto: bytes) -> Vocabulary:
    """The model, loaded once a worker."""
    key = hash(proto)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(proto)
    return _LOADED[key]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_decode(docs: DataFrame, model_path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, ``ids`` (packed unsigned 32-bit, little-endian, begin and end included), ``n_tokens``,
    ``decoded`` and ``agrees``.  ``model_path`` is read on the driver; its bytes go to the tasks."""
    proto = docs.sparkSession.sparkContext.broadcast(model_bytes(model_path))
    schema = StructType([StructField("__id", StringType()), StructField("ids", BinaryType()), StructField("n_tokens", LongType()),
                         StructField("decoded", StringType()), StructField("agrees", BooleanType())])

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = vocabulary(proto.value)
        for pdf in batches:
            ids = [model.encode(t) for t in pdf["__text"]]
            back = [model.decode(i) for i in ids]
            agrees = [model.library_agrees(t, i, b) for t, i, b in zip(pdf["__text"], ids, back)]
            yield pd.DataFrame({"__id": pdf["__id"], "ids": ids, "n_tokens": [len(i) // 4 for i in ids],
                                "decoded": back, "agrees": agrees})

    rows = docs.select(F.col(id_col).cast("string").alias("__id"), F.coalesce(text, F.lit("")).alias("__text"))
    return with_ids(rows.mapInPandas(coded, schema), docs, id_col)
