"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items (normalised to words) are built into one suffix automaton; every
document is streamed through it word by word, keeping the length of the longest
suffix that occurs in some item.  Where that length reaches the window, the last
window of words is an occurrence; items shorter than the window count as one
window of their own.  The state names the items, so one pass finds the hit words
and the items.

``scan`` reports per document; ``decontaminate`` acts: the hit spans are cut out
of the text, and documents of which more than ``max_coverage`` of the words are
hit are dropped.

The benchmark is cut into blocks of at most ``BLOCK_WORDS`` words, and tasks build
an automaton of each into a staged table: the driver sees neither items nor all
automata.  One block at a time is broadcast behind its bound, and the documents
stream past all of them, so a benchmark of any size is searched completely.  An
item that is larger than a block is cut into pieces that overlap by all but one
word of a window: no window is lost, only ``longest`` ends at a piece's edge.

Defined cases: null texts have no words; items without words never match; a null
item id is listed as ``null``; repeated items and documents are treated alike; an
empty benchmark hits nothing; extra columns are kept (``scan`` replaces those
named like its results).
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from surveil.llm.common import stage

WINDOW = 10
#: Words of the benchmark in one automaton, at most (it has two states a word at most).
BLOCK_WORDS = 100_000
#: Blocks that are built from one group of items, about; larger groups leave fewer blocks half full.
BLOCKS_A_GROUP = 4
#: Automata that the documents stream past before they are staged, so that few Python workers run at a time.
BLOCKS_AT_A_TIME = 4
#: Documents with a larger share of hit words are dropped, not cut.
MAX_COVERAGE = 0.5

#: Bytes that are not part of a word become spaces, A-Z become a-z; bytes from 0x80 are part of words.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
#: Code points that are read at a time.
SLICE = 1 << 20


def word_slices(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice; no word is cut."""
    rest = b""
    for i in range(0, len(text or ""), SLICE):
        raw = rest + text[i:i + SLICE].encode("utf-8", "surrogatepass").translate(_FOLD)
        words, rest = raw.split(), b""
        if words and raw[-1:] != b" " and i + SLICE < len(text):
            rest = words.pop()
        yield words
    if rest:
        yield [rest]


def words_of(text: str | None) -> list[bytes]:
    return [w for part in word_slices(text) for w in part]


class SuffixAutomaton:
    """A generalised suffix automaton over the words of several items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        coded = [(item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for item, words in items if words]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        #: state -> items in which its suffix of ``window`` words occurs
        self.items: dict[int, set[str]] = {}
        #: state -> (words, item) of shorter items that are suffixes of its strings
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, codes in coded:
            state = 0
            for n, c in enumerate(codes, 1):
                state = self.next[state][c]
                if n >= window:
                    self.items.setdefault(self._cut(state), set()).add(item)
            if len(codes) < window:
                self.short.setdefault(state, []).append((len(codes), item))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.short.get(self.link[state])
            if above:
                self.short[state] = self.short.get(state, []) + above

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:  # the string is known already, from this or another item
            known = self.next[last][c]
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, c, known)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _cut(self, state: int) -> int:
        """The state of the suffix of ``window`` words of a state's strings."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def match(self, slices: Iterable[list[bytes]]) -> tuple[list[tuple[int, int]], set[str], int, int]:
        """Hit word spans (start, end), merged; the items with an occurring window; the longest match; the number of words."""
        nxt, length, link, window, short = self.next, self.length, self.link, self.window, self.short
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        code = self.vocabulary.get
        state = matched = longest = i = 0
        for i, c in enumerate((c for words in slices for c in map(code, words)), 1):
            if c is None:
                state = matched = 0
                continue
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c not in nxt[state]:
                continue
            state = nxt[state][c]
            matched += 1
            if matched > longest:
                longest = matched
            if matched >= window:
                found |= self.items.get(self._cut(state), set())
                start = i - window
            elif state not in short:
                continue
            else:
                start = i
            for n, item in short.get(state, ()):
                if n <= matched:
                    found.add(item)
                    start = min(start, i - n)
            if start < i:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i))
        return spans, found, longest, i


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Blocks:
    """Automata over blocks of the items: rows (``block``, pickled ``body``) of a staged table."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.numbers = sorted(r["block"] for r in rows.select("block").collect())

    def __len__(self) -> int:
        return len(self.numbers)

    def broadcast(self, n: int) -> Broadcast[bytes]:
        """The n-th automaton, bounded by ``BLOCK_WORDS``; of an empty benchmark, one that matches nothing."""
        body = self.rows.filter(F.col("block") == self.numbers[n]).first()["body"] if self.numbers else pickle.dumps(SuffixAutomaton([]))
        return self.rows.sparkSession.sparkContext.broadcast(bytes(body))


def build_blocks(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, item_id: str = "item_id",
                 text: str = "text") -> Blocks:
    """Automata over blocks of the items, built in tasks."""
    size = max(block_words, 2 * window)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, t in zip(*(batch.column(c).to_pylist() for c in ("item", "text"))):
                words = words_of(t)
                starts = range(0, max(len(words) - window + 1, 1), size - window + 1) if words else ()
                cut = [words[i:i + size] for i in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(cut), pa.string()), pa.array(range(len(cut)), pa.int64()),
                     pa.array([len(c) for c in cut], pa.int64()), pa.array([b" ".join(c) for c in cut], pa.binary())],
                    ["item", "piece", "n_words", "body"])

    def built(pdf: pd.DataFrame) -> pd.DataFrame:
        parts: list[list[tuple[str, list[bytes]]]] = []
        held = size
        for item, n, body in zip(pdf["item"], pdf["n_words"], pdf["body"]):
            if held + n > size:
                parts.append([])
                held = 0
            parts[-1].append((item, body.split(b" ")))
            held += n
        return pd.DataFrame({"body": [pickle.dumps(SuffixAutomaton(part, window)) for part in parts]})

    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.coalesce(text, F.lit("")).alias("text"))
    cut = stage(named.distinct().mapInArrow(pieces, "item string, piece long, n_words long, body binary"), "decontaminate-items")
    words = cut.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    # by a key, not by partitions: the number of blocks must not follow the cluster's
    groups = max(1, -(-words // (size * BLOCKS_A_GROUP)))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("item", "piece"), F.lit(groups)))
    automata = dealt.groupBy("group").applyInPandas(built, "body binary").withColumn("block", F.monotonically_increasing_id())
    return Blocks(stage(automata, "decontaminate-automata"))


_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])


def scan(docs: DataFrame, blocks: Blocks, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with (names after ``prefix``) ``n_words``, ``spans`` (hit word intervals), ``items`` (sorted ids) and ``longest`` (match, in words)."""
    kinds = {"n_words": LongType(), "spans": ArrayType(_SPAN), "items": ArrayType(StringType()), "longest": LongType()}
    name = {k: prefix + k for k in kinds}
    docs = docs.drop(*name.values())
    schema = StructType([*docs.schema.fields, *(StructField(name[k], kind) for k, kind in kinds.items())])
    out = docs.withColumns({name[k]: (F.lit(0) if kind == LongType() else F.array()).cast(kind) for k, kind in kinds.items()})
    live: list[Broadcast[bytes]] = []
    for n in range(max(1, len(blocks))):
        live.append(blocks.broadcast(n))

        def matched(batches: Iterator[pd.DataFrame], block=live[-1]) -> Iterator[pd.DataFrame]:
            automaton = pickle.loads(block.value)
            for pdf in batches:
                sizes, spans, items, longest = [], [], [], []
                for t, old, had, top in zip(pdf[text], *(pdf[name[k]] for k in ("spans", "items", "longest"))):
                    got, found, most, size = automaton.match(word_slices(t))
                    longest.append(max(most, top))
                    sizes.append(size)
                    spans.append([{"start": a, "end": b} for a, b in merged([(s["start"], s["end"]) for s in old] + got)])
                    items.append(sorted(found.union(had)))
                yield pdf.assign(**{name["n_words"]: sizes, name["spans"]: spans, name["items"]: items, name["longest"]: longest})

        out = out.mapInPandas(matched, schema)
        if (n + 1) % BLOCKS_AT_A_TIME == 0 and n + 1 < len(blocks):
            out = stage(out, "decontaminate-blocks")
            while live:
                live.pop().unpersist()
    return out


def hit_words(prefix: str = "") -> Column:
    return F.aggregate(prefix + "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of these (ordered) spans; what separated them from the rest stays."""
    raw = text.encode("utf-8", "surrogatepass")
    out, at, todo = [], 0, iter(spans)
    start, end = next(todo, (-1, -1))
    for n, word in enumerate(_WORD.finditer(raw.translate(_FOLD))):
        if n == start:
            out.append(raw[at:word.start()])
        if n == end - 1:
            at = word.end()
            start, end = next(todo, (-1, -1))
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, blocks: Blocks, max_coverage: float = MAX_COVERAGE, text: str = "text") -> DataFrame:
    """The clean documents, with hit spans cut out; those of which too many words are hit are gone.

    Cutting can bring the two ends of another window together, so a text is
    searched again until nothing is found: with one block in the task that cuts
    it, with several in rounds over the documents cut last, block by block.
    """
    columns, schema = docs.columns, docs.schema
    found = scan(docs, blocks, text, "__").filter(hit_words("__") <= F.col("__n_words") * max_coverage)
    only = blocks.broadcast(0) if len(blocks) <= 1 else None

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = pickle.loads(only.value) if only else None
        for pdf in batches:
            texts = []
            for t, spans in zip(pdf[text], pdf["__spans"]):
                todo = [(s["start"], s["end"]) for s in spans]
                while todo:
                    t = cut_spans(t, todo)
                    todo = automaton.match(word_slices(t))[0] if automaton else []
                texts.append(t)
            yield pdf.assign(**{text: texts})[columns]

    if only:
        return found.mapInPandas(cut, schema)
    found = stage(found, "decontaminate-found")
    clean = [found.filter(F.size("__spans") == 0).select(*columns)]
    while not (hit := found.filter(F.size("__spans") > 0)).isEmpty():
        found = stage(scan(hit.mapInPandas(cut, schema), blocks, text, "__"), "decontaminate-again")
        clean.append(found.filter(F.size("__spans") == 0).select(*columns))
    return reduce(DataFrame.unionAll, clean)
