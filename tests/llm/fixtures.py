"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WIDE_SCHEMA = DOC_SCHEMA + ", " + ", ".join(
    f"{c} string" for c in "score size shard slot spans items fp component_id place label host rule taken target keep_id".split())


def vocabulary(n=400, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghiklmnoprstuvwz") for _ in range(rnd.randint(3, 9))) for _ in range(n)]


def prose(n_words, seed, vocab=None):
    rnd = random.Random(seed)
    vocab = vocab or vocabulary()
    words = [rnd.choice(vocab) for _ in range(n_words)]
    for i in range(0, n_words, 12):
        words[i] = words[i].capitalize()
        words[i - 1] += "."
    return " ".join(words)


def awkward_docs():
    base = prose(80, 7)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "b"), (2, base, "en", "b"),  # copies and a repeated row
        (3, base.replace(" ", "  \t\n"), "en", None), (4, base.upper(), None, "a"),
        (5, None, None, None), (6, "", "en", "a"), (7, " \n\t ", "de", "b"), (None, base, "en", "a"), (None, None, None, None),
        (8, "one two", "en", "a"), (9, "one", "en", "b"), (9, "another text with one id", "fr", "b"),
        (10, "é ü ß 日本語 \U0001F600 <|im_end|> \\ %0A", "de", "c"), (11, "!!! ... 123 456", "en", "c"),
        (12, prose(30_000, 3), "en", "c"), (13, "word " * 5000, "es", "c"), (14, "x" * 300_000, None, "c"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]


def docs_frame(spark, rows=None, wide=False):
    rows = awkward_docs() if rows is None else rows
    if wide:
        return spark.createDataFrame([(*r, *["?"] * 15) for r in rows], WIDE_SCHEMA)
    return spark.createDataFrame(rows, DOC_SCHEMA)
