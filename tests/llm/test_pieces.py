import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from fixtures import DOC_SCHEMA, awkward_docs, docs_frame
from surveil.llm import pieces
from surveil.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "   ", "\n", "\t", "a", "the", "ing", "<s>", "</s>", "<unk>", "<0x0A>", "▁", "é", "日本", "😀", "\x00", "1", "23", "\r\n",
         " ", "é", "�", "ß", " ", "=", "==", "//", "http://", "​", "͸"]


@pytest.fixture(scope="module")
def model():
    return pieces.Vocabulary(pieces.model_bytes(PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("slice_size", [1 << 20, 5])
def test_agenda_is_the_librarys_encoding(model, library, monkeypatch, slice_size):
    monkeypatch.setattr(pieces, "SLICE", slice_size)
    rnd = random.Random(slice_size)
    for _ in range(4000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30)))
        theirs = library.encode(text, add_bos=True, add_eos=True)
        ids = model.encode(text)
        assert ids == pieces.packed(theirs), text
        assert model.decode(ids) == library.decode(theirs), text
        assert model.library_agrees(text, ids, model.decode(ids))


def test_long_words_and_texts_need_no_cut(model, library):
    rnd = random.Random(3)
    for text in ("x" * 20_000, "".join(rnd.choice("abcdeé") for _ in range(20_000)), " " * 5000, "日" * 5000):
        assert model.encode(text) == pieces.packed(library.encode(text, add_bos=True, add_eos=True))


def test_decoding_of_any_ids_is_the_librarys(model, library):
    rnd = random.Random(4)
    for _ in range(2000):
        ids = [rnd.randrange(3, 600) for _ in range(rnd.randint(0, 9))]
        assert model.decode(pieces.packed(ids)) == library.decode(ids), ids


def test_a_disagreement_is_reported(model):
    ids = model.encode("one two")
    assert model.library_agrees("one two", ids, "one two")
    assert not model.library_agrees("one two", ids, "one  two")
    assert not model.library_agrees("one two", ids[:-8] + ids[-4:], "one two")
    assert not model.library_agrees("one two", ids[:4] + ids[8:12] + ids[8:], "one two")


def test_remembered_cuts_are_bounded(model, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))
    assert model.encode(text) == model.encode(text)
    model.encode("a b")
    assert len(model) <= 11 and len(model._older) < 400


@pytest.mark.parametrize("wide", [False, True])
def test_query_rows_of_awkward_documents(spark, tmp_path, library, wide):
    docs_frame(spark, wide=wide).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op13_sentencepiece"](spark, str(tmp_path)).collect()

    def expected(doc_id, text):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        return (doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), True)

    assert sorted(map(str, map(tuple, rows))) == sorted(str(expected(r[0], r[1])) for r in awkward_docs())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op13_sentencepiece"](spark, str(tmp_path)).collect() == []
