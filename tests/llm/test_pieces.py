"""Encoding and decoding against the library on whole texts."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from stayline.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_every_row_as_the_library(awkward, library):
    rows = pieces.encoded(awkward, "text", MODEL).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        ids = library.encode(r["text"] or "")
        assert r["ids"] == ids
        assert r["decoded"] == (library.decode(ids) if ids else "")


def test_columns_and_empty_table(awkward, empty):
    clash = awkward.withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    out = pieces.encoded(clash, "text", MODEL)
    assert sorted(out.columns) == sorted(clash.columns)
    assert pieces.encoded(empty, "text", MODEL).count() == 0


def test_encode_and_decode_columns(awkward, library):
    out = awkward.select("text", pieces.encode("text", MODEL).alias("ids"))
    for r in out.select("text", pieces.decode("ids", MODEL).alias("back")).collect():
        ids = library.encode(r["text"] or "")
        assert r["back"] == (library.decode(ids) if ids else "")


@settings(max_examples=2000, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab ▁\n\té😀́<s>/."), max_size=40))
def test_words_join_to_whole_text(text):
    own = pieces.Segmenter.of(MODEL)
    got = own.encode(text)
    ids = [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)]
    assert ids == own.model.encode(text)


def test_table_starts_anew(monkeypatch, library):
    monkeypatch.setattr(pieces, "TABLE_WORDS", 3)
    own = pieces.Segmenter(MODEL)
    for text in ("a b c d e", "f g h", "a f a f z"):
        got = own.encode(text)
        assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == library.encode(text)


@pytest.mark.parametrize("end", [" ", "\t", "\n", "  ", "▁", " ▁", "\n ", "\t \n"])
def test_lone_marker_at_the_end(spark, library, tmp_path, end):
    texts = ["a" + end, end, "a b" + end, "é." + end]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.queries()["op9_pieces"](spark, str(tmp_path)).collect():
        ids = library.encode(texts[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_query(spark, folder, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.queries()["op9_pieces"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
