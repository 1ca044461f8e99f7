"""Token counts against the library itself."""

from functools import cache

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from twinscope.llm import queries, tokencount

from .conftest import rows_of

SF = "/root/testdata/sf0.01"


@cache
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=tokencount.model_bytes(None))


@cache
def counter():
    model = tokencount.model_bytes(None)
    return tokencount.Counter(model, tokencount.prove_whole_tokens(model))


def test_query_against_library(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in queries.op13_token_counts(spark, SF).collect()}
    want = {i: (len(t.encode()), len(library().encode(t))) for i, t in texts.items()}
    assert {i: (r.n_bytes, r.n_tokens) for i, r in rows.items()} == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in rows.values())


PARTS = [" ", "  ", "▁", "▁▁", "a", "the", "of", "\n", "\t", "漢", "é", "<s>", "</s>", "<unk>", "<0x0A>", "\x00", "   x", "🙂", "won't", "　", " ", "Ünder", "0123", "...."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.text(max_size=20), min_size=1, max_size=8))
def test_any_text(texts):
    assert counter().of_texts(pa.array(texts, pa.string())).tolist() == [len(library().encode(t)) for t in texts]


def test_proved_words_are_one_token():
    words = counter().whole.to_pylist()[:-1]
    assert len(words) > 10_000 and all(len(ids) == 1 for ids in library().encode(words))


def test_null_and_slices():
    texts = pa.array(["x", None, "", " ", "a b", None])
    assert counter().of_texts(texts).tolist() == [1, 0, 0, 1, 2, 0]
    assert counter().of_texts(texts.slice(3, 2)).tolist() == [1, 2]
    assert counter().of_texts(texts.slice(0, 0)).tolist() == []


def test_odd_documents(spark, odd_docs, no_docs):
    clash = odd_docs.selectExpr("*", "'x' AS n_tokens")
    out = rows_of(tokencount.count_tokens(clash))
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in out) == sorted((str(r["doc_id"]), len(library().encode(r["text"] or ""))) for r in rows_of(odd_docs))
    assert rows_of(tokencount.count_tokens(no_docs)) == []


def test_models_without_the_facts_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(tokencount.model_bytes(None))
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="changes texts"):
        tokencount.prove_whole_tokens(proto.SerializeToString())
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.pieces[300].piece = "a▁b"
    with pytest.raises(ValueError, match="across a space"):
        tokencount.prove_whole_tokens(proto.SerializeToString())
