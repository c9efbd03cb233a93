import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm import token_counts as T

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abeht the\n\t▁é梦<s>/\x00ﬁ🙂", max_size=90), max_size=6))
def test_counts_match_the_library(texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = T.merger(MODEL).count_texts(pa.array(texts, pa.string())).tolist()
    assert got == [len(sp.encode(t)) for t in texts]


@pytest.mark.parametrize("text", ["", " ", "  ", "x" * 900, "the" * 200, "▁" * 70, " " * 77, "<0x00></s><unk>", "a" * 63, "a" * 64, "a" * 65])
def test_long_and_odd_tokens(library, text):
    assert T.merger(MODEL).count_texts(pa.array([text]))[0] == len(library.encode(text))


def test_operator_on_edges(make_docs, edge_rows, library):
    out = T.token_counts(make_docs(edge_rows), MODEL).collect()
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or ""))) for i, t in edge_rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == want
    assert T.token_counts(make_docs([]), MODEL).count() == 0


def test_documents(make_docs, small_docs, library):
    out = {r.doc_id: r.n_tokens for r in T.token_counts(make_docs(small_docs), MODEL).collect()}
    assert out == {i: len(library.encode(t)) for i, t, _ in small_docs}
