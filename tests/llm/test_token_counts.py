import public_tokenizers
import pytest
import sentencepiece

from llm_helpers import SF, awkward, no_docs, pairs, read  # noqa: F401

from tabscope.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def direct():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return lambda text: len(model.encode(text or ""))


@pytest.mark.parametrize("frequent", [0, 5, 100_000])
def test_counts_are_those_of_whole_texts(spark, awkward, direct, frequent):
    got = pairs(token_counts.count_tokens(awkward, MODEL, frequent=frequent), "doc_id", "n_bytes", "n_tokens")
    want = [(r.doc_id, len((r.text or "").encode()), direct(r.text)) for r in awkward.collect()]
    assert got == sorted(want, key=lambda t: tuple((v is not None, v or 0) for v in t))


def test_no_rows(no_docs):
    assert token_counts.count_tokens(no_docs, MODEL).collect() == []


def test_query(spark, direct):
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in token_counts.op2_token_counts(spark, SF).collect()}
    assert got == {r.doc_id: (direct(r.text), direct(r.text) > 4096) for r in read(spark, "documents").collect()}
