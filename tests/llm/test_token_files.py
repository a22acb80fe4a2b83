import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import SF, awkward, no_docs, pairs, read  # noqa: F401
from tokenizers import Tokenizer

from tabscope.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def listed(docs, ids):
    out, start = [], 0
    for doc, text in docs:
        n = ids(text)
        out.append((doc, start, len(n), zlib.crc32(np.array(n, "<u4").tobytes())))
        start += len(n)
    return out


def test_query_gives_back_what_the_tokenizer_gave(spark, ids):
    docs = [(r.doc_id, r.text) for r in read(spark, "documents").orderBy("doc_id").collect()]
    assert pairs(token_files.op5_token_files(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == listed(docs, ids)


def test_awkward_texts_in_many_files(spark, awkward, ids):
    folder = "file://" + tempfile.mkdtemp()
    files = token_files.write_token_files(awkward, folder, PATH, end_id=2, file_bytes=60)
    assert len(files) > 3 and sum(f["documents"] for f in files) == awkward.count()
    got = token_files.read_token_files(spark, files).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in got], key=lambda i: (i is not None, i or 0))
    want = sorted((len(n := ids(r.text)), zlib.crc32(np.array(n, "<u4").tobytes())) for r in awkward.collect())
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == want
    found = [x.tolist() for f in files for x in token_files.TokenFile(f["path"]).find(9)]
    assert sorted(found) == sorted(ids(r.text) for r in awkward.where("doc_id = 9").collect())


def test_fragments_and_encoder(ids):
    encode = token_files.Encoder(PATH)
    texts = ["", " ", "a b", "  a  b ", "a\n b", "a b\n", "it's a <|endoftext|> b", "é ñ　x y", " lead", "trail "]
    for text, got in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(got, encode.kind).tolist() == ids(text)[:-1]


def test_no_rows_and_changed_dictionary(spark, no_docs, awkward):
    folder = "file://" + tempfile.mkdtemp()
    assert token_files.write_token_files(no_docs, folder, PATH) == []
    assert token_files.read_token_files(spark, []).collect() == []
    files = token_files.write_token_files(awkward.limit(3), folder, PATH)
    path = files[0]["path"].removeprefix("file://")
    with open(path, "r+b") as f:
        f.seek(-8, 2)
        f.write(b"damaged!")
    with pytest.raises(ValueError):
        token_files.TokenFile(files[0]["path"])


def test_fragments_are_encoded_once_and_without_offsets(monkeypatch):
    encode = token_files.Encoder(PATH)
    texts = ["one two  two\tthree one", "", "two one é one", "x" * 100 + " " + "y" * 100 + " one", "　a b a b", "b " + "y" * 100 + " " + "y" * 100]
    want = [encode.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    asked = []

    class Fast:
        def encode_batch_fast(self, some, **kw):
            asked.append(some)
            return whole.encode_batch_fast(some, **kw)

    whole, encode.tokenizer = encode.tokenizer, Fast()
    for _ in range(2):
        assert [np.frombuffer(x, encode.kind).tolist() for x in encode(texts)] == want
    assert sum(" one" in x for some in asked for x in some) == 1 and all(len(x) <= token_files._LONGEST for x in encode.kept)


def test_words_before_marks_are_encoded_once(ids):
    encode = token_files.Encoder(PATH)
    encode.kept.clear()
    texts = ["Wort Wort, Wort.\nÜber Wort!! Wort", "Wort; Über\nWort", "a.b it's über."]
    assert [np.frombuffer(x, encode.kind).tolist() for x in encode(texts)] == [ids(t)[:-1] for t in texts]
    # With the white space that they follow; a word before a mark is no fragment of its own.
    assert sorted(encode.kept) == sorted(["\nWort", " Wort", ",", ".", "\nÜber", "!!", ";", " Über", "\na", ".b", " it's", " über"])


def test_fragments_do_not_touch_in_a_batch(ids):
    encode = token_files.Encoder(PATH)
    marks = ["", "a", "é", "×", "'s", ".", "!!", " ", "  ", "\n", "\n\n", "\t", "\x85", "<|endoftext|>", "<|endof", "1"]
    texts = [a + b + c + d for a in marks for b in marks for c in marks for d in marks[:8]]
    assert [np.frombuffer(x, encode.kind).tolist() for x in encode(texts)] == [ids(t)[:-1] for t in texts]
