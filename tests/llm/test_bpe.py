from __future__ import annotations

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from streakline.llm import bpe
from tests.llm.conftest import odd_rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def expected(library, rows):
    out = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        out.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


TRICKY = [
    "<|endoftext|>",
    "a <|endoftext|> b<|endoftext|>c  <|endoftext|>",
    "it's  we'll\n\n they 're\t\tx \u00a0 y\u2003z \x1c q \x85 r",
    "  leading and trailing  ",
    "tabs\t \tand \n newlines \r\n 's 't 're",
    "日本語 テキスト 𝄞 e\u0301 \u200b zero",
    "123 4567 8.9 ... !!! ''s",
    " ",
    "\n",
]


def test_odd(odd, library):
    assert sorted(map(tuple, bpe.measure_encoding(odd).collect()), key=str) == expected(library, odd_rows())


def test_tricky_texts(spark, library):
    rows = list(enumerate(TRICKY))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, bpe.measure_encoding(docs).collect()), key=str) == expected(library, rows)


def test_words_join_to_the_text():
    for t in TRICKY:
        assert "".join(bpe.words_of(t)) == t
    assert bpe.words_of(None) == []


def test_small_blocks_give_the_same(odd, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 2_000)
    monkeypatch.setattr(bpe, "PACK_CHARS", 500)
    assert sorted(map(tuple, bpe.measure_encoding(odd).collect()), key=str) == expected(library, odd_rows())


def test_round_trip_through_tables(odd):
    encoded = bpe.encode_documents(odd, keep=("doc_id", "h"))
    assert encoded.columns == ["doc_id", "h", "ids", "decoded"]
    texts = sorted((r["text"] or "" for r in odd.collect()))
    assert sorted(r["decoded"] for r in encoded.collect()) == texts
    assert sorted(r["text"] for r in bpe.decode_table(encoded).collect()) == texts


def test_other_vocabularies_are_a_parameter(spark, library):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    found = bpe.encode_documents(docs, bpe.default_path()).first()
    assert found["ids"] == library.encode("some text", add_special_tokens=False).ids


def test_empty(none):
    assert bpe.measure_encoding(none).collect() == []
    assert bpe.decode_table(bpe.encode_documents(none)).collect() == []
