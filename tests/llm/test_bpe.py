"""Segment-tree BPE against the tokenizers library."""

import hashlib
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spendlink.llm import bpe
from spendlink.llm.common import table


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_vocabulary(bpe.default_path())[0])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def row(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


ODD = [
    "", " ", "a", "  x\u0085​\x1c y\x1f", "it's we'll I'D 'S  \n\n  x ", "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>",
    "<|endoftext|", "é" * 70, "a" * 5000, " " * 700 + "x", "=" * 300, "\U0001f600\U0001f468‍\U0001f469", "Ⅷ½٣一二三 ①", "é́ ñ",
    "ab" * 40, "the the\tthe\r\nthe", "x" * 63, "y" * 64, "z" * 65, "퟿￿",
]


def test_odd_texts(codec, library):
    for text, ids in zip(ODD, codec.encode(ODD), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:20]
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(codec, library, text):
    assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_one_tree_equals_many(codec):
    words = ["Donaudampfschifffahrt", "internationalization", "aaaaaaaaaaaaaaaa", "zé" * 9, "ab"]
    for word in words:
        raw = word.encode()
        ids, _ = bpe.merge_rows([raw], 1 << (len(raw) - 1).bit_length(), codec.vocab)
        assert ids.tolist() == bpe.merge_long(raw, codec.vocab).tolist()


def test_rows(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(None, None, None), (3, "same", "x"), (3, "same", "x"), (99, "word " * 30000, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    out = sorted((tuple(r) for r in bpe.digests(df, bpe.default_path()).collect()), key=str)
    assert out == sorted(((i, *row(library, t)) for i, t, _ in rows), key=str)
    assert bpe.digests(df.limit(0), bpe.default_path()).collect() == []
    back = bpe.decoded(bpe.encoded(df.drop("ids"), bpe.default_path()), bpe.default_path())
    assert all(r.decoded == (r.text or "") for r in back.collect())


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    want = sorted((r.doc_id, *row(library, r.text)) for r in table(spark, sf, "documents").collect())
    assert sorted(tuple(r) for r in bpe.query(spark, sf).collect()) == want
