from __future__ import annotations

import hashlib
import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidegauge.llm import bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "\n\n a", "a\n\nb", "The cat's mat, 12345 times!!", "naïve façade – “quotes” 日本語 👍🏽 x", "<|endoftext|>",
    "a<|endoftext|><|endoftext|> b", "   lead and trail   ", "\t\t tab\r\n", "aaaa" * 300, "   spaces 　",
    "don't DON'T we'll 'S", "\x00\x01 control \x7f", "ß" * 50 + "\n" * 7 + "é", "0" * 700, "!?" * 400,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def coder():
    with open(FILE, encoding="utf-8") as file:
        return bpe.Coder(json.load(file))


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library(coder, library, text):
    ids = coder.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab \n\t'.<|>sé日1", max_size=60))
def test_any_text(coder, library, text):
    ids = coder.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_broken_sequences_are_replaced(coder, library):
    ids = coder.encode("日")[:1]
    assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_cuts_are_certain(coder):
    """No vocabulary token holds a pair at which a text is cut."""
    raw = [b for b in coder.bytes_of.values() if b not in {t.encode() for t in coder.special}]
    assert all(pair in coder.joined for b in raw for pair in zip(b, b[1:], strict=False))


def test_memory_is_bounded_and_keeps_what_is_used(coder):
    memory = bpe.Memory(3)
    for i in range(20):
        memory.put(i, i + 1)
        assert memory.get(0) == 1
        assert len(memory.young) + len(memory.old) <= 6


def test_long_fragments_merge_as_short_ones(coder, monkeypatch):
    fragments = [b"aaaaaaa", b"abababab" * 5, b"thethethe" * 6, b"=" * 50]
    short = [coder.merge(f) for f in fragments]
    monkeypatch.setattr(bpe, "LONG", 1)
    assert [coder.merge(f) for f in fragments] == short


def test_report(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, None, TEXTS[4]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_report(docs, FILE).collect()}
    assert got == want
    assert bpe.encode_report(docs.limit(0), FILE).collect() == []


def test_encode_and_decode_keep_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "keep"), (2, None, None)], "doc_id long, text string, `odd name` string")
    back = bpe.decode(bpe.encode(docs, FILE), FILE, into="back").orderBy("doc_id").collect()
    assert [(r["odd name"], r["back"]) for r in back] == [("keep", "a b"), (None, "")]
