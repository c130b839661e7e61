from __future__ import annotations

import hashlib
import json
import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderloom.llm import bpe
from orderloom.llm.bpe import Encoder, Vocabulary, decode, encode, read_vocabulary, round_trip
from orderloom.llm.queries import BYTE_BPE, QUERIES

LIBRARY = Tokenizer.from_file(BYTE_BPE)
ENCODER = Encoder(Vocabulary(read_vocabulary(BYTE_BPE)))

ODD = [
    "", " ", "aaaaaaa aaaa aaa", "a" * 300, "  a  b \n\n c\n d\t\te ", "it's we'll I'd 'x' don't", "\x1c\x1d a\x1fb \x85 c",
    "<|endoftext|>hi<|endoftext|><|endoftext|> x", "<|endoftext|", "á   z　 q", "12 345 ½ ² ٣", "😀😀 👍🏽 x​z",
    "日本語 テスト。", " " * 40 + "x", "\r\n\r\n x \r", "\x00\x01", "İstanbul ß ﬁ", "the the the theathe",
]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert ENCODER.ids([text])[0].tolist() == library(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abtheing 'sé\n\t  1.,!ß日\u0301"), max_size=60), max_size=5))
def test_equals_the_library(texts):
    assert [i.tolist() for i in ENCODER.ids(texts)] == [library(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_any_characters_round_trip(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    ids = ENCODER.ids([text])[0]
    assert b"".join(ENCODER.vocabulary.bytes[i] for i in ids.tolist()).decode() == text


def test_a_small_memory_changes_nothing():
    small = Encoder(ENCODER.vocabulary, most_units=3)
    for _ in range(3):
        assert [i.tolist() for i in small.ids(ODD)] == [library(t) for t in ODD]


def test_what_units_share_is_merged_once(monkeypatch):
    taken = []
    merge = bpe.merge_pieces
    monkeypatch.setattr(bpe, "merge_pieces", lambda pieces, v: taken.extend(pieces) or merge(pieces, v))
    texts = ["a word, a word. a word; it's word's", " word <|endoftext|>, word ,,", "<|endoftext|>", "word word"]
    assert [i.tolist() for i in Encoder(ENCODER.vocabulary).ids(texts)] == [library(t) for t in texts]
    assert taken.count(b" word") == 1 and len(taken) == len(set(taken))


def test_memory_for_texts_of_new_words():
    draw = random.Random(5)
    words = ["".join(draw.choices(["re", "st", "an", "ä", "ou", "ch"], k=draw.randint(2, 5))) for _ in range(120_000)]
    texts = [" ".join(f"{w}{draw.choice(['', ',', '.'])}" for w in draw.choices(words, k=500)) for _ in range(2000)]
    encoder = Encoder(ENCODER.vocabulary)
    tracemalloc.start()
    try:
        for start in range(0, len(texts), 500):
            encoder.ids(texts[start : start + 500])
        assert tracemalloc.get_traced_memory()[1] < 18e6
    finally:
        tracemalloc.stop()


def test_disordered_merges_are_refused():
    parts = json.loads(read_vocabulary(BYTE_BPE))
    parts["model"]["merges"].reverse()
    with pytest.raises(ValueError, match="later merge"):
        Vocabulary(json.dumps(parts))


def test_columns(spark):
    rows = [(k, t, b"old") for k, t in enumerate(ODD)] + [(50, None, None), (0, "", None), (51, "long word " * 30_000, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, IDS binary")
    coded = decode(encode(df, BYTE_BPE), BYTE_BPE)
    assert coded.columns == ["doc_id", "text", "ids", "decoded"]
    for row in coded.collect():
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert ids == library(row["text"] or "")
        assert row["decoded"] == LIBRARY.decode(ids, skip_special_tokens=False) == (row["text"] or "")
    assert encode(df.limit(0), BYTE_BPE).count() == 0
    both = round_trip(df, BYTE_BPE)
    assert both.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(repr, both.collect())) == sorted(map(repr, coded.drop("text").collect()))


def test_decoding_bad_ids(spark):
    ids = lambda *x: np.array(x, "<u4").tobytes()
    accent = ENCODER.vocabulary.of_byte[0xC3]
    df = spark.createDataFrame([(1, None), (2, b""), (3, ids(accent)), (4, ids(4_000_000_000))], "doc_id int, ids binary")
    got = {r["doc_id"]: r["decoded"] for r in decode(df, BYTE_BPE).collect()}
    assert got == {1: None, 2: "", 3: "�", 4: ""}


def test_the_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    expected = {}
    for doc, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        back = LIBRARY.decode(ids, skip_special_tokens=False).encode()
        expected[doc] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back).hexdigest())
    got = QUERIES["op4_bpe"](spark, folder)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()} == expected
