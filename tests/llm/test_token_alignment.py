from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm import token_alignment
from orderloom.llm.queries import BYTE_BPE, PIECES, QUERIES
from orderloom.llm.token_alignment import WIDE_GROUP, aligned, byte_letters, coalesced, expanded

TEXTS = [
    None, "", " ", "   ", "plain words here", "plain words here", "a  b\n\n c\td", "it's  don't\n\n\n  x",
    "<|endoftext|> and </s> stay text", "▁ is a mark", "é😀　中文字\r\n tab", "trail  ", "\n lead", "\x00 nul",
    "== == " * 40, "longwordwithoutanyblank" * 300, "Ünïcödé " * 5, "1234567890 " * 9,
]


def token_bytes():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = byte_letters()
    of_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return (lambda t: a.encode(t, add_special_tokens=False).ids), b.encode, of_a, of_b


def brute_force(texts: list[str | None]) -> list[tuple]:
    """Whole texts through both libraries; every common end cuts; pairs counted one by one."""
    encode_a, encode_b, of_a, of_b = token_bytes()
    groups = []
    for text in texts:
        ia, ib = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if b"".join(map(of_a, ia)) != raw or b"".join(map(of_b, ib)) != raw:
            groups.append([])
            continue
        ends_a, ends_b = np.cumsum([len(of_a(i)) for i in ia]), np.cumsum([len(of_b(i)) for i in ib])
        own, i, j = [], 0, 0
        for cut in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            u, v = int(np.searchsorted(ends_a, cut)) + 1, int(np.searchsorted(ends_b, cut)) + 1
            own.append((ia[i:u], ib[j:v]))
            i, j = u, v
        groups.append(own)
    links = [Counter((x, y) for a, b in own for x in a for y in b) for own in groups]
    held = Counter(pair for found in links for pair in found)
    highest = Counter()
    for (a, _), n in held.items():
        highest[a] = max(highest[a], n)
    return [
        (
            sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), found.total(),
            sum(n for p, n in found.items() if held[p] == highest[p[0]]), sum(n * held[p] for p, n in found.items()),
            ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own),
        )
        for own, found in zip(groups, links)
    ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("slice_bytes", [40, 1 << 20])
def test_edges_equal_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(token_alignment, "ALIGNED_BYTES", slice_bytes)
    rows = [(None if k == 5 else k, t, 9, "x") for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int, groups string").repartition(3)
    got = aligned(df, BYTE_BPE, PIECES).collect()
    expected = brute_force(TEXTS)
    assert len(got) == len(TEXTS)
    assert {r.id: tuple(r[c] for c in COLUMNS) for r in got} == {(None if k == 5 else k): e for k, e in enumerate(expected)}
    assert expected[4][2] > 0 and expected[9] == (0,) * 6 + ("",)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert aligned(df, BYTE_BPE, PIECES).collect() == []


def test_the_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = {
        d.doc_id: (*e[:6], hashlib.sha256(e[6].encode()).hexdigest() if e[6] else "")
        for d, e in zip(docs, brute_force([d.text for d in docs]))
    }
    got = QUERIES["op13_token_alignment"](spark, folder)
    columns = [*COLUMNS[:6], "groups_sha256"]
    assert sorted(got.columns) == sorted(["doc_id", *columns])
    assert {r.doc_id: tuple(r[c] for c in columns) for r in got.collect()} == expected


def test_wide_groups_are_expanded_by_distinct_ids():
    rng = np.random.default_rng(3)
    a_len, b_len = np.array([2] + [4] * 149 + [2]), np.full(150, 4)  # ends at 2, 6, 10 ... and at 4, 8, 12 ...
    a_groups, b_groups = coalesced(a_len, b_len)
    assert a_groups.max() == b_groups.max() == 0 and len(a_len) * len(b_len) > WIDE_GROUP
    a_ids, b_ids = rng.integers(0, 9, 151).astype(np.uint32), rng.integers(0, 7, 150).astype(np.uint32)
    docs, codes, counts = expanded(a_ids, b_ids, a_groups, b_groups, np.zeros(151, np.int64), 7)
    assert counts.sum() == 151 * 150 and len(codes) == len(set(codes.tolist())) <= 63
    assert dict(zip(codes.tolist(), counts.tolist())) == Counter(int(a) * 7 + int(b) for a in a_ids for b in b_ids)


def test_counts_are_documents_not_links(spark):
    df = spark.createDataFrame([(1, "a a a a"), (2, "a"), (3, "a b")], "doc_id long, text string")
    rows = {r.id: r for r in aligned(df, BYTE_BPE, PIECES).collect()}
    assert rows[1].count_sum == 12 and rows[2].count_sum == 3 and rows[3].count_sum == 4
    assert aligned(df, BYTE_BPE, PIECES, groups=F.length("groups")).filter("groups > 0").count() == 3
