from __future__ import annotations

import random
import re

import pytest

from orderloom.llm.decontaminate import _blocks, hit_words, with_overlap

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def plain(docs, items):
    out = {}
    for doc, text in docs:
        w, hit, owners = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            k = min(10, len(p))
            windows = {tuple(p[i : i + k]) for i in range(len(p) - k + 1)} if k else set()
            for i in range(len(w)):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    owners.add(str(item))
        out[doc] = (len(w), len(hit), sorted(owners))
    return out


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "D", "é", "7", "x_y", "don't"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, some(rng.randint(10, 25))) for k in range(20)]
    items += [(20, "Short, one!"), (21, "Short one"), (22, ""), (23, None), (24, "..."), (3, some(12)), (25, items[0][1])]
    docs = [(k, some(rng.randint(0, 200))) for k in range(60)]
    docs += [(100 + n, f"{some(5)}. {text} -- {some(5)}") for n, (_, text) in enumerate(items) if text]
    docs += [(200, None), (201, ""), (202, "-- .."), (203, some(30_000)), (204, "a SHORT\tone b"), (204, "a SHORT\tone b")]
    docs.append((205, (items[2][1] or "").upper()))
    return docs, items


def frames(spark, cases):
    docs, items = cases
    return (
        spark.createDataFrame([(d, t, [1], 5) for d, t in docs], "doc_id int, text string, Items array<int>, lang int"),
        spark.createDataFrame(items, "item_id int, text string"),
    )


@pytest.mark.parametrize("chars", [3_000_000, 500])
def test_equals_every_window_in_turn(spark, cases, chars):
    docs, benchmark = frames(spark, cases)
    found = with_overlap(docs, benchmark, automaton_chars=chars)
    assert "lang" in found.columns and "Items" not in found.columns
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in found.withColumn("n_hit", hit_words()).collect()}
    assert got == plain(*cases)


def test_spans_are_offsets_of_the_original(spark):
    text = "Ünd now: The QUICK, brown fox; jumps over the lazy dog today – and 5 more words here."
    item = "the quick brown fox jumps over the lazy dog today and 5 more"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    row = with_overlap(docs, spark.createDataFrame([("q", item)], "item_id string, text string")).first()
    (span,) = row["spans"]
    assert text[span["start"] : span["end"]].startswith("The QUICK")
    assert words(text[span["start"] : span["end"]])[:10] == words(item)[:10]


def test_empty_tables(spark, cases):
    docs, benchmark = frames(spark, cases)
    assert with_overlap(docs.limit(0), benchmark).count() == 0
    nothing = with_overlap(docs, benchmark.limit(0)).collect()
    assert len(nothing) == len(cases[0]) and not any(r["hits"] or r["items"] for r in nothing)


def test_a_repeated_item_is_collected_once(spark):
    rows = [(1, "the same passage again")] * 300 + [(k, f"passage number {k}") for k in range(2, 22)]
    benchmark = spark.createDataFrame(rows, "item_id int, text string")
    blocks = list(_blocks(benchmark, "item_id", "text", 200))
    assert sorted(r for b in blocks for r in b) == sorted({(str(k), t) for k, t in rows})
    assert len(blocks) == 2
