from __future__ import annotations

import math
import random

from orderloom.llm.queries import PIECES, QUERIES
from orderloom.llm.token_counts import WORD_START, Pieces, count_words, load_pieces, with_token_counts


def every_segmentation(word, pieces):
    """Best score and fewest tokens over all ways to cut a word."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            part = word[start:end]
            if part in pieces.score:
                options.append((best[start][0] + pieces.score[part], best[start][1] + 1))
            elif len(part) == 1:
                size = len(part.encode())
                options.append((best[start][0] + pieces.fallback * size, best[start][1] + size))
        best[end] = max(options, key=lambda o: (o[0], -o[1]))
    return best[-1][1]


def test_equals_dynamic_programming_word_by_word():
    rng = random.Random(2)
    pieces = Pieces(["a", "b", "ab", "ba", "aab", "bb", "abab", WORD_START, WORD_START + "a"])
    words = [WORD_START + "".join(rng.choice("abcé") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    words += words[:5]
    assert count_words(words, pieces).tolist() == [every_segmentation(w, pieces) for w in words]


def test_prefixes_are_scored_once():
    calls = []

    class Counted(Pieces):
        def ends_at(self, word, end):
            calls.append(word[:end])
            return super().ends_at(word, end)

    count_words(["abc", "abd", "ab", "abc"], Counted(["a", "b", "c", "d"]))
    assert sorted(calls) == ["a", "ab", "abc", "abd"]


def test_texts(spark):
    pieces = Pieces(load_pieces(PIECES))
    texts = [None, "", " \n\t", "The cat sat.", "The cat sat.", "日本語 ǘ \x00", "word " * 20_000, "y" * 5_000]
    df = spark.createDataFrame([(k, t, 9) for k, t in enumerate(texts)], "doc_id int, text string, N_Tokens int")
    got = with_token_counts(df, PIECES)
    assert got.columns == ["doc_id", "text", "n_words", "n_tokens"]
    for row in got.collect():
        words = (row["text"] or "").split()
        counts = {w: every_segmentation(WORD_START + w, pieces) if len(w) < 100 else int(count_words([WORD_START + w], pieces)[0]) for w in set(words)}
        assert row["n_words"] == len(words) and row["n_tokens"] == sum(counts[w] for w in words)
    assert with_token_counts(df.limit(0), PIECES).count() == 0


def test_a_small_memory_changes_nothing(spark):
    df = spark.createDataFrame([(k, f"w{k} common") for k in range(50)], "doc_id int, text string")
    one, other = (with_token_counts(df, PIECES, most_units=n).orderBy("doc_id").collect() for n in (1, 10_000))
    assert one == other


def test_the_query_equals_brute_force(spark):
    folder, pieces = "/root/testdata/sf0.001", Pieces(load_pieces(PIECES))
    counts, expected = {}, {}
    for doc, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        words = (text or "").split()
        for word in set(words) - counts.keys():
            counts[word] = every_segmentation(WORD_START + word, pieces)
        expected[doc] = (len(words), sum(counts[w] for w in words))
    got = QUERIES["op5_token_counts"](spark, folder)
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in got.collect()} == expected
