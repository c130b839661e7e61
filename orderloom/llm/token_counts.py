"""Unigram token counts by dynamic programming over a shared trie of pre-tokens."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.rows import add_columns, texts_of
from orderloom.llm.units import MOST_UNITS, WORDS, UnitCache

WORD_START = "▁"


class Pieces:
    """Pieces of a vocabulary with unigram scores.

    The file gives pieces by rank, no probabilities; a rank r scores -ln(r + 2), as in
    Zipf's law. A character that is no piece is worth a score below every piece and
    counts as its UTF-8 bytes, as byte fallback writes it.
    """

    def __init__(self, ranked: list[str]):
        self.score = {p: -math.log(r + 2) for r, p in enumerate(ranked)}
        self.longest = max(map(len, self.score), default=1)
        self.fallback = -math.log(len(ranked) + 2) - 10

    def ends_at(self, word: str, end: int):
        """(start, score, tokens) of the pieces that end before position end of word."""
        single = False
        for start in range(max(0, end - self.longest), end):
            score = self.score.get(word[start:end])
            if score is not None:
                single |= start == end - 1
                yield start, score, 1
        if not single:
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            yield end - 1, self.fallback * size, size


def load_pieces(path: str) -> list[str]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class _Node:
    __slots__ = ("next", "best", "count", "terminal")

    def __init__(self, best: float, count: int):
        self.next: dict[str, _Node] = {}
        self.best, self.count, self.terminal = best, count, -1


def count_words(words: list[str], pieces: Pieces) -> np.ndarray:
    """Tokens of the best segmentation of each word.

    The words go into one trie. A node is a prefix, and holds the best forward score of
    the prefix and the tokens of that segmentation (the fewest, if scores are equal).
    What a prefix scores depends only on the prefixes before it on its path, so it is
    computed when the node is made and shared by all words that start with it. Where a
    word ends the node keeps the word's count.
    """
    root = _Node(0.0, 0)
    out = np.zeros(len(words), np.int64)
    for k, word in enumerate(words):
        path, node = [root], root
        for end, letter in enumerate(word, 1):
            below = node.next.get(letter)
            if below is None:
                best, count = -math.inf, 0
                for start, score, tokens in pieces.ends_at(word, end):
                    total, n = path[start].best + score, path[start].count + tokens
                    if total > best or total == best and n < count:
                        best, count = total, n
                below = node.next[letter] = _Node(best, count)
            node = below
            path.append(node)
        if node.terminal < 0:
            node.terminal = node.count
        out[k] = node.terminal
    return out


# Words whose trie is alive at once; a node takes some 300 bytes, a word four to six nodes.
TRIE_WORDS = 50_000


def with_token_counts(df: DataFrame, model_path: str, text: str = "text", most_units: int = MOST_UNITS) -> DataFrame:
    """df with n_words and n_tokens of each whole text.

    Pre-tokens are the runs of non-space characters, each with the word-start mark in
    front. Each distinct one is counted once per task by count_words; the sorted words go
    through tries of bounded size. Null and empty texts, and texts of white space, have no
    words and no tokens. Repeated rows count alike; columns named like a result give way.
    """
    sent = df.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    def make():
        pieces = Pieces(sent.value)

        def counted(units):
            order = sorted(range(len(units)), key=units.__getitem__)
            counts = np.zeros(len(units), np.int64)
            for i in range(0, len(order), TRIE_WORDS):
                part = order[i : i + TRIE_WORDS]
                counts[part] = count_words([WORD_START + units[j] for j in part], pieces)
            return counts.astype(np.uint32), np.ones(len(units), np.int64)

        cache = UnitCache(WORDS, counted, most_units)

        def step(batch):
            found = cache.ids(texts_of(batch, text))
            return [pa.array([len(f) for f in found], pa.int64()), pa.array([int(f.sum(dtype=np.int64)) for f in found], pa.int64())]

        return step

    return add_columns(df, make, "n_words long, n_tokens long")
