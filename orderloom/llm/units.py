"""Texts as numbered units, each distinct unit encoded once per task."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np

# Unicode White_Space, as the tokenizers' own patterns understand \s.
# Fixed values.
SPACE = r"\t-\r \x85\xa0  -     　"

WORDS = re.compile(f"[^{SPACE}]+").findall
SPACED_WORDS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall

# Distinct units a task remembers (some 200 MB with their ids); then it starts afresh.
MOST_UNITS = 700_000

# Characters of text whose units are encoded together.
SLICE_CHARS = 12_000_000


class Numbers(dict):
    """Strings by their number, in the order of their first look-up."""

    def __missing__(self, unit):
        number = self[unit] = len(self)
        return number


def gathered(flat: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Pieces of flat that start at first and have these lengths, one after the other."""
    if not len(first):
        return flat[:0]
    ends = np.cumsum(lengths)
    return flat[np.arange(ends[-1]) + np.repeat(first - (ends - lengths), lengths)]


class UnitCache:
    """Ids of texts, put together from the ids of their units.

    split turns a text into units; encode turns a list of distinct units into their
    ids, one after the other, and the number of ids of each.
    """

    def __init__(
        self,
        split: Callable[[str], list[str]],
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        most: int = MOST_UNITS,
        slice_chars: int = SLICE_CHARS,
    ):
        self.split, self.encode, self.most, self.slice_chars = split, encode, most, slice_chars
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def ids(self, texts: Iterable[str]) -> list[np.ndarray]:
        """The ids of each text; texts are taken in slices of bounded length (or one longer text)."""
        out: list[np.ndarray] = []
        held: list[str] = []
        size = 0
        for text in texts:
            if held and size + len(text) > self.slice_chars:
                out += self._slice(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        return out + self._slice(held)

    def _slice(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.numbers) > self.most:
            self._forget()
        number = self.numbers.__getitem__
        known, per_text = len(self.numbers), []
        for text in texts:
            units = self.split(text)
            per_text.append(np.fromiter(map(number, units), np.int32, len(units)))
        if len(self.numbers) > known:
            new = list(self.numbers)[known:] if known else list(self.numbers)
            flat, lengths = self.encode(new)
            self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths, dtype=np.int64)])
        return [self._gather(units) for units in per_text]

    def _gather(self, units: np.ndarray) -> np.ndarray:
        first = self.starts[units]
        return gathered(self.flat, first, self.starts[units + 1] - first)
