"""Byte-level BPE by an index of pair occurrences."""

from __future__ import annotations

import heapq
import json
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from orderloom.llm.rows import add_columns, give_back, texts_of
from orderloom.llm.units import SPACED_WORDS, Numbers, UnitCache, gathered

# The vocabulary is a file of fixed size, sent to every task.
MOST_VOCABULARY_BYTES = 64 * 1024 * 1024

# A task holds the pairs of a slice beside its units, so it remembers and takes at a time
# less than the other token operators; two tasks and a JVM share an executor.
MOST_UNITS, SLICE_CHARS, SLICE_BYTES = 300_000, 6_000_000, 4 << 20

# The published split pattern of this tokenizer kind, with white space spelled out.
# Fixed value.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
).findall


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if printable, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merges, ids and bytes of a byte-level BPE file of the tokenizers library."""

    def __init__(self, file_text: str):
        parts = json.loads(file_text)
        model, letters = parts["model"], _byte_letters()
        ids = model["vocab"]
        raw = lambda token: bytes(letters[c] for c in token)
        self.bytes = {i: raw(t) for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.of_byte = np.zeros(256, np.int32)
        for letter, byte in letters.items():
            self.of_byte[byte] = ids[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made: dict[str, int] = {}
        for rank, (a, b) in enumerate(pairs):
            if any(len(x) > 1 and made.get(x, rank) >= rank for x in (a, b)):
                raise ValueError(f"merge {rank} uses a part that only a later merge makes")
            made.setdefault(a + b, rank)
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.left, self.right = left, right
        keys = left << 32 | right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it is never merged."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], -1)


def merge_pieces(pieces: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, one after the other, and how many each has.

    All pieces lie in one array of linked symbols. The index maps each rank to the
    positions where its pair occurs. Ranks are applied in ascending order: a merge
    only makes pairs of higher rank (the vocabulary is checked for that), so one
    pass over the active ranks does for every piece what merging its lowest rank
    again and again would do. Each merge updates the lists of the pairs left and
    right of it; positions that no longer hold their pair are passed over.
    """
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    symbols = vocabulary.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    n = len(symbols)
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    ends = np.cumsum(lengths)
    filled = lengths > 0
    after[ends[filled] - 1] = -1
    before[(ends - lengths)[filled]] = -1
    index: dict[int, list[np.ndarray]] = defaultdict(list)
    active: list[int] = []

    def note(positions: np.ndarray) -> None:
        ranks = vocabulary.ranks(symbols[positions], symbols[after[positions]])
        found = ranks >= 0
        positions, ranks = positions[found], ranks[found]
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.r_[0, cuts]].tolist() if len(ranks) else (), np.split(positions, cuts)):
            if rank not in index:
                heapq.heappush(active, rank)
            index[rank].append(part)

    note(np.flatnonzero(after >= 0).astype(np.int32))
    while active:
        rank = heapq.heappop(active)
        at = np.unique(np.concatenate(index.pop(rank)))
        a, b = vocabulary.left[rank], vocabulary.right[rank]
        at = at[(symbols[at] == a) & (after[at] >= 0)]
        at = at[symbols[after[at]] == b]
        if not len(at):
            continue
        if a == b:  # of overlapping occurrences every second one goes, from the left
            new_run = np.r_[True, after[at[:-1]] != at[1:]]
            run_start = np.flatnonzero(new_run)
            at = at[(np.arange(len(at)) - run_start[np.cumsum(new_run) - 1]) % 2 == 0]
        gone = after[at]
        rest = after[gone]
        symbols[at] = vocabulary.merged[rank]
        symbols[gone] = -1
        after[at] = rest
        after[gone] = -1
        linked = rest >= 0
        before[rest[linked]] = at[linked]
        lefts = before[at]
        changed = np.concatenate([at[linked], lefts[lefts >= 0]])
        if len(changed):
            note(changed)
    alive = symbols >= 0
    counts = np.concatenate([[0], np.cumsum(alive)])
    return symbols[alive], counts[ends] - counts[ends - lengths]


class Encoder:
    def __init__(self, vocabulary: Vocabulary, most_units: int = MOST_UNITS, slice_chars: int = SLICE_CHARS):
        self.vocabulary = vocabulary
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.cache = UnitCache(self._units, self._encode, most_units, slice_chars)

    def _units(self, text: str) -> list[str]:
        if self.cut is None or not self.cut.search(text):
            return SPACED_WORDS(text)
        units: list[str] = []
        for part in self.cut.split(text):
            units += [part] if part in self.vocabulary.special else SPACED_WORDS(part)
        return units

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces = Numbers()
        number, which = pieces.__getitem__, array("i")
        owner_counts = np.zeros(len(units), np.int64)
        special = self.vocabulary.special
        for i, unit in enumerate(units):
            if unit in special:
                found = [""]
            elif unit.isalpha() or unit[0] == " " and unit[1:].isalpha():
                found = [unit]
            else:
                found = _PIECES(unit)
            owner_counts[i] = len(found)
            which.extend(map(number, found))
        ids, counts = merge_pieces([p.encode() for p in pieces], self.vocabulary)
        order = np.frombuffer(which, np.int32)
        first, counts = (np.cumsum(counts) - counts)[order], counts[order]
        ids = gathered(ids, first, counts)
        firsts = np.cumsum(owner_counts) - owner_counts
        lengths = np.add.reduceat(counts, firsts)
        own = [i for i, u in enumerate(units) if u in special]
        if own:
            starts = np.cumsum(lengths) - lengths
            ids = np.insert(ids, starts[own], [special[units[i]] for i in own])
            lengths[own] = 1
        return ids, lengths

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return self.cache.ids(texts)


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.table = [vocabulary.bytes.get(i, b"") for i in range(max(vocabulary.bytes) + 1)]

    def text(self, ids: bytes | None) -> str | None:
        if ids is None:
            return None
        found = np.frombuffer(ids, "<u4")
        found = found[found < len(self.table)].tolist()
        return b"".join(map(self.table.__getitem__, found)).decode("utf-8", "replace")


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if len(text.encode()) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be ({MOST_VOCABULARY_BYTES} bytes)")
    return text


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with the token ids of each text as little-endian unsigned 32-bit integers in one binary.

    A null or empty text has no ids. The contents of special tokens in a text are the
    special ids. Each distinct unit (a run of non-space characters with the blank
    before it, or a run of white space) is merged once per slice (what its units share,
    like a word with and without a comma, once for all of them) and remembered by its
    task, up to MOST_UNITS; repeated rows cost a look-up. Texts of any
    length go through whole. Other columns pass through; one named like the result
    gives way to it.
    """
    sent = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def make():
        encoder = Encoder(Vocabulary(sent.value))

        def step(batch):
            found = encoder.ids(texts_of(batch, text))
            give_back()  # what merging has freed
            return [pa.array([f.astype("<u4").tobytes() for f in found], pa.binary())]

        return step

    return add_columns(df, make, f"`{ids}` binary", slice_bytes=SLICE_BYTES)


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the text of each binary of ids, special tokens spelled out.

    Bytes that are not UTF-8 become replacement characters; ids outside the
    vocabulary stand for nothing; null ids decode to null.
    """
    sent = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def make():
        decoder = Decoder(Vocabulary(sent.value))
        return lambda batch: [pa.array([decoder.text(b) for b in batch.column(ids).to_pylist()], pa.string())]

    return add_columns(df, make, f"`{text}` string")


def round_trip(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encode and decode in one Python process: df without its text, with its ids and what they decode to.

    Null and empty texts have no ids and decode to the empty text; rows that repeat are coded
    alike, texts of any length whole. Columns named like a result give way to it; an empty table
    gives an empty one.
    """
    sent = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def make():
        vocabulary = Vocabulary(sent.value)
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)

        def step(batch):
            coded = [f.astype("<u4").tobytes() for f in encoder.ids(texts_of(batch, text))]
            give_back()  # what merging has freed
            return [pa.array(coded, pa.binary()), pa.array([decoder.text(c) for c in coded], pa.string())]

        return step

    return add_columns(df, make, f"`{ids}` binary, `{decoded}` string", [text], SLICE_BYTES)
