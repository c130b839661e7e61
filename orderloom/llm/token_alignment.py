"""Alignment of two tokenizers' tokens by interval coalescing, and how often token ids meet.

1.  Both tokenizers cut the same bytes into intervals. All intervals of a slice of documents
    are sorted by their start; the running maximum of their ends tells how far they reach. A
    group breaks where a start reaches that maximum: there a token of either side has ended
    at the same byte. Overlaps are expanded within a group only.
2.  A slice writes its documents, each with its distinct links as places in the slice's table
    of id pairs, and that table with the number of the slice's documents that hold each pair.
3.  Only the tables are shuffled by pair, to count documents over the whole corpus and to find
    every A id's highest count. The counts go back to the slice they are asked for by, as one
    packed row, and meet its documents there.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import slices, to_rows, written
from orderloom.llm.units import SPACE, UnitCache, gathered

# Bytes of text aligned at a time; a single longer document goes alone.
ALIGNED_BYTES = 4 << 20

# Distinct units whose ids a task remembers.
REMEMBERED_UNITS = 500_000

# A group with more token pairs than this is expanded by its distinct ids.
WIDE_GROUP = 4096

# A piece's mark for a blank. Fixed value.
BLANK = "▁"

NO_LINKS = np.zeros(0, np.int64)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


# Blanks and other white space, as the byte-level tokenizer's pattern understands it.
_OTHER_SPACE = SPACE.replace(" ", "", 1)

# A unit starts at a blank after a character that is no white space and goes on to the next such
# blank: no token of either tokenizer reaches over that place. All text starts with a blank here.
UNITS = re.compile(f" [{SPACE}]*[^{SPACE}]*(?:[{_OTHER_SPACE}][{SPACE}]*[^{SPACE}]*)*").findall
_SPACES = re.compile(f"[{SPACE}]").fullmatch

# Characters of units that are encoded in one text.
JOINED_CHARS = 20_000


class _Side:
    """One tokenizer: ids of texts that start with a blank, and the bytes that each id stands for."""

    def __init__(self, token_bytes: list[bytes], encode):
        self.bytes_of, self.encode = token_bytes, encode
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)

    def spelled(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def byte_level_side(file_text: str) -> _Side:
    """The tokenizers library's byte-level BPE; special tokens' strings are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(file_text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    spelled = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        spelled[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return _Side(spelled, lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])


def piece_side(model: bytes) -> _Side:
    """A sentencepiece BPE with byte fallback that puts a blank before each text."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    if any(re.search(f"[^{BLANK}]{BLANK}", n) for n in names):
        raise ValueError("a piece reaches over a blank: texts cannot be cut there")
    spelled = [
        bytes([int(name[3:-1], 16)]) if pieces.is_byte(i) else b"" if pieces.is_control(i) else name.replace(BLANK, " ").encode()
        for i, name in enumerate(names)
    ]
    blank = [pieces.piece_to_id(BLANK)]  # the library puts none before an empty text
    return _Side(spelled, lambda texts: [ids or blank for ids in pieces.encode([t[1:] for t in texts], num_threads=1)])


class _Both:
    """Ids of texts by both tokenizers; each distinct unit is encoded once.

    A's ids come as they are, B's behind A's vocabulary; BAD marks a text that either
    tokenizer does not spell out byte by byte.
    """

    def __init__(self, a: _Side, b: _Side, most_units: int = REMEMBERED_UNITS):
        self.a, self.b = a, b
        self.a_count = len(a.bytes_of)
        self.bad = self.a_count + len(b.bytes_of)
        self.cache = UnitCache(UNITS, self._encode, most_units)

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        out = []
        for found in self.cache.ids(texts):
            is_a = found < self.a_count
            rest = found[~is_a]
            out.append(None if (rest == self.bad).any() else (found[is_a], rest - np.uint32(self.a_count)))
        return out

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units, one after the other, and how many each has.

        Units that end in a letter or mark are put in one text: their cuts are safe there
        as well, and bytes tell where each ends. Others are encoded on their own.
        """
        plain = [k for k, u in enumerate(units) if not _SPACES(u[-1]) and BLANK not in u]
        parts: list[list[int]] = [[k] for k in sorted(set(range(len(units))) - set(plain))]
        size = JOINED_CHARS
        for k in plain:
            if size >= JOINED_CHARS:
                parts.append([])
                size = 0
            parts[-1].append(k)
            size += len(units[k])
        texts = ["".join([units[k] for k in part]) for part in parts]
        flat, lengths = [], []
        for part, text, a_ids, b_ids in zip(parts, texts, self.a.encode(texts), self.b.encode(texts)):
            raw = text.encode("utf-8", "surrogatepass")
            if self.a.spelled(a_ids) != raw or self.b.spelled(b_ids) != raw:
                if len(part) > 1:
                    raise ValueError("units came out otherwise than alone")
                flat.append(np.array([self.bad], np.uint32))
                lengths.append(np.array([1], np.int64))
                continue
            ends = np.cumsum([len(units[k].encode("utf-8", "surrogatepass")) for k in part])
            a, b = np.array(a_ids, np.uint32), np.array(b_ids, np.uint32)
            many = [np.diff(np.searchsorted(np.cumsum(side.lengths[i]), ends, "right"), prepend=0) for side, i in ((self.a, a), (self.b, b))]
            order = np.argsort(np.concatenate([np.repeat(np.arange(len(part)), m) for m in many]), kind="stable")
            flat.append(np.concatenate([a, b + np.uint32(self.a_count)])[order])
            lengths.append(many[0] + many[1])
        sizes = np.concatenate(lengths)
        order = np.argsort(np.array([k for part in parts for k in part]), kind="stable")
        return gathered(np.concatenate(flat), (np.cumsum(sizes) - sizes)[order], sizes[order]), sizes[order]


def coalesced(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and every B token; both sides tile the same bytes, tokens are not empty."""
    a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
    starts = np.concatenate([a_ends - a_lengths, b_ends - b_lengths])
    order = np.lexsort((starts,))
    reach = np.maximum.accumulate(np.concatenate([a_ends, b_ends])[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    groups = np.empty(len(order), np.int64)
    groups[order] = np.cumsum(breaks)
    return groups[: len(a_ends)], groups[len(a_ends) :]


def expanded(
    a_ids: np.ndarray, b_ids: np.ndarray, a_groups: np.ndarray, b_groups: np.ndarray, a_docs: np.ndarray, b_count: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair code (A id * b_count + B id) and number of the links within groups.

    Links of usual groups come one by one, those of a wide group once per distinct pair.
    """
    n = int(a_groups[-1]) + 1 if len(a_groups) else 0
    in_a, in_b = np.bincount(a_groups, minlength=n), np.bincount(b_groups, minlength=n)
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    wide = in_a * in_b > WIDE_GROUP
    narrow = ~wide[a_groups]
    per_token = in_b[a_groups[narrow]]
    left = np.repeat(a_ids[narrow].astype(np.int64), per_token)
    codes = [left * b_count + gathered(b_ids, first_b[a_groups[narrow]], per_token)]
    docs, counts = [np.repeat(a_docs[narrow], per_token)], [np.ones(len(left), np.int64)]
    for g in np.flatnonzero(wide).tolist():
        ua, ca = np.unique(a_ids[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
        ub, cb = np.unique(b_ids[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
        codes.append((ua.astype(np.int64)[:, None] * b_count + ub).ravel())
        counts.append((ca[:, None] * cb).ravel())
        docs.append(np.full(len(codes[-1]), a_docs[first_a[g]]))
    return np.concatenate(docs), np.concatenate(codes), np.concatenate(counts)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the weights of each."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


class _Shown:
    """Groups as text: `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, a_count: int, b_count: int):
        a, b = [str(i) for i in range(a_count)], [str(i) for i in range(b_count)]
        self.places = np.cumsum([0, a_count, a_count, b_count])  # of ";a", ",a", "|b" and ",b"
        self.texts = [f";{i}" for i in a] + [f",{i}" for i in a] + [f"|{i}" for i in b] + [f",{i}" for i in b]

    def codes(self, ids: np.ndarray, groups: np.ndarray, side: int) -> np.ndarray:
        first = np.concatenate([np.ones(min(1, len(groups)), bool), groups[1:] != groups[:-1]])
        return ids.astype(np.int64) + np.where(first, self.places[2 * side], self.places[2 * side + 1])

    def text(self, codes: np.ndarray) -> str:
        return "".join(map(self.texts.__getitem__, codes.tolist()))[1:]


class _Aligner:
    """Documents of a batch, aligned, as the columns of _coded."""

    def __init__(self, a: _Side, b: _Side):
        self.a, self.b, self.both = a, b, _Both(a, b)
        self.shown = _Shown(len(a.bytes_of), len(b.bytes_of))

    def columns(self, batch: pa.RecordBatch, block: int) -> dict:
        texts = batch.column("text").to_pylist()
        asked = [k for k, t in enumerate(texts) if t]
        found = [(k, ids) for k, ids in zip(asked, self.both.ids([" " + texts[k] for k in asked])) if ids]
        same = [ids for _, ids in found]
        rows = np.array([k for k, _ in found], np.int64)
        n_a, n_b = (np.array([len(ids[s]) for ids in same], np.int64) for s in (0, 1))
        a_ids, b_ids = (np.concatenate([ids[s] for ids in same]) if same else np.zeros(0, np.uint32) for s in (0, 1))
        a_groups, b_groups = coalesced(self.a.lengths[a_ids], self.b.lengths[b_ids])
        a_docs = np.repeat(np.arange(len(same)), n_a)
        docs, codes, counts = expanded(a_ids, b_ids, a_groups, b_groups, a_docs, len(self.b.bytes_of))
        pairs, place = np.unique(codes, return_inverse=True)
        links, weights = _summed(docs * max(1, len(pairs)) + place, counts)
        owner, place = np.divmod(links, max(1, len(pairs)))
        holders = np.bincount(place, minlength=len(pairs)).astype(np.int64)
        cuts = np.searchsorted(owner, np.arange(len(same) + 1))

        whole = np.zeros((4, len(texts)), np.int64)
        whole[0, rows], whole[1, rows] = n_a, n_b
        ends = np.cumsum(n_a)
        if len(same):
            whole[2, rows] = a_groups[ends - 1] - a_groups[ends - n_a] + 1
            whole[3, rows] = np.bincount(owner, weights, minlength=len(same)).astype(np.int64)
        shown: list[str | None] = [""] * len(texts)
        packed: list[bytes | None] = [b""] * len(texts)
        held: list[bytes | None] = [b""] * len(texts)
        codes = np.concatenate([self.shown.codes(a_ids, a_groups, 0), self.shown.codes(b_ids, b_groups, 1)])
        # In a group A's ids come first; every group has both.
        order = np.lexsort((np.repeat([0, 1], [len(a_ids), len(b_ids)]), np.concatenate([a_groups, b_groups])))
        codes, until = codes[order], np.cumsum(n_a + n_b)
        for j, k in enumerate(rows.tolist()):
            shown[k] = self.shown.text(codes[until[j] - n_a[j] - n_b[j] : until[j]])
            packed[k] = place[cuts[j] : cuts[j + 1]].astype("<u4").tobytes()
            held[k] = weights[cuts[j] : cuts[j + 1]].astype("<i8").tobytes()
        head = 1 if len(pairs) else 0
        return {
            "block": pa.array([block] * (len(texts) + head), pa.int64()),
            "id": pa.concat_arrays([batch.column("id"), pa.nulls(head, pa.int64())]),
            **{n: pa.array(np.append(whole[k], np.zeros(head, np.int64))) for k, n in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            "groups": pa.array(shown + [None] * head, pa.string()),
            "places": pa.array(packed + [None] * head, pa.binary()),
            "counts": pa.array(held + [holders.tobytes()] * head, pa.binary()),
            "pairs": pa.array([None] * len(texts) + [pairs.astype("<i8").tobytes()] * head, pa.binary()),
        }


CODED = """block long, id long, n_a long, n_b long, n_groups long, n_links long, groups string,
           places binary, counts binary, pairs binary"""


def _coded(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The documents of each slice, and one row with the slice's pairs, which has no groups."""
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        sent = docs.sparkSession.sparkContext.broadcast((a_file.read(), b_file.read()))

    def make():
        aligner = _Aligner(byte_level_side(sent.value[0]), piece_side(sent.value[1]))

        def run(batches):
            task = TaskContext.get().partitionId() << 32
            for k, batch in enumerate(slices(batches, ALIGNED_BYTES)):
                yield aligner.columns(batch, task + k)

        return run

    return to_rows(docs, make, CODED)


def _entries(tables: DataFrame) -> DataFrame:
    """One row per pair of a slice's table: block, place, pair and the slice's documents that hold it."""

    def make():
        def run(batches):
            for batch in batches:
                for block, pairs, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "counts"))):
                    found = np.frombuffer(pairs, "<i8")
                    yield {
                        "block": pa.array(np.full(len(found), block)),
                        "place": pa.array(np.arange(len(found), dtype=np.int32)),
                        "pair": pa.array(found),
                        "held": pa.array(np.frombuffer(counts, "<i8")),
                    }

        return run

    return to_rows(tables, make, "block long, place int, pair long, held long")


def _make_scored():
    """Rows sorted by block, a block's counts first: what each document's links are worth."""

    def run(batches) -> Iterator[dict]:
        block, count, best = None, NO_LINKS, NO_LINKS
        for batch in batches:
            blocks, ids = batch.column("block").to_pylist(), batch.column("id").to_pylist()
            ranks, kinds = batch.column("ranks"), batch.column("kind").to_pylist()
            places, weights = batch.column("places").to_pylist(), batch.column("counts").to_pylist()
            out: dict[str, list] = {"id": [], "n_best": [], "count_sum": []}
            rest = [k for k, kind in enumerate(kinds) if kind]
            for k, kind in enumerate(kinds):
                if not kind:
                    found = ranks[k].values
                    order = np.argsort(found.field("place").to_numpy())
                    block = blocks[k]
                    count = found.field("count").to_numpy()[order]
                    best = found.field("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
                    continue
                at, many = np.frombuffer(places[k], "<u4"), np.frombuffer(weights[k], "<i8")
                if len(at) and blocks[k] != block:
                    raise ValueError("the counts of a slice are missing")
                out["id"].append(ids[k])
                out["n_best"].append(int((many * best[at]).sum()) if len(at) else 0)
                out["count_sum"].append(int((many * count[at]).sum()) if len(at) else 0)
            chosen = pa.array(rest, pa.int64())
            kept = {c: batch.column(c).take(chosen) for c in ("n_a", "n_b", "n_groups", "n_links", "groups")}
            yield kept | {c: pa.array(v, pa.int64()) for c, v in out.items()}

    return run


def aligned(
    df: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", groups: Column | None = None
) -> DataFrame:
    """One row per row of df: id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    A is a byte-level BPE file of the tokenizers library over the text with a blank before it,
    B a sentencepiece model that adds that blank itself; neither adds special tokens, and the
    strings of special tokens are plain text. groups shows the ids of each group in order, as
    `a1,a2|b1;a3|b2,b3`; or, computed where it is made, any column of `groups` and `n_groups`.
    A link is a pair of an A and a B token whose byte ranges share a group. A pair of ids
    counts the rows of df that hold it linked; n_best are the row's links whose count is the
    highest of their A id, ties included, and count_sum adds the counts of all its links.

    Null and empty texts, and texts that either tokenizer does not spell out byte by byte (a
    literal blank mark, say), have no tokens: zeros, no links, groups ''. Rows that repeat
    count each; ids are integers and may be null. Texts go through whole, however long. An
    empty table gives an empty result; other columns of df are not read.
    """
    docs = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    shown = (F.col("groups") if groups is None else groups).alias("groups")
    rows = _coded(docs, a_path, b_path)
    coded = written(rows.select(*[shown if c == "groups" else c for c in rows.columns]), "aligned")
    entries = written(_entries(coded.filter("pairs is not null").select("block", "pairs", "counts")), "slice-pairs")
    b_count = F.lit(_piece_count(b_path))
    counted = entries.groupBy("pair").agg(F.sum("held").alias("count"))
    counted = written(counted.withColumn("a", F.floor(F.col("pair") / b_count).cast("long")), "pair-counts")
    highest = counted.groupBy("a").agg(F.max("count").alias("highest"))
    ranked = counted.join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    # At most the pairs of one slice of text meet in a row.
    packed = entries.join(ranked, "pair").groupBy("block").agg(F.collect_list(F.struct("place", "count", "best")).alias("ranks"))
    documents = coded.filter("pairs is null").drop("pairs").withColumns({"kind": F.lit(1), "ranks": F.lit(None).cast(packed.schema["ranks"].dataType)})
    both = documents.unionByName(packed.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    ordered = both.repartition("block").sortWithinPartitions("block", "kind")
    named = f"id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups {coded.schema['groups'].dataType.simpleString()}"
    return to_rows(ordered, _make_scored, named)


def _piece_count(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
