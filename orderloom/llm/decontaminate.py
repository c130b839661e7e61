"""Benchmark passages in documents: one Aho-Corasick automaton, one scan."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import add_columns, to_rows, written

WINDOW = 10

# Characters of benchmark text in one automaton: it has ten nodes per word of some 50
# bytes, so 3 million characters take up to 300 MB of a task. A larger benchmark is
# scanned in several passes, each with its own automaton.
AUTOMATON_CHARS = 3_000_000

_NOT_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_NORMAL = bytes.maketrans(_NOT_WORD, b" " * len(_NOT_WORD))
_FOLD = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_TABLE = _NORMAL.translate(_FOLD)
_ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Automaton:
    """All windows of the items over word numbers; a word the items lack is number 0."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1) if size else ():
                windows.setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.search = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, owners in windows.items():
            self.search.add_word(ids, (len(ids), tuple(owners)))
        self.empty = not windows
        if windows:
            self.search.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges [from, to), in order and merged, and the items that occur."""
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        if self.empty or not words:
            return ranges, items
        get = self.numbers.get
        for end, (size, owners) in self.search.iter(tuple([get(w, 0) for w in words])):
            ranges.append((end + 1 - size, end + 1))
            items.update(owners)
        return merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _spans(text: str, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word ranges as character offsets of the text as it was."""
    if not ranges:
        return []
    at = [(m.start(), m.end()) for m in _ORIGINAL_WORD.finditer(text)]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in ranges]


def _blocks(benchmark: DataFrame, item: str, text: str, most_chars: int) -> Iterator[list[tuple[str, str]]]:
    """The distinct items in blocks of bounded size, each collected when its turn comes."""
    items = benchmark.select(
        F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text")
    ).filter("text is not null and item is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()["chars"]
    count = -(-total // most_chars) or 1
    for k in range(count):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).collect()]


def with_overlap(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    automaton_chars: int = AUTOMATON_CHARS,
) -> DataFrame:
    """df with n_words, hits (word ranges), spans (character ranges of the original text) and items.

    A window is `window` consecutive words of an item; an item of fewer words is one
    window, one without words none. Every word inside an occurrence of a window is hit.
    items holds the ids of the items with a window in the text, sorted as strings. A
    null or empty text has no words and no hits; a null item id or text is no item.
    Several items with one text all count; rows repeated in df are scanned alike. Other
    columns pass through; columns named like a result give way to it.
    """
    sent = df.sparkSession.sparkContext.broadcast
    blocks = _blocks(benchmark, item, item_text, automaton_chars)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _with_results(df, text, sent(first), window, None)
    # Several blocks: each finds its hits in the texts; only they are carried on, and meet the rows once.
    number, found = "_row" + "_" * max(map(len, df.columns)), "_found" + "_" * max(map(len, df.columns))  # longer than any
    rows = written(df.withColumn(number, F.monotonically_increasing_id()), "overlap-rows")
    texts = rows.select(F.col(number).alias("row"), F.col(f"`{text}`").alias("text"))
    hits = [written(_hits(texts, sent(block), window), "overlap") for block in chain([first, second], blocks)]
    flat = lambda c: F.flatten(F.collect_list(c)).alias(c)
    joined = reduce(DataFrame.unionByName, hits).groupBy("row").agg(flat("hits"), flat("items"))
    held = joined.select(F.col("row").alias(number), F.struct("hits", "items").alias(found))
    return _with_results(rows.join(held, number, "left").drop(number), text, None, window, found)


RANGES = "array<struct<start:int,end:int>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _hits(texts: DataFrame, sent, window: int) -> DataFrame:
    """row, hits and items of the texts that one block of items hits."""

    def make():
        automaton = Automaton(sent.value, window)

        def run(batches):
            for batch in batches:
                scanned = [automaton.scan(words_of(t)) for t in batch.column("text").to_pylist()]
                hit = [k for k, (ranges, _) in enumerate(scanned) if ranges]
                yield {
                    "row": batch.column("row").take(pa.array(hit, pa.int64())),
                    "hits": pa.array([[{"start": a, "end": b} for a, b in scanned[k][0]] for k in hit], _SPAN),
                    "items": pa.array([sorted(scanned[k][1]) for k in hit], pa.list_(pa.string())),
                }

        return run

    return to_rows(texts, make, f"row long, hits {RANGES}, items array<string>")


def _with_results(df: DataFrame, text: str, sent, window: int, found: str | None) -> DataFrame:
    """df with the results: of the automaton of one block, or of hits that a column holds."""

    def make():
        automaton = Automaton(sent.value, window) if found is None else None

        def step(batch):
            texts = batch.column(text).to_pylist()
            before = batch.column(found).to_pylist() if found else [None] * len(texts)
            n, hits, spans, items = [], [], [], []
            for t, old in zip(texts, before):
                words = words_of(t)
                if automaton is not None:
                    ranges, owners = automaton.scan(words)
                else:
                    ranges = merged([(h["start"], h["end"]) for h in old["hits"]]) if old else []
                    owners = set(old["items"]) if old else set()
                n.append(len(words))
                hits.append([{"start": a, "end": b} for a, b in ranges])
                spans.append(_spans(t, ranges) if ranges else [])
                items.append(sorted(owners))
            return [pa.array(n, pa.int64()), pa.array(hits, _SPAN), pa.array(spans, _SPAN), pa.array(items, pa.list_(pa.string()))]

        return step

    return add_columns(df, make, f"n_words long, hits {RANGES}, spans {RANGES}, items array<string>", [found] if found else [])


def hit_words(hits: str = "hits"):
    """How many words the hit ranges cover."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]).cast("long"))
