"""Token ids in files of independent zstandard frames with a trailing seek table.

One file holds, in order of (id, text):

* frames, each a whole zstandard frame with its own content checksum. Unpacked:
  count u32, then per document has_id u8, id i64, n_tokens u64, then all ids u32;
* a skippable frame (magic 0x184D2A50) with one entry per frame:
  documents u64, tokens u64, first id i64, last id i64 (of the documents with ids);
* the seek table of the zstandard seekable format (skippable frame 0x184D2A5E):
  per frame packed size u32, unpacked size u32, checksum u32 (low half of xxh64 of
  the unpacked bytes), then frames u32, descriptor u8 (0x80), magic 0x8F92EAB1.

All numbers are little-endian. Any zstandard reader can unpack a file; ShardReader
opens only the frames that hold the documents asked for.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.rows import texts_of, to_rows, written
from orderloom.llm.units import WORDS, UnitCache, gathered
from orderloom.llm.bpe import read_vocabulary

# Fixed values of the format.
INDEX_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1

# Input splits that make one file: more text in a task means fewer units to encode again.
SPLITS_PER_SHARD = 2
# Distinct units a writing task remembers (some 350 MB with their ids).
MOST_UNITS = 1_200_000

# Characters of a text that decide which file it goes to among rows of one id.
RANGE_CHARS = 32

FRAME_BYTES = 1 << 20
FRAME_DOCUMENTS = 4096
LARGEST_FRAME = (1 << 32) - 1
CHUNK = 5_000
# Marks that stand as a word of their own behind letters. Fixed values.
MARKS = frozenset(".,;:!?")


def in_order(numbers: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of flat, which belong to these numbers, by ascending number."""
    order = np.argsort(numbers, kind="stable")
    firsts = np.cumsum(lengths) - lengths
    return gathered(flat, firsts[order], lengths[order]), lengths[order]


class LibraryEncoder:
    """Ids by the tokenizers library, which sees each distinct run of non-space characters once.

    Fits tokenizers that drop white space before anything can depend on it.
    """

    def __init__(self, file_text: str, most_units: int = MOST_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file_text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parts = json.loads(file_text)
        steps = (parts["normalizer"] or {}).get("normalizers", [])
        self.folds = any(step["type"] == "Lowercase" for step in steps)
        ends = parts["model"].get("end_of_word_suffix")
        self.word_ends = None
        if ends:
            self.word_ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.word_ends[[i for t, i in parts["model"]["vocab"].items() if t.endswith(ends)]] = True
        # Special tokens are found before any folding, so a text that might hold one is left as it is.
        self.marks = {t["content"][:2] for t in parts["added_tokens"]} | {t["content"][:2].upper() for t in parts["added_tokens"]}
        self.cache = UnitCache(WORDS, self._encode, most_units)

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units, many in one call.

        Units of letters, and of letters before one mark, are put in one text with line
        feeds between. They are one and two words to the tokenizer, so ids that end a word
        tell where each ends. Where the words do not come out as many as they should, and
        for all other units, each is encoded on its own.
        """
        alike: dict[int, list[int]] = {1: [], 2: []}
        for k, unit in enumerate(units if self.word_ends is not None else ()):
            if unit.isalpha():
                alike[1].append(k)
            elif unit[-1] in MARKS and unit[:-1].isalpha():
                alike[2].append(k)
        alone = np.ones(len(units), bool)
        done: list[int] = []
        flat: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        for words, plain in alike.items():
            for i in range(0, len(plain), CHUNK):
                some = plain[i : i + CHUNK]
                text = "\n".join([units[k] for k in some])
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                ends = np.flatnonzero(self.word_ends[ids]) + 1
                if len(ends) == words * len(some) and ends[-1] == len(ids):
                    alone[some] = False
                    done += some
                    flat.append(ids)
                    lengths.append(np.diff(ends[words - 1 :: words], prepend=0))
        rest = np.flatnonzero(alone).tolist()
        for i in range(0, len(rest), CHUNK):
            some = rest[i : i + CHUNK]
            own = [e.ids for e in self.tokenizer.encode_batch_fast([units[k] for k in some], add_special_tokens=False)]
            flat.append(np.fromiter(chain.from_iterable(own), np.uint32))
            lengths.append(np.fromiter(map(len, own), np.int64, len(own)))
        return in_order(np.array(done + rest, np.int64), np.concatenate(flat), np.concatenate(lengths))

    def _folded(self, text: str) -> str:
        """A-Z as a-z where the tokenizer does so itself, so that fewer units are distinct."""
        if not self.folds or any(s in text for s in self.marks):
            return text
        return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return self.cache.ids(map(self._folded, texts))


class ShardWriter:
    def __init__(self, sink, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.sink, self.frame_bytes = sink, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int, int]] = []
        self.documents = self.tokens = 0
        self._start()

    def _start(self) -> None:
        self.held: list[tuple[int | None, np.ndarray]] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.held and (self.size + 4 * len(ids) > self.frame_bytes or len(self.held) == FRAME_DOCUMENTS):
            self._flush()
        self.held.append((doc_id, ids))
        self.size += 4 * len(ids) + 17

    def _flush(self) -> None:
        known = [d for d, _ in self.held if d is not None]
        counts = np.array([len(i) for _, i in self.held], "<u8")
        raw = b"".join([
            struct.pack("<I", len(self.held)),
            bytes(d is not None for d, _ in self.held),
            np.array([d or 0 for d, _ in self.held], "<i8").tobytes(),
            counts.tobytes(),
            *(i.astype("<u4").tobytes() for _, i in self.held),
        ])
        if len(raw) > LARGEST_FRAME:
            raise ValueError(f"document {self.held[0][0]} has more ids than the format can hold in a frame")
        packed = self.packer.compress(raw)
        self.sink.write(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        tokens = int(counts.sum())
        self.index.append((len(self.held), tokens, min(known, default=0), max(known, default=-1)))
        self.documents += len(self.held)
        self.tokens += tokens
        self._start()

    def finish(self) -> None:
        if self.held:
            self._flush()
        index = b"".join(struct.pack("<QQqq", *e) for e in self.index)
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), 0x80, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class ShardReader:
    """Reads a file that can be sought; a wrong checksum raises ValueError."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, 2)
        if end < 17:
            raise ValueError("not a token file: too short")
        source.seek(end - 9)
        frames, descriptor, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or descriptor != 0x80:
            raise ValueError("not a token file: no seek table")
        table_at = end - 17 - 12 * frames
        index_at = table_at - 8 - 32 * frames
        if index_at < 0:
            raise ValueError("not a token file: seek table too long")
        source.seek(index_at)
        tail = source.read(end - index_at)
        if struct.unpack_from("<II", tail) != (INDEX_MAGIC, 32 * frames) or struct.unpack_from("<II", tail, 8 + 32 * frames) != (TABLE_MAGIC, 12 * frames + 9):
            raise ValueError("not a token file: broken tables")
        self.index = [struct.unpack_from("<QQqq", tail, 8 + 32 * k) for k in range(frames)]
        self.entries = [struct.unpack_from("<III", tail, 16 + 32 * frames + 12 * k) for k in range(frames)]
        self.places = [0, *accumulate(e[0] for e in self.entries)]
        self.unpacker = zstandard.ZstdDecompressor()
        self.opened = 0

    def frame(self, k: int) -> Iterator[tuple[int | None, np.ndarray]]:
        packed_size, size, checksum = self.entries[k]
        self.source.seek(self.places[k])
        try:
            raw = self.unpacker.decompress(self.source.read(packed_size), max_output_size=size)
        except zstandard.ZstdError as error:
            raise ValueError(f"frame {k} is damaged: {error}") from error
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        self.opened += 1
        (count,) = struct.unpack_from("<I", raw)
        has = raw[4 : 4 + count]
        doc_ids = np.frombuffer(raw, "<i8", count, 4 + count).tolist()
        counts = np.frombuffer(raw, "<u8", count, 4 + 9 * count).astype(np.int64)
        ids = np.frombuffer(raw, "<u4", -1, 4 + 17 * count)
        at = 0
        for k, n in enumerate(counts.tolist()):
            yield (doc_ids[k] if has[k] else None), ids[at : at + n]
            at += n

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, tokens before it in this file, ids); of the wanted ids only, if given."""
        asked = None if wanted is None else sorted(set(wanted))
        chosen = set(asked or ())
        start = 0
        for k, (_, tokens, first, last) in enumerate(self.index):
            here = asked is None or np.searchsorted(asked, first) < np.searchsorted(asked, last, "right")
            at = start
            for doc_id, ids in self.frame(k) if here else ():
                if asked is None or doc_id in chosen:
                    yield doc_id, at, ids
                at += len(ids)
            start += tokens


def write_token_files(
    df: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Writes the ids of every text, each followed by end_id, and returns the manifest.

    The manifest has one row per file: shard, path, n_docs, n_tokens, and first_id and last_id, the
    range of its ids (null where it has none). Shards follow each other in ascending id (null ids
    first, equal ids by text), one per SPLITS_PER_SHARD input splits; rows that share an id, or have
    none, are dealt over several where they are many, by the first RANGE_CHARS of their text. A task writes its own new file and the manifest names only the files of
    finished tasks, so a retried or doubled task leaves no row twice; the manifest is
    a written table. Null texts count as empty and hold end_id alone; an empty table
    gives an empty manifest. Columns other than id and text are not stored.
    """
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(read_vocabulary(tokenizer_path))
    rows = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    shards = max(1, -(-_splits(rows) // SPLITS_PER_SHARD))
    # Rows without an id, and copies, are parted by how their texts start and then by number.
    numbered = rows.withColumns({"start": F.substring("text", 1, RANGE_CHARS), "row": F.monotonically_increasing_id()})
    ordered = numbered.repartitionByRange(shards, "id", "start", "row").sortWithinPartitions("id", "text", "row")
    ordered = ordered.select("id", "text")
    end = np.array([end_id], np.uint32)

    def make():
        def run(batches):
            target, base = pafs.FileSystem.from_uri(folder)
            writer = encoder = first_id = last_id = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                if writer is None:
                    shard = TaskContext.get().partitionId()
                    target.create_dir(base, recursive=True)
                    path = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}.ids.zst"
                    sink = target.open_output_stream(path, compression=None)
                    writer, encoder = ShardWriter(sink, frame_bytes), LibraryEncoder(sent.value)
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(texts_of(batch, "text"))):
                    writer.add(doc_id, np.concatenate([ids, end]))
                    first_id = doc_id if first_id is None else first_id
                    last_id = doc_id if doc_id is not None else last_id
            if writer is not None:
                writer.finish()
                sink.close()
                yield {
                    "shard": pa.array([shard], pa.int64()),
                    "file": pa.array([os.path.basename(path)]),
                    "n_docs": pa.array([writer.documents], pa.int64()),
                    "n_tokens": pa.array([writer.tokens], pa.int64()),
                    "first_id": pa.array([first_id], pa.int64()),
                    "last_id": pa.array([last_id], pa.int64()),
                }

        return run

    manifest = to_rows(ordered, make, "shard long, file string, n_docs long, n_tokens long, first_id long, last_id long")
    path = F.concat(F.lit(f"{folder}/"), "file").alias("path")
    return written(manifest.select("shard", path, "n_docs", "n_tokens", "first_id", "last_id"), "token-manifest")


def _splits(rows: DataFrame) -> int:
    """Partitions that a scan comes in."""
    return rows.select(F.spark_partition_id().alias("part")).distinct().count()


def read_token_files(manifest: DataFrame, wanted: Sequence[int] | None = None) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens and ids (binary) from the files.

    One file is read by one task, a frame at a time. Counts before a file are a running
    sum over the manifest, which has one row per file. With wanted, a list of ids, only their
    documents: files whose range of ids holds none of them are not opened, and of the others only
    the frames that may hold one are unpacked.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    asked = None if wanted is None else sorted({int(w) for w in wanted})
    if asked is not None:
        ids = F.lit(asked).cast("array<long>")
        files = files.filter(F.exists(ids, lambda w: w.between(F.col("first_id"), F.col("last_id"))))
    spread = files.select("path", "first").repartition(max(1, files.count()))

    def make():
        def run(batches):
            for batch in batches:
                for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    source, base = pafs.FileSystem.from_uri(path)
                    with source.open_input_file(base) as file:
                        yield from _blocks(ShardReader(file).documents(asked), first)

        return run

    return to_rows(spread, make, "doc_id long, start long, n_tokens long, ids binary")


def _blocks(documents, first: int, most_bytes: int = 4 << 20) -> Iterator[dict]:
    held: list[tuple] = []
    size = 0
    for doc_id, at, ids in documents:
        held.append((doc_id, first + at, len(ids), ids.tobytes()))
        size += 4 * len(ids)
        if size > most_bytes:
            yield _columns(held)
            held, size = [], 0
    if held:
        yield _columns(held)


def _columns(held: list[tuple]) -> dict:
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}
    return {n: pa.array([h[i] for h in held], k) for i, (n, k) in enumerate(kinds.items())}
