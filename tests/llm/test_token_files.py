from __future__ import annotations

import io
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm.queries import QUERIES, WORD_BPE
from orderloom.llm.bpe import read_vocabulary
from orderloom.llm.token_files import LibraryEncoder, ShardReader, ShardWriter, read_token_files, write_token_files
from orderloom.sources.folders import new_folder

LIBRARY = Tokenizer.from_file(WORD_BPE)
ENCODER = LibraryEncoder(read_vocabulary(WORD_BPE))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBthéein 'sÉ\n\t\x1c\x85 　1.,!İΣ日́<|>endoftx"), max_size=60), max_size=5))
def test_units_equal_whole_texts(texts):
    texts = [*texts, "x<|endoftext|>Y <|startoftext|>"]
    assert [i.tolist() for i in ENCODER.ids(texts)] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def shard(documents, frame_bytes=200):
    sink = io.BytesIO()
    writer = ShardWriter(sink, frame_bytes)
    for doc, ids in documents:
        writer.add(doc, np.array(ids, np.uint32))
    writer.finish()
    return sink


DOCUMENTS = [(None, [5]), (-3, []), (0, [1, 2]), (7, list(range(1000)))] + [(10 + k, [k] * k) for k in range(90)] + [(99, [1]), (99, [2])]


def test_round_trip_and_frames_on_demand():
    sink = shard(DOCUMENTS)
    reader = ShardReader(sink)
    assert [(d, i.tolist()) for d, _, i in reader.documents()] == DOCUMENTS
    starts = [s for _, s, _ in ShardReader(sink).documents()]
    assert starts == np.cumsum([0] + [len(i) for _, i in DOCUMENTS])[:-1].tolist()
    few = ShardReader(sink)
    assert [(d, s, i.tolist()) for d, s, i in few.documents([30, 99])] == [
        (d, s, i) for (d, i), s in zip(DOCUMENTS, starts) if d in (30, 99)
    ]
    assert few.opened <= 3 < len(few.entries)


def test_any_zstandard_reader_unpacks_it():
    sink = shard(DOCUMENTS)
    raw = sink.getvalue()
    out = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert len(out) == sum(size for _, size, _ in ShardReader(sink).entries)


def test_an_empty_file():
    assert list(ShardReader(shard([])).documents()) == []


@pytest.mark.parametrize("at", [3, 40, -1, -5, -20, -60])
def test_damage_is_noticed(at):
    raw = bytearray(shard(DOCUMENTS).getvalue())
    raw[at] ^= 0x55
    with pytest.raises(ValueError):
        found = [(d, i.tolist()) for d, _, i in ShardReader(io.BytesIO(bytes(raw))).documents()]
        if found == DOCUMENTS:
            raise ValueError("only the index of unused ids was hit")


def test_short_files_are_refused():
    for size in (0, 5, 30):
        with pytest.raises(ValueError):
            ShardReader(io.BytesIO(shard(DOCUMENTS).getvalue()[:size]))


def test_files_of_a_table(spark):
    rows = [(k * 7 % 101, f"Word{k} of the, text\n " * (k % 9)) for k in range(101)] + [(None, "no id"), (200, None), (201, ""), (202, "long " * 50_000), (5, "again"), (5, "again")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int").repartition(5)
    manifest = write_token_files(df, new_folder(spark, "files"), WORD_BPE, end_id=1, frame_bytes=500)
    assert manifest.count() > 1
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, start = [], 0
    for doc, text in ordered:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc"))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected
    assert read_token_files(write_token_files(df.limit(0), new_folder(spark, "files"), WORD_BPE, end_id=1)).count() == 0


def test_rows_without_an_id_are_dealt_over_files(spark):
    df = spark.createDataFrame([(None, "the same text")] * 300 + [(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    manifest = write_token_files(df.repartition(10), new_folder(spark, "files"), WORD_BPE, end_id=1)
    files = manifest.orderBy("shard").collect()
    assert len(files) == 5 and max(f.n_docs for f in files) < 120
    assert [(f.first_id, f.last_id) for f in files][-1][1] == 19 and files[0].first_id is None
    rows = sorted(map(tuple, read_token_files(manifest).select("start", "doc_id").collect()))
    assert [d for _, d in rows] == [None] * 300 + list(range(20))


def test_some_documents_are_read_from_the_files_that_may_hold_them(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")).repartition(8)
    manifest = write_token_files(df, new_folder(spark, "files"), WORD_BPE, end_id=1, frame_bytes=300)
    whole = {r.doc_id: tuple(r) for r in read_token_files(manifest).collect()}
    some = read_token_files(manifest, wanted=[3, 390, 390, 5_000])
    assert {r.doc_id: tuple(r) for r in some.collect()} == {k: whole[k] for k in (3, 390)}
    assert read_token_files(manifest, wanted=[]).count() == 0


def test_the_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    expected, start = [], 0
    for doc, text in docs:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = QUERIES["op6_token_files"](spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == expected
