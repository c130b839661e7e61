from __future__ import annotations

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_bpe import LIBRARY
from test_decontaminate import plain as overlaps
from test_line_dedup import plain as cleaned_lines
from test_ngram_join import plain as groups

import corpus_pipeline
from orderloom.llm import line_dedup, quality
from orderloom.llm.rows import table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_every_stage_and_the_whole_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "lines", "near_duplicates", "contamination", "tokens"]
    docs = table(spark, FOLDER, "documents")

    def apply(name, rows):
        frame = spark.createDataFrame(rows, docs.schema)
        out = stages[name](spark, frame, FOLDER)
        assert name == "tokens" or out.columns == COLUMNS
        return rows_of(out)

    rows = rows_of(docs)
    model = quality.train(docs, table(spark, FOLDER, "labels"))
    scores = model.scores(np.array([quality.features(r[1]) for r in rows]))
    expected = [r for r, s in zip(rows, scores) if s >= 0.5]
    assert apply("quality", rows) == expected and 0 < len(expected) < len(rows)

    rows = expected
    by_id = {r[0]: r for r in rows}
    found = cleaned_lines([(r[0], r[1], r[3]) for r in rows], line_dedup.LEAST_SITES, corpus_pipeline.LONG_LINE_SITES)
    expected = sorted(
        (d, t, *by_id[d][2:4], len(t)) for d, t, _, gone in found if not gone or t.strip(" \t\n\v\f\r")
    )
    assert apply("lines", rows) == expected

    rows = expected
    roots = groups([(r[0], r[1]) for r in rows])
    expected = [r for r in rows if roots[r[0]][1] == r[0]]
    assert apply("near_duplicates", rows) == expected

    rows = expected
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    hits = overlaps([(r[0], r[1]) for r in rows], items)
    expected = [r for r in rows if not hits[r[0]][2]]
    assert apply("contamination", rows) == expected and expected

    rows = expected
    expected = []
    for doc, text, *_ in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        back = LIBRARY.decode(ids, skip_special_tokens=False).encode()
        expected.append((doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back).hexdigest()))
    assert apply("tokens", rows) == expected
    assert rows_of(corpus_pipeline.run(spark, FOLDER)) == expected


def test_odd_documents_pass_every_filter_without_a_crash(spark):
    docs = table(spark, FOLDER, "documents")
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id " * 9, "en", "s", 1), (3, "x", None, "s", 1), (3, "x", None, "s", 1)]
    for name, stage in corpus_pipeline.STAGES:
        for rows in (odd, []):
            out = stage(spark, spark.createDataFrame(rows, docs.schema), FOLDER)
            kept = out.count()
            assert kept <= len(rows)
            if name in ("contamination", "tokens"):
                assert kept == len(rows)
            if name == "near_duplicates":  # of the two equal rows one stays
                assert kept == max(0, len(rows) - 1)


def test_a_long_passage_on_few_sources_stays_once(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(k, f"{passage}\nown line {k}", "en", f"s{k % 3}", 0) for k in range(12)]
    docs = spark.createDataFrame(rows, table(spark, FOLDER, "documents").schema)
    left = rows_of(corpus_pipeline.line_stage(spark, docs, FOLDER))
    assert [r[1] for r in left] == [rows[0][1]] + [f"own line {k}" for k in range(1, 12)]


def test_copies_with_blank_lines_leave_no_document_without_words(spark):
    texts = ["A a\n\nB b\n\nC c", "D d\n \t\n\r\nE e", "F f"]
    rows = [(20 * n + k, t, "en", f"s{k}", 0) for n, t in enumerate(texts) for k in range(9)]
    blank = [(100, "\n\n", "en", "s1", 2), (101, None, "en", "s1", None), (102, "A a\n\nown", "en", "s1", 0)]
    docs = spark.createDataFrame(rows + blank, table(spark, FOLDER, "documents").schema)
    left = {r[0]: r[1] for r in rows_of(corpus_pipeline.line_stage(spark, docs, FOLDER))}
    found = cleaned_lines([(r[0], r[1], r[3]) for r in rows + blank], line_dedup.LEAST_SITES)
    assert left == {d: t for d, t, _, gone in found if not gone or t.strip(" \t\n\v\f\r")}
    assert sorted(left) == [0, 20, 40, 100, 101, 102] and left[102] == "\nown"


def test_columns_of_the_caller_are_kept(spark):
    extra = ["score", "n_lines", "items", "Predicted", "n_removed", "hits", "spans", "n_words", "_version", "group", "carried", "id"]
    docs = table(spark, FOLDER, "documents").limit(60)
    own = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in extra])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, own, FOLDER)
        assert out.columns == own.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in extra)


def test_near_duplicates_are_told_by_row(spark):
    text = "one two three four five six seven eight"
    rows = [
        (4, text, "en", "a", 1), (4, "quite another text that stays", "en", "a", 1), (9, text, "en", "b", 1),
        (None, text, "en", "c", 1), (None, "alone without an id", "en", "c", 1), (None, "alone without an id", "en", "d", 1),
        (2, text.upper(), "en", "e", 1), (2, text.upper(), "en", "e", 1), (7, None, "en", "e", 0), (7, None, "en", "e", 0),
    ]
    docs = spark.createDataFrame(rows, table(spark, FOLDER, "documents").schema)
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, FOLDER).collect()]
    assert sorted(left, key=repr) == sorted(
        [(2, text.upper()), (4, "quite another text that stays"), (None, "alone without an id"), (7, None), (7, None)], key=repr
    )
