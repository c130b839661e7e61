from __future__ import annotations

import pyarrow as pa

from orderloom.llm.rows import add_columns, slices, texts_of, to_rows, without


def test_slices_are_bounded_and_whole():
    texts = ["x" * n for n in (1, 0, 50_000, 3, 9, 20_000, 20_000, 1)] * 5 + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), 30_000))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.num_rows == 1 or p.nbytes <= 60_000 for p in parts) and len(parts) > 10


def test_columns_that_clash_give_way(spark):
    df = spark.createDataFrame([(1, "a", 5.0)], "id int, text string, LENGTH double")
    made = add_columns(df, lambda: lambda b: [pa.array([len(t) for t in texts_of(b, "text")], pa.int64())], "length long", ["text"])
    assert made.columns == ["id", "length"] and tuple(made.first()) == (1, 1)
    assert without(df, ["Text", "missing"]).columns == ["id", "LENGTH"]


def test_rows_of_another_number(spark):
    def make():
        def run(batches):
            for batch in batches:
                yield {"n": pa.array([i for i in batch.column(0).to_pylist() for _ in range(2)], pa.int64())}

        return run

    assert to_rows(spark.range(50), make, "n long").count() == 100
