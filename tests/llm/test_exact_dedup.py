from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from orderloom.llm.exact_dedup import digit_widths, exact_groups


def rows():
    base = "x" * 256
    texts = ["", None, "a", "a", "A", "a ", base, base, base + "y", base[:-1], base * 5, base * 5, base * 5 + "z", "é", "é", "e\u0301"]
    texts += ["long " * 40_000 + tail for tail in ("a", "b", "a")] + [base * 5 + "ü" * k for k in (1, 1, 2)]
    found = [(k, t) for k, t in enumerate(texts)]
    return found + [(3, "a"), (None, "a"), (None, "only"), (None, "twice"), (None, "twice")]


def test_equals_grouping_by_text(spark):
    df = spark.createDataFrame([(d, t, "kept", 1) for d, t in rows()], "doc_id int, text string, size string, row int")
    got = exact_groups(df, carried=F.coalesce("text", F.lit(""))).collect()
    assert len(got) == len(rows())
    groups = defaultdict(list)
    for doc, text in rows():
        groups[text or ""].append(doc)
    for text, ids in groups.items():
        mine = [r for r in got if r["carried"] == text]
        best = max((i for i in ids if i is not None), default=None)
        assert sorted(map(repr, ids)) == sorted(repr(r["id"]) for r in mine)
        assert {(r["keep_id"], r["group_size"]) for r in mine} == {(best, len(ids))}
        (kept,) = [r for r in mine if r["kept"]]
        assert kept["id"] == best


def test_empty_table(spark):
    assert exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_digits_grow_and_stay_bounded():
    widths = digit_widths()
    found = [next(widths) for _ in range(12)]
    assert found[0] < found[1] and found[-1] == found[-2]
