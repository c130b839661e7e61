from __future__ import annotations

import re
from collections import defaultdict

import pytest

from orderloom.llm import line_dedup
from orderloom.llm.line_dedup import without_boilerplate


def plain(rows, least, long=None):
    """Every line counted; long is the bar of lines of LONG_WORDS words and more, if they have one."""
    words = re.compile(r"[^\x20\x09-\x0D]+").findall
    bar = lambda bare: least if long is None or len(words(bare)) < line_dedup.LONG_WORDS else long
    sites, first = defaultdict(set), {}
    for doc, text, site in rows:
        for at, line in enumerate(text.split("\n") if text is not None else []):
            bare = line.strip(" ")
            if bare:
                sites[bare].add(site or "")
                place = (doc is not None, doc or 0, at)
                first[bare] = min(first.get(bare, place), place)
    out = []
    for doc, text, _ in rows:
        if text is None:
            out.append((doc, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for at, x in enumerate(lines) if len(sites[x.strip(" ")]) < bar(x.strip(" ")) or first[x.strip(" ")] == (doc is not None, doc or 0, at)]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


ROWS = (
    [(k, f"own {k}\n  shared by many \nrare {k // 4}\n\nend", f"s{k % 12}") for k in range(60)]
    + [(100 + k, "near the threshold", f"s{k}") for k in range(7)]
    + [(200 + k, "at the threshold\nat the threshold", f"s{k}") for k in range(8)]
    + [(300 + k, "often on one site", "s1") for k in range(40)]
    + [(400, None, "s1"), (401, "", "s2"), (402, "shared by many", None), (403, "shared by many", ""), (402, "shared by many", None)]
    + [(None, "shared by many\nwithout id", "s3"), (404, "shared by many\n" * 20_000 + "x", "s4"), (405, " \n\n ", "s5")]
)


@pytest.mark.parametrize("least,near", [(8, 0.1), (8, 0.9), (2, 0.1), (1, 0.1), (1000, 0.1)])
def test_equals_counting_every_line(spark, least, near):
    df = spark.createDataFrame([(d, t, s, [1], 2) for d, t, s in ROWS], "doc_id int, text string, source string, site array<int>, N_LINES int")
    found = without_boilerplate(df, least_sites=least, near=near)
    assert found.columns == ["doc_id", "text", "source", "site", "n_lines", "n_removed"]
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in found.collect()), key=repr)
    assert got == plain(ROWS, least)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert without_boilerplate(df).count() == 0


def test_plan_has_no_python(spark):
    df = spark.createDataFrame(ROWS, "doc_id int, text string, source string")
    plan = without_boilerplate(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_long_lines_have_a_bar_of_their_own(spark):
    long, short = " ".join(f"w{k}" for k in range(50)), " ".join(f"w{k}" for k in range(49))
    bare = long.replace(" ", "\t ")
    rows = [(k, f"{long}\n{short}\n{bare}\nown {k}", f"s{k}") for k in range(3)]
    rows += [(10 + k, f"two {long}\nown {10 + k}", f"s{k}") for k in range(2)]
    rows += [(20 + k, f"one {long}", "s1") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = {r["doc_id"]: r["text"] for r in without_boilerplate(df, long_sites=3).collect()}
    assert got == {d: t if d not in (1, 2) else f"{short}\nown {d}" for d, t, _ in rows}
    assert {r["doc_id"]: r["text"] for r in without_boilerplate(df).collect()} == {d: t for d, t, _ in rows}


def test_only_lines_near_the_threshold_have_their_sites_listed(spark, monkeypatch):
    tables = {}

    def kept(df, label, write=line_dedup.written):
        tables[label] = write(df, label)
        return tables[label]

    monkeypatch.setattr(line_dedup, "written", kept)
    rows = [(k, "on many sites", f"s{k % 40}") for k in range(80)] + [(100 + k, "near it", f"s{k % 8}") for k in range(16)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    assert without_boilerplate(df).filter("n_removed = 1").count() == 79 + 15
    assert tables["line-sites"].count() == 8
