from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import ngram_join
from orderloom.llm.components import components
from orderloom.llm.ngram_join import near_duplicates, overlap_bound, shared

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def roots(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def plain(rows):
    sets = {d: shingles(t) for d, t in rows}
    linked = []
    for (a, x), (b, y) in combinations(sets.items(), 2):
        both = len(x & y)
        if both and 100 * both >= 75 * len(x | y):
            linked.append((a, b))
    found = roots(sets, linked)
    return {d: (len(s), found[d]) for d, s in sets.items()}


def made_up(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    some = lambda k: [word() for _ in range(k)]
    common = some(30)
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3 or not texts:
            words = some(rng.choice([1, 3, 4, 5, 6, 20, 60, 200]))
        elif kind < 0.5:
            words = some(rng.randint(5, 40)) + common
        else:
            words = rng.choice(texts).split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = word()
            if rng.random() < 0.3:
                words = words[: max(1, int(len(words) * rng.uniform(0.6, 1)))]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed,block", [(1, 2_000), (2, 3)])
def test_equals_all_pairs(spark, seed, block):
    rows = list(enumerate(made_up(seed, 300)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one\x0btwo"), (1005, "one two"), (1006, "ÀB c"), (1007, "àb c")]
    rows += [(1010, "very long " + " ".join(map(str, range(30_000)))), (1011, " ".join(map(str, range(30_000))))]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id int, text string, node string, id int")
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, block=block).collect()}
    assert got == plain(rows)


def test_one_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SENT_PER_TILE", 3)
    monkeypatch.setattr(ngram_join, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(ngram_join, "ENTRIES_PER_SHARE", 100)
    monkeypatch.setattr(ngram_join, "REPRESENTATIVES", 1)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for d in range(250):
        words = list(base)
        words[rng.randrange(80)] = f"own{d}"
        rows.append((d, " ".join(words)))
    rows += [(500 + k, " ".join(base[:40] + [f"x{k}y{j}" for j in range(20)])) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(7)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, block=16).collect()}
    assert got == plain(rows)


def test_repeated_rows_and_null_ids(spark):
    text = "one two three four five six"
    rows = [(5, text), (5, text), (None, text), (3, text), (None, "alone here"), (None, None), (9, "")]
    got = sorted(map(repr, (tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect())))
    assert got == sorted(map(repr, [(5, 2, 3), (5, 2, 3), (None, 2, 3), (3, 2, 3), (None, 1, None), (None, 0, None), (9, 0, 9)]))


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        x, y = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        bits = [np.frombuffer(ngram_join.bitmap(s), np.uint64) for s in (x, y)]
        bits = [ngram_join.folded(b, min(map(len, bits))) for b in bits]
        overlap = len(np.intersect1d(x, y))
        assert shared(x, y) == overlap
        assert overlap_bound(*bits, len(x), len(y)) >= overlap


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randint(-50, 300), rng.randint(-50, 300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7), (1000, 1000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = [(a, b) for a, b in pairs if a != b]
    assert got == roots({x for p in linked for x in p}, linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("n", [150, 300])
def test_rows_grow_with_the_members_of_a_group(spark, monkeypatch, n):
    """Documents that share a base and differ in three words each: most pairs lie about the threshold."""
    rng = random.Random(3)
    rows = []
    for d in range(n):
        words = [f"base{k}" for k in range(100)]
        for at in rng.sample(range(100), 3):
            words[at] = f"own{d}at{at}"
        rows.append((d, " ".join(words)))
    links = []
    original = ngram_join._cross_links

    def watched(*args):
        found = original(*args)
        links.append(found.count())
        return found

    monkeypatch.setattr(ngram_join, "_cross_links", watched)
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect()}
    assert got == plain(rows)
    assert 0 < links[0] < n


def test_rows_are_told_apart_by_what_they_carry(spark):
    text = "one two three four five six"
    rows = [(5, text, 1), (5, "other words", 2), (None, text, 3), (None, None, 4), (None, "alone", 5)]
    df = spark.createDataFrame(rows, "doc_id int, text string, mark long")
    got = {r["carried"]: r for r in near_duplicates(df, carried=F.col("mark")).collect()}
    assert got[1].group == got[3].group is not None and got[2].group not in (None, got[1].group, got[5].group)
    assert got[4].group is None and got[5].group is not None and got[1].component_id == 5
    assert near_duplicates(df).columns == ["id", "n_shingles", "component_id"]
