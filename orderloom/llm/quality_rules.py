"""Quality rules: counts of every text, and robust multivariate outliers; DataFrame operations only.

1.  Words, symbols, repeated lines and repeated words of each whole text are counted in its row.
    Texts that break the base rules go.
2.  The others are points of five transformed statistics, as whole numbers. For every language
    and source, the minimum covariance determinant is sought: the mean and covariance of the
    COVERAGE share of points whose covariance has the least determinant. From two starts (all
    points; medians and quartiles), a step takes the points nearest to the estimate and makes
    the next estimate of them, until no determinant falls any more; the lesser one stays.
3.  As usual, the estimate is scaled to a normal distribution, made once more of all points that
    lie within it, and points too far off by their squared Mahalanobis distance are rejected.

Points meet their estimates in a join with one row per language and source. A step adds up
whole numbers per ring of distance, so a hot source sends a few rows per task, sums do not
depend on how rows are dealt, and no ring, however full, is sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import written
from orderloom.sources.sizing import fits_broadcast

# Words and symbols, and the base rules.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Steps of a doubling: a statistic is log2 of a count or ratio in such steps, below 2^15, so
# that sums of products of 2^33 points fit into a long.
STEPS = 512
LARGEST = 32_767

# Spread that each statistic is given beyond its own: a statistic that is the same in nearly all
# texts of a source must not reject all others. Half a doubling of words, an eighth of a doubling
# of their mean length, one doubling of the shares, where a single symbol or line makes one.
LEAST_SPREADS = (STEPS // 2, STEPS // 8, STEPS, STEPS, STEPS)

# Share of the points that an estimate is made of.
COVERAGE = 0.75

# Points below which a language and source have no estimate of their own: those of one language
# are taken together, and if they are still too few, those of all languages.
LEAST_POINTS = 100

# Rings of squared distance per doubling; a ring is taken whole.
RINGS = 16

# Most steps from a start; estimates settle after four to eight.
MOST_STEPS = 20

# Share of normal points that make the final estimate, and that are kept.
WITHIN = 0.975
KEPT = 1 - 1e-9

# Parts of a hot source in a join that cannot be a broadcast.
SALTS = 32


def counts(text: Column) -> list[tuple[str, Column]]:
    """Columns to add one after the other; the last five are COUNTS, the others are scratch.

    Arrays are columns of their own, as what a lambda function names is otherwise computed
    again for each element.
    """
    words, lines, windows, order, places = (F.col(f"_{c}") for c in ("words", "lines", "windows", "order", "places"))
    n = F.size(words)

    def window(first: Column, at: Column) -> Column:
        return F.xxhash64(first, *[F.get(words, at + k) for k in range(1, WINDOW)])

    def repeated(entry: Column, at: Column) -> Column:
        same = lambda k: F.coalesce(F.get(order, k)["window"] == entry["window"], F.lit(False))
        return same(at - 1) | same(at + 1)

    def covered(place: Column, at: Column) -> Column:
        return F.least(F.lit(WINDOW), F.coalesce(F.get(places, at + 1) - place, F.lit(WINDOW)))

    several = F.size(F.array_distinct(windows)) < F.size(windows)
    entries = F.transform(windows, lambda w, i: F.struct(w.alias("window"), i.alias("place")))
    return [
        ("_text", F.coalesce(text, F.lit(""))),
        ("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))),
        ("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD))),
        ("_windows", F.when(n >= WINDOW, F.transform(F.slice(words, F.lit(1), n - (WINDOW - 1)), window)).otherwise(F.array().cast("array<long>"))),
        ("_order", F.when(several, F.sort_array(entries))),
        ("_places", F.sort_array(F.transform(F.filter(order, repeated), lambda e: e["place"]))),
        ("n_words", n.cast("long")),
        ("word_chars", F.length(F.array_join(words, "")).cast("long")),
        ("n_symbols", F.regexp_count("_text", F.lit(SYMBOL)).cast("long")),
        ("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")),
        ("n_repeat_words", F.coalesce(F.aggregate(F.transform(places, covered), F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")),
    ]


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """df with COUNTS and base_failed of each whole text; columns named like these give way.

    Words are runs of characters other than white space of ASCII. word_chars are the code points
    in words, n_dup_lines the lines with a word that equal an earlier line of the text,
    n_repeat_words the words in windows of three that are found twice or more (a window is
    compared by a digest of 64 bits). A null text has none of all.
    """
    steps = counts(F.col("_given"))
    gone = {n.lower() for n, _ in steps} | {"base_failed", "_given"}
    out = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone], F.col(f"`{text}`").alias("_given"))
    for name, column in steps:
        out = out.withColumn(name, column)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_given", *[n for n, _ in steps if n.startswith("_")])


def statistics() -> list[Column]:
    """The point of a text that keeps the base rules, as whole numbers below 2^15."""
    words = F.col("n_words")
    raw = [
        words,
        F.col("word_chars") / words,
        1 + 100 * F.col("n_symbols") / words,
        1 + 100 * F.col("n_dup_lines") / words,
        1 + 100 * F.col("n_repeat_words") / words,
    ]
    return [F.least(F.round(STEPS * F.log2(r)), F.lit(LARGEST)).cast("long") for r in raw]


SIZE = 5
POINT = [f"t{i}" for i in range(SIZE)]
MEAN = [f"m{i}" for i in range(SIZE)]
PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]
INVERSE = [f"w{i}{j}" for i, j in PAIRS]  # of the covariance's Cholesky factor
SUMS = ["n", *[f"s{i}" for i in range(SIZE)], *[f"p{i}{j}" for i, j in PAIRS]]


def normal_share(squared: float, size: int) -> float:
    """Share of standard normal points of so many dimensions within this squared distance."""
    half, z = size / 2, squared / 2
    term = total = 1 / half
    k = 1
    while term > total * 1e-17:
        term *= z / (half + k)
        total += term
        k += 1
    return total * math.exp(half * math.log(z) - z - math.lgamma(half)) if z else 0.0


def squared_distance(share: float, size: int) -> float:
    """The squared distance within which such a share lies."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if normal_share(middle, size) < share else (low, middle)
    return high


def consistency(share: float, size: int) -> float:
    """What the covariance of the innermost share of normal points is to be multiplied with."""
    return share / normal_share(squared_distance(share, size), size + 2)


def _sums() -> list[Column]:
    """Sums of whole numbers over points, in the order of SUMS."""
    t = [F.col(c) for c in POINT]
    return [
        F.count("*").alias("n"),
        *[F.sum(t[i]).alias(f"s{i}") for i in range(SIZE)],
        *[F.sum(t[i] * t[j]).alias(f"p{i}{j}") for i, j in PAIRS],
    ]


def _from_sums(sums: DataFrame, factor: float = 1.0) -> DataFrame:
    """MEAN and covariance columns c.. from SUMS, the covariance times a factor."""
    n = F.col("n").cast("double")
    mean = {f"m{i}": F.col(f"s{i}") / n for i in range(SIZE)}
    covariance = {f"c{i}{j}": F.lit(factor) * (F.col(f"p{i}{j}") / n - F.col(f"m{i}") * F.col(f"m{j}")) for i, j in PAIRS}
    return sums.withColumns(mean).withColumns(covariance)


def _estimates(covariances: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, MEAN, INVERSE and the determinant, from MEAN and covariance columns.

    The squares of LEAST_SPREADS are added to its diagonal, so that it can be inverted.
    """
    out = covariances
    for i, j in PAIRS:  # the factor, row by row
        inner = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        spread = F.col(f"c{i}{j}") - inner + (LEAST_SPREADS[i] ** 2 if i == j else 0)
        out = out.withColumn(f"l{i}{j}", F.sqrt(spread) if i == j else spread / F.col(f"l{j}{j}"))
    for i in range(SIZE):
        for j in range(i + 1):
            below = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            out = out.withColumn(f"w{i}{j}", (1 / F.col(f"l{i}{i}")) if i == j else -below / F.col(f"l{i}{i}"))
    determinant = F.lit(1.0)
    for i in range(SIZE):
        determinant = determinant * F.col(f"l{i}{i}") * F.col(f"l{i}{i}")
    return out.withColumn("determinant", determinant).select(*keys, *MEAN, *INVERSE, "determinant")


def _met(points: DataFrame, small: DataFrame, key: str, how: str) -> DataFrame:
    """Points joined to the row (or rows) of a table by key: a broadcast while that is small.

    Beyond that both sides are parted by a salt, so that no key's points meet in one task.
    """
    if fits_broadcast(small):
        return points.join(F.broadcast(small), key, how)
    salted = points.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, [key, "_salt"], how).drop("_salt")


def _measured(points: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Points with the squared Mahalanobis distance from their cell's estimate."""
    met = _met(points, estimates, "cell", how)
    z = {
        f"z{i}": sum((F.col(f"w{i}{j}") * (F.col(f"t{j}") - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0))
        for i in range(SIZE)
    }
    distance = sum((F.col(c) * F.col(c) for c in z), F.lit(0.0))
    return met.withColumns(z).withColumn("distance", distance).drop(*z, *MEAN, *INVERSE, "determinant")


def _cells(points: DataFrame, least_points: int) -> DataFrame:
    """own -> cell: the language and source, or what it is taken together with if it has few points."""
    sizes = written(points.groupBy("own", "language").agg(F.count("*").alias("n")), "cells")
    together = sizes.filter(F.col("n") < least_points).groupBy("language").agg(F.sum("n").alias("together"))
    cell = (
        F.when(F.col("n") >= least_points, F.col("own"))
        .when(F.col("together") >= least_points, F.col("language"))
        .otherwise(F.lit("all"))
    )
    return written(_met(sizes, written(together, "languages"), "language", "left").select("own", cell.alias("cell")), "cells")


def _starts(points: DataFrame, least_points: int) -> tuple[DataFrame, DataFrame]:
    """The two starts of every cell with enough points; and how many points each cell's estimate needs."""
    quartiles = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    found = written(
        points.groupBy("cell")
        .agg(*_sums(), *[F.percentile(c, quartiles).alias(f"q{c}") for c in POINT])
        .filter(F.col("n") >= least_points),
        "starts",
    )
    middle = {f"m{i}": F.get(f"qt{i}", 1) for i in range(SIZE)}
    spread = lambda i: (F.get(f"qt{i}", 2) - F.get(f"qt{i}", 0)) / 1.349
    apart = {f"c{i}{j}": spread(i) * spread(i) if i == j else F.lit(0.0) for i, j in PAIRS}
    both = [_from_sums(found), found.withColumns(middle).withColumns(apart)]
    rows = [_estimates(b, ["cell"]).withColumn("start", F.lit(k)) for k, b in enumerate(both)]
    # A start's determinant is none of a share of the points, so any first step is a fall.
    starts = rows[0].unionByName(rows[1]).withColumn("determinant", F.lit(math.inf))
    return starts, found.select("cell", F.ceil(COVERAGE * F.col("n")).alias("needed"))


def _stepped(points: DataFrame, estimates: DataFrame, needed: DataFrame) -> DataFrame:
    """The next estimate of each start: of the innermost rings that hold enough points."""
    ring = F.floor(RINGS * F.log2(1 + F.col("distance"))).cast("int")
    rings = _measured(points, estimates).withColumn("ring", ring).groupBy("cell", "start", "ring").agg(*_sums())
    rings = written(rings, "rings")  # some hundred rows per cell and start
    inner = rings.groupBy("cell", "start").agg(F.array_sort(F.collect_list(F.struct("ring", "n"))).alias("held"))
    # The first ring at which enough points are reached.
    reach = F.aggregate(
        "held",
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("ring")),
        lambda state, entry: F.when(state["sum"] >= F.col("needed"), state).otherwise(
            F.struct((state["sum"] + entry["n"]).alias("sum"), entry["ring"].alias("ring"))
        ),
    )["ring"]
    limits = inner.join(needed, "cell").select("cell", "start", reach.alias("outermost"))
    taken = rings.join(limits, ["cell", "start"]).filter("ring <= outermost")
    return _estimates(_from_sums(taken.groupBy("cell", "start").agg(*[F.sum(c).alias(c) for c in SUMS])), ["cell", "start"])


def _least_determinants(points: DataFrame, least_points: int) -> DataFrame:
    """A row per cell: the estimate of least determinant that either start leads to."""
    estimates, needed = _starts(points, least_points)
    estimates, needed = written(estimates, "estimates"), written(needed, "needed")
    for _ in range(MOST_STEPS):
        after = written(_stepped(points, estimates, needed), "estimates")
        columns = [c for c in after.columns if c not in ("cell", "start")]
        then, now = F.struct(*[F.col(f"b.{c}") for c in columns]), F.struct(*[F.col(f"a.{c}") for c in columns])
        falls = F.col("a.determinant") < F.col("b.determinant") * (1 - 1e-9)
        both = estimates.alias("b").join(after.alias("a"), ["cell", "start"]).select("cell", "start", falls.alias("falls"), F.when(falls, now).otherwise(then).alias("e"))
        both = written(both, "estimates")
        estimates = both.select("cell", "start", "e.*")
        if both.filter("falls").isEmpty():
            break
    best = F.min_by(F.struct(*[c for c in estimates.columns if c != "cell"]), F.struct("determinant", "start"))
    return estimates.groupBy("cell").agg(best.alias("e")).select("cell", "e.*").drop("start")


def _final(points: DataFrame, least: DataFrame) -> DataFrame:
    """The estimates again, of all points within the scaled ones."""
    scale = 1 / math.sqrt(consistency(COVERAGE, SIZE))
    scaled = written(least.withColumns({c: F.col(c) * scale for c in INVERSE}), "estimates")
    inside = _measured(points, scaled).filter(F.col("distance") <= squared_distance(WITHIN, SIZE))
    sums = inside.groupBy("cell").agg(*_sums())
    return _estimates(_from_sums(sums, consistency(WITHIN, SIZE)), ["cell"]).drop("determinant")


def judged(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    source: str = "source",
    kept_share: float = KEPT,
    least_points: int = LEAST_POINTS,
) -> DataFrame:
    """One row per row of df: id, COUNTS, base_failed, distance and kept.

    A text fails the base rules with fewer than LEAST_WORDS words, or if more than half of them
    are in repeated windows of three; such texts are no points. distance is the squared
    Mahalanobis distance of the others from the robust estimate of their language and source
    (see the module), null where fewer than least_points points can be put together; kept is
    false for a text that fails the base rules or whose distance is beyond that of kept_share of
    normal points.

    Null and empty texts have no words and fail. A null language or source is one of its own.
    Rows that repeat are points each, and get the same verdict. Texts are counted whole,
    however long. An empty table gives an empty result; other columns of df are not read.
    """
    named = lambda kind, **parts: F.concat(F.lit(kind), F.to_json(F.struct(*[c.cast("string").alias(k) for k, c in parts.items()])))
    lang, site = F.col(f"`{language}`"), F.col(f"`{source}`")
    given = df.select(
        F.col(f"`{id}`").alias("id"),
        named("source ", lang=lang, site=site).alias("own"),
        named("language ", lang=lang).alias("language"),
        F.col(f"`{text}`").alias("text"),
    )
    counted = with_counts(given).drop("text")
    point = [F.when(~F.col("base_failed"), t).alias(c) for c, t in zip(POINT, statistics())]
    rows = written(counted.select("*", *point), "counts")
    cells = _cells(rows.filter(~F.col("base_failed")), least_points)
    placed = written(_met(rows, cells, "own", "left").drop("own", "language"), "points")
    points = placed.filter(~F.col("base_failed")).select("cell", *POINT)
    final = written(_final(points, written(_least_determinants(points, least_points), "estimates")), "estimates")
    far = F.col("distance") > squared_distance(kept_share, SIZE)
    distance = F.when(~F.col("base_failed"), F.col("distance"))
    return _measured(placed, final, "left").select(
        "id", *COUNTS, "base_failed", distance.alias("distance"), (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept")
    )
