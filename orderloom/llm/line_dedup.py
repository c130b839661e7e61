"""Boilerplate lines by how many distinct sites they are on; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import without, written

# A line on this many sites or more is boilerplate.
LEAST_SITES = 8

# A line of this many words or more does not recur by chance; callers may give such lines a lower bar.
LONG_WORDS = 50

# 2^12 registers: a relative standard error of 1.6 %. Estimates within NEAR of the
# threshold, six standard errors, are settled by exact counts.
SKETCH_LOG2 = 12
NEAR = 0.10


def line_key(line: Column) -> Column:
    """A line without blanks around it, as 64 bits; null for a blank line, which is never boilerplate."""
    bare = F.trim(line)
    return F.when(bare != "", F.xxhash64(bare))


def is_long(line: Column, words: int = LONG_WORDS) -> Column:
    """Whether a line has so many words, runs of characters other than white space of ASCII."""
    # So many words need one character each and one between two; the pattern looks at nothing shorter.
    return (F.length(line) >= 2 * words - 1) & (F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")) >= words)


def _lines(df: DataFrame, id: str, text: str, site: str, least_sites: int, long_sites: int | None) -> DataFrame:
    """One narrow row per line that is not blank: its key, its bar, site, document and position."""
    if long_sites is None:
        entry = lambda line: F.struct(line_key(line).alias("line"), F.lit(least_sites).alias("bar"))
    else:
        bar = lambda line: F.when(is_long(line), long_sites).otherwise(least_sites)
        entry = lambda line: F.struct(line_key(line).alias("line"), bar(line).alias("bar"))
    rows = df.select(
        F.col(f"`{id}`").alias("doc"),
        F.xxhash64(f"`{text}`").alias("version"),
        F.xxhash64(F.coalesce(F.col(f"`{site}`").cast("string"), F.lit(""))).alias("site"),
        F.posexplode(F.transform(F.split(f"`{text}`", "\n"), entry)).alias("at", "entry"),
    )
    return rows.select("doc", "version", "site", "at", "entry.line", "entry.bar").filter("line is not null")


def boilerplate_lines(lines: DataFrame, near: float = NEAR) -> DataFrame:
    """Lines on at least as many sites as their bar says, with the place of their first occurrence.

    Lines that do not occur that often at all, or on one site only, cannot be; a hash
    aggregate with map-side combining removes them, and a hot line is one row per task.
    One more such aggregate over the other lines' rows gives a sketch of each line's sites
    and its first occurrence. Only lines whose estimate is near the threshold have their
    (line, site) pairs made distinct and counted.
    """
    often = written(
        lines.groupBy("line")
        .agg(F.count("*").alias("n"), F.min("site").alias("low"), F.max("site").alias("high"), F.min("bar").alias("bar"))
        .filter((F.col("n") >= F.col("bar")) & ((F.col("bar") < 2) | (F.col("low") != F.col("high"))))
        .select("line", "bar"),
        "line-often",
    )
    lines = lines.drop("bar")
    spread = (
        lines.join(often, "line")
        .groupBy("line", "bar")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_LOG2))).alias("sites"),
            F.min(F.struct("doc", "at")).alias("first"),
        )
    )
    low, high = F.col("bar") * (1 - near), F.col("bar") * (1 + near)
    spread = written(spread.filter(F.col("sites") >= low), "line-spread")
    unsure = spread.filter(F.col("sites") <= high)
    pairs = written(lines.join(unsure.select("line", "bar"), "line").select("line", "bar", "site").distinct(), "line-sites")
    exact = pairs.groupBy("line", "bar").count().filter(F.col("count") >= F.col("bar")).select("line")
    sure = spread.filter(F.col("sites") > high).select("line", "first")
    return written(sure.unionByName(unsure.select("line", "first").join(exact, "line")), "boilerplate")


def without_boilerplate(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    least_sites: int = LEAST_SITES,
    near: float = NEAR,
    long_sites: int | None = None,
) -> DataFrame:
    """df with each boilerplate line left only where it occurs first; n_lines and n_removed added.

    Lines are split at line feeds and compared without the blanks around them. A line on
    least_sites distinct sites or more is boilerplate, and with long_sites a line of
    LONG_WORDS words from so many on; of its occurrences the first, by (id, position),
    stays, so no content is lost from the corpus. A null site counts as
    one site of its own. A null text stays null and has no lines; an empty text has one
    blank line, and blank lines always stay. Rows repeated with the same id and text are
    treated alike. A null id comes first. Columns named like a result give way to it.

    What is shuffled: narrow line rows for the counts, the positions to remove, and the
    documents once, joined with those positions (Spark broadcasts them if they are few).
    """
    lines = _lines(df, id, text, site, least_sites, long_sites)
    boilerplate = boilerplate_lines(lines, near)
    gone = (
        lines.join(boilerplate, "line")
        .filter(~F.struct("doc", "at").eqNullSafe(F.col("first")))
        .groupBy("doc", "version")
        .agg(F.collect_set("at").alias("gone"))
    )
    gone = written(gone, "lines-gone")
    rest = without(df, ["n_lines", "n_removed"])
    joined = rest.alias("rows").join(
        gone.alias("removed"),
        F.col(f"rows.`{id}`").eqNullSafe(F.col("removed.doc"))
        & (F.xxhash64(F.col(f"rows.`{text}`")) == F.col("removed.version")),
        "left",
    )
    source = F.col(f"rows.`{text}`")
    all_lines = F.split(source, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("removed.gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(all_lines, i)), "\n")
    cleaned = F.when(F.col("removed.gone").isNull(), source).otherwise(kept)
    return joined.select(
        *[cleaned.alias(c) if c.lower() == text.lower() else F.col(f"rows.`{c}`") for c in rest.columns],
        F.when(source.isNull(), 0).otherwise(F.size(all_lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed.gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
