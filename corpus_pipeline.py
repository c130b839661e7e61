"""From raw documents to token ids: each stage works on all rows the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import decontaminate, line_dedup, ngram_join, quality
from orderloom.llm.queries import tokens_and_digests
from orderloom.llm.rows import table, written


USED = ("doc_id", "text", "source")


def _set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with all columns but USED under names that no operator gives, and the way back.

    Operators put their results in place of columns of the same name; a caller's own score
    or items are neither lost to them nor taken for theirs.
    """
    names = {c: f"_own_{k}" for k, c in enumerate(docs.columns) if c not in USED}
    aside = docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns])
    return aside, lambda frame: frame.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, as they are.

    Null and empty texts are scored like any other; rows of equal text share a verdict. No
    rows give none.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    rows, back = _set_aside(docs)
    return back(quality.with_quality(rows, model).filter("predicted = 1"))


# Sites from which a long line is boilerplate; the README says why it is not 2.
LONG_LINE_SITES = 3


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated boilerplate; one that held nothing else but white space goes.

    A null source is a site of its own. Null and empty texts have no lines and stay, and so do
    texts of blank lines; n_chars, where there is one, is that of the text that is left.
    """
    rows, back = _set_aside(docs)
    cleaned = line_dedup.without_boilerplate(rows, long_sites=LONG_LINE_SITES)
    left = back(cleaned.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")))
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the least id; documents without words stay.

    A row is told by its id and its text, not by its id alone: another document with the same
    id is not taken along, and of rows without an id one stays as well (ids come before none, then
    the least digest of the text decides). Of rows that share id and text one stays.
    """
    version = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    found = ngram_join.near_duplicates(docs, carried=version).filter("group is not null")
    rows = written(found.groupBy("group", "id", "carried").agg(F.count("*").alias("copies")), "near-rows")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "carried")
    best = rows.groupBy("group").agg(F.min(place).alias("best"))
    judged = written(rows.join(best, "group").select("id", "carried", "copies", (place == F.col("best")).alias("stays")), "near-verdicts")
    aside, back = _set_aside(docs)
    aside = aside.withColumn("_version", version)
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_version") == F.col("carried"))
    alone = aside.join(judged.filter("not stays or copies > 1"), same, "left_anti")
    copies = aside.join(judged.filter("stays and copies > 1"), same, "left_semi")
    one = F.min_by(F.struct(*copies.columns), F.xxhash64(*copies.columns)).alias("row")
    return back(alone.unionByName(copies.groupBy("doc_id", "_version").agg(one).select("row.*")))


def contamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, as they are; null and empty texts have none."""
    rows, back = _set_aside(docs)
    found = decontaminate.with_overlap(rows, table(spark, sf_dir, "benchmark"))
    return back(found.filter(F.size("items") == 0))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to, a row per document.

    Null and empty texts have no tokens; rows that repeat are each coded.
    """
    return tokens_and_digests(docs)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("contamination", contamination_stage),
    ("tokens", token_stage),
]

# A fitted model and a tokenizer are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a written table before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return last(spark, docs, sf_dir)
