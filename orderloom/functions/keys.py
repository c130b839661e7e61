"""Surrogate keys computed from the natural key, and one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.sources.folders import new_folder
from orderloom.sources.sizing import broadcasts, hinted, line_scan_bytes, sized_shuffles

# Bits of the digest that keys are first counted by: of 2 * 10^8 keys some 36,000 share one by chance.
DIGEST_BITS = 40


def _digest(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("long")


def surrogate_key(*parts: str | Column) -> Column:
    """64-bit digest of a natural key.

    The same key comes out in every run, on every executor and in both the
    dimension and the fact, so the fact needs no join to find it. Each part is
    written with its length, so no two different tuples (or nulls) read alike.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat(*[
        F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("null;"))
        for c in columns
    ])
    return _digest(text)


def date_key(date: str | Column) -> Column:
    """The date as an integer yyyyMMdd."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def key_clashes(dimension: DataFrame, key: str) -> DataFrame:
    """Surrogate keys carried by more than one row; must be empty.

    Of 10^9 members two clash with a chance of some 3 %; a batch run looks for it before
    it publishes, and gives one of them another key (see rekeyed).
    """
    return dimension.groupBy(key).agg(F.count("*").alias("members")).where("members > 1")


def rekeyed(
    dimension: DataFrame, natural: Sequence[str], key: str, number: int, stays: DataFrame | None = None
) -> DataFrame:
    """The dimension with other keys for members that share theirs.

    Of those members one keeps the key: first one that stays lists, then the least natural key.
    The others get the digest of their natural key with a number before it; it may clash again,
    then the next number is tried. The same members have the same keys in every run. Only the
    members concerned are put in order.
    """
    first = F.lit(True)
    rows = dimension
    if stays is not None:
        rows = rows.join(stays.select(*natural).distinct().withColumn("_stays", F.lit(True)), list(natural), "left")
        first = F.col("_stays").isNull()
    shared = key_clashes(dimension, key).select(key)
    place = F.row_number().over(Window.partitionBy(key).orderBy(first, *[F.col(n).asc_nulls_first() for n in natural]))
    clashing = rows.join(shared, key, "left_semi").withColumn("_place", place)
    other = F.when(F.col("_place") > 1, surrogate_key(F.lit(f"again {number}"), *natural)).otherwise(F.col(key))
    alone = dimension.join(shared, key, "left_anti")
    return alone.unionByName(clashing.withColumn(key, other).select(*dimension.columns))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Mapping[str, str]) -> DataFrame:
    """The first row of every key; order maps columns to "asc" or "desc", nulls last.

    Ties are broken by all other columns, so every run picks the same row.
    Spark limits each key to one row inside every map task before the shuffle
    (WindowGroupLimit), so a key that holds a third of the rows sends one row
    per task, not the whole group, to its reducer.
    """
    first = [
        F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last()
        for c, way in order.items()
    ]
    tie_break = [F.col(c) for c in df.columns if c not in keys and c not in order]
    window = Window.partitionBy(*keys).orderBy(*first, *tie_break)
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def unique_per_key(df: DataFrame, keys: Sequence[str], order: Mapping[str, str]) -> DataFrame:
    """first_per_key where few keys occur twice: only lines of such keys are moved.

    A digest of the keys is counted first, so that of nearly all lines no more than that is shuffled;
    unless very many come twice, only lines whose digest does are looked at again. One hash
    aggregate over their bare keys and the first order column finds the keys with several
    lines and the value of the line that stays. The found keys are written at once: their size
    is known then, and unless they are many they are broadcast, so that whole lines stay where
    they are. All other lines of those keys go in one pass over the lines, by an anti join. Only
    keys whose surviving line that value does not settle (two lines that share it, or more than
    two lines) have theirs put in order; without such a key, adaptive execution leaves that pass out.
    """
    column, way = next(iter(order.items()))
    least, most = F.min(column), F.max(column)
    size = line_scan_bytes(df)
    digest = F.shiftright(F.xxhash64(*keys), 64 - DIGEST_BITS)
    counted = df.groupBy(digest.alias("_digest")).agg(F.count("*").alias("_copies"))
    twice = _kept(counted.where("_copies > 1").select("_digest"), "repeated-digests", size)
    # A digest may be shared by two keys: these are told apart here.
    rows = df.join(hinted(twice), digest == F.col("_digest"), "left_semi") if broadcasts(twice) else df
    found = rows.groupBy(*keys).agg(
        F.count("*").alias("_copies"),
        F.count(column).alias("_known"),
        (most if way == "desc" else least).alias("_first"),
        least.eqNullSafe(most).alias("_same"),
    ).where("_copies > 1")
    several = found.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        "_first",
        ((F.col("_copies") > 2) | (F.col("_same") & (F.col("_known") != 1))).alias("_unsettled"),
    )
    several = _kept(several, "repeated-keys", size)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    goes = F.col("_unsettled") | ~F.col(column).eqNullSafe(F.col("_first"))
    settled = df.join(hinted(several), same & goes, "left_anti")
    unsettled = df.join(hinted(several.where("_unsettled")), same, "left_semi")
    return settled.unionByName(first_per_key(unsettled, keys, order))


def _kept(rows: DataFrame, label: str, input_bytes: int) -> DataFrame:
    """Rows made from so many bytes, written and read back: their size is known then."""
    spark = rows.sparkSession
    path = new_folder(spark, label)
    with sized_shuffles(spark, input_bytes):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
