"""Exact duplicates by distributed most-significant-digit radix partitioning."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.joins import looked_up
from orderloom.llm.rows import written

# Digits are runs of bytes: the first separates most texts, later ones grow so that few
# passes reach the end of a long text. A digit is a grouping key, so it stays bounded.
FIRST_DIGIT, DIGIT_GROWTH, LARGEST_DIGIT = 256, 4, 1 << 20


def digit_widths() -> Iterator[int]:
    width = FIRST_DIGIT
    while True:
        yield width
        width = min(width * DIGIT_GROWTH, LARGEST_DIGIT)


def _split(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """One pass: the rows of a group that share the next digit form a group of their own.

    Rows alone in their group and groups whose texts have ended are done: they keep no rest.
    Counts are combined before the shuffle, so a hot group sends one row per task. The
    groups of several rows are written, so the join back is one of two plain inputs, which
    adaptive execution splits at a hot group, or broadcasts if there are few.
    """
    cut = rows.withColumn("digit", F.substring("rest", 1, width))
    name = F.min("row") if keys else F.first("digit")
    counted = cut.groupBy(*keys, "digit").agg(F.count("*").alias("size"), name.alias("below"))
    groups = written(counted.filter("size > 1"), "radix-groups")
    more = F.col("size").isNotNull() & (F.length("digit") == width)
    return cut.join(groups, [*keys, "digit"], "left").select(
        F.col("below").alias("group"),
        F.col("row") if keys else F.monotonically_increasing_id().alias("row"),
        "id",
        "carried",
        F.coalesce("size", F.lit(1)).cast("long").alias("size"),
        F.when(more, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
    )


def exact_groups(df: DataFrame, id: str = "doc_id", text: str = "text", carried: Column | None = None) -> DataFrame:
    """One row per row of df: id, keep_id, group_size, kept and what is carried along.

    Texts are equal when their UTF-8 bytes are; a null text counts as empty. Of equal
    texts the row with the largest id stays (a null id is the smallest; of rows that also
    share the id, one stays). carried is any column of df, computed in the first scan.

    Documents are split by successive bytes until a group is a single row or its texts
    have ended; no digest decides. Only rows that still share all bytes so far go into
    the next pass. Each pass is written to the shared folder, which also fixes the row
    numbers that the first one gives. An empty table gives an empty result; columns of df
    other than those named are not read.
    """
    active = df.select(
        F.col(f"`{id}`").alias("id"),
        (F.lit(None).cast("string") if carried is None else carried).alias("carried"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("rest"),
    )
    alone, shared = [], []
    for level, width in enumerate(digit_widths()):
        state = written(_split(active, ["group"] if level else [], width), "radix")
        ended = state.filter("rest is null")
        alone.append(ended.filter("size = 1"))
        shared.append(
            ended.filter("size > 1").select(
                F.struct(F.lit(level).alias("level"), F.hex("group").alias("group")).alias("key"), "row", "id", "carried", "size"
            )
        )
        active = state.filter("rest is not null").drop("size")
        if active.isEmpty():
            break
    single = reduce(DataFrame.unionByName, [a.select("id", "carried", "size") for a in alone])
    copies = reduce(DataFrame.unionByName, shared)
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "row")
    best = written(copies.groupBy("key").agg(F.max(order).alias("best")), "radix-best")
    return single.select(
        "id", "carried", F.col("id").alias("keep_id"), F.col("size").alias("group_size"), F.lit(True).alias("kept")
    ).unionByName(
        looked_up(copies, best, ["key"]).select(
            "id", "carried", F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("best.row") == F.col("row")).alias("kept")
        )
    )
