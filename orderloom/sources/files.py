"""Raw order files in, bronze column names out."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schema import BROKEN_RECORD, ORDER_LINE_COLUMNS, ORDER_LINE_HEADINGS


def _order_schema() -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType()) for h in ORDER_LINE_HEADINGS])


def read_order_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw order lines, every column as text; a line with more or fewer columns fails the read.

    The schema is given, so no pass over the data infers it, and the heading
    line is checked against it instead of being trusted by position.
    """
    return (
        spark.read.schema(_order_schema())
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def has_quoted_line_feeds(spark: SparkSession, path: str) -> bool:
    """Whether a record may go on over a line feed: some line has an odd number of quotes then."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_order_records(
    spark: SparkSession, path: str, header: bool = True, multi_line: bool | None = None
) -> DataFrame:
    """Raw order lines as text, and broken records as they stand in the file.

    A record that has more or fewer columns than the headings (cut off, or with a comma
    that no quotes protect) has its text in the column broken_record; whatever else is in
    its row is not to be trusted, and cleaning does not (see quality.quarantine).

    A line feed inside quotes belongs to its value if multi_line is set. Files are then read
    by one task each, as nothing but the quotes before it tells where a record starts. Without
    it large files are split, and a record with such a line feed becomes two broken ones. By
    default the lines are looked through for an odd number of quotes first.
    """
    if multi_line is None:
        multi_line = has_quoted_line_feeds(spark, path)
    schema = _order_schema().add(BROKEN_RECORD, T.StringType())
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN_RECORD)
        .option("multiLine", multi_line)
        .csv(path)
    )


def rename_by_position(df: DataFrame) -> DataFrame:
    """Bronze names by position; refuses a frame of any other width."""
    if len(df.columns) != len(ORDER_LINE_COLUMNS):
        raise ValueError(f"expected {len(ORDER_LINE_COLUMNS)} columns, got {len(df.columns)}")
    return df.toDF(*ORDER_LINE_COLUMNS)


def rename_by_heading(df: DataFrame) -> DataFrame:
    """Bronze names by heading, whatever order the file has them in.

    The text of broken records comes along where the reader has set it aside.
    """
    names = [re.sub(r"[^a-z0-9]+", "_", h.strip().lower()) for h in df.columns]
    found = dict(zip(names, df.columns))
    twice = sorted({n for n in names if names.count(n) > 1} & set(ORDER_LINE_COLUMNS))
    if twice:
        raise ValueError(f"several headings of the input mean the same column: {twice}")
    missing = [c for c in ORDER_LINE_COLUMNS if c not in found]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    wanted = ORDER_LINE_COLUMNS + ((BROKEN_RECORD,) if BROKEN_RECORD in df.columns else ())
    return df.select(*[F.col(f"`{found[c]}`").alias(c) for c in wanted])
