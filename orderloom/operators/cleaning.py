"""Silver: typed, trimmed, valid and unique order lines.

The steps work alike on batch and streaming frames; only removing duplicates
needs a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.keys import unique_per_key
from orderloom.schema import (
    BATCH_TEXT_COLUMNS,
    BATCH_V2,
    BROKEN_RECORD,
    DATE_FORMAT,
    DEDUP_KEY,
    ORDER_LINE_SCHEMA,
    Profile,
)


def read_as(source: Column, kind: str, field: T.StructField) -> Column:
    """A value as its field's type, null where it cannot be read."""
    if kind == field.dataType.simpleString():
        return source
    if isinstance(field.dataType, T.DateType) and kind == "string":
        return F.try_to_date(source, DATE_FORMAT)
    return source.try_cast(field.dataType)


def typed(df: DataFrame, schema: T.StructType = ORDER_LINE_SCHEMA) -> DataFrame:
    """Cast to the schema; what cannot be read becomes null instead of failing the job (see flaws)."""
    kinds = dict(df.dtypes)
    return df.select(*[read_as(F.col(f.name), kinds[f.name], f).alias(f.name) for f in schema])


# Whole numbers by width: a wider one holds every narrower one. Fixed values.
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _may_lose(kind: str, field: T.StructField) -> bool:
    """Whether values of one type can get lost, or change, on the way to a field's type."""
    wanted = field.dataType.simpleString()
    if kind == wanted or isinstance(field.dataType, T.StringType):
        return False
    return not (kind in _WHOLE and wanted in _WHOLE and _WHOLE.index(kind) < _WHOLE.index(wanted))


def _may_round(kind: str, field: T.StructField) -> bool:
    """Whether a value can be read only in part. Text is read in full or not at all, but for decimals."""
    return _may_lose(kind, field) and (kind != "string" or isinstance(field.dataType, T.DecimalType))


def _decimals(text: Column) -> Column:
    """Decimals that a number written out needs, the zeros at its end left out; an exponent moves its point."""
    fraction = F.regexp_extract(text, r"\.(\d*?)0*(?:[eE]|\s*$)", 1)
    zeros = F.regexp_extract(text, r"(0*)(?:\.0*)?(?:[eE]|\s*$)", 1)
    exponent = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?\d+)", 1).try_cast("int"), F.lit(0))
    return F.when(F.length(fraction) > 0, F.length(fraction)).otherwise(-F.length(zeros)) - exponent


def _changed(source: Column, kind: str, field: T.StructField) -> Column:
    """Whether a value that can be read comes out as another one."""
    value = read_as(source, kind, field)
    if kind != "string":  # the way back shows it
        return value.try_cast(kind) != source
    whole = source.try_cast(T.DecimalType(38, 18))
    # Beyond 18 decimals, and with an exponent, the digits themselves are looked at.
    unclear = (F.length(source) > 18) | source.contains("e") | source.contains("E")
    more = source.rlike("^[^eE]*[1-9]") & (_decimals(source) > field.dataType.scale)
    return value.isNotNull() & ((whole != value) | (unclear & more))


def flaws(df: DataFrame, schema: T.StructType = ORDER_LINE_SCHEMA) -> Column:
    """Names of what a raw line loses when it is typed; empty for a line read in full.

    Every pair of source and target type is tested, whatever types the raw lines have:
    unreadable_<column>: there is a value (of a text: more than blanks), but the field's type cannot hold it.
    not_exact_<column>: the type holds another value, rounded or cut: of text, an amount with
    more decimals than its type; of any other type, a value that the way back does not give again.
    """
    kinds = dict(df.dtypes)
    found = []
    for field in schema:
        source, kind = F.col(field.name), kinds[field.name]
        if not _may_lose(kind, field):
            continue
        there = F.trim(source) != "" if kind == "string" else source.isNotNull()
        found.append(F.when(there & read_as(source, kind, field).isNull(), F.lit(f"unreadable_{field.name}")))
        if _may_round(kind, field):
            found.append(F.when(_changed(source, kind, field), F.lit(f"not_exact_{field.name}")))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def flaw_names(df: DataFrame, schema: T.StructType = ORDER_LINE_SCHEMA) -> list[str]:
    """Names that flaws can give for lines of these types."""
    kinds = dict(df.dtypes)
    fields = [f for f in schema if _may_lose(kinds[f.name], f)]
    return [f"unreadable_{f.name}" for f in fields] + [
        f"not_exact_{f.name}" for f in fields if _may_round(kinds[f.name], f)
    ]


def trimmed(df: DataFrame, columns: Sequence[str] = BATCH_TEXT_COLUMNS) -> DataFrame:
    """Strip leading and trailing spaces of the text columns."""
    return df.withColumns({c: F.trim(c) for c in columns})


def whole_lines(df: DataFrame) -> DataFrame:
    """Lines that were read as records of the right width; all, where broken ones are not marked."""
    return df.where(F.col(BROKEN_RECORD).isNull()).drop(BROKEN_RECORD) if BROKEN_RECORD in df.columns else df


def prepared(df: DataFrame, profile: Profile = BATCH_V2) -> DataFrame:
    """Whole lines, typed and trimmed, before any row is judged."""
    return trimmed(typed(whole_lines(df)), profile.text_columns)


def reject_reason(profile: Profile) -> Column:
    """Name of the first rule a row breaks, null for a valid row."""
    return F.coalesce(*[
        F.when(~F.coalesce(F.expr(rule.keep), F.lit(False)), F.lit(rule.name))
        for rule in profile.rules
    ])


def valid(df: DataFrame, profile: Profile = BATCH_V2) -> DataFrame:
    """Rows that keep every rule of the profile."""
    for rule in profile.rules:
        df = df.where(rule.keep)
    return df


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def deduplicated(df: DataFrame, keys: Sequence[str] = DEDUP_KEY) -> DataFrame:
    """One row per key: the lowest row_id, so every run keeps the same one."""
    return unique_per_key(df, keys, {"row_id": "asc"})


def clean(df: DataFrame, profile: Profile = BATCH_V2) -> DataFrame:
    """The whole cleaning path.

    Invalid rows go before duplicates: otherwise an unusable copy could be the
    one that survives and take the valid line down with it.
    """
    rows = valid(prepared(df, profile), profile)
    return deduplicated(rows, profile.dedup_key) if profile.dedup_key else rows
