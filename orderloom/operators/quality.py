"""What cleaning found: violations, rejected rows, rows lost per step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.cleaning import flaw_names, flaws, prepared, read_as, reject_reason, trimmed, typed
from orderloom.schema import BATCH_V2, BROKEN_RECORD, DEDUP_KEY, ORDER_LINE_COLUMNS, ORDER_LINE_SCHEMA, Profile
from orderloom.sources.sizing import line_scan_bytes, sized_shuffles


def _broken(keep: str) -> Column:
    return ~F.coalesce(F.expr(keep), F.lit(False))


def _unpivoted(row: DataFrame, names: list[str]) -> DataFrame:
    return row.unpivot([], names, "rule", "violations").select(
        "rule", "violations", (F.col("violations") == 0).alias("passed")
    )


def _without_broken_values(raw: DataFrame) -> DataFrame:
    """Raw lines with a broken_record column, and no values where it says that a line is broken."""
    if BROKEN_RECORD not in raw.columns:
        return raw.withColumn(BROKEN_RECORD, F.lit(None).cast("string"))
    return raw.withColumns({c: F.when(F.col(BROKEN_RECORD).isNull(), F.col(c)) for c in ORDER_LINE_COLUMNS})


def _reason(profile: Profile) -> Column:
    """Name of the first thing wrong with a line: it is broken, or the first rule that it breaks."""
    return F.when(F.col(BROKEN_RECORD).isNotNull(), BROKEN_RECORD).otherwise(reject_reason(profile))


def rule_report(rows: DataFrame, profile: Profile = BATCH_V2) -> DataFrame:
    """One line per rule: how many of the rows break it, and whether it passed.

    Expects typed, trimmed rows, raw or already cleaned. Duplicates are rows
    beyond the first of their key. The rules are counted in one global aggregate,
    which shuffles one line per task; only bare keys are shuffled, for the duplicates.
    """
    names = [rule.name for rule in profile.rules]
    totals = rows.agg(
        *[F.count_if(_broken(rule.keep)).alias(rule.name) for rule in profile.rules],
        F.count_if(_key_known()).alias("keyed"),
    )
    surplus = (F.col("keyed") - _distinct_keys(rows.where(_key_known()))).alias("duplicate_key")
    return _unpivoted(totals.select(*names, surplus), names + ["duplicate_key"])


def _key_known() -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in DEDUP_KEY])


def _distinct_keys(rows: DataFrame) -> Column:
    """How many keys the rows have, counted at once, in as many parts as their size asks for; only keys are shuffled."""
    with sized_shuffles(rows.sparkSession, line_scan_bytes(rows)):
        return F.lit(rows.select(*DEDUP_KEY).distinct().count()).cast("long")


def validation_summary(report: DataFrame) -> DataFrame:
    """Checks passed out of checks made."""
    return report.agg(
        F.count_if("passed").alias("checks_passed"), F.count("*").alias("checks_made")
    )


def flaw_report(raw: DataFrame) -> DataFrame:
    """One line per way a value can get lost in typing: how many raw lines lose one so.

    Which ways there are depends on the types of the raw lines; lines that come typed as
    they are to be have none. Lines that a file's reader marked as broken have a line of
    their own and lose nothing else.
    """
    marked = BROKEN_RECORD in raw.columns
    names = flaw_names(raw) + [BROKEN_RECORD] * marked
    lines = _without_broken_values(raw)
    judged = lines.select(flaws(lines).alias("flaws"), BROKEN_RECORD)
    if not names:
        return judged.select(F.lit("").alias("rule"), F.lit(0).cast("long").alias("violations"), F.lit(True).alias("passed")).limit(0)
    lost = [F.count_if(F.array_contains("flaws", n)).alias(n) for n in flaw_names(raw)]
    return _unpivoted(judged.agg(*lost, *[F.count(BROKEN_RECORD).alias(BROKEN_RECORD)] * marked), names)


def full_report(raw: DataFrame, profile: Profile = BATCH_V2) -> DataFrame:
    """Rules and lost values of raw lines in one report."""
    return rule_report(prepared(raw, profile), profile).unionByName(flaw_report(raw))


def quarantine(df: DataFrame, profile: Profile = BATCH_V2) -> DataFrame:
    """Rows that break a rule, with the first one they break, and rows that lose a value.

    reject_reason is null for a row that stays in silver; flaws names what it lost there. Of a
    line that a file's reader marked as broken the text is kept in broken_record, and no value.
    No shuffle.
    """
    lines = _without_broken_values(df)
    marked = lines.withColumn("flaws", F.array_join(flaws(lines), ","))
    extra = [T.StructField(c, T.StringType()) for c in ("flaws", BROKEN_RECORD)]
    rows = trimmed(typed(marked, T.StructType(ORDER_LINE_SCHEMA.fields + extra)), profile.text_columns)
    found = rows.withColumn("reject_reason", _reason(profile)).where("reject_reason IS NOT NULL OR flaws <> ''")
    return found if BROKEN_RECORD in df.columns else found.drop(BROKEN_RECORD)


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return rows.groupBy(*DEDUP_KEY).agg(F.count("*").alias("copies")).where("copies > 1")


def _step_names(df: DataFrame, profile: Profile) -> list[str]:
    """The cleaning steps that judge a line by itself."""
    return [BROKEN_RECORD] * (BROKEN_RECORD in df.columns) + [rule.name for rule in profile.rules]


def step_counts(df: DataFrame, profile: Profile = BATCH_V2) -> DataFrame:
    """Rows before, removed by and after each cleaning step.

    Rules are counted in one global aggregate; only the keys of valid rows are shuffled.
    The rules are the first steps, in order; removing duplicates is the last. Where a file's
    reader marks broken lines, they go before all others.
    """
    names = _step_names(df, profile)
    lines = T.StructType(ORDER_LINE_SCHEMA.fields + [T.StructField(BROKEN_RECORD, T.StringType())])
    judged = trimmed(typed(_without_broken_values(df), lines), profile.text_columns).withColumn("reason", _reason(profile))
    counted = judged.agg(
        F.count_if(F.col("reason").isNull()).alias("valid_rows"),
        *[F.count_if(F.col("reason") == n).alias(n) for n in names],
    )
    unique = _distinct_keys(judged.where("reason IS NULL"))
    totals = counted.withColumn("unique_rows", unique)
    removed = [F.col(n) for n in names] + [F.col("valid_rows") - F.col("unique_rows")]
    rows_in = reduce(lambda a, b: a + b, [F.col(n) for n in names], F.col("valid_rows"))
    steps = []
    for number, (name, gone) in enumerate(zip(names + ["duplicate_key"], removed), start=1):
        steps.append(F.struct(
            F.lit(number).alias("step_number"),
            F.lit(name).alias("step"),
            rows_in.alias("rows_before"),
            gone.alias("rows_removed"),
            (rows_in - gone).alias("rows_after"),
        ))
        rows_in = rows_in - gone
    return totals.select(F.inline(F.array(*steps)))


def with_observed(raw: DataFrame, observation: Observation, profile: Profile = BATCH_V2) -> DataFrame:
    """raw, counted while it is written: what step_counts and flaw_report would read it again for.

    The observation then has raw_rows, a count per cleaning step that judges a line by itself,
    and one per way to lose a value; observed_steps and observed_flaws put them in order. An
    input without rows may give none.
    """
    kept = {c: f"_raw_{c}" for c in raw.columns}
    lines = _without_broken_values(raw.withColumns({k: F.col(c) for c, k in kept.items()}))
    kinds = dict(lines.dtypes)
    values = {f.name: read_as(F.col(f.name), kinds[f.name], f) for f in ORDER_LINE_SCHEMA}
    judged = trimmed(lines.withColumn("_flaws", flaws(lines)).withColumns(values), profile.text_columns)
    counts = [F.count("*").alias("raw_rows")]
    counts += [F.count_if(F.col("_reason") == n).alias(n) for n in _step_names(raw, profile)]
    counts += [F.count_if(F.array_contains("_flaws", n)).alias(n) for n in flaw_names(raw)]
    observed = judged.withColumn("_reason", _reason(profile)).observe(observation, *counts)
    return observed.select(*[F.col(k).alias(c) for c, k in kept.items()])


def observed_steps(observed: dict[str, int], unique_rows: int, raw: DataFrame, profile: Profile = BATCH_V2) -> list[dict]:
    """The rows of step_counts from what was observed and the number of rows that silver has."""
    rows, steps = observed.get("raw_rows", 0), []
    for name in [*_step_names(raw, profile), "duplicate_key"]:
        gone = rows - unique_rows if name == "duplicate_key" else observed.get(name, 0)
        steps.append({"step_number": len(steps) + 1, "step": name, "rows_before": rows, "rows_removed": gone, "rows_after": rows - gone})
        rows -= gone
    return steps


def observed_flaws(observed: dict[str, int], raw: DataFrame) -> dict[str, int]:
    """How many raw lines lose a value, by way, from what was observed."""
    return {name: observed.get(name, 0) for name in flaw_names(raw)}
