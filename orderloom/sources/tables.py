"""Reading, writing and replacing tables stored as Parquet."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderloom.sources.folders import file_exists, folder_names, remove_folder


def use_database(spark: SparkSession, database: str) -> None:
    """Create the database if needed and make it the current one."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    spark.catalog.setCurrentDatabase(database)


def quoted(name: str) -> str:
    """A dotted table name with every part in backticks (hyphens are legal then)."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(quoted(name))


def scan_if_exists(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None where there is none; any other error still shows."""
    return scan(spark, name) if spark.catalog.tableExists(quoted(name)) else None


def create_empty(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty typed table unless it is there already."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({schema.toDDL()}) USING PARQUET")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def overwrite(df: DataFrame, name: str) -> None:
    """Replace a managed table's rows and schema (not one the frame itself reads)."""
    df.write.format("parquet").mode("overwrite").saveAsTable(quoted(name))


def write_files(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str | None = None) -> None:
    """Write a frame to a new folder.

    With partition columns the rows are first rebalanced on them: without it
    every task would open a file in every partition, and the rebalance splits a
    partition value too large for one task. compression: the codec, if not the session's.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).mode("errorifexists").parquet(path, compression=compression)


SCHEMA_LOG = "_schemas"


def logged_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of all files appended to a folder, from its schema log; None without one."""
    versions = sorted(folder_names(spark, f"{path.rstrip('/')}/{SCHEMA_LOG}/version=*/_SUCCESS"))
    if not versions:
        return None
    text = spark.read.text(versions[-1].removesuffix("/_SUCCESS"), wholetext=True).first()
    return T.StructType.fromJson(json.loads(text.value))


def merged_schema(known: T.StructType, new: T.StructType) -> T.StructType:
    """known and the columns of new that it lacks; a column of another type is refused.

    Names are compared as Spark does, without case.
    """
    fields = {f.name.lower(): f for f in known}
    for field in new:
        before = fields.setdefault(field.name.lower(), T.StructField(field.name, field.dataType))
        if before.dataType != field.dataType:
            raise ValueError(
                f"column {field.name} comes as {field.dataType.simpleString()}, the files have {before.dataType.simpleString()}"
            )
    return T.StructType(list(fields.values()))


def append_files(df: DataFrame, path: str) -> None:
    """Append to a folder; new columns are welcome, a column of another type is not (ValueError).

    The union of all columns is kept as a small versioned file beside the data, so that neither
    the next append nor a read has to open every file for it. A folder without one, which was
    written otherwise, is looked through once. Of two appends that add a column at the same
    time, the one that comes second to the log fails before it writes data.
    """
    spark, folder = df.sparkSession, path.rstrip("/")
    known = logged_schema(spark, folder)
    missing = known is None
    if missing:
        there = bool(folder_names(spark, f"{folder}/*.parquet"))
        known = spark.read.option("mergeSchema", True).parquet(folder).schema if there else T.StructType()
    schema = merged_schema(T.StructType([T.StructField(f.name, f.dataType) for f in known]), df.schema)
    if missing or len(schema) > len(known):
        number = len(folder_names(spark, f"{folder}/{SCHEMA_LOG}/version=*")) + 1
        line = spark.createDataFrame([(json.dumps(schema.jsonValue()),)], "value string")
        line.coalesce(1).write.mode("errorifexists").text(f"{folder}/{SCHEMA_LOG}/version={number:06d}")
    df.write.mode("append").parquet(folder)


def scan_files(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Read a folder; with merge_schema, files of differing width line up by name.

    The columns come from the schema log where there is one, and no file is opened for them.
    """
    known = logged_schema(spark, path) if merge_schema else None
    if known is not None:
        return spark.read.schema(known).parquet(path)
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def point_table_at(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
    root: str | None = None,
) -> None:
    """Make a table show the files under path, which are complete by then.

    An external table of the same shape is switched in one step. Any other is switched as
    switch_tables does it; files of external tables stay in either case.
    """
    schema = schema or spark.read.parquet(path).schema
    if not partition_by and _is_external_with(spark, name, schema):
        spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{path}'")
        spark.catalog.refreshTable(quoted(name))
    else:
        switch_tables(spark, [Switch(name, path, schema, partition_by)], root)


class Switch(NamedTuple):
    """A table and the written files it is to show."""

    name: str
    path: str
    schema: T.StructType
    partition_by: Sequence[str] = ()


JOURNAL_FOLDER = "_switches"
JOURNAL_SCHEMA = "name string, path string, had_one boolean"


def _staged(name: str) -> str:
    return f"{name}__next"


def _aside(name: str) -> str:
    return f"{name}__before"


def _exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(quoted(name))


def switch_tables(spark: SparkSession, switches: Sequence[Switch], root: str | None = None) -> None:
    """Point several tables at new files, all or none.

    All are first built under second names, where most can go wrong. Then a journal with every
    name and its new files is written under root, and each table is renamed into place and the
    one it replaces kept aside. An error or interrupt undoes the renames done so far. A run that
    is killed leaves the journal, and recover_switches settles it; without a root there is none.
    A name is missing only between two renames. The old tables go at the end; files of external
    tables stay.
    """
    for new in switches:
        layout = f"PARTITIONED BY ({', '.join(new.partition_by)})" if new.partition_by else ""
        drop(spark, _staged(new.name))
        spark.sql(
            f"CREATE TABLE {quoted(_staged(new.name))} ({new.schema.toDDL()}) USING PARQUET {layout} LOCATION '{new.path}'"
        )
        if new.partition_by:
            spark.catalog.recoverPartitions(quoted(_staged(new.name)))
        drop(spark, _aside(new.name))
    entries = [(new.name, new.path, _exists(spark, new.name)) for new in switches]
    journal = f"{root.rstrip('/')}/{JOURNAL_FOLDER}/{uuid.uuid4().hex}" if root else None
    if journal:
        write_files(spark.createDataFrame(entries, JOURNAL_SCHEMA).coalesce(1), journal)
    try:
        for name, _, had_one in entries:
            if had_one:
                rename(spark, name, _aside(name))
            rename(spark, _staged(name), name)
    except BaseException:
        _settle(spark, entries)
        if journal:
            remove_folder(spark, journal)
        raise
    _settle(spark, entries)
    if journal:
        remove_folder(spark, journal)


def recover_switches(spark: SparkSession, root: str) -> int:
    """Settle the switches that a killed run has left under root; returns how many there were.

    To be called at the start of a run, before any table is read; one run at a time may switch
    tables under a root. A switch that had reached its last table is finished, any other is undone.
    """
    journals = folder_names(spark, f"{root.rstrip('/')}/{JOURNAL_FOLDER}/*")
    for journal in journals:
        if file_exists(spark, f"{journal}/_SUCCESS"):  # else no table had been touched
            _settle(spark, [tuple(r) for r in spark.read.schema(JOURNAL_SCHEMA).parquet(journal).collect()])
        remove_folder(spark, journal)
    return len(journals)


def _settle(spark: SparkSession, entries: Sequence[tuple[str, str, bool]]) -> None:
    """Finish a switch if every table is in place, or undo it; can itself be cut short and repeated.

    A staged table is renamed last of all, so while one is left the switch has not ended; undoing
    drops the staged tables at its very end.
    """
    if not any(_exists(spark, _staged(name)) for name, _, _ in entries):
        for name, _, _ in entries:
            drop(spark, _aside(name))
            if _exists(spark, name):
                spark.catalog.refreshTable(quoted(name))
        return
    for name, path, had_one in entries:
        if _exists(spark, _aside(name)):
            drop(spark, name)
            rename(spark, _aside(name), name)
        elif not had_one and _exists(spark, name):
            drop(spark, name)
        if _exists(spark, name):
            spark.catalog.refreshTable(quoted(name))
    for name, _, _ in entries:
        drop(spark, _staged(name))


def rename(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(to)}")


def _is_external_with(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    current = scan_if_exists(spark, name)
    if current is None or spark.catalog.getTable(quoted(name)).tableType != "EXTERNAL":
        return False
    return [(f.name, f.dataType) for f in current.schema] == [(f.name, f.dataType) for f in schema]


def replace_table(df: DataFrame, name: str, root: str) -> None:
    """Replace a table, also from a query that reads that same table."""
    recover_switches(df.sparkSession, root)
    path = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    write_files(df, path)
    point_table_at(df.sparkSession, name, path, df.schema, root=root)
