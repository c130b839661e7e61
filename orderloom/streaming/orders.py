"""Newly arrived orders: incremental cleaning and live totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators.cleaning import clean
from orderloom.operators.measures import category_region_totals
from orderloom.schema import (
    CLEAN_STREAM_SCHEMA,
    LIVE_TOTALS_SCHEMA,
    ORDER_LINE_SCHEMA,
    STREAM,
)
from orderloom.sources.folders import folder_names, remove_folder
from orderloom.sources.tables import point_table_at, quoted, recover_switches, replace_table

DATA_SOURCE = "streaming"

# Folders of live totals that stay: the newest, and one a reader may have open.
KEPT_TOTALS = 2


def arriving_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType = ORDER_LINE_SCHEMA,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Order lines from a folder that keeps receiving Parquet files.

    The schema is declared, never inferred; files_per_batch bounds how much one
    micro-batch takes on when a backlog is worked off.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def arriving_table(spark: SparkSession, name: str) -> DataFrame:
    """Order lines appended to a table."""
    return spark.readStream.table(quoted(name))


def cleaned_stream(lines: DataFrame, data_source: str = DATA_SOURCE) -> DataFrame:
    """The cleaning path under the stream's rules, stamped with time and feed.

    Works the same on a batch frame.
    """
    return clean(lines, STREAM).withColumns({
        "processed_at": F.current_timestamp(),
        "data_source": F.lit(data_source),
    })


def append_available(clean_lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Clean what has arrived since the last run, append it, and stop.

    The checkpoint and the sink's own log make each file count once, also when
    a run is killed and started again.
    """
    return (
        clean_lines.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_available_to_table(clean_lines: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """append_available into a catalog table."""
    return (
        clean_lines.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(quoted(name))
    )


def with_last_updated(totals: DataFrame) -> DataFrame:
    return totals.withColumn("last_updated", F.current_timestamp())


def recomputed_totals(clean_lines: DataFrame) -> DataFrame:
    """Live totals from everything cleaned so far (batch), in order."""
    return with_last_updated(category_region_totals(clean_lines)).orderBy("category", "region")


def publish_totals(clean_lines: DataFrame, name: str, root: str) -> None:
    """Recompute the live totals and replace their table."""
    replace_table(recomputed_totals(clean_lines), name, root)


def running_totals(
    spark: SparkSession,
    clean_path: str,
    totals_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    table: str | None = None,
) -> StreamingQuery:
    """Live totals kept up to date from new rows only.

    State is one row per category and region. Each micro-batch writes the full
    totals into a folder of its own, so a repeated batch replaces only itself
    and readers keep the folder they opened; a table, if named, is then pointed
    at it. Folders older than the last KEPT_TOTALS are removed.
    """
    recover_switches(spark, totals_path)
    lines = arriving_lines(spark, clean_path, CLEAN_STREAM_SCHEMA, files_per_batch)

    def publish(totals: DataFrame, batch: int) -> None:
        path = totals_folder(totals_path, batch)
        with_last_updated(totals).repartition(1).write.mode("overwrite").parquet(path)
        if table:
            point_table_at(spark, table, path, LIVE_TOTALS_SCHEMA, root=totals_path)
        for old in totals_batches(spark, totals_path):
            if old <= batch - KEPT_TOTALS:
                remove_folder(spark, totals_folder(totals_path, old))

    return (
        category_region_totals(lines)
        .writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def totals_folder(totals_path: str, batch: int) -> str:
    return f"{totals_path.rstrip('/')}/batch={batch}"


def totals_batches(spark: SparkSession, totals_path: str) -> list[int]:
    """Numbers of the micro-batches whose totals are complete, from folder names alone."""
    names = folder_names(spark, f"{totals_path.rstrip('/')}/batch=*/_SUCCESS")
    return sorted(int(n.split("batch=")[1].split("/")[0]) for n in names)


def latest_totals(spark: SparkSession, totals_path: str) -> DataFrame:
    """The totals as of the newest complete micro-batch; opens that one's files only.

    Before the first one there are no rows.
    """
    batches = totals_batches(spark, totals_path)
    if not batches:
        return spark.createDataFrame([], LIVE_TOTALS_SCHEMA)
    return spark.read.schema(LIVE_TOTALS_SCHEMA).parquet(totals_folder(totals_path, batches[-1]))
