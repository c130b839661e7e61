"""What the operators share: reading tables, columns made batch by batch, tables between steps."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.sources.folders import new_folder, remove_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Batch = pa.RecordBatch
Step = Callable[[Batch], list[pa.Array]]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """df without columns of these names, as Spark compares names (case does not count)."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


# Bytes of a batch that an operator works on at a time; a single longer row goes alone.
SLICE_BYTES = 8 << 20


def slices(batches: Iterator[Batch], most_bytes: int = SLICE_BYTES) -> Iterator[Batch]:
    """The batches in slices of bounded size, so that long texts do not add up in a task."""
    for batch in batches:
        step = max(1, batch.num_rows // (batch.nbytes // most_bytes + 1))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            if part.num_rows > 1 and part.nbytes > 2 * most_bytes:
                yield from slices(iter([part]), most_bytes)
            else:
                yield part


def give_back() -> None:
    """Returns memory that is free inside this Python process to the system.

    Spark keeps its Python processes between tasks, and the allocators keep what a task
    has freed; over several stages of one job that would add up beside the JVM.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def add_columns(
    df: DataFrame, make: Callable[[], Step], added: str, drop: Iterable[str] = (), slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """df with columns computed from each Arrow batch; nothing is shuffled.

    make() runs once per task and returns the function from a batch to the added
    columns, so what it builds (tables, caches) lives as long as the task. Columns
    of df that are named like an added one give way to it.
    """
    fields = T._parse_datatype_string(added).fields
    names = {f.name.lower() for f in fields} | {d.lower() for d in drop}
    kept = [i for i, c in enumerate(df.columns) if c.lower() not in names]
    schema = T.StructType([df.schema.fields[i] for i in kept] + fields)

    def run(batches: Iterator[Batch]) -> Iterator[Batch]:
        step = make()
        for batch in slices(batches, slice_bytes):
            columns = [batch.column(i) for i in kept] + step(batch)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        del step
        give_back()

    return df.mapInArrow(run, schema)


def to_rows(
    df: DataFrame, make: Callable[[], Callable[[Iterator[Batch]], Iterator[dict]]], schema: str, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Rows of another shape and number: make() returns a function from a task's batches to column dicts."""
    shape = T._parse_datatype_string(schema)

    def run(batches: Iterator[Batch]) -> Iterator[Batch]:
        for columns in make()(slices(batches, slice_bytes)):
            yield pa.RecordBatch.from_arrays([columns[n] for n in shape.names], names=shape.names)
        give_back()

    return df.mapInArrow(run, shape)


def texts_of(batch: Batch, column: str, null: str | None = "") -> list[str | None]:
    """The texts of a batch, nulls replaced."""
    values = batch.column(column).to_pylist()
    return values if null is None else [null if v is None else v for v in values]


def written(df: DataFrame, label: str) -> DataFrame:
    """df written to a fresh folder that all executors share, and read back.

    It cuts the lineage, and a lost executor costs only its running tasks.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables written on the way to a result, removed once what reads them is written too."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def written(self, df: DataFrame, label: str) -> DataFrame:
        """As the function of that name."""
        path = new_folder(self.spark, label)
        df.write.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(found)] = (found, path)
        return found

    def remove(self, *tables: DataFrame) -> None:
        for table in tables:
            remove_folder(self.spark, self.paths.pop(id(table))[1])
