"""What the size of an input decides: shuffle partitions and broadcasts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS_SETTING = "spark.sql.shuffle.partitions"

SPLIT_SETTING = "spark.sql.files.maxPartitionBytes"

BROADCAST_SETTING = "spark.sql.autoBroadcastJoinThreshold"

# Parquet grows two- to threefold in a shuffle: 64 MB read are some 150 MB sorted.
BYTES_PER_PARTITION = 64 * 1024 * 1024

# Order lines, most of whose columns are dictionaries in Parquet, grow four times as much again:
# 16 MB of them are a million rows. A task's share has to fit in its memory, or it is spilled.
LINE_GROWTH = 4

# Bytes of files that one task reads at most, where a file can be split: its aggregates and
# sorts before the shuffle have to fit as well.
SPLIT_BYTES = 64 * 1024 * 1024

# An estimate beyond this many partitions' worth is one of a plan too complex to judge.
MOST_PARTITIONS = 2_000

# Largest dimension, in bytes of the files read for it, that is sent to every
# executor whole.
BROADCAST_BYTES = 32 * 1024 * 1024


UNKNOWN_BYTES = 1 << 62


def scan_bytes(scan: DataFrame) -> int:
    """Bytes of the files a plain scan reads, as Spark's own statistics have it.

    A session without access to them (Spark Connect) knows no size: then nothing counts
    as small and the session's own settings hold.
    """
    if not hasattr(scan, "_jdf"):
        return UNKNOWN_BYTES
    return int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(table: DataFrame, limit: int | None = None) -> bool:
    """Whether a table is small enough to broadcast; a plan too complex to judge is not."""
    return scan_bytes(table) <= (BROADCAST_BYTES if limit is None else limit)


def line_scan_bytes(scan: DataFrame) -> int:
    """What a scan of order lines counts as when its shuffles are sized."""
    return sized_lines(scan_bytes(scan))


def sized_lines(files_bytes: int) -> int:
    """Bytes of files of order lines as sized_shuffles is to take them."""
    if files_bytes >= UNKNOWN_BYTES:
        return files_bytes
    return min(LINE_GROWTH * files_bytes, MOST_PARTITIONS * BYTES_PER_PARTITION)


def hinted(table: DataFrame) -> DataFrame:
    """The table, marked for a broadcast if it is small but too large for Spark to do so by itself."""
    return F.broadcast(table) if broadcasts(table) and not broadcast_by_itself(table) else table


def broadcasts(table: DataFrame) -> bool:
    """Whether a hinted table is broadcast: a small one, unless the session has broadcasts switched off."""
    return fits_broadcast(table) and not table.sparkSession.conf.get(BROADCAST_SETTING).startswith("-")


def broadcast_by_itself(table: DataFrame) -> bool:
    """Whether Spark broadcasts a plain scan without being told to, by the session's own limit."""
    own = table.sparkSession.conf.get(BROADCAST_SETTING)
    return not own.startswith("-") and scan_bytes(table) <= _bytes(own)


def partitions_for(input_bytes: int, at_least: int) -> int:
    if input_bytes >= UNKNOWN_BYTES:
        return at_least
    needed = -(-input_bytes // BYTES_PER_PARTITION)
    return max(at_least, needed)


_UNITS = {unit: 1 << 10 * place for place, unit in enumerate("bkmgtp")}


def _bytes(setting: str) -> int:
    """A size as Spark's settings write it: '134217728b', '128MB', '16m'."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", setting.strip().lower()).groups()
    return int(number) * _UNITS[unit[:1] or "b"]


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Within the block, shuffles and scans are split finely enough for so much input.

    The session's number of partitions is the least; adaptive execution merges what turns
    out small. Its size of a scan's part is the most.
    """
    before = {s: spark.conf.get(s) for s in (PARTITIONS_SETTING, SPLIT_SETTING)}
    spark.conf.set(PARTITIONS_SETTING, partitions_for(input_bytes, int(before[PARTITIONS_SETTING])))
    spark.conf.set(SPLIT_SETTING, f"{min(_bytes(before[SPLIT_SETTING]), SPLIT_BYTES)}b")
    try:
        yield
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)
