"""Looking up members of a dimension, with hot keys spread over all tasks."""

from __future__ import annotations

from collections.abc import Sequence
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.packing import Packing
from orderloom.sources.sizing import PARTITIONS_SETTING, UNKNOWN_BYTES, fits_broadcast, scan_bytes

# Most keys looked at as hot ones, and counters of the sketch that finds them per key looked for.
MOST_HOT_KEYS = 10_000
COUNTERS_PER_KEY = 16

# Parts that a partition's share of a hot key's rows is dealt into: several land in one by chance.
PARTS_PER_PARTITION = 16

# Bytes of files of one dimension that a task holds as a hash table where several are looked up together.
SLICE_BYTES = 12 * 1024 * 1024

# Partitions that lines are sorted in, of which one is enough where they only pass a hash table.
PARTITIONS_PER_CELL = 8

_HOT, _PARTS, _SALT, _CELL = "_hot_key", "_hot_parts", "_hot_salt", "_cell"


def digest_of(columns: Sequence[Column]) -> Column:
    return F.xxhash64(*columns)


def hot_keys(rows: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Digests of keys with more than half a partition's share of the rows, and parts for their rows.

    A sketch of frequent items is kept per task and merged, so nothing is shuffled by key. It has
    16 counters per key looked for: what it misses or overrates by is a fraction of the bound.
    There are at most two such keys per partition, and never more than MOST_HOT_KEYS are spread.
    """
    many = min(2 * partitions, MOST_HOT_KEYS)
    counters = 1 << (COUNTERS_PER_KEY * many - 1).bit_length()
    digest = digest_of([F.col(k) for k in keys]).alias("digest")
    found = rows.select(digest).agg(
        F.expr(f"approx_top_k(digest, {many}, {min(counters, 1_000_000)})").alias("top"), F.count("*").alias("rows")
    )
    share = F.col("rows") / partitions
    return found.select("rows", F.inline("top")).where(F.col("count") > share / 2).select(
        F.col("item").alias(_HOT), F.ceil(PARTS_PER_PARTITION * F.col("count") / share).cast("int").alias(_PARTS)
    )


def looked_up(
    lines: DataFrame,
    members: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    partitions: int | None = None,
    among: DataFrame | None = None,
) -> DataFrame:
    """lines with the columns of members, one row per key: a left join that a hot key cannot hold up.

    Members whose files are small are broadcast. Otherwise both sides are shuffled; the rows of a
    key that alone would fill half a partition or more are dealt over several, and only the
    members concerned are repeated for it. Rows without a key have no member and are dealt over
    all partitions as well. With null_safe a null key part equals a null. partitions is how many
    a shuffle makes, if the session's setting is not enough (without null_safe only). Hot keys are
    looked for in among: rows with the keys of lines, where lines are dear to make.
    """
    named = [f"_member_{k}" for k in keys]
    right = members.withColumnsRenamed(dict(zip(keys, named)))
    equal = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    conf = lines.sparkSession.conf
    if fits_broadcast(members):
        # A session that has broadcasts switched off gets none; adaptive execution then splits hot keys.
        off = conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
        small = right if off else F.broadcast(right)
        return lines.join(small, [equal(F.col(a), F.col(b)) for a, b in zip(keys, named)], "left").drop(*named)
    own = partitions is not None and not null_safe
    partitions = partitions if own else int(conf.get(PARTITIONS_SETTING))
    hot = hot_keys(lines if among is None else among, keys, partitions)
    row = F.xxhash64(F.monotonically_increasing_id())  # mixed: rows of a key may come at regular places
    parts = F.when(F.col(_PARTS).isNotNull(), F.pmod(row, F.col(_PARTS))).otherwise(0).cast("int")
    left = lines.withColumn(_HOT, digest_of([F.col(k) for k in keys])).join(F.broadcast(hot), _HOT, "left")
    right = right.withColumn(_HOT, digest_of([F.col(k) for k in named])).join(F.broadcast(hot), _HOT, "left")
    right = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_PARTS, F.lit(1)) - 1)))
    conditions = [equal(F.col(f"l.{a}"), F.col(f"r.{b}")) for a, b in zip(keys, named)]
    spread, right = left.withColumn(_SALT, parts).drop(_HOT, _PARTS), right.drop(_HOT, _PARTS)
    if own:
        spread, right = spread.repartition(partitions, *keys, _SALT), right.repartition(partitions, *named, _SALT)
    met = spread.alias("l").join(right.alias("r"), [*conditions, F.col(f"l.{_SALT}") == F.col(f"r.{_SALT}")], "left")
    return met.select("l.*", *[F.col(f"r.{c}") for c in members.columns if c not in keys]).drop(_SALT)


def slices_together(lines: DataFrame, dimensions: Sequence[tuple[DataFrame, str]], partitions: int) -> list[int] | None:
    """Slices of each large dimension for looked_up_together; None where lookups one after the other move less.

    A slice is small enough for a hash table, and there are cells enough for the lines. Each slice
    is sent to every cell of the other dimensions' slices; as long as that is less than the lines'
    own files, it is less than one more shuffle of the lines.
    """
    sizes = [scan_bytes(members) for members, _ in dimensions]
    if len(sizes) < 2 or max(sizes) >= UNKNOWN_BYTES or min(sizes) <= SLICE_BYTES:
        return None
    if any(lines.schema[key].dataType != members.schema[key].dataType for members, key in dimensions):
        return None  # digests of two types differ
    slices = [-(-size // SLICE_BYTES) for size in sizes]
    while PARTITIONS_PER_CELL * prod(slices) < partitions:
        slices[max(range(len(sizes)), key=lambda i: sizes[i] / slices[i])] += 1
    sent = sum(size * prod(slices) // own for size, own in zip(sizes, slices))
    return slices if sent <= scan_bytes(lines) else None


def looked_up_together(
    lines: DataFrame, dimensions: Sequence[tuple[DataFrame, str]], slices: Sequence[int], packing: Packing
) -> DataFrame:
    """lines with the columns of several large dimensions, shuffled once: left joins by one key each.

    Every dimension is dealt into slices by its key, and a line goes to the cell of its slices;
    a slice goes to all cells it is part of, as a hash table that the lines pass unsorted. A line whose
    key is hot, or missing, goes to any slice; the members of hot keys are in all of them. Hot keys
    are looked for at once, as both sides have to know the same ones. Lines are moved in the form
    of packing, members with their texts as one.
    """
    cells = prod(slices)
    row = F.monotonically_increasing_id()
    cell = F.lit(0).cast("long")
    tables, packings = [], [packing]
    for place, ((members, key), own) in enumerate(zip(dimensions, slices)):
        hot = [r[_HOT] for r in hot_keys(lines, [key], cells).collect()]
        stride = prod(slices[place + 1:])
        digest = digest_of([F.col(key)])
        anywhere = digest.isin(hot) | F.col(key).isNull()
        by_key = F.pmod(digest, F.lit(own))
        cell = cell + F.when(anywhere, F.pmod(F.xxhash64(row, F.lit(place)), F.lit(own))).otherwise(by_key) * stride
        # The cells of this dimension's slice 0, one per combination of the other slices.
        first = [F.lit(c) for c in range(cells) if c // stride % own == 0]
        every = F.when(digest.isin(hot), F.sequence(F.lit(0), F.lit(own - 1))).otherwise(F.array(by_key.cast("int")))
        named = {c: f"_{place}_{c}" for c in members.columns}
        table = members.where(F.col(key).isNotNull()).withColumn(_SALT, every).withColumnsRenamed(named)
        texts = [c for c, kind in table.dtypes if kind == "string" and c != named[key]]
        packings.append(Packing(table, {}, texts, label=f"member_{place}"))
        table = packings[-1].packed(table).withColumn(_SALT, F.explode(_SALT))
        table = table.withColumn("_first", F.explode(F.array(*first)))
        table = table.withColumn(f"{_CELL}_{place}", (F.col("_first") + F.col(_SALT) * stride).cast("int"))
        tables.append(table.drop("_first", _SALT))
    met = packing.packed(lines.withColumn(_CELL, cell.cast("int"))).repartitionById(cells, F.col(_CELL))
    found = []
    for place, ((members, key), table) in enumerate(zip(dimensions, tables)):
        theirs = f"{_CELL}_{place}"
        same = (F.col(key) == F.col(f"_{place}_{key}")) & (F.col(_CELL) == F.col(theirs))
        met = met.join(table.repartitionById(cells, F.col(theirs)).hint("shuffle_hash"), same, "left")
        found += [F.col(f"_{place}_{c}").alias(c) for c in members.columns if c != key]
    for each in packings:
        met = each.unpacked(met)
    return met.select(*lines.columns, *found)
