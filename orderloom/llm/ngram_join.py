"""Near duplicates by exact Jaccard similarity of word shingles.

Size-banded tiles with bitmap signatures:

1.  A document is the set of its shingles, as 64-bit hashes. Equal sets are one node.
2.  All shingles have one order, frequent ones last, then by hash. Two sets that are
    similar enough share one of the first n - ceil(t * n) + 1 shingles of each, and
    their sizes differ by at most the factor t. So a tile is a size band and one such
    shingle, and every link is between two nodes of a tile. The order only decides how
    much work there is, never the result, so frequencies may be estimates.
3.  In each tile every node is paired with the least one. A pair's bitmaps bound its
    overlap from above; what they leave is settled by intersecting the sorted sets.
    Components of these links join most nodes of most tiles.
4.  Tiles that still hold nodes of different components are worked off in groups, by blocks of
    bounded size. By bitmaps alone a first task tells which nodes may still have a link to
    another component; only their sets are sent to the second task of the group. That one
    bounds pairs by bitmaps, settles them by intersecting the sorted sets and joins nodes as it
    goes: pairs that are joined already are passed over, first those with the least nodes of
    a tile, so that a large group of near copies takes few of them. It emits the links that
    joined something, a tree: never more rows than the group has nodes.

Nothing is capped: a tile of any size is worked off, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.components import components
from orderloom.llm.rows import Scratch, to_rows, written

WORDS_PER_SHINGLE = 5
SIMILARITY = 75  # percent

# A bitmap grows with its set, so that it bounds large ones as well.
LEAST_BITS = 512
BITS_PER_SHINGLE = 2
BAND_BASE = 4

# Slots of the frequency estimate: a byte each, sent to every task; the size is fixed.
FREQUENCY_SLOTS = 1 << 22
# A slot is noted by a task if so many more of its documents hold it than four times the mean.
NOTED = 2

# A batch sends all nodes of a tile on, unless it has more of them than this.
SENT_PER_TILE = 64

# Most bits (16 MB) of a filter that keeps rows without a partner out of a shuffle.
FILTER_BITS = 1 << 27

# Nodes of a block of a large tile, and shingles (8 bytes each) of its sets.
BLOCK = 2_000
BLOCK_SHINGLES = 2_000_000

# Least nodes of a tile that its other nodes are compared with before all pairs are.
REPRESENTATIVES = 8

# Shingles whose tiles one task sorts at a time.
ENTRIES_PER_PARTITION = 1_000_000
# Bytes of signatures whose tiles a task holds at a time: a shingle of the prefix is 6 bytes
# there and some 60 while its tile is sought.
SIGNATURE_BYTES = 2 << 20

# Bytes of a text hashed at a time; each takes some 40 bytes of working memory.
CHUNK_BYTES = 1 << 20

# Odd multipliers. Fixed values.
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order."""
    values = np.sort(values)
    first = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


# Bytes of white space, and A-Z as a-z.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256)
_FOLD[ord("A") : ord("Z") + 1] += 32
# A 64-bit number per byte, the same for both cases; white space is worth nothing.
_BYTE_VALUES = np.where(_SPACE, np.uint64(0), mixed(_FOLD.astype(np.uint64) + _FACTORS[2]))


class Shingler:
    def __init__(self, size: int = WORDS_PER_SHINGLE):
        self.size = size
        self.factors = mixed(np.arange(1, size + 1, dtype=np.uint64) * _FACTORS[0]) | np.uint64(1)
        self.up = self.down = np.zeros(0, np.uint64)

    def _words(self, raw: np.ndarray) -> np.ndarray:
        """A hash of each word of a text: the sum of its bytes' numbers times powers of an odd factor, mixed."""
        outside = np.ones(len(raw) + 2, bool)
        outside[1:-1] = _SPACE[raw]
        change = np.flatnonzero(outside[1:] != outside[:-1])
        starts, ends = change[::2], change[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64)
        hashes, first = [], 0
        while first < len(starts):  # whole words of some bytes at a time
            last = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK_BYTES)))
            origin, end = int(starts[first]), int(ends[last - 1])
            up, down = self._powers(end - origin)
            sums = np.zeros(end - origin + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[raw[origin:end]] * up, out=sums[1:])
            at = starts[first:last] - origin
            hashes.append((sums[ends[first:last] - origin] - sums[at]) * down[at])
            first = last
        return mixed(hashes[0] if len(hashes) == 1 else np.concatenate(hashes))

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first n powers of an odd factor and of its inverse modulo 2^64."""
        if n > len(self.up):
            inverse = np.uint64(pow(int(_FACTORS[3]), -1, 1 << 64))
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, f)])) for f in (_FACTORS[3], inverse)
            )
        return self.up[:n], self.down[:n]

    def __call__(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingles of a text; one for fewer words, none without words."""
        h = self._words(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)) if text else ()
        if not len(h):
            return np.zeros(0, np.uint64)
        size = min(self.size, len(h))
        n = len(h) - size + 1
        total = np.full(n, np.uint64(size))
        for o in range(size):
            total += h[o : o + n] * self.factors[o]
        return distinct(mixed(total))


def digest(shingles: np.ndarray) -> int:
    """The node of a set, as a signed 64-bit number."""
    value = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return value - (1 << 64) if value >> 63 else value


def prefix_length(n: int, similarity: int) -> int:
    return n - -(-similarity * n // 100) + 1


def bands(n: int, similarity: int) -> list[int]:
    """The band of a size, and the next one if a similar set can lie there."""
    band, bound = 0, BAND_BASE
    while n >= bound:
        band, bound = band + 1, bound * BAND_BASE
    return [band, band + 1] if 100 * n >= similarity * bound else [band]


def bitmap(shingles: np.ndarray) -> bytes:
    """A bit per shingle, by its hash; the larger the set, the more bits."""
    bits = LEAST_BITS
    while bits < BITS_PER_SHINGLE * len(shingles):
        bits *= 2
    marks = np.zeros(bits, np.uint8)
    marks[(shingles >> np.uint64(10)) & np.uint64(bits - 1)] = 1
    return np.packbits(marks).tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap made as small as another one: halves laid over each other."""
    return np.bitwise_or.reduce(bits.reshape(*bits.shape[:-1], -1, words), -2)


def packed(keys: np.ndarray) -> bytes:
    """The upper 48 bits of each key, six bytes a key."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(keys: bytes) -> np.ndarray:
    out = np.zeros((len(keys) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(keys, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def similar(overlap, n, m, similarity: int):
    return 100 * overlap >= similarity * (n + m - overlap)


def overlap_bound(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """At most this many shingles are shared: each bit of one side alone is a shingle of that side alone."""
    only_left = np.bitwise_count(left & ~right).sum(-1, dtype=np.int64)
    only_right = np.bitwise_count(right & ~left).sum(-1, dtype=np.int64)
    return np.minimum(n - only_left, m - only_right)


def shared(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(left) > len(right):
        left, right = right, left
    at = np.searchsorted(right, left)
    at[at == len(right)] = len(right) - 1
    return int((right[at] == left).sum())


def _frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """A class per slot, growing with the logarithm of the documents counted there; 0 for rare shingles."""

    def make():
        shingle = Shingler(size)

        def run(batches):
            counts = np.zeros(FREQUENCY_SLOTS, np.int32)
            for batch in batches:
                slots = [(shingle(t) >> np.uint64(42)).astype(np.int32) for t in batch.column("text").to_pylist()]
                if slots:
                    np.add.at(counts, np.concatenate(slots), 1)
            noted = np.flatnonzero(counts >= NOTED + 4 * counts.mean())
            yield {"slot": pa.array(noted.astype(np.int32)), "n": pa.array(counts[noted].astype(np.int64))}

        return run

    noted = to_rows(docs.select("text"), make, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    classes = np.zeros(FREQUENCY_SLOTS, np.uint8)
    classes[noted["slot"].to_numpy(int)] = np.log2(noted["n"].to_numpy(float)).astype(np.uint8)
    return classes


def _signatures(docs: DataFrame, size: int, similarity: int) -> DataFrame:
    """id, carried, node, n, bitmap and prefix (the first shingles in the common order) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(_frequencies(docs, size))

    def make():
        shingle, classes = Shingler(size), sent.value

        def run(batches):
            for batch in batches:
                nodes, sizes, bitmaps, prefixes = [], [], [], []
                for text in batch.column("text").to_pylist():
                    found = shingle(text)
                    n = len(found)
                    nodes.append(digest(found))
                    sizes.append(n)
                    bitmaps.append(bitmap(found))
                    first = found[np.argsort(classes[found >> np.uint64(42)], kind="stable")[: prefix_length(n, similarity)]]
                    prefixes.append(packed(first) if n else b"")
                yield {
                    "id": batch.column("id"),
                    "carried": batch.column("carried"),
                    "node": pa.array(nodes, pa.int64()),
                    "n": pa.array(sizes, pa.int64()),
                    "bitmap": pa.array(bitmaps, pa.binary()),
                    "prefix": pa.array(prefixes, pa.binary()),
                }

        return run

    return to_rows(docs, make, "id long, carried long, node long, n long, bitmap binary, prefix binary")


_TILE = ~np.uint64(0xFFFF)


def _tile_keys(prefix: bytes, n: int, similarity: int) -> np.ndarray:
    """Tiles of a node, as the upper 48 bits of a hash of shingle and band."""
    first = unpacked(prefix)
    tiles = [mixed(first + np.array([b + 1], np.uint64) * _FACTORS[1]) for b in bands(n, similarity)]
    return np.concatenate(tiles) & _TILE


def _tile_entries(batch: pa.RecordBatch, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Tile and node of every prefix shingle of a batch; a node that is there twice counts once."""
    keys, nodes, counts, seen = [], [], [], set()
    for node, n, prefix in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "prefix"))):
        if n and node not in seen:
            seen.add(node)
            keys.append(_tile_keys(prefix, n, similarity))
            nodes.append(node)
            counts.append(len(keys[-1]))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.repeat(np.array(nodes, np.int64), counts)


class Filter:
    """Tells which numbers may be in a column; a set of bits, some 16 per distinct value.

    It goes to every task, so it has at most FILTER_BITS bits. When a column has more
    values than that serves it lets more pass; the joins behind it then do the work.
    """

    def __init__(self, column: DataFrame):
        count = max(1, column.count())
        self.bits = min(FILTER_BITS, 1 << (16 * count - 1).bit_length())
        slots = column.select(F.pmod(F.col(column.columns[0]).cast("long"), F.lit(self.bits)).alias("slot"))
        words = (
            slots.selectExpr("slot div 64 as word", "shiftleft(1L, cast(slot % 64 as int)) as bit")
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bits"))
            .toPandas()
        )
        held = np.zeros(max(1, self.bits // 64), np.int64)
        held[words["word"].to_numpy(int)] = words["bits"].to_numpy(np.int64)
        self.sent = column.sparkSession.sparkContext.broadcast(held)

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        slot = values & (self.bits - 1)
        return (self.sent.value[slot >> 6] >> (slot & 63)) & 1 == 1


def _to_least(keys: np.ndarray, nodes: np.ndarray, counts: np.ndarray):
    """Tiles with their least node and count, and the distinct (node, least node) of all other nodes."""
    order = np.lexsort((nodes, keys))
    keys, nodes, counts = keys[order], nodes[order], counts[order]
    if not len(keys):
        return keys, nodes, counts, np.zeros((0, 2), np.int64)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    least = np.repeat(nodes[first], np.diff(np.r_[first, len(keys)]))
    other = nodes != least
    pairs = np.unique(np.stack([nodes[other], least[other]], 1), axis=0)
    return keys[first], nodes[first], np.add.reduceat(counts, first), pairs


def _thinned(keys: np.ndarray, nodes: np.ndarray):
    """Like _to_least, but only tiles of many nodes are reduced to the least one; others stay as they are."""
    order = np.argsort(keys, kind="stable")
    keys, nodes = keys[order], nodes[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    large = np.repeat(sizes > SENT_PER_TILE, sizes)
    tiles, least, counts, pairs = _to_least(keys[large], nodes[large], np.ones(int(large.sum()), np.int64))
    some = ~large
    return (
        np.concatenate([keys[some], tiles]),
        np.concatenate([nodes[some], least]),
        np.concatenate([np.ones(int(some.sum()), np.int64), counts]),
        pairs,
    )


def _stars(signatures: DataFrame, similarity: int, entries: int) -> DataFrame:
    """Rows (a, b, null): a node of a tile and the tile's least one, or that of its own batch;
    and rows (null, null, tile) of the tiles with three nodes or more.

    Of a tile that has many nodes in a batch only the least one is sent on, so a tile that
    holds a third of all nodes reaches the next step as few entries per batch. Entries
    travel packed, by parts of the tile's hash. A tile of two nodes has one pair, so it is
    done with these.
    """
    least_parts = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least_parts, -(-entries // ENTRIES_PER_PARTITION))

    def make_local():
        def run(batches):
            for batch in batches:
                keys, least, counts, pairs = _thinned(*_tile_entries(batch, similarity))
                part = ((keys >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                rows = [(p, order[cuts[p] : cuts[p + 1]]) for p in range(parts) if cuts[p] < cuts[p + 1]]
                more = [1] * bool(len(pairs))  # a row for the batch's own pairs
                yield {
                    "part": pa.array([p for p, _ in rows] + [int(pairs[0, 0]) % parts for _ in more], pa.int32()),
                    "tiles": pa.array([packed(keys[i]) for _, i in rows] + [None for _ in more], pa.binary()),
                    "nodes": pa.array([least[i].tobytes() for _, i in rows] + [pairs.tobytes() for _ in more], pa.binary()),
                    "crowd": pa.array([np.minimum(counts[i], 3).astype(np.uint8).tobytes() for _, i in rows] + [None for _ in more], pa.binary()),
                }

        return run

    def make_merged():
        def rows(pairs, tiles):
            none = lambda n: pa.nulls(n, pa.int64())
            a, b = (pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1))
            return {
                "a": pa.concat_arrays([a, none(len(tiles))]),
                "b": pa.concat_arrays([b, none(len(tiles))]),
                "tile": pa.concat_arrays([none(len(pairs)), pa.array(tiles.view(np.int64))]),
            }

        def run(batches):
            held: list[tuple[bytes, bytes, bytes]] = []
            no_tiles = np.zeros(0, np.uint64)
            for batch in batches:
                for tiles, nodes, crowd in zip(*(batch.column(c).to_pylist() for c in ("tiles", "nodes", "crowd"))):
                    if tiles is None:
                        yield rows(np.frombuffer(nodes, np.int64).reshape(-1, 2), no_tiles)
                    else:
                        held.append((tiles, nodes, crowd))
            keys, nodes, crowd = (b"".join(h[k] for h in held) for k in range(3))
            held.clear()
            tiles, _, counts, pairs = _to_least(
                unpacked(keys), np.frombuffer(nodes, np.int64), np.frombuffer(crowd, np.uint8).astype(np.int64)
            )
            yield rows(pairs, tiles[counts >= 3])

        return run

    local = to_rows(signatures.select("node", "n", "prefix"), make_local, "part int, tiles binary, nodes binary, crowd binary", SIGNATURE_BYTES)
    return to_rows(local.repartition(parts, "part"), make_merged, "a long, b long, tile long")


def _bounded(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """Pairs whose sizes and bitmaps leave a link possible."""
    sizes = nodes.select("node", "n")
    close = (100 * F.col("n_a") >= similarity * F.col("n_b")) & (100 * F.col("n_b") >= similarity * F.col("n_a"))
    sized = pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b").filter(close & (F.col("a") != F.col("b")))
    bits = nodes.select("node", "bitmap")
    joined = sized.join(bits.toDF("a", "bitmap_a"), "a").join(bits.toDF("b", "bitmap_b"), "b")

    def make():
        def run(batches):
            for batch in batches:
                n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                bound = np.zeros(len(n), np.int64)
                for k, (x, y) in enumerate(zip(batch.column("bitmap_a").to_pylist(), batch.column("bitmap_b").to_pylist())):
                    words = min(len(x), len(y)) // 8
                    sides = [folded(np.frombuffer(z, np.uint64), words) for z in (x, y)]
                    bound[k] = overlap_bound(*sides, n[k], m[k])
                left = pa.array(similar(bound, n, m, similarity))
                yield {c: batch.column(c).filter(left) for c in ("a", "b")}

        return run

    return to_rows(joined, make, "a long, b long")


def _sets(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """node and its sorted set, for the nodes of wanted.

    The sets are made again from the texts of the nodes concerned. A fixed-size filter on
    ids keeps other documents from being shingled and shuffled.
    """
    numbered = F.coalesce(F.col("id"), F.lit(0)).cast("long")
    ids = Filter(nodes.join(wanted, "node", "left_semi").select(F.coalesce("least_id", F.lit(0)).alias("id")))

    def make():
        shingle = Shingler(size)

        def run(batches):
            for batch in batches:
                chosen = pa.array(np.flatnonzero(ids.may_hold(batch.column("number").to_numpy())))
                found = [shingle(t) for t in batch.column("text").take(chosen).to_pylist()]
                yield {
                    "node": pa.array([digest(f) for f in found], pa.int64()),
                    "set": pa.array([f.tobytes() for f in found], pa.binary()),
                }

        return run

    made = to_rows(docs.select(numbered.alias("number"), "text"), make, "node long, set binary")
    return scratch.written(made.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "sets")


def _links(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, similarity: int, scratch: Scratch) -> DataFrame:
    """The pairs that are similar, by intersecting their sorted sets."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets(wanted, docs, nodes, size, scratch)

    def make_exact():
        def run(batches):
            for batch in batches:
                pairs_of = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())
                keep = []
                for left, right in pairs_of:
                    x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                    keep.append(similar(shared(x, y), len(x), len(y), similarity))
                mask = pa.array(keep, pa.bool_())
                yield {c: batch.column(c).filter(mask) for c in ("a", "b")}

        return run

    joined = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    links = scratch.written(to_rows(joined, make_exact, "a long, b long"), "links")
    scratch.remove(sets)
    return links


# Tiles with one least node mostly hold the same nodes, so they are worked off together: a
# pair is then looked at once, and a node's bitmap is sent once.
# One with very many entries is split by tile into shares.
GROUP = ("least", "share", "blocks", "i", "j")
ENTRIES_PER_SHARE = 20_000


def _placed(signatures: DataFrame, classes: DataFrame, crowded: DataFrame, similarity: int, block: int, scratch: Scratch) -> DataFrame:
    """Nodes of the tiles that hold several components, by the groups that work them off.

    Only tiles of three nodes or more are looked at; those of one component are found by an
    aggregate and dropped. A tile of more than `block` nodes, or of more than BLOCK_SHINGLES
    shingles, is split into blocks, and each pair of blocks is work of its own.
    """
    short = F.shiftright("tile", 16).alias("tile")  # the lower 16 bits of a tile are empty
    wanted = Filter(crowded.select(short))

    def make():
        def run(batches):
            for batch in batches:
                keys, owners = _tile_entries(batch, similarity)
                keys = keys.view(np.int64)
                chosen = wanted.may_hold(keys >> 16)
                yield {"tile": pa.array(keys[chosen]), "node": pa.array(owners[chosen])}

        return run

    rows = to_rows(signatures.select("node", "n", "prefix"), make, "tile long, node long", SIGNATURE_BYTES)
    sizes = signatures.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"))
    described = sizes.join(classes, "node", "left").select("node", "n", F.coalesce("root", "node").alias("class"))
    entries = scratch.written(rows.join(described, "node").distinct(), "entries")
    blocks = F.ceil(F.greatest(F.col("size") / block, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    mixed_tiles = scratch.written(
        entries.groupBy("tile")
        .agg(
            F.min("class").alias("low"),
            F.max("class").alias("high"),
            F.count("*").alias("size"),
            F.sum("n").alias("shingles"),
            F.min("node").alias("least"),
        )
        .filter("low <> high")
        .select("tile", "least", "size", blocks.alias("blocks")),
        "mixed-tiles",
    )
    per_least = mixed_tiles.groupBy("least").agg(F.ceil(F.sum("size") / ENTRIES_PER_SHARE).cast("int").alias("shares"))
    shared_out = mixed_tiles.join(per_least, "least").select(
        "tile", "least", "blocks", F.pmod(F.xxhash64("tile"), F.col("shares")).cast("int").alias("share")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = scratch.written(
        entries.join(shared_out, "tile")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*GROUP[:3], F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "tile", "node", "class"),
        "placed",
    )
    scratch.remove(entries, mixed_tiles)
    return placed


def _by_group(placed: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of a group together: first its members with what is known of them, then tile by tile."""
    known = members.columns[len(GROUP) + 1 :]
    tiles = ("tile", "class", "own")
    rows = members.withColumns({c: F.lit(None).cast(placed.schema[c].dataType) for c in tiles}).unionByName(
        placed.withColumns({c: F.lit(None).cast(members.schema[c].dataType) for c in known})
    )
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, F.col("tile").asc_nulls_first())


def _cross_links(
    signatures: DataFrame,
    nodes: DataFrame,
    docs: DataFrame,
    classes: DataFrame,
    crowded: DataFrame,
    size: int,
    similarity: int,
    block: int,
    scratch: Scratch,
) -> DataFrame:
    """Links between nodes of different components that share a tile: enough to join all that link."""
    placed = _placed(signatures, classes, crowded, similarity, block, scratch)
    bits = nodes.select("node", "n", "bitmap")
    members = placed.select(*GROUP, "node").distinct().join(bits, "node").select(*GROUP, "node", "n", "bitmap")
    key = ", ".join(f"{c} {placed.schema[c].dataType.simpleString()}" for c in GROUP)
    named = f"{key}, node long"
    possible = scratch.written(to_rows(_by_group(placed, members), partial(_worked_off, _Possible, similarity), named), "possible")
    sets = _sets(possible.select("node").distinct(), docs, nodes, size, scratch)
    members = possible.join(bits, "node").join(sets, "node").select(*GROUP, "node", "n", "bitmap", "set")
    rows = placed.join(possible, [*GROUP, "node"], "left_semi")
    tree = to_rows(_by_group(rows, members), partial(_worked_off, _Joined, similarity), "a long, b long")
    links = scratch.written(tree.distinct(), "cross-links")
    scratch.remove(placed, possible, sets)
    return links


# Pairs a task holds before it compares their bitmaps.
PAIRS_AT_ONCE = 1_000_000
# Bytes of bitmaps on either side of one comparison.
SETTLED_BYTES = 4 << 20


class _Group:
    """The tiles of one group: first its members, then tile by tile."""

    def __init__(self, key: tuple, similarity: int):
        self.key, self.similarity = key, similarity
        self.across = key[-2] != key[-1]
        self.members: list[tuple] = []
        self.tiles: list[tuple[np.ndarray, np.ndarray]] = []
        self.asked = np.zeros(0, np.int64)
        self.codes: list[np.ndarray] = []
        self.waiting = 0

    def add_members(self, rows: dict) -> None:
        bitmaps = [np.frombuffer(b, np.uint64) for b in rows["bitmap"]]
        sets = [np.frombuffer(b, np.uint64) for b in rows.get("set", [])] or [None] * len(bitmaps)
        self.members += zip(rows["node"].tolist(), rows["n"].tolist(), bitmaps, sets)

    def _start(self) -> None:
        self.members.sort(key=lambda m: m[0])
        self.nodes = np.array([m[0] for m in self.members], np.int64)
        self.sizes = np.array([m[1] for m in self.members], np.int64)
        self.root = np.zeros(len(self.members), np.int64)  # the component of each member, as far as known
        self.widths = np.array([len(m[2]) for m in self.members], np.int64)
        self.place = np.zeros(len(self.members), np.int64)
        self.bitmaps = {}
        for width in np.unique(self.widths).tolist():
            own = np.flatnonzero(self.widths == width)
            self.place[own] = np.arange(len(own))
            self.bitmaps[width] = np.stack([self.members[k][2] for k in own])

    def add_tile(self, rows: dict) -> None:
        """Asks for pairs with the least nodes of a tile."""
        if not hasattr(self, "nodes"):
            self._start()
        at, first = np.unique(np.searchsorted(self.nodes, rows["node"]), return_index=True)
        if not self.tiles:
            self.first_class = {}
        self._learn(at, rows["class"][first])
        self.tiles.append((at, rows["own"][first]))
        self._ask(self.tiles[-1], 0, REPRESENTATIVES)

    def _learn(self, at: np.ndarray, classes: np.ndarray) -> None:
        """Numbers the components of members seen for the first time."""
        for k in np.flatnonzero(self.root[at] == 0).tolist():
            self.root[at[k]] = self.first_class.setdefault(int(classes[k]), len(self.first_class) + 1)

    def _ask(self, tile: tuple[np.ndarray, np.ndarray], first: int, last: int) -> None:
        """Asks for pairs of different components, and of sizes that allow a link."""
        at, own = tile
        n = self.sizes[at]
        for k in range(first, min(len(at) - 1, last)):
            rest = slice(k + 1, None)
            ask = self.open(at[k], at[rest])
            ask &= (100 * n[rest] >= self.similarity * n[k]) & (100 * n[k] >= self.similarity * n[rest])
            if self.across:
                ask &= own[rest] != own[k]
            if ask.any():
                self.codes.append(at[k] * len(self.nodes) + at[rest][ask])
                self.waiting += len(self.codes[-1])
            if self.waiting > PAIRS_AT_ONCE:
                self.settle()

    def open(self, x, y) -> np.ndarray:
        """Whether pairs of members have still to be looked at."""
        return self.root[y] != self.root[x]

    def finish(self) -> None:
        """All pairs of every tile that are still to be looked at."""
        self.settle()
        for tile in self.tiles:
            self._ask(tile, REPRESENTATIVES, len(tile[0]))
        self.settle()

    def settle(self) -> None:
        """Looks at the pairs asked for since the last time; those that bitmaps leave possible are found."""
        asked = np.setdiff1d(np.concatenate(self.codes), self.asked) if self.codes else np.zeros(0, np.int64)
        self.codes, self.waiting = [], 0
        x, y = np.divmod(asked, max(1, len(self.members)))
        still = self.open(x, y)
        asked, x, y = asked[still], x[still], y[still]
        if not len(asked):
            return
        self.asked = np.union1d(self.asked, asked)
        kept = np.zeros(len(asked), bool)
        for u, v in np.unique(np.stack([self.widths[x], self.widths[y]], 1), axis=0).tolist():
            alike = np.flatnonzero((self.widths[x] == u) & (self.widths[y] == v))
            words, at_once = min(u, v), max(1, SETTLED_BYTES // (8 * max(u, v)))
            for i in range(0, len(alike), at_once):
                k = alike[i : i + at_once]
                left = folded(self.bitmaps[u][self.place[x[k]]], words)
                right = folded(self.bitmaps[v][self.place[y[k]]], words)
                n, m = self.sizes[x[k]], self.sizes[y[k]]
                kept[k] = similar(overlap_bound(left, right, n, m), n, m, self.similarity)
        self.found(x[kept], y[kept])


class _Possible(_Group):
    """Which members bitmaps leave a link to another component."""

    def _start(self) -> None:
        super()._start()
        self.marked = np.zeros(len(self.members), bool)

    def open(self, x, y) -> np.ndarray:
        return super().open(x, y) & ~(self.marked[x] & self.marked[y])

    def found(self, x: np.ndarray, y: np.ndarray) -> None:
        self.marked[x] = self.marked[y] = True

    def rows(self) -> dict:
        nodes = self.nodes[self.marked]
        kinds = [pa.int64(), *[pa.int32()] * (len(GROUP) - 1)]
        return {c: pa.array([v] * len(nodes), k) for c, v, k in zip(GROUP, self.key, kinds)} | {"node": pa.array(nodes)}


class _Joined(_Group):
    """The links that join members, by exact intersection."""

    def __init__(self, key: tuple, similarity: int):
        super().__init__(key, similarity)
        self.tree: list[tuple[int, int]] = []

    def found(self, x: np.ndarray, y: np.ndarray) -> None:
        for i, j in zip(x.tolist(), y.tolist()):
            if self.root[i] == self.root[j]:
                continue
            left, right = self.members[i][3], self.members[j][3]
            if similar(shared(left, right), len(left), len(right), self.similarity):
                self.tree.append((i, j))
                self.root[self.root == self.root[j]] = self.root[i]

    def rows(self) -> dict:
        ends = np.array(self.tree, np.int64).reshape(-1, 2)
        return {"a": pa.array(self.nodes[ends[:, 0]]), "b": pa.array(self.nodes[ends[:, 1]])}


def _runs(batches) -> Iterator[tuple[tuple, bool, dict]]:
    """Rows of equal (group, tile), also across batches: group, whether they are members, columns."""
    held: list[dict] = []
    binary = ("bitmap", "set")

    def joined() -> tuple[tuple, bool, dict]:
        first = held[0]
        rows = {c: np.concatenate([h[c] for h in held]) for c in first if c not in binary}
        rows |= {c: [b for h in held for b in h[c]] for c in first if c in binary}
        return tuple(int(first[c][0]) for c in GROUP), bool(first["member"][0]), rows

    for batch in batches:
        if not batch.num_rows:
            continue
        filled = {c: batch.column(c).fill_null(0).to_numpy() for c in (*GROUP, "tile", "node", "class", "own", "n")}
        filled["member"] = batch.column("tile").is_null().to_numpy(zero_copy_only=False)
        keys = [filled[c] for c in (*GROUP, "tile", "member")]
        change = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        for start, end in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            part = {c: v[start:end] for c, v in filled.items()}
            for c in binary:
                if c in batch.schema.names:
                    part[c] = batch.column(c).slice(start, end - start).to_pylist() if part["member"][0] else []
            if held and any(held[0][c][0] != part[c][0] for c in (*GROUP, "tile", "member")):
                yield joined()
                held = []
            held.append(part)
    if held:
        yield joined()


def _worked_off(kind: type[_Group], similarity: int):
    def run(batches) -> Iterator[dict]:
        group: _Group | None = None
        for key, are_members, rows in _runs(batches):
            if group is None or key != group.key:
                if group is not None and group.tiles:
                    group.finish()
                    yield group.rows()
                group = kind(key, similarity)
            if are_members:
                group.add_members(rows)
            else:
                group.add_tile(rows)
        if group is not None and group.tiles:
            group.finish()
            yield group.rows()

    return run


def near_duplicates(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = WORDS_PER_SHINGLE,
    similarity: int = SIMILARITY,
    block: int = BLOCK,
    carried: Column | None = None,
) -> DataFrame:
    """One row per row of df: id, n_shingles and component_id.

    With carried, a column of longs, that as well and group: the same number for all rows of a
    component, whatever their ids; null for rows without words.

    Words are runs of characters other than white space of ASCII, A-Z lower-cased; a set
    holds the distinct shingles of `size` words, or the whole sequence if there are fewer
    words. Two rows link when 100 * overlap >= similarity * union, and component_id is the
    least id that a row reaches by links. No words, or a null text: an empty set, linked
    with nothing. Equal sets are one node throughout, so repeated rows cost nothing; a
    null id takes part but never names a component unless all its ids are null. Ids are
    integers. An empty table gives an empty result; other columns of df are not read.
    """
    docs = df.select(
        F.col(f"`{id}`").cast("long").alias("id"),
        F.col(f"`{text}`").alias("text"),
        (F.lit(None) if carried is None else carried).cast("long").alias("carried"),
    )
    scratch = Scratch(df.sparkSession)
    signatures = written(_signatures(docs, size, similarity), "signatures")
    entries = int(signatures.agg(F.coalesce(F.sum(F.length("prefix")), F.lit(0)).alias("bytes")).first()["bytes"]) // 6
    nodes = scratch.written(
        signatures.filter("n > 0").groupBy("node", "n", "bitmap").agg(F.min("id").alias("least_id")), "nodes"
    )
    stars = scratch.written(_stars(signatures, similarity, entries), "stars")
    pairs = stars.filter("a is not null").select("a", "b").distinct()
    likely = scratch.written(_bounded(pairs, nodes, similarity), "likely-pairs")
    links = _links(likely, docs, nodes, size, similarity, scratch)
    crowded = stars.filter("tile is not null").select("tile")
    across = _cross_links(signatures, nodes, docs, components(links), crowded, size, similarity, block, scratch)
    roots = nodes.select("node", "least_id").join(components(links.unionByName(across)), "node", "left")
    roots = roots.withColumn("root", F.coalesce("root", "node"))
    least = roots.groupBy("root").agg(F.min("least_id").alias("component"))
    named = written(roots.join(least, "root").select("node", "root", "component"), "named")
    scratch.remove(nodes, stars, likely, links, across)
    return signatures.select("id", "carried", "node", "n").join(named, "node", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
        *(["carried", F.when(F.col("n") > 0, F.col("root")).alias("group")] if carried is not None else []),
    )
