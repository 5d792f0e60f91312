"""Shards of near equal bytes by best-fit-decreasing bin packing of groups that stay together."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import slots, texts_of
from ferrycraft.session import stage

#: Bytes counted for each row besides its text.
ROW_BYTES = 16
#: Groups under 1 / FINE of a shard are bundled by hash; so the packing sees at most 2 * FINE units a shard.
FINE = 1024


class Bins:
    """Open bins in a balanced search tree (a treap) ordered by remaining capacity."""

    def __init__(self) -> None:
        self._root, self._draw = None, random.Random(0).random

    def _split(self, node, key):
        """Trees of the bins below ``key`` and of the others."""
        if node is None:
            return None, None
        own, weight, left, right = node
        if own < key:
            low, high = self._split(right, key)
            return (own, weight, left, low), high
        low, high = self._split(left, key)
        return low, (own, weight, high, right)

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return low[0], low[1], low[2], self._merge(low[3], high)
        return high[0], high[1], self._merge(low, high[2]), high[3]

    def put(self, room: int, name: int) -> None:
        low, high = self._split(self._root, (room, name))
        self._root = self._merge(self._merge(low, ((room, name), self._draw(), None, None)), high)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least room of at least ``size``: (room, bin)."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            return None
        path = []
        while high[2] is not None:
            path.append(high)
            high = high[2]
        found, rest = high[0], high[3]
        for node in reversed(path):
            rest = (node[0], node[1], rest, node[3])
        self._root = self._merge(low, rest)
        return found


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of every size, sizes given in descending order; a bin is opened when none has the room.

    None when more than ``most`` bins are needed. A size over the capacity takes a bin of its own.
    """
    bins, used, placed = Bins(), 0, []
    for size in sizes:
        room, name = bins.tightest(size) or (max(capacity, size), used)
        if name == used:
            used += 1
            if most is not None and used > most:
                return None
        placed.append(name)
        bins.put(room - size, name)
    return placed


def pack(sizes: list[int], shards: int) -> list[int]:
    """Shards 0 … ``shards`` - 1 of descending sizes at the least capacity, to one in 4,000, that needs no more.

    Sizes over the mean of what is left take a shard alone first, so one of them does not loosen all the others.
    """
    rest, alone = sum(sizes), 0
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) > rest:
        rest -= sizes[alone]
        alone += 1
    tail, open_ = sizes[alone:], shards - alone
    if not tail:
        return list(range(alone))
    low = max(-(-rest // open_), tail[0])
    high, best = low + tail[0], None  # always enough: a bin that lacks room for a unit holds over the mean
    if (tight := best_fit_decreasing(tail, low, open_)) is not None:
        high, best = low, tight
    while best is None or high - low > max(1, low // 4000):
        middle = (low + high) // 2 if best is not None or high - low > 1 else high
        tried = best_fit_decreasing(tail, middle, open_)
        if tried is None:
            low = middle
        else:
            high, best = middle, tried
    return list(range(alone)) + [alone + b for b in best]


def pack_shards(docs: DataFrame, key: str = "doc_id", shards: int = 40, text: str = "text") -> DataFrame:
    """``(key, size, text_crc32, law, shard, slot, grown_shard)`` for every row, under the law ``bytes``.

    Groups are equal texts and stay in one shard. Groups of at least 1 / 1,024 of the mean shard are packed one by
    one and smaller ones in bundles made by the hash of the text, so the packing handles at most 2,048 units a
    shard however many rows there are; unit sizes come from sums that combine before the shuffle. A group larger
    than the mean shard cannot be in one of ``shards`` near equal shards: it alone is split, by the hash of the key,
    into pieces of about half a shard. Slots number the rows of a shard by key from 0. NULL texts count as empty,
    repeated rows count each, a NULL key is a key like others, an empty table gives no rows; further columns are
    ignored. ``grown_shard`` belongs to another law and is NULL.
    """
    source = texts_of(docs, key, text=text)
    rows = stage(source.select(
        F.col(key).alias("key"), (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"),
        F.crc32("text").alias("crc"), F.xxhash64("text").alias("group")), "sizes")
    spark, total = docs.sparkSession, rows.agg(F.sum("size")).first()[0] or 0
    mean = max(1, -(-total // shards))
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"))
    own = stage(groups.where(F.col("size") >= max(1, mean // FINE)).withColumn(
        "pieces", F.when(F.col("size") > mean, F.ceil(2 * F.col("size") / mean)).otherwise(1).cast("int")), "own")

    bundle = F.pmod("group", F.lit(shards * FINE)).cast("long")
    small = groups.where(F.col("size") < max(1, mean // FINE)).groupBy(bundle.alias("unit")).agg(
        F.sum("size").alias("size")).select("unit", F.lit(-1).alias("piece"), "size")
    whole = own.where("pieces = 1").select(F.col("group").alias("unit"), F.lit(0).alias("piece"), "size")
    # No more than ``shards`` groups exceed the mean, and no more than FINE * shards reach the bound of ``own``.
    piece = F.pmod(F.xxhash64("key"), F.col("pieces")).cast("int")
    cut = rows.join(F.broadcast(own.where("pieces > 1").select("group", "pieces")), "group").groupBy(
        F.col("group").alias("unit"), piece.alias("piece")).agg(F.sum("size").alias("size"))
    units = small.union(whole).union(cut).toArrow().sort_by(
        [("size", "descending"), ("piece", "ascending"), ("unit", "ascending")])
    placed = pa.table({"unit": units["unit"], "piece": units["piece"],
                       "shard": pa.array(pack(units["size"].to_pylist(), shards), pa.int32())})
    homes = stage(spark.createDataFrame(placed), "homes")

    known = rows.join(F.broadcast(own.select("group", "pieces")), "group", "left")
    shared = known.withColumns({
        "unit": F.when(F.col("pieces").isNull(), bundle).otherwise(F.col("group")),
        "piece": F.when(F.col("pieces").isNull(), F.lit(-1)).otherwise(piece)}).join(
        F.broadcast(homes), ["unit", "piece"])
    dealt = shared.select("key", "size", "crc", "shard").repartitionByRange(
        slots(docs), "shard", "key", "size", "crc").sortWithinPartitions("shard", "key", "size", "crc")
    number = F.monotonically_increasing_id()  # the partition, and the row's place in it in the lower 33 bits
    placed_rows = stage(dealt.withColumns({
        "part": F.shiftright(number, 33).cast("int"), "at": number.bitwiseAND((1 << 33) - 1)}), "dealt")
    # A row for each range partition and shard in it: partitions + shards at most, as ranges follow the shards.
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed_rows.groupBy("part", "shard").agg(F.min("at").alias("first"), F.count("*").alias("n")).select(
        "part", "shard", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed_rows.join(F.broadcast(bases), ["part", "shard"]).select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("at") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
