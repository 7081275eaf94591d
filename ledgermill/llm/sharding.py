"""Shards of near-equal bytes: the minimax contiguous partition of ordered groups that stay whole.

Documents with equal texts are one group; groups are ordered by their smallest doc_id. The smallest capacity that lets a
greedy walk fill at most ``shards`` shards is found by binary search, and the order is cut where that walk cuts.

No walk reads the groups. They are sorted by range over partitions and numbered, blocks of 16,384 consecutive groups are
summed (one row per block comes to the driver), and a step of a walk looks up the block in which its target falls and
reads that block only. The walks of one search end in the same few blocks, which are kept.

Defined results: a null text counts as an empty one (1 byte with its end); null ids order first; equal rows get a slot
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import stage

BLOCK_BITS = 14


class GroupOrder:
    """Prefix sums of the ordered groups, block by block."""

    def __init__(self, groups: DataFrame, kept: int = 64):
        self.groups, self.kept, self.held = groups, kept, {}
        rows = groups.groupBy("block").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")).toPandas()
        rows = rows.sort_values("block")
        self.blocks = rows["block"].to_numpy()
        self.before = np.concatenate([[0], np.cumsum(rows["bytes"].to_numpy(np.int64))])
        self.total, self.most = int(self.before[-1]), int(rows["most"].max()) if len(rows) else 0

    def _block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Position and prefix sum (itself included) of each group of a block."""
        if b not in self.held:
            if len(self.held) >= self.kept:
                self.held.pop(next(iter(self.held)))
            rows = self.groups.where(F.col("block") == int(self.blocks[b])).select("position", "bytes").toPandas()
            rows = rows.sort_values("position")
            sums = self.before[b] + np.cumsum(rows["bytes"].to_numpy(np.int64))
            self.held[b] = rows["position"].to_numpy(), sums
        return self.held[b]

    def reach(self, target: int) -> tuple[int, int]:
        """The largest prefix sum up to ``target`` and the position of the first group beyond it."""
        b = int(np.searchsorted(self.before, target, "right")) - 1
        if b >= len(self.blocks):
            return self.total, -1
        positions, sums = self._block(b)
        k = int(np.searchsorted(sums, target, "right"))
        return int(sums[k - 1]) if k else int(self.before[b]), int(positions[k])

    def cuts(self, capacity: int, shards: int) -> list[int] | None:
        """First positions of the second and later shards of the greedy walk; None if they are too many."""
        found, filled = [], 0
        for _ in range(shards):
            filled, first = self.reach(filled + capacity)
            if filled == self.total:
                return found
            found.append(first)
        return None

    def smallest(self, shards: int) -> tuple[int, list[int]]:
        low = max(self.most, -(-self.total // shards))
        high, best = low, None
        step = 1 << 10
        while (best := self.cuts(high, shards)) is None:  # most + total / shards always suffices
            low, high, step = high + 1, min(high + step, self.most + -(-self.total // shards)), step * 8
        while low < high:
            middle = (low + high) // 2
            if (found := self.cuts(middle, shards)) is None:
                low = middle + 1
            else:
                high, best = middle, found
        return high, best


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: slots follow (smallest id of the group, doc_id)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key"),
    )
    rows = stage(rows, "shard-rows")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = rows.groupBy("text_key").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"))
    groups = groups.repartitionByRange(parts, "first_id", "text_key").sortWithinPartitions("first_id", "text_key")
    groups = groups.withColumn("position", F.monotonically_increasing_id())
    # The id of a row is (partition, row in it), so shifting it numbers the blocks in order.
    groups = stage(groups.withColumn("block", F.shiftright("position", BLOCK_BITS)), "shard-groups")
    _, cuts = GroupOrder(groups).smallest(shards)

    number = sum((F.col("position") >= c).cast("int") for c in cuts) if cuts else F.lit(0)
    placed = rows.join(groups.select("text_key", "position"), "text_key").withColumn("shard", number)
    placed = placed.select("doc_id", "size", "text_crc32", "shard", "position")
    placed = placed.repartitionByRange(parts, "position", "doc_id").sortWithinPartitions("position", "doc_id")
    numbered = stage(placed.withColumn("row", F.monotonically_increasing_id()), "shard-order")
    part = F.shiftright("row", 33)
    runs = numbered.groupBy("shard", part.alias("part")).agg(F.min("row").alias("first_row"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))  # one row per shard and task
    numbered = numbered.withColumn("part", part).join(runs, ["shard", "part"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("row") - F.col("first_row") + F.col("before")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
