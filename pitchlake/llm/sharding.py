"""Sharding of documents by longest-processing-time scheduling."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, salt_bit, spread_over_salts

#: Ranges of hashed ids within a shard, and of hashed texts within a size, numbered apart.
SLOT_RANGES, SIZE_RANGES = 512, 4096
#: Salts among which the rows of one text are spread.
SALTS = 16


def schedule(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """The shard of each item: items by falling size, each to the least loaded shard."""
    loads = [(0, s) for s in range(shards)]
    out = {}
    for item, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        out[item] = shard
        heapq.heappush(loads, (load + size, shard))
    return out


def deal(heap: list[tuple[int, int]], size: int, n: int) -> list[tuple[int, list[int]]]:
    """n items of one size, each to the least loaded shard of the heap (load, shard), which is
    changed: (first, turn) for each stretch of items from first on that go to the shards of
    turn by turns. Shards whose loads differ by less than the size take turns until the next
    one is reached, so a stretch is found at once, however many items it has."""
    if n == 1:
        load, shard = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, shard))
        return [(0, [shard])]
    out, at = [], 0
    while at < n:
        heap.sort()
        turn = [s for load, s in heap if load - heap[0][0] < size][: n - at]
        rounds = (n - at) // len(turn)
        if len(turn) < len(heap):
            rounds = max(1, min(rounds, -((heap[len(turn) - 1][0] - heap[len(turn)][0]) // size)))
        heap[: len(turn)] = [(load + rounds * size, s) for load, s in heap[: len(turn)]]
        out.append((at, turn))
        at += rounds * len(turn)
    heapq.heapify(heap)
    return out


def _ranked(rows: DataFrame, group: str, range_: Column, order: Column) -> DataFrame:
    """rows with rank: gapless from 0 in each group, whatever the groups' sizes. A range of
    the group starts where the counts of the ranges before end."""
    rows = rows.withColumn("range", range_.cast("int"))
    counts = rows.groupBy(group, "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy(group, "range").orderBy(order))
    return rows.withColumn("place", place).join(starts, [group, "range"]).withColumn("rank", F.col("first") + F.col("place") - 1).drop("range", "place", "first")


def balanced_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `bytes`: shards have nearly equal sums of size, the UTF-8 bytes of a text
    plus 1. Rows of equal text are a group and share a shard; a null text counts as empty.
    Groups go by falling size, those of one size by a hash of their text, each to the least
    loaded shard. So no two loads differ by more than the group placed last on the larger.
    slot numbers a shard's rows from 0 without gaps. grown_shard is null under this law.
    Null ids, repeated rows and very long texts are rows like others. Other columns of docs
    are not read. An empty table gives no rows.

    The driver sees how many groups each size has, not the groups: all groups of a size are
    dealt at once, and a group finds its shard by its rank among those of its size. There
    are fewer sizes than the root of twice the sum of all bytes, and mostly no more than the
    longest text has bytes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"),
    )
    rows = materialize(rows, "shard-rows")
    salted = rows.groupBy("sha", "salt").agg(F.sum("size").alias("size"))
    groups = materialize(salted.groupBy("sha").agg(F.sum("size").alias("total"), F.sum(salt_bit()).alias("salt_bits")), "shard-groups")
    histogram = groups.groupBy("total").agg(F.count(F.lit(1)).alias("n")).collect()
    heap = [(0, s) for s in range(shards)]
    dealt = [(r.total, *zip(*deal(heap, r.total, r.n), strict=True)) for r in sorted(histogram, reverse=True)]

    turns = docs.sparkSession.createDataFrame(dealt, "total long, firsts array<long>, turns array<array<int>>")
    ranked = _ranked(groups, "total", F.pmod(F.xxhash64("sha"), F.lit(SIZE_RANGES)), F.col("sha")).join(turns, "total")
    stretch = F.size(F.filter("firsts", lambda f: f <= F.col("rank")))
    turn, first = F.element_at("turns", stretch), F.element_at("firsts", stretch)
    shard = F.element_at(turn, ((F.col("rank") - first) % F.size(turn)).cast("int") + 1)
    placed = spread_over_salts(ranked.select("sha", shard.alias("shard"), "salt_bits"), SALTS)
    placed = rows.join(placed, ["sha", "salt"])
    numbered = _ranked(placed, "shard", F.pmod(F.xxhash64("doc_id", "sha", "salt"), F.lit(SLOT_RANGES)), F.struct("doc_id", "text_crc32"))
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("rank").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
