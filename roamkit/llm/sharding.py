"""Fixed virtual slots: a versioned slot-to-shard map, edited when rebalancing.

Every record hashes into one of ``N_SLOTS`` virtual slots, for good.  Only the
small slot-to-shard map decides where a slot lives; it is balanced by the bytes
each slot holds and stored by version.  Rebalancing moves the fewest slots.

Defined cases: NULL text counts 1 byte (0 + 1) and has crc32 0, as the empty
text; rows that share a doc_id but not the text have slots of their own; rows without a
doc_id are dealt at random, since nothing looks them up; repeated rows share a slot and get
places of their own; an empty table gives no rows (and a map over empty slots);
columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roamkit.llm.shared import run_dir, stage

N_SLOTS = 8192


def slotted(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and the record's virtual slot."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.rand(8))).otherwise(F.xxhash64("doc_id", text))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       F.pmod(key, F.lit(n_slots)).cast("int").alias("virtual_slot"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each slot that holds any (at most ``n_slots`` rows)."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


@dataclass(frozen=True)
class SlotMap:
    """A version of the map.  ``shards[s]`` is the shard of slot ``s``."""

    version: int
    n_shards: int
    shards: tuple[int, ...]

    def save(self, spark: SparkSession, path: str) -> None:
        """Add this version to the map table at ``path`` (one Parquet folder a version)."""
        spark.createDataFrame(list(enumerate(self.shards)), "virtual_slot int, shard int").coalesce(1).write.parquet(f"{path}/version={self.version}")

    @staticmethod
    def load(spark: SparkSession, path: str, version: int) -> DataFrame:
        return spark.read.schema("virtual_slot int, shard int").parquet(f"{path}/version={version}")


def balance(sizes: dict[int, int], n_shards: int, n_slots: int = N_SLOTS) -> SlotMap:
    """First version: the largest slot goes to the least full shard, and so on down."""
    heap, shards = [(0, k) for k in range(n_shards)], [0] * n_slots
    for slot in sorted(range(n_slots), key=lambda s: (-sizes.get(s, 0), s)):
        full, k = heapq.heappop(heap)
        shards[slot] = k
        heapq.heappush(heap, (full + sizes.get(slot, 0), k))
    return SlotMap(1, n_shards, tuple(shards))


def rebalance(old: SlotMap, sizes: dict[int, int], n_shards: int, slack: float = 0.01) -> SlotMap:
    """Next version for ``n_shards`` shards: slots leave shards that go away or are
    over the mean by more than ``slack``, largest first where they fit; others stay."""
    mean, shards = sum(sizes.values()) / n_shards, list(old.shards)
    held: dict[int, list[int]] = {k: [] for k in range(max(n_shards, old.n_shards))}
    load = dict.fromkeys(held, 0)
    for slot, k in enumerate(shards):
        held[k].append(slot)
        load[k] += sizes.get(slot, 0)
    moving = [s for k in range(n_shards, old.n_shards) for s in held[k]]
    for k in range(min(n_shards, old.n_shards)):
        for s in sorted(held[k], key=lambda s: (-sizes.get(s, 0), s)):
            if load[k] <= mean * (1 + slack):
                break
            if load[k] - sizes.get(s, 0) >= mean * (1 - slack):
                moving.append(s)
                load[k] -= sizes.get(s, 0)
    heap = [(load[k], k) for k in range(n_shards)]
    heapq.heapify(heap)
    for s in sorted(moving, key=lambda s: (-sizes.get(s, 0), s)):
        full, k = heapq.heappop(heap)
        shards[s] = k
        heapq.heappush(heap, (full + sizes.get(s, 0), k))
    return SlotMap(old.version + 1, n_shards, tuple(shards))


def shard(docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard and the record's place in its shard.

    The text is read once; what is shuffled is four numbers a row, by virtual slot.
    The driver holds the byte counts of the ``n_slots`` slots and nothing else.  A place
    is the rows of the shard's earlier slots plus the rank inside the slot, so no task
    ever holds a shard.
    """
    spark = docs.sparkSession
    rows = stage(slotted(docs, n_slots), "slots")
    counted = {r["virtual_slot"]: (r["bytes"], r["rows"]) for r in slot_bytes(rows).collect()}
    first = balance({s: b for s, (b, _) in counted.items()}, n_shards, n_slots)
    path = run_dir(spark, "slot-map")
    first.save(spark, path)
    before, seen = [], [0] * n_shards
    for s, k in enumerate(first.shards):
        before.append((s, seen[k]))
        seen[k] += counted.get(s, (0, 0))[1]
    starts = spark.createDataFrame(before, "virtual_slot int, place_from long")
    placed = SlotMap.load(spark, path, first.version).join(starts, "virtual_slot")

    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    return (rows.withColumn("rank", rank).join(F.broadcast(placed), "virtual_slot")
            .select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("place_from") + F.col("rank")).cast("long").alias("place")))


def op8(docs: DataFrame) -> DataFrame:
    """The registered query: law ``bytes`` over 16 shards."""
    return shard(docs, 16).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
                                  F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
