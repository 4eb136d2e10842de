"""Sharding over fixed virtual slots.

Records are hashed into thousands of slots; bytes and rows are summed per slot; a stored, versioned map says which
shard owns each slot. Rebalancing edits the map, slot by slot, and never hashes a record anew.

The map has one entry per slot, a number fixed by a parameter, so it passes through the driver and is broadcast at any
size of the data. Only DataFrame functions touch the records.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Slots that records are hashed into; an entry of the map has a few bytes, so the map stays under 100 kB.
SLOTS = 4096

#: Bytes counted for each record besides its text.
OVERHEAD = 16


@dataclass(frozen=True)
class SlotMap:
    """``owner[s]`` is the shard of slot ``s``."""

    version: int
    shards: int
    owner: tuple[int, ...]


def load_of(slot_map: SlotMap, sizes: dict[int, int]) -> list[int]:
    loads = [0] * slot_map.shards
    for slot, size in sizes.items():
        loads[slot_map.owner[slot]] += size
    return loads


def first_map(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 1: the largest slot first, each to the shard with the least bytes so far."""
    heap = [(0, shard) for shard in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        owner[slot] = shard
        # An empty slot counts a byte, so that empty slots are spread as well.
        heapq.heappush(heap, (load + max(1, sizes.get(slot, 0)), shard))
    return SlotMap(1, shards, tuple(owner))


def rebalance(slot_map: SlotMap, sizes: dict[int, int], shards: int, tolerance: float = 0.02) -> SlotMap:
    """The next version: slots move from the fullest shards until each is within ``tolerance`` of the mean.

    Slots of shards that no longer exist move first. A slot moves only if that narrows the gap between its old and its
    new shard, so few slots move and the loop ends.
    """
    owner = list(slot_map.owner)
    held: list[set[int]] = [set() for _ in range(shards)]
    loads = [0] * shards
    homeless = []
    for slot, shard in enumerate(owner):
        if shard < shards:
            held[shard].add(slot)
            loads[shard] += sizes.get(slot, 0)
        else:
            homeless.append(slot)

    def give(slot: int, shard: int) -> None:
        owner[slot] = shard
        held[shard].add(slot)
        loads[shard] += sizes.get(slot, 0)

    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        give(slot, min(range(shards), key=lambda s: (loads[s], s)))
    mean = sum(loads) / shards
    while True:
        full = max(range(shards), key=lambda s: (loads[s], -s))
        free = min(range(shards), key=lambda s: (loads[s], s))
        gap = loads[full] - loads[free]
        if loads[full] <= mean * (1 + tolerance) and loads[free] >= mean * (1 - tolerance):
            break
        movable = [slot for slot in held[full] if 0 < sizes.get(slot, 0) < gap]
        if not movable:
            break
        slot = min(movable, key=lambda s: (abs(2 * sizes[s] - gap), s))
        held[full].remove(slot)
        loads[full] -= sizes[slot]
        give(slot, free)
    return replace(slot_map, version=slot_map.version + 1, shards=shards, owner=tuple(owner))


def store_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Write one version of the map under ``path/version=N``; a version that exists already is an error."""
    values = ", ".join(f"({slot}, {shard})" for slot, shard in enumerate(slot_map.owner))
    rows = spark.sql(f"SELECT slot, shard, {slot_map.shards} AS shards FROM VALUES {values} AS t(slot, shard)")
    rows.coalesce(1).write.parquet(f"{path}/version={slot_map.version}")


def load_map(spark: SparkSession, path: str, version: int) -> SlotMap:
    rows = spark.read.parquet(f"{path}/version={version}").orderBy("slot").collect()
    return SlotMap(version, rows[0]["shards"], tuple(row["shard"] for row in rows))


def sized_records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of each document.

    The slot depends on id and text, so neither copies of a text nor rows without an id share one.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_totals(records: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot: at most as many rows as there are slots."""
    return records.groupBy("virtual_slot").agg(
        F.sum("size").alias("slot_bytes"), F.count(F.lit(1)).alias("slot_rows")
    )


def assign_shards(docs: DataFrame, shards: int, path: str, slots: int = SLOTS) -> DataFrame:
    """Put each document into a shard so that shards have near equal bytes.

    Returns doc_id, size, text_crc32, law ("bytes"), shard, slot (place within the shard, gapless from 0), grown_shard
    (NULL: the map, not the key, decides), virtual_slot and map_version. The map is stored under ``path``.

    Each row gets its own place, repeated rows too. A NULL text counts as empty and a NULL id is an id like any other.
    An empty table gives an empty result and a map over empty slots. Other columns are ignored.
    """
    spark = docs.sparkSession
    records = sized_records(docs, slots)
    totals = {row["virtual_slot"]: row for row in slot_totals(records).collect()}
    store_map(spark, first_map({slot: row["slot_bytes"] for slot, row in totals.items()}, shards, slots), path)
    slot_map = load_map(spark, path, 1)
    places, entries = [0] * shards, []
    for slot, shard in enumerate(slot_map.owner):
        entries.append(f"({slot}, {shard}, {places[shard]}L)")
        places[shard] += totals[slot]["slot_rows"] if slot in totals else 0
    owners = spark.sql(f"SELECT * FROM VALUES {', '.join(entries)} AS t(owned, shard, first_place)")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    placed = records.withColumn("place", F.row_number().over(within) - 1)
    # One entry per slot: the size is fixed by the number of slots.
    placed = placed.join(F.broadcast(owners), placed["virtual_slot"] == owners["owned"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first_place") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.lit(slot_map.version).alias("map_version"),
    )
