"""Sharding by fixed virtual slots and a versioned map from slots to shards.

Records are hashed into ``slots`` virtual slots once and for all. The bytes of each slot are summed, and the map deals
the slots out, heaviest first, each to the lightest shard: the law is `bytes`. A new version of the map is an edit of
the last one: only the slots move that a new shard needs or that lie above the mean. Slots and maps have a fixed number
of rows, whatever the data.

Defined results: a null text has no bytes and the checksum of none; a null id hashes as such, with the text, so that
null ids spread over the slots; repeated rows share a slot and get neighbouring places; an empty table gives none.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetspark.llm.common import full, table

SLOTS = 4096
OVERHEAD = 8  # bytes of a record besides its text
MAP = "version int, shards int, slot int, shard int, bytes long, rows long"


def with_slots(docs: DataFrame, id_col: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Adds size, text_crc32, _llm_order (a hash of the record) and _llm_slot."""
    data = F.encode(full(text), "UTF-8")
    return docs.withColumns({
        "size": (F.octet_length(data) + OVERHEAD).cast("long"), "text_crc32": F.crc32(data),
        "_llm_order": F.xxhash64(id_col, full(text)),
    }).withColumn("_llm_slot", F.pmod("_llm_order", F.lit(slots)).cast("int"))


def slot_loads(slotted: DataFrame, slots: int = SLOTS) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of every slot, at most ``slots`` rows of sums."""
    found = {r[0]: (r[1], r[2]) for r in slotted.groupBy("_llm_slot").agg(F.sum("size"), F.count("*")).collect()}
    return [(slot, *found.get(slot, (0, 0))) for slot in range(slots)]


def first_map(loads: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """Slots, heaviest first, each to the lightest shard."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for slot, size, _ in sorted(loads, key=lambda x: (-x[1], x[0])):
        held, shard = heapq.heappop(heap)
        placed[slot] = shard
        heapq.heappush(heap, (held + size, shard))
    return placed


def edited_map(loads: list[tuple[int, int, int]], placed: dict[int, int], shards: int) -> dict[int, int]:
    """The map after growth or change of sizes: heavy shards give slots to the lightest until no move helps."""
    size = {slot: n for slot, n, _ in loads}
    held = [0] * shards
    owned: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    placed = dict(placed)
    for slot, shard in placed.items():
        held[shard] += size[slot]
        owned[shard].append((size[slot], slot))
    for of in owned:
        of.sort()
    while True:
        low, high = min(range(shards), key=lambda s: (held[s], s)), max(range(shards), key=lambda s: (held[s], -s))
        room = (held[high] - held[low]) // 2
        movable = [x for x in owned[high] if 0 < x[0] <= room]
        if not movable:
            return placed
        moved = movable[-1]
        owned[high].remove(moved)
        owned[low] = sorted([*owned[low], moved])
        held[high], held[low] = held[high] - moved[0], held[low] + moved[0]
        placed[moved[1]] = low


def map_table(spark: SparkSession, loads, placed: dict[int, int], shards: int, version: int) -> DataFrame:
    return spark.createDataFrame([(version, shards, s, placed[s], b, n) for s, b, n in loads], MAP)


def save_map(maps: DataFrame, path: str) -> None:
    """Appends a version; older versions stay readable."""
    maps.write.partitionBy("version").mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    maps = spark.read.schema(MAP).parquet(path)
    wanted = F.lit(version) if version is not None else maps.agg(F.max("version")).scalar()
    return maps.where(F.col("version") == wanted)


def assign_shards(slotted: DataFrame, maps: DataFrame) -> DataFrame:
    """Adds shard and slot (place in the shard, gapless from 0) by one version of the map, a row per virtual slot."""
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = maps.select(F.col("slot").alias("_llm_of"), "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_llm_shift"))
    nth = F.row_number().over(Window.partitionBy("_llm_slot").orderBy("_llm_order"))
    placed = slotted.drop("shard", "slot").join(F.broadcast(offsets), F.col("_llm_slot") == F.col("_llm_of"))
    return placed.withColumn("slot", (nth - 1 + F.col("_llm_shift")).cast("long")).drop(
        "_llm_slot", "_llm_of", "_llm_shift", "_llm_order")


def op9_virtual_slots(spark, folder, shards: int = 24):
    """Shards by version 1 of the map; next_shard by version 2, the same map edited for one more shard."""
    from fleetspark.session import scratch_path

    docs = table(spark, folder, "documents").select("doc_id", "text")
    slotted = with_slots(docs).drop("text")
    loads = slot_loads(slotted)
    path, placed = scratch_path(spark, "slot-map"), first_map(loads, shards)
    save_map(map_table(spark, loads, placed, shards, 1), path)
    save_map(map_table(spark, loads, edited_map(loads, placed, shards + 1), shards + 1, 2), path)
    after = load_map(spark, path, 2).select(F.col("slot").alias("_llm_after"), F.col("shard").cast("int").alias("next_shard"))
    slotted = slotted.join(F.broadcast(after), F.col("_llm_slot") == F.col("_llm_after")).drop("_llm_after")
    return assign_shards(slotted, load_map(spark, path, 1)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"), "next_shard")
