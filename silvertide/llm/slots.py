"""Sharding by fixed virtual slots and a versioned map from slots to shards.

Each record is hashed into one of SLOTS slots, which never change. Bytes are summed per slot, and only this summary,
whose size is fixed, reaches the driver. A map names the shard of each slot; a new version is made by editing the last
one, so a rebalance moves whole slots and leaves all others where they are. Equal records are counted, and each copy is
hashed with its number, so a record that makes up a third of the table is spread over all slots.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silvertide.llm.shared import materialize, shared_folder
from silvertide.sources.versions import Files

SLOTS = 4096
SHARDS = 16
#: By how much the fullest shard may exceed the mean before slots of a stored map move.
TOLERANCE = 0.001


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: the shard of each slot."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def loads(self, sizes: list[int]) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            out[shard] += sizes[slot]
        return out


def first_map(sizes: list[int], shards: int = SHARDS) -> SlotMap:
    """Version 1: the largest slots first, each to the shard with the fewest bytes; ties go by number."""
    heap = [(0, shard) for shard in range(shards)]
    shard_of = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        load, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        heapq.heappush(heap, (load + sizes[slot], shard))
    return SlotMap(1, shards, tuple(shard_of))


def rebalanced(old: SlotMap, sizes: list[int], tolerance: float = TOLERANCE) -> SlotMap:
    """The next version for new sizes: single slots move from the fullest shard to the emptiest while that helps.

    Ends when no shard is above the mean by more than the tolerance, or when no slot is small enough to move.
    """
    shard_of, loads = list(old.shard_of), old.loads(sizes)
    mean = sum(loads) / old.shards
    while max(loads) > mean * (1 + tolerance):
        full, empty = loads.index(max(loads)), loads.index(min(loads))
        gap = loads[full] - loads[empty]
        movable = [s for s, shard in enumerate(shard_of) if shard == full and 0 < sizes[s] < gap]
        if not movable:
            break
        slot = min(movable, key=lambda s: (abs(2 * sizes[s] - gap), s))
        shard_of[slot] = empty
        loads[full] -= sizes[slot]
        loads[empty] += sizes[slot]
    return SlotMap(old.version + 1, old.shards, tuple(shard_of))


def grown(old: SlotMap, sizes: list[int]) -> SlotMap:
    """The next version with one more shard: slots move only into the new one, until it holds its share."""
    shard_of, loads = list(old.shard_of), old.loads(sizes) + [0]
    new, share = old.shards, sum(sizes) / (old.shards + 1)
    held = [[s for s, shard in enumerate(shard_of) if shard == d] for d in range(old.shards)]
    for own in held:
        own.sort(key=lambda s: (sizes[s], -s))
    while True:
        full = max(range(old.shards), key=lambda d: (loads[d], -d))
        fits = [s for s in held[full] if sizes[s] and loads[new] + sizes[s] <= share]
        if not fits:
            break
        slot = fits[-1]
        held[full].remove(slot)
        shard_of[slot] = new
        loads[full] -= sizes[slot]
        loads[new] += sizes[slot]
    return SlotMap(old.version + 1, old.shards + 1, tuple(shard_of))


def map_folder(spark: SparkSession, name: str) -> str:
    """Where the maps of a named table are kept: below the folder that the cluster shares, beyond the end of a session."""
    return f"{shared_folder(spark)}/slot-maps/{name}"


def save_map(spark: SparkSession, slot_map: SlotMap, folder: str) -> None:
    """Stores a version beside the earlier ones, in one step; a version is written once, by the first who tries."""
    rows = [(slot, shard, slot_map.shards) for slot, shard in enumerate(slot_map.shard_of)]
    frame = spark.createDataFrame(rows, "virtual_slot int, shard int, shards int").coalesce(1)
    draft = f"{folder}/_draft-{uuid.uuid4().hex}"
    frame.write.parquet(draft)
    files = Files(spark, folder)
    if not files.rename_new(draft, f"{folder}/version={slot_map.version}"):
        files.delete(draft)
        raise FileExistsError(f"version {slot_map.version} of {folder} is stored already")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap | None:
    """A stored version, the last one by default; None where none is stored."""
    if version is None:
        stored = Files(spark, folder).matches(f"{folder}/version=*")
        if not stored:
            return None
        version = max(int(f.getPath().getName().split("=")[1]) for f in stored)
    rows = spark.read.parquet(f"{folder}/version={version}").orderBy("virtual_slot").collect()
    return SlotMap(version, rows[0].shards, tuple(r.shard for r in rows))


def next_map(old: SlotMap | None, sizes: list[int], shards: int = SHARDS) -> SlotMap:
    """The map for these sizes: a first one, the old one where it still fits, or the old one edited.

    More shards are added one by one, each taking slots from the others; then single slots move if a shard is too full.
    A map of more shards, or of another number of slots, is an error: its places could not be kept.
    """
    if old is None:
        return first_map(sizes, shards)
    if len(old.shard_of) != len(sizes) or old.shards > shards:
        raise ValueError(f"the stored map has {len(old.shard_of)} slots and {old.shards} shards")
    new = old
    while new.shards < shards:
        new = grown(new, sizes)
    new = rebalanced(new, sizes)
    same = new.shard_of == old.shard_of and new.shards == old.shards
    return old if same else SlotMap(old.version + 1, new.shards, new.shard_of)


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, copy, n, virtual_slot): records of docs, equal ones counted.

    Null texts count as empty and have size 1. Copies 0, 1, 2, ... of a record go to slots of their own, from the
    slots-th copy on again to those of the first ones; n says how many of them a row stands for.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    counted = sized.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("all"))
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.least("all", F.lit(slots)) - 1).cast("int"))))
    share = F.expr(f"`all` div {slots}") + F.when(F.col("copy") < F.col("all") % slots, 1).otherwise(0)
    return copies.select(
        "doc_id", "size", "text_crc32", "copy", share.alias("n"),
        F.pmod(F.xxhash64("doc_id", "text_crc32", "copy"), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and records of every slot; one row per slot reaches the driver, however many records there are."""
    sizes, counts = [0] * slots, [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n")).collect():
        sizes[r.virtual_slot], counts[r.virtual_slot] = r["size"], r.n
    return sizes, counts


def placed(rows: DataFrame, slot_map: SlotMap, counts: list[int]) -> DataFrame:
    """One row per record with shard and slot, the place within the shard: 0, 1, 2, ... without gaps.

    Places are numbered within a virtual slot and shifted by the records of the shard's slots before it, so no shard is
    sorted as a whole; counted records take as many places as there are of them.
    """
    before, offsets = [0] * slot_map.shards, []
    for virtual, shard in enumerate(slot_map.shard_of):
        offsets.append((virtual, shard, before[shard]))
        before[shard] += counts[virtual]
    table = rows.sparkSession.createDataFrame(offsets, "virtual_slot int, shard int, offset long")
    own = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "copy")
    numbered = rows.withColumn("after", F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # One row per virtual slot: a fixed number, whatever the input.
    known = numbered.join(F.broadcast(table), "virtual_slot").withColumn("after", F.col("offset") + F.col("after"))
    places = F.sequence(F.col("after") - F.col("n"), F.col("after") - 1)
    return known.withColumn("slot", F.explode(places)).drop("offset", "after", "n", "copy")


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, maps: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version) for every row of docs.

    The law is `bytes`: shards have nearly equal sizes. Equal rows are spread by their number. A null doc_id hashes like a
    value of its own. An empty table gives no rows. grown_shard is null, as this law does not fix it; grown() makes the
    map of one more shard. maps is the folder of the table's map: the last version stored there is used, and where it
    no longer fits, an edited one is stored as the next version. Without it a first map is made and not stored.
    """
    spark = docs.sparkSession
    rows = materialize(slotted(docs, slots), "slotted")
    sizes, counts = slot_sizes(rows, slots)
    old = load_map(spark, maps) if maps else None
    slot_map = next_map(old, sizes, shards)
    if maps and slot_map != old:
        save_map(spark, slot_map, maps)
    return placed(rows, slot_map, counts).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(slot_map.version).alias("map_version"),
    )
