"""Shards by fixed virtual slots.

Records hash into a fixed number of slots; bytes are summed per slot; a versioned
map says which shard each slot is in. Rebalancing edits the map: it moves as few
bytes as it needs from the fullest shards to the emptiest, and a new version
never changes the old one. The map has one row per slot, so it is small at any
size of the corpus; rows never pass the driver.

Defined cases: a null text counts as no bytes and has a size of 1; a null
``doc_id`` is a value like another; rows alike in id, size and checksum share a
slot; an empty table gives an empty one and a map of equal slot counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docwatch.llm.common import place_in_group, text_of
from docwatch.session import materialize

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """Which shard each slot is in; ``version`` counts the edits."""

    shards: int
    owner: tuple[int, ...]
    version: int = 1
    moved: tuple[int, ...] = field(default=())

    @staticmethod
    def even(shards: int, slots: int = SLOTS) -> SlotMap:
        return SlotMap(shards, tuple(slot % shards for slot in range(slots)))

    def rebalanced(self, slot_bytes: dict[int, int]) -> SlotMap:
        """The next version: slots move from the fullest shard to the emptiest.

        Each step takes the slot, or the exchange of two slots, that brings the two
        shards nearest to each other; it ends when no step helps. Ties go to the
        lower slot, so the same bytes give the same map.
        """
        owner = list(self.owner)
        load = [0] * self.shards
        held: list[list[tuple[int, int]]] = [[] for _ in range(self.shards)]
        for slot, shard in enumerate(owner):
            held[shard].append((slot_bytes.get(slot, 0), slot))
            load[shard] += slot_bytes.get(slot, 0)
        while True:
            full = max(range(self.shards), key=lambda s: (load[s], -s))
            bare = min(range(self.shards), key=lambda s: (load[s], s))
            gap = load[full] - load[bare]
            step = _best_step(sorted(held[full]), sorted(held[bare]), gap)
            if step is None:
                break
            out, back = step
            for item, a, b in ((out, full, bare), (back, bare, full)):
                if item is not None:
                    held[a].remove(item)
                    held[b].append(item)
                    load[a] -= item[0]
                    load[b] += item[0]
                    owner[item[1]] = b
        return self._edited(owner)

    def grown(self, slot_bytes: dict[int, int]) -> SlotMap:
        """The next version with one more shard, which takes slots from the others."""
        wider = replace(self, shards=self.shards + 1)
        owner, total = list(self.owner), sum(slot_bytes.values())
        load = [0] * wider.shards
        for slot, shard in enumerate(owner):
            load[shard] += slot_bytes.get(slot, 0)
        share = total / wider.shards
        for slot in sorted(range(len(owner)), key=lambda s: (-slot_bytes.get(s, 0), s)):
            size = slot_bytes.get(slot, 0)
            if size and load[owner[slot]] - size >= share and load[-1] + size <= share:
                load[owner[slot]] -= size
                load[-1] += size
                owner[slot] = self.shards
        return wider._edited(owner)

    def _edited(self, owner: list[int]) -> SlotMap:
        moved = tuple(s for s, (a, b) in enumerate(zip(self.owner, owner)) if a != b)
        return replace(self, owner=tuple(owner), version=self.version + 1, moved=moved)

    def table(self, spark: SparkSession) -> DataFrame:
        """``version, virtual_slot, shard``."""
        rows = [(self.version, slot, shard) for slot, shard in enumerate(self.owner)]
        return spark.createDataFrame(rows, "version int, virtual_slot int, shard int")


def _best_step(full: list, bare: list, gap: int):
    """The move, or exchange, whose size is nearest to half the gap; None if none helps."""
    best, left = None, gap
    at = 0
    for out in [item for item in full if item[0]]:
        if abs(gap - 2 * out[0]) < left:
            best, left = (out, None), abs(gap - 2 * out[0])
        while at < len(bare) and 2 * (out[0] - bare[at][0]) > gap:
            at += 1
        for place in (at - 1, at):
            if 0 <= place < len(bare) and abs(gap - 2 * (out[0] - bare[place][0])) < left:
                best, left = (out, bare[place]), abs(gap - 2 * (out[0] - bare[place][0]))
    return best


def save_map(slot_map: SlotMap, spark: SparkSession, path: str) -> None:
    """Write a version beside the earlier ones; writing it again changes nothing."""
    slot_map.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/map_version={slot_map.version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, the latest if none is named."""
    rows = spark.read.parquet(path).select("version", "virtual_slot", "shard")
    wanted = version or rows.agg(F.max("version")).first()[0]
    kept = rows.filter(F.col("version") == wanted).orderBy("virtual_slot").collect()
    owner = tuple(r.shard for r in kept)
    return SlotMap(max(owner) + 1, owner, wanted)


def hashed(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` of every row."""
    text = text_of("text")
    narrow = docs.select(
        "doc_id",
        F.when(F.col("text").isNull(), F.lit(1)).otherwise(F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    slot = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(slots)).cast("int")
    return narrow.withColumn("virtual_slot", slot)


def slot_sizes(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows per slot; as many entries as there are slots at most."""
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    return {r.virtual_slot: (r.bytes, r.n) for r in sums.collect()}


def assign_shards(rows: DataFrame, slot_map: SlotMap, sizes: dict[int, tuple[int, int]], bucket_rows: int = 1 << 20) -> DataFrame:
    """Adds ``shard`` and ``slot``, the row's number in its shard, gapless from 0.

    ``rows`` is a written table of :func:`hashed`. Rows are numbered within their
    virtual slot and slots within their shard, so no shard is sorted whole.
    """
    spark = rows.sparkSession
    start, places = [0] * slot_map.shards, []
    for slot, shard in enumerate(slot_map.owner):
        n = sizes.get(slot, (0, 0))[1]
        places.append((slot, shard, start[shard], n))
        start[shard] += n
    table = spark.createDataFrame(places, "virtual_slot int, shard int, first long, n long")
    placed = place_in_group(
        rows, ["virtual_slot"], ["doc_id", "text_crc32", "size"], table.select("virtual_slot", "n"), bucket_rows
    )
    # a row per virtual slot: the bound is the number of slots
    joined = placed.join(F.broadcast(table.select("virtual_slot", "shard", "first")), "virtual_slot")
    return joined.withColumn("slot", F.col("first") + F.col("place")).drop("first", "place")


def shard_documents(docs: DataFrame, shards: int, slots: int = SLOTS) -> tuple[DataFrame, SlotMap]:
    """All rows of ``docs`` in ``shards`` shards of near equal bytes, and the map used."""
    rows = materialize(hashed(docs, slots), "hashed")
    sizes = slot_sizes(rows)
    slot_map = SlotMap.even(shards, slots).rebalanced({s: b for s, (b, _) in sizes.items()})
    return assign_shards(rows, slot_map, sizes), slot_map
