"""Sharding by fixed virtual slots: rows hash into slots, slots are dealt to shards by a versioned map.

The law is ``bytes``: the first map deals the slots evenly by number, the next one is edited by their
measured bytes; each version is written once to the shared folder and read from there. Rows are hashed by
doc_id and text, so that rows of one doc_id, or of none, spread. Edge cases: a null text has 16 bytes and
the checksum of no bytes; rows that repeat both share a slot and take places of their own; an empty table
gives no rows (and needs no edit); other columns are left out.
"""

from __future__ import annotations

import heapq
import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shared_dir, stage, table

SLOTS = 4096


@dataclass
class SlotMap:
    """Slot to shard; every edit makes a new version that says which slots moved."""

    shards: int
    owner: list[int]
    version: int = 1
    moved: list[int] = field(default_factory=list)

    @classmethod
    def balanced(cls, sizes: list[int], shards: int) -> SlotMap:
        """Largest slot first, to the shard with the fewest bytes (ties: fewest slots, lowest number)."""
        heap, owner = [(0, 0, s) for s in range(shards)], [0] * len(sizes)
        for slot in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            held, n, shard = heapq.heappop(heap)
            owner[slot] = shard
            heapq.heappush(heap, (held + sizes[slot], n + 1, shard))
        return cls(shards, owner)

    def loads(self, sizes: list[int]) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.owner):
            out[shard] += sizes[slot]
        return out

    def grown(self, sizes: list[int]) -> SlotMap:
        """One more shard; slots move only into it, from the fullest shards, up to the new mean."""
        owner, loads, new = list(self.owner), [*self.loads(sizes), 0], self.shards
        mean, moved = sum(sizes) / (new + 1), []
        by_shard: dict[int, list[int]] = {s: sorted((i for i, o in enumerate(owner) if o == s), key=lambda i: (sizes[i], i)) for s in range(new)}
        while True:
            full = max(range(new), key=lambda s: (loads[s], -s))
            fits = [i for i in by_shard[full] if 0 < sizes[i] and loads[new] + sizes[i] <= mean]
            if not fits:
                break
            slot = fits[-1]
            by_shard[full].remove(slot)
            loads[full] -= sizes[slot]
            loads[new] += sizes[slot]
            owner[slot] = new
            moved.append(slot)
        return SlotMap(new + 1, owner, self.version + 1, moved)

    def rebalanced(self, sizes: list[int], tolerance: float = 0.05) -> SlotMap:
        """Move slots from the fullest to the emptiest shard while that narrows a gap over ``tolerance`` of the mean."""
        owner, loads, moved = list(self.owner), self.loads(sizes), []
        mean = sum(sizes) / self.shards
        while True:
            a, b = max(range(self.shards), key=lambda s: loads[s]), min(range(self.shards), key=lambda s: loads[s])
            gap = loads[a] - loads[b]
            fits = [i for i, o in enumerate(owner) if o == a and 0 < sizes[i] < gap]
            if gap <= tolerance * mean or not fits:
                break
            slot = min(fits, key=lambda i: (abs(gap - 2 * sizes[i]), i))
            owner[slot] = b
            loads[a] -= sizes[slot]
            loads[b] += sizes[slot]
            moved.append(slot)
        return SlotMap(self.shards, owner, self.version + 1, moved)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "shards": self.shards, "owner": self.owner, "moved": self.moved})

    @classmethod
    def from_json(cls, text: str) -> SlotMap:
        x = json.loads(text)
        return cls(x["shards"], x["owner"], x["version"], x["moved"])

    def save(self, spark: SparkSession, path: str) -> None:
        """Write this version; one that is there already raises, versions never change."""
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/v{self.version:06d}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A version, or the latest that is there."""
        found = spark.read.text(f"{path}/v*" if version is None else f"{path}/v{version:06d}").collect()
        return max((cls.from_json(r[0]) for r in found), key=lambda m: m.version)

    @classmethod
    def even(cls, slots: int, shards: int) -> SlotMap:
        """The first version of a store: slots dealt out by number, before any bytes are known."""
        return cls(shards, [s % shards for s in range(slots)])


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot), narrow and staged: the texts are read once."""
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    key = F.xxhash64(F.col("doc_id").cast("long"), "text")
    out = docs.select(F.col("doc_id").cast("long"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.pmod(key, F.lit(slots)).cast("int").alias("virtual_slot"))
    return stage(out, "slotted")


def slot_totals(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows by slot: ``slots`` numbers each, whatever the size of the table."""
    sizes, counts = [0] * slots, [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        sizes[r.virtual_slot], counts[r.virtual_slot] = r.b, r.n
    return sizes, counts


def placed(spark: SparkSession, path: str | None, shards: int, sizes: list[int], tolerance: float) -> SlotMap:
    """The map in force: the store's latest, edited and stored if it needs that."""
    store = path or f"{shared_dir(spark)}/lumenframe/slot-map-{uuid.uuid4().hex}"
    try:
        m = SlotMap.load(spark, store)
    except AnalysisException:  # nothing is there yet
        m = SlotMap.even(len(sizes), shards)
        m.save(spark, store)
    if m.shards != shards or len(m.owner) != len(sizes):
        raise ValueError(f"the map in {store} has {m.shards} shards and {len(m.owner)} slots")
    edited = m.rebalanced(sizes, tolerance)
    if not edited.moved:
        return m
    edited.save(spark, store)
    return SlotMap.load(spark, store)


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS, path: str | None = None, tolerance: float = 0.001) -> DataFrame:
    """Rows with their virtual slot, shard, gapless place in the shard and the version of the map.

    ``path`` is the store of the map: its latest version, or the first one where there is none (None: a
    store of this call's own), is edited by the slots' bytes if they have gone further apart than
    ``tolerance`` of the mean, and the edit is stored as the next version. A place is the rows of the shard's earlier slots plus the rank within the own slot, so no window
    is larger than a slot.
    """
    rows = slotted(docs, slots)
    sizes, counts = slot_totals(rows, slots)
    m = placed(rows.sparkSession, path, shards, sizes, tolerance)
    first, used = [], [0] * m.shards
    for slot, owner in enumerate(m.owner):
        first.append(used[owner])
        used[owner] += counts[slot]
    places = rows.sparkSession.createDataFrame([(i, o, f) for i, (o, f) in enumerate(zip(m.owner, first))], "virtual_slot int, shard int, first long")
    rank = F.row_number().over(W.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32"))
    ranked = rows.withColumn("rank", rank)
    # the map has one row a slot: a fixed size
    out = ranked.join(F.broadcast(places), "virtual_slot")
    return out.withColumns({"slot": F.col("first") + F.col("rank") - 1, "map_version": F.lit(m.version)})


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
