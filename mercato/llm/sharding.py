"""Shards through a fixed number of virtual slots.

A record's id hashes to one of 4096 slots for good; a versioned map says which shard holds
each slot. A rebalance edits the map, never the hash, so only the moved slots' rows move.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from mercato.operators.ranking import rank_in_group
from mercato.session import cut, remove_dir, shared_dir, table

SLOTS = 4096
#: Parts into which the rows of a slot are split to number them.
PARTS = 16


@dataclass(frozen=True)
class SlotMap:
    """shard_of[slot] for one version."""

    version: int
    shard_of: tuple[int, ...]

    @staticmethod
    def first(slots: int = SLOTS) -> SlotMap:
        return SlotMap(1, (0,) * slots)

    @staticmethod
    def of(shards: int, slots: int = SLOTS) -> SlotMap:
        """The map for a number of shards: version k has k shards, each grown from the one before."""
        m = SlotMap.first(slots)
        while m.version < shards:
            m = m.grown()
        return m

    def grown(self) -> SlotMap:
        """One more shard, which takes an equal share of slots from the fullest; nothing else moves."""
        held: dict[int, list[int]] = {}
        for slot, shard in enumerate(self.shard_of):
            held.setdefault(shard, []).append(slot)
        new, edited = max(held) + 1, list(self.shard_of)
        for _ in range(len(self.shard_of) // (new + 1)):
            giver = max(held, key=lambda s: (len(held[s]), s))
            edited[held[giver].pop()] = new
        return SlotMap(self.version + 1, tuple(edited))

    def rebalanced(self, slot_bytes: dict[int, int], tolerance: float = 0.05) -> SlotMap:
        """Move slots from the largest shard to the smallest until sizes are within tolerance of the mean, or no move helps."""
        edited = list(self.shard_of)
        shards = sorted(set(edited))
        size = {s: 0 for s in shards}
        for slot, shard in enumerate(edited):
            size[shard] += slot_bytes.get(slot, 0)
        mean = sum(size.values()) / len(shards)
        for _ in range(len(edited)):
            top, low = max(shards, key=size.get), min(shards, key=size.get)
            gap = size[top] - size[low]
            able = [s for s, shard in enumerate(edited) if shard == top and 0 < slot_bytes.get(s, 0) < gap]
            if size[top] <= mean * (1 + tolerance) and size[low] >= mean * (1 - tolerance) or not able:
                break
            s = min(able, key=lambda s: abs(slot_bytes[s] - gap / 2))
            edited[s] = low
            size[top] -= slot_bytes[s]
            size[low] += slot_bytes[s]
        return SlotMap(self.version + 1, tuple(edited))

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(self.version, i, s) for i, s in enumerate(self.shard_of)], "version int, virtual_slot int, shard int")

    def save(self, spark, folder: str) -> None:
        """Add this version to the stored map; an older one stays readable."""
        self.frame(spark).drop("version").coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={self.version}")

    @staticmethod
    def load(spark, folder: str, version: int | None = None) -> SlotMap:
        """A stored version, or the newest."""
        stored = spark.read.parquet(folder)
        version = version or stored.agg(F.max("version")).first()[0]
        rows = stored.where(F.col("version") == version).orderBy("virtual_slot").collect()
        return SlotMap(version, tuple(r["shard"] for r in rows))


def virtual_slot(id_col: str, slots: int = SLOTS):
    return F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(slots)).cast("int")


def slot_bytes(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(virtual_slot, rows, bytes): at most `slots` rows, summed before the shuffle."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    return docs.select(virtual_slot(id_col, slots).alias("virtual_slot"), size.alias("s")).groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("s").alias("bytes"))


def shard(docs: DataFrame, now: SlotMap, then: SlotMap | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, slot_bytes, shard, slot, grown_shard); one row per row of docs.

    slot is the row's place in its shard, 0, 1, ..; grown_shard is the shard under `then`.
    A null text has size 1 and the checksum of no bytes; null ids share one slot. Repeated
    rows get places of their own, an empty table none. Other columns aren't read.
    """
    spark, slots = docs.sparkSession, len(now.shard_of)
    both = now.frame(spark).select("virtual_slot", "shard")
    grown = then.frame(spark).select("virtual_slot", F.col("shard").alias("grown_shard")) if then else both.select("virtual_slot", F.lit(None).cast("int").alias("grown_shard"))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), virtual_slot(id_col, slots).alias("virtual_slot"), F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part"))
    slim = cut(slim.join(F.broadcast(both), "virtual_slot").join(F.broadcast(grown), "virtual_slot"))
    slim = slim.withColumn("fine", F.col("virtual_slot") * PARTS + F.col("part"))
    total = slim.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"))
    ranked = rank_in_group(slim, "shard", "fine", ["doc_id", "text_crc32", "size"], "slot")
    return ranked.join(F.broadcast(total), "virtual_slot").select("doc_id", "size", "text_crc32", "virtual_slot", "slot_bytes", "shard", "slot", "grown_shard")


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    """Eight shards by key: the id and the number of shards decide, one more shard only takes.

    Both versions of the map are stored in the shared folder and read from there. The law
    `key` forbids moves by bytes (two corpora would place one id apart), so the slots' bytes
    are reported and the edit by bytes, `rebalanced`, is for the callers of other laws.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/slot-map-{uuid.uuid4().hex}"
    first = SlotMap.of(8)
    first.save(spark, folder)
    first.grown().save(spark, folder)
    now, then = SlotMap.load(spark, folder, first.version), SlotMap.load(spark, folder)
    remove_dir(spark, folder)
    done = shard(table(spark, sf_dir, "documents"), now, then)
    return done.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "virtual_slot", "slot_bytes")
