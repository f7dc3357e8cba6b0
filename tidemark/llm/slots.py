"""Sharding through fixed virtual slots.

Records hash into thousands of slots, bytes are summed per slot, and a small table says which
shard holds which slot. Moving load means editing that table: its versions are kept, and no
record changes its slot. DataFrame functions only; the driver handles one number per slot.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import int_array, size_of
from tidemark.session import work_dir
from tidemark.sources.sinks import append, materialize

SLOTS = 4096


def balanced(weights: list[int], shards: int) -> list[int]:
    """Shard of each slot: heaviest slot first to the lightest shard, then swaps that level the ends."""
    load, members = [0] * shards, [[] for _ in range(shards)]
    for slot in sorted(range(len(weights)), key=lambda s: (-weights[s], s)):
        to = min(range(shards), key=lambda k: (load[k], k))
        load[to] += weights[slot]
        members[to].append(slot)
    for _ in range(64 * shards):
        high, low = max(range(shards), key=lambda k: load[k]), min(range(shards), key=lambda k: load[k])
        gap = load[high] - load[low]
        light = sorted([(0, -1), *((weights[s], s) for s in members[low])])
        best = None
        for s in members[high]:
            at = bisect_left(light, (weights[s] - gap // 2, -1))
            for w, other in light[max(0, at - 1):at + 1]:
                left = abs(gap - 2 * (weights[s] - w))
                if left < gap and (best is None or left < best[0]):
                    best = (left, s, other, weights[s] - w)
        if best is None:
            break
        _, s, other, moved = best
        members[high].remove(s)
        members[low].append(s)
        if other >= 0:
            members[low].remove(other)
            members[high].append(other)
        load[high] -= moved
        load[low] += moved
    out = [0] * len(weights)
    for shard, own in enumerate(members):
        for s in own:
            out[s] = shard
    return out


def grown(weights: list[int], shard_of: list[int], shards: int) -> list[int]:
    """The map edited for one more shard: slots move into shard ``shards`` only, none between the others."""
    load = [0] * (shards + 1)
    for w, k in zip(weights, shard_of):
        load[k] += w
    goal, out = sum(load) / (shards + 1), list(shard_of)
    for slot in sorted(range(len(weights)), key=lambda s: (-weights[s], s)):
        k = out[slot]
        if k < shards and load[k] - weights[slot] / 2 > goal and load[shards] + weights[slot] / 2 <= goal:
            load[k] -= weights[slot]
            load[shards] += weights[slot]
            out[slot] = shards
    return out


def write_map(spark: SparkSession, path: str, version: int, shard_of: list[int], weights: list[int],
              rows: list[int]) -> None:
    """Append one version of the slot table (version, slot, shard, bytes, rows) to ``path``."""
    append(spark.range(1).select(
        F.posexplode(F.arrays_zip(int_array(shard_of).alias("shard"), int_array(weights).alias("bytes"),
                                  int_array(rows).alias("rows"))).alias("slot", "e"))
        .select(F.lit(version).alias("version"), "slot", F.col("e.shard").cast("int").alias("shard"),
                "e.bytes", "e.rows") if shard_of else
        spark.sql("SELECT 0 version, 0 slot, 0 shard, 0L bytes, 0L rows WHERE false"), path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the slot table, the newest unless named."""
    table = spark.read.parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version)


def to_slots(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """A written table (key, size, text_crc32, slot) of the records, without their texts.

    The slot is a hash of key, text checksum and size. Where equal records pile up in a slot (more
    than four times the mean number), it is cut into further slots by the place of the record in
    the written table, so neither one shard nor one task gets the pile.
    """
    spark = docs.sparkSession
    placed = materialize(docs.select(
        F.col(key), (size_of(text) + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
        .withColumn("slot", F.pmod(F.xxhash64(key, "text_crc32", "size"), F.lit(slots))), "slots")
    counts = {r["slot"]: r["n"] for r in placed.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect()}
    usual = 4 * sum(counts.values()) / slots + 8
    parts = [max(1, round(4 * counts.get(s, 0) / usual)) if counts.get(s, 0) > usual else 1 for s in range(slots)]
    if max(parts) == 1:
        return placed
    first, at = [], 0
    for p in parts:
        first.append(at)
        at += p
    spot = F.col("slot").cast("int") + 1
    return materialize(placed.withColumn("place", F.monotonically_increasing_id()).withColumn(
        "slot", F.element_at(int_array(first), spot)
        + F.pmod(F.xxhash64("place"), F.element_at(int_array(parts), spot))).drop("place"), "slots")


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slots: int = SLOTS,
          map_path: str | None = None) -> DataFrame:
    """Every record with its shard; shard sizes in bytes are near equal (law ``bytes``).

    Returns key, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot, grown_shard (null),
    virtual_slot and map_version. ``slot`` numbers the records of a shard from 0 without gaps: counts
    per virtual slot give each its first number, and rows are numbered inside virtual slots only.
    The map goes to ``map_path`` as version 1 and, edited for one more shard, as version 2.
    Null text has size 1 and checksum 0; null keys and repeated rows are placed like any other row;
    an empty table gives no rows; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    table = to_slots(docs, key, text, slots)
    totals = sorted((r["slot"], r["bytes"], r["n"]) for r in table.groupBy("slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect())
    n = max([slots, *(t[0] + 1 for t in totals)])
    weights, rows = [0] * n, [0] * n
    for s, b, c in totals:
        weights[s], rows[s] = b, c
    shard_of = balanced(weights, shards)
    map_path = map_path or work_dir(spark, "slot-map")
    write_map(spark, map_path, 1, shard_of, weights, rows)
    write_map(spark, map_path, 2, grown(weights, shard_of, shards), weights, rows)
    first, used = [], [0] * shards
    for s in range(n):
        first.append(used[shard_of[s]])
        used[shard_of[s]] += rows[s]
    spot = F.col("virtual_slot").cast("int") + 1
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(key, "text_crc32", "size"))
    return (table.withColumnRenamed("slot", "virtual_slot")
            .withColumn("inside", inside.cast("long") - 1)
            .select(key, "size", "text_crc32", F.lit("bytes").alias("law"),
                    F.element_at(int_array(shard_of), spot).cast("int").alias("shard"),
                    (F.element_at(int_array(first), spot) + F.col("inside")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(1).alias("map_version")))
