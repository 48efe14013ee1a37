"""Shards of near equal size by longest-processing-time scheduling.

Rows of equal text form a group and stay together. Groups, by size from the largest, go each to the shard with the
least load so far. Groups of one size are alike, so the heap works on size classes: a class of c groups of size s first
raises all shards to the highest level that c groups suffice for, in one step, and then deals the rest one by one. The
loads are those of the plain method. There are few classes: d different sizes take d * (d + 1) / 2 bytes at least, so a
corpus of B bytes has no more than sqrt(2 * B). Groups get their place in their class, and rows their place in their
shard, by running totals over ranges; no task holds a class, a group or a shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm._common import documents, materialise, running_totals

SHARDS = 16


def deal_class(loads: list[int], size: int, count: int) -> list[int]:
    """How many of `count` groups of `size` each shard gets, each group going to the shard of least load (of several
    the first); adds them to loads."""
    got = [0] * len(loads)
    low, high = min(loads), max(loads) + size * (count // len(loads) + 1)

    def below(level: int) -> int:
        return sum(max(0, -(-(level - x) // size)) for x in loads)

    while low < high:  # highest level up to which count groups fill all shards
        middle = (low + high + 1) // 2
        low, high = (middle, high) if below(middle) <= count else (low, middle - 1)
    for i, x in enumerate(loads):
        got[i] = max(0, -(-(low - x) // size))
        loads[i] += got[i] * size
    heap = [(x, i) for i, x in enumerate(loads)]
    heapq.heapify(heap)
    for _ in range(count - sum(got)):
        x, i = heap[0]
        heapq.heapreplace(heap, (x + size, i))
        got[i] += 1
        loads[i] += size
    return got


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs; law is `bytes`.

    A null text has size 1, a null text_crc32 and is a group with all other null texts, apart from empty ones. Rows of
    a shard have the slots from 0 without a gap, along doc_id (null first). Repeated rows each get a slot. Texts that
    share two hashes and a length would share a group as well. Other columns of docs are ignored.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("_hash"),
    ).withColumn("_crc", F.coalesce("text_crc32", F.lit(-1).cast("long")))
    rows = materialise(rows, "rows")
    key = ["_hash", "_crc", "size"]
    groups = rows.groupBy(*key).agg((F.count("*") * F.col("size")).alias("total")).withColumn("one", F.lit(1))
    placed = running_totals(groups, ["total"], key, "one", "place")

    def schedule(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loads = [0] * shards
        for batch in batches:
            upto = []
            for size, count in zip(batch["total"], batch["groups"], strict=True):
                got = deal_class(loads, int(size), int(count))
                upto.append([sum(got[: i + 1]) for i in range(shards)])
            yield pd.DataFrame({"total": batch["total"], "upto": upto})

    classes = groups.groupBy("total").agg(F.count("*").alias("groups"))
    dealt = classes.repartition(1).sortWithinPartitions(F.desc("total")).mapInPandas(schedule, "total long, upto array<long>")
    shard_of = placed.join(materialise(dealt, "classes"), "total").select(*key, F.size(F.filter("upto", lambda x: x <= F.col("place"))).alias("shard"))
    sharded = rows.join(shard_of, key).withColumn("_one", F.lit(1)).withColumn("_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    slots = running_totals(sharded, ["shard"], ["_id", *key], "_one", "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))
