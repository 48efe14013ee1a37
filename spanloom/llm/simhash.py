"""Near duplicates by SimHash; pairs are found through covering locality-sensitive hashing.

A fingerprint has 64 bits. For radius 3 each bit position gets a non-zero vector of four bits; for each of the 15
non-zero vectors v a table keeps the positions whose vector has an odd product with v. Whatever three positions two
fingerprints differ at, some v is orthogonal to all three of their vectors, so the pair shares its key in that table:
no pair within the radius is missed. A key keeps about 34 of the bits. Where a key holds more than BUCKET distinct
fingerprints, the same construction over its free bits splits it again, so that no group is larger than BUCKET and
still no pair is lost: after three levels fewer than ten bits are free.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm._common import bounded_batches, documents, materialise
from spanloom.llm.graph import connected_components

#: Most distinct fingerprints that are compared with each other in one group.
BUCKET = 1024

#: Words of a shingle, and hash seed, of the fingerprint.
SHINGLE, SEED = 3, 42

#: Words that are hashed at a time: the memory of a long text doesn't follow its length.
CHUNK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text as a signed integer; zero without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = words[at : at + CHUNK + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
        counts += _ones(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8"))
    return _majority(counts, n)


def fingerprint_of_hashes(hashes: np.ndarray) -> int:
    """The fingerprint of a text whose shingles have these hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        counts += _ones(hashes[at : at + CHUNK])
    return _majority(counts, len(hashes))


def _ones(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _majority(counts: np.ndarray, n: int) -> int:
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column) -> Column:
    """Column form of fingerprint_of; null counts as empty."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(x) for x in texts], dtype="int64")

    return simhash(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def cover(free: list[int]) -> list[int]:
    """15 masks over these bit positions, as signed integers, that cover radius 3."""
    vectors = [i % 15 + 1 for i in range(len(free))]
    masks = [sum(1 << bit for bit, x in zip(free, vectors, strict=True) if (x & v).bit_count() % 2) for v in range(1, 16)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _refined(mask: int) -> list[int]:
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | m for m in cover(free)]


def _stars(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links each fingerprint of one group to the smallest one of its component within the group."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        low = np.where(near, label, len(fps)).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    for i in np.flatnonzero(label != np.arange(len(fps))):
        yield int(fps[i].view(np.int64)), int(fps[label[i]].view(np.int64))


def near_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join the same components as all pairs within the
    radius do. Each group yields fewer links than it has members, never all its pairs."""
    if radius != 3:
        raise ValueError("the masks here cover radius 3")
    spark = fps.sparkSession

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [x for group in batch["fps"] for x in _stars(np.sort(np.asarray(group, dtype=np.int64).view(np.uint64)), radius)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    masks = F.array(*map(F.lit, cover(list(range(64)))))
    keyed = fps.select("fp", F.explode(masks).alias("mask"))
    links: DataFrame | None = None
    for level in range(3):
        keyed = keyed.withColumn("key", F.col("mask").bitwiseAND(F.col("fp")))
        sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        sizes = materialise(sizes, "buckets")
        limit = F.lit(BUCKET) if level < 2 else F.lit(1 << 62)
        small = (
            keyed.join(sizes.where(F.col("n") <= limit).select("mask", "key"), ["mask", "key"])
            .groupBy("mask", "key")
            .agg(F.collect_list("fp").alias("fps"))
            .select("fps")
            .mapInPandas(link, "a long, b long")
        )
        links = small if links is None else links.union(small)
        wide = sizes.where(F.col("n") > limit).select("mask", "key")
        masks_here = [r.mask for r in wide.select("mask").distinct().collect()]  # 15 or 225 masks at most
        if not masks_here:
            break
        finer = spark.createDataFrame([(m, x) for m in masks_here for x in _refined(m)], "mask long, finer long")
        keyed = keyed.join(wide, ["mask", "key"]).join(F.broadcast(finer), "mask").select("fp", F.col("finer").alias("mask"))
    return links.distinct()


def near_components(rows: DataFrame, fp: str = "fp", doc_id: str = "doc_id") -> DataFrame:
    """(fp, root, component_id): the smallest fingerprint and the smallest doc_id that are reachable over links from each
    distinct fingerprint. component_id is null where no document of the component has a doc_id; root never is."""
    least = materialise(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("least")), "fingerprints")
    roots = connected_components(near_links(least.select("fp")), "a", "b")
    rooted = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(component, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null and blank texts have fingerprint zero, which links like any other. Repeated rows each get their row. A null
    doc_id is never a component's id unless the component has no other. A text of any length counts whole. Other columns
    of docs are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = materialise(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")), "simhash")
    return rows.join(near_components(rows), "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
