"""Near copies: documents whose sets of five-word shingles have a Jaccard likeness of at least 0.8.

Candidates come by op4's covering masks: a set of shingles has a SimHash of 64 bits, and what each of the 15 masks keeps of
it is a key, so that no pair whose fingerprints differ at three bits or fewer is missed. That radius alone is not enough: at
a likeness of 0.8 fingerprints differ by about ten bits, often by fifteen, which no affordable number of masks covers. So a
set has further keys: BANDS x LOWEST minima of its hashes (MinHash), of which those of a band make one. Two sets of likeness
j share a given one with probability j ** LOWEST, so that of pairs at 0.8 one in ten thousand shares none of 30, and fewer
above. Candidates of both kinds are then confirmed on the whole sets, so that no pair below 0.8 links.

Equal sets are one node. Sets of a key are compared in one group up to GROUP; of a larger key all are first
compared with its smallest one, and only blocks of those that this leaves in different components with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm._common import bounded_batches, materialise, running_totals
from spanloom.llm.graph import connected_components
from spanloom.llm.simhash import cover, fingerprint_of_hashes

#: Words of a shingle, and hash seed.
SHINGLE, SEED = 5, 42

#: MinHash keys of a set, and minima in one of them.
BANDS, LOWEST = 30, 6

#: Masks whose keys no two fingerprints within three bits miss.
MASKS = np.array(cover(list(range(64))), dtype=np.int64)

#: Likeness of near copies, as a fraction.
LEAST, OF = 4, 5

#: Most sets that are compared with each other in one group.
GROUP = 1024

#: Shingles that are hashed at a time.
CHUNK = 4096

_RANDOM = np.random.default_rng(SEED)
_FLIP, _TIMES = (_RANDOM.integers(0, 1 << 64, BANDS * LOWEST, dtype=np.uint64)[:, None] for _ in range(2))
_TIMES |= np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; one of fewer words is a single shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    parts = [b" ".join(words)] if len(words) < SHINGLE else map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), dtype="<u8"))


def node_of(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def masked_keys(found: np.ndarray) -> list[int]:
    """What each mask keeps of the fingerprint of a set."""
    kept = MASKS & np.int64(fingerprint_of_hashes(found))
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), BANDS + i) for i, x in enumerate(kept)], dtype=np.uint64).view(np.int64).tolist()


def keys_of(found: np.ndarray) -> list[int]:
    low = np.full(BANDS * LOWEST, ~np.uint64(0))
    for at in range(0, len(found), CHUNK):
        low = np.minimum(low, ((found[at : at + CHUNK] ^ _FLIP) * _TIMES).min(axis=1))
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), i) for i, x in enumerate(low.reshape(BANDS, LOWEST))], dtype=np.uint64).view(np.int64).tolist()


def _node(text: Column) -> Column:
    @F.pandas_udf("node long, keys array<long>")
    def node(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(node_of(x), masked_keys(x) + keys_of(x)) for x in map(shingles, texts)], columns=["node", "keys"])

    return node(text)


def _set(text: Column) -> Column:
    @F.pandas_udf("binary")
    def whole(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(x).tobytes() for x in texts], dtype=object)

    return whole(text)


def _alike(a: Column, b: Column) -> Column:
    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs = ((np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) for x, y in zip(a, b, strict=True))
        return pd.Series([_enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in pairs], dtype=bool)

    return alike(a, b)


def _enough(shared, m, n):
    return OF * shared >= LEAST * (m + n - shared)


def linked(nodes: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links each set of a group to the first one of its component among all pairs of the group."""
    sizes = np.array([len(x) for x in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    label = np.arange(len(sets))
    for i in range(len(sets)):
        if not label.any():
            break
        mine = np.zeros(codes.max() + 1, np.int64)
        mine[codes[starts[i] : starts[i] + sizes[i]]] = 1
        near = _enough(np.add.reduceat(mine[codes], starts), sizes[i], sizes)
        joined = np.unique(label[near])
        label[np.isin(label, joined)] = joined[0]
    return [(nodes[i], nodes[k]) for i, k in enumerate(label) if i != k]


def _links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) within the groups of members (group, node)."""

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, nodes, held = None, [], []

        def settle() -> pd.DataFrame:
            return pd.DataFrame(linked(nodes, held), columns=["a", "b"], dtype="int64")

        for batch in batches:
            for g, node, data in zip(batch["group"], batch["node"], batch["set"], strict=True):
                if g != group:
                    if nodes:
                        yield settle()
                    group, nodes, held = g, [], []
                nodes.append(node)
                held.append(np.frombuffer(data, "<u8"))
        if nodes:
            yield settle()

    rows = members.join(sets, "node").repartition("group").sortWithinPartitions("group", "node")
    return rows.select("group", "node", "set").mapInPandas(link, "a long, b long")


def _blocks(wide: DataFrame, links: DataFrame) -> DataFrame:
    """(group, node): of the keys in wide (key, node), pairs of blocks that links leave in more than one component."""
    roots = connected_components(links, "a", "b")
    placed = wide.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"), F.lit(1).alias("one"))
    placed = running_totals(placed, ["key"], ["root", "node"], "one", "at").withColumn("block", F.floor(F.col("at") / (GROUP // 2)))
    placed = materialise(placed.select("key", "node", "root", "block"), "blocks")
    blocks = placed.groupBy("key", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    other = blocks.select("key", *(F.col(c).alias(f"b_{c}") for c in ("block", "low", "high")))
    pairs = blocks.join(other, "key").where("block <= b_block AND NOT (low = high AND b_low = b_high AND low = b_low)")
    group = F.xxhash64("key", "block", "b_block").alias("group")
    return pairs.select("key", group, F.explode(F.array_distinct(F.array("block", "b_block"))).alias("block")).join(placed, ["key", "block"]).select("group", "node")


def near_links(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b) between nodes that join the same components as all pairs of LEAST / OF that share a key do."""
    keyed = rows.dropDuplicates(["node"]).select("node", F.explode("keys").alias("key"))
    keyed = materialise(keyed, "keys")
    sizes = materialise(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1"), "buckets")
    shared = keyed.join(sizes, "key")
    asked = shared.select("node").distinct().join(rows.groupBy("node").agg(F.min("_key").alias("_key")), "node")
    texts = docs.select(F.xxhash64("doc_id", "text").alias("_key"), "text").join(asked, "_key").dropDuplicates(["node"])
    sets = materialise(texts.select("node", _set(F.col("text")).alias("set")), "sets")
    alike = shared.where(F.col("n") <= GROUP).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    alike = alike.select("nodes").distinct().select(F.xxhash64("nodes").alias("group"), F.explode("nodes").alias("node"))
    links = _links(alike, sets)
    wide = shared.where(F.col("n") > GROUP).select("key", "node", "first")
    if not wide.isEmpty():
        firsts = sets.join(wide.select("first").distinct().withColumnRenamed("first", "node"), "node").select(F.col("node").alias("first"), F.col("set").alias("first_set"))
        stars = wide.where("node != first").select("node", "first").distinct().join(sets, "node").join(firsts, "first")
        stars = materialise(stars.where(_alike(F.col("set"), F.col("first_set"))).select(F.col("node").alias("a"), F.col("first").alias("b")).unionByName(links), "links")
        links = stars.unionByName(_links(_blocks(wide.select("key", "node"), stars), sets))
    return links.distinct()


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """Keeps one document of each component of near copies: that of the smallest doc_id (of the smallest text hash,
    where rows share one), with its columns as they are; a null doc_id stands behind all others. Rows that are alike in
    doc_id and text count as one, and so do texts without a word."""
    bounded_batches(docs.sparkSession)
    given = docs.columns
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_key"), _node(F.col("text")).alias("_n"))
    rows = materialise(rows.select("doc_id", "_key", "_n.*"), "shingles")
    roots = connected_components(near_links(docs, rows), "a", "b")
    rooted = rows.select("doc_id", "_key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    place = F.struct(F.col("doc_id").isNull().alias("_last"), "doc_id", "_key")
    first = rooted.groupBy("root").agg(F.min(place).alias("_first")).select(F.col("_first._key").alias("_key"))
    kept = docs.withColumn("_key", F.xxhash64("doc_id", "text")).join(first, "_key")
    others = [F.col(c) for c in given if c not in ("doc_id", "text")] or [F.lit(0)]
    copy = F.row_number().over(Window.partitionBy("_key").orderBy(*others))
    return kept.withColumn("_copy", copy).where("_copy = 1").select(*given)
