"""Verdict analytics, ranking metrics, vectors, catalog and sampling."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """Null where b is 0; six decimals."""
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), 6)


def confusion(verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """tp, fp, fn, tn (positive: reject) by every key and over all, with rates; rows without a candidate are missing."""
    rows = verdicts.select(*keys, "reference", "candidate")
    hit = lambda r, c: F.count_if((F.col("reference") == r) & (F.col("candidate") == c))
    agg = rows.cube(*keys) if len(keys) == 1 else rows.rollup(*keys)
    out = agg.agg(
        F.count("*").alias("n"), F.count_if(F.col("candidate").isNull()).alias("missing"),
        hit("reject", "reject").alias("tp"), hit("pass", "reject").alias("fp"), hit("reject", "pass").alias("fn"), hit("pass", "pass").alias("tn"),
    )
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    return out.withColumns({"accuracy": ratio(tp + tn, tp + fp + fn + tn), "recall": ratio(tp, tp + fn), "false_reject": ratio(fp, fp + tn), "precision": ratio(tp, tp + fp), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def code_counts(verdicts: DataFrame, codes: Sequence[str]) -> DataFrame:
    """By failure code, over rows with a candidate (reference_codes, codes, candidate): how often the reference has it, how many
    of these the candidate catches (has it too, and rejects) and misses, how often only the candidate has it, and recall."""
    names = F.explode(F.array(*map(F.lit, codes)))  # a fixed list
    has = lambda c: F.coalesce(F.array_contains(c, F.col("code")), F.lit(False))
    ref, mine = has("reference_codes"), has("codes")
    counts = verdicts.where("candidate IS NOT NULL").withColumn("code", names).groupBy("code").agg(
        F.count_if(ref).alias("ref_count"), F.count_if(ref & mine & (F.col("candidate") == "reject")).alias("caught"), F.count_if(mine & ~ref).alias("overcalled")
    )
    return counts.withColumn("missed", F.col("ref_count") - F.col("caught")).withColumn("recall", ratio(F.col("caught"), F.col("ref_count")))


def coverage(expected: DataFrame, artifacts: DataFrame, key: str) -> DataFrame:
    """One row: expected keys, of their artifacts (decision) those that are valid (pass or reject), invalid or missing, artifacts
    that nothing expects (unmatched), and the share that passes of the valid ones and of all expected ones."""
    both = expected.select(key, F.lit(1).alias("_e")).join(artifacts.select(key, F.lit(1).alias("_a"), "decision"), key, "full")
    wanted, given = F.col("_e").isNotNull(), F.col("_a").isNotNull()
    ok = F.coalesce(F.col("decision").isin("pass", "reject"), F.lit(False))
    n, valid, passed = F.count_if(wanted), F.count_if(wanted & ok), F.count_if(wanted & (F.col("decision") == "pass"))
    return both.agg(
        n.alias("expected"), valid.alias("valid"), F.count_if(wanted & given & ~ok).alias("invalid"), F.count_if(wanted & ~given).alias("missing"), F.count_if(~wanted).alias("unmatched"),
        ratio(passed, valid).alias("pass_rate"), ratio(passed, n).alias("conservative_pass_rate"),
    )


def order_statistics(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median (interpolated) and three definitions of the 95th percentile: nearest rank, floor, and the largest value
    where there are fewer than 20. Ranks come from windows, not from collected lists."""
    by = Window.partitionBy(*keys)
    ranked = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), F.row_number().over(by.orderBy(value)).alias("_i"), F.count("*").over(by).alias("_n"))
    at = lambda i: F.max(F.when(F.col("_i") == i, F.col("_v")))
    n = F.col("_n")
    return ranked.groupBy(*keys).agg(
        F.count("*").alias("n"), F.round(F.median("_v"), 6).alias("median"),
        at(F.ceil(n * 95 / 100)).alias("p95_nearest"), at(F.least(F.floor(n * 95 / 100) + 1, n)).alias("p95_floor"),
        at(F.when(n < 20, n).otherwise(F.least(F.floor(n * 95 / 100) + 1, n))).alias("p95_small_n"),
    )


def auroc(rows: DataFrame, keys: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve, ties half, from counts by score: no pairs are formed."""
    by_score = rows.groupBy(*keys, score).agg(F.sum(label).alias("pos"), F.sum(1 - F.col(label)).alias("neg"))
    below = F.sum("neg").over(Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1))
    wins = by_score.withColumn("_w", F.col("pos") * (F.coalesce(below, F.lit(0)) + F.col("neg") / 2))
    out = wins.groupBy(*keys).agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.sum("_w").alias("_w"))
    return out.withColumn("auroc", ratio(F.col("_w"), F.col("positives") * F.col("negatives"))).drop("_w")


def yield_curve(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Share of bad minutes in what is accepted against the share accepted; clips of one score are accepted together."""
    by_score = rows.groupBy(*keys, "score").agg(F.sum("minutes").alias("m"), F.sum(F.col("minutes") * F.col("label")).alias("bad"))
    upto = Window.partitionBy(*keys).orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    accepted, bad = F.sum("m").over(upto), F.sum("bad").over(upto)
    return by_score.select(*keys, "score", accepted.alias("accepted"), bad.alias("bad"), ratio(accepted, F.sum("m").over(whole)).alias("yield"), ratio(bad, accepted).alias("r"))


def matched_point(curve: DataFrame, keys: list[str], target: float) -> DataFrame:
    """The point whose yield is nearest to target, the first of several."""
    best = F.min_by(F.struct("score", "yield", "r"), F.struct(F.round(F.abs(F.col("yield") - target), 6), F.col("score")))
    return curve.groupBy(*keys).agg(best.alias("p")).select(*keys, "p.*")


def robust_z(rows: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """z: the largest of (value - median) / interquartile range over the values, the range being 1 where it isn't positive."""
    stats = rows.groupBy(*keys).agg(*[F.percentile(v, [0.25, 0.5, 0.75]).alias(f"_q_{v}") for v in values])

    def z(v: str) -> Column:
        q = F.col(f"_q_{v}")
        return (F.col(v) - q[1]) / F.when(q[2] > q[0], q[2] - q[0]).otherwise(1.0)

    each = [z(v) for v in values]
    return rows.join(stats, keys).withColumn("z", F.round(F.greatest(*each) if len(each) > 1 else each[0], 6)).drop(*[f"_q_{v}" for v in values])


def eer(rows: DataFrame, steps: int, width: float) -> DataFrame:
    """Threshold on a grid at which false rejects and false accepts are nearest to each other (accept: score below)."""
    bins = rows.groupBy(F.least(F.floor(F.col("score") / width), F.lit(steps)).alias("bin")).agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    grid = rows.sparkSession.range(steps + 1).withColumnRenamed("id", "bin").join(bins, "bin", "left").na.fill(0)
    upto, whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    far = ratio(F.coalesce(F.sum("pos").over(upto), F.lit(0)), F.sum("pos").over(whole))
    frr = ratio(F.sum("neg").over(whole) - F.coalesce(F.sum("neg").over(upto), F.lit(0)), F.sum("neg").over(whole))
    curve = grid.select((F.col("bin") * width).alias("threshold"), far.alias("far"), frr.alias("frr"))
    best = F.min_by(F.struct("threshold", "far", "frr"), F.struct(F.round(F.abs(F.col("far") - F.col("frr")), 6), F.col("threshold")))
    return curve.agg(best.alias("p")).select("p.*")


def centroids(vectors: DataFrame, key: str) -> DataFrame:
    """Mean vector of each key, scaled to length 1."""
    dims = vectors.select(key, F.posexplode("embedding").alias("i", "x")).groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    mean = dims.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("_v")).select(key, F.col("_v.x").alias("mean"))
    norm = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda s, x: s + x * x))
    return mean.withColumn("_n", norm).select(key, F.transform("mean", lambda x: x / F.col("_n")).alias("centroid"))


#: Most vectors and references that meet in one task.
CHUNK_ROWS, BLOCK_ROWS = 4096, 1024


def best_reference(vectors: DataFrame, references: DataFrame) -> DataFrame:
    """vec_id and best: the largest inner product of each vector (vec_id, embedding) with any reference (ref, ref_vector)
    of another `owner`, if both sides have that column.

    References come in blocks; a vector goes to every block once, in chunks, and meets a whole block in one product. Rows
    grow by the number of blocks, not by pairs.
    """
    owned = "owner" in vectors.columns and "owner" in references.columns
    refs, n = references.count(), vectors.count()
    blocks, chunks = max(1, -(-refs // BLOCK_ROWS)), max(1, -(-n // CHUNK_ROWS))
    owner = F.col("owner").cast("string") if owned else F.lit(None).cast("string")
    left = vectors.select("vec_id", "embedding", owner.alias("owner"), F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = references.select("ref", "ref_vector", owner.alias("owner"), F.pmod(F.xxhash64("ref"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"))

    def product(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"vec_id": [], "best": []}).astype({"vec_id": "int64", "best": "float64"})
        near = np.stack(a["embedding"].to_numpy()).astype(float) @ np.stack(b["ref_vector"].to_numpy()).astype(float).T
        if owned:
            near[a["owner"].to_numpy()[:, None] == b["owner"].to_numpy()[None, :]] = -np.inf
        best = near.max(axis=1)
        return pd.DataFrame({"vec_id": a["vec_id"], "best": best})[best > -np.inf]

    met = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInPandas(product, "vec_id long, best double")
    return met.groupBy("vec_id").agg(F.max("best").alias("best"))


def centroid_scores(vectors: DataFrame, key: str) -> DataFrame:
    """Each vector's cosine to its own key's centroid without the vector itself (null where there is no other vector of
    the key), and to the best centroid of another key."""
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    unit = lambda v: F.transform(v, lambda x: F.try_divide(x, norm(v)))
    rows = vectors.select("vec_id", key, F.col("embedding").cast("array<double>").alias("e"))
    dims = rows.select(key, F.posexplode("e").alias("i", "x")).groupBy(key, "i").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
    sums = dims.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).getField("x").alias("sums"), F.max("n").alias("n"))
    rest = F.zip_with("sums", "e", lambda s, x: s - x)
    dot = F.aggregate(F.zip_with("e", rest, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    own = F.when(F.col("n") > 1, F.try_divide(dot, norm(F.col("e")) * norm(rest)))
    clip = lambda c: F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)), 6)
    mine = rows.join(sums, key).select("vec_id", key, own.alias("own"))
    others = best_reference(
        rows.select("vec_id", F.col(key).alias("owner"), unit(F.col("e")).alias("embedding")), sums.select(F.col(key).alias("ref"), F.col(key).alias("owner"), unit(F.col("sums")).alias("ref_vector"))
    )
    clipped = lambda c: F.when(F.col(c).isNotNull(), clip(F.col(c)))
    return mine.join(others, "vec_id", "left").select("vec_id", key, clipped("own").alias("own"), clipped("best").alias("best_other"))


def first_per_group(rows: DataFrame, keys: list[str], order: list[Column | str], n: int, strict: bool = False) -> DataFrame:
    """The first n rows of each group in order; with strict a group of fewer is an error when they are read."""
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n)
    if strict:
        enough = F.count("*").over(Window.partitionBy(*keys)) == n  # n rows a group at most
        first = first.withColumn("_n", F.when(enough, F.col("_n")).otherwise(F.raise_error(F.lit(f"a group has fewer than {n} rows")).cast("int"))).where("_n IS NOT NULL")
    return first.drop("_n")


def round_robin(rows: DataFrame, strata: list[str], order: list[str], n: int) -> DataFrame:
    """n rows, one of each stratum in turn."""
    turn = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    return rows.withColumn("turn", turn).orderBy("turn", *strata).limit(n)


def disjoint_split(rows: DataFrame, stratum: str, unit: str, test_share: float) -> DataFrame:
    """Units (speakers) go whole to test, in hashed order, until a stratum's test share is reached."""
    units = rows.groupBy(stratum, unit).agg(F.count("*").alias("n"))
    by = Window.partitionBy(stratum)
    before = F.coalesce(F.sum("n").over(by.orderBy(F.md5(F.col(unit).cast("string").cast("binary"))).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return units.withColumn("before", before).withColumn("split", F.when(F.col("before") < test_share * F.sum("n").over(by), "test").otherwise("train"))


def tag_filter(catalog: DataFrame, required: list[str], excluded: list[str], least: float, most: float) -> DataFrame:
    """All required tags, none of the excluded, duration within both limits."""
    arr = lambda x: F.array(*map(F.lit, x)).cast("array<string>")
    tags = (F.size(F.array_except(arr(required), "tags")) == 0) & ~F.arrays_overlap("tags", arr(excluded))
    return catalog.where(tags & F.col("duration_s").between(least, most))


def first_wins(rows: DataFrame, key: str, order: list[str], source: str) -> DataFrame:
    """One row a key, the first in order, with the sorted sources that name it."""
    groups = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("_f"), F.array_sort(F.collect_set(source)).alias("sources"), F.count("*").alias("n"))
    return groups.select(key, "_f.*", "sources", "n")
