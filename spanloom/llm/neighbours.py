"""Approximate nearest neighbours: NN-descent builds a neighbour graph, queries search it greedily.

Nodes are the distinct vectors; vectors of one length are compared with each other only. The graph starts from two
deals of random groups, in which every node takes the others as neighbours, up to DEGREE. Each round joins every node's neighbours and a
sample of the nodes that have it as neighbour with their vectors, compares them with each other (neighbours of
neighbours), and keeps each node's DEGREE best. A round never lists a node's pairs: of one comparison a node gets the
PROPOSALS best that beat its worst neighbour. Rounds end when less than SETTLED of all neighbours are new, or after ROUNDS.

A query starts at its own node. Each round looks at the STEP best nodes of its beam that it hasn't looked at, by a join
of (query, node) with the graph, where a node carries its neighbours' vectors in eight bits a component, and keeps the
BEAM best. The beam is scored exactly, in double precision, at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm._common import discard, materialise

#: Neighbours of a node and sample of the nodes that have it; proposals of one comparison; rounds of descent.
DEGREE, REVERSE, PROPOSALS, ROUNDS = 36, 36, 4, 12

#: Share of new neighbours in the graph under which a round is the last.
SETTLED = 0.01

#: Nodes that a query keeps and looks at in a round; rounds of search.
BEAM, STEP = 160, 48

#: Queries are the rows whose vec_id this divides; results of each.
EVERY, RESULTS = 20, 20


def takes_part(vector: str = "embedding") -> Column:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _code(vectors: pd.Series) -> pd.Series:
    """Eight bits a component, after the scale."""
    out = []
    for v in vectors:
        v = np.asarray(v, dtype=np.float64)
        scale = np.abs(v).max() / 127
        out.append(np.float32(scale).tobytes() + np.rint(v / scale).astype(np.int8).tobytes())
    return pd.Series(out)


def _decode(codes: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes), dtype=np.uint8).reshape(len(codes), -1)
    return raw[:, 4:].view(np.int8).astype(np.float32) * raw[:, :4].copy().view(np.float32)


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(node, vector, code, dim, members): distinct vectors, with their length and the RESULTS + 1 smallest vec_id of each."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).where(takes_part("vector") & F.col("vec_id").isNotNull()).distinct()
    rows = rows.withColumn("node", F.xxhash64("vector"))
    order = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    few = rows.withColumn("_n", order).where(F.col("_n") <= RESULTS + 1)
    grouped = few.groupBy("node").agg(F.array_sort(F.collect_list("vec_id")).alias("members"), F.first("vector").alias("vector"))
    return grouped.withColumn("dim", F.size("vector")).withColumn("code", F.pandas_udf(_code, "binary")("vector"))


def _compare(groups: DataFrame, most: int = PROPOSALS) -> DataFrame:
    """(a, b, near) from groups (array members of node, code, worst): of each member the `most` best others that beat its
    worst."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for members in batch["members"]:
                ids = np.fromiter((m["node"] for m in members), np.int64, len(members))
                if len(ids) < 2:
                    continue
                v = _decode([m["code"] for m in members])
                near = v @ v.T
                worst = np.fromiter((m["worst"] for m in members), np.float32, len(members))
                near[near <= worst[:, None]] = -np.inf
                np.fill_diagonal(near, -np.inf)
                k = min(most, len(ids) - 1)
                best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                value = np.take_along_axis(near, best, 1)
                good = value > -np.inf
                found.append((np.repeat(ids, good.sum(1)), ids[best][good], value[good]))
            a, b, near = map(np.concatenate, zip(*found, strict=True)) if found else ([], [], [])
            yield pd.DataFrame({"a": np.asarray(a, np.int64), "b": np.asarray(b, np.int64), "near": np.asarray(near, np.float32)})

    return groups.select("members").mapInPandas(compare, "a long, b long, near float")


def _best(pairs: DataFrame) -> DataFrame:
    """(node, near: array of (near, b) from the best): each node's DEGREE best neighbours."""
    once = pairs.groupBy("a", "b").agg(F.max("near").alias("near"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("near"), "b"))
    few = once.withColumn("_n", rank).where(F.col("_n") <= DEGREE)
    return few.groupBy(F.col("a").alias("node")).agg(F.sort_array(F.collect_list(F.struct("near", "b")), asc=False).alias("near"))


def _around(graph: DataFrame) -> DataFrame:
    """(c, m): each node's neighbours, and of the nodes that have it as neighbour REVERSE by hash."""
    out = graph.select(F.col("node").alias("c"), F.explode("near.b").alias("m"))
    rank = F.row_number().over(Window.partitionBy("m").orderBy(F.xxhash64("c", "m")))
    back = out.withColumn("_n", rank).where(F.col("_n") <= REVERSE).select(F.col("m").alias("c"), F.col("c").alias("m"))
    return out.union(back).distinct()


def neighbour_graph(nodes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, near) by NN-descent over nodes (node, code, dim)."""
    groups = nodes.groupBy("dim").agg(F.greatest(F.lit(1), F.floor(F.count("*") / DEGREE)).alias("_groups"))
    # groups of two deals: within one deal, neighbours of neighbours would never leave their group
    deals = F.explode(F.array(F.lit(1), F.lit(2))).alias("_deal")
    dealt = nodes.join(groups, "dim").select("*", deals).withColumn("g", F.pmod(F.xxhash64("node", "_deal"), F.col("_groups")))
    members = dealt.groupBy("dim", "_deal", "g").agg(F.collect_list(F.struct("node", "code", F.lit(float("-inf")).cast("float").alias("worst"))).alias("members"))
    graph = materialise(_best(_compare(members, DEGREE)), "graph")
    size = nodes.count()
    for _ in range(rounds):
        worst = F.when(F.size("near") >= DEGREE, F.col("near")[DEGREE - 1]["near"]).otherwise(F.lit(float("-inf"))).cast("float")
        known = nodes.select("node", "code").join(graph.select("node", worst.alias("worst")), "node")
        around = _around(graph).join(known, F.col("m") == F.col("node"))
        members = around.groupBy("c").agg(F.collect_list(F.struct("node", "code", "worst")).alias("members"))
        now = graph.select(F.col("node").alias("a"), F.explode("near").alias("_x")).select("a", F.col("_x.b").alias("b"), F.col("_x.near").alias("near"))
        after = materialise(_best(_compare(members).union(now)), "graph")
        kept = after.select("node", F.col("near.b").alias("now")).join(graph.select("node", F.col("near.b").alias("was")), "node", "left")
        new = kept.agg(F.sum(F.size(F.array_except("now", F.coalesce("was", F.array().cast("array<long>"))))).alias("n")).first().n
        discard(graph)
        graph = after
        if not new or new < SETTLED * DEGREE * size:
            break
    return graph


def _looked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nearness of a node's neighbours to a query: the BEAM best of each look."""
    for batch in batches:
        out = []
        for q, own, ids, codes in zip(batch["q"], batch["own"], batch["ids"], batch["codes"], strict=True):
            near = _decode(list(codes)) @ _decode([own])[0]
            best = np.argsort(-near, kind="stable")[:BEAM]
            out.append((q, np.asarray(ids)[best], near[best]))
        yield pd.DataFrame(out, columns=["q", "ids", "nears"])


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Takes what the looks found into a query's beam; next are the STEP best that weren't looked at."""
    for batch in batches:
        out = []
        for q, own, beam, seen, ids, nears in zip(batch["q"], batch["own"], batch["beam"], batch["seen"], batch["ids"], batch["nears"], strict=True):
            value: dict[int, float] = {}
            for some, x in zip(ids if ids is not None else (), nears if nears is not None else (), strict=True):
                value.update(zip(map(int, some), map(float, x), strict=True))
            value |= {b["id"]: b["near"] for b in beam}
            kept = sorted(value.items(), key=lambda kv: (-kv[1], kv[0]))[:BEAM]
            looked = set(map(int, seen))
            front = [i for i, _ in kept if i not in looked][:STEP]
            out.append((q, own, [{"id": i, "near": x} for i, x in kept], sorted(looked & {i for i, _ in kept} | set(front)), front))
        yield pd.DataFrame(out, columns=["q", "own", "beam", "seen", "front"])


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """(q, id): the beam that greedy search ends with for each query node (column node).

    A search ends when no node of its beam is left to look at: what has left a beam never comes back, so it does end. The
    query's own node always stays in its beam, as rows equal to the query are found with it.
    """
    links = _around(graph).join(nodes.select(F.col("node").alias("m"), "code"), "m")
    inline = materialise(links.groupBy(F.col("c").alias("node")).agg(F.collect_list("m").alias("ids"), F.collect_list("code").alias("codes")), "inline")
    state_type = "q long, own binary, beam array<struct<id:long,near:float>>, seen array<long>, front array<long>"
    start = queries.select("node").distinct().join(nodes.select("node", "code"), "node")
    self_near = F.lit(float("inf")).cast("float")
    state = materialise(
        start.select(
            F.col("node").alias("q"), F.col("code").alias("own"), F.array(F.struct(F.col("node").alias("id"), self_near.alias("near"))).alias("beam"),
            F.array("node").alias("seen"), F.array("node").alias("front"),
        ),
        "state",
    )
    while True:
        looks = state.select("q", "own", F.explode("front").alias("node")).join(inline, "node").select("q", "own", "ids", "codes")
        found = looks.mapInPandas(_looked, "q long, ids array<long>, nears array<float>")
        found = found.groupBy("q").agg(F.collect_list("ids").alias("ids"), F.collect_list("nears").alias("nears"))
        after = materialise(state.drop("front").join(found, "q", "left").mapInPandas(_merged, state_type), "state")
        discard(state)
        state = after
        if not state.where(F.size("front") > 0).limit(1).count():
            break
    return state.select("q", F.explode("beam.id").alias("id"))


def nearest(vectors: DataFrame, results: int = RESULTS, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the `results` nearest rows found of each row whose vec_id `every` divides, by
    inner product in double precision, ties to the smaller vec_id.

    Vectors that are null, zero, or that hold a null or non-finite component take no part, nor do rows without vec_id. A
    query's candidates are the vectors of its length. Repeated rows count once; other columns are ignored. Equal vectors
    share a node: all of them, as far as they can be among a query's results, are found with it. Up to DEGREE + 1 distinct
    vectors are all each other's neighbours, so that all are found.
    """
    nodes = materialise(nodes_of(vectors), "nodes")
    queries = vectors.where((F.col("vec_id") % every == 0) & takes_part()).select("vec_id", F.xxhash64(F.col("embedding").cast("array<double>")).alias("node")).distinct()
    queries = queries.join(nodes.select("node"), "node", "left_semi")
    beams = search(queries, nodes, neighbour_graph(nodes.select("node", "code", "dim")))
    pairs = beams.join(nodes.select(F.col("node").alias("q"), F.col("vector").alias("own")), "q").join(nodes.select(F.col("node").alias("id"), "vector", "members"), "id")
    score = F.aggregate(F.zip_with("own", "vector", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = pairs.select("q", "members", score.alias("score"))
    rank = Window.partitionBy("q").orderBy(F.desc("score"), F.col("members")[0])
    scored = scored.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= results + 1)
    rows = queries.select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")).join(scored, "q")
    rows = rows.select("query_id", "score", F.explode("members").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= results).select("query_id", "rank", "vec_id", "score")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
