"""Merkle manifest of a dataset by superblock reduction.

Each source is a tree over its documents in order of doc_id, and the roots of the sources are the leaves of one tree over
the dataset. A tree's nodes are dealt to superblocks of FANOUT ** LEVELS nodes in a row; applyInPandas collapses LEVELS
levels of a superblock at once, and the roots of superblocks are reduced in the same way until one is left. A leaf's proof
is the proof within its superblock, then that of its superblock in the level above, and so on. So no task ever holds more
than a superblock, whatever the size of a source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm._common import documents, materialise, running_totals

#: Nodes that make a parent; levels that a superblock collapses.
FANOUT, LEVELS = 3, 5

#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

WIDTH = 64


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- a superblock ---


def levels_of(total: int, most: int = LEVELS) -> int:
    """Levels from `total` nodes of a tree to a single one, `most` at most."""
    found = 0
    while total > 1 and found < most:
        total, found = -(-total // FANOUT), found + 1
    return found


def collapse(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a superblock, and those of each level above."""
    rows = [nodes]
    for _ in range(levels):
        below = rows[-1]
        rows.append([digest(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return rows


def proof(rows: list[list[str]], place: int) -> str:
    """The siblings of a node of rows[0] by level, packed: for each level the node's place in its run, the number of
    siblings, and the siblings from left to right."""
    out = []
    for row in rows[:-1]:
        first = place - place % FANOUT
        run = row[first : first + FANOUT]
        at = place - first
        out += [f"{at}{len(run) - 1}", *run[:at], *run[at + 1 :]]
        place //= FANOUT
    return "".join(out)


def siblings(packed: str) -> list[tuple[int, list[str]]]:
    """By level, from the leaf: its place in its run, and its siblings from left to right."""
    out, at = [], 0
    while at < len(packed):
        place, n = int(packed[at]), int(packed[at + 1])
        out.append((place, [packed[i : i + WIDTH] for i in range(at + 2, at + 2 + n * WIDTH, WIDTH)]))
        at += 2 + n * WIDTH
    return out


def fold(leaf: str, packed: str) -> str:
    """The root that a leaf and its proof lead to."""
    for place, others in siblings(packed):
        leaf = digest([*others[:place], leaf, *others[place:]])
    return leaf


# --- trees ---

#: tree and place (from 0) tell a node; total is the number of nodes that its tree has on its level.
_NODE = "tree long, place long, total long, node string"


def _blocks(nodes: DataFrame):
    return nodes.withColumn("block", F.floor(F.col("place") / FANOUT**LEVELS).cast("long")).groupBy("tree", "block")


def _roots(nodes: DataFrame) -> DataFrame:
    """The roots of all superblocks, the nodes of the level that is LEVELS higher."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        tree, total, at = (int(block[c].iloc[0]) for c in ("tree", "total", "block"))
        top = collapse(list(block.sort_values("place")["node"]), levels_of(total))[-1]
        return pd.DataFrame({"tree": [tree], "place": [at], "total": [-(-total // FANOUT**LEVELS)], "node": top})

    return _blocks(nodes).applyInPandas(reduce, _NODE)


def _reduced(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """nodes and all levels above them that superblocks end at; the last one has a node a tree. `largest` is the largest
    total."""
    found = [nodes]
    while largest > 1:
        found.append(materialise(_roots(found[-1]), "superblocks"))
        largest = -(-largest // FANOUT**LEVELS)
    return found


def _proved(nodes: DataFrame, above: DataFrame, carry: dict[str, str], schema: str, finish: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """nodes with their proof, through their superblock and then that of the block's root (above: tree, block, upper and the
    columns of carry). Lower proofs are made where they are wanted and never shuffled."""

    def prove(block: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        rows, first = collapse(list(block["node"]), levels_of(int(block["total"].iloc[0]))), upper.iloc[0]
        out = block.assign(proof=[proof(rows, i) + first["upper"] for i in range(len(block))], **{c: first[c] for c in carry})
        return finish(out)[[f.split()[0] for f in schema.split(", ")]]

    return _blocks(nodes).cogroup(above.groupBy("tree", "block")).applyInPandas(prove, schema)


def _above(levels: list[DataFrame], tops: DataFrame, carry: dict[str, str]) -> DataFrame:
    """(tree, block, upper, *carry): of every superblock of levels[0] the proof of its root up to the top; tops has that of the
    last level's nodes."""
    schema = ", ".join(["tree long", "block long", "upper string", *[f"{c} {t}" for c, t in carry.items()]])
    for nodes in levels[-2:0:-1]:
        tops = _proved(nodes, tops, carry, schema, lambda out: out.drop(columns="block").rename(columns={"place": "block", "proof": "upper"}))
    return tops


# --- the operator ---


def _field(name: str, value: Column | None = None) -> Column:
    text = (F.col(name) if value is None else value).cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column | None = None) -> Column:
    """The leaf of a row with the columns of documents, with another text if given."""
    return F.sha2(F.concat(*[_field(c, text if c == "text" else None) for c in FIELDS]), 256)


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """Of every row doc_id, leaf, changed_leaf (the leaf with the text `changed`, its own by default), subroot (of its source),
    root (of all), proof (packed, see siblings()), proof_sha256 and folded_root, to which the changed leaf and the proof lead.

    A null source is a source, before all others. A null doc_id comes before all others of its source; rows of one doc_id
    follow each other by leaf. Equal rows are leaves of their own. An empty table has no rows. Other columns are ignored.
    """
    leaf = leaf_of()
    rows = docs.select(
        "doc_id", F.col("source").isNotNull().alias("_has"), F.coalesce("source", F.lit("")).alias("_source"), leaf.alias("node"), F.lit(1).cast("long").alias("_one"),
        (leaf if changed is None else leaf_of(changed)).alias("changed_leaf"), F.col("doc_id").isNotNull().alias("_known"), F.coalesce("doc_id", F.lit(0)).alias("_id"),
    )
    counts = rows.groupBy("_has", "_source").agg(F.count("*").alias("total")).select("*", F.lit(0).alias("_all"), F.lit(1).cast("long").alias("_one"))
    sources = materialise(running_totals(counts, ["_all"], ["_has", "_source"], "_one", "tree"), "sources")
    n, largest = (x or 0 for x in sources.agg(F.count("*"), F.max("total")).first())
    placed = running_totals(rows, ["_has", "_source"], ["_known", "_id", "node", "changed_leaf"], "_one", "place")
    nodes = materialise(placed.join(sources.select("_has", "_source", "tree", "total"), ["_has", "_source"]).select("tree", "place", "total", "node", "doc_id", "changed_leaf"), "leaves")
    trees = _reduced(nodes, largest)
    subroots = trees[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(n).cast("long").alias("total"), "node")
    dataset = _reduced(subroots, n)
    top = dataset[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit("").alias("upper"), F.col("node").alias("root"))
    schema = "tree long, block long, upper string, subroot string, root string"
    tops = _proved(subroots, _above(dataset, top, {"root": "string"}), {"root": "string"}, schema, lambda out: out.assign(tree=out["place"], block=0, upper=out["proof"], subroot=out["node"]))
    carry = {"subroot": "string", "root": "string"}

    def folded(out: pd.DataFrame) -> pd.DataFrame:
        return out.assign(leaf=out["node"], proof_sha256=[digest(s for _, row in siblings(p) for s in row) for p in out["proof"]], folded_root=[fold(x, p) for x, p in zip(out["changed_leaf"], out["proof"], strict=True)], doc_id=out["doc_id"].astype("Int64"))

    result = "doc_id long, leaf string, changed_leaf string, subroot string, root string, proof string, proof_sha256 string, folded_root string"
    return _proved(nodes, _above(trees, materialise(tops, "tops"), carry), carry, result, folded)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = manifest(documents(spark, sf_dir), changed)
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(text: str) -> str:
    fields = [text if c == "text" else f"cast({c} AS VARCHAR)" for c in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


_BEFORE, _AFTER = ("string_agg(node, '') OVER (PARTITION BY {by} ORDER BY place ROWS BETWEEN " + r + ")" for r in ("UNBOUNDED PRECEDING AND 1 PRECEDING", "1 FOLLOWING AND UNBOUNDED FOLLOWING"))

#: crc32 has no counterpart in DuckDB: it is worked out bit by bit over the at most 20 characters of a doc_id.
OP13_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, cast(doc_id AS VARCHAR) AS s, 0 AS pos, 4294967295::BIGINT AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, pos + 1, CASE WHEN pos % 9 = 0 THEN xor(c, ascii(s[pos // 9 + 1])::BIGINT) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc WHERE pos < 9 * len(s)),
even AS (SELECT doc_id, xor(c, 4294967295) % 2 = 0 AS even FROM crc WHERE pos = 9 * len(s)),
d AS (SELECT documents.*, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents LEFT JOIN even ON documents.doc_id = even.doc_id),
leaves AS (SELECT doc_id, source, {_sql_leaf("text")} AS leaf, {_sql_leaf("changed")} AS changed FROM d),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS total,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS place FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, place, total, leaf AS node FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 3, (total + 2) // 3, sha256(string_agg(node, '' ORDER BY place)) FROM nodes WHERE total > 1 GROUP BY tree, level, place // 3, total),
subroots AS (SELECT tree, node AS subroot FROM nodes WHERE total = 1),
tops AS (
  SELECT 0 AS level, tree AS place, count(*) OVER () AS total, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, (total + 2) // 3, sha256(string_agg(node, '' ORDER BY place)) FROM tops WHERE total > 1 GROUP BY level, place // 3, total),
near AS (SELECT tree, level, place, coalesce({_BEFORE.format(by="tree, level, place // 3")}, '') AS l, coalesce({_AFTER.format(by="tree, level, place // 3")}, '') AS r FROM nodes WHERE total > 1),
top_near AS (SELECT level, place, coalesce({_BEFORE.format(by="level, place // 3")}, '') AS l, coalesce({_AFTER.format(by="level, place // 3")}, '') AS r FROM tops WHERE total > 1),
steps AS (
  SELECT p.tree, p.place, n.level, n.l, n.r FROM placed p JOIN near n ON p.tree = n.tree AND n.place = p.place // cast(3 ** n.level AS BIGINT)
  UNION ALL
  SELECT p.tree, p.place, 1000 + n.level, n.l, n.r FROM placed p JOIN top_near n ON n.place = p.tree // cast(3 ** n.level AS BIGINT)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree, place ORDER BY level) AS k FROM steps),
proofs AS (SELECT tree, place, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, count(*) AS n FROM steps GROUP BY tree, place),
folds AS (
  SELECT tree, place, 0::BIGINT AS k, changed AS node FROM placed
  UNION ALL
  SELECT f.tree, f.place, n.k, sha256(n.l || f.node || n.r) FROM folds f JOIN numbered n ON f.tree = n.tree AND f.place = n.place AND n.k = f.k + 1)
SELECT p.doc_id, p.leaf, s.subroot, t.node AS root, coalesce(q.proof, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = t.node AS verified
FROM placed p JOIN subroots s ON p.tree = s.tree LEFT JOIN proofs q ON p.tree = q.tree AND p.place = q.place
JOIN folds f ON p.tree = f.tree AND p.place = f.place AND f.k = coalesce(q.n, 0), (SELECT node FROM tops WHERE total = 1) t
"""
