"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source is a queue of its documents in shuffled order, passed through at most twice. A document's packet of one
pass has the virtual finish time (words of its queue up to its end) / (target of its source). Packets are sorted by
finish time over all sources, and the mix is cut where it reaches the total budget; as every source reaches its target
at time 1, each is cut within about a document of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm._common import column, documents, materialise, running_totals

#: Weights of the sources by rank, repeating; share of all words that the mix has; most passes over a source.
WEIGHTS, SHARE, PASSES = (3, 1, 2), 1.5, 2

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, rank, source_size, target), one row a source; sizes has source and size.

    Targets share SHARE of all words by weight and stop at PASSES times their source's size; what is over is shared
    again by weight until nothing is. That is target = least(limit, weight * level) with one level for all: the largest
    of (budget - limits before) / (weights from here on) along the sources by limit / weight. A row a source is small.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = by_source.withColumn("rank", rank).withColumn("weight", weight).withColumn("limit", PASSES * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.lit(SHARE) * F.sum("source_size").over(Window.partitionBy())
    levelled = ranked.withColumn("_level", (budget - before) / onward).withColumn("level", F.max("_level").over(Window.partitionBy()))
    return levelled.select("source", "rank", "source_size", F.least(F.col("limit").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def mix(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The columns `carry` of every row (all of them by default) with size, source_size, target and taken: the words
    that the mix takes of the row, 0, 1 or 2 times its size.

    A null source is a source, after all others; a null text has size 0 and is never taken. Repeated rows are
    separate documents. The shuffle is the order of md5(doc_id), so reruns agree. A column of docs with the name of a
    result is replaced by it.
    """
    carry = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")] if carry is None else carry
    order = ["_shuffle", "_id", "_size"]
    sized = docs.select(
        F.struct(*[column(c).alias(c) for c in carry]).alias("_row"),
        F.col("source").alias("_source"),
        words().alias("_size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_shuffle"),
        F.coalesce("doc_id", F.lit(-1)).alias("_id"),
    )
    targets = materialise(source_targets(docs.select("source", words().alias("size"))), "targets")
    ranked = sized.join(
        targets.select(F.col("source").alias("_s"), F.col("rank").alias("_rank"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target")),
        F.col("_source").eqNullSafe(F.col("_s")),
    ).drop("_s", "_source")
    queued = running_totals(ranked, ["_rank"], order, "_size", "_before")
    finish = [F.try_divide((F.lit(i) * F.col("_source_size") + F.col("_before") + F.col("_size")).cast("double"), F.col("_target")) for i in range(PASSES)]
    queued = queued.withColumn("_finish", F.array(*finish))
    packets = queued.where("_size > 0 and _target > 0").select(F.explode("_finish").alias("finish"), *order)
    by = ["finish", *order]
    packets = materialise(packets.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "packets")
    along = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = packets.groupBy("_part").agg(F.sum("_size").alias("_sum")).withColumn("_ahead", F.coalesce(F.sum("_sum").over(along), F.lit(0)))
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    cut = parts.where(F.col("_ahead") <= budget).agg(F.max("_part").alias("part"), F.max("_ahead").alias("ahead")).first()
    last = None
    if cut.part is not None:
        inside = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        here = packets.where(F.col("_part") == cut.part).withColumn("_sum", F.sum("_size").over(inside) + F.lit(cut.ahead))
        within = here.where(F.col("_sum") <= budget).agg(F.max(F.struct(*by)).alias("last")).first().last
        last = within or packets.where(F.col("_part") < cut.part).agg(F.max(F.struct(*by)).alias("last")).first().last
    if last is None:
        taken = F.lit(0).cast("long")
    else:
        mark = F.struct(F.lit(last.finish), F.lit(last._shuffle), F.lit(last._id).cast("long"), F.lit(last._size).cast("long"))
        passes = sum((F.struct(F.col("_finish")[i], *map(F.col, order)) <= mark).cast("long") for i in range(PASSES))
        taken = F.when((F.col("_size") > 0) & (F.col("_target") > 0), F.col("_size") * passes).otherwise(F.lit(0)).cast("long")
    return queued.select("_row.*", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), taken.alias("taken"))


def take_mix(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows that it takes, those of two passes twice, with the columns of docs."""
    given = [column(c).alias(c) for c in docs.columns]
    mixed = mix(docs.select(F.struct(*given).alias("_doc"), "doc_id", "text", "source"), ["_doc"])
    return mixed.where("taken > 0").select("_doc", F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int")))).select("_doc.*")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir).select("doc_id", "text", "source"), ["doc_id"])


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(cast(doc_id AS VARCHAR), '')) AS shuffle,
         cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, cast(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, [3, 1, 2][(rnk - 1) % 3 + 1] AS weight, 2 * source_size AS lim FROM sources),
levels AS (
  SELECT max((budget - before) / onward) AS level FROM (
    SELECT 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS budget,
      cast(coalesce(sum(lim) OVER (ORDER BY lim::DOUBLE / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before,
      cast(sum(weight) OVER (ORDER BY lim::DOUBLE / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS onward
    FROM weighted)),
targets AS (SELECT source, rnk, source_size, least(lim::DOUBLE, weight * level) AS target FROM weighted, levels),
queued AS (
  SELECT s.doc_id, s.size, s.shuffle, t.rnk, t.source_size, t.target,
    cast(coalesce(sum(s.size) OVER (PARTITION BY t.rnk ORDER BY s.shuffle, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
packets AS (
  SELECT *, (pass * source_size + before + size)::DOUBLE / target AS finish
  FROM queued, (VALUES (0), (1)) p(pass) WHERE size > 0 AND target > 0),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, shuffle, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM packets),
taken AS (
  SELECT doc_id, rnk, before, sum(size) AS taken FROM ordered
  WHERE upto <= (SELECT sum(target) FROM targets) GROUP BY doc_id, rnk, before)
SELECT q.doc_id, q.size, q.source_size, q.target, cast(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id = t.doc_id AND q.rnk = t.rnk AND q.before = t.before
"""
