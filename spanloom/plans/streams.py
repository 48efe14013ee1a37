"""Queries that run streams over the tables, each to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import profiles
from spanloom.plans.registry import MERGED, query, turned
from spanloom.sources import tables as S
from spanloom.sources.scratch import new_path
from spanloom.streaming import merging
from spanloom.streaming import publishing as P


def _stream(session, sf, name):
    """A table as a stream of its files. As a pattern its path may be that of a single file, too."""
    return session.readStream.schema(S.table(session, sf, name).schema).parquet(f"{sf}/{name}.parque[t]")


@query("x03_merged_stream", turned("SELECT * FROM merged", *MERGED))
def _(spark, sf):
    """The turns as a stream, with the closing row that ends it: it lies behind all others in time and is no turn."""
    session = merging.with_rocks(spark)
    turns = S.turns_of(_stream(session, sf, "events"), "ts")
    closing, out, checkpoint = (new_path(session, x) for x in ("closing", "merged", "checkpoint"))
    end = session.range(1).select(*[F.lit(None).cast(t).alias(n) for n, t in turns.dtypes])
    end.withColumns({"ts": F.lit("2100-01-01").cast("timestamp_ntz"), "recording_id": F.lit("2100-01-01"), "end_us": F.lit(-1).cast("long")}).write.parquet(closing)
    stream = turns.unionByName(session.readStream.schema(turns.schema).parquet(closing))
    merged = merging.merge_stream(stream, 120_000_000, "1 hour").writeStream.format("parquet").option("path", out)
    P.finished(merged.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return spark.read.schema(merging.MERGED).parquet(out)


@query("x04_published_requests", """WITH c AS (SELECT *, row_number() OVER (PARTITION BY role, text ORDER BY conv_id, turn) AS n FROM conversations)
  SELECT role, conv_id, turn, strlen(text) AS bytes FROM c WHERE n = 1""")
def _(spark, sf):
    """The requests are sent twice in one run, and the run is started again: one artifact each."""
    path, checkpoint = new_path(spark, "published"), new_path(spark, "checkpoint")
    for _ in range(2):
        requests = _stream(spark, sf, "conversations")
        both = requests.unionByName(_stream(spark, sf, "conversations"))
        P.finished(P.publish(both, path, checkpoint, ["role", "text"], ["conv_id", "turn"], lambda new: new.withColumn("bytes", F.octet_length("text").cast("long"))))
    return P.published(spark, path).select("role", "conv_id", "turn", "bytes")


@query("x05_running_costs", """WITH u AS (SELECT 'm' || (l_partkey % 5) AS model, cast(l_quantity AS BIGINT) * 9000 AS p, l_suppkey % 50 * 10 AS o FROM lineitem)
  SELECT model, count(*) AS calls, sum(p)::BIGINT AS prompt_tokens, sum(o)::BIGINT AS output_tokens, sum(((p * (1 + substr(model, 2)::INT) + o * 4)::DOUBLE / 1000000)::DECIMAL(38,6))::DOUBLE AS cost FROM u GROUP BY model""")
def _(spark, sf):
    calls = S.usage_of(_stream(spark, sf, "lineitem")).select("model", "prompt_tokens", "output_tokens")
    rates = spark.range(5).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("model"), (F.col("id") + 1).alias("prompt_rate"), F.lit(4).alias("output_rate"))
    path, checkpoint = new_path(spark, "costs"), new_path(spark, "checkpoint")
    P.finished(P.running_costs(calls, rates, path, checkpoint))
    return P.latest_report(spark, path).withColumn("cost", F.col("cost").cast("double"))


@query("w23_carried_profiles")
def _(spark, sf):
    vectors = S.table(spark, sf, "embeddings")
    windows = vectors.select(F.col("label").alias("recording_id"), F.floor(F.col("vec_id") / 40).alias("window"), F.col("vec_id").alias("local"), "embedding")
    return profiles.carry_speakers(windows, 0.5)
