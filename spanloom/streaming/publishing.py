"""Publishing what streams bring in: one artifact for each request, and reports that follow the stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException


def request_hash(columns: Sequence[str]) -> Column:
    """What tells requests apart: a digest of the columns' values, nulls and order included."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """All artifacts so far, or None before the first."""
    try:
        return spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def publish(requests: DataFrame, path: str, checkpoint: str, request: Sequence[str], order: Sequence[str], answer: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Writes answer(rows) for each request (the columns `request`) that path doesn't have yet, its first row by `order` only.

    A micro-batch has a folder of its own and overwrites it, so one that is run again after a failure leaves what a single run
    leaves; the hashes of other batches are left out by an anti-join. So each request has exactly one artifact, whatever is
    sent twice or run twice. answer() must keep request_hash.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        hashed = batch.withColumn("request_hash", request_hash(request))
        first = F.min_by(F.struct(*batch.columns), F.struct(*order))
        new = hashed.groupBy("request_hash").agg(first.alias("_row")).select("request_hash", "_row.*")
        if (known := published(batch.sparkSession, path)) is not None:
            new = new.join(known.where(F.col("batch") != batch_id).select("request_hash"), "request_hash", "left_anti")
        answer(new).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_costs(calls: DataFrame, rates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Calls, tokens and cost by model over the whole stream (model, prompt_tokens, output_tokens), with a static card of rates
    (model, prompt_rate, output_rate a million tokens); each micro-batch publishes the report anew as version=<batch>."""
    cost = (F.col("prompt_tokens") * F.col("prompt_rate") + F.col("output_tokens") * F.col("output_rate")) / 1_000_000
    report = calls.join(F.broadcast(rates), "model").groupBy("model").agg(
        F.count("*").alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum(cost.cast("decimal(38,6)")).alias("cost")
    )  # a card has a row a model

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return report.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_report(spark: SparkSession, path: str) -> DataFrame:
    versions = spark.read.option("basePath", path).parquet(f"{path}/version=*")
    return versions.where(F.col("version") == versions.agg(F.max("version")).first()[0]).drop("version")


def finished(query: StreamingQuery) -> None:
    """Waits for a query over what is there; raises what it failed with."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
