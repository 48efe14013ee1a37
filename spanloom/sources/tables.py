"""Views over the driver tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Length of a recording (a day) in microseconds.
DAY_US = 86_400_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns_of(table(spark, sf_dir, "events"))


def turns_of(events: DataFrame, *more: str) -> DataFrame:
    """Turns from events: a day is a recording, an event type a speaker; bounds in whole microseconds of the day."""
    start = F.expr("(hour(ts) * 3600 + minute(ts) * 60) * 1000000L + cast(extract(second from ts) * 1000000 as bigint)")
    return events.where("value > 0").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("recording_id"),
        F.col("event_type").alias("speaker_id"),
        "user_id",
        start.alias("start_us"),
        (start + F.round(F.col("value") * 1_000_000).cast("long")).alias("end_us"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("confidence"),
        *more,
    )


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference and candidate decisions for each document; documents without labels have no candidate."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    reject = lambda c: F.when(c, "reject").otherwise("pass")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("key"),
        F.col("lang").alias("family"),
        F.col("source").alias("recording_id"),
        "n_chars",
        (F.col("n_chars") / 15.0).alias("duration_s"),
        reject(F.col("n_chars") < 600).alias("reference"),
        F.when(F.col("quality").isNotNull(), reject((F.col("quality") == 0) | (F.col("toxic") == 1))).alias("candidate"),
        F.when(F.col("quality").isNotNull(), _codes(low_quality=F.col("quality") == 0, toxic=F.col("toxic") == 1)).alias("codes"),
        _codes(low_quality=F.col("n_chars") < 600, toxic=F.contains("text", F.lit("!"))).alias("reference_codes"),
        "text",
    )


def _codes(**given: Column) -> Column:
    """The names of what is true."""
    return F.filter(F.array(*[F.when(c, name) for name, c in given.items()]), lambda x: x.isNotNull())


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled clips with a score: bad is label 1, minutes follow length, clusters are sources."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("clip_id"),
        F.col("source").alias("cluster"),
        (1 - F.col("quality")).alias("label"),
        F.col("n_chars").alias("minutes"),
        (F.col("n_chars") % 97).cast("double").alias("score"),
        (F.col("doc_id") % 7 == 0).alias("pre_gate"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage_of(table(spark, sf_dir, "lineitem"))


def usage_of(lines: DataFrame) -> DataFrame:
    """Calls of a model with their tokens, from lineitem."""
    key, part, supplier, line = (F.col(f"l_{c}") for c in ("orderkey", "partkey", "suppkey", "linenumber"))
    quantity = F.col("l_quantity").cast("long")
    return lines.select(
        (key * 8 + line).alias("call_id"), F.concat(F.lit("m"), (part % 5).cast("string")).alias("model"), F.when(supplier % 3 == 0, "standard").when(supplier % 3 == 1, "batch").otherwise("flex").alias("tier"),
        (quantity * 9000).alias("prompt_tokens"), (supplier % 4 * 3200).alias("audio_tokens"), (part % 7 * 1000).alias("text_tokens"), (key % 6 * 2500).alias("cached_tokens"), (key % 3 * 800).alias("cached_audio_tokens"),
        (supplier % 50 * 10).alias("output_tokens"), (line * 20).cast("long").alias("thinking_tokens"), quantity.alias("minutes"),
    )


# --- the same views in DuckDB ---

RAW_TURNS = """raw AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS recording_id, event_type AS speaker_id, user_id,
  epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS start_us,
  epoch_us(ts) - epoch_us(date_trunc('day', ts)) + cast(round(value * 1000000) AS BIGINT) AS end_us,
  cast(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS confidence FROM events WHERE value > 0)"""
TURNS = RAW_TURNS + """, turns AS (SELECT recording_id,
  row_number() OVER (PARTITION BY recording_id ORDER BY start_us, least(end_us, 86400000000), speaker_id, event_id) - 1 AS turn_index,
  speaker_id, greatest(start_us, 0) AS start_us, least(end_us, 86400000000) AS end_us, confidence, event_id
  FROM raw WHERE least(end_us, 86400000000) > greatest(start_us, 0))"""
VERDICTS = """v AS (SELECT d.doc_id AS key, lang AS family, source AS recording_id, n_chars, n_chars / 15.0::DOUBLE AS duration_s, text,
  CASE WHEN n_chars < 600 THEN 'reject' ELSE 'pass' END AS reference,
  CASE WHEN quality IS NULL THEN NULL WHEN quality = 0 OR toxic = 1 THEN 'reject' ELSE 'pass' END AS candidate, quality, toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
SCORED = """s AS (SELECT d.doc_id AS clip_id, source AS cluster, 1 - quality AS label, n_chars AS minutes,
  cast(n_chars % 97 AS DOUBLE) AS score, d.doc_id % 7 = 0 AS pre_gate FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
