"""What the operators of this subpackage share: tables that cut lineage, running totals, names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.sources.scratch import new_path, remove

#: Columns of the documents table, in order.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows in one Arrow batch: long texts come in small batches.
BATCH_ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches of whole texts in rows; Spark bounds them in bytes as well (maxBytesPerBatch, 64 MB unless
    set), so that a worker's memory doesn't follow the length of texts. The setting is the session's and stays, since
    plans are run after the operators return."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: lineage ends here, the rows are computed once,
    and a lost executor costs no more than the read of its files. The shuffle files behind it go as soon as the driver
    has collected its garbage, which is asked for here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(table: DataFrame) -> None:
    """Removes a table of materialise() that nothing reads any more."""
    remove(table.sparkSession, table.written_to)


def column(name: str) -> Column:
    """A column by its plain name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def running(df: DataFrame, group: list[str], order: list[str], value: str, out: str, how: Callable = F.sum) -> DataFrame:
    """Adds `out`: `how` (sum or max) of `value` over the rows before each one in its group, along `order`; null for
    the first.

    No task ever holds a group: rows are dealt by range of (group, order), each range is combined, and so are the
    ranges before. The ranges are fixed by writing them out once. Group columns must not be null.
    """
    ranged = df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy(*group, "_part").agg(how(value).alias("_in_range"))
    ranges = ranges.select(*group, "_part", how("_in_range").over(before).alias("_in_ranges_before"))
    inside = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here, ahead = how(value).over(inside), F.col("_in_ranges_before")
    both = F.when(here.isNull(), ahead).when(ahead.isNull(), here).otherwise(here + ahead if how is F.sum else F.greatest(here, ahead))
    return ranged.join(ranges, [*group, "_part"]).withColumn(out, both).drop("_part", "_in_ranges_before")


def running_totals(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """running() sums, 0 for the first row of a group."""
    return running(df, group, order, value, out).withColumn(out, F.coalesce(out, F.lit(0)))
