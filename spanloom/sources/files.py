"""Readers and writers of the text formats that datasets come in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.timeline import along, place
from spanloom.sources.tables import DAY_US

AUDIO = "*.{wav,flac,mp3,ogg,m4a}"


def _us(seconds: Column) -> Column:
    return F.round(seconds * 1_000_000).cast("long")


# --- turns ---


def read_rttm(spark: SparkSession, path: str) -> DataFrame:
    """SPEAKER rows of RTTM files as turns; rows with fewer than eight fields or without length are dropped."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select(f.alias("f")).where((F.size("f") >= 8) & (F.col("f")[0] == "SPEAKER"))
    start, length = (F.expr(f"try_cast(f[{i}] as double)") for i in (3, 4))
    turns = rows.select(F.col("f")[1].alias("recording_id"), F.col("f")[7].alias("speaker_id"), _us(start).alias("start_us"), _us(start + length).alias("end_us"))
    return turns.where("end_us > start_us")


def write_rttm(turns: DataFrame, path: str) -> None:
    """Turns as SPEAKER rows, in microseconds' precision."""
    s = lambda c: F.format_string("%.6f", c / 1_000_000)
    fields = [F.lit("SPEAKER"), F.col("recording_id"), F.lit("1"), s(F.col("start_us")), s(F.col("end_us") - F.col("start_us")), F.lit("<NA>"), F.lit("<NA>"), F.col("speaker_id"), F.lit("<NA>"), F.lit("<NA>")]
    turns.select(F.concat_ws(" ", *fields).alias("value")).write.text(path)


def triples_to_turns(rows: DataFrame, triples: str, length_us: int = DAY_US) -> DataFrame:
    """Turns of rows with an array of [start, end, label] strings: clamped to the recording; triples that aren't numbers
    or have no length are dropped."""
    each = rows.select("recording_id", F.explode(triples).alias("_t"))
    number = lambda i: F.col("_t")[i].try_cast("double")
    turns = each.where(number(0).isNotNull() & number(1).isNotNull()).select("recording_id", F.col("_t")[2].alias("speaker_id"), F.greatest(_us(number(0)), F.lit(0)).alias("start_us"), F.least(_us(number(1)), F.lit(length_us)).alias("end_us"))
    return turns.where("end_us > start_us AND speaker_id IS NOT NULL")


LINE = r"^\s*(\d+(?:\.\d+)?)\s+(\d+(?:\.\d+)?)\s+(speaker_\d+)\s*$"


def read_turn_lines(spark: SparkSession, path: str) -> DataFrame:
    """Turns of lines `start end speaker_k`; any other line, or one without length, is an error when it is read."""
    part = lambda i: F.regexp_extract("value", LINE, i)
    start, end = part(1).try_cast("double"), part(2).try_cast("double")
    ok = F.col("value").rlike(LINE) & (end > start)
    checked = F.when(F.coalesce(ok, F.lit(False)), part(3)).otherwise(F.raise_error(F.concat(F.lit("not a turn: "), "value")))
    return spark.read.text(path).select(checked.alias("speaker_id"), _us(start).alias("start_us"), _us(end).alias("end_us"))


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Turns of JSON manifests, one object with turns[] in a file."""
    schema = "recording_id string, duration_s double, complete boolean, turns array<struct<speaker_id:string,start_s:double,end_s:double,confidence:double>>"
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    return docs.select("recording_id", "duration_s", "complete", F.posexplode_outer("turns").alias("turn_index", "_t")).select("recording_id", "duration_s", "complete", "turn_index", "_t.*")


# --- JSON and text ---


def read_json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines that hold a JSON object each; one that doesn't is an error when it is read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_json_objects(rows: DataFrame, path: str) -> None:
    """One JSON object a line. A value that isn't a number becomes null: JSON has none. A task's file appears whole or not
    at all."""
    finite = lambda n: F.when(~F.isnan(n) & (F.abs(F.col(n)) < float("inf")), F.col(n)).alias(n)
    rows.select(*[finite(n) if k in ("double", "float") else F.col(n) for n, k in rows.dtypes]).write.json(path)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a list without blanks and # comments."""
    return spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)")).select(F.trim("value").alias("url"))


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", " ", 2)
    return spark.read.text(path).where(F.length(F.trim("value")) > 0).select(parts[0].alias("key"), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("text"))


def read_responses(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(file, answer) of whole text files."""
    files = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("value").alias("answer"))


# --- CSV ---


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows of CSV files with a header, which may begin with a byte order mark, and exactly these columns; a row of another
    width is an error when it is read."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if [c.lstrip("﻿").strip() for c in raw.columns] != list(columns):
        raise ValueError(f"columns {raw.columns}, not {list(columns)}")
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST").csv(path)


def find_column(names: Sequence[str], wanted: Sequence[str]) -> str:
    """The first of the wanted names that there is, whatever its case."""
    have = {n.strip().lower(): n for n in names}
    for w in wanted:
        if w.lower() in have:
            return have[w.lower()]
    raise ValueError(f"none of {list(wanted)} in {list(names)}")


def write_csv(rows: DataFrame, path: str) -> None:
    """Columns sorted by name, nested ones as JSON text."""
    cell = lambda name, kind: F.to_json(name).alias(name) if kind.startswith(("array", "struct", "map")) else F.col(name)
    rows.select(*[cell(n, k) for n, k in sorted(rows.dtypes)]).write.option("header", True).option("escape", '"').csv(path)


# --- catalogs ---


def read_catalog(spark: SparkSession, path: str, glob: str = AUDIO) -> DataFrame:
    """Path, size and digest of every file below path. A file's bytes come as one row, so files have to fit in a task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def list_files(spark: SparkSession, path: str, output: str, glob: str = AUDIO) -> DataFrame:
    """Path and size of every file below path but for those below output; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "length").where(~F.contains("path", F.lit(output.rstrip("/") + "/")))


def write_index(rows: DataFrame, path: str) -> None:
    """JSON lines in order of (upload_date, title, video_id)."""
    rows.orderBy(F.coalesce("upload_date", F.lit("")), "title", "video_id").write.json(path)


def downloaded(sidecars: DataFrame) -> DataFrame:
    """The sidecars of finished downloads: those with a digest."""
    return sidecars.where((F.col("operation") == "download") & F.col("sha256").isNotNull())


def numbered(rows: DataFrame, order: str, name: str = "stt", width: int = 1 << 20) -> DataFrame:
    """Adds the place of each row, from 1, along a unique number; no task holds all rows."""
    placed = along(rows.withColumn("_all", F.lit(0)), ["_all"], [order], at=order, width=width, **{name: place()})
    return placed.withColumn(name, F.col(name) + 1).drop("_all")

