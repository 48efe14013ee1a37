"""Queries that write a table in one of the formats and read it again; the registry loads them."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.plans.registry import query, turned, turns
from spanloom.sources import files as X
from spanloom.sources import scratch
from spanloom.sources import tables as S


@query("s12_rttm", turned("SELECT recording_id, speaker_id, start_us, end_us FROM turns"))
def _(spark, sf):
    X.write_rttm(turns(spark, sf), path := scratch.new_path(spark, "rttm"))
    return X.read_rttm(spark, path)


@query("s13_triples", "SELECT event_id::VARCHAR AS recording_id, event_type AS speaker_id, greatest(cast(round((event_id % 50 - 5) * 1000000) AS BIGINT), 0) AS start_us, cast(round((event_id % 50 + 2) * 1000000) AS BIGINT) AS end_us FROM events WHERE event_id % 11 <> 0 AND event_id % 50 + 2 > 0")
def _(spark, sf):
    n = F.col("event_id") % 50
    start = F.when(F.col("event_id") % 11 == 0, "x").otherwise((n - 5).cast("string"))
    rows = S.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("recording_id"), F.array(F.array(start, (n + 2).cast("string"), F.col("event_type"))).alias("triples"))
    return X.triples_to_turns(rows, "triples")


@query("s14_turn_lines", turned("SELECT 'speaker_' || (event_id % 5) AS speaker_id, start_us, end_us FROM turns"))
def _(spark, sf):
    s = lambda c: F.format_string("%.6f", F.col(c) / 1_000_000)
    lines = turns(spark, sf).select(F.concat_ws(" ", s("start_us"), s("end_us"), F.concat(F.lit("speaker_"), (F.col("event_id") % 5).cast("string"))).alias("value"))
    lines.write.text(path := scratch.new_path(spark, "lines"))
    return X.read_turn_lines(spark, path)


@query("s02_manifests", turned("SELECT recording_id, turn_index, speaker_id, start_us FROM turns"))
def _(spark, sf):
    turn = F.struct("speaker_id", (F.col("start_us") / 1_000_000).alias("start_s"), (F.col("end_us") / 1_000_000).alias("end_s"), "confidence")
    each = turns(spark, sf).groupBy("recording_id").agg(F.array_sort(F.collect_list(F.struct("turn_index", turn.alias("t")))).getField("t").alias("turns"))
    each.write.json(path := scratch.new_path(spark, "manifests"))
    lines = spark.read.schema("recording_id string, turns array<struct<speaker_id:string,start_s:double,end_s:double,confidence:double>>").json(path)
    out = lines.select("recording_id", F.posexplode("turns").alias("turn_index", "t"))
    return out.select("recording_id", "turn_index", "t.speaker_id", F.round(F.col("t.start_s") * 1_000_000).cast("long").alias("start_us"))


@query("s03_json_lines", "SELECT event_id, CASE WHEN event_id % 7 > 0 THEN event_id / 4 END AS x FROM events")
def _(spark, sf):
    """Also S04."""
    rows = S.table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("event_id") / 4).alias("x"))
    X.write_json_objects(rows, path := scratch.new_path(spark, "json"))
    return X.read_json_objects(spark, path, "event_id long, x double")


@query("s05_download_index", "SELECT page_id::VARCHAR AS video_id, url AS title, md5(html) AS sha256 FROM pages WHERE page_id % 4 > 0")
def _(spark, sf):
    pages = S.table(spark, sf, "pages")
    sidecars = pages.select(
        F.col("page_id").cast("string").alias("video_id"), F.col("url").alias("title"), F.lit(None).cast("string").alias("upload_date"), F.when(F.col("page_id") % 4 == 1, "download").otherwise("download").alias("operation"),
        F.when(F.col("page_id") % 4 > 0, F.md5(F.col("html").cast("binary"))).alias("sha256"),
    )
    X.write_index(X.downloaded(sidecars), path := scratch.new_path(spark, "index"))
    return spark.read.schema("video_id string, title string, sha256 string").json(path)


@query("s06_csv", "SELECT doc_id::VARCHAR AS doc_id, source, '[\"' || lang || '\",\"' || source || '\"]' AS tags, text FROM documents")
def _(spark, sf):
    """Also S07."""
    docs = S.table(spark, sf, "documents").select("doc_id", "source", F.array("lang", "source").alias("tags"), "text")
    X.write_csv(docs, path := scratch.new_path(spark, "csv"))
    return X.read_csv(spark, path, ["doc_id", "source", "tags", "text"])


@query("s09_prompts", "SELECT 'p' || doc_id AS key, md5(text) AS text FROM documents WHERE NOT contains(text, chr(10)) AND NOT contains(text, chr(13)) AND trim(text) <> ''")
def _(spark, sf):
    docs = S.table(spark, sf, "documents").where(~F.contains("text", F.lit("\n")) & ~F.contains("text", F.lit("\r")) & (F.trim("text") != ""))
    docs.select(F.concat(F.lit("p"), F.col("doc_id").cast("string"), F.lit(" "), "text").alias("value")).write.text(path := scratch.new_path(spark, "prompts"))
    return X.read_prompts(spark, path).select("key", F.md5(F.col("text").cast("binary")).alias("text"))


@query("s10_url_list", "SELECT url FROM pages WHERE page_id % 3 = 0")
def _(spark, sf):
    k = F.col("page_id") % 3
    lines = S.table(spark, sf, "pages").select(F.when(k == 0, F.concat(F.lit("  "), "url")).when(k == 1, F.concat(F.lit("# "), "url")).otherwise("   ").alias("value"))
    lines.write.text(path := scratch.new_path(spark, "urls"))
    return X.read_url_list(spark, path)


@query("s11_responses", "SELECT doc_id::VARCHAR AS transcript FROM labels")
def _(spark, sf):
    from spanloom.functions.text import transcript

    lines = S.table(spark, sf, "labels").select(F.concat(F.lit("transcript: "), F.col("doc_id").cast("string")).alias("value"))
    lines.repartition(3).write.text(path := scratch.new_path(spark, "responses"))
    answers = X.read_responses(spark, path).select(F.explode(F.split("answer", "\n")).alias("line")).where("line <> ''")
    return answers.select(transcript(F.col("line")).alias("transcript"))


@query("w31_numbered", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS stt FROM documents")
def _(spark, sf):
    return X.numbered(S.table(spark, sf, "documents").select("doc_id"), "doc_id").select("doc_id", "stt")


@query("s23_digests")
def _(spark, sf):
    """Also S01: files below a folder, but for those of the output, with size and digest."""
    S.table(spark, sf, "pages").select("html").repartition(3).write.text(path := scratch.new_path(spark, "files"))
    files = X.list_files(spark, path, f"{path}/out", "*.txt").select("path")
    return X.read_catalog(spark, path, "*.txt").join(files, "path").select("length", "sha256")
