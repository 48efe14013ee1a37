"""Queries on cuts, collars, adaptive gaps, stitched windows, signals and learned heads; the registry loads them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions import signal as G
from spanloom.functions import splitters
from spanloom.operators import folds, heads, judging
from spanloom.operators import intervals as I
from spanloom.operators import planning as P
from spanloom.operators.timeline import along, following, upto_sum
from spanloom.plans.alignment import WORDS, frames, words, words_of
from spanloom.plans.registry import ORACLES, query, turned, turns, union_cte
from spanloom.sources.scratch import settled
from spanloom.sources import tables as S

FRAME_US = 1_000_000
#: A probability for each second in which somebody speaks, from a hash both engines have.
QUIET = "fr AS (SELECT recording_id, frame, ('0x' || substr(md5(recording_id || ':' || frame), 1, 4))::BIGINT % 100 AS p FROM (SELECT DISTINCT recording_id, unnest(generate_series(start_us // 1000000, (end_us + 999999) // 1000000 - 1)) AS frame FROM turns))"
LOW = "lo AS (SELECT recording_id, min(frame) * 1000000 AS s, (max(frame) + 1) * 1000000 AS e FROM (SELECT *, frame - row_number() OVER (PARTITION BY recording_id ORDER BY frame) AS g FROM fr WHERE p < 60) GROUP BY recording_id, g)"


def seconds(spark, sf) -> DataFrame:
    return seconds_of(turns(spark, sf))


def seconds_of(t) -> DataFrame:
    frame = lambda c: c * FRAME_US
    # of the turns that begin in a second the longest has the frames of all; their unions have each frame once
    spans = t.groupBy("recording_id", frame(F.floor(F.col("start_us") / FRAME_US)).alias("start_us")).agg(frame(F.max(F.ceil(F.col("end_us") / FRAME_US))).alias("end_us"))
    spoken = I.islands(spans, ["recording_id"])
    spoken = spoken.select("recording_id", I.frames_of(spoken, FRAME_US).alias("frame"))
    digest = F.substring(F.md5(F.concat_ws(":", "recording_id", F.col("frame").cast("string")).cast("binary")), 1, 4)
    return spoken.withColumn("p", F.conv(digest, 16, 10).cast("long") % 100)


def word_pairs(spark, sf) -> DataFrame:
    """Neighbouring words of a recording."""
    w = along(words(spark, sf), ["recording_id"], ["start_us", "end_us", "word_id"], _n=following(F.struct("start_us", "end_us")))
    pair = w.where("_n IS NOT NULL").select("recording_id", F.col("word_id").alias("pair"), F.col("start_us").alias("left_start_us"), F.col("end_us").alias("left_end_us"), "_n.*")
    return pair.withColumnsRenamed({"start_us": "right_start_us", "end_us": "right_end_us"})


PAIRS = "wp AS (SELECT * FROM (SELECT recording_id, word_id AS pair, start_us AS ls, end_us AS le, lead(start_us) OVER w AS rs, lead(end_us) OVER w AS re FROM words WINDOW w AS (PARTITION BY recording_id ORDER BY start_us, end_us, word_id)) WHERE rs IS NOT NULL)"


@query("w15_cut_candidates", turned("""SELECT recording_id, pair, a AS pause_start_us, b AS pause_end_us, (a + b) // 2 AS cut_us FROM (SELECT *, row_number() OVER (PARTITION BY recording_id, pair ORDER BY abs(a + b - le - rs), a) AS n FROM (
  SELECT x.recording_id, x.pair, x.le, x.rs, greatest(x.lo * 1000000, lo.s) AS a, least(x.hi * 1000000, lo.e) AS b FROM (SELECT *, (greatest(ls, le - 3000000) + 999999) // 1000000 AS lo, least(re, rs + 3000000) // 1000000 AS hi FROM wp) x JOIN lo ON lo.recording_id = x.recording_id AND lo.s < x.hi * 1000000 AND lo.e > x.lo * 1000000)
  WHERE b - a >= 2000000) WHERE n = 1""", WORDS, PAIRS, QUIET, LOW.replace("GROUP BY recording_id, g)", "GROUP BY recording_id, g HAVING count(*) >= 2)")))
def _(spark, sf):
    found = P.cut_candidates(word_pairs(spark, sf), seconds(spark, sf), FRAME_US, 3_000_000, 60, 2)
    return found.select("recording_id", "pair", "pause_start_us", "pause_end_us", "cut_us")


RUNS = """ru AS (SELECT recording_id, min(turn_index) AS run, min(start_us) AS speaker_from, max(end_us) AS speaker_to, min(start_us) + 700000 AS f, max(end_us) - 700000 AS t FROM (SELECT *, sum(b) OVER (PARTITION BY recording_id ORDER BY turn_index ROWS UNBOUNDED PRECEDING) AS run FROM (
  SELECT *, CASE WHEN speaker_id = lag(speaker_id) OVER w AND start_us - lag(end_us) OVER w BETWEEN 0 AND 300000000 THEN 0 ELSE 1 END AS b FROM turns WINDOW w AS (PARTITION BY recording_id ORDER BY turn_index))) GROUP BY recording_id, run)"""


def speaker_runs(spark, sf) -> DataFrame:
    order = ["start_us", "turn_index"]
    from spanloom.operators.timeline import previous

    near = along(turns(spark, sf), ["recording_id"], order, _s=previous("speaker_id"), _e=previous("end_us"))
    fresh = F.when((F.col("speaker_id") == F.col("_s")) & (F.col("start_us") - F.col("_e")).between(0, 300_000_000), 0).otherwise(1)
    runs = along(near.withColumn("_b", fresh), ["recording_id"], order, _run=upto_sum("_b")).groupBy("recording_id", "_run")
    out = runs.agg(F.min("turn_index").alias("run"), F.min("start_us").alias("speaker_from_us"), F.max("end_us").alias("speaker_to_us")).drop("_run")
    return out.withColumn("from_us", F.col("speaker_from_us") + 700_000).withColumn("to_us", F.col("speaker_to_us") - 700_000)


@query("w16_run_edges", turned("""SELECT recording_id, run, greatest(speaker_from, least(f, coalesce(onset, f)) - 100000) AS start_us, least(speaker_to, greatest(t, coalesce(offs, t)) + 100000) AS end_us FROM ru LEFT JOIN (
  SELECT x.recording_id, x.run, min(CASE WHEN fr.frame * 1000000 < f THEN greatest(a, fr.frame * 1000000) END) AS onset, max(CASE WHEN (fr.frame + 1) * 1000000 > t THEN least(b, (fr.frame + 1) * 1000000) END) AS offs
  FROM (SELECT *, greatest(speaker_from, f - 500000) AS a, least(speaker_to, t + 500000) AS b FROM ru) x JOIN fr ON fr.recording_id = x.recording_id AND fr.p >= 60 AND fr.frame * 1000000 < greatest(b, a + 1) AND (fr.frame + 1) * 1000000 > a GROUP BY ALL) USING (recording_id, run)""", QUIET, RUNS))
def _(spark, sf):
    return P.protected_edges(speaker_runs(spark, sf), seconds(spark, sf), FRAME_US, 500_000, 100_000, 60)


@query("w17_planned_runs")
def _(spark, sf):
    runs = speaker_runs(spark, sf).select("recording_id", "run", F.col("speaker_from_us").alias("start_us"), F.col("speaker_to_us").alias("end_us"))
    found = P.cut_candidates(word_pairs(spark, sf), seconds(spark, sf), FRAME_US, 3_000_000, 60, 2)
    points = found.select("recording_id", (F.col("pair") % 3 == 0).alias("b_sentence"), F.col("cut_us").alias("b_start_us"), (F.col("cut_us") + 1).alias("b_end_us"))
    cuts = I.range_join(runs, points, ["recording_id"]).select("recording_id", "run", F.col("b_start_us").alias("cut_us"), F.col("b_sentence").alias("sentence"))
    return P.plan_runs(runs, cuts, (7_000_000, 10_000_000), (1_500_000, 15_000_000))


@query("w11_word_segments")
def _(spark, sf):
    t = settled(turns(spark, sf).select("event_id", "recording_id", "turn_index", "start_us", "end_us"))
    said = words_of(t).withColumn("sentence", F.col("word_id") % 5 == 0)
    return P.segment_at_words(t, said, 1_000_000, 10_000_000, 0, 0)


SPLIT = ["""pc AS (SELECT recording_id, turn_index, start_us // 1000000 AS a, end_us // 1000000 AS b FROM turns WHERE end_us // 1000000 - start_us // 1000000 > 30
  UNION ALL SELECT recording_id, turn_index, CASE WHEN side = 0 THEN a ELSE k END, CASE WHEN side = 0 THEN k ELSE b END FROM (
    SELECT pc.recording_id, pc.turn_index, a, b, min(fr.p) AS low, arg_min(fr.frame, (fr.p, abs(2 * fr.frame - a - b), fr.frame)) AS k FROM pc JOIN fr ON fr.recording_id = pc.recording_id AND fr.frame > a AND fr.frame < b WHERE b - a > 30 GROUP BY ALL), (VALUES (0), (1)) s(side) WHERE low < 50)""",
"""seg AS (SELECT recording_id, turn_index, a AS first_frame, b AS end_frame, b - a <= 30 AS fits FROM pc WHERE b - a <= 30 OR (SELECT min(p) FROM fr WHERE fr.recording_id = pc.recording_id AND fr.frame > a AND fr.frame < b) >= 50)"""]


def _bounds(spark, sf):
    return settled(turns(spark, sf).select("recording_id", "turn_index", "start_us", "end_us"))


def _segments(t):
    return folds.plan_segments(t, seconds_of(t).withColumn("p", F.col("p") / 100), FRAME_US, 30, 0.5)


@query("w12_plan_segments", turned("SELECT * FROM seg", QUIET, *SPLIT).replace("WITH", "WITH RECURSIVE", 1))
def _(spark, sf):
    return _segments(_bounds(spark, sf))


@query("w12_quiet_cuts_by_sql", ORACLES["w12_plan_segments"])
def _(spark, sf):
    splitters.register(spark)
    t = _bounds(spark, sf)
    tracks = folds.tracks(t, seconds_of(t), FRAME_US, 30)
    return spark.sql("SELECT * FROM quiet_cuts(TABLE(SELECT * FROM {tracks}) PARTITION BY (recording_id, part), 30, 50.0D)", tracks=tracks)


@query("w19_windows_by_sql", ORACLES["w19_sliding_windows"])
def _(spark, sf):
    splitters.register(spark)
    return spark.sql("SELECT * FROM sliding_windows(TABLE(SELECT recording_id, turn_index, start_us, end_us FROM {turns}), 20000000, 7500000)", turns=turns(spark, sf))


@query("w13_split_with_lineage", turned("""SELECT s.recording_id, s.turn_index AS parent, CASE WHEN first_frame = f THEN start_us ELSE first_frame * 1000000 END AS start_us, CASE WHEN end_frame = l THEN end_us ELSE end_frame * 1000000 END AS end_us, true AS split
  FROM seg s JOIN sn ON s.recording_id = sn.recording_id AND s.turn_index = sn.turn_index JOIN turns t ON s.recording_id = t.recording_id AND s.turn_index = t.turn_index
  UNION ALL SELECT recording_id, turn_index, start_us, end_us, false FROM turns t WHERE NOT EXISTS (SELECT 1 FROM sn WHERE sn.recording_id = t.recording_id AND sn.turn_index = t.turn_index)""",
  QUIET, *SPLIT, "sn AS (SELECT recording_id, turn_index, min(first_frame) AS f, max(end_frame) AS l FROM seg GROUP BY ALL HAVING count(*) > 1)").replace("WITH", "WITH RECURSIVE", 1))
def _(spark, sf):
    t = _bounds(spark, sf)
    return P.split_with_lineage(t, _segments(t), FRAME_US)


NEAR = """nb AS (SELECT *, lead(start_us) OVER (PARTITION BY recording_id ORDER BY turn_index) AS nx,
  (SELECT CASE WHEN count(*) > 0 THEN greatest(t.start_us - max(b.end_us), 0) END FROM turns b WHERE b.recording_id = t.recording_id AND b.speaker_id <> t.speaker_id AND (b.start_us, b.turn_index) < (t.start_us, t.turn_index)) AS b,
  (SELECT CASE WHEN count(*) > 0 THEN greatest(min(b.start_us) - t.end_us, 0) END FROM turns b WHERE b.recording_id = t.recording_id AND b.speaker_id <> t.speaker_id AND (b.start_us, b.turn_index) > (t.start_us, t.turn_index)) AS a FROM turns t)"""


@query("w08_context_collar", turned("""SELECT recording_id, turn_index, s AS start_us, e AS end_us, kept AS tail_kept FROM (SELECT recording_id, turn_index, NOT coalesce(a < 8000000, false) AS kept,
  CASE WHEN b < 8000000 THEN start_us + 100000 + CASE WHEN b < 4000000 THEN (4000000 - b) // 2 ELSE 0 END ELSE start_us END AS s,
  CASE WHEN a < 8000000 THEN end_us - 100000 - CASE WHEN a < 4000000 THEN (4000000 - a) // 2 ELSE 0 END ELSE least(end_us + 27000, coalesce(nx - 50000, end_us + 27000), coalesce(end_us + a - 50000, end_us + 27000)) END AS e FROM nb) WHERE e - s >= 500000""", NEAR))
def _(spark, sf):
    return P.context_collar(turns(spark, sf), 100_000, 8_000_000, 4_000_000, 27_000, 500_000)


@query("w02_adaptive_gap")
def _(spark, sf):
    return P.adapt_gap(turns(spark, sf), 60_000_000, 20_000_000, 600_000_000, 1_500_000, 300_000_000, (20_000_000, 40_000_000), 25)


@query("w02_merged_by_gap", turned("""SELECT recording_id, gap_us, count(*) FILTER (WHERE us BETWEEN 1500000 AND 300000000) AS n, coalesce(sum(us) FILTER (WHERE us BETWEEN 1500000 AND 300000000), 0)::BIGINT AS us FROM (SELECT recording_id, gap_us, max(end_us) - min(start_us) AS us FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY recording_id, gap_us ORDER BY turn_index ROWS UNBOUNDED PRECEDING) AS chain FROM (SELECT prev.*, g * 60000000 AS gap_us, CASE WHEN ps = speaker_id AND start_us >= pt AND start_us - pt <= g * 60000000 AND NOT EXISTS (
  SELECT 1 FROM turns c WHERE c.recording_id = prev.recording_id AND c.speaker_id <> prev.speaker_id AND c.start_us < prev.end_us AND c.end_us > prev.pf) THEN 0 ELSE 1 END AS fresh FROM prev, range(5) r(g))) GROUP BY recording_id, gap_us, chain) GROUP BY ALL""",
  "prev AS (SELECT *, lag(speaker_id) OVER w AS ps, lag(start_us) OVER w AS pf, lag(end_us) OVER w AS pt FROM turns WINDOW w AS (PARTITION BY recording_id ORDER BY turn_index))"))
def _(spark, sf):
    return P.merged_by_gap(turns(spark, sf), [g * 60_000_000 for g in range(5)], 1_500_000, 300_000_000)


@query("w21_stitched_windows", turned("SELECT recording_id, speaker_id, start_us, end_us FROM u", """pt AS (SELECT recording_id, speaker_id, greatest(start_us, CASE WHEN w = 0 THEN 0 ELSE w * 6600000000 + 300000000 END) AS start_us, least(end_us, w * 6600000000 + 6900000000) AS end_us
  FROM turns, range(14) r(w) WHERE start_us < w * 6600000000 + 7200000000 AND end_us > w * 6600000000 AND least(end_us, w * 6600000000 + 6900000000) > greatest(start_us, CASE WHEN w = 0 THEN 0 ELSE w * 6600000000 + 300000000 END))""", union_cte("u", "pt", "recording_id, speaker_id", 80_000)))
def _(spark, sf):
    length, overlap = 7_200_000_000, 600_000_000
    hop = length - overlap
    first, last = F.greatest(F.ceil((F.col("start_us") - length + 1) / hop), F.lit(0)), F.floor((F.col("end_us") - 1) / hop)
    found = turns(spark, sf).withColumn("window", F.explode(F.sequence(first, last)))
    return P.stitch(found, length, overlap, 80_000)


@query("w25_refreshed_overlaps", turned("""SELECT a.recording_id, a.new_index AS turn_index, count(b.new_index) AS n FROM k a LEFT JOIN k b ON a.recording_id = b.recording_id AND a.new_index <> b.new_index AND a.start_us < b.end_us AND b.start_us < a.end_us GROUP BY ALL""",
  "k AS (SELECT *, (row_number() OVER (PARTITION BY recording_id ORDER BY start_us, end_us, speaker_id, event_id) - 1)::INT AS new_index FROM turns WHERE end_us - start_us BETWEEN 10000000 AND 100000000)"))
def _(spark, sf):
    kept = I.duration_filter(turns(spark, sf), 10.0, 100.0)
    return P.refreshed_overlaps(kept).select("recording_id", "turn_index", F.size("overlap_with").cast("long").alias("n"))


@query("j27_local_speakers")
def _(spark, sf):
    v = S.table(spark, sf, "embeddings").select((F.col("vec_id") % 10).cast("string").alias("recording_id"), F.floor(F.col("vec_id") / 40).alias("window"), F.concat(F.lit("l"), (F.col("vec_id") % 4).cast("string")).alias("local"), F.concat(F.lit("g"), F.col("label").cast("string")).alias("global"), F.col("embedding")[0].cast("double").alias("score"))
    return P.match_local_speakers(v, 0.05)


# --- signals: an embedding serves as a waveform of 64 samples ---


def waves(spark, sf) -> DataFrame:
    return S.table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("samples"))


SAMPLES = "w AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)"


@query("g01_active_rms", f"WITH {SAMPLES}, m AS (SELECT vec_id, max(abs(x)) AS peak FROM w GROUP BY ALL) SELECT vec_id, round(greatest(sqrt(avg(x * x)), 1e-9), 5) AS rms FROM w JOIN m USING (vec_id) WHERE abs(x) >= peak * pow(10, -45 / 20.0::DOUBLE) AND peak > 0 GROUP BY ALL")
def _(spark, sf):
    return waves(spark, sf).select("vec_id", F.round(G.active_rms_of(F.col("samples")), 5).alias("rms"))


@query("g02_edge_features")
def _(spark, sf):
    return waves(spark, sf).select("vec_id", G.edge_features_of(F.col("samples"), 400).alias("f")).select("vec_id", "f.*")


@query("g03_frame_rms", f"WITH {SAMPLES} SELECT vec_id, (i // 16)::INT AS frame, round(sqrt(avg(x * x)), 5) AS rms FROM w GROUP BY ALL")
def _(spark, sf):
    return waves(spark, sf).select("vec_id", F.posexplode(G.frame_rms_of(F.col("samples"), 16, 16)).alias("frame", "rms")).withColumn("rms", F.round("rms", 5))


@query("g05_separation_gain")
def _(spark, sf):
    ratio = F.pandas_udf(lambda s: s.map(lambda x: G.si_sdr_db(x, x[::-1])), "double")
    return waves(spark, sf).select("vec_id", ratio("samples").alias("si_sdr_db"))


@query("g08_snr")
def _(spark, sf):
    return waves(spark, sf).select("vec_id", F.pandas_udf(lambda s: s.map(lambda x: G.snr_db(x, 8)), "double")("samples").alias("snr_db"))


POOLED = f"""{SAMPLES}, fr AS (SELECT label, i, x, dense_rank() OVER (PARTITION BY label ORDER BY vec_id) AS a, dense_rank() OVER (PARTITION BY label ORDER BY vec_id DESC) AS z FROM w JOIN embeddings USING (vec_id)),
  l AS (SELECT label, i::INT AS i, avg(x) AS mean, stddev_pop(x) AS std, avg(x) FILTER (WHERE a <= 4) AS start_edge, avg(x) FILTER (WHERE z <= 4) AS end_edge FROM fr GROUP BY ALL)"""


def pooled_layers(spark, sf) -> DataFrame:
    return heads.pool_frames(waves(spark, sf).select("label", "vec_id", "samples"), "label", "vec_id", "samples", 4)


@query("g10_pooled_layers", f"WITH {POOLED} SELECT label, i, round(mean, 5) AS mean, round(std, 5) AS std, round(start_edge, 5) AS start_edge, round(end_edge, 5) AS end_edge FROM l")
def _(spark, sf):
    return pooled_layers(spark, sf).select("label", "i", *[F.round(c, 5).alias(c) for c in ("mean", "std", "start_edge", "end_edge")])


@query("g11_silent_gaps", f"WITH {SAMPLES}, f AS (SELECT vec_id, i // 16 AS frame, sum((x * 1000)::INT * (x * 1000)::INT) AS e FROM w GROUP BY ALL) SELECT vec_id, max(e)::BIGINT AS loudest, max(e) <= 16 * 20000 AS silent FROM f WHERE frame BETWEEN 1 AND 2 GROUP BY ALL")
def _(spark, sf):
    whole = F.bround(F.col("x").cast("double") * 1000).cast("long")
    each = waves(spark, sf).select("vec_id", F.posexplode("samples").alias("i", "x")).groupBy("vec_id", F.floor(F.col("i") / 16).alias("frame")).agg(F.sum(whole * whole).alias("e"))
    return I.silent_gaps(each.where("frame BETWEEN 1 AND 2"), "vec_id", "e", 16 * 20000).select("vec_id", F.col("_loudest").alias("loudest"), "silent")


@query("w09_snapped_bounds")
def _(spark, sf):
    rows = waves(spark, sf).withColumn("s", F.lit(16)).withColumn("e", F.lit(48))
    return rows.select("vec_id", G.snapped_of(F.col("samples"), F.col("s"), F.col("e"), 8, 8, 4, 1).alias("b")).select("vec_id", "b.*")


@query("g06_mixes")
def _(spark, sf):
    mix = F.pandas_udf(lambda s: s.map(lambda x: G.mixed(x, x[::-1], 10.0, 7).tolist()), "array<double>")
    return waves(spark, sf).select("vec_id", mix("samples").alias("mixture"))


@query("g07_clipped_starts", f"WITH {SAMPLES} SELECT vec_id, cut::INT AS cut, count(*) AS n, round(max(abs(x)), 5) AS peak FROM w, (VALUES (4), (8), (16)) c(cut) WHERE i >= cut GROUP BY ALL")
def _(spark, sf):
    cuts = waves(spark, sf).withColumn("cut", F.explode(F.array(*map(F.lit, (4, 8, 16)))))
    kept = F.slice("samples", F.col("cut") + 1, F.size("samples") - F.col("cut"))
    each = cuts.select("vec_id", "cut", F.explode(kept).alias("x"))
    return each.groupBy("vec_id", "cut").agg(F.count("*").alias("n"), F.round(F.max(F.abs(F.col("x").cast("double"))), 5).alias("peak"))


RING = """rg AS (SELECT vec_id, label, ('0x' || substr(md5('7:' || vec_id), 1, 12))::BIGINT AS at_ FROM embeddings), dn AS (SELECT a.vec_id, arg_min(b.vec_id, (b.at_ - a.at_ + 281474976710656) % 281474976710656) AS donor FROM rg a JOIN rg b ON a.label <> b.label GROUP BY a.vec_id)"""


def _donors(spark, sf) -> DataFrame:
    return judging.ring_donors(waves(spark, sf), "vec_id", "label", 7)


@query("j25_ring_donors", f"WITH {RING} SELECT vec_id, donor FROM dn")
def _(spark, sf):
    return _donors(spark, sf)


@query("g07_defect_grid", f"""WITH {SAMPLES}, {RING}, c AS (SELECT vec_id, kind, c::DOUBLE AS severity, x FROM w, (VALUES (4), (8), (16)) s(c), (VALUES ('clipped_word_start'), ('clipped_word_end')) k(kind) WHERE CASE kind WHEN 'clipped_word_start' THEN i >= c ELSE i < 64 - c END),
  e AS (SELECT vec_id, sqrt(avg(x * x)) AS rms FROM w GROUP BY vec_id), m AS (SELECT a.vec_id, 'secondary_speaker', r.db::DOUBLE, a.x + d.x * ea.rms / (ed.rms * pow(10, r.db / 20.0::DOUBLE)) FROM w a JOIN dn ON a.vec_id = dn.vec_id JOIN w d ON d.vec_id = dn.donor AND d.i = a.i JOIN e ea ON ea.vec_id = a.vec_id JOIN e ed ON ed.vec_id = dn.donor, (VALUES (0), (10), (20)) r(db)),
  u AS (SELECT * FROM c UNION ALL SELECT * FROM m) SELECT vec_id, kind, severity, count(*)::INT AS n, round(sqrt(avg(x * x)), 5) AS rms, round(max(abs(x)), 5) AS peak FROM u GROUP BY ALL""")
def _(spark, sf):
    grid = judging.defect_grid(waves(spark, sf), _donors(spark, sf), "vec_id", "samples", (4, 8, 16), (0, 10, 20))
    n, x = F.size("samples"), F.col("samples")
    return grid.select("vec_id", "kind", "severity", n.alias("n"), F.round(F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v) / n), 5).alias("rms"), F.round(F.array_max(F.transform(x, F.abs)), 5).alias("peak"))


@query("g13_speech_masks")
def _(spark, sf):
    mask = F.pandas_udf(lambda s: s.map(lambda x: G.speech_mask(len(x), [(20, 40)], 2, 4).tolist()), "array<double>")
    return waves(spark, sf).select("vec_id", mask("samples").alias("mask"))


@query("a37_acoustic_profile", f"WITH {SAMPLES}, c AS (SELECT vec_id, label, count(*) AS n, sqrt(avg(x * x)) AS rms, count(*) FILTER (WHERE abs(x) >= 0.25) AS clipped FROM w JOIN embeddings USING (vec_id) GROUP BY ALL) SELECT label, count(*) AS clips, sum(n)::BIGINT AS samples, round(avg(rms), 5) AS rms, round(sum(clipped) / sum(n)::DOUBLE, 6) AS clipping FROM c GROUP BY ALL")
def _(spark, sf):
    x = F.col("x").cast("double")
    each = waves(spark, sf).select("vec_id", "label", F.explode("samples").alias("x")).groupBy("vec_id", "label").agg(F.count("*").alias("n"), F.sqrt(F.avg(x * x)).alias("rms"), F.count_if(F.abs(x) >= 0.25).alias("clipped"))
    return each.groupBy("label").agg(F.count("*").alias("clips"), F.sum("n").alias("samples"), F.round(F.avg("rms"), 5).alias("rms"), F.round(F.sum("clipped") / F.sum("n"), 6).alias("clipping"))


@query("r12_feature_matrix", f"""WITH {POOLED}, m(mode, part, nth) AS (VALUES ('mean', 'mean', 0), ('mean_std', 'mean', 0), ('mean_std', 'std', 1), ('edge', 'start_edge', 0), ('edge', 'end_edge', 1), ('combined', 'mean', 0), ('combined', 'std', 1), ('combined', 'start_edge', 2), ('combined', 'end_edge', 3)),
  u AS (UNPIVOT l ON mean, std, start_edge, end_edge INTO NAME part VALUE x) SELECT label, mode, (nth * 64 + i)::INT AS place, round(x, 5) AS x FROM u JOIN m USING (part)""")
def _(spark, sf):
    return heads.feature_matrix(pooled_layers(spark, sf), "label").withColumn("x", F.round("x", 5))


@query("m09_out_of_fold")
def _(spark, sf):
    rows = S.table(spark, sf, "embeddings").select("vec_id", (F.col("label") == 0).cast("int").alias("y"), (F.col("vec_id") % 3).alias("fold"), F.col("embedding").alias("x"))
    return heads.out_of_fold(rows, 3)
