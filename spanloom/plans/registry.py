"""Names of all queries, each with the DuckDB SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.operators import analytics as A
from spanloom.operators import folds, intervals as I
from spanloom.operators import sweeps
from spanloom.operators.timeline import along, following, previous
from spanloom.sources import tables as S
from spanloom.streaming import windows as W

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LAB = "label"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return I.normalize(S.raw_turns(spark, sf))


def turned(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([S.TURNS, *ctes])} {select}"


#: Unions of overlapping or touching rows of x(k..., start_us, end_us).
def union_cte(name: str, of: str, keys: str, gap: int = 0) -> str:
    return f"""{name} AS (SELECT {keys}, min(start_us) AS start_us, max(end_us) AS end_us, count(*) AS n FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY start_us, end_us ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT *, CASE WHEN start_us <= max(end_us) OVER (PARTITION BY {keys} ORDER BY start_us, end_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 0 ELSE 1 END AS fresh FROM {of}))
      GROUP BY {keys}, island)"""


# --- turns and intervals ---


@query("f01_normalize_turns", turned("SELECT recording_id, turn_index, speaker_id, start_us, end_us FROM turns"))
def _(spark, sf):
    return turns(spark, sf).select("recording_id", "turn_index", "speaker_id", "start_us", "end_us")


@query("f02_duration_filter", turned("SELECT recording_id, turn_index FROM turns WHERE end_us - start_us BETWEEN 1500000 AND 15000000"))
def _(spark, sf):
    return I.duration_filter(turns(spark, sf), 1.5, 15.0).select("recording_id", "turn_index")


@query("f13_first_appearance_labels", turned("""SELECT t.recording_id, t.turn_index, 'spk_' || lpad(cast(r - 1 AS VARCHAR), 2, '0') AS label FROM turns t JOIN (
  SELECT recording_id, speaker_id, dense_rank() OVER (PARTITION BY recording_id ORDER BY f) AS r FROM (SELECT recording_id, speaker_id, min(turn_index) AS f FROM turns GROUP BY ALL)) USING (recording_id, speaker_id)"""))
def _(spark, sf):
    return I.first_appearance_labels(turns(spark, sf)).select("recording_id", "turn_index", "label")


@query("j01_overlaps", turned("""SELECT a.recording_id, a.turn_index, count(b.turn_index) AS n, coalesce(string_agg(cast(b.turn_index AS VARCHAR), ',' ORDER BY b.turn_index), '') AS overlap_with
  FROM turns a LEFT JOIN turns b ON a.recording_id = b.recording_id AND a.turn_index <> b.turn_index AND a.start_us < b.end_us AND b.start_us < a.end_us GROUP BY ALL"""))
def _(spark, sf):
    out = I.overlaps(turns(spark, sf))
    return out.select("recording_id", "turn_index", F.size("overlap_with").cast("long").alias("n"), F.array_join(F.transform("overlap_with", lambda x: x.cast("string")), ",").alias("overlap_with"))


@query("j02_overlaps_other_speaker", turned("""SELECT recording_id, turn_index FROM turns a WHERE EXISTS (SELECT 1 FROM turns b WHERE a.recording_id = b.recording_id AND a.speaker_id <> b.speaker_id
  AND a.start_us < b.end_us AND b.start_us < a.end_us)"""))
def _(spark, sf):
    t = turns(spark, sf)
    return I.range_join(t, I.other(t, "speaker_id"), ["recording_id"]).where("speaker_id <> b_speaker_id").select("recording_id", "turn_index").distinct()


@query("j04_other_speaker_overlap", turned("""SELECT t.recording_id, t.turn_index, cast(coalesce(o.us, 0) AS BIGINT) AS other_us FROM turns t LEFT JOIN (
  SELECT recording_id, turn_index, sum(end_us - start_us) AS us FROM u GROUP BY ALL) o USING (recording_id, turn_index)""",
  """parts AS (SELECT a.recording_id, a.turn_index, greatest(a.start_us, b.start_us) AS start_us, least(a.end_us, b.end_us) AS end_us FROM turns a JOIN turns b
  ON a.recording_id = b.recording_id AND a.speaker_id <> b.speaker_id AND a.start_us < b.end_us AND b.start_us < a.end_us)""", union_cte("u", "parts", "recording_id, turn_index")))
def _(spark, sf):
    return sweeps.other_speaker_overlap(turns(spark, sf))


@query("j05_overlap_weights", turned("""SELECT a.recording_id, a.speaker_id, b.speaker_id AS b_speaker_id, cast(sum(least(a.end_us, b.end_us) - greatest(a.start_us, b.start_us)) AS BIGINT) AS weight
  FROM turns a JOIN h b ON a.recording_id = b.recording_id AND a.start_us < b.end_us AND b.start_us < a.end_us GROUP BY ALL""",
  "h AS (SELECT recording_id, 'u' || (user_id % 5) AS speaker_id, start_us + event_id % 1000 AS start_us, end_us + event_id % 1000 AS end_us FROM raw)"))
def _(spark, sf):
    return _weights(spark, sf)


def _weights(spark, sf):
    raw = S.raw_turns(spark, sf)
    shift = F.col("event_id") % 1000
    hyp = raw.select("recording_id", F.concat(F.lit("u"), (F.col("user_id") % 5).cast("string")).alias("b_speaker_id"), (F.col("start_us") + shift).alias("b_start_us"), (F.col("end_us") + shift).alias("b_end_us"))
    pairs = I.range_join(turns(spark, sf), hyp, ["recording_id"])
    return pairs.groupBy("recording_id", "speaker_id", "b_speaker_id").agg(F.sum(F.least("end_us", "b_end_us") - F.greatest("start_us", "b_start_us")).alias("weight"))


@query("j06_midpoint_speakers", turned("""SELECT s.recording_id, s.start_us, string_agg(DISTINCT t.speaker_id, ',' ORDER BY t.speaker_id) AS speakers FROM (
  SELECT recording_id, edge AS start_us, lead(edge) OVER (PARTITION BY recording_id ORDER BY edge) AS end_us FROM (SELECT recording_id, start_us AS edge FROM turns UNION SELECT recording_id, end_us FROM turns)) s
  JOIN turns t ON s.recording_id = t.recording_id AND (s.start_us + s.end_us) // 2 >= t.start_us AND (s.start_us + s.end_us) // 2 < t.end_us GROUP BY ALL"""))
def _(spark, sf):
    t = turns(spark, sf)
    mid = F.floor((F.col("start_us") + F.col("end_us")) / 2)
    points = I.sweep(t).select("recording_id", F.col("start_us").alias("from_us"), mid.alias("start_us"), (mid + 1).alias("end_us"))
    found = I.range_join(points, I.other(t, "speaker_id"), ["recording_id"]).groupBy("recording_id", F.col("from_us").alias("start_us"))
    return found.agg(F.array_join(F.array_sort(F.collect_set("b_speaker_id")), ",").alias("speakers"))


@query("j11_neighbour_gaps", turned("""SELECT recording_id, turn_index,
  (SELECT CASE WHEN count(*) > 0 THEN greatest(a.start_us - max(b.end_us), 0) END FROM turns b WHERE b.recording_id = a.recording_id AND b.speaker_id <> a.speaker_id AND (b.start_us, b.turn_index) < (a.start_us, a.turn_index)) AS gap_before_us,
  (SELECT CASE WHEN count(*) > 0 THEN greatest(min(b.start_us) - a.end_us, 0) END FROM turns b WHERE b.recording_id = a.recording_id AND b.speaker_id <> a.speaker_id AND (b.start_us, b.turn_index) > (a.start_us, a.turn_index)) AS gap_after_us
  FROM turns a"""))
def _(spark, sf):
    return I.neighbour_gaps(turns(spark, sf)).select("recording_id", "turn_index", "gap_before_us", "gap_after_us")


@query("j12_previous_next", turned("""SELECT recording_id, turn_index, lag(speaker_id) OVER w AS previous, lead(speaker_id) OVER w AS next, start_us - lag(end_us) OVER w AS gap_us FROM turns
  WINDOW w AS (PARTITION BY recording_id ORDER BY turn_index)"""))
def _(spark, sf):
    near = along(turns(spark, sf), ["recording_id"], ["start_us", "turn_index"], previous=previous("speaker_id"), next=following("speaker_id"), _end=previous("end_us"))
    return near.select("recording_id", "turn_index", "previous", "next", (F.col("start_us") - F.col("_end")).alias("gap_us"))


@query("a03_union_length", turned("SELECT recording_id, cast(sum(end_us - start_us) AS BIGINT) AS union_us FROM u GROUP BY ALL", union_cte("u", "turns", "recording_id")))
def _(spark, sf):
    return I.union_length(turns(spark, sf), ["recording_id"])


@query("w03_islands", turned("SELECT recording_id, speaker_id, start_us, end_us, n FROM u", union_cte("u", "turns", "recording_id, speaker_id", 30_000_000)))
def _(spark, sf):
    return I.islands(turns(spark, sf), ["recording_id", "speaker_id"], 30_000_000)


@query("w05_sweep_line", turned("""SELECT recording_id, edge AS start_us, nxt AS end_us, active FROM (SELECT recording_id, edge, lead(edge) OVER w AS nxt, cast(sum(step) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS active FROM (
  SELECT recording_id, edge, sum(step) AS step FROM (SELECT recording_id, start_us AS edge, 1 AS step FROM turns UNION ALL SELECT recording_id, end_us, -1 FROM turns) GROUP BY ALL) WINDOW w AS (PARTITION BY recording_id ORDER BY edge))
  WHERE nxt IS NOT NULL"""))
def _(spark, sf):
    return I.sweep(turns(spark, sf))


MERGED = ["""prev AS (SELECT *, lag(speaker_id) OVER w AS ps, lag(start_us) OVER w AS pf, lag(end_us) OVER w AS pt FROM turns WINDOW w AS (PARTITION BY recording_id ORDER BY turn_index))""",
"""joins AS (SELECT *, CASE WHEN ps = speaker_id AND start_us >= pt AND start_us - pt <= 120000000 AND NOT EXISTS (SELECT 1 FROM turns c WHERE c.recording_id = prev.recording_id AND c.speaker_id <> prev.speaker_id
  AND c.start_us < prev.end_us AND c.end_us > prev.pf) THEN 0 ELSE 1 END AS fresh FROM prev)""",
"""merged AS (SELECT recording_id, min(speaker_id) AS speaker_id, min(start_us) AS start_us, max(end_us) AS end_us, count(*) AS sources, CASE WHEN count(confidence) = count(*) THEN min(confidence) END AS confidence
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY recording_id ORDER BY turn_index ROWS UNBOUNDED PRECEDING) AS chain FROM joins) GROUP BY recording_id, chain)"""]  # fmt: skip


@query("w01_merge_turns", turned("SELECT * FROM merged", *MERGED))
def _(spark, sf):
    return I.merge_turns(turns(spark, sf), 120_000_000)


DECIDED = """dec AS (SELECT *, CASE WHEN ps IS NULL THEN 'first_turn' WHEN ps <> speaker_id THEN 'other_speaker' WHEN start_us < pt THEN 'overlapping_turns' WHEN start_us - pt > 120000000 THEN 'gap_too_long'
  WHEN EXISTS (SELECT 1 FROM turns c WHERE c.recording_id = prev.recording_id AND c.speaker_id <> prev.speaker_id AND c.start_us < prev.end_us AND c.end_us > prev.pf) THEN 'competing_speaker'
  WHEN EXISTS (SELECT 1 FROM raw c WHERE c.recording_id = prev.recording_id AND c.event_id % 3 = 0 AND prev.start_us > prev.pt AND (c.start_us // 1000000) * 1000000 < prev.start_us AND (c.start_us // 1000000 + 1) * 1000000 > prev.pt) THEN 'gap_not_silent' ELSE 'merged' END AS decision FROM prev)"""


def _loud(spark, sf):
    return S.raw_turns(spark, sf).where("event_id % 3 = 0").select("recording_id", F.floor(F.col("start_us") / 1_000_000).alias("frame")).distinct()


@query("w01_merge_decisions", turned("SELECT recording_id, turn_index, decision FROM dec", MERGED[0], DECIDED))
def _(spark, sf):
    return I.merge_decisions(turns(spark, sf), 120_000_000, _loud(spark, sf)).select("recording_id", "turn_index", "decision")


@query("w01_merge_silent_turns", turned("""SELECT recording_id, min(speaker_id) AS speaker_id, min(start_us) AS start_us, max(end_us) AS end_us, count(*) AS sources FROM (
  SELECT *, sum((decision <> 'merged')::INT) OVER (PARTITION BY recording_id ORDER BY turn_index ROWS UNBOUNDED PRECEDING) AS chain FROM dec) GROUP BY recording_id, chain""", MERGED[0], DECIDED))
def _(spark, sf):
    return I.merge_turns(turns(spark, sf), 120_000_000, _loud(spark, sf)).drop("confidence")


@query("w01_merge_turns_capped", turned("""SELECT recording_id, min(speaker_id) AS speaker_id, min(start_us) AS start_us, max(end_us) AS end_us, count(*) AS sources FROM f GROUP BY recording_id, began""", *MERGED[:2],
  """f AS (SELECT recording_id, turn_index, speaker_id, start_us, end_us, turn_index AS began, start_us AS from_us FROM joins WHERE turn_index = 0
  UNION ALL SELECT j.recording_id, j.turn_index, j.speaker_id, j.start_us, j.end_us, CASE WHEN j.fresh = 1 OR j.end_us - f.from_us > 300000000 THEN j.turn_index ELSE f.began END,
    CASE WHEN j.fresh = 1 OR j.end_us - f.from_us > 300000000 THEN j.start_us ELSE f.from_us END FROM f JOIN joins j ON j.recording_id = f.recording_id AND j.turn_index = f.turn_index + 1)""").replace("WITH", "WITH RECURSIVE", 1))
def _(spark, sf):
    return folds.merge_capped(turns(spark, sf), 120_000_000, 300_000_000)


CLEAN = ["""c AS (SELECT *, coalesce(ps = fs AND ps <> speaker_id AND end_us - start_us <= 20000000 AND start_us - pe BETWEEN 0 AND 60000000 AND ff - end_us BETWEEN 0 AND 60000000 AND NOT EXISTS (
    SELECT 1 FROM turns b WHERE b.recording_id = x.recording_id AND b.turn_index <> x.turn_index AND b.start_us < x.end_us AND x.start_us < b.end_us), false) AS cand
  FROM (SELECT *, lag(speaker_id) OVER w AS ps, lag(end_us) OVER w AS pe, lead(speaker_id) OVER w AS fs, lead(start_us) OVER w AS ff FROM turns WINDOW w AS (PARTITION BY recording_id ORDER BY turn_index)) x)""",
"""l AS (SELECT recording_id, turn_index, start_us, end_us, CASE WHEN cand AND (turn_index - coalesce(last_value(CASE WHEN NOT cand THEN turn_index END IGNORE NULLS) OVER (
    PARTITION BY recording_id ORDER BY turn_index ROWS UNBOUNDED PRECEDING), -1)) % 2 = 1 THEN ps ELSE speaker_id END AS speaker_id FROM c)""",
"""n AS (SELECT *, lag(speaker_id) OVER w AS ps, lag(end_us) OVER w AS pe, lead(speaker_id) OVER w AS fs, lead(start_us) OVER w AS ff FROM l WINDOW w AS (PARTITION BY recording_id ORDER BY turn_index))""",
"""t AS (SELECT recording_id, turn_index, speaker_id,
  greatest(CASE WHEN ps <> speaker_id AND pe > start_us THEN (pe + start_us) // 2 + 500000 WHEN ps <> speaker_id AND start_us - pe < 1000000 THEN start_us + 500000 ELSE start_us END, 0) AS start_us,
  CASE WHEN fs <> speaker_id AND end_us > ff THEN (end_us + ff) // 2 - 500000 WHEN fs <> speaker_id AND ff - end_us < 1000000 THEN end_us - 500000 ELSE end_us END AS end_us FROM n)""",
"""q AS (SELECT *, sum(ch) OVER (PARTITION BY recording_id ORDER BY turn_index ROWS UNBOUNDED PRECEDING) AS speech FROM (
  SELECT *, CASE WHEN speaker_id = lag(speaker_id) OVER (PARTITION BY recording_id ORDER BY turn_index) THEN 0 ELSE 1 END AS ch FROM t WHERE end_us > start_us))""",
"""g AS (SELECT *, sum(fresh) OVER (PARTITION BY recording_id, speech ORDER BY turn_index ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN start_us <= 60000000 + max(end_us) OVER (
  PARTITION BY recording_id, speech ORDER BY turn_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM q))"""]  # fmt: skip


@query("w04_cleanup", turned("""SELECT * FROM (SELECT recording_id, speaker_id, arg_min(start_us, turn_index) AS start_us, max(end_us) AS end_us, count(*) AS n FROM g GROUP BY recording_id, speaker_id, speech, island)
  WHERE end_us - start_us >= 5000000""", *CLEAN))
def _(spark, sf):
    return I.cleanup(turns(spark, sf), 20_000_000, 500_000, 60_000_000, 5_000_000)


@query("w07_erode_boundaries", turned("""SELECT recording_id, turn_index, start_us, end_us FROM (SELECT recording_id, turn_index,
  start_us + 500000 + CASE WHEN b < 10000000 THEN (10000000 - b) // 2 ELSE 0 END AS start_us, end_us - 500000 - CASE WHEN a < 10000000 THEN (10000000 - a) // 2 ELSE 0 END AS end_us FROM (SELECT *,
  (SELECT CASE WHEN count(*) > 0 THEN greatest(t.start_us - max(b.end_us), 0) END FROM turns b WHERE b.recording_id = t.recording_id AND b.speaker_id <> t.speaker_id AND (b.start_us, b.turn_index) < (t.start_us, t.turn_index)) AS b,
  (SELECT CASE WHEN count(*) > 0 THEN greatest(min(b.start_us) - t.end_us, 0) END FROM turns b WHERE b.recording_id = t.recording_id AND b.speaker_id <> t.speaker_id AND (b.start_us, b.turn_index) > (t.start_us, t.turn_index)) AS a FROM turns t))
  WHERE end_us - start_us >= 1000000"""))
def _(spark, sf):
    return I.erode(turns(spark, sf), 500_000, 10_000_000, 1_000_000).select("recording_id", "turn_index", "start_us", "end_us")


@query("j26_speaker_assignment")
def _(spark, sf):
    return folds.match_speakers(_weights(spark, sf))


@query("w18_speaker_runs", turned("""SELECT recording_id, speaker_id, min(turn_index) AS run, min(start_us) AS start_us, max(end_us) AS end_us, count(*) AS turns FROM (SELECT *, sum(b) OVER (PARTITION BY recording_id ORDER BY turn_index ROWS UNBOUNDED PRECEDING) AS r FROM (
  SELECT *, CASE WHEN speaker_id = ps AND start_us - pe BETWEEN 0 AND 300000000 AND NOT EXISTS (SELECT 1 FROM turns c WHERE c.recording_id = x.recording_id AND c.speaker_id <> x.speaker_id AND c.start_us < x.start_us AND c.end_us > x.pe)
  AND NOT EXISTS (SELECT 1 FROM turns c WHERE c.recording_id = x.recording_id AND c.event_id % 10 = 0 AND c.start_us < x.start_us AND c.end_us > x.pe AND x.start_us > x.pe) THEN 0 ELSE 1 END AS b
  FROM (SELECT *, lag(speaker_id) OVER w AS ps, lag(end_us) OVER w AS pe FROM turns WINDOW w AS (PARTITION BY recording_id ORDER BY turn_index)) x)) GROUP BY recording_id, speaker_id, r"""))
def _(spark, sf):
    t = turns(spark, sf)
    return I.speaker_runs(t, 300_000_000, t.where("event_id % 10 = 0"))


@query("w19_sliding_windows", turned("""SELECT recording_id, turn_index, ws AS window_start_us, least(ws + 20000000, end_us) AS window_end_us FROM (SELECT DISTINCT * FROM (
  SELECT recording_id, turn_index, end_us, unnest(list_append(generate_series(start_us, greatest(end_us - 20000000, start_us), 7500000), greatest(end_us - 20000000, start_us))) AS ws FROM turns))"""))
def _(spark, sf):
    return I.sliding_windows(turns(spark, sf), 20_000_000, 7_500_000).select("recording_id", "turn_index", "window_start_us", "window_end_us")


@query("w20_hysteresis", f"""WITH {S.RAW_TURNS}, f AS (SELECT recording_id, start_us // 60000000 AS frame, avg((event_id * 37 + user_id * 11) % 100) / 100 AS p FROM raw GROUP BY ALL),
  st AS (SELECT *, coalesce(last_value(CASE WHEN p > 0.6 THEN 1 WHEN p < 0.3 THEN 0 END IGNORE NULLS) OVER (PARTITION BY recording_id ORDER BY frame ROWS UNBOUNDED PRECEDING), 0) AS act FROM f),
  x AS (SELECT recording_id, frame AS start_us, frame + 1 AS end_us FROM st WHERE act = 1), {union_cte("r", "x", "recording_id")},
  y AS (SELECT recording_id, greatest(start_us - 1, 0) AS start_us, end_us + 2 AS end_us FROM r WHERE end_us + 2 - greatest(start_us - 1, 0) >= 5), {union_cte("u", "y", "recording_id", 5)}
  SELECT recording_id, start_us AS first_frame, end_us AS end_frame, n AS runs FROM u""")
def _(spark, sf):
    raw = S.raw_turns(spark, sf)
    frames = raw.groupBy("recording_id", F.floor(F.col("start_us") / 60_000_000).alias("frame")).agg((F.avg((F.col("event_id") * 37 + F.col("user_id") * 11) % 100) / 100).alias("p"))
    return I.hysteresis(frames, 0.6, 0.3, 5, (1, 2), 5)


@query("w30_largest_gap", turned("""SELECT recording_id, cast(max(g) AS BIGINT) AS largest_gap_us FROM (SELECT recording_id, CASE WHEN speaker_id = lag(speaker_id) OVER w THEN start_us - lag(end_us) OVER w END AS g FROM turns
  WINDOW w AS (PARTITION BY recording_id ORDER BY turn_index)) GROUP BY ALL"""))
def _(spark, sf):
    near = along(turns(spark, sf), ["recording_id"], ["start_us", "turn_index"], _s=previous("speaker_id"), _e=previous("end_us"))
    gap = F.when(F.col("speaker_id") == F.col("_s"), F.col("start_us") - F.col("_e"))
    return near.withColumn("_g", gap).groupBy("recording_id").agg(F.max("_g").alias("largest_gap_us"))


def _stage_sql(name: str, of: str) -> list[str]:
    return [union_cte(f"u_{name}", of, "recording_id"), f"""s_{name} AS (SELECT a.recording_id, a.n AS {name}_turns, cast(a.us AS BIGINT) AS {name}_us, cast(b.us AS BIGINT) AS {name}_union_us, cast(a.us - b.us AS BIGINT) AS {name}_overlap_us
      FROM (SELECT recording_id, count(*) AS n, sum(end_us - start_us) AS us FROM {of} GROUP BY ALL) a JOIN (SELECT recording_id, sum(end_us - start_us) AS us FROM u_{name} GROUP BY ALL) b USING (recording_id))"""]


_AUDIT = [*MERGED, "final AS (SELECT * FROM merged WHERE end_us - start_us BETWEEN 5000000 AND 300000000)", *_stage_sql("raw", "turns"), *_stage_sql("merged", "merged"), *_stage_sql("final", "final")]
_AUDIT_COLS = ", ".join(f"coalesce({s}_{c}, 0) AS {s}_{c}" for s in ("raw", "merged", "final") for c in ("turns", "us", "union_us", "overlap_us"))


def _audit(spark, sf):
    raw = turns(spark, sf)
    merged = I.merge_turns(raw, 120_000_000)
    return I.duration_loss(raw, merged, I.duration_filter(merged, 5.0, 300.0))


@query("a04_duration_loss", turned(f"""SELECT recording_id, {_AUDIT_COLS}, round(coalesce(final_us, 0) / raw_us::DOUBLE, 6) AS final_yield, round(coalesce(final_union_us, 0) / raw_union_us::DOUBLE, 6) AS union_yield,
  raw_us - coalesce(final_us, 0) AS net_loss_us FROM s_raw LEFT JOIN s_merged USING (recording_id) LEFT JOIN s_final USING (recording_id)""", *_AUDIT))
def _(spark, sf):
    return _audit(spark, sf)


@query("a06_rollup_by_month", turned("""SELECT month, recording_id, count(*) AS turns, cast(sum(end_us - start_us) AS BIGINT) AS us FROM (SELECT *, substr(recording_id, 1, 7) AS month FROM turns) GROUP BY ROLLUP (month, recording_id)"""))
def _(spark, sf):
    t = turns(spark, sf).withColumn("month", F.substring("recording_id", 1, 7))
    return t.rollup("month", "recording_id").agg(F.count("*").alias("turns"), F.sum(F.col("end_us") - F.col("start_us")).alias("us"))


@query("a23_duration_histogram", turned("SELECT (end_us - start_us) // 5000000 AS bin, count(*) AS n FROM turns GROUP BY ALL"))
def _(spark, sf):
    return turns(spark, sf).groupBy(F.floor((F.col("end_us") - F.col("start_us")) / 5_000_000).alias("bin")).agg(F.count("*").alias("n"))


@query("a23_duration_summary", turned("SELECT count(*) AS n, (sum(end_us - start_us) // count(*))::BIGINT AS mean_us, median(end_us - start_us) AS median_us FROM turns"))
def _(spark, sf):
    us = F.col("end_us") - F.col("start_us")
    return turns(spark, sf).agg(F.count("*").alias("n"), F.floor(F.sum(us) / F.count("*")).alias("mean_us"), F.percentile(us, 0.5).alias("median_us"))


@query("a24_cutoff_curve", turned("""SELECT g * 5000000 AS threshold_us, count(*) FILTER (WHERE end_us - start_us >= g * 5000000) AS remaining, cast(coalesce(sum(end_us - start_us) FILTER (WHERE end_us - start_us >= g * 5000000), 0) AS BIGINT) AS remaining_us
  FROM turns, range(61) r(g) GROUP BY g"""))
def _(spark, sf):
    return I.cutoff_curve(turns(spark, sf), 5_000_000, 60)


@query("a45_speaker_sets", turned("SELECT recording_id, string_agg(DISTINCT speaker_id, ',' ORDER BY speaker_id) AS speakers FROM turns GROUP BY ALL"))
def _(spark, sf):
    return turns(spark, sf).groupBy("recording_id").agg(F.array_join(F.array_sort(F.collect_set("speaker_id")), ",").alias("speakers"))


# --- verdicts ---

_RATES = """round((tp + tn) / nullif(tp + fp + fn + tn, 0)::DOUBLE, 6) AS accuracy, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall, round(fp / nullif(fp + tn, 0)::DOUBLE, 6) AS false_reject,
  round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision, round(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 6) AS f1"""


@query("a09_confusion", f"""WITH {S.VERDICTS} SELECT *, {_RATES} FROM (SELECT family, count(*) AS n, count(*) FILTER (WHERE candidate IS NULL) AS missing, count(*) FILTER (WHERE reference = 'reject' AND candidate = 'reject') AS tp,
  count(*) FILTER (WHERE reference = 'pass' AND candidate = 'reject') AS fp, count(*) FILTER (WHERE reference = 'reject' AND candidate = 'pass') AS fn, count(*) FILTER (WHERE reference = 'pass' AND candidate = 'pass') AS tn
  FROM v GROUP BY CUBE (family))""")
def _(spark, sf):
    return A.confusion(S.verdicts(spark, sf), ["family"])


@query("a11_code_counts", f"""WITH {S.VERDICTS}, c AS (SELECT candidate, code, CASE code WHEN 'toxic' THEN contains(text, '!') ELSE n_chars < 600 END AS ref, CASE code WHEN 'toxic' THEN toxic = 1 ELSE quality = 0 END AS mine FROM v, (VALUES ('low_quality'), ('toxic')) k(code) WHERE candidate IS NOT NULL)
  SELECT code, count(*) FILTER (WHERE ref) AS ref_count, count(*) FILTER (WHERE ref AND mine AND candidate = 'reject') AS caught, count(*) FILTER (WHERE ref AND NOT (mine AND candidate = 'reject')) AS missed, count(*) FILTER (WHERE mine AND NOT ref) AS overcalled,
  CASE WHEN count(*) FILTER (WHERE ref) > 0 THEN round(count(*) FILTER (WHERE ref AND mine AND candidate = 'reject') / count(*) FILTER (WHERE ref)::DOUBLE, 6) END AS recall FROM c GROUP BY code""")
def _(spark, sf):
    return A.code_counts(S.verdicts(spark, sf), ["low_quality", "toxic"])


@query("a13_order_statistics", f"""WITH {S.VERDICTS}, r AS (SELECT family, n_chars AS v, row_number() OVER (PARTITION BY family ORDER BY n_chars) AS i, count(*) OVER (PARTITION BY family) AS n FROM v)
  SELECT family, count(*) AS n, round(median(v), 6) AS median, max(v) FILTER (WHERE i = ceil(n * 95 / 100.0)) AS p95_nearest, max(v) FILTER (WHERE i = least(n * 95 // 100 + 1, n)) AS p95_floor,
  max(v) FILTER (WHERE i = CASE WHEN n < 20 THEN n ELSE least(n * 95 // 100 + 1, n) END) AS p95_small_n FROM r GROUP BY ALL""")
def _(spark, sf):
    return A.order_statistics(S.verdicts(spark, sf), ["family"], "n_chars")


@query("a14_percentiles", f"WITH {S.VERDICTS} SELECT family, quantile_cont(duration_s, 0.05) AS p05, quantile_cont(duration_s, 0.5) AS p50, quantile_cont(duration_s, 0.95) AS p95 FROM v GROUP BY ALL")
def _(spark, sf):
    q = S.verdicts(spark, sf).groupBy("family").agg(F.percentile("duration_s", [0.05, 0.5, 0.95]).alias("q"))
    return q.select("family", F.col("q")[0].alias("p05"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p95"))


@query("a15_coverage", """WITH e AS (SELECT doc_id FROM documents WHERE lang <> 'fr'), a AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 1 THEN 'contradictory' WHEN quality = 1 THEN 'pass' ELSE 'reject' END AS d FROM labels),
  b AS (SELECT e.doc_id AS e, a.doc_id AS a, d FROM e FULL JOIN a ON e.doc_id = a.doc_id)
  SELECT count(e) AS expected, count(*) FILTER (WHERE e IS NOT NULL AND d IN ('pass', 'reject')) AS valid, count(*) FILTER (WHERE e IS NOT NULL AND d = 'contradictory') AS invalid, count(*) FILTER (WHERE e IS NOT NULL AND a IS NULL) AS missing, count(*) FILTER (WHERE e IS NULL) AS unmatched,
  round(count(*) FILTER (WHERE e IS NOT NULL AND d = 'pass') / count(*) FILTER (WHERE e IS NOT NULL AND d IN ('pass', 'reject'))::DOUBLE, 6) AS pass_rate, round(count(*) FILTER (WHERE e IS NOT NULL AND d = 'pass') / count(e)::DOUBLE, 6) AS conservative_pass_rate FROM b""")
def _(spark, sf):
    """The labels as artifacts of all documents but French ones; a good and toxic one has no valid decision."""
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    artifacts = S.table(spark, sf, "labels").select("doc_id", F.when(good & toxic, "contradictory").when(good, "pass").otherwise("reject").alias("decision"))
    return A.coverage(S.table(spark, sf, "documents").where("lang <> 'fr'"), artifacts, "doc_id")


@query("a16_length_by_decision", f"""WITH {S.VERDICTS} SELECT family, sum(n_chars) FILTER (WHERE candidate = 'pass')::BIGINT AS pass, sum(n_chars) FILTER (WHERE candidate = 'reject')::BIGINT AS reject FROM v GROUP BY ALL""")
def _(spark, sf):
    return S.verdicts(spark, sf).groupBy("family").pivot("candidate", ["pass", "reject"]).agg(F.sum("n_chars"))


@query("j14_reference_candidate", f"WITH {S.VERDICTS} SELECT key, reference, candidate, CASE WHEN candidate IS NULL THEN 'missing' WHEN candidate = reference THEN 'agree' ELSE 'disagree' END AS status FROM v")
def _(spark, sf):
    status = F.when(F.col("candidate").isNull(), "missing").when(F.col("candidate") == F.col("reference"), "agree").otherwise("disagree")
    return S.verdicts(spark, sf).select("key", "reference", "candidate", status.alias("status"))


# --- ranking ---


@query("a25_auroc", f"""WITH {S.SCORED} SELECT cluster, sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives, round(w / nullif(sum(label) * sum(1 - label), 0)::DOUBLE, 6) AS auroc FROM s JOIN (
  SELECT cluster AS c, (SELECT coalesce(sum(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0 END), 0)::DOUBLE FROM s p, s q WHERE p.cluster = k.cluster AND q.cluster = k.cluster AND p.label = 1 AND q.label = 0) AS w
  FROM (SELECT DISTINCT cluster FROM s) k) ON cluster = c GROUP BY cluster, w""")
def _(spark, sf):
    return A.auroc(S.scored(spark, sf), ["cluster"])


_CURVE = """curve AS (SELECT cluster, score, sum(m) OVER w AS accepted, sum(bad) OVER w AS bad, round(sum(m) OVER w / (sum(m) OVER (PARTITION BY cluster))::DOUBLE, 6) AS yield, round(sum(bad) OVER w / (sum(m) OVER w)::DOUBLE, 6) AS r
  FROM (SELECT cluster, score, sum(minutes)::BIGINT AS m, sum(minutes * label)::BIGINT AS bad FROM s GROUP BY ALL) WINDOW w AS (PARTITION BY cluster ORDER BY score ROWS UNBOUNDED PRECEDING))"""


@query("a27_yield_curve", f"WITH {S.SCORED}, {_CURVE} SELECT cluster, score, accepted::BIGINT AS accepted, bad::BIGINT AS bad, yield, r FROM curve")
def _(spark, sf):
    return A.yield_curve(S.scored(spark, sf), ["cluster"])


@query("a29_matched_point", f"""WITH {S.SCORED}, {_CURVE} SELECT cluster, score, yield, r FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(abs(yield - 0.7), 6), score) AS n FROM curve) WHERE n = 1""")
def _(spark, sf):
    return A.matched_point(A.yield_curve(S.scored(spark, sf), ["cluster"]), ["cluster"], 0.7)


@query("a32_equal_error_rate", f"""WITH {S.SCORED}, g AS (SELECT t AS threshold, round(count(*) FILTER (WHERE label = 1 AND score < t) / sum(label)::DOUBLE, 6) AS far, round(count(*) FILTER (WHERE label = 0 AND score >= t) / sum(1 - label)::DOUBLE, 6) AS frr
  FROM s, (SELECT range * 1.0::DOUBLE AS t FROM range(101)) GROUP BY t) SELECT threshold, far, frr FROM g ORDER BY round(abs(far - frr), 6), threshold LIMIT 1""")
def _(spark, sf):
    return A.eer(S.scored(spark, sf), 100, 1.0)


@query("a33_distribution", f"WITH {S.SCORED} SELECT cluster, count(*) AS n, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, min(score) AS least, quantile_cont(score, 0.1) AS p10, quantile_cont(score, 0.9) AS p90 FROM s GROUP BY ALL")
def _(spark, sf):
    return S.scored(spark, sf).groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.stddev_pop("score"), 6).alias("std"), F.min("score").alias("least"), F.percentile("score", 0.1).alias("p10"), F.percentile("score", 0.9).alias("p90"))


@query("w26_lexicographic_rank", f"WITH {S.SCORED} SELECT cluster, clip_id, row_number() OVER (PARTITION BY cluster ORDER BY pre_gate, score, clip_id) AS rank FROM s")
def _(spark, sf):
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy("pre_gate", "score", "clip_id"))
    return S.scored(spark, sf).select("cluster", "clip_id", rank.alias("rank"))


@query("w27_empirical_cdf", f"WITH {S.SCORED} SELECT clip_id, round(cume_dist() OVER (PARTITION BY cluster ORDER BY score), 6) AS cdf FROM s")
def _(spark, sf):
    return S.scored(spark, sf).select("clip_id", F.round(F.cume_dist().over(Window.partitionBy("cluster").orderBy("score")), 6).alias("cdf"))


@query("w29_robust_z", f"""WITH {S.SCORED}, q AS (SELECT cluster, quantile_cont(score, [0.25, 0.5, 0.75]) AS a, quantile_cont(minutes, [0.25, 0.5, 0.75]) AS b FROM s GROUP BY ALL)
  SELECT clip_id, round(greatest((score - a[2]) / CASE WHEN a[3] > a[1] THEN a[3] - a[1] ELSE 1.0 END, (minutes - b[2]) / CASE WHEN b[3] > b[1] THEN b[3] - b[1] ELSE 1.0 END), 6) AS z FROM s JOIN q USING (cluster)""")
def _(spark, sf):
    return A.robust_z(S.scored(spark, sf), ["cluster"], "score", "minutes").select("clip_id", "z")


# --- vectors, catalog, sampling, sets ---


@query("a35_centroids", f"""WITH d AS (SELECT {LAB}, i, avg(x::DOUBLE) AS x FROM (SELECT {LAB}, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) GROUP BY ALL)
  SELECT {LAB}, i::INT AS i, round(x / sqrt(sum(x * x) OVER (PARTITION BY {LAB})), 5) AS x FROM d""")
def _(spark, sf):
    c = A.centroids(S.table(spark, sf, "embeddings"), LAB)
    return c.select(LAB, F.posexplode("centroid").alias("i", "x")).withColumn("x", F.round("x", 5))


@query("f04_tag_filter", "SELECT doc_id FROM documents WHERE lang = 'en' AND source NOT IN ('src1', 'src2') AND n_chars / 15.0 BETWEEN 20.0 AND 200.0")
def _(spark, sf):
    catalog = S.table(spark, sf, "documents").select("doc_id", F.array("lang", "source").alias("tags"), (F.col("n_chars") / 15.0).alias("duration_s"))
    return A.tag_filter(catalog, ["en"], ["src1", "src2"], 20.0, 200.0).select("doc_id")


@query("f05_rejection_reason", """SELECT page_id, CASE WHEN html IS NULL OR html = '' THEN 'empty' WHEN length(html) < 800 THEN 'too_short' WHEN regexp_matches(url, '(?i)login|signup') THEN 'blocked_pattern' WHEN length(html) > 5000 THEN 'too_long' ELSE 'accepted' END AS reason FROM pages""")
def _(spark, sf):
    length = F.char_length("html")
    reason = F.when(F.col("html").isNull() | (F.col("html") == ""), "empty").when(length < 800, "too_short").when(F.col("url").rlike("(?i)login|signup"), "blocked_pattern").when(length > 5000, "too_long").otherwise("accepted")
    return S.table(spark, sf, "pages").select("page_id", reason.alias("reason"))


@query("j28_first_wins", "SELECT text_hash, min(doc_id) AS doc_id, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS n FROM (SELECT md5(text) AS text_hash, doc_id, source FROM documents) GROUP BY ALL")
def _(spark, sf):
    rows = S.table(spark, sf, "documents").select(F.md5(F.col("text").cast("binary")).alias("text_hash"), "doc_id", "source")
    return A.first_wins(rows, "text_hash", ["doc_id"], "source").withColumn("sources", F.array_join("sources", ","))


@query("k04_first_turns", turned("SELECT recording_id, turn_index FROM turns WHERE turn_index < 30"))
def _(spark, sf):
    return A.first_per_group(turns(spark, sf), ["recording_id"], ["start_us", "turn_index"], 30).select("recording_id", "turn_index")


@query("k07_disjoint_split", """WITH u AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY lang ORDER BY md5(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before, sum(n) OVER (PARTITION BY lang) AS t FROM u)
  SELECT lang, source, n, before, CASE WHEN before < 0.2 * t THEN 'test' ELSE 'train' END AS split FROM c""")
def _(spark, sf):
    return A.disjoint_split(S.table(spark, sf, "documents"), "lang", "source", 0.2)


@query("k09_round_robin", "SELECT doc_id, lang, turn FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS turn FROM documents) ORDER BY turn, lang LIMIT 100")
def _(spark, sf):
    return A.round_robin(S.table(spark, sf, "documents"), ["lang"], ["n_chars", "doc_id"], 100).select("doc_id", "lang", "turn")


@query("u01_set_operations", """WITH a AS (SELECT doc_id FROM documents WHERE lang = 'en'), b AS (SELECT doc_id FROM labels)
  SELECT (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS either, (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS shared, (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_a""")
def _(spark, sf):
    a, b = S.table(spark, sf, "documents").where("lang = 'en'").select("doc_id"), S.table(spark, sf, "labels").select("doc_id")
    one = lambda df, name: df.agg(F.count("*").alias(name))
    return one(a.union(b).distinct(), "either").join(one(a.intersect(b), "shared"), F.lit(True)).join(one(a.exceptAll(b), "only_a"), F.lit(True))


@query("m01_usage_cost", """WITH r(p_brand, rate) AS (SELECT p_brand, 0.1 * (1 + (row_number() OVER (ORDER BY p_brand)) % 7) FROM (SELECT DISTINCT p_brand FROM part))
  SELECT p_brand, sum(l_quantity)::BIGINT AS tokens, round(sum(l_quantity) * any_value(rate)::DOUBLE / 1e6, 9) AS cost, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'mixed' ELSE min(l_returnflag) END AS tier FROM lineitem JOIN part ON l_partkey = p_partkey JOIN r USING (p_brand) GROUP BY p_brand""")
def _(spark, sf):
    part = S.table(spark, sf, "part").select("p_partkey", "p_brand")
    rank = F.row_number().over(Window.orderBy("p_brand"))
    card = part.select("p_brand").distinct().select("p_brand", (F.lit(0.1) * (1 + rank % 7)).alias("rate"))
    used = S.table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.sum("l_quantity").alias("q"), F.count_distinct("l_returnflag").alias("f"), F.min("l_returnflag").alias("m"))
    return used.join(card, "p_brand").select("p_brand", F.col("q").cast("long").alias("tokens"), F.round(F.col("q") * F.col("rate") / 1e6, 9).alias("cost"), F.when(F.col("f") > 1, "mixed").otherwise(F.col("m")).alias("tier"))


# --- text ---


@query("t03_written_form", r"SELECT doc_id, md5(regexp_replace(x, '([\p{L}\p{N}])\[[^\[\]\n]*\]', '\1', 'g')) AS written FROM (SELECT doc_id, replace(text, ' the ', ' the[ðə] ') AS x FROM documents)")
def _(spark, sf):
    d = S.table(spark, sf, "documents")
    return d.select("doc_id", F.md5(T.written_form(F.replace("text", F.lit(" the "), F.lit(" the[ðə] "))).cast("binary")).alias("written"))


@query("t09_final_word", r"""SELECT doc_id, coalesce(w[-1], '') AS word, regexp_matches(coalesce(w[-1], ''), '(p|t|c|ch)$') AS stop_coda, regexp_matches(rtrim(text), '[.!?…]$') AS sentence
  FROM (SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents)""")
def _(spark, sf):
    word = T.final_word(F.col("text"))
    return S.table(spark, sf, "documents").select("doc_id", word.alias("word"), T.is_stop_coda(word).alias("stop_coda"), T.ends_sentence(F.col("text")).alias("sentence"))


@query("t12_clip_names", turned("SELECT recording_id, turn_index, printf('%s_%s_%09d-%09d_%04d.wav', recording_id, speaker_id, start_us // 1000, end_us // 1000, turn_index) AS clip, start_us // 1000 AS start_ms, end_us // 1000 AS end_ms FROM turns"))
def _(spark, sf):
    ms = lambda c: F.floor(F.col(c) / 1000)
    named = turns(spark, sf).withColumn("clip", T.clip_name(F.col("recording_id"), F.col("speaker_id"), ms("start_us"), ms("end_us"), F.col("turn_index")))
    start, end = T.clip_bounds_ms(F.col("clip"))
    return named.select("recording_id", "turn_index", "clip", start.alias("start_ms"), end.alias("end_ms"))


@query("t15_counts", r"SELECT doc_id, length(text) AS chars, len(regexp_extract_all(text, '\S+')) AS words FROM documents")
def _(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", F.char_length("text").cast("long").alias("chars"), F.regexp_count("text", F.lit(r"\S+")).cast("long").alias("words"))


@query("t01_transcript_forms")
def _(spark, sf):
    return S.table(spark, sf, "conversations").select("conv_id", "turn", T.transcript_forms(F.col("text")).alias("f")).select("conv_id", "turn", "f.*")


@query("n01_json_payload")
def _(spark, sf):
    wrapped = F.concat(F.lit("<think>so</think> here: ```json\n"), "props", F.lit("\n``` done"))
    return S.table(spark, sf, "events").select("event_id", T.json_payload(wrapped).alias("payload"))


# --- windows over events (the streaming operators, run on the batch) ---


@query("x02_tumbling_windows", "SELECT time_bucket(INTERVAL 6 HOURS, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def _(spark, sf):
    return W.window_counts(S.table(spark, sf, "events"))


@query("x02_sessions", """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTES AS session_end, count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (
  SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, s""")
def _(spark, sf):
    return W.sessions(S.table(spark, sf, "events"))


from spanloom.plans import alignment, curation, formats, judgements, planning, streams  # noqa: E402, F401 (they add their queries)
