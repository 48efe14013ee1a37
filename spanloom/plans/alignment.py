"""Queries on words, walls, two labellings, masks, keys and resampling; the registry loads them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanloom.operators import alignment as L
from spanloom.operators import folds, intervals as I
from spanloom.operators import sweeps
from spanloom.operators.timeline import along, upto_sum
from spanloom.plans.registry import _weights, query, turned, turns, union_cte
from spanloom.sources import tables as S
from spanloom.sources.scratch import settled

WORDS = """words AS (SELECT recording_id, event_id * 4 + i AS word_id, start_us + ((end_us - start_us) * i) // n + shift AS start_us, start_us + ((end_us - start_us) * (i + 1)) // n + shift AS end_us
  FROM (SELECT *, 1 + event_id % 4 AS n, (event_id % 3 - 1) * 300000 AS shift FROM turns), range(4) r(i) WHERE i < n AND ((end_us - start_us) * (i + 1)) // n > ((end_us - start_us) * i) // n)"""
HYP = "h AS (SELECT recording_id, 'u' || (user_id % 5) AS speaker_id, start_us + event_id % 1000 AS start_us, end_us + event_id % 1000 AS end_us FROM raw)"
NAMES = "m(speaker_id, mapped_from) AS (VALUES ('click', 'u0'), ('error', 'u1'), ('purchase', 'u2'), ('signup', 'u3'), ('view', 'u4'))"
WALLS = """walls AS (SELECT *, (SELECT max(b.end_us) FROM turns b WHERE b.recording_id = a.recording_id AND b.speaker_id <> a.speaker_id AND b.end_us <= a.start_us) AS wall_before_us,
  (SELECT min(b.start_us) FROM turns b WHERE b.recording_id = a.recording_id AND b.speaker_id <> a.speaker_id AND b.start_us >= a.end_us) AS wall_after_us FROM turns a)"""
FRAMES = f"{S.RAW_TURNS}, f AS (SELECT recording_id, start_us // 60000000 AS frame, avg((event_id * 37 + user_id * 11) % 100) / 100 AS p FROM raw GROUP BY ALL)"
ACTIVE = "act AS (SELECT recording_id, speaker_id, frame, count(*) AS turns FROM (SELECT recording_id, speaker_id, unnest(generate_series(start_us // 10000000, (end_us + 9999999) // 10000000 - 1)) AS frame FROM turns) GROUP BY ALL)"


def words(spark, sf):
    return words_of(turns(spark, sf))


def words_of(t):
    """One to four words a turn, shifted so that some of them straddle its bounds."""
    n, shift, length = 1 + F.col("event_id") % 4, (F.col("event_id") % 3 - 1) * 300_000, F.col("end_us") - F.col("start_us")
    each = t.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    at = lambda i: F.col("start_us") + F.floor(length * i / n) + shift
    return each.select("recording_id", (F.col("event_id") * 4 + F.col("i")).alias("word_id"), at(F.col("i")).alias("start_us"), at(F.col("i") + 1).alias("end_us")).where("end_us > start_us")


def hypothesis(spark, sf):
    shift = F.col("event_id") % 1000
    return S.raw_turns(spark, sf).select("recording_id", F.concat(F.lit("u"), (F.col("user_id") % 5).cast("string")).alias("speaker_id"), (F.col("start_us") + shift).alias("start_us"), (F.col("end_us") + shift).alias("end_us"))


def given_names(spark, sf):
    """A mapping by name for every recording."""
    of = F.create_map(*[F.lit(x) for i, s in enumerate(("click", "error", "purchase", "signup", "view")) for x in (s, f"u{i}")])
    return turns(spark, sf).select("recording_id", "speaker_id", of[F.col("speaker_id")].alias("mapped_from")).distinct()


def frames(spark, sf):
    p = (F.avg((F.col("event_id") * 37 + F.col("user_id") * 11) % 100) / 100).alias("p")
    return S.raw_turns(spark, sf).groupBy("recording_id", F.floor(F.col("start_us") / 60_000_000).alias("frame")).agg(p)


# --- words and walls ---


@query("j07_word_overlaps", turned("SELECT w.recording_id, word_id, count(*) AS turns FROM words w JOIN turns t ON w.recording_id = t.recording_id AND w.end_us > t.start_us AND w.start_us < t.end_us GROUP BY ALL", WORDS))
def _(spark, sf):
    return I.range_join(words(spark, sf), I.other(turns(spark, sf)), ["recording_id"]).groupBy("recording_id", "word_id").agg(F.count("*").alias("turns"))


@query("j08_contained_words", turned("SELECT t.recording_id, turn_index, count(*) AS words FROM turns t JOIN words w ON w.recording_id = t.recording_id AND w.start_us >= t.start_us AND w.end_us <= t.end_us GROUP BY ALL", WORDS))
def _(spark, sf):
    pairs = I.range_join(turns(spark, sf), I.other(words(spark, sf)), ["recording_id"]).where("b_start_us >= start_us AND b_end_us <= end_us")
    return pairs.groupBy("recording_id", "turn_index").agg(F.count("*").alias("words"))


ACROSS = """st AS (SELECT t.recording_id, turn_index, min(w.start_us) FILTER (WHERE w.start_us < t.start_us AND t.start_us < w.end_us) AS first_word_us, max(w.end_us) FILTER (WHERE w.start_us < t.end_us AND t.end_us < w.end_us) AS last_word_us
  FROM turns t JOIN words w ON w.recording_id = t.recording_id AND ((w.start_us < t.start_us AND t.start_us < w.end_us) OR (w.start_us < t.end_us AND t.end_us < w.end_us)) GROUP BY ALL)"""


@query("j09_straddling_words", turned("SELECT * FROM st", WORDS, ACROSS))
def _(spark, sf):
    return L.straddles(turns(spark, sf), words(spark, sf))


@query("j10_word_owners", turned("""SELECT w.recording_id, word_id, min(turn_index) FILTER (WHERE t.start_us <= w.start_us AND t.end_us >= w.end_us) AS turn_index FROM words w JOIN turns t ON w.recording_id = t.recording_id AND w.end_us > t.start_us
  AND w.start_us < t.end_us GROUP BY ALL HAVING count(*) FILTER (WHERE t.start_us <= w.start_us AND t.end_us >= w.end_us) = 1 AND count(DISTINCT t.speaker_id) = 1""", WORDS))
def _(spark, sf):
    t = settled(turns(spark, sf).select("event_id", "recording_id", "turn_index", "speaker_id", "start_us", "end_us"))
    return sweeps.word_owners(words_of(t), t)


@query("j13_safe_walls", turned("SELECT recording_id, turn_index, wall_before_us, wall_after_us FROM walls", WALLS))
def _(spark, sf):
    return L.safe_walls(turns(spark, sf)).select("recording_id", "turn_index", "wall_before_us", "wall_after_us")


@query("w10_word_lock", turned("""SELECT recording_id, turn_index, s AS start_us, e AS end_us, CASE WHEN blocked OR (shrunk AND EXISTS (SELECT 1 FROM words w WHERE w.recording_id = cut.recording_id AND ((w.start_us < s AND s < w.end_us) OR (w.start_us < e AND e < w.end_us))))
  THEN 'conflict' WHEN s >= e OR NOT EXISTS (SELECT 1 FROM words w WHERE w.recording_id = cut.recording_id AND w.end_us > s AND w.start_us < e) THEN 'no_words' ELSE 'keep' END AS action FROM cut""", WORDS, WALLS, ACROSS,
  """bound AS (SELECT *, greatest(coalesce(lag(end_us) OVER w, 0), coalesce(wall_before_us, 0)) AS low, least(coalesce(lead(start_us) OVER w, 86400000000), coalesce(wall_after_us, 86400000000)) AS high FROM walls
  WINDOW w AS (PARTITION BY recording_id ORDER BY turn_index))""",
  """cut AS (SELECT b.recording_id, b.turn_index, greatest(start_us, low) AS s, least(end_us, high) AS e, start_us < low OR end_us > high AS shrunk, coalesce(low > first_word_us, false) OR coalesce(high < last_word_us, false) AS blocked
  FROM bound b LEFT JOIN st ON b.recording_id = st.recording_id AND b.turn_index = st.turn_index)"""))
def _(spark, sf):
    return L.lock_words(turns(spark, sf), words(spark, sf))


# --- two labellings ---


def sole_cte(name: str, of: str) -> str:
    return f"""{name} AS (SELECT s.recording_id, min(t.speaker_id) AS speaker_id, s.a AS start_us, s.b AS end_us FROM (SELECT recording_id, edge AS a, lead(edge) OVER (PARTITION BY recording_id ORDER BY edge) AS b
      FROM (SELECT recording_id, start_us AS edge FROM {of} UNION SELECT recording_id, end_us FROM {of})) s JOIN {of} t ON s.recording_id = t.recording_id AND t.start_us <= s.a AND t.end_us >= s.b GROUP BY ALL HAVING count(DISTINCT t.speaker_id) = 1)"""


@query("w06_consensus", turned("SELECT recording_id, speaker_id, start_us, end_us FROM u", HYP, NAMES, sole_cte("p", "turns"), sole_cte("q", "h"), """x AS (SELECT p.recording_id, p.speaker_id, greatest(p.start_us, q.start_us) AS start_us, least(p.end_us, q.end_us) AS end_us
  FROM p JOIN m USING (speaker_id) JOIN q ON q.recording_id = p.recording_id AND q.speaker_id = m.mapped_from AND p.start_us < q.end_us AND q.start_us < p.end_us)""", union_cte("u", "x", "recording_id, speaker_id")))
def _(spark, sf):
    return L.consensus(turns(spark, sf), hypothesis(spark, sf), given_names(spark, sf))


RATES = ["""sl AS (SELECT recording_id, edge AS a, lead(edge) OVER (PARTITION BY recording_id ORDER BY edge) AS b FROM (SELECT recording_id, start_us AS edge FROM turns UNION SELECT recording_id, end_us FROM turns UNION SELECT recording_id, start_us FROM h UNION SELECT recording_id, end_us FROM h))""",
"r AS (SELECT s.recording_id, s.a, count(DISTINCT speaker_id) AS n FROM sl s JOIN turns t ON s.recording_id = t.recording_id AND t.start_us <= s.a AND t.end_us >= s.b GROUP BY ALL)",
"k AS (SELECT s.recording_id, s.a, count(DISTINCT speaker_id) AS n FROM sl s JOIN h t ON s.recording_id = t.recording_id AND t.start_us <= s.a AND t.end_us >= s.b GROUP BY ALL)",
"""c AS (SELECT recording_id, a, count(*) AS n FROM (SELECT DISTINCT s.recording_id, s.a, t.speaker_id FROM sl s JOIN turns t ON s.recording_id = t.recording_id AND t.start_us <= s.a AND t.end_us >= s.b JOIN m USING (speaker_id)
  JOIN h ON h.recording_id = s.recording_id AND h.speaker_id = m.mapped_from AND h.start_us <= s.a AND h.end_us >= s.b) GROUP BY ALL)""",
"""e AS (SELECT s.recording_id, sum(coalesce(r.n, 0) * (b - s.a)) AS speech, sum(greatest(coalesce(r.n, 0) - coalesce(k.n, 0), 0) * (b - s.a)) AS missed, sum(greatest(coalesce(k.n, 0) - coalesce(r.n, 0), 0) * (b - s.a)) AS false_us,
  sum((least(coalesce(r.n, 0), coalesce(k.n, 0)) - coalesce(c.n, 0)) * (b - s.a)) AS confused FROM sl s LEFT JOIN r ON r.recording_id = s.recording_id AND r.a = s.a LEFT JOIN k ON k.recording_id = s.recording_id AND k.a = s.a
  LEFT JOIN c ON c.recording_id = s.recording_id AND c.a = s.a WHERE b IS NOT NULL GROUP BY ALL)"""]  # fmt: skip


@query("a08_error_rates_given_names", turned("""SELECT recording_id, speech::BIGINT AS speech_us, missed::BIGINT AS missed_us, false_us::BIGINT AS false_us, confused::BIGINT AS confusion_us, round((missed + false_us + confused) / speech::DOUBLE, 6) AS der FROM e WHERE speech > 0""", HYP, NAMES, *RATES))
def _(spark, sf):
    return L.error_rates(turns(spark, sf), hypothesis(spark, sf), given_names(spark, sf))


@query("a08_error_rates")
def _(spark, sf):
    return L.error_rates(turns(spark, sf), hypothesis(spark, sf), folds.match_speakers(_weights(spark, sf)))


@query("a07_error_summary", turned("""SELECT count(*) AS recordings, round(avg(d), 6) AS mean, round(median(d), 6) AS median, round(sum(d * speech) / sum(speech)::DOUBLE, 6) AS weighted FROM (
  SELECT *, round((missed + false_us + confused) / speech::DOUBLE, 6) AS d FROM e WHERE speech > 0)""", HYP, NAMES, *RATES))
def _(spark, sf):
    rates = L.error_rates(turns(spark, sf), hypothesis(spark, sf), given_names(spark, sf))
    weighted = F.sum(F.col("der") * F.col("speech_us")) / F.sum("speech_us")
    return rates.agg(F.count("*").alias("recordings"), F.round(F.avg("der"), 6).alias("mean"), F.round(F.median("der"), 6).alias("median"), F.round(weighted, 6).alias("weighted"))


@query("a08_jaccard_errors", turned("""SELECT a.recording_id, a.speaker_id, a.us::BIGINT AS speech_us, coalesce(x.us, 0)::BIGINT AS shared_us, (a.us + coalesce(b.us, 0) - coalesce(x.us, 0))::BIGINT AS united_us, round(1 - coalesce(x.us, 0) / (a.us + coalesce(b.us, 0) - coalesce(x.us, 0))::DOUBLE, 6) AS jaccard_error
  FROM (SELECT recording_id, speaker_id, sum(end_us - start_us) AS us FROM ua GROUP BY ALL) a JOIN m USING (speaker_id) LEFT JOIN (SELECT recording_id, speaker_id, sum(end_us - start_us) AS us FROM ub GROUP BY ALL) b ON b.recording_id = a.recording_id AND b.speaker_id = mapped_from
  LEFT JOIN (SELECT ua.recording_id, ua.speaker_id, sum(least(ua.end_us, ub.end_us) - greatest(ua.start_us, ub.start_us)) AS us FROM ua JOIN m USING (speaker_id) JOIN ub ON ub.recording_id = ua.recording_id AND ub.speaker_id = mapped_from AND ua.start_us < ub.end_us AND ub.start_us < ua.end_us GROUP BY ALL) x
  ON x.recording_id = a.recording_id AND x.speaker_id = a.speaker_id""", HYP, NAMES, union_cte("ua", "turns", "recording_id, speaker_id"), union_cte("ub", "h", "recording_id, speaker_id")))
def _(spark, sf):
    return L.jaccard_errors(turns(spark, sf), hypothesis(spark, sf), given_names(spark, sf))


@query("a07_speaker_count_error", turned("SELECT recording_id, coalesce(a.n, 0) AS expected, coalesce(b.n, 0) AS found, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS error FROM (SELECT recording_id, count(DISTINCT speaker_id) AS n FROM turns GROUP BY ALL) a FULL JOIN (SELECT recording_id, count(DISTINCT speaker_id) AS n FROM h GROUP BY ALL) b USING (recording_id)", HYP))
def _(spark, sf):
    return L.speaker_count_error(turns(spark, sf), hypothesis(spark, sf))


@query("a30_paired_bootstrap", f"""WITH {S.VERDICTS}, c AS (SELECT *, row_number() OVER (ORDER BY recording_id) - 1 AS k, count(*) OVER () AS c FROM (SELECT recording_id, sum((candidate = reference)::INT) AS h0, count(candidate = reference) AS n0, sum((n_chars % 3 > 0)::INT) AS h1, count(*) AS n1 FROM v GROUP BY ALL)),
  d AS (SELECT r, ('0x' || substr(md5('123:' || r || ':' || i), 1, 8))::BIGINT % c AS k FROM range(200) x(r), (SELECT k AS i, c FROM c)), s AS (SELECT r, sum(h0) / sum(n0)::DOUBLE - sum(h1) / sum(n1)::DOUBLE AS g FROM d JOIN c USING (k) GROUP BY r)
  SELECT count(*) AS replicates, round(quantile_cont(g, 0.025), 6) AS low, round(quantile_cont(g, 0.5), 6) AS middle, round(quantile_cont(g, 0.975), 6) AS high FROM s WHERE g IS NOT NULL""")
def _(spark, sf):
    judged = S.verdicts(spark, sf).withColumn("a", (F.col("candidate") == F.col("reference")).cast("int")).withColumn("b", (F.col("n_chars") % 3 > 0).cast("int"))
    return L.paired_bootstrap(judged, "recording_id", "a", "b", 200, 123)


@query("g12_activity_frames", turned("SELECT * FROM act", ACTIVE))
def _(spark, sf):
    return L.activity(turns(spark, sf), 10_000_000)


@query("w22_dice", turned("""SELECT a.recording_id, a.speaker_id, b.speaker_id AS b_speaker_id, count(*) AS shared, round(2 * count(*) / (a.n + b.n)::DOUBLE, 6) AS dice FROM s a JOIN s b ON a.recording_id = b.recording_id AND a.frame = b.frame AND a.speaker_id < b.speaker_id
  GROUP BY a.recording_id, a.speaker_id, b.speaker_id, a.n, b.n""", ACTIVE, "s AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY recording_id, speaker_id) AS n FROM act) WHERE n >= 4)"))
def _(spark, sf):
    return L.dice(L.activity(turns(spark, sf), 10_000_000))


@query("w14_low_spans", f"WITH {FRAMES} SELECT recording_id, min(frame) AS first_frame, max(frame) + 1 AS end_frame FROM (SELECT *, frame - row_number() OVER (PARTITION BY recording_id ORDER BY frame) AS g FROM f WHERE p < 0.5) GROUP BY recording_id, g HAVING count(*) >= 2")
def _(spark, sf):
    return L.frame_runs(frames(spark, sf).where("p < 0.5"), 2)


@query("w24_sustained_runs", f"WITH {FRAMES} SELECT recording_id, min(frame) AS first_frame, max(frame) + 1 AS end_frame FROM (SELECT *, frame - row_number() OVER (PARTITION BY recording_id ORDER BY frame) AS g FROM f WHERE p >= 0.4) GROUP BY recording_id, g HAVING count(*) >= 3")
def _(spark, sf):
    return L.frame_runs(frames(spark, sf).where("p >= 0.4"), 3)


@query("w23_running_mean", turned("SELECT recording_id, turn_index, (sum(k) OVER w * 10000 // count(k) OVER w)::BIGINT AS mean_micro FROM (SELECT *, round(confidence * 100)::BIGINT AS k FROM turns) WINDOW w AS (PARTITION BY recording_id, speaker_id ORDER BY turn_index ROWS UNBOUNDED PRECEDING)"))
def _(spark, sf):
    """In millionths, from sums of whole hundredths."""
    whole = turns(spark, sf).withColumn("k", F.round(F.col("confidence") * 100).cast("long"))
    sums = along(whole, ["recording_id", "speaker_id"], ["start_us", "turn_index"], s=upto_sum("k"), n=upto_sum(F.col("k").isNotNull().cast("long")))
    return sums.select("recording_id", "turn_index", F.floor(F.try_divide(F.col("s") * 10000, F.col("n"))).alias("mean_micro"))


@query("w23_running_profile", "SELECT label, vec_id, i::INT AS i, sum(x) OVER (PARTITION BY label, i ORDER BY vec_id ROWS UNBOUNDED PRECEDING)::BIGINT AS total, count(*) OVER (PARTITION BY label, i ORDER BY vec_id ROWS UNBOUNDED PRECEDING) AS n FROM (SELECT label, vec_id, floor(unnest(embedding)::DOUBLE * 1000000)::BIGINT AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)")
def _(spark, sf):
    """A profile after each of its vectors, as sums of millionths and their number, dimension by dimension."""
    dims = S.table(spark, sf, "embeddings").select("label", "vec_id", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.floor(F.col("x").cast("double") * 1_000_000))
    return along(dims, ["label", "i"], ["vec_id"], at="vec_id", width=1 << 16, total=upto_sum("x"), n=upto_sum(F.lit(1).cast("long"))).drop("x")


# --- keys, picks, resampling ---


@query("j20_first_key_that_matches", """SELECT doc_id, arg_min(key, place) AS key, min(place) AS place FROM (SELECT d.doc_id, c.key, c.place FROM documents d, LATERAL (VALUES (d.doc_id, 0), (d.doc_id * 2, 1), (d.doc_id // 2, 2)) c(key, place)) x
  JOIN (SELECT DISTINCT doc_id AS key FROM labels) l USING (key) GROUP BY doc_id""")
def _(spark, sf):
    keys = F.array(F.col("doc_id"), F.col("doc_id") * 2, F.floor(F.col("doc_id") / 2))
    asked = S.table(spark, sf, "documents").select("doc_id", F.posexplode(keys).alias("place", "key"))
    known = S.table(spark, sf, "labels").select(F.col("doc_id").alias("key")).distinct()
    return asked.join(known, "key").groupBy("doc_id").agg(F.min_by("key", "place").alias("key"), F.min("place").alias("place"))


@query("j21_covered", "SELECT count(*) AS asked, count(l.doc_id) AS found, count(*) = count(l.doc_id) AS complete FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE lang = 'en'")
def _(spark, sf):
    known = S.table(spark, sf, "labels").select("doc_id").distinct().withColumn("_l", F.lit(1))
    n, found = F.count("*"), F.count("_l")
    return S.table(spark, sf, "documents").where("lang = 'en'").join(known, "doc_id", "left").agg(n.alias("asked"), found.alias("found"), (n == found).alias("complete"))


@query("k08_one_per_source", "SELECT source, arg_min(doc_id, md5(doc_id::VARCHAR)) AS doc_id FROM documents GROUP BY ALL")
def _(spark, sf):
    return S.table(spark, sf, "documents").groupBy("source").agg(F.min_by("doc_id", F.md5(F.col("doc_id").cast("string").cast("binary"))).alias("doc_id"))


@query("k14_drop_share", r"""WITH o AS (SELECT doc_id, md5(doc_id || ':' || i) AS h FROM (SELECT doc_id, unnest(range(len(regexp_extract_all(text, ',')))) AS i FROM documents))
  SELECT doc_id, count(*) AS kept FROM (SELECT *, row_number() OVER (ORDER BY h) AS r, count(*) OVER () AS n FROM o) WHERE r > floor(n * 0.25) GROUP BY ALL""")
def _(spark, sf):
    docs = S.table(spark, sf, "documents").select("doc_id", F.regexp_count("text", F.lit(",")).alias("n")).where("n > 0")
    each = docs.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    hashed = each.withColumn("h", F.md5(F.concat_ws(":", "doc_id", "i").cast("binary")))
    return L.drop_share(hashed, "h", 0.25).groupBy("doc_id").agg(F.count("*").alias("kept"))


@query("a30_cluster_bootstrap", f"""WITH {S.VERDICTS}, c AS (SELECT *, row_number() OVER (ORDER BY recording_id) - 1 AS k, count(*) OVER () AS c FROM (SELECT recording_id, sum((candidate = reference)::INT) AS hits, count(candidate = reference) AS n FROM v GROUP BY ALL)),
  d AS (SELECT r, ('0x' || substr(md5('42:' || r || ':' || i), 1, 8))::BIGINT % c AS k FROM range(1000) x(r), (SELECT k AS i, c FROM c)),
  s AS (SELECT r, sum(hits) / sum(n)::DOUBLE AS rate FROM d JOIN c USING (k) GROUP BY r)
  SELECT count(*) AS replicates, round(quantile_cont(rate, 0.025), 6) AS low, round(quantile_cont(rate, 0.5), 6) AS middle, round(quantile_cont(rate, 0.975), 6) AS high FROM s WHERE rate IS NOT NULL""")
def _(spark, sf):
    judged = S.verdicts(spark, sf).withColumn("hit", (F.col("candidate") == F.col("reference")).cast("int"))
    return L.cluster_bootstrap(judged, "recording_id", "hit", 1000, 42)


@query("m02_storage_cost", "SELECT l_orderkey, round(sum(l_quantity * (600 * l_linenumber) / 3600.0 * 0.5) / 1e6, 9) AS cost FROM lineitem GROUP BY ALL")
def _(spark, sf):
    hours = F.lit(600) * F.col("l_linenumber") / 3600.0
    return S.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum(F.col("l_quantity") * hours * 0.5) / 1e6, 9).alias("cost"))


@query("m10_gated_fusion", f"WITH {S.SCORED}, c AS (SELECT *, cume_dist() OVER (PARTITION BY cluster ORDER BY score) AS q FROM s) SELECT clip_id, round(CASE WHEN pre_gate THEN 1.0 WHEN q > 0.9 THEN greatest(q, score / 96) ELSE score / 96 END, 6) AS fused FROM c")
def _(spark, sf):
    q, own = F.cume_dist().over(Window.partitionBy("cluster").orderBy("score")), F.col("score") / 96
    fused = F.when(F.col("pre_gate"), 1.0).when(F.col("q") > 0.9, F.greatest("q", own)).otherwise(own)
    return S.scored(spark, sf).withColumn("q", q).select("clip_id", F.round(fused, 6).alias("fused"))
