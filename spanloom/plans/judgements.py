"""Queries on verdicts, usage, calibration and the joins between manifests and artifacts; the registry loads them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanloom.operators import analytics as A
from spanloom.operators import judging as J
from spanloom.operators import intervals as I
from spanloom.plans.registry import _AUDIT, _audit, query, turned, turns
from spanloom.sources import tables as S

# --- counts and rates over verdicts ---

STATUS = "CASE WHEN candidate IS NULL THEN 'missing_candidate' WHEN reference = candidate THEN 'agree' WHEN candidate = 'pass' THEN 'bad_accept' ELSE 'false_reject' END"


@query("a01_count_by_key", f"WITH {S.VERDICTS} SELECT family, {STATUS} AS status, count(*) AS n FROM v GROUP BY ALL")
def _(spark, sf):
    return J.with_status(S.verdicts(spark, sf)).groupBy("family", "status").agg(F.count("*").alias("n"))


@query("a02_merge_metrics", turned("""SELECT recording_id, count(*) AS merged, sum(sources - 1)::BIGINT AS joins, count(*) FILTER (WHERE us < 5000000) AS too_short, count(*) FILTER (WHERE us > 60000000) AS too_long,
  coalesce(sum(us) FILTER (WHERE us BETWEEN 5000000 AND 60000000), 0)::BIGINT AS kept_us FROM (SELECT *, end_us - start_us AS us FROM merged) GROUP BY ALL""", *_AUDIT[:3]))
def _(spark, sf):
    merged = I.merge_turns(turns(spark, sf), 120_000_000).withColumn("us", F.col("end_us") - F.col("start_us"))
    return J.merge_metrics(merged, 5_000_000, 60_000_000)


@query("a05_audit_rollup", turned("""SELECT count(*) AS recordings, sum(raw_ms)::BIGINT AS raw_ms, sum(final_ms)::BIGINT AS final_ms, round(sum(final_ms) / sum(raw_ms)::DOUBLE, 6) AS final_yield FROM (
  SELECT (raw_us + 500) // 1000 AS raw_ms, (coalesce(final_us, 0) + 500) // 1000 AS final_ms FROM s_raw LEFT JOIN s_final USING (recording_id))""", *_AUDIT))
def _(spark, sf):
    ms = lambda c: F.floor((F.col(c) + 500) / 1000)
    each = _audit(spark, sf).select(ms("raw_us").alias("raw_ms"), ms("final_us").alias("final_ms"))
    sums = each.agg(F.count("*").alias("recordings"), F.sum("raw_ms").alias("raw_ms"), F.sum("final_ms").alias("final_ms"))
    return sums.withColumn("final_yield", A.ratio(F.col("final_ms"), F.col("raw_ms")))


@query("r03_loss_lines", turned("SELECT recording_id, printf('%s | %.1f s | %.1f s | %.2f%%', recording_id, raw_us // 100000 / 10.0, coalesce(final_us, 0) // 100000 / 10.0, coalesce(final_us, 0) * 10000 // raw_us / 100.0) AS line FROM s_raw LEFT JOIN s_final USING (recording_id)", *_AUDIT))
def _(spark, sf):
    tenths = lambda c: F.floor(F.col(c) / 100_000) / 10
    share = F.floor(F.col("final_us") * 10_000 / F.col("raw_us")) / 100
    return _audit(spark, sf).select("recording_id", F.format_string("%s | %.1f s | %.1f s | %.2f%%", "recording_id", tenths("raw_us"), tenths("final_us"), share).alias("line"))


@query("r04_stale_audits", turned("SELECT recording_id, CASE WHEN n % 3 = 0 THEN 'missing' WHEN n % 3 = 1 THEN 'stale' ELSE 'current' END AS state FROM (SELECT recording_id, count(*) AS n FROM turns GROUP BY ALL)"))
def _(spark, sf):
    now = turns(spark, sf).groupBy("recording_id").agg(F.count("*").alias("n"))
    kept = now.where("n % 3 > 0").select("recording_id", (F.col("n") - (F.col("n") % 3 == 1).cast("int")).alias("n"))
    return J.audit_states(now, kept, "recording_id", "n")


@query("a10_rates_or_zero", f"""WITH {S.VERDICTS}, c AS (SELECT recording_id, count(*) FILTER (WHERE reference = 'reject' AND candidate = 'reject') AS tp, count(*) FILTER (WHERE reference = 'pass' AND candidate = 'reject') AS fp,
  count(*) FILTER (WHERE reference = 'reject' AND candidate = 'pass') AS fn FROM v GROUP BY ALL)
  SELECT recording_id, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 4) AS recall FROM c""")
def _(spark, sf):
    return J.rates_or_zero(S.verdicts(spark, sf), ["recording_id"])


TEXTS = """x AS (SELECT *, CASE WHEN reference = 'pass' THEN text END AS ref_text, CASE WHEN candidate = 'pass' THEN CASE key % 3 WHEN 0 THEN text WHEN 1 THEN upper(text) ELSE text || '.' END END AS cand_text FROM v)"""


@query("a12_transcript_status", f"""WITH {S.VERDICTS}, {TEXTS}, s AS (SELECT *, CASE WHEN coalesce(ref_text, '') = '' THEN 'not_applicable' WHEN coalesce(cand_text, '') = '' THEN 'missing_candidate' WHEN ref_text = cand_text THEN 'exact_match' ELSE 'different' END AS status FROM x)
  SELECT family, count(*) FILTER (WHERE status = 'not_applicable') AS not_applicable, count(*) FILTER (WHERE status = 'missing_candidate') AS missing_candidate, count(*) FILTER (WHERE status = 'exact_match') AS exact_match,
  count(*) FILTER (WHERE status = 'different') AS different, round(count(*) FILTER (WHERE status = 'exact_match') / nullif(count(*) FILTER (WHERE status IN ('exact_match', 'different')), 0)::DOUBLE, 6) AS exact_rate,
  round(count(*) FILTER (WHERE status IN ('exact_match', 'different')) / nullif(count(*) FILTER (WHERE status <> 'not_applicable'), 0)::DOUBLE, 6) AS coverage FROM s GROUP BY ALL""")
def _(spark, sf):
    given = F.when(F.col("key") % 3 == 0, F.col("text")).when(F.col("key") % 3 == 1, F.upper("text")).otherwise(F.concat("text", F.lit(".")))
    rows = S.verdicts(spark, sf).withColumn("ref_text", F.when(F.col("reference") == "pass", F.col("text"))).withColumn("cand_text", F.when(F.col("candidate") == "pass", given))
    return J.text_status_counts(rows, "family", "ref_text", "cand_text")


# --- usage and cost ---

USAGE = """u AS (SELECT l_orderkey * 8 + l_linenumber AS call_id, 'm' || (l_partkey % 5) AS model, CASE l_suppkey % 3 WHEN 0 THEN 'standard' WHEN 1 THEN 'batch' ELSE 'flex' END AS tier, l_quantity::BIGINT * 9000 AS prompt_tokens,
  (l_suppkey % 4) * 3200 AS audio_tokens, (l_partkey % 7) * 1000 AS text_tokens, (l_orderkey % 6) * 2500 AS cached_tokens, (l_orderkey % 3) * 800 AS cached_audio_tokens, (l_suppkey % 50) * 10 AS output_tokens, l_linenumber * 20 AS thinking_tokens, l_quantity::BIGINT AS minutes FROM lineitem)"""
CARD = """card(model, mode, input, audio_input, cached, cached_audio, output, long_from) AS (VALUES ('m0', 'standard', 75, 75, 8, 8, 375, NULL), ('m0', 'batch', 37, 37, 4, 4, 187, NULL), ('m1', 'standard', 25, 50, 3, 5, 150, NULL),
  ('m1', 'batch', 12, 25, 1, 2, 75, NULL), ('m2', 'standard', 200, 200, 20, 20, 1200, 200000), ('m2', 'batch', 100, 100, 20, 20, 600, 200000), ('m3', 'standard', 30, 30, 3, 3, 250, NULL), ('m3', 'batch', 15, 15, 2, 2, 125, NULL))"""
PRICED = """s1 AS (SELECT *, least(audio_tokens, prompt_tokens) AS a, least(text_tokens, prompt_tokens - least(audio_tokens, prompt_tokens)) AS t, least(cached_tokens, prompt_tokens) AS c FROM u),
  s2 AS (SELECT *, prompt_tokens - a - t AS o, least(cached_audio_tokens, a, c) AS ca FROM s1), s3 AS (SELECT *, least(o, c - ca) AS co FROM s2), s4 AS (SELECT *, least(t, c - ca - co) AS ct FROM s3),
  s5 AS (SELECT *, ca + least(a - ca, c - ca - co - ct) AS fa FROM s4),
  p AS (SELECT s5.*, ((a - fa) * audio_input + (t - ct + o - co) * input + fa * cached_audio + (ct + co) * cached) * CASE WHEN prompt_tokens > long_from THEN 4 ELSE 2 END
    + (output_tokens + thinking_tokens) * output * CASE WHEN prompt_tokens > long_from THEN 3 ELSE 2 END AS cost FROM s5 LEFT JOIN card ON card.model = s5.model AND card.mode = CASE WHEN tier = 'standard' THEN 'standard' ELSE 'batch' END)"""
#: Rates of a fixture card, in hundredths of a currency unit for a million tokens.
RATES = [
    ("m0", "standard", 75, 75, 8, 8, 375, None), ("m0", "batch", 37, 37, 4, 4, 187, None), ("m1", "standard", 25, 50, 3, 5, 150, None), ("m1", "batch", 12, 25, 1, 2, 75, None),
    ("m2", "standard", 200, 200, 20, 20, 1200, 200000), ("m2", "batch", 100, 100, 20, 20, 600, 200000), ("m3", "standard", 30, 30, 3, 3, 250, None), ("m3", "batch", 15, 15, 2, 2, 125, None),
]


def priced(spark, sf):
    card = spark.createDataFrame(RATES, "model string, mode string, input long, audio_input long, cached long, cached_audio long, output long, long_from long")
    return J.price(S.usage(spark, sf), card)


@query("m01_call_costs", f"WITH {USAGE}, {CARD}, {PRICED} SELECT call_id, cost, round(cost / 2e8, 9) AS amount FROM p")
def _(spark, sf):
    return priced(spark, sf).select("call_id", "cost", F.round(F.col("cost") / 2e8, 9).alias("amount"))


@query("a17_cost_summary", f"""WITH {USAGE}, {CARD}, {PRICED} SELECT count(*) AS calls, sum(cost)::BIGINT AS cost, round(sum(cost) / count(*)::DOUBLE, 4) AS mean, quantile_cont(cost, 0.25) AS p25, quantile_cont(cost, 0.5) AS p50,
  quantile_cont(cost, 0.75) AS p75, quantile_cont(cost, 0.95) AS p95, round(sum(cost) / sum(minutes)::DOUBLE, 6) AS per_minute, sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(output_tokens)::BIGINT AS output_tokens FROM p WHERE cost > 0""")
def _(spark, sf):
    q = F.percentile("cost", [0.25, 0.5, 0.75, 0.95])
    total = priced(spark, sf).where("cost > 0").agg(
        F.count("*").alias("calls"), F.sum("cost").alias("cost"), F.round(F.sum("cost") / F.count("*"), 4).alias("mean"), q.alias("_q"),
        F.round(F.sum("cost") / F.sum("minutes"), 6).alias("per_minute"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("output_tokens").alias("output_tokens"),
    )
    return total.withColumns({c: F.col("_q")[i] for i, c in enumerate(("p25", "p50", "p75", "p95"))}).drop("_q")


@query("a18_usage_totals", f"""WITH {USAGE}, {CARD}, {PRICED} SELECT model, count(*) AS calls, count(cost) AS priced, count(*) - count(cost) AS unpriced, sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(cost)::BIGINT AS cost,
  CASE WHEN count(DISTINCT tier) > 1 THEN 'mixed' ELSE min(tier) END AS tier FROM p GROUP BY ALL""")
def _(spark, sf):
    tier = F.when(F.min("tier") != F.max("tier"), "mixed").otherwise(F.min("tier"))
    n, known = F.count("*"), F.count("cost")
    return priced(spark, sf).groupBy("model").agg(n.alias("calls"), known.alias("priced"), (n - known).alias("unpriced"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("cost").alias("cost"), tier.alias("tier"))


@query("n05_usage_by_modality", f"""WITH {USAGE} SELECT call_id, CASE WHEN audio_tokens > 0 THEN audio_tokens ELSE least(prompt_tokens, minutes * 60 * 32) END AS audio_tokens, audio_tokens = 0 AS estimated,
  CASE WHEN audio_tokens > 0 THEN text_tokens ELSE greatest(text_tokens, prompt_tokens - least(prompt_tokens, minutes * 60 * 32)) END AS text_tokens, least(prompt_tokens, cached_tokens) AS cached_tokens FROM u""")
def _(spark, sf):
    return J.by_modality(S.usage(spark, sf), F.col("minutes") * 60).select("call_id", "audio_tokens", "estimated", "text_tokens", "cached_tokens")


@query("a19_error_rates", f"""WITH {S.VERDICTS}, k(category) AS (VALUES ('low_quality'), ('toxic'), ('silence')), m AS (SELECT family, count(candidate) AS judged, count(*) FILTER (WHERE candidate = 'reject') AS rejected FROM v GROUP BY ALL),
  e AS (SELECT family, category, count(*) AS n FROM (SELECT family, 'low_quality' AS category FROM v WHERE quality = 0 UNION ALL SELECT family, 'toxic' FROM v WHERE toxic = 1) GROUP BY ALL)
  SELECT family, category, coalesce(n, 0) AS n, CASE WHEN category = 'toxic' THEN rejected ELSE judged END AS among, round(coalesce(n, 0) / nullif(CASE WHEN category = 'toxic' THEN rejected ELSE judged END, 0)::DOUBLE, 6) AS rate
  FROM m CROSS JOIN k LEFT JOIN e USING (family, category)""")
def _(spark, sf):
    return J.error_rates_by_category(S.verdicts(spark, sf), ["low_quality", "toxic", "silence"], {"toxic"})


@query("a20_model_groups", """SELECT substr(sha256('{"backend":"' || o_orderstatus || '","model":"' || o_orderpriority || '"}'), 1, 10) AS id, o_orderstatus AS backend, o_orderpriority AS model, count(*) AS n FROM orders GROUP BY ALL""")
def _(spark, sf):
    named = S.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("backend"), F.col("o_orderpriority").alias("model"))
    return J.group_ids(named, ["backend", "model"])


@query("a21_prompt_groups", "SELECT DISTINCT o_orderstatus AS backend, md5(o_orderpriority) AS prompt_hash FROM orders")
def _(spark, sf):
    return S.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("backend"), F.md5(F.col("o_orderpriority").cast("binary")).alias("prompt_hash")).distinct()


@query("a22_emotions", f"""WITH {S.VERDICTS} SELECT lower(trim(emotion)) AS emotion, count(*) FILTER (WHERE candidate = 'pass') AS passed, count(*) FILTER (WHERE candidate = 'reject') AS rejected, sum(n_chars)::BIGINT AS length
  FROM (SELECT *, CASE key % 3 WHEN 0 THEN ' ' || upper(family) ELSE family || ' ' END AS emotion FROM v) GROUP BY ALL""")
def _(spark, sf):
    said = F.when(F.col("key") % 3 == 0, F.concat(F.lit(" "), F.upper("family"))).otherwise(F.concat("family", F.lit(" ")))
    by = S.verdicts(spark, sf).groupBy(F.lower(F.trim(said)).alias("emotion"))
    return by.agg(F.count_if(F.col("candidate") == "pass").alias("passed"), F.count_if(F.col("candidate") == "reject").alias("rejected"), F.sum("n_chars").alias("length"))


# --- scores ---


@query("a26_detection_rates", f"""WITH {S.SCORED}, t AS (SELECT 0.05 AS false_rejects, quantile_cont(score, 0.95) AS thr FROM s WHERE label = 0 UNION ALL SELECT 0.1, quantile_cont(score, 0.9) FROM s WHERE label = 0)
  SELECT false_rejects::DOUBLE AS false_rejects, minutes % 3 AS severity, count(*) AS n, count(*) FILTER (WHERE score >= thr) AS found, round(count(*) FILTER (WHERE score >= thr) / count(*)::DOUBLE, 6) AS rate FROM s, t WHERE label = 1 GROUP BY ALL""")
def _(spark, sf):
    return J.detection_rates(S.scored(spark, sf).withColumn("severity", F.col("minutes") % 3), "severity", [0.05, 0.1])


LEX = """lx AS (SELECT cluster, clip_id, minutes, label, row_number() OVER (PARTITION BY cluster ORDER BY pre_gate, score > 80, score, clip_id) AS place FROM s),
  curve AS (SELECT cluster, place, sum(minutes) OVER w AS accepted, sum(minutes * label) OVER w AS bad, sum(minutes) OVER (PARTITION BY cluster) AS all_m FROM lx WINDOW w AS (PARTITION BY cluster ORDER BY place ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT DISTINCT cluster, 0, 0, 0, 1 FROM s)"""


@query("a28_lexicographic_curve", f"WITH {S.SCORED}, {LEX} SELECT cluster, place::INT AS place, accepted::BIGINT AS accepted, bad::BIGINT AS bad, round(accepted / all_m::DOUBLE, 6) AS yield, round(bad / nullif(accepted, 0)::DOUBLE, 6) AS r FROM curve")
def _(spark, sf):
    return J.lexicographic_curve(S.scored(spark, sf).withColumn("flag_edge", F.col("score") > 80), ["cluster"], ["pre_gate", "flag_edge", "score", "clip_id"])


@query("a34_folded_calibration", f"""WITH {S.SCORED}, f AS (SELECT *, ('0x' || substr(md5(cluster), 1, 6))::BIGINT % 5 AS fold FROM s WHERE label = 0), t AS (SELECT k AS fold, quantile_cont(score, 0.95) AS thr FROM f, range(5) x(k) WHERE fold <> k GROUP BY k)
  SELECT f.fold, round(any_value(thr), 6) AS threshold, count(*) AS n, round(count(*) FILTER (WHERE score <= thr) / count(*)::DOUBLE, 6) AS specificity FROM f JOIN t USING (fold) GROUP BY f.fold""")
def _(spark, sf):
    return J.folded_calibration(S.scored(spark, sf).where("label = 0"), "cluster", 5, 0.95)


@query("a36_dominant_speaker", turned("""SELECT recording_id, arg_max(speaker_id, (us, speaker_id)) AS speaker_id, max(us)::BIGINT AS dominant_us, (sum(us) - max(us))::BIGINT AS secondary_us,
  CASE WHEN (sum(us) - max(us)) * 20 <= sum(us) THEN 'pass' WHEN (sum(us) - max(us)) * 4 > sum(us) * 3 THEN 'reject' ELSE 'uncertain' END AS decision FROM (SELECT recording_id, speaker_id, sum(end_us - start_us) AS us FROM turns GROUP BY ALL) GROUP BY ALL"""))
def _(spark, sf):
    return J.dominant_speaker(turns(spark, sf), 1 / 20, 3 / 4)


@query("a38_control_checks", f"""WITH {S.VERDICTS} SELECT round(count(candidate) / count(*)::DOUBLE, 6) AS valid_rate, round(count(*) FILTER (WHERE reference = 'pass' AND candidate = 'pass') / nullif(count(candidate) FILTER (WHERE reference = 'pass'), 0)::DOUBLE, 6) AS clean_pass,
  round(count(*) FILTER (WHERE reference = 'reject' AND candidate = 'reject') / nullif(count(candidate) FILTER (WHERE reference = 'reject'), 0)::DOUBLE, 6) AS defect_reject, count(*) FILTER (WHERE n_chars = 0 AND candidate = 'pass') AS silence_passes,
  coalesce(count(candidate) >= 0.95 * count(*) AND count(*) FILTER (WHERE reference = 'pass' AND candidate = 'pass') >= 0.8 * count(candidate) FILTER (WHERE reference = 'pass') AND count(*) FILTER (WHERE reference = 'reject' AND candidate = 'reject') >= 0.7 * count(candidate) FILTER (WHERE reference = 'reject')
  AND count(*) FILTER (WHERE n_chars = 0 AND candidate = 'pass') = 0, false) AS accepted FROM v""")
def _(spark, sf):
    return J.control_checks(S.verdicts(spark, sf), F.col("n_chars") == 0)


@query("a39_decisions_by_recording", f"WITH {S.VERDICTS} SELECT recording_id, count(*) FILTER (WHERE candidate = 'pass') AS pass, count(*) FILTER (WHERE candidate = 'reject') AS reject, count(*) FILTER (WHERE candidate IS NULL) AS missing FROM v GROUP BY ALL")
def _(spark, sf):
    return J.crosstab(S.verdicts(spark, sf).withColumn("candidate", F.coalesce("candidate", F.lit("missing"))), "recording_id", "candidate", ["pass", "reject", "missing"])


@query("a40_device_comparison", f"""WITH {S.RAW_TURNS}, f AS (SELECT recording_id, start_us // 60000000 AS frame, sum((event_id * 37) % 100) // count(*) AS p, sum((event_id * 37 + user_id % 3) % 100) // count(*) AS q FROM raw GROUP BY ALL)
  SELECT recording_id, max(abs(p - q))::BIGINT AS worst, round(sum(abs(p - q)) / count(*)::DOUBLE, 6) AS mean, count(*) FILTER (WHERE (p >= 50) <> (q >= 50)) AS disagreements FROM f GROUP BY ALL""")
def _(spark, sf):
    frames = S.raw_turns(spark, sf).groupBy("recording_id", F.floor(F.col("start_us") / 60_000_000).alias("frame"))
    whole = lambda x: F.floor(F.sum(x) / F.count("*"))
    p, q = frames.agg(whole((F.col("event_id") * 37) % 100).alias("p")), frames.agg(whole((F.col("event_id") * 37 + F.col("user_id") % 3) % 100).alias("q"))
    return J.compare_tracks(p, q, ["recording_id"], 50)


@query("a41_handoff_summary", f"""WITH {S.VERDICTS} SELECT count(*) AS clips, count(*) FILTER (WHERE candidate IS NULL) AS unresolved, count(*) FILTER (WHERE candidate = 'pass' AND coalesce(trim(text), '') = '') AS needs_transcription,
  coalesce(sum(n_chars) FILTER (WHERE candidate = 'pass'), 0)::BIGINT AS passed_length, sum(n_chars)::BIGINT AS length FROM v""")
def _(spark, sf):
    ok = F.col("candidate") == "pass"
    return S.verdicts(spark, sf).agg(
        F.count("*").alias("clips"), F.count_if(F.col("candidate").isNull()).alias("unresolved"), F.count_if(ok & (F.coalesce(F.trim("text"), F.lit("")) == "")).alias("needs_transcription"),
        F.coalesce(F.sum(F.when(ok, F.col("n_chars"))), F.lit(0)).alias("passed_length"), F.sum("n_chars").alias("length"),
    )


@query("a42_crawl_summary", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS copy FROM documents) SELECT source, count(*) AS seen, count(*) FILTER (WHERE n_chars < 200) AS rejected,
  count(*) FILTER (WHERE n_chars >= 200 AND copy > 1) AS duplicates, count(*) FILTER (WHERE n_chars >= 200 AND copy = 1) AS accepted, count(*) FILTER (WHERE n_chars >= 200 AND copy = 1) > 20 AS truncated FROM r GROUP BY ALL""")
def _(spark, sf):
    return J.crawl_summary(S.table(spark, sf, "documents"), F.md5(F.col("text").cast("binary")), F.col("n_chars") < 200, 20)


@query("a44_ablation", f"""WITH {S.SCORED}, x AS (SELECT cluster, label, name, CASE name WHEN 'full' THEN score + 100 * pre_gate::INT WHEN 'content' THEN score ELSE 100.0 * pre_gate::INT END AS score FROM s, (VALUES ('full'), ('content'), ('gate')) n(name)),
  b AS (SELECT name, score, sum(label) AS pos, sum(1 - label) AS neg FROM x GROUP BY ALL), w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY name ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM b)
  SELECT name, sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives, round(sum(pos * (below + neg / 2.0::DOUBLE)) / nullif(sum(pos) * sum(neg), 0)::DOUBLE, 6) AS auroc FROM w GROUP BY ALL""")
def _(spark, sf):
    gate = F.col("pre_gate").cast("int") * 100.0
    rows = S.scored(spark, sf).select("label", (F.col("score") + gate).alias("full"), F.col("score").alias("content"), gate.alias("gate"))
    long = rows.unpivot("label", ["full", "content", "gate"], "name", "score")
    return A.auroc(long, ["name"])


@query("w28_percentile_of_reference", f"""WITH {S.SCORED}, g AS (SELECT score FROM s WHERE label = 0) SELECT clip_id, round((SELECT count(*) FROM g WHERE g.score <= s.score) / (SELECT count(*) FROM g)::DOUBLE, 6) AS share FROM s""")
def _(spark, sf):
    return J.share_below(S.scored(spark, sf), S.scored(spark, sf).where("label = 0"), "score").select("clip_id", "share")


@query("m03_logistic_head", """SELECT vec_id, round(1 / (1 + exp(-greatest(-50, least(50, s)))), 6) AS p FROM (SELECT vec_id, sum((x::DOUBLE - 0.01) / 0.5 * ((i % 7) - 3)) AS s FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) GROUP BY vec_id)""")
def _(spark, sf):
    n = F.size("embedding")
    weights = F.transform(F.sequence(F.lit(0), n - 1), lambda i: (i % 7 - 3).cast("double"))
    return S.table(spark, sf, "embeddings").select("vec_id", F.round(J.logistic_head(F.col("embedding"), F.lit(0.01), F.lit(0.5), weights), 6).alias("p"))


@query("m04_gate", f"WITH {S.SCORED} SELECT clip_id, minutes < 300 AS pre, score > 80 OR minutes % 50 > 45 AS edge, (score > 80 OR minutes % 50 > 45)::INT + score / 96 AS gate FROM s")
def _(spark, sf):
    return J.gate(S.scored(spark, sf), F.col("minutes") < 300, (F.col("score") > 80) | (F.col("minutes") % 50 > 45), F.col("score") / 96).select("clip_id", "pre", "edge", "gate")


@query("a31_bootstrap_auroc", f"""WITH {S.SCORED}, k AS (SELECT cluster, row_number() OVER (ORDER BY cluster) - 1 AS k, count(*) OVER () AS c FROM (SELECT DISTINCT cluster FROM s)),
  d AS (SELECT r, draw.k, count(*) AS times FROM (SELECT r, ('0x' || substr(md5('7:' || r || ':' || k), 1, 8))::BIGINT % c AS k FROM range(60) x(r), k) draw GROUP BY ALL),
  b AS (SELECT r, name, score, sum(label * times) AS pos, sum((1 - label) * times) AS neg FROM d JOIN k USING (k) JOIN (SELECT cluster, label, 'own' AS name, score FROM s UNION ALL SELECT cluster, label, 'base', (minutes % 13)::DOUBLE FROM s) s USING (cluster) GROUP BY ALL),
  w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY r, name ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM b),
  a AS (SELECT r, name, sum(pos * (2 * below + neg)) / nullif(2 * sum(pos) * sum(neg), 0)::DOUBLE AS auroc FROM w GROUP BY ALL), p AS (SELECT r, max(auroc) FILTER (WHERE name = 'own') AS own, max(auroc) FILTER (WHERE name = 'base') AS base FROM a GROUP BY r)
  SELECT count(*) AS replicates, round(quantile_cont(own, 0.025), 5) AS low, round(quantile_cont(own, 0.975), 5) AS high, round(quantile_cont(own - base, 0.025), 5) AS gain_low, round(quantile_cont(own - base, 0.975), 5) AS gain_high FROM p WHERE own IS NOT NULL AND base IS NOT NULL""")
def _(spark, sf):
    rows = S.scored(spark, sf).withColumn("base", (F.col("minutes") % 13).cast("double")).withColumnRenamed("score", "own")
    return J.bootstrap_auroc(rows, "cluster", "own", "base", 60, 7)


# --- joins between manifests and artifacts ---

SIDES = """e AS (SELECT doc_id AS key, source || '/' || (doc_id - doc_id % 2) AS path, doc_id // 3 AS hash FROM documents), a AS (SELECT doc_id AS artifact, CASE WHEN quality = 1 THEN d.source || '/' || (doc_id - doc_id % 2) END AS path, doc_id // 3 AS hash FROM labels l JOIN documents d USING (doc_id))"""


@query("j16_expected_actual", f"""WITH {SIDES}, ep AS (SELECT path, count(*) AS n, min(key) AS key FROM e GROUP BY ALL), ap AS (SELECT path, count(*) AS n, min(artifact) AS artifact FROM a WHERE path IS NOT NULL GROUP BY ALL),
  bp AS (SELECT ep.key, ap.artifact FROM ep JOIN ap USING (path) WHERE ep.n = 1 AND ap.n = 1), e2 AS (SELECT * FROM e WHERE key NOT IN (SELECT key FROM bp)), a2 AS (SELECT * FROM a WHERE artifact NOT IN (SELECT artifact FROM bp)),
  eh AS (SELECT hash, count(*) AS n FROM e2 GROUP BY ALL), ah AS (SELECT hash, count(*) AS n, min(artifact) AS artifact FROM a2 GROUP BY ALL)
  SELECT key, artifact, 'path' AS status FROM bp UNION ALL SELECT e2.key, CASE WHEN eh.n = 1 AND ah.n = 1 THEN ah.artifact END, CASE WHEN ah.n IS NULL THEN 'missing' WHEN eh.n = 1 AND ah.n = 1 THEN 'hash' ELSE 'ambiguous' END FROM e2 JOIN eh USING (hash) LEFT JOIN ah USING (hash)
  UNION ALL SELECT NULL, a2.artifact, CASE WHEN eh.n IS NULL THEN 'orphan' ELSE 'ambiguous' END FROM a2 JOIN ah USING (hash) LEFT JOIN eh USING (hash) WHERE NOT coalesce(eh.n = 1 AND ah.n = 1, false)""")
def _(spark, sf):
    docs = S.table(spark, sf, "documents").select("doc_id", F.concat_ws("/", "source", (F.col("doc_id") - F.col("doc_id") % 2).cast("string")).alias("path"), F.floor(F.col("doc_id") / 3).alias("hash"))
    found = S.table(spark, sf, "labels").join(docs, "doc_id").select(F.col("doc_id").alias("artifact"), F.when(F.col("quality") == 1, F.col("path")).alias("path"), "hash")
    return J.expected_actual(docs.withColumnRenamed("doc_id", "key"), found)


@query("j15_common_keys", "SELECT d.doc_id, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def _(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id").join(S.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


@query("j17_inventory", """WITH x AS (SELECT doc_id // 2 AS key, count(DISTINCT quality) AS verdicts, count(*) AS n, max(quality) AS quality FROM labels GROUP BY ALL), e AS (SELECT doc_id AS key FROM documents)
  SELECT coalesce(e.key, x.key) AS key, CASE WHEN e.key IS NULL THEN 'unexpected' WHEN x.key IS NULL THEN 'missing' WHEN verdicts > 1 THEN 'competing' WHEN n > 1 THEN 'repeated' ELSE 'resolved' END AS status FROM e FULL JOIN x ON e.key = x.key""")
def _(spark, sf):
    artifacts = S.table(spark, sf, "labels").select(F.floor(F.col("doc_id") / 2).alias("key"), F.col("quality").alias("verdict"))
    return J.inventory(S.table(spark, sf, "documents").select(F.col("doc_id").alias("key")), artifacts)


@query("j18_match_exactly_one", """WITH d AS (SELECT substr(md5(doc_id::VARCHAR), 1, 3) AS stem, count(*) AS n, min(doc_id) AS doc_id FROM documents GROUP BY ALL)
  SELECT page_id, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS status, CASE WHEN n = 1 THEN doc_id END AS doc_id FROM (SELECT page_id, substr(md5(page_id || 'p'), 1, 3) AS stem FROM pages) k LEFT JOIN d USING (stem)""")
def _(spark, sf):
    stem = lambda x: F.substring(F.md5(x.cast("binary")), 1, 3)
    asked = S.table(spark, sf, "pages").select("page_id", stem(F.concat(F.col("page_id").cast("string"), F.lit("p"))).alias("stem"))
    files = S.table(spark, sf, "documents").select(stem(F.col("doc_id").cast("string")).alias("stem"), "doc_id")
    return J.match_exactly_one(asked, files, "stem", "doc_id").select("page_id", "status", "doc_id")


@query("j19_responses", "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN md5(d.text) <> md5(CASE WHEN l.toxic = 1 THEN d.text || 'x' ELSE d.text END) THEN 'hash_mismatch' ELSE 'collected' END AS status FROM documents d LEFT JOIN labels l USING (doc_id)")
def _(spark, sf):
    docs, labels = S.table(spark, sf, "documents").select("doc_id", "text"), S.table(spark, sf, "labels").select("doc_id", "toxic")
    sha = lambda x: F.md5(x.cast("binary"))
    answers = docs.join(labels, "doc_id").select("doc_id", sha(F.when(F.col("toxic") == 1, F.concat("text", F.lit("x"))).otherwise(F.col("text"))).alias("hash"))
    return J.collected(docs.select("doc_id", sha(F.col("text")).alias("hash")), answers, "doc_id", "hash")


@query("j22_disjoint", """SELECT count(*) AS shared, count(*) = 0 AS disjoint FROM (SELECT source FROM documents WHERE lang = 'en' INTERSECT SELECT source FROM documents WHERE lang = 'de')""")
def _(spark, sf):
    docs = S.table(spark, sf, "documents")
    return J.shared_keys(docs.where("lang = 'en'").select("source"), docs.where("lang = 'de'").select("source"))


@query("j23_reference_similarity", """WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings) SELECT a.vec_id, round(max(list_dot_product(a.e, b.e)), 5) AS best FROM v a JOIN v b ON b.label = 0 AND a.label <> 0 GROUP BY ALL""")
def _(spark, sf):
    vectors = S.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    refs = vectors.where("label = 0").select(F.col("vec_id").alias("ref"), F.col("embedding").alias("ref_vector"))
    return A.best_reference(vectors.where("label <> 0").select("vec_id", "embedding"), refs).select("vec_id", F.round("best", 5).alias("best"))


@query("j24_centroid_scores", """WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), d AS (SELECT vec_id, label, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v), s AS (SELECT label, i, sum(x) AS t, count(*) AS n FROM d GROUP BY ALL),
  own AS (SELECT vec_id, sum(x * (t - x)) / nullif(sqrt(sum(x * x)) * sqrt(sum((t - x) * (t - x))), 0) AS own FROM d JOIN s USING (label, i) WHERE n > 1 GROUP BY vec_id),
  other AS (SELECT d.vec_id, s.label AS of, sum(x * t) / nullif(sqrt(sum(x * x)) * sqrt(sum(t * t)), 0) AS c FROM d JOIN s ON d.i = s.i AND d.label <> s.label GROUP BY ALL)
  SELECT v.vec_id, v.label, round(greatest(-1, least(1, own)), 6) AS own, round(greatest(-1, least(1, (SELECT max(c) FROM other o WHERE o.vec_id = v.vec_id))), 6) AS best_other FROM v LEFT JOIN own USING (vec_id)""")
def _(spark, sf):
    return A.centroid_scores(S.table(spark, sf, "embeddings"), "label")


@query("j25_donors", """SELECT doc_id, source, arg_min(donor, md5(doc_id || ':' || donor)) AS donor FROM (SELECT d.doc_id, d.source, (d.doc_id + k * 7) % (SELECT max(doc_id) + 1 FROM documents) AS donor FROM documents d, range(1, 5) r(k)) c JOIN (SELECT doc_id AS donor, source AS donor_source FROM documents) x USING (donor)
  WHERE donor_source <> source GROUP BY ALL""")
def _(spark, sf):
    docs = S.table(spark, sf, "documents").select("doc_id", "source")
    n = docs.agg((F.max("doc_id") + 1).alias("n")).first().n or 1
    offered = docs.withColumn("donor", F.explode(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: (F.col("doc_id") + k * 7) % n)))
    return J.choose_donor(offered, docs.select(F.col("doc_id").alias("donor"), F.col("source").alias("donor_source")))
