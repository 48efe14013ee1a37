"""Verdicts against references, usage and cost, calibration, and joins between manifests and what was made of them."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.analytics import ratio
from spanloom.operators.timeline import along, previous, upcoming
from spanloom.sources.scratch import settled

# --- verdicts ---


def with_status(rows: DataFrame) -> DataFrame:
    """Adds status: missing_candidate, agree, bad_accept or false_reject."""
    agree = F.col("reference") == F.col("candidate")
    return rows.withColumn("status", F.when(F.col("candidate").isNull(), "missing_candidate").when(agree, "agree").when(F.col("candidate") == "pass", "bad_accept").otherwise("false_reject"))


def merge_metrics(merged: DataFrame, least_us: int, most_us: int) -> DataFrame:
    """By recording: merged turns (sources, us), joins made, how many are too short or too long, and the length kept."""
    us = F.col("us")
    return merged.groupBy("recording_id").agg(
        F.count("*").alias("merged"), F.sum(F.col("sources") - 1).alias("joins"), F.count_if(us < least_us).alias("too_short"), F.count_if(us > most_us).alias("too_long"),
        F.coalesce(F.sum(F.when(us.between(least_us, most_us), us)), F.lit(0)).alias("kept_us"),
    )


def rates_or_zero(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Precision and recall of rejects by key, to four decimals, 0 where nothing was to be counted."""
    hit = lambda r, c: F.count_if((F.col("reference") == r) & (F.col("candidate") == c))
    tp, fp, fn = hit("reject", "reject"), hit("pass", "reject"), hit("reject", "pass")
    rate = lambda a, b: F.round(F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0)), 4)
    return rows.groupBy(*keys).agg(rate(tp, tp + fp).alias("precision"), rate(tp, tp + fn).alias("recall"))


def text_status_counts(rows: DataFrame, key: str, reference: str, candidate: str) -> DataFrame:
    """By key how many texts agree; a row without a reference text isn't asked for. exact_rate is among texts on both
    sides, coverage is theirs among all asked for."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    status = F.when(empty(reference), "not_applicable").when(empty(candidate), "missing_candidate").when(F.col(reference) == F.col(candidate), "exact_match").otherwise("different")
    names = ("not_applicable", "missing_candidate", "exact_match", "different")
    counts = rows.withColumn("_status", status).groupBy(key).agg(*[F.count_if(F.col("_status") == n).alias(n) for n in names])
    both = F.col("exact_match") + F.col("different")
    return counts.withColumns({"exact_rate": ratio(F.col("exact_match"), both), "coverage": ratio(both, both + F.col("missing_candidate"))})


def error_rates_by_category(verdicts: DataFrame, categories: Sequence[str], among_rejects: Collection[str]) -> DataFrame:
    """For each family and known category how often its code was given (0 if never), and its share: of the rejects for the
    categories in among_rejects, else of all that were judged."""
    judged = verdicts.groupBy("family").agg(F.count("candidate").alias("_judged"), F.count_if(F.col("candidate") == "reject").alias("_rejected"))
    known = judged.withColumn("category", F.explode(F.array(*map(F.lit, categories))))
    given = verdicts.select("family", F.explode("codes").alias("category")).groupBy("family", "category").agg(F.count("*").alias("n"))
    out = known.join(given, ["family", "category"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    among = F.when(F.col("category").isin(list(among_rejects)), F.col("_rejected")).otherwise(F.col("_judged"))
    return out.select("family", "category", "n", among.alias("among"), ratio(F.col("n"), among).alias("rate"))


def group_ids(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct settings in `columns` with their count and a short id, the hash of their JSON."""
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).select(F.substring(F.sha2(F.to_json(F.struct(*columns)), 256), 1, 10).alias("id"), *columns, "n")


def dominant_speaker(turns: DataFrame, pass_share: float, reject_share: float) -> DataFrame:
    """By recording the speaker who talks most, the others' length, and pass, reject or uncertain by the others' share."""
    each = turns.groupBy("recording_id", "speaker_id").agg(F.sum(F.col("end_us") - F.col("start_us")).alias("us"))
    out = each.groupBy("recording_id").agg(F.max_by("speaker_id", F.struct("us", "speaker_id")).alias("speaker_id"), F.max("us").alias("dominant_us"), F.sum("us").alias("_all"))
    second = F.col("_all") - F.col("dominant_us")
    decision = F.when(second <= F.col("_all") * pass_share, "pass").when(second > F.col("_all") * reject_share, "reject").otherwise("uncertain")
    return out.select("recording_id", "speaker_id", "dominant_us", second.alias("secondary_us"), decision.alias("decision"))


def control_checks(verdicts: DataFrame, silent: Column, valid: float = 0.95, clean: float = 0.8, defect: float = 0.7) -> DataFrame:
    """One row: share of valid answers, of clean controls that pass, of defects that are rejected, silent clips that pass,
    and whether all of it is accepted."""
    hit = lambda r, c: F.count_if((F.col("reference") == r) & (F.col("candidate") == c))
    asked = lambda r: F.count(F.when(F.col("reference") == r, F.col("candidate")))
    n, known, quiet = F.count("*"), F.count("candidate"), F.count_if(silent & (F.col("candidate") == "pass"))
    accepted = (known >= valid * n) & (hit("pass", "pass") >= clean * asked("pass")) & (hit("reject", "reject") >= defect * asked("reject")) & (quiet == 0)
    return verdicts.agg(
        ratio(known, n).alias("valid_rate"), ratio(hit("pass", "pass"), asked("pass")).alias("clean_pass"), ratio(hit("reject", "reject"), asked("reject")).alias("defect_reject"),
        quiet.alias("silence_passes"), accepted.alias("accepted"),
    )


def crosstab(rows: DataFrame, key: str, column: str, values: Sequence[str]) -> DataFrame:
    return rows.groupBy(key).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def compare_tracks(p: DataFrame, q: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """By key the largest and mean difference of two tracks (keys, frame, p / q), and the frames on which they fall on
    different sides of the threshold."""
    gap = F.abs(F.col("p") - F.col("q"))
    return p.join(q, [*keys, "frame"]).groupBy(*keys).agg(
        F.max(gap).alias("worst"), F.round(F.sum(gap) / F.count("*"), 6).alias("mean"), F.count_if((F.col("p") >= threshold) != (F.col("q") >= threshold)).alias("disagreements")
    )


def crawl_summary(rows: DataFrame, identity: Column, rejected: Column, most: int) -> DataFrame:
    """By source what was seen, rejected, a duplicate of an earlier row (doc_id), accepted, and whether that is more than
    `most`. Firsts come from a minimum by identity, not from a window over its copies."""
    firsts = rows.groupBy(identity.alias("_identity")).agg(F.min("doc_id").alias("_first"))
    marked = rows.withColumn("_identity", identity).withColumn("_rejected", rejected).join(firsts, "_identity")
    first = F.col("doc_id") == F.col("_first")
    out = marked.groupBy("source").agg(
        F.count("*").alias("seen"), F.count_if("_rejected").alias("rejected"), F.count_if(~F.col("_rejected") & ~first).alias("duplicates"), F.count_if(~F.col("_rejected") & first).alias("accepted")
    )
    return out.withColumn("truncated", F.col("accepted") > most)


# --- usage ---


def by_modality(usage: DataFrame, seconds: Column, per_second: int = 32) -> DataFrame:
    """Fills in audio tokens where none are given, from the length of the audio; text is what is left of the prompt."""
    none = F.col("audio_tokens") == 0
    guess = F.least("prompt_tokens", seconds * per_second)
    text = F.when(none, F.greatest("text_tokens", F.col("prompt_tokens") - guess)).otherwise(F.col("text_tokens"))
    return usage.withColumns({
        "audio_tokens": F.when(none, guess).otherwise(F.col("audio_tokens")), "estimated": none, "text_tokens": text, "cached_tokens": F.least("prompt_tokens", "cached_tokens"),
    })


def price(usage: DataFrame, card: DataFrame) -> DataFrame:
    """Adds cost, in half units of the card times tokens (whole numbers, so sums are exact): null for a model that the card
    (model, mode, rates, long_from) hasn't. The card is a row for each model and mode.

    Tokens of a prompt are audio, text or other; cached ones are first those known to be audio, then other, then text,
    then audio again. A prompt of more than long_from tokens costs twice as much, its output half as much again.
    """
    audio = F.least("audio_tokens", "prompt_tokens")
    text = F.least("text_tokens", F.col("prompt_tokens") - audio)
    other = F.col("prompt_tokens") - audio - text
    cached = F.least("cached_tokens", "prompt_tokens")
    cached_audio = F.least("cached_audio_tokens", audio, cached)
    cached_other = F.least(other, cached - cached_audio)
    cached_text = F.least(text, cached - cached_audio - cached_other)
    all_cached_audio = cached_audio + F.least(audio - cached_audio, cached - cached_audio - cached_other - cached_text)
    mode = F.when(F.col("tier") == "standard", "standard").otherwise("batch")
    rated = usage.withColumn("mode", mode).join(card, ["model", "mode"], "left")
    long = F.coalesce(F.col("prompt_tokens") > F.col("long_from"), F.lit(False))
    fresh = (audio - all_cached_audio) * F.col("audio_input") + (text - cached_text + other - cached_other) * F.col("input")
    held = all_cached_audio * F.col("cached_audio") + (cached_text + cached_other) * F.col("cached")
    out = (F.col("output_tokens") + F.col("thinking_tokens")) * F.col("output")
    cost = (fresh + held) * F.when(long, 4).otherwise(2) + out * F.when(long, 3).otherwise(2)
    return rated.withColumn("cost", cost).select(*usage.columns, "cost")


# --- scores ---


def detection_rates(rows: DataFrame, severity: str, false_rejects: Sequence[float]) -> DataFrame:
    """For thresholds that reject a given share of the clean rows (label 0) how many bad ones of each severity they find."""
    cut = rows.where("label = 0").agg(F.percentile("score", [1 - q for q in false_rejects]).alias("_t"))
    shares = F.array(*map(F.lit, false_rejects))
    cuts = cut.select(F.explode(F.arrays_zip(shares.alias("q"), F.col("_t").alias("t"))).alias("_x")).select(F.col("_x.q").alias("false_rejects"), F.col("_x.t").alias("_thr"))
    met = rows.where("label = 1").join(F.broadcast(cuts), F.lit(True))  # one row for each share
    found = F.count_if(F.col("score") >= F.col("_thr"))
    return met.groupBy("false_rejects", severity).agg(F.count("*").alias("n"), found.alias("found"), ratio(found, F.count("*")).alias("rate"))


def lexicographic_curve(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Yield curve with one point a clip, in lexicographic order, and a point at the origin."""
    by = Window.partitionBy(*keys).orderBy(*order)
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    m, bad = F.col("minutes"), F.col("minutes") * F.col("label")
    points = rows.select(*keys, F.row_number().over(by).alias("place"), F.sum(m).over(upto).alias("accepted"), F.sum(bad).over(upto).alias("bad"), F.sum(m).over(Window.partitionBy(*keys)).alias("_all"))
    zero = rows.select(*keys).distinct().select(*keys, F.lit(0).alias("place"), F.lit(0).cast("long").alias("accepted"), F.lit(0).cast("long").alias("bad"), F.lit(1).cast("long").alias("_all"))
    return points.unionByName(zero).select(*keys, "place", "accepted", "bad", ratio(F.col("accepted"), F.col("_all")).alias("yield"), ratio(F.col("bad"), F.col("accepted")).alias("r"))


def folded_calibration(clean: DataFrame, group: str, folds: int, share: float) -> DataFrame:
    """Threshold of each fold from the clean rows of the other folds, and the fold's own share under it. Groups fall into
    folds whole, by hash."""
    fold = F.conv(F.substring(F.md5(F.col(group).cast("binary")), 1, 6), 16, 10).cast("long") % folds
    dealt = clean.withColumn("fold", fold)
    others = dealt.withColumn("_of", F.explode(F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda k: k != F.col("fold"))))
    cut = others.groupBy(F.col("_of").cast("long").alias("fold")).agg(F.percentile("score", share).alias("_t"))
    kept = F.count_if(F.col("score") <= F.col("_t"))
    return dealt.join(cut, "fold").groupBy("fold").agg(F.round(F.first("_t"), 6).alias("threshold"), F.count("*").alias("n"), ratio(kept, F.count("*")).alias("specificity"))


def share_below(rows: DataFrame, reference: DataFrame, score: str) -> DataFrame:
    """Adds share: how much of the reference has at most a row's score. Counts by score are added up once; no row meets
    the reference's rows."""
    counts = reference.groupBy(score).agg(F.count("*").alias("_r")).unionByName(rows.select(score, F.lit(0).cast("long").alias("_r"))).groupBy(score).agg(F.sum("_r").alias("_r"))
    upto = Window.orderBy(score).rowsBetween(Window.unboundedPreceding, 0)  # a row for each score
    shares = counts.select(score, ratio(F.sum("_r").over(upto), F.sum("_r").over(Window.partitionBy())).alias("share"))
    return rows.join(shares, score)


def logistic_head(features: Column, mean: Column, spread: Column, weights: Column, clip: float = 50.0) -> Column:
    """Probability of a linear head over standardised features."""
    dot = F.aggregate(F.zip_with(features, weights, lambda x, w: (x.cast("double") - mean) / spread * w), F.lit(0.0), lambda s, x: s + x)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-clip), F.least(F.lit(clip), dot))))


def gate(rows: DataFrame, pre: Column, edge: Column, content: Column) -> DataFrame:
    """Adds pre, edge and gate: a flagged edge puts a clip behind all others, content orders the rest."""
    return rows.withColumns({"pre": pre, "edge": edge, "gate": edge.cast("int") + content})


def bootstrap_auroc(rows: DataFrame, cluster: str, own: str, base: str, replicates: int, seed: int) -> DataFrame:
    """Interval of the AUROC of `own`, and of its gain over `base`, when clusters are drawn with replacement. Replicates
    meet counts by (cluster, score), not clips."""
    numbered = rows.select(cluster).distinct().withColumn("_k", F.row_number().over(Window.orderBy(cluster)).cast("long") - 1)
    total = numbered.agg(F.count("*").alias("_c"))
    places = rows.sparkSession.range(replicates).withColumnRenamed("id", "_rep").join(F.broadcast(total), F.lit(True)).where("_c > 0")
    places = places.withColumn("_d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c") - 1)))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "_rep", "_d").cast("binary"))
    drawn = places.withColumn("_k", F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.col("_c")).groupBy("_rep", "_k").agg(F.count("*").alias("_times"))
    long = rows.select(cluster, "label", own, base).unpivot([cluster, "label"], [own, base], "_name", "_score")
    counts = long.groupBy(cluster, "_name", "_score").agg(F.sum("label").alias("_p"), F.sum(1 - F.col("label")).alias("_n"))
    met = drawn.join(numbered, "_k").join(counts, cluster).groupBy("_rep", "_name", "_score").agg(F.sum(F.col("_p") * F.col("_times")).alias("p"), F.sum(F.col("_n") * F.col("_times")).alias("n"))
    below = F.coalesce(F.sum("n").over(Window.partitionBy("_rep", "_name").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wins = met.withColumn("_w", F.col("p") * (2 * below + F.col("n"))).groupBy("_rep", "_name").agg(F.try_divide(F.sum("_w").cast("double"), (2 * F.sum("p") * F.sum("n")).cast("double")).alias("a"))
    pair = wins.groupBy("_rep").agg(F.max(F.when(F.col("_name") == own, F.col("a"))).alias("own"), F.max(F.when(F.col("_name") == base, F.col("a"))).alias("base")).where("own IS NOT NULL AND base IS NOT NULL")
    q = lambda c: F.percentile(c, [0.025, 0.975])
    out = pair.agg(F.count("*").alias("replicates"), q(F.col("own")).alias("o"), q(F.col("own") - F.col("base")).alias("g"))
    names = (("low", "o", 0), ("high", "o", 1), ("gain_low", "g", 0), ("gain_high", "g", 1))
    return out.select("replicates", *[F.round(F.col(c)[i], 5).alias(n) for n, c, i in names])


# --- joins ---


def expected_actual(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(key, artifact, status) of expected (key, path, hash) and actual (artifact, path, hash) rows: `path` where a path
    names exactly one of each; of the others `hash` where a hash does; else `ambiguous`, `missing` (expected only) or
    `orphan` (actual only)."""
    e = expected.groupBy("path").agg(F.count("*").alias("_n"), F.min("key").alias("key")).where("_n = 1 AND path IS NOT NULL").drop("_n")
    a = actual.groupBy("path").agg(F.count("*").alias("_n"), F.min("artifact").alias("artifact")).where("_n = 1 AND path IS NOT NULL").drop("_n")
    by_path = e.join(a, "path").select("key", "artifact")
    e2, a2 = expected.join(by_path.select("key"), "key", "left_anti"), actual.join(by_path.select("artifact"), "artifact", "left_anti")
    counts = e2.groupBy("hash").agg(F.count("*").alias("_e")).join(a2.groupBy("hash").agg(F.count("*").alias("_a"), F.min("artifact").alias("_one")), "hash", "full")
    one = (F.col("_e") == 1) & (F.col("_a") == 1)
    status = F.when(F.col("_a").isNull(), "missing").when(one, "hash").otherwise("ambiguous")
    left = e2.join(counts, "hash").select("key", F.when(one, F.col("_one")).alias("artifact"), status.alias("status"))
    rest = a2.join(counts, "hash").where(~F.coalesce(one, F.lit(False)))
    right = rest.select(F.lit(None).cast(expected.schema["key"].dataType).alias("key"), "artifact", F.when(F.col("_e").isNull(), "orphan").otherwise("ambiguous").alias("status"))
    return by_path.withColumn("status", F.lit("path")).unionByName(left).unionByName(right)


def inventory(expected: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(key, status) over the keys of both sides: unexpected, missing, competing (different verdicts), repeated, resolved."""
    found = artifacts.groupBy("key").agg((F.min("verdict") != F.max("verdict")).alias("_compete"), F.count("*").alias("_n"))
    both = expected.withColumn("_e", F.lit(1)).join(found, "key", "full")
    status = F.when(F.col("_e").isNull(), "unexpected").when(F.col("_n").isNull(), "missing").when(F.col("_compete"), "competing").when(F.col("_n") > 1, "repeated").otherwise("resolved")
    return both.select("key", status.alias("status"))


def match_exactly_one(rows: DataFrame, files: DataFrame, stem: str, name: str) -> DataFrame:
    """Adds status and the file of each row whose stem exactly one file has."""
    found = files.groupBy(stem).agg(F.count("*").alias("_n"), F.min(name).alias("_file"))
    status = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "ambiguous").otherwise("matched")
    return rows.join(found, stem, "left").withColumn("status", status).withColumn(name, F.when(F.col("_n") == 1, F.col("_file"))).drop("_n", "_file")


def collected(asked: DataFrame, answers: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, status) of each question: missing, hash_mismatch or collected."""
    both = asked.join(answers.select(key, F.col(digest).alias("_given")), key, "left")
    return both.select(key, F.when(F.col("_given").isNull(), "missing").when(F.col("_given") != F.col(digest), "hash_mismatch").otherwise("collected").alias("status"))


def shared_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    """How many keys both sides have, and whether there is none."""
    n = F.count("*")
    return a.intersect(b).agg(n.alias("shared"), (n == 0).alias("disjoint"))


def choose_donor(offered: DataFrame, donors: DataFrame) -> DataFrame:
    """One of the donors offered to each row (doc_id, source) that has another source, by hash of both."""
    fit = offered.join(donors, "donor").where("donor_source <> source")
    order = F.md5(F.concat_ws(":", "doc_id", "donor").cast("binary"))
    return fit.groupBy("doc_id", "source").agg(F.min_by("donor", order).alias("donor"))


def ring_donors(clips: DataFrame, clip: str, speaker: str, seed: int) -> DataFrame:
    """(clip, donor): clips stand on a ring in order of a seeded hash, and a clip's donor is the next one of another speaker; null if
    there is no other. No pairs are tried: the next clip that begins a run of a speaker is it."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(clip).cast("string")).cast("binary"))
    ring = clips.select(F.lit(0).alias("_all"), F.conv(F.substring(digest, 1, 12), 16, 10).cast("long").alias("_at"), F.col(clip).alias("_clip"), F.col(speaker).alias("_speaker"))
    order, wide = ["_at", "_clip"], {"at": "_at", "width": 1 << 36}
    near = settled(along(ring, ["_all"], order, **wide, _before=previous(F.struct("_speaker"))))
    begins = F.col("_before").isNull() | ~F.col("_before._speaker").eqNullSafe(F.col("_speaker"))
    first = near.where(begins).orderBy(*order).select("_clip", "_speaker").limit(2).collect()
    found = along(near, ["_all"], order, **wide, cheap=True, _next=upcoming(F.when(begins, F.col("_clip"))))
    lit = lambda r: F.lit(r._clip if r else None).cast(clips.schema[clip].dataType)
    one, two = (first + [None, None])[:2]
    wrapped = F.when(~F.col("_speaker").eqNullSafe(F.lit(one._speaker)), lit(one)).otherwise(lit(two)) if one else lit(None)
    return found.select(F.col("_clip").alias(clip), F.coalesce("_next", wrapped).alias("donor"))


def defect_grid(clips: DataFrame, donors: DataFrame, clip: str, samples: str, cuts: Sequence[int], ratios_db: Sequence[float]) -> DataFrame:
    """(clip, kind, severity, samples): each clip with each defect: its start or end cut by so many samples, or its donor's samples mixed
    in at a ratio of their RMS. Donors come from donors (clip, donor); a clip without one, or silence, isn't mixed."""
    x, n = F.col(samples), F.size(samples)
    whole = clips.select(clip, F.transform(samples, lambda v: v.cast("double")).alias(samples))
    severity = lambda values: F.explode(F.array(*[F.lit(float(v)) for v in values]))
    cut = whole.withColumn("severity", severity(cuts))
    k = F.least(F.col("severity").cast("int"), n)
    start, end = cut.select(clip, F.lit("clipped_word_start").alias("kind"), "severity", F.slice(x, k + 1, n - k).alias(samples)), cut.select(clip, F.lit("clipped_word_end").alias("kind"), "severity", F.slice(x, F.lit(1), n - k).alias(samples))
    power = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v * v) / F.size(c))
    met = whole.join(donors, clip).join(whole.select(F.col(clip).alias("donor"), F.col(samples).alias("_d")), "donor").where((power(x) > 1e-9) & (power(F.col("_d")) > 1e-9))
    met = met.withColumn("severity", severity(ratios_db)).withColumn("_gain", power(x) / (power(F.col("_d")) * F.pow(F.lit(10.0), F.col("severity") / 20)))
    mixed = F.zip_with(x, "_d", lambda a, b: a + F.coalesce(b, F.lit(0.0)) * F.col("_gain"))
    return start.unionByName(end).unionByName(met.select(clip, F.lit("secondary_speaker").alias("kind"), "severity", F.slice(mixed, F.lit(1), n).alias(samples)))


def audit_states(now: DataFrame, kept: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, state): whether an audit of each item is missing, of another state of it (stale), or current."""
    both = now.join(kept.select(key, F.col(digest).alias("_kept")), key, "left")
    return both.select(key, F.when(F.col("_kept").isNull(), "missing").when(F.col("_kept") != F.col(digest), "stale").otherwise("current").alias("state"))
