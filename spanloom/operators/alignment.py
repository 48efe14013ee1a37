"""Words against turns, walls between speakers, and two labellings of one recording against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators import intervals as I
from spanloom.operators.timeline import along, before_max, following, place, previous, upcoming, upto_sum
from spanloom.sources.tables import DAY_US

_TURN = ["recording_id", "turn_index"]


def straddles(turns: DataFrame, words: DataFrame) -> DataFrame:
    """Of each turn that a word straddles a bound of: where the first word across its start begins (first_word_us), and
    where the last word across its end does end (last_word_us)."""
    edge = lambda c, side: turns.select(*_TURN, F.lit(side).alias("side"), F.col(c).alias("start_us"), (F.col(c) + 1).alias("end_us"))
    edges = edge("start_us", "start").unionAll(edge("end_us", "end"))
    across = I.range_join(edges, I.other(words), ["recording_id"]).where("b_start_us < start_us")
    first = F.min(F.when(F.col("side") == "start", F.col("b_start_us")))
    last = F.max(F.when(F.col("side") == "end", F.col("b_end_us")))
    return across.groupBy(*_TURN).agg(first.alias("first_word_us"), last.alias("last_word_us"))


def safe_walls(turns: DataFrame) -> DataFrame:
    """Adds wall_before_us, the last end of another speaker's turn at or before a turn's start, and wall_after_us, the
    first start of one at or after its end; null where there is none.

    Bounds of the others are dealt to each speaker of the recording, so that a window over (recording, speaker) finds
    both walls: rows grow by the number of speakers, not by pairs of turns.
    """
    speakers = turns.select("recording_id", F.col("speaker_id").alias("of")).distinct()
    rivals = turns.join(speakers, "recording_id").where("speaker_id <> of")

    def wall(at: str, theirs: str, back: bool, name: str) -> DataFrame:
        none, place_ = F.lit(None), F.col("turn_index").isNull() if not back else F.col("turn_index").isNotNull()
        mine = turns.select("recording_id", F.col("speaker_id").alias("of"), F.col(at).alias("at"), "turn_index", none.cast("long").alias("bound"))
        marks = mine.unionAll(rivals.select("recording_id", "of", F.col(theirs), none.cast("int"), F.col(theirs)))
        # bounds at the same time count: they stand before a turn that looks back and behind one that looks ahead
        met = along(marks.withColumn("_side", place_.cast("int")), ["recording_id", "of"], ["at", "_side"], at="at", **{name: before_max("bound") if back else upcoming("bound")})
        return met.where("turn_index IS NOT NULL").select(*_TURN, name)

    before, after = wall("start_us", "end_us", True, "wall_before_us"), wall("end_us", "start_us", False, "wall_after_us")
    return turns.join(before, _TURN).join(after, _TURN)


def lock_words(turns: DataFrame, words: DataFrame, length_us: int = DAY_US) -> DataFrame:
    """Shrinks turns to their safe bounds (neighbouring turns, walls, the recording) and says what becomes of them:
    `conflict` where a word across a bound would have to pass a safe bound, `no_words` without a word left, or `keep`.
    Bounds never grow."""
    walls = along(safe_walls(turns), ["recording_id"], ["start_us", "turn_index"], _before=previous("end_us"), _after=following("start_us"))
    low = F.greatest(F.coalesce("_before", F.lit(0)), F.coalesce("wall_before_us", F.lit(0)))
    high = F.least(F.coalesce("_after", F.lit(length_us)), F.coalesce("wall_after_us", F.lit(length_us)))
    bound = walls.withColumn("_low", low).withColumn("_high", high).join(straddles(turns, words), _TURN, "left")
    blocked = F.coalesce(F.col("_low") > F.col("first_word_us"), F.lit(False)) | F.coalesce(F.col("_high") < F.col("last_word_us"), F.lit(False))
    cut = bound.select(*_TURN, blocked.alias("_blocked"), F.greatest("start_us", "_low").alias("start_us"), F.least("end_us", "_high").alias("end_us"), ((F.col("start_us") < F.col("_low")) | (F.col("end_us") > F.col("_high"))).alias("_shrunk"))
    real = cut.where("start_us < end_us")
    torn = straddles(cut.where("_shrunk"), words).select(*_TURN, F.lit(True).alias("_torn"))
    spoken = I.range_join(real, I.other(words), ["recording_id"]).select(*_TURN).distinct().withColumn("_spoken", F.lit(True))
    conflict = F.col("_blocked") | F.col("_torn").isNotNull()
    action = F.when(conflict, "conflict").when((F.col("start_us") >= F.col("end_us")) | F.col("_spoken").isNull(), "no_words").otherwise("keep")
    return cut.join(torn, _TURN, "left").join(spoken, _TURN, "left").select(*_TURN, "start_us", "end_us", action.alias("action"))


def sole(turns: DataFrame) -> DataFrame:
    """Where exactly one speaker is active: recording_id, speaker_id, start_us, end_us.

    One sweep: with one speaker active, the running sum of the active speakers' numbers is that speaker's number.
    """
    speech = I.islands(turns, ["recording_id", "speaker_id"])
    numbers = speech.select("recording_id", "speaker_id").distinct().withColumn("_k", F.dense_rank().over(Window.partitionBy("recording_id").orderBy("speaker_id")).cast("long"))
    numbered = speech.join(numbers, ["recording_id", "speaker_id"])
    events = numbered.select("recording_id", F.col("start_us").alias("at"), F.lit(1).alias("n"), F.col("_k").alias("k")).unionAll(numbered.select("recording_id", "end_us", F.lit(-1), -F.col("_k")))
    steps = events.groupBy("recording_id", "at").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    steps = steps.withColumnRenamed("at", "start_us")
    slices = along(steps, ["recording_id"], ["start_us"], end_us=following("start_us"), n=upto_sum("n"), _k=upto_sum("k"))
    return slices.where("n = 1").join(numbers, ["recording_id", "_k"]).select("recording_id", "speaker_id", "start_us", "end_us")


def consensus(first: DataFrame, second: DataFrame, mapping: DataFrame) -> DataFrame:
    """Where both labellings have one speaker each, and the mapping (recording_id, speaker_id, mapped_from) makes them
    the same; what abuts is joined."""
    both = I.range_join(sole(first), I.other(sole(second), "speaker_id"), ["recording_id"])
    same = both.join(mapping.select("recording_id", "speaker_id", F.col("mapped_from").alias("b_speaker_id")), ["recording_id", "speaker_id", "b_speaker_id"])
    parts = same.select("recording_id", "speaker_id", F.greatest("start_us", "b_start_us").alias("start_us"), F.least("end_us", "b_end_us").alias("end_us"))
    return I.islands(parts, ["recording_id", "speaker_id"]).drop("n")


def error_rates(reference: DataFrame, hypothesis: DataFrame, mapping: DataFrame) -> DataFrame:
    """By recording of the reference: its speech, missed speech, false alarm and confusion in microseconds, and their
    share of the speech (der). One speaker's overlapping turns count once."""
    ref, hyp = (I.islands(t, ["recording_id", "speaker_id"]) for t in (reference, hypothesis))
    edge = lambda t, c, r, h: t.select("recording_id", F.col(c).alias("at"), F.lit(r).alias("r"), F.lit(h).alias("h"))
    edges = edge(ref, "start_us", 1, 0).unionAll(edge(ref, "end_us", -1, 0)).unionAll(edge(hyp, "start_us", 0, 1)).unionAll(edge(hyp, "end_us", 0, -1))
    steps = edges.groupBy("recording_id", "at").agg(F.sum("r").alias("r"), F.sum("h").alias("h"))
    swept = along(steps, ["recording_id"], ["at"], at="at", _next=following("at"), r=upto_sum("r"), h=upto_sum("h"))
    slices = swept.withColumn("us", F.col("_next") - F.col("at")).where("us IS NOT NULL")
    over = lambda c: F.sum(F.greatest(c, F.lit(0)) * F.col("us"))
    sums = slices.groupBy("recording_id").agg(
        over(F.col("r")).alias("speech_us"), over(F.col("r") - F.col("h")).alias("missed_us"), over(F.col("h") - F.col("r")).alias("false_us"), over(F.least("r", "h")).alias("_both")
    )
    met = I.range_join(ref, I.other(hyp, "speaker_id"), ["recording_id"]).join(mapping.select("recording_id", "speaker_id", F.col("mapped_from").alias("b_speaker_id")), ["recording_id", "speaker_id", "b_speaker_id"])
    right = met.groupBy("recording_id").agg(F.sum(F.least("end_us", "b_end_us") - F.greatest("start_us", "b_start_us")).alias("_right"))
    out = sums.where("speech_us > 0").join(right, "recording_id", "left").withColumn("confusion_us", F.col("_both") - F.coalesce("_right", F.lit(0)))
    rate = (F.col("missed_us") + F.col("false_us") + F.col("confusion_us")) / F.col("speech_us")
    return out.select("recording_id", "speech_us", "missed_us", "false_us", "confusion_us", F.round(rate, 6).alias("der"))


def jaccard_errors(reference: DataFrame, hypothesis: DataFrame, mapping: DataFrame) -> DataFrame:
    """By speaker of the reference: own length, shared and united length with the speaker mapped to them, and the share of
    the united length that isn't shared (1 without a mapped speaker)."""
    ref, hyp = (I.islands(t, ["recording_id", "speaker_id"]) for t in (reference, hypothesis))
    length = lambda t, n: t.groupBy("recording_id", "speaker_id").agg(F.sum(F.col("end_us") - F.col("start_us")).alias(n))
    met = I.range_join(ref, I.other(hyp, "speaker_id"), ["recording_id"]).join(mapping.select("recording_id", "speaker_id", F.col("mapped_from").alias("b_speaker_id")), ["recording_id", "speaker_id", "b_speaker_id"])
    shared = met.groupBy("recording_id", "speaker_id").agg(F.sum(F.least("end_us", "b_end_us") - F.greatest("start_us", "b_start_us")).alias("shared_us"))
    theirs = length(hyp, "_theirs").withColumnRenamed("speaker_id", "mapped_from").join(mapping.select("recording_id", "speaker_id", "mapped_from"), ["recording_id", "mapped_from"]).select("recording_id", "speaker_id", "_theirs")
    key = ["recording_id", "speaker_id"]
    both = length(ref, "speech_us").join(shared, key, "left").join(theirs, key, "left").na.fill(0, ["shared_us", "_theirs"])
    united = F.col("speech_us") + F.col("_theirs") - F.col("shared_us")
    return both.select(*key, "speech_us", "shared_us", united.alias("united_us"), F.round(1 - F.col("shared_us") / united, 6).alias("jaccard_error"))


def speaker_count_error(reference: DataFrame, hypothesis: DataFrame) -> DataFrame:
    """By recording how many speakers either side has, and how far they are apart."""
    count = lambda t, n: t.groupBy("recording_id").agg(F.count_distinct("speaker_id").alias(n))
    both = count(reference, "expected").join(count(hypothesis, "found"), "recording_id", "full").na.fill(0)
    return both.withColumn("error", F.abs(F.col("expected") - F.col("found")))


def paired_bootstrap(rows: DataFrame, cluster: str, first: str, second: str, replicates: int, seed: int, least: int = 50) -> DataFrame:
    """Interval of the difference of two rates (0/1 columns, nulls left out) on the same clusters, drawn with replacement;
    null with fewer than `least` replicates that have both rates."""
    sums = rows.groupBy(cluster).agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate((first, second)) for f, n in ((F.sum, "h"), (F.count, "n"))])
    numbered = sums.withColumn("_k", F.row_number().over(Window.orderBy(cluster)).cast("long") - 1)
    total = numbered.agg(F.count("*").alias("_c"))
    places = rows.sparkSession.range(replicates).withColumnRenamed("id", "replicate").join(F.broadcast(total), F.lit(True)).where("_c > 0")
    places = places.withColumn("_d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c") - 1)))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "replicate", "_d").cast("binary"))
    drawn = places.withColumn("_k", F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.col("_c")).groupBy("replicate", "_k").agg(F.count("*").alias("t"))
    rate = lambda i: F.try_divide(F.sum(F.col(f"h{i}") * F.col("t")).cast("double"), F.sum(F.col(f"n{i}") * F.col("t")).cast("double"))
    gains = drawn.join(numbered, "_k").groupBy("replicate").agg((rate(0) - rate(1)).alias("gain")).where("gain IS NOT NULL")
    out = gains.agg(F.count("*").alias("replicates"), F.percentile("gain", [0.025, 0.5, 0.975]).alias("q"))
    return out.select("replicates", *[F.when(F.col("replicates") >= least, F.round(F.col("q")[i], 6)).alias(c) for i, c in enumerate(("low", "middle", "high"))])


def activity(turns: DataFrame, frame_us: int) -> DataFrame:
    """Frames in which each speaker is active, with the number of turns: starts go down, ends go up to whole frames."""
    return turns.select("recording_id", "speaker_id", I.frames_of(turns, frame_us).alias("frame")).groupBy("recording_id", "speaker_id", "frame").agg(F.count("*").alias("turns"))


def dice(active: DataFrame, least: int = 4) -> DataFrame:
    """Dice overlap of the masks of two speakers of a recording that share a frame, each of at least `least` frames."""
    sizes = active.groupBy("recording_id", "speaker_id").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    left = active.join(sizes, ["recording_id", "speaker_id"]).select("recording_id", "frame", "speaker_id", "n")
    right = left.select("recording_id", "frame", F.col("speaker_id").alias("b_speaker_id"), F.col("n").alias("b_n"))
    pairs = left.join(right, ["recording_id", "frame"]).where("speaker_id < b_speaker_id")
    met = pairs.groupBy("recording_id", "speaker_id", "b_speaker_id", "n", "b_n").agg(F.count("*").alias("shared"))
    return met.select("recording_id", "speaker_id", "b_speaker_id", "shared", F.round(2 * F.col("shared") / (F.col("n") + F.col("b_n")), 6).alias("dice"))


def frame_runs(frames: DataFrame, least: int) -> DataFrame:
    """Maximal runs of the given frames (recording_id, frame) of at least `least` frames."""
    placed = along(frames, ["recording_id"], ["frame"], at="frame", width=1 << 14, _n=place())
    runs = placed.withColumn("_run", F.col("frame") - F.col("_n")).groupBy("recording_id", "_run").agg(F.min("frame").alias("first_frame"), (F.max("frame") + 1).alias("end_frame"))
    return runs.where(F.col("end_frame") - F.col("first_frame") >= least).drop("_run")


def drop_share(occurrences: DataFrame, order: str, share: float) -> DataFrame:
    """Takes away floor(share * n) of all rows: those of the lowest value of the hexadecimal string `order`. Ranks come
    from counts by the first three digits and places within them, so that no task sorts all rows."""
    low = F.substring(order, 1, 3)
    counts = occurrences.groupBy(low.alias("_bin")).agg(F.count("*").alias("_n"))  # 4096 rows at most
    ahead = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_bin", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_bin").orderBy(order))
    return occurrences.withColumn("_bin", low).join(F.broadcast(starts), "_bin").withColumn("_rank", rank).where(F.col("_rank") > F.floor(F.col("_all") * share)).drop("_bin", "_before", "_all", "_rank")


def cluster_bootstrap(rows: DataFrame, cluster: str, hit: str, replicates: int, seed: int) -> DataFrame:
    """Interval (2.5 to 97.5 %) of a rate when whole clusters are drawn with replacement. Clusters are reduced to sums
    first; a draw is the hash of (seed, replicate, place)."""
    sums = rows.groupBy(cluster).agg(F.sum(hit).alias("hits"), F.count(hit).alias("n"))
    numbered = sums.withColumn("_k", F.row_number().over(Window.orderBy(cluster)).cast("long") - 1)
    total = numbered.agg(F.count("*").alias("_c"))
    places = rows.sparkSession.range(replicates).withColumnRenamed("id", "replicate").join(F.broadcast(total), F.lit(True)).where("_c > 0")
    places = places.withColumn("_d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c") - 1)))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "replicate", "_d").cast("binary"))
    drawn = places.withColumn("_k", F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.col("_c")).groupBy("replicate", "_k").agg(F.count("*").alias("times"))
    rates = drawn.join(numbered, "_k").groupBy("replicate").agg((F.sum(F.col("hits") * F.col("times")) / F.sum(F.col("n") * F.col("times"))).alias("rate"))
    q = F.percentile("rate", [0.025, 0.5, 0.975])
    return rates.where("rate IS NOT NULL").agg(F.count("*").alias("replicates"), q.alias("q")).select("replicates", *[F.round(F.col("q")[i], 6).alias(c) for i, c in enumerate(("low", "middle", "high"))])
