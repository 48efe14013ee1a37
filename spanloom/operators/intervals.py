"""Interval algebra: half-open intervals [start_us, end_us) in recordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.timeline import along, before_max, following, island, latest, place, previous, run_number, upcoming, upto_sum
from spanloom.sources.scratch import settled
from spanloom.sources.tables import DAY_US

#: Width of the time buckets that range joins meet in, in microseconds.
BUCKET_US = 120_000_000


def normalize(turns: DataFrame, length_us: int = DAY_US) -> DataFrame:
    """Clamps turns to the recording, drops what is empty then, and numbers them by (start, end, speaker)."""
    clamped = turns.withColumn("start_us", F.greatest("start_us", F.lit(0))).withColumn("end_us", F.least("end_us", F.lit(length_us)))
    placed = along(clamped.where("end_us > start_us"), ["recording_id"], ["start_us", "end_us", "speaker_id", "event_id"], cheap=True, turn_index=place())
    return placed.withColumn("turn_index", F.col("turn_index").cast("int"))


def duration_filter(turns: DataFrame, least_s: float, most_s: float) -> DataFrame:
    """Both limits belong to the range; seconds become whole microseconds by ceiling and floor of decimals."""
    low, high = (F.lit(str(x)).cast("decimal(38,9)") * 1_000_000 for x in (least_s, most_s))
    length = F.col("end_us") - F.col("start_us")
    return turns.where((length >= F.ceil(low)) & (length <= F.floor(high)))


def range_join(a: DataFrame, b: DataFrame, on: list[str], bucket_us: int = BUCKET_US) -> DataFrame:
    """Pairs of rows of a (start_us, end_us) and b (b_start_us, b_end_us) that overlap, equal in `on`.

    Both sides are dealt to time buckets and meet in one bucket only: the later of their first ones. So a long
    recording spreads over its buckets, and no pair comes twice.
    """
    span = lambda s, e: F.sequence(F.floor(F.col(s) / bucket_us), F.floor((F.col(e) - 1) / bucket_us))
    left = a.withColumn("_bucket", F.explode(span("start_us", "end_us")))
    right = b.withColumn("_bucket", F.explode(span("b_start_us", "b_end_us")))
    meet = F.greatest(F.floor(F.col("start_us") / bucket_us), F.floor(F.col("b_start_us") / bucket_us))
    return left.join(right, [*on, "_bucket"]).where((F.col("_bucket") == meet) & (F.col("start_us") < F.col("b_end_us")) & (F.col("b_start_us") < F.col("end_us"))).drop("_bucket")


def other(turns: DataFrame, *columns: str) -> DataFrame:
    return turns.select("recording_id", *[F.col(c).alias(f"b_{c}") for c in ("start_us", "end_us", *columns)])


def overlaps(turns: DataFrame) -> DataFrame:
    """Every turn with overlap and the indices that it overlaps with."""
    pairs = range_join(turns, other(turns, "turn_index"), ["recording_id"]).where("turn_index <> b_turn_index")
    found = pairs.groupBy("recording_id", "turn_index").agg(F.array_sort(F.collect_list("b_turn_index")).alias("overlap_with"))
    joined = turns.join(found, ["recording_id", "turn_index"], "left")
    return joined.withColumn("overlap", F.col("overlap_with").isNotNull()).withColumn("overlap_with", F.coalesce("overlap_with", F.array().cast("array<int>")))


def islands(intervals: DataFrame, keys: list[str], gap_us: int = 0, cheap: bool = False) -> DataFrame:
    """Unions of intervals that touch or lie within gap_us of each other: keys, start_us, end_us, n."""
    placed = along(intervals.select(*keys, "start_us", "end_us"), keys, ["start_us", "end_us"], cheap=cheap, _island=island(gap_us))
    return placed.groupBy(*keys, "_island").agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.count("*").alias("n")).drop("_island")


def union_length(intervals: DataFrame, keys: list[str], cheap: bool = False) -> DataFrame:
    return islands(intervals, keys, cheap=cheap).groupBy(*keys).agg(F.sum(F.col("end_us") - F.col("start_us")).alias("union_us"))


def sweep(turns: DataFrame) -> DataFrame:
    """Elementary intervals between neighbouring bounds of a recording, with the number of turns active."""
    events = turns.select("recording_id", F.col("start_us").alias("at"), F.lit(1).alias("step")).unionAll(turns.select("recording_id", "end_us", F.lit(-1)))
    steps = events.groupBy("recording_id", "at").agg(F.sum("step").alias("step"))
    swept = along(steps.withColumnRenamed("at", "start_us"), ["recording_id"], ["start_us"], end_us=following("start_us"), active=upto_sum("step"))
    return swept.where("end_us IS NOT NULL").select("recording_id", "start_us", "end_us", "active")


def neighbour_gaps(turns: DataFrame) -> DataFrame:
    """Gap from each turn to the nearest competitor (another speaker's turn) before and after; 0 if one is inside. Rows grow
    by the number of a recording's speakers."""
    speakers = turns.select("recording_id", "speaker_id").distinct().select("recording_id", F.col("speaker_id").alias("of"))
    marks = turns.join(speakers, "recording_id")
    mine = F.col("speaker_id") == F.col("of")
    near = along(marks, ["recording_id", "of"], ["start_us", "turn_index"], _b=before_max(F.when(~mine, F.col("end_us"))), _a=upcoming(F.when(~mine, F.col("start_us")))).where(mine)
    zero = lambda c: F.when(c.isNotNull(), F.greatest(c, F.lit(0)))
    return near.withColumn("gap_before_us", zero(F.col("start_us") - F.col("_b"))).withColumn("gap_after_us", zero(F.col("_a") - F.col("end_us"))).drop("of", "_a", "_b")


_ORDER = ["start_us", "turn_index"]


def merge_decisions(turns: DataFrame, gap_us: int, loud: DataFrame | None = None, frame_us: int = 1_000_000) -> DataFrame:
    """Adds decision to every turn, on joining it to the one before (in order of start): first_turn, other_speaker,
    overlapping_turns, gap_too_long, competing_speaker (another speaker touches their hull), gap_not_silent (a frame of
    `loud`, recording_id and frame, lies in the gap) or merged; the first that holds."""
    turns = settled(turns)
    near = settled(along(turns, ["recording_id"], _ORDER, cheap=True, _p=previous(F.struct("speaker_id", "start_us", "end_us"))))
    p, key = F.col("_p"), ["recording_id", "turn_index"]
    same = p["speaker_id"] == F.col("speaker_id")
    gap = F.col("start_us") - p["end_us"]
    rough = near.where(same & gap.between(0, gap_us))
    hulls = rough.select(*key, p["start_us"].alias("start_us"), "end_us", "speaker_id")
    rivals = range_join(hulls, other(turns, "speaker_id"), ["recording_id"]).where("speaker_id <> b_speaker_id").select(*key).distinct()
    marked = near.join(rivals.withColumn("_rival", F.lit(True)), key, "left")
    noisy = F.lit(False)
    if loud is not None:
        gaps = rough.where(gap > 0).select(*key, p["end_us"].alias("start_us"), F.col("start_us").alias("end_us"))
        sounds = loud.select("recording_id", (F.col("frame") * frame_us).alias("b_start_us"), ((F.col("frame") + 1) * frame_us).alias("b_end_us"))
        heard = range_join(gaps, sounds, ["recording_id"]).select(*key).distinct()
        marked, noisy = marked.join(heard.withColumn("_loud", F.lit(True)), key, "left"), F.col("_loud").isNotNull()
    decision = (
        F.when(p.isNull(), "first_turn").when(~same, "other_speaker").when(gap < 0, "overlapping_turns").when(gap > gap_us, "gap_too_long")
        .when(F.col("_rival").isNotNull(), "competing_speaker").when(noisy, "gap_not_silent").otherwise("merged")
    )
    return marked.withColumn("decision", decision).select(*turns.columns, "decision")


def merge_turns(turns: DataFrame, gap_us: int, loud: DataFrame | None = None) -> DataFrame:
    """Same-speaker merging without a duration cap, by merge_decisions(): recording_id, speaker_id, start_us, end_us,
    sources (turns) and confidence (the least; null if one has none)."""
    decided = merge_decisions(turns, gap_us, loud)
    chained = along(decided, ["recording_id"], _ORDER, _chain=upto_sum(F.when(F.col("decision") == "merged", 0).otherwise(1)))
    least = F.when(F.count("confidence") == F.count("*"), F.min("confidence"))
    grouped = chained.groupBy("recording_id", "_chain")
    return grouped.agg(F.first("speaker_id").alias("speaker_id"), F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.count("*").alias("sources"), least.alias("confidence")).drop("_chain")


def speaker_runs(turns: DataFrame, gap_us: int, rejected: DataFrame | None = None) -> DataFrame:
    """Runs of one speaker's turns: a new one begins with another speaker, an overlap, a gap over gap_us, or a gap that
    another speaker's turn or a rejected span (recording_id, start_us, end_us) touches."""
    turns = settled(turns)
    near = settled(along(turns, ["recording_id"], _ORDER, cheap=True, _p=previous(F.struct("speaker_id", "end_us"))))
    gap = F.col("start_us") - F.col("_p.end_us")
    rough = (F.col("_p.speaker_id") == F.col("speaker_id")) & gap.between(0, gap_us)
    gaps = near.where(rough & (gap > 0)).select("recording_id", "turn_index", F.col("_p.end_us").alias("start_us"), F.col("start_us").alias("end_us"), "speaker_id")
    key = ["recording_id", "turn_index"]
    broken = range_join(gaps, other(turns, "speaker_id"), ["recording_id"]).where("speaker_id <> b_speaker_id").select(*key)
    if rejected is not None:
        broken = broken.union(range_join(gaps, other(rejected), ["recording_id"]).select(*key))
    marked = near.join(broken.distinct().withColumn("_broken", F.lit(True)), key, "left")
    fresh = F.when(rough & F.col("_broken").isNull(), 0).otherwise(1)
    runs = along(marked.withColumn("_new", fresh).drop("_p"), ["recording_id"], _ORDER, _run=upto_sum("_new")).groupBy("recording_id", "speaker_id", "_run")
    return runs.agg(F.min("turn_index").alias("run"), F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.count("*").alias("turns")).drop("_run")


def cleanup(turns: DataFrame, jitter_us: int, collar_us: int, merge_gap_us: int, least_us: int) -> DataFrame:
    """Relabels short A-B-A jitters, trims close bounds between different speakers, merges same-speaker neighbours, drops
    what stays short: recording_id, speaker_id, start_us, end_us, n.

    A jitter is a turn of up to jitter_us that overlaps with no other and lies between two turns of one other speaker, in
    order and each within merge_gap_us. As relabelling one settles its neighbour, those at odd places of a run of
    candidates change. Where the next turn is another speaker's and overlaps, both are cut at the middle less a collar;
    where it is closer than two collars, each loses a collar. Turns that this leaves empty go.
    """
    order = ["start_us", "turn_index"]
    near = F.struct("speaker_id", "start_us", "end_us")
    met = along(turns, ["recording_id"], order, _p=previous(near), _f=following(near), _reach=before_max("end_us"))
    p, f = F.col("_p"), F.col("_f")
    overlap = F.coalesce(F.col("_reach") > F.col("start_us"), F.lit(False)) | F.coalesce(f["start_us"] < F.col("end_us"), F.lit(False))
    candidate = (
        (p["speaker_id"] == f["speaker_id"]) & (p["speaker_id"] != F.col("speaker_id")) & (F.col("end_us") - F.col("start_us") <= jitter_us) & ~overlap
        & (F.col("start_us") - p["end_us"]).between(0, merge_gap_us) & (f["start_us"] - F.col("end_us")).between(0, merge_gap_us)
    )
    marked = met.withColumn("_c", F.coalesce(candidate.cast("int"), F.lit(0))).withColumn("_around", p["speaker_id"])
    placed = along(marked.drop("_p", "_f", "_reach"), ["recording_id"], order, _last=latest(F.when(F.col("_c") == 0, F.col("turn_index"))))
    odd = (F.col("turn_index") - F.coalesce("_last", F.lit(-1))) % 2 == 1
    fixed = placed.withColumn("speaker_id", F.when((F.col("_c") == 1) & odd, F.col("_around")).otherwise(F.col("speaker_id")))
    fixed = along(fixed, ["recording_id"], order, _p=previous(near), _f=following(near))

    def cut(of: Column, end: Column, start: Column, middle: Column, sign: int) -> Column:
        """What a bound moves to, given the end of the earlier and the start of the later turn."""
        other = of.isNotNull() & (of != F.col("speaker_id"))
        own = end if sign < 0 else start
        return F.when(other & (end > start), middle + sign * collar_us).when(other & (start - end < 2 * collar_us), own + sign * collar_us).otherwise(own)

    # a turn's end is cut after its start was, and an overlap is judged on the ends that stand then; starts don't move ends
    middle = lambda end, start: F.floor((end + start) / 2)
    start = cut(p["speaker_id"], p["end_us"], F.col("start_us"), middle(p["end_us"], F.col("start_us")), 1)
    end = cut(f["speaker_id"], F.col("end_us"), f["start_us"], middle(F.col("end_us"), f["start_us"]), -1)
    trimmed = fixed.withColumns({"_from": F.greatest(F.coalesce(start, F.col("start_us")), F.lit(0)), "_to": F.coalesce(end, F.col("end_us"))}).where("_to > _from")
    trimmed = trimmed.select("recording_id", "turn_index", "speaker_id", F.col("_from").alias("start_us"), F.col("_to").alias("end_us"))
    wide = {"at": "turn_index", "width": 1 << 14}
    runs = along(trimmed, ["recording_id"], ["turn_index"], **wide, _speech=run_number("speaker_id"))
    keys = ["recording_id", "speaker_id", "_speech"]
    reached = along(runs, keys, ["turn_index"], **wide, _reach=before_max("end_us"))
    fresh = F.when(F.col("start_us") <= F.col("_reach") + merge_gap_us, 0).otherwise(1)
    grouped = along(reached.withColumn("_new", fresh), keys, ["turn_index"], **wide, _island=upto_sum("_new")).groupBy(*keys, "_island")
    merged = grouped.agg(F.min_by("start_us", "turn_index").alias("start_us"), F.max("end_us").alias("end_us"), F.count("*").alias("n"))
    return merged.where(F.col("end_us") - F.col("start_us") >= least_us).drop("_speech", "_island")


def erode(turns: DataFrame, collar_us: int, near_us: int, least_us: int) -> DataFrame:
    """Takes a collar off both sides of each turn, and more where another speaker is closer than near_us: half of what
    is missing; drops what becomes shorter than least_us."""
    gaps = neighbour_gaps(turns)
    extra = lambda c: F.coalesce(F.when(F.col(c) < near_us, F.floor((near_us - F.col(c)) / 2)), F.lit(0))
    cut = gaps.withColumn("start_us", F.col("start_us") + collar_us + extra("gap_before_us")).withColumn("end_us", F.col("end_us") - collar_us - extra("gap_after_us"))
    return cut.where(F.col("end_us") - F.col("start_us") >= least_us)


def sliding_windows(turns: DataFrame, length_us: int, hop_us: int) -> DataFrame:
    """Windows over each turn; the last one ends with the turn. A turn shorter than a window is one window."""
    last = F.greatest(F.col("end_us") - length_us, F.col("start_us"))
    starts = F.array_distinct(F.concat(F.sequence(F.col("start_us"), last, F.lit(hop_us)), F.array(last)))
    at = turns.withColumn("window_start_us", F.explode(starts))
    return at.withColumn("window_end_us", F.least(F.col("window_start_us") + length_us, F.col("end_us")))


def first_appearance_labels(turns: DataFrame) -> DataFrame:
    """Labels spk_00, spk_01, ... in the order in which a recording's speakers first appear."""
    firsts = turns.groupBy("recording_id", "speaker_id").agg(F.min("turn_index").alias("_first"))
    rank = F.dense_rank().over(Window.partitionBy("recording_id").orderBy("_first"))
    names = firsts.select("recording_id", "speaker_id", F.format_string("spk_%02d", rank - 1).alias("label"))
    return turns.join(names, ["recording_id", "speaker_id"])


def hysteresis(frames: DataFrame, onset: float, offset: float, fill: int, pad: tuple[int, int] = (0, 0), least: int = 1) -> DataFrame:
    """Active runs of a probability track (recording_id, frame, p): on above onset, off below offset, in between as before.
    Runs get `pad` frames before and after, those shorter than `least` go, and gaps of up to `fill` frames close."""
    signal = F.when(F.col("p") > onset, 1).when(F.col("p") < offset, 0)
    states = along(frames, ["recording_id"], ["frame"], at="frame", width=1 << 14, _on=latest(signal))
    on = states.where("_on = 1").select("recording_id", F.col("frame").alias("start_us"), (F.col("frame") + 1).alias("end_us"))
    padded = islands(on, ["recording_id"]).select("recording_id", F.greatest(F.col("start_us") - pad[0], F.lit(0)).alias("start_us"), (F.col("end_us") + pad[1]).alias("end_us"))
    kept = padded.where(F.col("end_us") - F.col("start_us") >= least)
    return islands(kept, ["recording_id"], fill).select("recording_id", F.col("start_us").alias("first_frame"), F.col("end_us").alias("end_frame"), F.col("n").alias("runs"))


def duration_loss(raw: DataFrame, merged: DataFrame, final: DataFrame) -> DataFrame:
    """By recording: count, length, union and overlap of three stages, silence lost, and yields."""

    def stage(turns: DataFrame, name: str) -> DataFrame:
        sums = turns.groupBy("recording_id").agg(F.count("*").alias(f"{name}_turns"), F.sum(F.col("end_us") - F.col("start_us")).alias(f"{name}_us"))
        joined = sums.join(union_length(turns, ["recording_id"], cheap=True).withColumnRenamed("union_us", f"{name}_union_us"), "recording_id")
        return joined.withColumn(f"{name}_overlap_us", F.col(f"{name}_us") - F.col(f"{name}_union_us"))

    raw, merged, final = settled(raw), settled(merged), settled(final)
    both = stage(raw, "raw").join(stage(merged, "merged"), "recording_id", "left").join(stage(final, "final"), "recording_id", "left").na.fill(0)
    ratio = lambda a, b: F.round(F.try_divide(F.col(a), F.col(b)), 6)
    return both.withColumn("final_yield", ratio("final_us", "raw_us")).withColumn("union_yield", ratio("final_union_us", "raw_union_us")).withColumn("net_loss_us", F.col("raw_us") - F.col("final_us"))


def silent_gaps(frames: DataFrame, key: str, energy: str, most: float) -> DataFrame:
    """By key whether no frame is louder than `most`; a missing or non-finite value isn't silent."""
    value = F.col(energy).cast("double")
    sound = F.max(F.when(value.isNull() | F.isnan(value), F.lit(float("inf"))).otherwise(value))
    return frames.groupBy(key).agg(F.max(energy).alias("_loudest"), (sound <= most).alias("silent"))


def cutoff_curve(turns: DataFrame, step_us: int, steps: int) -> DataFrame:
    """For each threshold how many turns are at least that long, and their total length."""
    bins = turns.select(F.least(F.floor((F.col("end_us") - F.col("start_us")) / step_us), F.lit(steps)).alias("bin"), (F.col("end_us") - F.col("start_us")).alias("length"))
    by_bin = bins.groupBy("bin").agg(F.count("*").alias("n"), F.sum("length").alias("us"))
    grid = turns.sparkSession.range(steps + 1).withColumnRenamed("id", "bin").join(by_bin, "bin", "left").na.fill(0)
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    return grid.select((F.col("bin") * step_us).alias("threshold_us"), F.sum("n").over(down).alias("remaining"), F.sum("us").over(down).alias("remaining_us"))


def frames_of(turns: DataFrame, frame_us: int) -> Column:
    return F.explode(F.sequence(F.floor(F.col("start_us") / frame_us), F.ceil(F.col("end_us") / frame_us) - 1))
