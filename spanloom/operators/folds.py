"""Order-dependent folds and small optimisations, a group of one recording (or turn) at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators import cuts
from spanloom.operators import intervals as I
from spanloom.operators.timeline import along, upto_sum
from spanloom.sources.scratch import settled


def merge_capped(turns: DataFrame, gap_us: int, most_us: int) -> DataFrame:
    """Same-speaker merging as merge_turns(), and no merged turn longer than most_us. Which neighbours may join is found
    by windows and a range join; only the cap looks at where a merged turn began, so each chain of joins is cut greedily."""
    keys, order = ["recording_id", "chain"], ["start_us", "turn_index"]
    decided = I.merge_decisions(turns, gap_us)
    chained = along(decided, ["recording_id"], order, chain=upto_sum(F.when(F.col("decision") == "merged", 0).otherwise(1)))
    merged = cuts.cut_where(chained, keys, order, "start_us", "end_us", F.col("start_us") + most_us, most_us * 16)
    grouped = merged.groupBy("recording_id", "speaker_id", "chain", "group")
    return grouped.agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.count("*").alias("sources")).drop("chain", "group")


class Minima:
    """The least values of any stretches of a track, and where they stand nearest to a place, each without looking at the
    stretch: minima of all stretches of 1, 2, 4, ... values, up to the longest asked for, and the places of each value in
    order. Values are looked up by their rank."""

    def __init__(self, p: np.ndarray, longest: int) -> None:
        self.values, rank = np.unique(p, return_inverse=True)
        self.levels = [rank]
        while 2 << len(self.levels) - 1 <= min(longest, len(p)):
            half = 1 << len(self.levels) - 1
            self.levels.append(np.minimum(self.levels[-1][:-half], self.levels[-1][half:]))
        self.order = np.argsort(rank, kind="stable")
        self.wide = len(p) + 1
        self.places = rank[self.order] * self.wide + self.order

    def least(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rank of the least value of each start:end."""
        level = np.frexp(end - start)[1] - 1
        out = np.empty(len(start), dtype=np.int64)
        for n in np.unique(level):
            own = level == n
            out[own] = np.minimum(self.levels[n][start[own]], self.levels[n][end[own] - (1 << int(n))])
        return out

    def nearest(self, rank: np.ndarray, start: np.ndarray, end: np.ndarray, twice: np.ndarray) -> np.ndarray:
        """Place of the value in each start:end, which has it, that is nearest to twice / 2, the earlier of two."""
        at = np.searchsorted(self.places, rank * self.wide + (twice + 1) // 2)
        found = []
        for k in (at - 1, at):
            place = self.order[np.clip(k, 0, len(self.order) - 1)]
            real = (k >= 0) & (k < len(self.order)) & (self.levels[0][place] == rank) & (place >= start) & (place < end)
            found.append((place, np.where(real, np.abs(2 * place - twice), np.iinfo(np.int64).max)))
        (before, near), (behind, far) = found
        return np.where(near <= far, before, behind)


def split_at_minima(p: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, from, to, fits) of the pieces of many stretches of a track: one that is too long is cut at its least
    probability (ties: nearest to the middle, then earliest) if that is under the threshold. All are cut at once, round by
    round; a cut takes the logarithm of the frames, not all of them."""
    minima = Minima(p, int((ends - starts).max(initial=0)))
    which, a, b, done = np.arange(len(starts)), starts, ends, []
    while len(which):
        long = (b - a > most) & (b - a >= 3)
        done.append((which[~long], a[~long], b[~long], (b - a <= most)[~long]))
        which, a, b = which[long], a[long], b[long]
        value = minima.least(a + 1, b)
        quiet = minima.values[value] < threshold
        done.append((which[~quiet], a[~quiet], b[~quiet], np.zeros((~quiet).sum(), dtype=bool)))
        which, a, b = which[quiet], a[quiet], b[quiet]
        k = minima.nearest(value[quiet], a + 1, b, a + b)
        which, a, b = np.concatenate([which, which]), np.concatenate([a, k]), np.concatenate([k, b])
    out = [np.concatenate(c) for c in zip(*done, strict=True)] or [starts, starts, ends, starts > ends]
    order = np.lexsort((out[1], out[0]))
    return tuple(c[order] for c in out)


def split_at_minimum(start: int, p: np.ndarray, most: int, threshold: float) -> list[tuple[int, int, bool]]:
    """Pieces (from, to, fits) of one stretch of frames, see split_at_minima()."""
    _, a, b, fits = split_at_minima(p, np.array([0]), np.array([len(p)]), most, threshold)
    return list(zip((start + a).tolist(), (start + b).tolist(), fits.tolist(), strict=True))


#: Frames of a recording that come to a task together.
BLOCK = 1 << 12


def tracks(turns: DataFrame, frames: DataFrame, frame_us: int, most_frames: int, block: int = BLOCK) -> DataFrame:
    """(recording_id, part, turn_index, first, end, frames, p): the turns of more than most_frames with their bounds in frames,
    and in rows without a turn_index what a part of them needs of the frames (recording_id, frame, p).

    A part is the turns that begin in one block of frames; they need that block and the next. A turn that is longer than a
    block is a part of its own. So frames aren't copied for each turn, and no part holds more than the longest turn's.
    """
    first, end = F.floor(F.col("start_us") / frame_us), F.floor(F.col("end_us") / frame_us)
    long = turns.select("recording_id", "turn_index", first.alias("first"), end.alias("end")).where(F.col("end") - F.col("first") > most_frames)
    in_block = lambda c: F.floor(c / block)
    part = F.when(F.col("end") - F.col("first") <= block, in_block(F.col("first"))).otherwise(-1 - F.col("turn_index"))
    keys = ["recording_id", "part"]
    long = settled(long.withColumn("part", part))
    reach = long.groupBy(*keys).agg(F.min(in_block(F.col("first"))).alias("_a"), F.max(in_block(F.col("end") - 1)).alias("_b"))
    blocks = frames.where("p IS NOT NULL").groupBy("recording_id", in_block(F.col("frame")).alias("_block")).agg(F.collect_list(F.struct("frame", F.col("p").cast("double").alias("p"))).alias("_f"))
    known = reach.select(*keys, F.explode(F.sequence("_a", "_b")).alias("_block")).join(blocks, ["recording_id", "_block"])
    none = lambda kind: F.lit(None).cast(kind)
    given = known.select(*keys, none("int").alias("turn_index"), none("long").alias("first"), none("long").alias("end"), F.col("_f.frame").alias("frames"), F.col("_f.p").alias("p"))
    return long.select(*keys, "turn_index", "first", "end", none("array<long>").alias("frames"), none("array<double>").alias("p")).unionAll(given)


def split_part(turns: np.ndarray, known: list[tuple[np.ndarray, np.ndarray]], most: int, threshold: float) -> tuple[np.ndarray, ...]:
    """(turn_index, first_frame, end_frame, fits) of the pieces of the turns (turn_index, first, end) of a part of tracks(),
    given its blocks (frames, p). A frame that isn't known is never cut at; a turn without a known one is left out."""
    low, high = int(turns[:, 1].min(initial=0)), int(turns[:, 2].max(initial=0))
    track, there = np.full(high - low, np.inf), np.zeros(high - low + 1, dtype=np.int64)
    for at, p in known:
        at, p = np.asarray(at, dtype=np.int64) - low, np.asarray(p, dtype=float)
        inside = (at >= 0) & (at < len(track))
        track[at[inside]], there[at[inside] + 1] = p[inside], 1
    there = there.cumsum()
    turns = turns[there[turns[:, 2] - low] > there[turns[:, 1] - low]]
    which, a, b, fits = split_at_minima(track, turns[:, 1] - low, turns[:, 2] - low, most, threshold)
    return turns[which, 0], a + low, b + low, fits


def plan_segments(turns: DataFrame, frames: DataFrame, frame_us: int, most_frames: int, threshold: float) -> DataFrame:
    """Splits turns of more than most_frames at quiet frames (recording_id, frame, p); only those meet their frames."""

    def split(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows.turn_index.notna()
        known, turns = rows.loc[~asked], rows.loc[asked, ["turn_index", "first", "end"]].to_numpy(dtype=np.int64)
        found = split_part(turns, list(zip(known.frames, known.p, strict=True)), most_frames, threshold)
        return pd.DataFrame(dict(zip(["turn_index", "first_frame", "end_frame", "fits"], found, strict=True))).assign(recording_id=key[0])

    rows = tracks(turns, frames, frame_us, most_frames)
    # few bytes, much work: not to be coalesced by size
    dealt = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "recording_id", "part")
    return dealt.groupBy("recording_id", "part").applyInPandas(split, "recording_id string, turn_index int, first_frame long, end_frame long, fits boolean")


def best_assignment(weights: np.ndarray) -> list[tuple[int, int]]:
    """Rows to columns, one to one, of the largest total weight; only pairs of positive weight. Hungarian method: each
    row in turn takes its column along a shortest path of reduced costs."""
    w = np.maximum(weights if weights.shape[0] <= weights.shape[1] else weights.T, 0)
    m, n = w.shape
    of_row, of_col = np.zeros(m + 1), np.zeros(n + 1)
    owner = np.zeros(n + 1, dtype=int)  # 1-based; column 0 holds the row that looks for a place
    for row in range(1, m + 1):
        owner[0], at = row, 0
        least, back, done = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=int), np.zeros(n + 1, dtype=bool)
        while owner[at]:
            done[at] = True
            cost = np.append(np.inf, -w[owner[at] - 1] - of_row[owner[at]] - of_col[1:])
            nearer = ~done & (cost < least)
            least[nearer], back[nearer] = cost[nearer], at
            following = int(np.argmin(np.where(done, np.inf, least)))
            step = least[following]
            of_row[owner[done]] += step
            of_col[done] -= step
            least[~done] -= step
            at = following
        while at:
            owner[at] = owner[back[at]]
            at = back[at]
    pairs = [(int(owner[j]) - 1, j - 1) for j in range(1, n + 1) if owner[j] and w[owner[j] - 1, j - 1] > 0]
    return sorted(pairs if weights.shape[0] <= weights.shape[1] else [(j, i) for i, j in pairs])


def match_speakers(weights: DataFrame) -> DataFrame:
    """One-to-one mapping of secondary to primary speakers of each recording by overlap (recording_id, speaker_id,
    b_speaker_id, weight)."""

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.pivot_table(index="speaker_id", columns="b_speaker_id", values="weight", aggfunc="sum", fill_value=0)
        found = [(pdf.recording_id.iloc[0], table.index[i], table.columns[j], int(table.iat[i, j])) for i, j in best_assignment(table.to_numpy(float))]
        return pd.DataFrame(found, columns=["recording_id", "speaker_id", "mapped_from", "weight"])

    return weights.groupBy("recording_id").applyInPandas(match, "recording_id string, speaker_id string, mapped_from string, weight long")
