"""Same-speaker merging of turns on a stream, with state by recording.

A turn can be joined to the one before it as soon as nothing that begins before its end can still come: when the watermark
has reached that end. Until then it waits in the state; with it stay the latest end of each speaker's earlier turns and
the merged turn that is still open. So the state holds what the watermark spans, however long a recording is.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from spanloom.sources.tables import DAY_US

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

MERGED = "recording_id string, speaker_id string, start_us long, end_us long, sources long, confidence double"

_TURN = "start_us long, end_us long, speaker_id string, event_id long, confidence double"
_OPEN = "speaker_id string, start_us long, end_us long, sources long, confidence double, last_start long, last_end long"


class Merger(StatefulProcessor):
    """Merges the turns of one recording, a day, in order of (start, end, speaker, event)."""

    def __init__(self, gap_us: int) -> None:
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _TURN)
        self.open = handle.getValueState("open", _OPEN)
        self.reach = handle.getMapState("reach", "speaker_id string", "end_us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        day = _day_ms(key[0])
        for batch in rows:
            turns = batch[(batch["end_us"] > batch["start_us"]) & (batch["start_us"] < DAY_US)]
            found = [
                (int(a), min(int(b), DAY_US), s, int(e), None if pd.isna(c) else float(c))
                for a, b, s, e, c in zip(turns["start_us"], turns["end_us"], turns["speaker_id"], turns["event_id"], turns["confidence"], strict=True)
            ]
            if found:
                self.waiting.appendList(found)
                # a timer a second at most, and one for what is open at the end of the day
                for second in {-(-t[1] // 1_000_000) for t in found} | {DAY_US // 1_000_000}:
                    self.handle.registerTimer(day + second * 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = (timerValues.getCurrentWatermarkInMs() - _day_ms(key[0])) * 1000
        waiting = sorted(((t[0], t[1], t[2], t[3], t[4]) for t in self.waiting.get()), key=lambda t: t[:4])
        ready = next((i for i, t in enumerate(waiting) if t[1] > upto), len(waiting))
        out = []
        if ready:
            now = tuple(self.open.get()) if self.open.exists() else None
            reach = {k[0]: v[0] for k, v in self.reach.iterator()}
            for i, (start, end, speaker, _, confidence) in enumerate(waiting[:ready]):
                if now and now[0] == speaker and 0 <= start - now[6] <= self.gap_us and not _rival(speaker, now[5], end, reach, waiting, i):
                    least = None if now[4] is None or confidence is None else min(now[4], confidence)
                    now = (speaker, now[1], end, now[3] + 1, least, start, end)
                else:
                    out += [now] if now else []
                    now = (speaker, start, end, 1, confidence, start, end)
                reach[speaker] = max(end, reach.get(speaker, end))
            self.open.update(now)
            for speaker, end in reach.items():
                self.reach.updateValue((speaker,), (end,))
            if waiting[ready:]:
                self.waiting.put(waiting[ready:])
            else:
                self.waiting.clear()
        if upto >= DAY_US and ready == len(waiting) and self.open.exists():
            out.append(tuple(self.open.get()))
            self.open.clear()
            self.reach.clear()
        if out:
            yield pd.DataFrame([(key[0], *m[:5]) for m in out], columns=[f.split()[0] for f in MERGED.split(", ")]).astype({"confidence": "Float64"})

    def close(self) -> None:
        pass


def _day_ms(recording: str) -> int:
    return int(datetime.strptime(recording, "%Y-%m-%d").replace(tzinfo=UTC).timestamp() * 1000)


def _rival(speaker: str, start: int, end: int, reach: dict[str, int], waiting: list, i: int) -> bool:
    """Whether another speaker's turn touches (start, end): one before the i-th that waits, or one from it on."""
    if any(s != speaker and e > start for s, e in reach.items()):
        return True
    for t in waiting[i + 1 :]:
        if t[0] >= end:
            return False
        if t[2] != speaker:
            return True
    return False


def merge_stream(turns: DataFrame, gap_us: int, late: str = "1 hour") -> DataFrame:
    """The rows of merge_turns() for a stream of raw turns (ts, recording_id: the day of ts, speaker_id, event_id, start_us,
    end_us, confidence), each as soon as it is settled, and once. Turns later than the watermark are dropped; rows that are
    no turns only move it. The session's state store must be RocksDB (see with_rocks())."""
    stamped = turns.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    rows = stamped.select("ts", "recording_id", "speaker_id", "event_id", "start_us", "end_us", "confidence")
    return rows.groupBy("recording_id").transformWithStateInPandas(Merger(gap_us), MERGED, "Append", "EventTime")


def with_rocks(spark: SparkSession) -> SparkSession:
    """A session of its own on the same cluster, whose streams keep state in RocksDB."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    return session
