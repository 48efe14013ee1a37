"""Streams against the batch operators that they are counterparts of."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators import intervals as I
from spanloom.streaming import merging

RAW = "ts timestamp, recording_id string, speaker_id string, event_id long, start_us long, end_us long, confidence double"


def some_turns(rng, n, first=0):
    """Turns of two days in order of time, and as (row of the stream)."""
    out, at = [], 0
    for i in range(n):
        at += rng.randint(0, 400_000_000)
        day, start = divmod(at, 86_400_000_000)
        length = rng.choice([1_000_000, 50_000_000, 90_000_000, 500_000_000])
        out.append((day, start, start + length, rng.choice("aab"), first + i, rng.choice([None, 0.5, 0.25])))
    return out


def write(spark, turns, path):
    from datetime import datetime, timedelta

    epoch = datetime(2024, 1, 1)
    rows = [(epoch + timedelta(days=d, microseconds=a), (epoch + timedelta(days=d)).strftime("%Y-%m-%d"), s, e, a, b, c) for d, a, b, s, e, c in turns]
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(path)


def run(session, path, out, checkpoint, gap):
    stream = session.readStream.schema(RAW).parquet(path)
    query = merging.merge_stream(stream, gap, "1 hour").writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@pytest.mark.parametrize("slices", [1, 4])
def test_merged_stream_gives_the_rows_of_the_batch_once(spark, tmp_path, slices):
    rng, gap = random.Random(slices), 120_000_000
    session = merging.with_rocks(spark)
    turns = some_turns(rng, 700)
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    step = -(-len(turns) // slices)
    for i in range(slices):
        part = turns[i * step : i * step + step]
        rng.shuffle(part)  # order within what the watermark allows doesn't matter
        write(session, part, path)
        run(session, path, out, checkpoint, gap)  # each run goes on from the checkpoint of the one before
    write(session, [(40, 0, 0, None, -1, None)], path)  # no turn: it only moves the watermark past all others
    run(session, path, out, checkpoint, gap)
    write(session, [(0, 5, 10_000_000, "late", -2, None)], path)  # too late, dropped
    run(session, path, out, checkpoint, gap)
    key = ["recording_id", "speaker_id", "start_us", "end_us", "sources", "confidence"]
    got = sorted(map(str, session.read.parquet(out).select(*key).collect()))
    raw = session.read.schema(RAW).parquet(path).where("event_id >= 0").drop("ts")
    want = sorted(map(str, I.merge_turns(I.normalize(raw), gap).select(*key).collect()))
    assert got == want and any("sources=3" in r for r in want)


def test_speakers_carried_over_windows_are_those_of_a_plain_loop(spark):
    from itertools import product

    import numpy as np

    from spanloom.operators import profiles

    rng = np.random.default_rng(5)
    voices = rng.normal(size=(6, 12))
    rows = []
    for recording, window in product("abc", range(9)):
        for local in range(rng.integers(0, 4)):
            rows.append((recording, window, local, [float(x) for x in voices[rng.integers(6)] + 0.2 * rng.normal(size=12)]))
    rows += [("a", 3, 9, None), (None, 1, 1, [1.0] * 12), ("zero", 0, 0, [0.0] * 12), ("zero", 1, 0, [0.0] * 12)]
    got = profiles.carry_speakers(spark.createDataFrame(rows, "recording_id string, window int, local int, embedding array<double>"), 0.6).collect()
    mine = {(r.recording_id, r.window, r.local): r["global"] for r in got}
    want = {}
    for recording in {r[0] for r in rows if r[0]}:
        known: list[tuple[np.ndarray, int]] = []
        for window in range(9):
            now = sorted((r[2], np.array(r[3])) for r in rows if r[0] == recording and r[1] == window and r[3])
            cosine = lambda a, b: a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) if a.any() and b.any() else 0.0
            best, score = None, -1.0
            for choice in product([None, *range(len(known))], repeat=len(now)):
                used = [c for c in choice if c is not None]
                worth = [cosine(now[i][1], known[c][0]) for i, c in enumerate(choice) if c is not None]
                if len(set(used)) == len(used) and all(w >= 0.6 for w in worth) and sum(worth) > score:
                    best, score = choice, sum(worth)
            fresh = len(known)
            for (local, e), c in zip(now, best, strict=True):
                g = c
                if c is None:
                    g, fresh = fresh, fresh + 1
                    known.append((e, 1))
                else:
                    both = known[c][0] * known[c][1] + e
                    known[c] = (both / np.linalg.norm(both), known[c][1] + 1)
                want[recording, window, local] = g
    assert mine == want and len(set(want.values())) > 4


def test_each_request_has_one_artifact_even_if_a_batch_is_run_again(spark, tmp_path):
    from spanloom.streaming import publishing as P

    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    schema = "id long, ask string, model string"
    calls = []

    def answer(new):
        calls.append(1)
        return new.withColumn("said", F.upper("ask"))

    def send(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        P.finished(P.publish(spark.readStream.schema(schema).parquet(source), out, checkpoint, ["ask", "model"], ["id"], answer))

    assert P.published(spark, out) is None
    send([(1, "a", "m"), (2, "a", "m"), (3, "b", None), (4, None, "b"), (5, "", "m")])
    send([(6, "a", "m"), (7, "c", "m"), (0, "b", None)])
    got = sorted((r.id, r.ask, r.model, r.said) for r in P.published(spark, out).collect())
    assert got == [(1, "a", "m", "A"), (3, "b", None, "B"), (4, None, "b", None), (5, "", "m", ""), (7, "c", "m", "C")]
    # the driver fails after a batch was written and before it was noted: it runs again, over its own folder
    import os

    last = max(int(x) for x in os.listdir(f"{checkpoint}/commits") if x.isdigit())
    os.remove(f"{checkpoint}/commits/{last}")
    if os.path.exists(f"{checkpoint}/commits/.{last}.crc"):
        os.remove(f"{checkpoint}/commits/.{last}.crc")
    P.finished(P.publish(spark.readStream.schema(schema).parquet(source), out, checkpoint, ["ask", "model"], ["id"], answer))
    assert len(calls) == 3
    assert sorted((r.id, r.ask, r.model, r.said) for r in P.published(spark, out).collect()) == got
