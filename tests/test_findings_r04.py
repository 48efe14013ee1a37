"""Findings of round 4: queries on small tables that their SQL differed on or that took too much."""

import contextlib
import io
import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from spanloom.functions import splitters
from spanloom.operators import folds, picking, planning, sweeps
from spanloom.plans.registry import ORACLES, QUERIES
from test_operators import rows


def held(spark, folder, name, **tables):
    """The query's rows over these tables and those of its SQL."""
    con = duckdb.connect()
    for table, frame in tables.items():
        frame.to_parquet(folder / f"{table}.parquet")
        con.sql(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return rows(QUERIES[name](spark, str(folder)).toPandas()), rows(con.sql(ORACLES[name]).df())


def documents(ids, source="src1"):
    return pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "text": [f"text {i}" for i in range(len(ids))], "lang": "en", "source": source, "n_chars": 6})


def test_enrolment_names_over_a_thousand_clips_as_its_sql_does(spark, tmp_path):
    got, want = held(spark, tmp_path, "r09_enrolment", documents=documents([None, *range(1200)]))
    assert got == want
    clips = documents(range(1200))
    taken = spark.createDataFrame([("src1", 5)], "source string, last int")
    names = [r.name for r in picking.enrol(spark.createDataFrame(clips), taken, "source", "doc_id", "text").collect()]
    assert len(set(names)) == 1200 and "clip_1205" in names


def test_blind_batches_keep_shared_ids_and_repeated_documents(spark, tmp_path):
    got, want = held(spark, tmp_path, "r16_blind_batches", documents=documents([16491, 18081, 24144, 37930, 5, 5, None, *range(100, 140)]))
    assert got == want
    assert len(got) == 47


def test_families_of_five_digit_documents(spark, tmp_path):
    source = [None if i % 2 else "src7" for i in range(30)]
    got, want = held(spark, tmp_path, "t08_audio_family", documents=documents([*range(10), *range(12345, 12364), None], source))
    assert got == want


def busy_turns(spark, n, length, longest):
    rng = np.random.default_rng(5)
    start = rng.integers(0, length, n)
    end = np.minimum(start + rng.integers(1, np.where(rng.random(n) < 0.02, longest, 60)), length)
    frame = pd.DataFrame({"recording_id": rng.choice(["a", "b"], n), "turn_index": np.arange(n, dtype=np.int32), "start_us": start * 10 + 3, "end_us": end * 10 + 7})
    p = rng.integers(0, 8, length + 1) / 8
    frames = pd.DataFrame([(r, i, x) for r in "ab" for i, x in enumerate(p.tolist())], columns=["recording_id", "frame", "p"])
    return frame, p, spark.createDataFrame(frame), spark.createDataFrame(frames)


def test_turns_of_a_block_share_its_frames(spark):
    frame, p, turns, frames = busy_turns(spark, 600, 500, 400)
    want = []
    for r in frame.itertuples():
        a, b = r.start_us // 10, r.end_us // 10
        if b - a > 7:
            want += [(r.recording_id, r.turn_index, x, y, ok) for x, y, ok in folds.split_at_minimum(a, p[a:b], 7, 0.5)]
    tracks = folds.tracks(turns, frames, 10, 7, block=64).collect()
    asked = sum(t.turn_index is not None for t in tracks)
    assert asked == len({w[:2] for w in want})
    assert len(tracks) - asked < 150  # blocks of frames; a row a turn and frame are about 18000
    assert sorted(map(tuple, folds.plan_segments(turns, frames, 10, 7, 0.5).collect())) == sorted(want)
    tracks = folds.tracks(turns, frames, 10, 7, block=64)
    splitters.register(spark)
    assert sorted(map(tuple, spark.sql("SELECT * FROM quiet_cuts(TABLE(SELECT * FROM {t}) PARTITION BY (recording_id, part), 7, 0.5D)", t=tracks).collect())) == sorted(want)


def test_lineage_plans_its_segments_once(spark):
    _, _, turns, frames = busy_turns(spark, 300, 500, 100)
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        planning.split_with_lineage(turns, folds.plan_segments(turns, frames, 10, 7, 0.5), 10).explain()
    assert plan.getvalue().split("== Initial Plan ==")[0].count("FlatMapGroupsInPandas") == 1


def plan_of(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    return out.getvalue().split("== Initial Plan ==")[0]


def crowd(seed, n):
    rng = random.Random(seed)
    spans = []
    for i in range(n):
        start = rng.randint(0, 400)
        spans.append((rng.choice(["a", "b", None]), i, rng.choice(["x", "x", "x", "y", "z", None]), start, start + rng.choice([1, 2, 5, 5, 30, 200])))
    return spans


TURN = "recording_id string, turn_index int, speaker_id string, start_us long, end_us long"


@pytest.mark.parametrize("n", [0, 12, 150])
def test_overlap_of_others_without_pairs_of_turns(spark, n):
    turns = crowd(n, n)
    want = []
    for r, i, who, start, end in turns:
        heard = {t for q, _, s, a, b in turns if q == r and r and s and who and s != who for t in range(max(a, start), min(b, end))}
        want.append((r, i, len(heard)))
    got = sweeps.other_speaker_overlap(spark.createDataFrame(turns, TURN), bucket_us=50)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert "Join" not in plan_of(got)


@pytest.mark.parametrize("n", [0, 25, 150])
def test_word_owners_without_pairs_of_words_and_turns(spark, n):
    turns, words, want = crowd(n + 1, n), [], []
    for r, i, _, start, end in crowd(n + 2, n):
        words.append((r, i, start - 3, max(end - 6, start - 2)))
    words += [("a", 900, 10, 12), ("a", 900, 10, 12)]
    for r, i, start, end in words:
        met = [(t, s, a <= start and b >= end) for q, t, s, a, b in turns if q == r and r and a < end and start < b] * (2 if i == 900 else 1)
        inside = [t for t, _, holds in met if holds]
        if len(inside) == 1 and len({s for _, s, _ in met if s}) == 1:
            want.append((r, i, inside[0]))
    got = sweeps.word_owners(spark.createDataFrame(words, "recording_id string, word_id long, start_us long, end_us long"), spark.createDataFrame(turns, TURN), bucket_us=50)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert "Join" not in plan_of(got)


@pytest.mark.parametrize("seed", range(4))
def test_turns_are_cut_at_pauses_of_the_recording(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(sweeps.pauses, "__defaults__", (40,))
    turns = crowd(seed, 80)
    words = [(r, i, at, at + rng.choice([1, 1, 3, 3, 8, 60]), rng.random() < 0.4) for i in range(120) for r, at in [(rng.choice(["a", "b", None]), rng.randint(-5, 600))]]
    pause, margin, want = seed % 2 * 2, seed // 2, []
    for r, i, _, start, end in turns:
        said = sorted((a, b, s) for q, _, a, b, s in words if q == r and r and a < end and start < b)
        if end - start <= 20:
            want.append((r, i, 0, start, end, "below_min_duration" if end - start < 4 else None))
        else:
            pieces, reason = planning.cut_at_gaps(start, end, planning.gaps_between(said, pause), 4, 20, margin)
            rest = [(pieces[-1][1] if pieces else start, end, reason)] if reason else []
            want += [(r, i, k, *p) for k, p in enumerate([*[(a, b, None) for a, b in pieces], *rest])]
    said = spark.createDataFrame(words, "recording_id string, word_id long, start_us long, end_us long, sentence boolean")
    met = []
    join = planning.I.range_join
    monkeypatch.setattr(planning.I, "range_join", lambda a, b, *rest: met.append(b.columns) or join(a, b, *rest))
    got = planning.segment_at_words(spark.createDataFrame(turns, TURN), said, 4, 20, pause, margin)
    assert sorted(map(tuple, got.select("recording_id", "turn_index", "piece", "start_us", "end_us", "reason").collect()), key=repr) == sorted(want, key=repr)
    assert met == [["recording_id", "b_start_us", "b_end_us", "ends"]]  # pauses, not words
