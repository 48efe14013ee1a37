import os
import random
from concurrent.futures import ThreadPoolExecutor

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F

from spanloom.functions import signal as G
from spanloom.functions import text as T
from spanloom.functions.signal import active_rms, si_sdr_db, snr_db
from spanloom.functions.text import _forms, _salvage
from spanloom.operators import alignment as L
from spanloom.operators import folds
from spanloom.operators import intervals as I
from spanloom.operators import picking, planning
from spanloom.operators.timeline import along, before_max, following, island, latest, place, previous, run_number, upcoming, upto_sum
from spanloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows(frame):
    frame = frame[sorted(frame.columns)]
    cell = lambda x: None if x is None or x is pd.NA or x != x else round(float(x), 5) if isinstance(x, (int, float, np.number)) and not isinstance(x, (bool, np.bool_)) else str(x)
    return sorted((tuple(map(cell, r)) for r in frame.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    found = duckdb.connect()
    for f in os.listdir(SF):
        found.sql(f"create view {f[:-8]} as select * from read_parquet('{SF}/{f}')")
    return found


@pytest.fixture(scope="module")
def answers(spark, request):
    """The rows of all queries that the chosen tests ask for, several at a time: small queries leave cores idle."""
    asked = {item.callspec.params["name"] for item in request.session.items if "answers" in getattr(item, "fixturenames", ())}
    with ThreadPoolExecutor(8) as pool:
        yield {name: pool.submit(lambda n: QUERIES[n](spark, SF).toPandas(), name) for name in sorted(asked)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_sql_gives(answers, con, name):
    assert rows(answers[name].result()) == rows(con.sql(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(answers, name):
    assert len(answers[name].result()) > 0


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_merge_without_reaching_the_cap_is_the_plain_merge(spark):
    rng = random.Random(3)
    data, at = [], 0
    for i in range(120):
        at += rng.randint(0, 4)
        data.append((f"r{i % 3}", rng.choice("ab"), at, at + rng.randint(1, 4), i, 0.5))
    turns = I.normalize(spark.createDataFrame(data, "recording_id string, speaker_id string, start_us long, end_us long, event_id long, confidence double"))
    key = ["recording_id", "speaker_id", "start_us", "end_us", "sources"]
    plain, capped = I.merge_turns(turns, 3).select(*key), folds.merge_capped(turns, 3, 10**9).select(*key)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, capped.collect()))


def test_runs_and_islands_over_buckets_are_those_of_a_plain_loop(spark):
    rng = random.Random(11)
    data, at = [], {}
    for i in range(400):
        key = rng.choice(["a", "b", None])
        at[key] = at.get(key, 0) + rng.choice([0, 0, 1, 2, 30])
        data.append((key, at[key], at[key] + rng.choice([0, 1, 5, 60]), i, rng.choice(["x", "y", None])))
    turns = spark.createDataFrame(data, "k string, start_us long, end_us long, i long, v string")
    got = along(turns, ["k"], ["start_us", "end_us", "i"], width=7, run=run_number("v"), island=island(2)).collect()
    assert len(got) == len(data)
    for key in at:
        run, last, start, reach = 0, object(), None, None
        for r in sorted((r for r in got if r.k == key), key=lambda r: (r.start_us, r.end_us, r.i)):
            run, last = run + (r.v != last or run == 0), r.v
            start = r.start_us if reach is None or r.start_us > reach + 2 else start
            reach = max(r.end_us, reach if reach is not None else r.end_us)
            assert (r.run, r.island) == (run, start)


@pytest.mark.parametrize(("name", "most"), [("w04_cleanup", 10), ("a04_duration_loss", 12), ("w01_merge_turns", 10), ("j04_other_speaker_overlap", 10), ("w03_islands", 10), ("w08_context_collar", 20)])
def test_chained_windows_do_not_double_the_plan(spark, name, most):
    from contextlib import redirect_stdout
    from io import StringIO

    with redirect_stdout(StringIO()) as out:
        QUERIES[name](spark, SF).explain()
    plan = out.getvalue().split("== Initial Plan ==")[0]
    assert 0 < plan.count("FileScan") <= most


@pytest.mark.parametrize("block", [3, 16, 1 << 13])
def test_greedy_cuts_are_those_of_a_plain_fold(spark, monkeypatch, block):
    from spanloom.operators import cuts

    monkeypatch.setattr(cuts, "BLOCK", block)
    monkeypatch.setattr(cuts.group_starts, "__defaults__", (block,))
    rng = random.Random(block)
    data = [(rng.choice(["a", "b", None, "c"]), i * 3, rng.choice([0, 1, 4, 9, 30, None])) for i in range(300)] + [("one", 5, 100), ("one", 6, 1)]
    got = cuts.pack(spark.createDataFrame(data, "k string, at long, bytes long"), ["k"], ["at"], "at", "bytes", 20, 5, 40).collect()
    assert len(got) == len(data)
    for key in {d[0] for d in data}:
        held = n = began = 0
        for i, r in enumerate(sorted((r for r in got if r.k == key), key=lambda r: r["at"])):
            size = r["bytes"] or 0
            if i and (held + size > 20 or n >= 5):
                held, n, began = 0, 0, i
            held, n = held + size, n + 1
            assert (r.place, r.group) == (i, began)


def test_the_capped_merge_cuts_chains_where_a_fold_does(spark):
    rng = random.Random(9)
    data, at = [], 0
    for i in range(400):
        at += rng.randint(0, 3)
        end = at + rng.choice([1, 2, 3, 40])
        data.append((f"r{i % 2}", "a" if i % 50 else "b", at, end, i, 0.5))
        at = end
    turns = I.normalize(spark.createDataFrame(data, "recording_id string, speaker_id string, start_us long, end_us long, event_id long, confidence double"))
    got = sorted(map(tuple, folds.merge_capped(turns, 60, 30).select("recording_id", "start_us", "end_us", "sources").collect()))
    want = []
    for r in I.merge_decisions(turns, 60).orderBy("recording_id", "turn_index").collect():
        if r.decision == "merged" and want and want[-1][0] == r.recording_id and r.end_us - want[-1][1] <= 30:
            want[-1] = (r.recording_id, want[-1][1], r.end_us, want[-1][3] + 1)
        else:
            want.append((r.recording_id, r.start_us, r.end_us, 1))
    assert got == sorted(want) and max(w[3] for w in want) > 2


def test_the_merge_tree_gives_what_merging_at_any_gap_gives(spark):
    rng = random.Random(21)
    data, at = [], {}
    for i in range(250):
        r = rng.choice("xy")
        start = at.get(r, 0) + rng.choice([-1, 0, 0, 1, 2, 2, 5, 9, 40])
        end = start + rng.randint(1, 6)
        data.append((r, rng.choice("aaaab"), max(start, 0), end, i, 0.5))
        at[r] = end
    turns = I.normalize(spark.createDataFrame(data, "recording_id string, speaker_id string, start_us long, end_us long, event_id long, confidence double"))
    tree = planning.merge_tree(turns, 20).collect()
    assert len(tree) < 2 * len(data)
    for gap in (0, 1, 2, 3, 5, 8, 9, 20):
        want = sorted((m.recording_id, m.end_us - m.start_us, m.sources) for m in I.merge_turns(turns, gap).collect())
        assert sorted((c.recording_id, c.us, c.turns) for c in tree if c.from_us <= gap and (c.to_us is None or gap < c.to_us)) == want


@pytest.mark.parametrize("seed", range(12))
def test_split_by_minima_is_the_plain_recursion(seed):
    rng = np.random.default_rng(seed)
    p = rng.integers(0, rng.choice([3, 10, 1000]), rng.integers(1, 400)) / 10
    most, threshold = int(rng.integers(2, 20)), float(rng.choice([0.2, 0.5, 50.0]))

    def plain(a, b):
        if b - a <= most or b - a < 3:
            return [(a, b, b - a <= most)]
        k = min(range(a + 1, b), key=lambda i: (p[i], abs(2 * i - a - b), i))
        return [(a, b, False)] if p[k] >= threshold else plain(a, k) + plain(k, b)

    assert folds.split_at_minimum(7, p, most, threshold) == [(a + 7, b + 7, ok) for a, b, ok in plain(0, len(p))]


def test_caps_carry_across_strata_as_in_a_plain_loop(spark):
    import hashlib

    rng = random.Random(31)
    data = [(i, rng.choice(["x", "y", "z"]), rng.choice("aaaaabcdefg")) for i in range(300)]
    rows = spark.createDataFrame(data, "id long, stratum string, speaker string")
    for per, n in ((1, 5), (3, 12), (4, 200)):
        queues = {s: sorted((d for d in data if d[1] == s), key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest()) for s in "xyz"}
        want, of = [], {}
        while len(want) < n and any(queues.values()):
            for s in "xyz":
                while queues[s] and len(want) < n:
                    d = queues[s].pop(0)
                    if of.get(d[2], 0) < per:
                        of[d[2]] = of.get(d[2], 0) + 1
                        want.append(d[0])
                        break
        got = picking.capped_round_robin(rows, "stratum", "speaker", "id", per, n).orderBy("place").collect()
        assert [r.id for r in got] == want


def test_a_donor_is_the_next_clip_of_another_speaker_on_the_ring(spark):
    import hashlib

    from spanloom.operators import judging

    rng = random.Random(13)
    for clips in ([(i, rng.choice("aaaab")) for i in range(60)], [(i, "a") for i in range(5)], [(0, "a"), (1, "b")], []):
        got = {r.clip: r.donor for r in judging.ring_donors(spark.createDataFrame(clips, "clip long, who string"), "clip", "who", 3).collect()}
        ring = sorted((int(hashlib.md5(f"3:{c}".encode()).hexdigest()[:12], 16), c, w) for c, w in clips)
        want = {c: next((d for _, d, v in ring[i + 1 :] + ring[:i] if v != w), None) for i, (_, c, w) in enumerate(ring)}
        assert got == want


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_first_turns_are_thirty_a_recording_or_all_of_a_shorter_one(spark, sf):
    from spanloom.plans.registry import QUERIES, turns

    of = {r.recording_id: r["count"] for r in turns(spark, f"/root/testdata/{sf}").groupBy("recording_id").count().collect()}
    got = {r.recording_id: r["count"] for r in QUERIES["k04_first_turns"](spark, f"/root/testdata/{sf}").groupBy("recording_id").count().collect()}
    assert got == {k: min(n, 30) for k, n in of.items()}


def test_too_small_groups_and_strata_are_errors(spark):
    from spanloom.operators import analytics

    rows = spark.createDataFrame([(i, i % 3) for i in range(10)], "i long, k long")
    assert analytics.first_per_group(rows, ["k"], ["i"], 3, strict=True).count() == 9
    with pytest.raises(Exception, match="fewer than 4 rows"):
        analytics.first_per_group(rows, ["k"], ["i"], 4, strict=True).collect()
    anchors = spark.createDataFrame([(i, i % 4, "ab"[i % 2]) for i in range(12)], "doc_id long, anchor long, stratum string")
    picks = picking.picks_without_reuse(anchors, [("a", 1), ("b", 2), ("a", 1)], "s").collect()
    assert len({r.anchor for r in picks}) == 4
    with pytest.raises(ValueError, match="fewer than 3"):
        picking.picks_without_reuse(anchors, [("a", 3)], "s")


def test_assignment_is_the_best_of_all():
    from itertools import permutations

    rng = np.random.default_rng(1)
    for _ in range(30):
        w = rng.integers(0, 9, (3, 4)).astype(float)
        best = max(sum(w[i, j] for i, j in enumerate(p)) for p in permutations(range(4), 3))
        assert sum(w[i, j] for i, j in folds.best_assignment(w)) == best


def test_assignment_of_many_speakers_is_the_best_of_all():
    three_cycles = np.kron(np.eye(5), np.array([[5, 6, 0], [0, 5, 6], [6, 0, 5]])) + 0.0
    rng = np.random.default_rng(2)
    for w in [three_cycles, *(rng.integers(0, 9, (13, n)).astype(float) for n in (13, 15, 15)), np.array([[9.0] * 14] * 13)]:
        best = {0: 0.0}
        for row in w.T if w.shape[1] > w.shape[0] else w:
            for mask, value in list(best.items()):
                for j in range(len(row)):
                    if not mask >> j & 1:
                        best[mask | 1 << j] = max(best.get(mask | 1 << j, 0.0), value + row[j])
        for x in (w, w.T):
            found = folds.best_assignment(x)
            assert sum(x[i, j] for i, j in found) == max(best.values())
            assert len({i for i, _ in found}) == len({j for _, j in found}) == len(found)


def test_split_takes_the_least_frame_nearest_the_middle():
    assert folds.split_at_minimum(0, np.full(6, 0.9), 3, 0.5) == [(0, 6, False)]


def test_text_grammars():
    assert _forms("Mời AI[ây_ai] <laugh> [happy] nói") == ("Mời ây_ai <laugh> [happy] nói", "Mời AI <laugh> [happy] nói", None)
    assert _forms("9:15[chín_giờ] [neutral].") == ("chín_giờ.", "9:15.", None) and _forms("[neutral] it's a[/ə/]") == ("it's /ə/", "it's a", None)
    errors = {"a[b": "unclosed bracket", "a]": "unmatched closing bracket", "[odd] x": "unsupported standalone bracket", "a[ ]": "empty or nested annotation", "x:AI[ây]": "ambiguous compound word", "<Laugh>": "invalid sound tag", "[neutral]": "empty transcript"}
    assert all(_forms(text)[2].endswith(error) for text, error in errors.items())
    assert _salvage('<think>{"a": 0}</think> x ```json\n{"b": 1}\n```') == '{"b": 1}'
    assert _salvage("none") is None and _salvage('so {"x": {"y": 2}} ok') == '{"x": {"y": 2}}'


def test_text_columns(spark):
    cases = [
        (T.slug(F.lit("Đường phố 1.wav")), "duong_pho_1_wav"), (T.slug(F.lit("")), ""), (T.slug(F.lit("ab " * 30), 10), "ab_ab_ab"),
        (T.square_fillers(F.lit("<uh> [<s>-trét] x<t>")), "[uh] [<s>-trét] x[t]"), (T.unwrap_brackets(F.lit("[/həˈləʊ/] [ây_ai] [Happy] [9]"), ["happy"]), "/həˈləʊ/ ây_ai [Happy] [9]"),
        (T.redacted(F.lit("get https://me:pw@host/x?token=abc&y=1")), "get https://***@host/x?token=***&y=1"), (T.rate_limit(F.lit("1.5G")), 1610612736), (T.rate_limit(F.lit("x")), None),
        (T.transcript(F.lit("Transcript: none")), None), (T.percent_label(F.lit(None).cast("double")), "n/a"), (T.markdown_cell(F.lit("a|b\nc")), "a\\|b c"),
    ]
    got = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(cases)]).first()
    assert list(got) == [want for _, want in cases]


def test_signal_features():
    t = np.arange(16000) / 16000
    tone = np.sin(2 * np.pi * 200 * t)
    assert abs(active_rms(tone) - 2**-0.5) < 0.01 and active_rms(np.zeros(5)) == 1e-9
    assert si_sdr_db(2 * tone[:-5], tone) > 60 and snr_db(np.concatenate([tone, tone * 0.01])) > 30


def test_two_labellings_against_every_instant(spark):
    rng = random.Random(5)

    def label(names):
        return [("r", rng.choice(names), a, a + rng.randint(1, 9)) for a in (rng.randint(0, 60) for _ in range(14))]

    ref, hyp, names = label("abc"), label("xyz"), {"a": "x", "b": "y"}
    frame = lambda rows: spark.createDataFrame(rows, "recording_id string, speaker_id string, start_us long, end_us long")
    mapping = spark.createDataFrame([("r", k, v) for k, v in names.items()], "recording_id string, speaker_id string, mapped_from string")
    want, agreed = dict.fromkeys(("speech_us", "missed_us", "false_us", "confusion_us"), 0), set()
    for t in range(80):
        a, b = ({s for _, s, u, v in rows if u <= t < v} for rows in (ref, hyp))
        right = sum(names.get(s) in b for s in a)
        want["speech_us"] += len(a)
        want["missed_us"] += max(0, len(a) - len(b))
        want["false_us"] += max(0, len(b) - len(a))
        want["confusion_us"] += min(len(a), len(b)) - right
        if len(a) == len(b) == right == 1:
            agreed.add((t, *a))
    got = L.error_rates(frame(ref), frame(hyp), mapping).collect()[0]
    assert {k: got[k] for k in want} == want
    found = L.consensus(frame(ref), frame(hyp), mapping).collect()
    assert {(t, r.speaker_id) for r in found for t in range(r.start_us, r.end_us)} == agreed
    assert L.error_rates(frame([]), frame(hyp), mapping).count() == 0


def test_share_is_taken_exactly_and_by_lowest_hash(spark):
    rows = [(i, f"{i * 7919 % 4096:03x}{i:04x}") for i in range(101)]
    kept = {r.i for r in L.drop_share(spark.createDataFrame(rows, "i long, h string"), "h", 0.25).collect()}
    assert kept == {i for i, _ in sorted(rows, key=lambda r: r[1])[25:]}
    assert L.drop_share(spark.createDataFrame([], "i long, h string"), "h", 0.25).count() == 0


def test_walls_touch_and_are_missing_at_the_ends(spark):
    data = [("r", 0, "a", 0, 5), ("r", 1, "b", 5, 8), ("r", 2, "b", 9, 12), ("r", 3, "a", 12, 20)]
    turns = spark.createDataFrame(data, "recording_id string, turn_index int, speaker_id string, start_us long, end_us long")
    got = {r.turn_index: (r.wall_before_us, r.wall_after_us) for r in L.safe_walls(turns).collect()}
    assert got == {0: (None, 5), 1: (5, 12), 2: (5, 12), 3: (12, None)}


def test_signal_edges_valleys_mixes_and_masks():
    rng = np.random.default_rng(0)
    x = rng.normal(size=800)
    frames = [np.sqrt(np.mean(x[i : i + 40] ** 2)) for i in range(0, 761, 20)]
    assert np.allclose(G.frame_rms(x, 40, 20), frames) and len(G.frame_rms(x[:10], 40, 20)) == 0
    f = G.edge_features(x, 1000)
    assert len(f) == 9 and f["boundary_step_end"] == round(abs(x[-1]) / active_rms(x), 4) and G.edge_features(x[:0], 1000)["min_window_rms_db"] == -100
    quiet = np.concatenate([np.sin(np.arange(300)), 0.001 * np.sin(np.arange(60)), np.sin(np.arange(300))])
    assert 290 < G.local_valley(quiet, 320, 80, 20, 5) < 365 and G.local_valley(quiet, 5, 2, 20, 5) == 5
    assert G.snapped(quiet, 320, 330, (0, 660), 100, 80, 20, 5) == (320, 330)
    pooled = G.pooled(x.reshape(100, 8), 50, 4)
    assert np.allclose(pooled["mean"], x.reshape(100, 8)[:50].mean(0)) and np.allclose(pooled["end"], x.reshape(100, 8)[46:50].mean(0))
    both = G.mixed(x, x[:100], 10.0, 30)
    assert np.abs(both).max() <= 10 ** (-1 / 20) + 1e-9 and len(G.clipped_edge(x, 100, "end")) == 700
    mask = G.speech_mask(50, [(20, 30)], 2, 4)
    assert mask[18:32].min() == 1 and 0 < mask[17] <= 1 and mask[13] == 0 and mask[40] == 0
    with pytest.raises(ValueError):
        G.mixed(x, np.zeros(5), 0.0, 0)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_windows_by_buckets_are_those_of_the_whole(spark, width):
    rng = random.Random(width)
    data = [(rng.choice([None, "a", "b"]), rng.randint(-30, 60), i, rng.choice([None, rng.randint(0, 9)])) for i in range(120)]
    df = spark.createDataFrame(data, "k string, t long, i long, x long")
    got = along(df, ["k"], ["t", "i"], at="t", width=width, n=place(), s=upto_sum("x"), m=before_max("x"), p=previous("x"), f=following("x"), last=latest("x"), ahead=upcoming("x")).collect()
    for key in (None, "a", "b"):
        rows_ = sorted((r for r in got if r.k == key), key=lambda r: (r.t, r.i))
        total, best, last = 0, None, None
        for j, r in enumerate(rows_):
            total, last = total + (r.x or 0), r.x if r.x is not None else last
            assert (r.n, r.s, r.m, r.last) == (j, total, best, last)
            assert r.ahead == next((q.x for q in rows_[j + 1 :] if q.x is not None), None)
            assert r.p == (rows_[j - 1].x if j else None) and r.f == (rows_[j + 1].x if j + 1 < len(rows_) else None)
            best = max((v for v in (best, r.x) if v is not None), default=None)


def test_cuts_at_word_gaps():
    gaps = planning.gaps_between([(0, 5, False), (1, 9, True), (12, 20, False), (21, 30, True)], 2)
    assert gaps == [(9, 12, True)]
    assert planning.cut_at_gaps(0, 30, gaps, 2, 20, 0) == ([(0, 10), (10, 30)], None)
    assert planning.cut_at_gaps(0, 60, gaps, 2, 20, 0) == ([(0, 10), (10, 12)], "no_supported_word_gap")
    assert planning.cut_at_gaps(0, 1, [], 2, 20, 0) == ([], "below_min_duration")


def test_planned_pieces_join_towards_the_target():
    assert planning.plan_pieces(0, 30, [(4, True), (8, True), (20, False)], (7, 10), (2, 15)) == [(0, 8, None), (8, 20, None), (20, 30, None)]
    assert planning.plan_pieces(0, 9, [(8, True)], (3, 5), (2, 9)) == [(0, 9, None)]
    assert planning.plan_pieces(0, 40, [], (7, 10), (2, 15)) == [(0, 40, "no_pause_within_limit")]


def test_gap_walk_stops():
    stats = {g: (10, 10 * m) for g, m in ((0, 2), (1, 4), (2, 6), (3, 12))}
    walk = lambda first, target, widest=3: planning.walk_gaps(stats, first, 1, widest, target, 9)
    assert walk(0, (5, 8)) == (2, "target_reached") and walk(3, (1, 3)) == (0, "target_reached")
    assert walk(1, (20, 30)) == (3, "gap_upper_bound_reached") and walk(1, (0, 1)) == (0, "gap_lower_bound_reached")
    assert walk(2, (8, 9)) == (2, "gap_adjustment_oscillated") and planning.walk_gaps({}, 1, 1, 3, (1, 2), 9) == (1, "no_valid_clips")


def test_local_speakers_match_once_or_not():
    assert planning.match_with_none(np.array([[5.0, 4.0], [5.0, 0.0]])) == [1, 0]
    assert planning.match_with_none(np.array([[0.0], [0.0]])) == [None, None]


def test_packed_batches_keep_both_limits(spark):
    rng = random.Random(4)
    data = [(f"s{i % 3}", i, rng.randint(1, 9)) for i in range(80)]
    got = sorted(map(tuple, picking.packed(spark.createDataFrame(data, "source string, doc_id long, bytes long"), "source", "doc_id", 12, 4).collect()))
    size = {d: b for _, d, b in data}
    for s in ("s0", "s1", "s2"):
        batches = {}
        for source, d, b in got:
            if source == s:
                batches.setdefault(b, []).append(d)
        assert [d for b in sorted(batches) for d in batches[b]] == sorted(d for x, d, _ in data if x == s)
        assert all(sum(size[d] for d in ds) <= 12 and len(ds) <= 4 for ds in batches.values())


def test_strict_turns_raise(spark):
    turns = spark.createDataFrame([("r", "a", 5, 5)], "recording_id string, speaker_id string, start_us long, end_us long")
    with pytest.raises(Exception, match="turn: empty"):
        picking.strict(turns, 100).collect()


def test_windows_on_a_stream(spark, tmp_path):
    from spanloom.streaming import windows as W

    rows_ = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS ts, id % 3 AS user_id, 'view' AS event_type, id * 1.0D AS value FROM range(0, 900, 7)")
    rows_.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows_.schema).parquet(str(tmp_path / "in"))
    for name, build in (("windows", W.window_counts), ("sessions", W.sessions)):
        # at the end of the stream nothing late is missing but what the watermark still holds: complete output for windows
        query = build(stream).writeStream.format("memory").queryName(name).outputMode("complete" if name == "windows" else "append").trigger(availableNow=True).start()
        query.awaitTermination(120)
        if name == "windows":
            want = {tuple(r) for r in build(rows_).collect()}
            assert {tuple(r) for r in spark.table(name).collect()} == want
