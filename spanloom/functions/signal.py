"""Features of sample arrays as pandas functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def active_rms(x: np.ndarray) -> float:
    """RMS of the samples within 45 dB of the peak; 1e-9 for silence."""
    x = np.asarray(x, float)
    peak = np.abs(x).max(initial=0.0)
    loud = x[np.abs(x) >= peak * 10 ** (-45 / 20)] if peak else x[:0]
    return max(float(np.sqrt((loud**2).mean())), 1e-9) if len(loud) else 1e-9


def si_sdr_db(estimate: np.ndarray, reference: np.ndarray) -> float:
    """Scale-invariant signal-to-distortion ratio, both without their mean and as long as the shorter."""
    n = min(len(estimate), len(reference))
    if not n:
        return 0.0
    e, r = (np.asarray(v, float)[:n] - np.mean(v[:n]) for v in (estimate, reference))
    target = (e @ r) / max(r @ r, 1e-12) * r
    return float(10 * np.log10(max(target @ target, 1e-12) / max((e - target) @ (e - target), 1e-12)))


def snr_db(x: np.ndarray, frame: int = 320) -> float:
    """95th against 5th percentile of the frames' energy."""
    x = np.asarray(x, float)
    n = len(x) // frame
    if not n:
        return 0.0
    energy = (x[: n * frame].reshape(n, frame) ** 2).mean(1) + 1e-12
    return float(10 * np.log10(np.percentile(energy, 95) / np.percentile(energy, 5)))


def frame_rms(x: np.ndarray, frame: int, hop: int) -> np.ndarray:
    """RMS of whole frames."""
    x = np.asarray(x, float)
    if len(x) < frame:
        return np.zeros(0)
    power = np.concatenate([[0.0], np.cumsum(x**2)])
    at = np.arange(0, len(x) - frame + 1, hop)
    return np.sqrt(np.maximum(power[at + frame] - power[at], 0) / frame)


def level_db(rms: np.ndarray | float, floor: float = 1e-6) -> np.ndarray:
    return 20 * np.log10(np.maximum(rms, floor))


def edge_features(x: np.ndarray, rate: int) -> dict[str, float]:
    """Nine features of a clip: RMS of its first and last 10 and 20 ms and its first and last sample, in parts of the active
    RMS; spread of the 20 ms envelope; least level of 50 ms windows; variance of 250 ms windows."""
    x, ms = np.asarray(x, float), lambda n: max(1, round(n * rate / 1000))
    names = ["end_edge_ratio_10ms", "end_edge_ratio_20ms", "start_edge_ratio_10ms", "start_edge_ratio_20ms", "boundary_step_end", "boundary_step_start"]
    if not len(x):
        return dict.fromkeys(names, 0.0) | {"snr_envelope_db": 0.0, "min_window_rms_db": -100.0, "window_rms_var": 0.0}
    active = active_rms(x)
    rms = lambda v: float(np.sqrt(np.mean(v**2)))
    edges = [rms(x[-ms(10) :]), rms(x[-ms(20) :]), rms(x[: ms(10)]), rms(x[: ms(20)]), abs(float(x[-1])), abs(float(x[0]))]
    out = {n: round(v / active, 4) for n, v in zip(names, edges, strict=True)}
    frame = ms(20)
    envelope = level_db(frame_rms(np.pad(x, (frame // 2, frame - frame // 2 - 1)), frame, ms(10))) if len(x) >= frame else np.zeros(1)
    short, long = frame_rms(x, ms(50), ms(25)), frame_rms(x, ms(250), ms(125))
    return out | {
        "snr_envelope_db": round(float(np.percentile(envelope, 99) - np.percentile(envelope, 5)), 2),
        "min_window_rms_db": round(float(level_db(short.min())), 2) if len(short) else -100.0,
        "window_rms_var": round(float(np.var(long / active)), 6) if len(long) else 0.0,
    }


def local_valley(x: np.ndarray, at: int, reach: int, frame: int, hop: int, crossing: int = 20) -> int:
    """The quietest frame within reach of a sample, far ones at a small penalty, moved to the first zero crossing near its
    middle; the sample itself if no frame fits."""
    x = np.asarray(x, float)
    low, high = max(0, at - reach), min(len(x), at + reach)
    energy = np.sqrt(frame_rms(x[low:high], frame, hop) ** 2 + 1e-12)
    if not len(energy):
        return at
    away = np.arange(len(energy)) - (at - low) / hop
    best = low + int(np.argmin(energy + 0.005 * np.median(energy) * away**2)) * hop + frame // 2
    near = max(0, best - crossing)
    signs = np.signbit(x[near : best + crossing])
    turns = np.flatnonzero(signs[1:] != signs[:-1])
    return near + int(turns[0]) if len(turns) else best


def snapped(x: np.ndarray, start: int, end: int, walls: tuple[int, int], least: int, reach: int, frame: int, hop: int) -> tuple[int, int]:
    """Bounds moved to quiet places, kept between the walls; as they were if that leaves less than `least`."""
    a, b = (min(max(local_valley(x, p, reach, frame, hop), walls[0]), walls[1]) for p in (start, end))
    return (a, b) if b - a >= least else (start, end)


def pooled(frames: np.ndarray, valid: int, edge: int) -> dict[str, np.ndarray]:
    """Mean, spread, and means of the first and last `edge` frames of the valid ones (at least one)."""
    x = np.asarray(frames, float)[: max(1, valid)]
    k = max(1, min(len(x), edge))
    return {"mean": x.mean(0), "std": x.std(0), "start": x[:k].mean(0), "end": x[-k:].mean(0)}


def mixed(speech: np.ndarray, music: np.ndarray, ratio_db: float, begin: int, ceiling_db: float = -1.0) -> np.ndarray:
    """Speech with music (from sample `begin`, wrapped around) at a ratio of their RMS, scaled down to the ceiling."""
    speech, bed = np.asarray(speech, float), np.take(np.asarray(music, float), np.arange(begin, begin + len(speech)), mode="wrap")
    levels = [float(np.sqrt(np.mean(v**2))) for v in (speech, bed)]
    if min(levels) <= 1e-9:
        raise ValueError("silence can't be mixed at a ratio")
    both = speech + bed * levels[0] / (levels[1] * 10 ** (ratio_db / 20))
    return both * min(1.0, 10 ** (ceiling_db / 20) / max(float(np.abs(both).max()), 1e-12))


def clipped_edge(x: np.ndarray, samples: int, side: str) -> np.ndarray:
    """A clip that lost samples at its start or end."""
    x = np.asarray(x, float)
    return x[samples:] if side == "start" else x[: max(0, len(x) - samples)]


def speech_mask(n: int, spans: list[tuple[int, int]], pad: int, fade: int) -> np.ndarray:
    """1 within the padded spans, 0 elsewhere, with raised-cosine fades outside of them; overlapping fades take the larger."""
    mask = np.zeros(n)
    for a, b in spans:
        mask[max(0, a - pad) : max(0, min(n, b + pad))] = 1.0
    if fade:
        ramp = 0.5 - 0.5 * np.cos(np.linspace(0, np.pi, fade)) if fade > 1 else np.ones(1)
        hard = np.pad(mask, (1, 1))
        for s in np.flatnonzero(np.diff(hard) == 1):
            k = min(fade, s)
            mask[s - k : s] = np.maximum(mask[s - k : s], ramp[fade - k :])
        for e in np.flatnonzero(np.diff(hard) == -1):
            k = min(fade, n - e)
            mask[e : e + k] = np.maximum(mask[e : e + k], ramp[:k][::-1])
    return mask


def edge_features_of(samples: Column, rate: int) -> Column:
    kinds = ", ".join(f"{n} double" for n in edge_features(np.zeros(0), rate))
    return F.pandas_udf(lambda s: pd.DataFrame([edge_features(x, rate) for x in s]), kinds)(samples)


def frame_rms_of(samples: Column, frame: int, hop: int) -> Column:
    return F.pandas_udf(lambda s: pd.Series([frame_rms(x, frame, hop).tolist() for x in s]), "array<double>")(samples)


def snapped_of(samples: Column, start: Column, end: Column, least: int, reach: int, frame: int, hop: int) -> Column:
    def snap(xs: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([snapped(x, i, j, (0, len(x)), least, reach, frame, hop) for x, i, j in zip(xs, a, b, strict=True)], columns=["start", "end"])

    return F.pandas_udf(snap, "start long, end long")(samples, start, end)


def _of(f):
    return lambda samples: F.pandas_udf(lambda s: pd.Series([f(x) for x in s], dtype="float64"), "double")(samples)


def active_rms_of(samples: Column) -> Column:
    return _of(active_rms)(samples)


def snr_db_of(samples: Column) -> Column:
    return _of(snr_db)(samples)


def gain(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def dbfs(rms: Column) -> Column:
    return 20 * F.log10(F.greatest(rms, F.lit(1e-12)))
