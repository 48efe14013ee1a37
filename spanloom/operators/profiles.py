"""Speakers carried over windows: each window's local speakers are matched with the profiles of those before, and each match
moves the profile that the next window is matched with.

That is sequential within a recording, so a recording is read in order as a stream: a task holds one window and the
profiles, never a recording's windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from spanloom.operators.planning import match_with_none


class Profiles:
    """Profiles of one recording: unit centroids (the first one as it came) and how many embeddings they stand for."""

    def __init__(self, gate: float) -> None:
        self.gate, self.centroids, self.seen = gate, [], []

    def match(self, embeddings: list[np.ndarray]) -> list[tuple[int, float | None]]:
        """(global speaker, score) of each embedding of a window, one to one, of the largest total cosine; only cosines of
        `gate` or more (and over 0) match. Without a match a speaker is new, and has no score."""
        if self.centroids and embeddings:
            now, known = np.stack(embeddings), np.stack(self.centroids)
            norms = np.linalg.norm(now, axis=1)[:, None] * np.linalg.norm(known, axis=1)[None]
            scores = np.divide(now @ known.T, norms, out=np.zeros(norms.shape), where=norms > 0)
            scores = np.where(scores >= self.gate, scores, 0.0)
            found = match_with_none(scores)
        else:
            scores, found = None, [None] * len(embeddings)
        out, fresh = [], len(self.centroids)
        for i, g in enumerate(found):
            out.append((fresh, None) if g is None else (g, float(scores[i, g])))
            fresh += g is None
        for (g, _), e in zip(out, embeddings, strict=True):
            self._move(g, e)
        return out

    def _move(self, g: int, e: np.ndarray) -> None:
        if g == len(self.centroids):
            self.centroids.append(e.copy())
            self.seen.append(1)
            return
        both = self.centroids[g] * self.seen[g] + e
        norm = np.linalg.norm(both)
        if norm > 0:
            self.centroids[g], self.seen[g] = both / norm, self.seen[g] + 1


def carry_speakers(windows: DataFrame, gate: float) -> DataFrame:
    """(recording_id, window, local, global, score) from (recording_id, window, local, embedding): windows of a recording in
    order, their local speakers in order. Embeddings of a recording must have one length; a null one is left out."""
    kinds = dict(windows.dtypes)

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, profiles, held = None, None, []

        def settled() -> list[tuple]:
            found = profiles.match([e for _, e in held])
            return [(*at, local, g, s) for (local, _), (g, s) in zip(held, found, strict=True)]

        def frame(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["recording_id", "window", "local", "global", "score"]).astype({"score": "Float64"})

        for batch in batches:
            out = []
            for recording, window, local, embedding in zip(batch["recording_id"], batch["window"], batch["local"], batch["embedding"], strict=True):
                if at != (recording, window):
                    if held:
                        out += settled()
                    if at is None or at[0] != recording:
                        profiles = Profiles(gate)
                    at, held = (recording, window), []
                held.append((local, np.asarray(embedding, dtype=np.float64)))
            yield frame(out)
        if held:
            yield frame(settled())

    rows = windows.select("recording_id", "window", "local", "embedding").where("recording_id IS NOT NULL AND embedding IS NOT NULL")
    dealt = rows.repartition("recording_id").sortWithinPartitions("recording_id", "window", "local")
    return dealt.mapInPandas(carry, f"recording_id {kinds['recording_id']}, window {kinds['window']}, local {kinds['local']}, global int, score double")
