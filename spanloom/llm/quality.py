"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features, and those of the lines before and after it, give the evidence for good; a
2 x 2 table of transitions couples neighbours. Forward-backward gives each line's marginal; the marginals, weighted by
line length, average to a raw score, which a logistic curve turns into the probability of label 1.

The model is fitted on the driver on a bounded sample of labelled documents (SAMPLE of them, the lowest by hash, texts
up to TEXT_BYTES each, as many as SAMPLE_BYTES hold together); a document's label stands for all its lines. Scoring reads
every whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm._common import bounded_batches, documents

#: Most labelled documents, most bytes of each, and most bytes of all, that the model is fitted on; a line counts for so
#: many bytes more.
SAMPLE, TEXT_BYTES, SAMPLE_BYTES, LINE_BYTES = 4000, 200_000, 24_000_000, 50

#: Score from which a document is accepted.
ACCEPT = 0.3

ROUNDS, RATE, SHRINK = 250, 0.1, 1e-3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "end": b".?",
    "comma": b",;:",
    "exclaim": b"!",
    "symbol": b"#$%&*+=@^~|<>{}[]\\/_",
    "quote": b"\"'()-`",
    "space": b" \t\r\x0b\x0c",
}
_TABLE = np.full(256, len(_CLASSES), dtype=np.uint8)
for _i, _chars in enumerate(_CLASSES.values()):
    _TABLE[np.frombuffer(_chars, np.uint8)] = _i
_OWN = len(_CLASSES) + 6


#: Bytes of a text whose lines are looked at together.
CHUNK = 1 << 16


def _lines(data: bytes) -> Iterator[list[bytes]]:
    """The lines of a text, CHUNK bytes of them (or a longer single line) at a time."""
    at = 0
    while at <= len(data):
        end = data.find(b"\n", at + CHUNK)
        end = len(data) if end < 0 else end
        yield data[at:end].split(b"\n")
        at = end + 1


def _own(lines: list[bytes], repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line alone, its weight); repeated: sorted hashes of lines that occur more than once."""
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    code = _TABLE[np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)]
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    own = np.zeros((len(lines), _OWN))
    size = np.maximum(length, 1)
    for i in range(len(_CLASSES) + 1):
        own[:, i] = np.add.reduceat((code == i).astype(np.int64), start) / size
    own[:, len(_CLASSES)] -= 1 / size  # the line end itself
    letters = np.maximum(own[:, 0] + own[:, 1] + own[:, len(_CLASSES)], 1e-9)
    own[:, -5] = own[:, 0] / letters
    own[:, -4] = np.log1p(length) / 6
    own[:, -3] = np.isin(np.fromiter(map(hash, lines), np.int64, len(lines)), repeated) & (length > 0)
    for i, line in enumerate(lines):
        words = line.split()
        if words:
            own[i, -2] = len(set(words)) / len(words)
            own[i, -1] = min(3.0, (length[i] / len(words)) / 6)
    return own, size.astype(float)


def features_by_chunk(text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features of each line with those of its neighbours, weight of each line) of some lines after the others."""
    data = (text or "").encode("utf-8", "surrogatepass")
    hashes = np.sort(np.concatenate([np.fromiter(map(hash, lines), np.int64, len(lines)) for lines in _lines(data)]))
    repeated = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])
    del hashes
    edge = np.zeros((1, _OWN))
    before, held = edge, None

    def near(own: np.ndarray, after: np.ndarray) -> np.ndarray:
        return np.hstack([own, np.vstack([before, own[:-1]]), np.vstack([own[1:], after]), np.ones((len(own), 1))])

    for lines in _lines(data):
        now = _own(lines, repeated)
        if held:
            yield near(held[0], now[0][:1]), held[1]
            before = held[0][-1:]
        held = now
    yield near(held[0], edge), held[1]


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """features_by_chunk() of a whole text at once."""
    x, weight = zip(*features_by_chunk(text), strict=True)
    return np.concatenate(x), np.concatenate(weight)


@dataclass
class LineField:
    """Weights of the field: the evidence x @ weights for good, transitions[from, to], and the curve of the score."""

    weights: np.ndarray
    transitions: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good of each line by its features alone."""
        return np.clip(x @ self.weights, -30, 30)

    def marginals(self, evidence: np.ndarray) -> np.ndarray:
        """Probability that each line of one document is good. Two numbers a line are held."""
        (a, b), (c, d) = np.exp(self.transitions).tolist()
        out, p = np.empty(len(evidence)), None
        steps = range(0, len(evidence), CHUNK)
        for at in steps:
            part = []
            for odds in np.exp(evidence[at : at + CHUNK]).tolist():
                if p is None:
                    p = odds / (1 + odds)
                else:
                    bad, good = (1 - p) * a + p * c, ((1 - p) * b + p * d) * odds
                    p = good / (good + bad)
                part.append(p)
            out[at : at + CHUNK] = part
        u = v = 1.0
        for at in reversed(steps):
            part = []
            for odds, ahead in zip(np.exp(evidence[at : at + CHUNK])[::-1].tolist(), out[at : at + CHUNK][::-1].tolist(), strict=True):
                good, bad = ahead * v, (1 - ahead) * u
                part.append(good / (good + bad))
                w = v * odds
                u, v = a * u + b * w, c * u + d * w
                s = u + v
                u, v = u / s, v / s
            out[at : at + CHUNK] = part[::-1]
        return out

    def raw(self, text: str | None) -> float:
        evidence, weight = zip(*((self.evidence(x), w.astype(np.uint32)) for x, w in features_by_chunk(text)), strict=True)
        evidence, weight = np.concatenate(evidence), np.concatenate(weight)
        return float(self.marginals(evidence) @ weight / weight.sum(dtype=np.float64))

    def score(self, text: str | None) -> float:
        return _curve(self.raw(text), self.slope, self.offset)


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def _curve(raw: float, slope: float, offset: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * _logit(raw) + offset))))


def fit_field(texts: list[str | None], labels: list[int]) -> LineField:
    """Maximum likelihood by gradient steps over all documents at once, then the curve by Newton steps. Without
    texts of both labels nothing can be told apart: then every score is the share of label 1 (0.5 without any)."""
    pairs = [(line_features(t)[0], y) for t, y in zip(texts, labels, strict=True)]
    width = 3 * _OWN + 1
    share = (sum(labels) + 1) / (len(labels) + 2)
    if len(set(labels)) < 2:
        return LineField(np.zeros(width), np.zeros((2, 2)), 0.0, _logit(share))
    pairs.sort(key=lambda p: -len(p[0]))
    x = np.concatenate([p[0] for p in pairs])
    mean, spread = x.mean(0), x.std(0)
    mean[-1], spread[spread < 1e-9] = 0.0, 1.0
    x = (x - mean) / spread
    n, y = np.array([len(p[0]) for p in pairs]), np.array([p[1] for p in pairs], float)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    active = [int((n > t).sum()) for t in range(n[0])]
    at = [first[:k] + t for t, k in enumerate(active)]
    w, trans = np.zeros(width), np.zeros((2, 2))
    moment = [np.zeros(width + 4), np.zeros(width + 4)]
    good = np.repeat(y, n)
    for step in range(1, ROUNDS + 1):
        e = np.clip(x @ w, -30, 30)
        odds, move = np.exp(e), np.exp(trans)
        p = np.zeros(len(e))
        p[at[0]] = odds[at[0]] / (1 + odds[at[0]])
        for t in range(1, len(at)):
            before = p[at[t] - 1]
            bad, fine = (1 - before) * move[0, 0] + before * move[1, 0], ((1 - before) * move[0, 1] + before * move[1, 1]) * odds[at[t]]
            p[at[t]] = fine / (fine + bad)
        post, pair = np.zeros(len(e)), np.zeros((2, 2))
        u, v = np.ones(len(n)), np.ones(len(n))
        for t in range(len(at) - 1, -1, -1):
            i, k = at[t], active[t]
            fine, bad = p[i] * v[:k], (1 - p[i]) * u[:k]
            post[i] = fine / (fine + bad)
            right = v[:k] * odds[i]
            if t:
                before = p[i - 1]
                cell = np.stack([(1 - before) * move[0, 0] * u[:k], (1 - before) * move[0, 1] * right, before * move[1, 0] * u[:k], before * move[1, 1] * right])
                pair += (cell / cell.sum(0)).sum(1).reshape(2, 2)
            u[:k], v[:k] = move[0, 0] * u[:k] + move[0, 1] * right, move[1, 0] * u[:k] + move[1, 1] * right
            s = u[:k] + v[:k]
            u[:k], v[:k] = u[:k] / s, v[:k] / s
        seen = np.diag([((n - 1) * (1 - y)).sum(), ((n - 1) * y).sum()])
        grad = np.concatenate([x.T @ (good - post), (seen - pair).ravel()]) / len(n) - SHRINK * np.concatenate([w, trans.ravel()])
        moment = [0.9 * moment[0] + 0.1 * grad, 0.999 * moment[1] + 0.001 * grad**2]
        move_by = RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8)
        w, trans = w + move_by[:width], trans + move_by[width:].reshape(2, 2)
    w = w / spread
    w[-1] -= mean @ w
    field = LineField(w, trans)
    raw = np.array([_logit(field.raw(t)) for t in texts])
    design, target, beta = np.stack([raw, np.ones_like(raw)], 1), np.array(labels, float), np.array([0.2, 0.0])
    for _ in range(20):
        q = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        beta = beta + np.linalg.solve(design.T @ (design * (q * (1 - q))[:, None]) + 0.5 * np.eye(2), design.T @ (target - q) - 0.5 * beta)
    field.slope, field.offset = max(0.0, float(beta[0])), float(beta[1])
    return field


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from the fit; a null doc_id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineField:
    """Fits the field on at most `sample` labelled documents that aren't held out. Of labels for one document that
    contradict each other the lower counts; labels other than 0 and 1 are ignored. Of different texts of one doc_id that
    of the lowest hash counts."""
    known = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text)
    cost = size + LINE_BYTES * (size - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    texts = docs.select("doc_id", "text").where(size <= TEXT_BYTES).join(F.broadcast(known), "doc_id").withColumn("_hash", F.xxhash64("text"))
    # sizes first: `sample` rows without a text
    one = texts.groupBy("doc_id", "quality").agg(F.min(F.struct("_hash", cost.cast("long").alias("cost"))).alias("_one")).select("doc_id", "_one.*")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    chosen = one.withColumn("_upto", F.sum("cost").over(order)).where(F.col("_upto") <= SAMPLE_BYTES).select("doc_id", "_hash")
    rows = texts.join(F.broadcast(chosen), ["doc_id", "_hash"]).dropDuplicates(["doc_id"]).select("doc_id", "quality", "text").collect()
    rows.sort(key=lambda r: r.doc_id)
    return fit_field([r.text for r in rows], [r.quality for r in rows])


def score(text: Column, field: LineField) -> Column:
    """Score from 0 to 1, of null and empty texts too."""

    @F.pandas_udf("double")
    def line_field(texts: pd.Series) -> pd.Series:
        return pd.Series([field.score(t) for t in texts], dtype="float64")

    return line_field(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs; a null text scores like an empty one.

    Equal texts have equal scores, whatever their other columns; repeated rows each get a row. A text of any length is
    scored whole. Other columns are ignored."""
    bounded_batches(docs.sparkSession)
    field = train(docs, labels)
    rows = docs.select("doc_id", held_out().alias("held_out"), score(F.col("text"), field).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, as they are, with all their columns; repeated rows stay."""
    bounded_batches(docs.sparkSession)
    return docs.where(score(F.col("text"), train(docs, labels)) >= ACCEPT)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
