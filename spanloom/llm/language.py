"""Language of a text by rank-order profiles of its most frequent n-grams.

A profile is the list of the PROFILE most frequent letter n-grams (one to three letters, word edges included), most
frequent first. A document's own profile is compared with each language's by out-of-place distance: for each of its
n-grams the difference of ranks, or PROFILE where the language hasn't the n-gram.

Profiles are counted on a bounded sample: of each language about SAMPLE documents, the lowest by hash. Predictions read
every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm._common import bounded_batches, documents

#: n-grams of a profile; documents of each language that it is counted on; letters that are counted at a time.
PROFILE, SAMPLE, CHUNK = 300, 2000, 1 << 20

#: Code of a word edge; no letter has it.
EDGE = 1

UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as packed code points, their counts) of one text, in order of n-gram; a run of other characters than
    letters is one word edge, and so are both ends of the text. A long text is counted by chunks, each with the two codes
    before it, so that the counts are those of the whole."""
    grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lower = (text or "").lower()
    before = np.array([EDGE], dtype=np.int64)
    for at in range(0, len(lower), CHUNK):
        codes = np.frombuffer(lower[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        codes = np.where(_letters()[codes], codes, EDGE)
        codes = np.concatenate([before, codes, [EDGE] if at + CHUNK >= len(lower) else []]).astype(np.int64)
        codes = codes[np.concatenate([[True], (codes[1:] != EDGE) | (codes[:-1] != EDGE)])]
        k = len(before)
        singles = codes[k:][codes[k:] != EDGE]
        pairs = (codes[:-1] << 21 | codes[1:])[k - 1 :]
        triples = (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[codes[1:-1] != EDGE] if k == 1 else (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[k - 2 :][codes[k - 1 : -1] != EDGE]
        before = codes[-2:]
        found, n = np.unique(np.concatenate([singles, pairs, triples]), return_counts=True)
        if len(grams):
            both, back = np.unique(np.concatenate([grams, found]), return_inverse=True)
            found, n = both, np.bincount(back, np.concatenate([counts, n])).astype(np.int64)
        grams, counts = found, n
    return grams, counts


def profile(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, ties by n-gram."""
    return grams[np.lexsort((grams, -counts))[:size]]


class Profiles:
    """The languages' profiles, with the distance to them."""

    def __init__(self, ranked: dict[str, list[int]], size: int = PROFILE) -> None:
        self.size = size
        self.names = sorted(ranked)
        self.grams, self.ranks = [], []
        for name in self.names:
            grams = np.array(ranked[name], dtype=np.int64)
            order = np.argsort(grams)
            self.grams.append(grams[order])
            self.ranks.append(order)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): score is 1 less the distance in parts of the largest possible one."""
        own = profile(*gram_counts(text), self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        place = np.arange(len(own))
        distances = []
        for grams, ranks in zip(self.grams, self.ranks, strict=True):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            distances.append(int(np.where(grams[at] == own, np.minimum(np.abs(ranks[at] - place), self.size), self.size).sum()))
        best = int(np.argmin(distances))
        return self.names[best], 1 - distances[best] / (self.size * len(own))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null doc_id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def learn(docs: DataFrame, sample: int = SAMPLE) -> Profiles:
    """Profiles of the languages of docs, from documents with a lang that aren't held out."""
    known = docs.where(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "lang", "text")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Profiles({})
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, sample / n)))])
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found = [gram_counts(t) for t in texts]
                grams, back = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                n = np.bincount(back, np.concatenate([c for _, c in found]), minlength=len(grams)).astype(np.int64)
                yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})

    counts = drawn.select("lang", "text").mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ranked: dict[str, list[int]] = {lang: [] for lang in sizes}
    for r in counts.withColumn("rank", rank).where(F.col("rank") <= PROFILE).orderBy("lang", "rank").collect():
        ranked[r.lang].append(r.gram)
    return Profiles({lang: grams for lang, grams in ranked.items() if grams})


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs; `und` with score 0 where a text is null or has no
    letter, or where no language could be learned. Equal distances go to the first language by name.

    Repeated rows each get a row and count each time; a text of any length is counted whole; other columns than doc_id,
    lang and text are ignored. The profiles, PROFILE n-grams a language, are held by the driver and every task."""
    bounded_batches(docs.sparkSession)
    profiles = learn(docs)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang_pred", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), predict("text").alias("_p"))
    return rows.select("doc_id", "held_out", "_p.*")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
