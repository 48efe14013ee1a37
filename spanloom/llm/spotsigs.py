"""SpotSigs: a text's fingerprint is the set of chains of content words that follow its common words.

Each common word (anchor) with the next CHAIN content words after it is a signature. Two texts are alike as their sets
are (Jaccard). A pair can only reach a likeness t if the smaller set has t times the size of the larger one; so sets are
partitioned by length, only partitions next to each other are compared, and within them only pairs that share one of
the signatures of their prefixes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm._common import bounded_batches, documents, materialise

#: Content words of a chain.
CHAIN = 2

#: Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    "a an the of and to in is was are be it that this with for as on by at from or not he she they we you his her their "
    "der die das den dem des ein eine einer und zu von mit auf für ist im in nicht sich auch als an es "
    "le la les l un une du de et à en est que qui dans pour sur par pas au aux ce elle il "
    "el los las una y del con por para se su al lo como más o".split()
)

_WORD = re.compile(r"\w+")


def spots(text: str | None) -> np.ndarray:
    """The signatures of one text as sorted hashes. A text without any chain has its words instead."""
    anchors: list[tuple[str, int]] = []
    content: list[str] = []
    for word in _WORD.findall((text or "").lower()):
        if word in ANCHORS:
            anchors.append((word, len(content)))
        else:
            content.append(word)
    last = len(content) - CHAIN
    chains = {f"{word} {' '.join(content[at : at + CHAIN])}" for word, at in anchors if at <= last}
    chains = chains or {f" {w}" for w in content} or {w for w, _ in anchors} or ({text} if text else set())
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(c.encode("utf-8", "surrogatepass")) for c in chains), np.uint64, len(chains)))


def digest(sigs: np.ndarray) -> str:
    """The set as one string: its size and a hash of its members."""
    return f"{len(sigs):x}-{xxhash.xxh128_hexdigest(sigs.astype('<u8').tobytes())}"


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sets; 0 where their sizes alone show that it is under `least`. Two empty sets are alike."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _length_partition(n, least: float):
    return F.floor(F.log(n.cast("double")) / -np.log(least)).cast("int")


def near_pairs(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, likeness): pairs of fingerprints (digests) of likeness `least` or more, between different sets; docs with
    equal sets share their fingerprint (see fingerprints()).

    A set's prefix are its rarest signatures, so many that two sets of enough likeness share one: common signatures bring
    no candidates together. Sets meet by (signature, length partition) as ids and sizes; only candidates whose sizes
    allow the likeness meet their signatures.
    """
    sets = fingerprints(docs).where("n_signatures > 0").groupBy("fingerprint").agg(F.first("signatures").alias("s"), F.first("n_signatures").alias("n"))
    sets = materialise(sets, "sets")
    each = sets.select("fingerprint", "n", F.explode("s").alias("sig"))
    rare = each.join(each.groupBy("sig").agg(F.count("*").alias("_times")), "sig")
    rank = F.row_number().over(Window.partitionBy("fingerprint").orderBy("_times", "sig"))
    prefix = F.col("n") - F.ceil(F.round(F.col("n") * F.lit(least), 9)) + 1
    keyed = rare.withColumn("_rank", rank).where(F.col("_rank") <= prefix).select("fingerprint", "n", "sig", _length_partition(F.col("n"), least).alias("part"))
    keyed = materialise(keyed, "prefixes")
    other = keyed.select(F.col("fingerprint").alias("b"), F.col("n").alias("nb"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    smaller = (F.col("nb") < F.col("n")) | ((F.col("nb") == F.col("n")) & (F.col("b") < F.col("fingerprint")))
    pairs = keyed.join(other, ["sig", "part"]).where(smaller & (F.col("nb") >= F.round(F.col("n") * F.lit(least), 9)))
    pairs = pairs.select(F.col("fingerprint").alias("a"), "b").distinct()
    texts = pairs.join(sets.select(F.col("fingerprint").alias("a"), "s"), "a").join(sets.select(F.col("fingerprint").alias("b"), F.col("s").alias("sb")), "b")
    both = F.size(F.array_intersect("s", "sb"))
    return texts.withColumn("likeness", both / (F.size("s") + F.size("sb") - both)).where(F.col("likeness") >= least).select("a", "b", "likeness")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, n_signatures and signatures (sorted) of every row."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("fingerprint string, signatures array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        found = [spots(t) for t in texts]
        return pd.DataFrame({"fingerprint": [digest(s) for s in found], "signatures": [s.view(np.int64) for s in found]})

    rows = docs.select("doc_id", of("text").alias("_f")).select("doc_id", "_f.*")
    return rows.select("doc_id", "fingerprint", F.size("signatures").alias("n_signatures"), F.array_sort("signatures").alias("signatures"))


def with_next(docs: DataFrame) -> DataFrame:
    """(part, look, doc, doc_id, text): every document in its range of doc_id, in order; a range ends with the first
    document of the next one (look 1), the last range with the first document of all (look 2).

    So a single shuffle brings every document next to the one that follows it, and ranges are read as streams.
    """
    keyed = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts = keyed.select("doc").distinct().repartitionByRange(ranges, "doc").groupBy(F.spark_partition_id()).agg(F.min("doc").alias("doc"))
    bounds = np.array(sorted(r.doc for r in firsts.collect()), dtype=np.int64)

    @F.pandas_udf("array<struct<part:int,look:int>>")
    def places(doc: pd.Series) -> pd.Series:
        part = np.searchsorted(bounds, doc.to_numpy(np.int64), side="right") - 1
        out = []
        for d, p in zip(doc, part, strict=True):
            place = [{"part": p, "look": 0}]
            if d == bounds[p]:
                place += [{"part": p - 1, "look": 1}] if p else [{"part": len(bounds) - 1, "look": 2}]
            out.append(place)
        return pd.Series(out)

    dealt = keyed.withColumn("_at", F.explode(places("doc"))).select("_at.*", "doc", "doc_id", "text")
    return dealt.repartitionById(ranges, "part").sortWithinPartitions("part", "look", "doc", "text")


def compare_edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row, and the sets
    that the fingerprints stand for, signatures and edited_signatures (sorted hashes): near_edited is their Jaccard
    likeness.

    The edited text is the document with the last quarter of its characters replaced by as many first ones of the next
    document by doc_id. A null text counts as empty. A null doc_id comes first; rows of one doc_id follow each other by
    text. A single document is its own next. A text of any length counts whole; other columns are ignored.
    """
    import hashlib

    bounded_batches(docs.sparkSession)
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "signatures", "edited_signatures"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            out = []
            for look, doc, doc_id, text in zip(batch["look"], batch["doc"], batch["doc_id"], batch["text"], strict=True):
                sigs = spots(text) if look == 0 or held else None
                if held:
                    of, own, own_sigs = held
                    n = len(own)
                    edited = own[: n - n // 4] + text[: n // 4]
                    edited_sigs = spots(edited) if edited != own else own_sigs
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((of, n, sha, digest(own_sigs), digest(edited_sigs), likeness(own_sigs, edited_sigs), likeness(own_sigs, sigs), own_sigs.view(np.int64), edited_sigs.view(np.int64)))
                held = (None if doc == -(1 << 63) else doc, text, sigs) if look == 0 else None
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, signatures array<long>, edited_signatures array<long>"
    return with_next(docs).mapInPandas(compare, schema)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(documents(spark, sf_dir))
