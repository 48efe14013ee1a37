"""Fill-in-middle transformation through an index of distinct texts.

The digests of all distinct texts are one table, and documents meet it by a merge join: rows of one digest come to a task
one after the other, and a digest of very many rows is split over tasks by the skew join. There a text is compared with the
ones indexed under its digest; only a new content gets its token bounds found, kept as an Elias-Fano list of about five bits
a token, and each document of that content selects its own two seeded cuts from the list without unpacking it. So whole
texts are shuffled once, and a task holds the texts of a single digest.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm._common import bounded_batches, column, documents, materialise

#: Seed of the cuts; of 100 documents those that are cut at all, and of 100 cut ones those in suffix-prefix-middle order.
SEED, RATE, SPM_RATE = 42, 50, 80

#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")

_HEAD = struct.Struct("<QB")
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)
_SPACE = np.zeros(33, dtype=bool)
_SPACE[[*range(0x09, 0x0E), 0x20]] = True


# --- token bounds and their lists ---


def token_ends(text: str) -> np.ndarray:
    """Code points before the end of each token: words with the white space before them, and white space at the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    space = _SPACE[np.minimum(points, 32)] & (points <= 32)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(points)) if len(points) else ends


def elias_fano(values: np.ndarray) -> bytes:
    """An ascending list of numbers: low bits packed side by side, high bits as gaps of ones in a bit string."""
    n = len(values)
    if not n:
        return _HEAD.pack(0, 0)
    values = values.astype(np.uint64)
    low = max(0, (int(values[-1]) // n).bit_length() - 1)
    places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
    high[places] = 1
    lows = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return _HEAD.pack(n, low) + np.packbits(lows.ravel(), bitorder="little").tobytes() + np.packbits(high, bitorder="little").tobytes()


def size_of(packed: bytes) -> int:
    return _HEAD.unpack_from(packed)[0]


def select(packed: bytes, i: int) -> int:
    """The i-th number of a list, from 1; 0 for i = 0."""
    n, low = _HEAD.unpack_from(packed)
    if not 0 <= i <= n:
        raise IndexError(i)
    if not i:
        return 0
    lows = (n * low + 7) // 8
    high = np.frombuffer(packed, np.uint8, offset=_HEAD.size + lows)
    upto = np.cumsum(_ONES[high])
    byte = int(np.searchsorted(upto, i))
    rest, bits = i - int(upto[byte] - _ONES[high[byte]]), int(high[byte])
    at = next(b for b in range(8) if bits >> b & 1 and (bits & ((2 << b) - 1)).bit_count() == rest)
    first = (i - 1) * low
    chunk = int.from_bytes(packed[_HEAD.size + first // 8 : _HEAD.size + (first + low + 7) // 8], "little") >> first % 8
    return (byte * 8 + at - (i - 1) << low) | (chunk & ((1 << low) - 1))


# --- the operator ---


class TextIndex:
    """The lists of the texts of one digest, the last one asked for; texts are told apart by their content."""

    def __init__(self) -> None:
        self.digest, self.lists, self.made = None, {}, 0

    def of(self, digest: bytes, text: str) -> bytes:
        if digest != self.digest:
            self.digest, self.lists = digest, {}
        found = self.lists.get(text)
        if found is None:
            found = self.lists[text] = elias_fano(token_ends(text))
            self.made += 1
        return found


def _cuts(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    """Token count of each text and the code points before its two cuts; _one and _two are hashes."""
    index = TextIndex()
    for digests, texts, ones, twos in batches:
        out = []
        for digest, text, one, two in zip(digests, texts, ones, twos, strict=True):
            packed = index.of(digest, text)
            n = size_of(packed)
            first, last = sorted((one % (n + 1), two % (n + 1)))
            out.append((n, select(packed, first), select(packed, last)))
        yield pd.DataFrame(out, columns=["n", "a", "b"], dtype="int64")


def _hash(i: int) -> Column:
    return F.conv(F.substring("_h", 8 * i - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, carry: list[str] | None = None, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """The columns `carry` of every row (all by default) with n (tokens), form (plain, psm or spm), prefix_chars,
    middle_chars (code points; null if plain) and output, the text in that form.

    A null text counts as empty. Rows of one doc_id have the same seed; a null doc_id has that of an empty one. Equal rows
    have equal results, one for each of them. A text with one of the marks stays plain. A column of docs with the name of a
    result is replaced by it.
    """
    carry = [c for c in docs.columns if c not in RESULTS] if carry is None else carry
    rows = docs.select(
        F.struct(*[column(c).alias(c) for c in carry]).alias("_row"), F.coalesce("text", F.lit("")).alias("_text"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256).alias("_h"),
    )
    bounded_batches(docs.sparkSession)
    cuts = F.pandas_udf(_cuts, "n long, a long, b long")
    rows = rows.withColumn("_sha", F.unhex(F.sha2("_text", 256)))
    # a written table, so that both sides of the join are dealt out for it alone and a digest of many rows can be split
    digests = materialise(rows.select("_sha").distinct(), "digests")
    found = rows.join(digests.hint("merge"), "_sha")
    found = found.withColumn("_cut", cuts("_sha", "_text", _hash(1), _hash(2))).withColumn("_n", F.col("_cut.n"))
    marked = F.col("_text").contains(PREFIX) | F.col("_text").contains(SUFFIX) | F.col("_text").contains(MIDDLE)
    plain = (F.col("_n") == 0) | marked | (_hash(3) % 100 >= rate)
    found = found.withColumn("_form", F.when(plain, "plain").when(_hash(4) % 100 < spm_rate, "spm").otherwise("psm"))
    cut = F.col("_form") != "plain"
    a, b = F.col("_cut.a"), F.col("_cut.b")
    prefix, middle, suffix = F.substring("_text", F.lit(1), a), F.substring("_text", a + 1, b - a), F.substring("_text", b + 1, F.length("_text"))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    output = F.when(F.col("_form") == "psm", psm).when(F.col("_form") == "spm", spm).otherwise(F.col("_text"))
    return found.select("_row.*", F.col("_n").alias("n"), F.col("_form").alias("form"), F.when(cut, a).alias("prefix_chars"), F.when(cut, b - a).alias("middle_chars"), output.alias("output"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text, from output and form alone. A mark can't arise across the bounds of parts: none begins where another
    one ends, and no cut text holds one."""
    o = F.col(output)
    middle = F.substring_index(o, MIDDLE, -1)

    def parts(second: str) -> tuple[Column, Column]:
        rest = F.substring_index(o, second, -1)
        return F.substring(F.substring_index(o, second, 1), F.lit(len(PREFIX) + 1), F.length(o)), F.substring_index(rest, MIDDLE, 1)

    (prefix, suffix), (suffix_first, prefix_last) = parts(SUFFIX), parts(PREFIX)
    return F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix)).when(F.col(form) == "spm", F.concat(prefix_last, middle, suffix_first)).otherwise(o)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(cast(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens FROM documents),
u AS (
  SELECT *, len(tokens) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
f AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j FROM u),
p AS (
  SELECT *, coalesce(array_to_string(list_slice(tokens, 1, i), ''), '') AS pre, coalesce(array_to_string(list_slice(tokens, i + 1, j), ''), '') AS mid,
    coalesce(array_to_string(list_slice(tokens, j + 1, n), ''), '') AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE text END) AS output_sha256,
  sha256(CASE WHEN form = 'plain' THEN text ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
