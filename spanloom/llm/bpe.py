"""BPE encoding and decoding of whole texts by tree concatenation.

A text of more than PART characters is halved, wherever the middle falls, until its parts are short; the parts are encoded
on their own and joined pairwise up the tree. Around each join a window of the text is encoded again and grows until it
agrees with the left part near its begin and with the right part near its end: in ids and places of AGREE tokens in a row.
Between these the window's tokens stand, beyond them each part's own do. That is exact: a sequence of tokens is the encoding
of its text if each two neighbours are that of theirs (the merges of a pair never depend on what stands further off), and
every pair of neighbours of the joined sequence is one of a part's or of the window's encoding, since at a seam at least two
tokens in a row are common to both. A window that reaches both ends of what it joins is the encoding itself.

A text of more than SPREAD characters is dealt out: its stretches, cut by length, are trees that different tasks encode in
parallel, and are joined by windows in a second step, so that one very long document doesn't hold up one task for its whole
encoding.

Parts are encoded word by word where the tokenizer parts at spaces, as words are often at hand; windows, and everything for
a tokenizer that doesn't, by one call of the library.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm._common import bounded_batches, documents

#: Characters of a part that is encoded at once; characters on each side of a join that its first window has; tokens in a row
#: that must agree on each side.
PART, REACH, AGREE = 4096, 64, 4

#: Characters of a stretch of a long document.
SPREAD = 1 << 16

#: Words that a worker keeps at hand (in two generations), and characters of the longest of them.
KEPT, WORD = 300_000, 200

#: Words near a bound that are taken apart at once.
FEW = 16

#: How a token is kept.
_ID = np.dtype("<u4")

#: A token and its place in the text: (id, from, to). A segment is a list of tokens, or of words with where they begin.
Token = tuple[int, int, int]
Segment = tuple[int, list[str]] | list[Token]


def public_path(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


class TreeEncoder:
    """Encodes texts with one tokenizer file as its library does, without special tokens added."""

    def __init__(self, path: str, part: int = PART, reach: int = REACH) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.part, self.reach = part, reach
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.digits = [str(i) for i in range(self.tokenizer.get_vocab_size())]
        self.by_word = self._parts_at_spaces()
        self.windows = self.grown = 0

    def _encode(self, text: str, at: int = 0) -> list[Token]:
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return [(i, a + at, b + at) for i, (a, b) in zip(e.ids, e.offsets, strict=True)]

    def _parts_at_spaces(self) -> bool:
        """Whether words have the same tokens, at the same places, alone and between spaces."""
        words = ["a", "Some", "don't", "x1!", "(y)", "été", "日本", "--", "'s"]
        alone, at = [], 0
        for w in words:
            alone += self._encode(w, at)
            at += len(w) + 1
        return alone == self._encode(" ".join(words))

    def _ids(self, words: list[str]) -> list[int]:
        """The tokens of the words, in order; words that aren't at hand are encoded together. Tokens are kept as bytes, four
        for each: lists of so many words are scattered over memory, and the collector walks them again and again."""
        if len(self.new) > KEPT:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        found = list(map(new.get, words))
        if None in found:
            lacking = {w for w, kept in zip(words, found, strict=True) if kept is None}
            missing = [w for w in lacking if w not in old]
            if missing:
                # one text of them all: words are parted where their places say
                ends = np.cumsum([len(w) + 1 for w in missing])
                e = self.tokenizer.encode(" ".join(missing), add_special_tokens=False)
                places = np.fromiter((a for a, _ in e.offsets), np.int64)
                ids, start = np.array(e.ids, _ID).tobytes(), 0
                for w, end in zip(missing, (np.searchsorted(places, ends) * _ID.itemsize).tolist(), strict=True):
                    new[w] = ids[start:end]
                    start = end
            for w in lacking.difference(missing):
                new[w] = old[w]
            found = list(map(new.__getitem__, words))
            for w in missing:
                if len(w) > WORD:
                    del new[w]
        return np.frombuffer(b"".join(found), _ID).tolist()

    def _leaf(self, text: str, start: int, end: int) -> list[Segment]:
        piece = text[start:end]
        return [(start, piece.replace("\n", " ").split(" "))] if self.by_word else [self._encode(piece, start)]

    def _placed(self, base: int, words: list[str]) -> list[Token]:
        """The tokens of words with a space between them, with their places."""
        return self._encode(" ".join(words), base)

    def _last(self, segments: list[Segment]) -> list[Token]:
        """Takes the tokens of the last few words, or of the last segment, off the segments."""
        segment = segments.pop()
        if isinstance(segment, list):
            return segment
        base, words = segment
        few = words[-FEW:]
        if len(words) == len(few):
            return self._placed(base, few)
        segments.append((base, words[:-FEW]))
        return self._placed(base + sum(map(len, words[:-FEW])) + len(words) - FEW, few)

    def _first(self, segments: list[Segment]) -> list[Token]:
        """Takes the tokens of the first few words, or of the first segment, off the segments."""
        segment = segments[0]
        if isinstance(segment, list):
            del segments[0]
            return segment
        base, words = segment
        few = words[:FEW]
        if len(words) == len(few):
            del segments[0]
        else:
            segments[0] = (base + sum(map(len, few)) + FEW, words[FEW:])
        return self._placed(base, few)

    def tree(self, text: str, start: int = 0, end: int | None = None) -> list[Segment]:
        """The tokens of text[start:end], as one encoding of it gives them, in segments."""
        end = len(text) if end is None else end
        if end - start <= self.part:
            return self._leaf(text, start, end)
        middle = (start + end) // 2
        return self.join(text, self.tree(text, start, middle), self.tree(text, middle, end), start, middle, end)

    def join(self, text: str, left: list[Segment], right: list[Segment], start: int, middle: int, end: int) -> list[Segment]:
        """The segments of text[start:end] from those of its halves, whose lists are used up."""
        reach, tail, head = self.reach, [], []
        self.windows += 1
        while True:
            low, high = max(start, middle - reach), min(end, middle + reach)
            while left and (not tail or tail[0][1] > low):
                tail = self._last(left) + tail
            while right and (not head or head[-1][1] <= high):
                head += self._first(right)
            # a window begins where a token does
            i = next((k for k in range(len(tail) - 1, -1, -1) if tail[k][1] <= low), 0) if low > start else 0
            low = tail[i][1] if low > start and tail and tail[i][1] <= low else start
            window = self._encode(text[low:high], low)
            begin = _meet(window, tail[i:], 0) if low > start else (0, 0)
            finish = _meet(window, [t for t in head if t[1] <= high], begin[0] if begin else 0, backward=True) if high < end else (len(window), len(head))
            if begin is not None and finish is not None and begin[0] <= finish[0]:
                kept = tail[: i + begin[1]] if low > start else []
                return (left if low > start else []) + [kept + window[begin[0] : finish[0]] + head[finish[1] :]] + (right if high < end else [])
            self.grown += 1
            reach *= 2

    def result(self, segments: list[Segment]) -> tuple[int, str, str]:
        """(tokens, ids joined by a space, the library's decoding of the ids)."""
        ids = []
        for x in segments:
            ids += [t[0] for t in x] if isinstance(x, list) else self._ids(x[1])
        return len(ids), " ".join(map(self.digits.__getitem__, ids)), self.tokenizer.decode(ids, skip_special_tokens=False)

    def placed(self, segments: list[Segment]) -> list[Token]:
        return list(chain.from_iterable(x if isinstance(x, list) else self._placed(*x) for x in segments))

    def encode(self, text: str) -> tuple[int, str, str]:
        return self.result(self.tree(text))


def _meet(window: list, part: list, after: int, backward: bool = False) -> tuple[int, int] | None:
    """(place in window, place in part) within AGREE tokens in a row that both have: the first such run of the window, or with
    backward the last one that isn't at the window's own end."""
    at = {x: k for k, x in enumerate(part)}
    places = range(after, len(window) - AGREE + 1)
    for k in reversed(places[:-AGREE] if len(places) > AGREE else range(0)) if backward else places:
        p = at.get(window[k])
        if p is not None and window[k : k + AGREE] == part[p : p + AGREE]:
            return (k + AGREE // 2, p + AGREE // 2)
    return None


_encoders: dict[str, TreeEncoder] = {}


def encoder(path: str) -> TreeEncoder:
    if path not in _encoders:
        _encoders[path] = TreeEncoder(path)
    return _encoders[path]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


#: Tokens of a segment of a stretch that another task has encoded.
_SEGMENT = 64


def encode_documents(docs: DataFrame, path: str, texts: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of docs (with texts also ids and decoded).

    A null text counts as empty: no tokens, hashes of the empty string. Repeated rows each get a row; other columns
    are ignored. path: the tokenizer's file, at the same place on every machine.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")  # pandas would round long ids beside nulls
    bounded_batches(docs.sparkSession)
    more = ", ids string, decoded string" if texts else ""

    def row(n: int, ids: str, decoded: str) -> tuple:
        return (n, _sha(ids), _sha(decoded), *((ids, decoded) if texts else ()))

    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if texts else [])]

    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        e = encoder(path)
        for texts_in in batches:
            yield pd.DataFrame([row(*e.encode(t or "")) for t in texts_in], columns=names)

    result = f"n_tokens long, ids_sha256 string, decoded_sha256 string{more}"
    whole_udf = F.pandas_udf(whole, result)
    long = F.char_length(F.coalesce("text", F.lit(""))) > SPREAD
    short_rows = docs.where(~long).select("doc_id", whole_udf("text").alias("_e")).select("doc_id", "_e.*")

    # a long text is encoded once, however many rows have it
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                starts = range(0, len(text), SPREAD)
                yield pd.DataFrame({"key": _sha(text), "k": range(len(starts)), "text": [text[a : a + SPREAD] for a in starts]})

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path)
        for b in batches:
            flat = [e.placed(e.tree(text)) for text in b["text"]]
            yield b.assign(ids=[[t[0] for t in x] for x in flat], starts=[[t[1] for t in x] for x in flat], ends=[[t[2] for t in x] for x in flat])

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        e, pdf = encoder(path), pdf.sort_values("k")
        text, done, at = "".join(pdf["text"]), [], 0
        for t, ids, starts, ends in zip(pdf["text"], pdf["ids"], pdf["starts"], pdf["ends"], strict=True):
            tokens = list(zip(ids.tolist(), (starts + at).tolist(), (ends + at).tolist(), strict=True))
            part = [tokens[i : i + _SEGMENT] for i in range(0, len(tokens), _SEGMENT)]
            done = e.join(text, done, part, 0, at, at + len(t)) if at else part
            at += len(t)
        return pd.DataFrame([(pdf["key"].iloc[0], *row(*e.result(done)))], columns=["key", *names])

    long_docs = docs.where(long)
    stretches = long_docs.groupBy("text").agg(F.lit(1).alias("_one")).select("text").mapInPandas(cut, "key string, k long, text string")
    encoded = stretches.repartition(F.col("key"), F.col("k")).mapInPandas(parts, "key string, k long, text string, ids array<int>, starts array<int>, ends array<int>")
    results = encoded.groupBy("key").applyInPandas(joined, f"key string, {result}")
    long_rows = long_docs.select("doc_id", F.sha2("text", 256).alias("key")).join(results, "key").select("doc_id", *names)
    return short_rows.unionByName(long_rows).withColumn("doc_id", F.col("doc_id").cast(id_type))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), public_path("word_bpe_49k.json"))
