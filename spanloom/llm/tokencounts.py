"""Token counts of documents in flat token files that have no index.

A flat file is documents' token ids one after another, each document followed by an end-of-document id. It is read in
blocks. Each block is searched for the id with one vector comparison; what a document has in several blocks is put
together with prefix scans over the blocks: tokens before a block, and place of the last separator before it.

read_flat() reads such files. flatten() makes the blocks of one file for each task straight from documents, and logs which
documents end in a block, so that op10 can name the documents; no scan looks at that log.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm._common import bounded_batches, documents, materialise, running
from spanloom.llm.bpe import public_path
from spanloom.sources.ranges import register

#: End-of-document id of the 50k byte-level vocabulary, width of an id, ids in a block.
SEPARATOR, DTYPE, BLOCK = 50256, "<u2", 1 << 17


@cache
def _tiktoken(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def flatten(docs: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    """(file, block, tokens binary, ended array): the documents as flat files, one for each task, in blocks. `ended`
    is the writer's log of the documents whose separator a block has; scans don't need it. A null text is an empty
    document; repeated rows are documents of their own; a text of any length is encoded whole; other columns are
    ignored."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")  # pandas would round long ids beside nulls

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, file, number = _tiktoken(path).encode_ordinary, TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        ids: list[tuple[int, int | None]] = []
        n = 0

        def cut(size: int) -> pd.DataFrame:
            nonlocal held, ids, n, number
            tokens = np.concatenate(held)
            done = [d for at, d in ids if at < size]
            ids = [(at - size, d) for at, d in ids if at >= size]
            held, n = [tokens[size:]], len(tokens) - size
            number += 1
            return pd.DataFrame({"file": [file], "block": [number - 1], "tokens": [tokens[:size].astype(DTYPE).tobytes()], "ended": [done]})

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                tokens = np.array([*encode(text or ""), SEPARATOR], dtype=np.int64)
                held.append(tokens)
                n += len(tokens)
                ids.append((n - 1, None if doc is None else int(doc)))
                while n >= block:
                    yield cut(block)
        if n:
            yield cut(n)

    return docs.select("doc_id", "text").mapInPandas(write, "file long, block long, tokens binary, ended array<long>")


def read_flat(spark: SparkSession, path: str, block: int = BLOCK, dtype: str = DTYPE) -> DataFrame:
    """(file, block, tokens binary): flat files of ids of `dtype` below path, in blocks. Tasks read ranges of a file, so files may
    have any size."""
    size = block * np.dtype(dtype).itemsize
    register(spark)
    rows = spark.read.format("byte_ranges").option("block", size).load(path)
    return rows.select("file", (F.col("start") / size).cast("long").alias("block"), F.col("data").alias("tokens"))


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = DTYPE) -> DataFrame:
    """(file, block, k, n_tokens): the tokens of each document, without its separator, by the block that has the
    separator and the separator's number in it; blocks has file, block and tokens (binary). What stands after the last
    separator of a file is a document too (k null), if there is anything."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.frombuffer(t, dtype) for t in batch["tokens"]]
            yield pd.DataFrame({"file": batch["file"], "block": batch["block"], "n": [len(x) for x in found], "at": [np.flatnonzero(x == separator) for x in found]})

    kind = blocks.schema["file"].dataType.simpleString()
    seps = materialise(blocks.select("file", "block", "tokens").mapInPandas(search, f"file {kind}, block long, n long, at array<long>"), "separators")
    placed = running(seps, ["file"], ["block"], "n", "start").withColumn("start", F.coalesce("start", F.lit(0)))
    placed = placed.withColumn("last", F.col("start") + F.try_element_at("at", F.lit(-1)))
    stitched = materialise(running(placed, ["file"], ["block"], "last", "before", F.max).withColumn("before", F.coalesce("before", F.lit(-1))), "stitched")
    each = stitched.select("file", "block", "start", "before", "at", F.posexplode("at").alias("k", "sep"))
    earlier = F.when(F.col("k") > 0, F.col("start") + F.try_element_at("at", F.col("k"))).otherwise(F.col("before"))
    counts = each.select("file", "block", "k", (F.col("start") + F.col("sep") - earlier - 1).alias("n_tokens"))
    rest = stitched.groupBy("file").agg(F.max("block").alias("block"), F.sum("n").alias("n"), F.max("last").alias("last"))
    rest = rest.select("file", "block", F.lit(None).cast("int").alias("k"), (F.col("n") - F.coalesce("last", F.lit(-1)) - 1).alias("n_tokens"))
    return counts.unionByName(rest.where("n_tokens > 0"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and n_tokens of every row of documents (null and empty texts: 0; a null doc_id stays null), found in the
    flat files that the documents are first written to."""
    blocks = materialise(flatten(documents(spark, sf_dir), public_path("byte_bpe_50k.tiktoken")), "flat")
    log = blocks.select("file", "block", F.posexplode("ended").alias("k", "doc_id"))
    return count_tokens(blocks).join(log, ["file", "block", "k"]).select("doc_id", "n_tokens")
