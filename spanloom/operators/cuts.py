"""Greedy cuts by jump pointers: where a group that begins at one row ends is known for each row alone; which rows do begin
one depends on all before.

Each row's pointer is the row that the next group begins at. Within a block of BLOCK rows pointers are followed until they
leave it. What they leave to is few rows, since groups that begin near each other soon begin at the same rows; over those
the pointers are doubled by joins, so that the rows that the first group leads to are found in as many rounds as the number
of blocks has binary digits. Then each block is walked once, from the only row that it is entered at. No task holds more
than a block of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.operators.timeline import along, latest, place, upcoming, upto_sum
from spanloom.sources.scratch import settled

#: Rows of a key that a task follows pointers in.
BLOCK = 1 << 13

_NOWHERE = 1 << 62


def _key(keys: list[str]) -> Column:
    """The key as one string, nulls included."""
    return F.to_json(F.struct(*keys))


def first_beyond(rows: DataFrame, keys: list[str], value: str, limit: Column, width: int) -> DataFrame:
    """(_g, place, beyond): of each row the least place whose `value` is over the row's limit, null if there is none. Places
    number the rows of a key along `value`, which never falls. width: see along()."""
    points = rows.select(_key(keys).alias("_g"), F.col(value).cast("long").alias("v"), F.lit(0).alias("kind"), "place")
    asked = rows.select(_key(keys).alias("_g"), limit.cast("long").alias("v"), F.lit(1).alias("kind"), "place")
    both = along(points.unionAll(asked), ["_g"], ["v", "kind", "place"], at="v", width=width, beyond=upcoming(F.when(F.col("kind") == 0, F.col("place"))))
    return both.where("kind = 1").select("_g", "place", "beyond")


def _in_blocks(step: Callable[[pd.DataFrame, list[int], list[int]], pd.DataFrame]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Calls step for whole blocks of sorted rows (_g, _block, place, next), of many small keys at once. It gets the rows, of
    each the row that its pointer leads to, and the row behind its block."""

    def whole(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        ends = np.repeat(np.append(starts[1:], len(rows)), np.diff(np.append(starts, len(rows))))
        to = np.minimum(np.arange(len(rows)) + (rows["next"] - rows["place"]).to_numpy(), ends)
        return step(rows, to.tolist(), ends.tolist())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            if len(rows):
                g, block = rows["_g"].to_numpy(), rows["_block"].to_numpy()
                starts = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (block[1:] != block[:-1])))
                done = starts[-1]
                held = rows.iloc[done:].reset_index(drop=True)
                if done:
                    yield whole(rows.iloc[:done], starts[:-1])
        if held is not None and len(held):
            yield whole(held, np.array([0]))

    return run


def _exits(rows: pd.DataFrame, to: list[int], ends: list[int]) -> pd.DataFrame:
    """Of each row the first pointer that leaves its block."""
    out = rows["next"].tolist()
    for i in range(len(out) - 1, -1, -1):
        if to[i] < ends[i]:
            out[i] = out[to[i]]
    return pd.DataFrame({"_g": rows["_g"].to_numpy(), "place": rows["place"].to_numpy(), "to": out})


def _walked(rows: pd.DataFrame, to: list[int], ends: list[int]) -> pd.DataFrame:
    """The rows that begin a group, from those that their block is entered at."""
    begins = rows["entry"].tolist()
    for i, begun in enumerate(begins):
        if begun and to[i] < ends[i]:
            begins[to[i]] = True
    return rows.loc[np.array(begins, dtype=bool), ["_g", "place"]]


def _blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("_g", "_block").sortWithinPartitions("_g", "_block", "place")


def group_starts(pointers: DataFrame, block: int = BLOCK) -> DataFrame:
    """(_g, place): the rows that begin a group. pointers: _g (a key), place (0, 1, ... in a key) and next, which is larger
    than place; a key's first group begins at place 0."""
    pointers = settled(pointers.select("_g", "place", "next").withColumn("_block", F.floor(F.col("place") / block)))
    exits = settled(_blocks(pointers).mapInPandas(_in_blocks(_exits), "_g string, place long, to long"))
    last = pointers.agg(F.max("_block")).first()[0] or 0
    entered = exits.select("_g", F.col("to").alias("place")).where(F.col("place") < _NOWHERE).distinct()
    entries = pointers.where("place = 0").select("_g", "place")
    jumps = settled(exits.join(entered.union(entries), ["_g", "place"], "left_semi"))
    for _ in range(last.bit_length()):
        step = jumps.select("_g", "place", F.col("to").alias("_to"))
        entries = settled(entries.union(entries.join(step, ["_g", "place"]).select("_g", F.col("_to").alias("place")).where(F.col("place") < _NOWHERE)).distinct())
        further = jumps.select("_g", F.col("place").alias("_to"), F.col("to").alias("_then"))
        jumps = settled(step.join(further, ["_g", "_to"], "left").select("_g", "place", F.coalesce("_then", "_to").alias("to")))
    entered = entries.select(F.col("_g").alias("_key"), F.col("place").alias("_at"), F.lit(True).alias("entry"))
    rows = pointers.join(entered, (F.col("_g") == F.col("_key")) & (F.col("place") == F.col("_at")), "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return _blocks(rows.drop("_key", "_at")).mapInPandas(_in_blocks(_walked), "_g string, place long")


def _grouped(rows: DataFrame, keys: list[str], pointers: DataFrame) -> DataFrame:
    """rows (keys, place) with `group`, the place of the row that began theirs."""
    starts = group_starts(pointers).withColumn("_starts", F.lit(True))
    marked = rows.withColumn("_g", _key(keys)).join(starts, ["_g", "place"], "left")
    return along(marked, keys, ["place"], at="place", width=BLOCK, group=latest(F.when(F.col("_starts"), F.col("place")))).drop("_g", "_starts")


def pack(rows: DataFrame, keys: list[str], order: list[str], at: str, size: str, most: int, count: int, width: int) -> DataFrame:
    """Adds place (from 0) and group: in order, each row joins the group before it while the group's sizes then sum up to
    `most` and its rows to `count` at most; a row larger than `most` is a group of its own. order begins with `at`, a number
    (width: see along()), and tells rows apart; a null size counts as 0."""
    placed = settled(along(rows, keys, order, at=at, width=width, place=place(), _upto=upto_sum(F.coalesce(F.col(size), F.lit(0)))))
    before = F.col("_upto") - F.coalesce(F.col(size), F.lit(0))
    beyond = first_beyond(placed, keys, "_upto", before + most, most * 64)
    following = F.greatest(F.least(F.coalesce("beyond", F.lit(_NOWHERE)), F.col("place") + count), F.col("place") + 1)
    return _grouped(placed.drop("_upto"), keys, beyond.withColumn("next", following))


def cut_where(rows: DataFrame, keys: list[str], order: list[str], at: str, value: str, limit: Column, width: int) -> DataFrame:
    """Adds place (from 0) and group: in order, a group ends before the first row whose `value`, which never falls, is over the
    limit of the row that began it. order begins with `at` (width: see along()) and tells rows apart."""
    placed = settled(along(rows, keys, order, at=at, width=width, place=place()))
    beyond = first_beyond(placed, keys, value, limit, width)
    following = F.greatest(F.coalesce("beyond", F.lit(_NOWHERE)), F.col("place") + 1)
    return _grouped(placed, keys, beyond.withColumn("next", following))
