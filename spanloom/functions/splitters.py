"""Table functions that split turns, for use from SQL.

    register(spark)
    SELECT * FROM sliding_windows(TABLE(turns), 2000000, 750000)
    SELECT * FROM quiet_cuts(TABLE(tracks) PARTITION BY (recording_id, part), 30, 0.5)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import arrow_udtf, udtf
from pyspark.sql.types import BooleanType, DataType, IntegerType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from spanloom.operators.folds import split_part


def _row(**columns: DataType) -> StructType:
    """A turn's key and these columns; built here, as a worker can't parse a schema."""
    out = StructType().add("recording_id", StringType()).add("turn_index", IntegerType())
    for name, kind in columns.items():
        out = out.add(name, kind)
    return out


class SlidingWindows:
    """(recording_id, turn_index, window_start_us, window_end_us) over each turn of a table (recording_id, turn_index, start_us,
    end_us), of a length and every hop; the last one ends with the turn."""

    @staticmethod
    def analyze(turns: AnalyzeArgument, length: AnalyzeArgument, hop: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(_row(window_start_us=LongType(), window_end_us=LongType()))

    def eval(self, turn: Row, length: int, hop: int):
        start, end = turn["start_us"], turn["end_us"]
        last = max(end - length, start)
        for at in dict.fromkeys([*range(start, last + 1, hop), last]):
            yield turn["recording_id"], turn["turn_index"], at, min(at + length, end)


class QuietCuts:
    """(recording_id, turn_index, first_frame, end_frame, fits): pieces of the turns of a table that tracks() gives, cut as
    split_part() does. It wants the rows of a part together (PARTITION BY recording_id, part), and gets them as Arrow batches."""

    def __init__(self) -> None:
        self.batches, self.asked = [], None

    def eval(self, rows: pa.RecordBatch, most: pa.Array, threshold: pa.Array):
        if rows.num_rows:
            self.batches.append(rows)
            self.asked = most[0].as_py(), float(threshold[0].as_py())
        yield from ()

    def terminate(self):
        if self.batches:
            rows = pa.Table.from_batches(self.batches)
            turns = rows.filter(pc.is_valid(rows["turn_index"]))
            known = rows.filter(pc.is_null(rows["turn_index"]))
            asked = np.stack([turns[c].to_numpy().astype(np.int64) for c in ("turn_index", "first", "end")], axis=1)
            blocks = [(f.values.to_numpy(zero_copy_only=False), p.values.to_numpy(zero_copy_only=False)) for f, p in zip(known["frames"], known["p"], strict=True)]
            index, a, b, fits = split_part(asked, blocks, *self.asked)
            key = pa.repeat(rows["recording_id"][0], len(index))
            yield pa.table({"recording_id": key, "turn_index": index.astype(np.int32), "first_frame": a, "end_frame": b, "fits": fits})


def register(spark: SparkSession) -> None:
    spark.udtf.register("sliding_windows", udtf(SlidingWindows))
    spark.udtf.register("quiet_cuts", arrow_udtf(QuietCuts, returnType=_row(first_frame=LongType(), end_frame=LongType(), fits=BooleanType())))
