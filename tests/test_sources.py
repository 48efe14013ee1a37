"""Data sources and table functions of our own."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.sources import ranges


@pytest.fixture(scope="module")
def known(spark):
    ranges.register(spark)
    return spark


def test_a_file_is_read_by_several_tasks_in_whole_blocks(known, tmp_path):
    rng = np.random.default_rng(1)
    files = {"a.bin": 10_000, "b/c.bin": 257, "empty.bin": 0, "_hidden": 50, "d.bin": 3 * 256}
    data = {}
    for name, size in files.items():
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        data[name] = rng.bytes(size)
        (tmp_path / name).write_bytes(data[name])
    rows = known.read.format("byte_ranges").option("block", 256).option("range", 1000).load(str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in rows if r.file.endswith("a.bin")}) == 14
    for name in ("a.bin", "b/c.bin", "d.bin"):
        own = sorted((r for r in rows if r.file.endswith("/" + name)), key=lambda r: r.start)
        assert b"".join(bytes(r.data) for r in own) == data[name]
        assert [r.start for r in own] == list(range(0, files[name], 256))
    assert not [r for r in rows if "empty" in r.file or "hidden" in r.file]
    one = known.read.format("byte_ranges").option("block", 256).load(f"file:{tmp_path}/a.bin")
    assert one.agg(F.sum(F.octet_length("data"))).first()[0] == 10_000


def test_lines_appear_when_all_tasks_are_done_and_none_after_a_failure(known, tmp_path):
    path = str(tmp_path / "out")
    lines = known.range(100, numPartitions=4).select(F.concat(F.lit("é "), F.col("id").cast("string")).alias("value"))
    write = lambda df, mode: df.write.format("published_lines").mode(mode).save(path)
    write(lines, "append")
    want = sorted(f"é {i}" for i in range(100))
    assert sorted(r.value for r in known.read.text(path).collect()) == want
    bad = lines.select(F.when(F.col("value") == "é 77", "two\nlines").otherwise(F.col("value")).alias("value"))
    with pytest.raises(Exception, match="without line ends"):
        write(bad, "append")
    assert sorted(r.value for r in known.read.text(path).collect()) == want
    assert not [d for d in os.listdir(path) if d.startswith("_pending")]
    write(known.range(1).select(F.lit("new").alias("value")), "append")
    assert known.read.text(path).count() == 101
    write(known.range(2, numPartitions=2).select(F.col("id").cast("string").alias("value")), "overwrite")
    assert sorted(r.value for r in known.read.text(path).collect()) == ["0", "1"]
