"""Removal of repeated passages by a logarithmic family of sparse suffix arrays.

A byte goes if a string of WIDTH bytes that covers it also starts earlier in the corpus. Indexing every suffix would
take tens of bytes for each byte of text, so the arrays are sparse: of each string of WIDTH bytes one core of CORE bytes
is sampled by the mod-minimizer scheme (Groot Koerkamp and Pibiri, 2024): its gram of GRAM bytes that hashes lowest fixes
the place of the core. Equal strings sample the same core at the same place. So it is enough to keep, for each sampled
core, one suffix entry that stands for the run of neighbouring strings that sampled it (a zone, about every 26th byte).
An entry holds the core's hash as sort key, a hash of the zone's whole content, and where it starts. In the order of
(key, content) equal zones stand side by side, which is what a suffix array is used for here. Two zones are taken for
equal if both 64-bit hashes, which are of different bytes and bases, agree.

Documents come in batches of ascending doc_id. A batch's array is sorted and merge-scanned against the levels that stand;
zones whose key holds one content only are settled at once: all but the first are repeats. Keys that hold several contents
(a passage of CORE bytes or more in different surroundings) go on to a comparison of their single strings. Levels of about
equal size merge, so that there are never more than a logarithmic number of them. A level is a table that is bucketed and
sorted by key: a batch is shuffled into the levels' buckets once, and levels are neither shuffled again by a scan nor by a
merge.

No key gathers its rows in one task: what repeats within a block of a task is settled there, so that a key has at most
one row of each content from each block, however many documents share a passage.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm._common import bounded_batches, column, discard, documents, materialise, running_totals
from spanloom.sources.scratch import remove, shared_dir

#: Bytes of a repeated string, of the core that it is filed under, and of the gram that fixes the core's place. A core
#: begins at its gram or HALF bytes before it, so that the string holds the whole core in either case.
WIDTH, CORE = 100, 62
HALF = WIDTH - CORE + 1
GRAM = CORE % HALF

#: Batches that a corpus comes in: the first two levels merge before the third is scanned.
BATCHES = 4

#: Window starts that are hashed at a time; positions within fit in 16 bits.
CHUNK = 60_000

#: Entries that a task settles at a time: about 190 bytes of a worker's memory for each.
BLOCK = 400_000

#: Most zones of a key that are compared in one group; strings in a part of a zone where a key has more.
GROUP, STEP = 256, 10

#: Kinds of rows: an entry of an array; sign that a key holds several contents; a zone whose strings must be looked at
#: one by one; a repeat.
ZONE, MARK, OPEN, REPEAT = 0, 1, 2, 3

ROWS = "key long, content long, doc long, at long"

#: `at` holds variant (20 bits, counts the different texts of one doc_id), start (31, a text's bytes), strings (8) and
#: kind (4).
NO_DOC = -(1 << 63)
VARIANTS = 1 << 20

_U = np.uint64


def _powers(base: int) -> np.ndarray:
    powers = np.full(CHUNK + WIDTH + 1, base, dtype=_U)
    powers[0] = 1
    return np.cumprod(powers, dtype=_U)


#: Of two odd bases, each followed by its inverse modulo 2^64.
_POWERS = [_powers(pow(base, sign, 1 << 64)) for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F) for sign in (1, -1)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _sums(data: np.ndarray, base: int) -> np.ndarray:
    return np.concatenate([np.zeros(1, _U), np.cumsum((data.astype(_U) + _U(1)) * _POWERS[base][: len(data)], dtype=_U)])


def _lowest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours."""
    n = len(x) - width + 1
    rows = np.full(-(-len(x) // width) * width, ~_U(0))
    rows[: len(x)] = x
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _cores(part: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Where the core of each string begins; sums are the part's _sums() of base 0."""
    grams = len(part) - GRAM + 1
    hashes = _mix((sums[GRAM:] - sums[:-GRAM]) * _POWERS[1][:grams])
    low = _lowest((hashes & ~_U(0xFFFF)) | np.arange(grams, dtype=_U), WIDTH - GRAM + 1)
    gram = (low & _U(0xFFFF)).astype(np.int64)
    return np.where(gram - np.arange(len(low)) >= HALF, gram - HALF, gram)


def zones(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, strings, key, content) of the zones of one text: each string of WIDTH bytes is in exactly one."""
    found = []
    text = np.frombuffer(data, dtype=np.uint8)
    for base in range(0, max(0, len(text) - WIDTH + 1), CHUNK):
        part = text[base : base + CHUNK + WIDTH - 1]
        sums, other = _sums(part, 0), _sums(part, 2)
        core = _cores(part, sums)
        start = np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]]))
        strings = np.diff(np.append(start, len(core)))
        at = core[start]
        key = _mix((sums[at + CORE] - sums[at]) * _POWERS[1][at])
        found.append((start + base, strings, key, _content(other, start, strings, at - start)))
    if not found:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, _U))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _content(sums: np.ndarray, start: np.ndarray, strings: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """Hash of runs of strings, of their number and of the bytes before their core; sums are of base 2."""
    whole = (sums[start + strings - 1 + WIDTH] - sums[start]) * _POWERS[3][start]
    return _mix(whole ^ _mix(strings.astype(_U) << _U(16) | ahead.astype(_U))) | _U(1)


def parts_of(zone: bytes, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, strings, key, content) of the parts of a zone's bytes. Strings of one zone differ in how many bytes they
    have before the core; a part holds those with as many, to the next multiple of step, and its key is the hash of all
    bytes that such strings share."""
    part = np.frombuffer(zone, dtype=np.uint8)
    sums, other = _sums(part, 0), _sums(part, 2)
    core = int(_cores(part[:WIDTH], sums[: WIDTH + 1])[0])
    ahead = core - np.arange(len(part) - WIDTH + 1)
    kind = ahead // step
    start = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    strings = np.diff(np.append(start, len(ahead)))
    low = kind[start] * step
    begin, end = core - low, core - np.minimum(low + step, HALF) + 1 + WIDTH
    key = _mix((sums[end] - sums[begin]) * _POWERS[1][begin] ^ _mix(low.astype(_U) + _U(step << 8)))
    return start, strings, key, _content(other, start, strings, ahead[start])


def settled(key: np.ndarray, content: np.ndarray, doc: np.ndarray, at: np.ndarray, last: bool) -> pd.DataFrame:
    """Settles one block: of equal (key, content) all but the first are repeats; where a key is left with several
    contents, its entries are opened and dealt by their place (content then holds their key), and one sign stays with
    the key. last: single strings, of which different contents say nothing about each other."""
    order = np.lexsort((at, doc, content, key))
    key, content, doc, at = key[order], content[order], doc[order], at[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
    kind = np.where(first, ZONE, REPEAT)
    marks = np.zeros(0, _U)
    if not last:
        k = key[first]
        same = np.zeros(len(k), bool)
        same[1:] = k[1:] == k[:-1]
        several = same.copy()
        several[:-1] |= same[1:]
        kind[np.flatnonzero(first)[several]] = OPEN
        marks = np.unique(k[several])
    spread = _mix(doc.view(_U) ^ _mix(at.view(_U)))
    content = np.where(kind == OPEN, key, content)
    key = np.where(kind == ZONE, key, spread)
    return pd.DataFrame(
        {
            "key": np.concatenate([key, marks]).view(np.int64),
            "content": np.concatenate([content, np.zeros(len(marks), _U)]).view(np.int64),
            "doc": np.concatenate([doc, np.full(len(marks), NO_DOC)]),
            "at": np.concatenate([at | kind, np.full(len(marks), MARK)]),
        }
    )


def _packed(variant: int, start: np.ndarray | int, strings: np.ndarray | int):
    return variant << 43 | start << 12 | strings << 4


def _start(at):
    return at >> 12 & ((1 << 31) - 1)


def _blocks(parts: Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]], last: bool) -> Iterator[pd.DataFrame]:
    """Settles (key, content, doc, at) of documents or zones by blocks."""
    held, n = [], 0
    for key, content, doc, at in parts:
        if len(key):
            held.append((key, content, np.full(len(key), doc, np.int64), at))
            n += len(key)
        if n >= BLOCK:
            yield settled(*map(np.concatenate, zip(*held, strict=True)), last)
            held, n = [], 0
    if held:
        yield settled(*map(np.concatenate, zip(*held, strict=True)), last)


def suffix_array(docs: DataFrame) -> DataFrame:
    """The entries of a batch (columns doc, variant, text)."""

    def parts(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            for doc, variant, text in zip(batch["doc"], batch["variant"], batch["text"], strict=True):
                start, strings, key, content = zones((text or "").encode("utf-8", "surrogatepass"))
                yield key, content, doc, _packed(variant, start.astype(np.int64), strings.astype(np.int64))

    return docs.select("doc", "variant", "text").mapInPandas(lambda batches: _blocks(parts(batches), last=False), ROWS)


def _kind(at: str = "at") -> Column:
    return F.col(at).bitwiseAND(F.lit(15))


def _variant() -> Column:
    return F.shiftright("at", 43).alias("variant")


def merge_scan(array: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Brings a new array and the standing levels into one order and looks at neighbours of equal key.

    Adds fresh (from the new array), first (no equal zone stands before it), several (its key holds other contents).
    The levels' documents all stand before the batch's.
    """
    rows = array.withColumn("fresh", F.lit(True))
    for level in levels:
        rows = rows.unionByName(level.withColumn("fresh", F.lit(False)))
    equal, key = Window.partitionBy("key", "content"), Window.partitionBy("key")
    place = F.struct("doc", "at")
    return rows.withColumns(
        {
            "first": place == F.min(place).over(equal),
            "several": F.min("content").over(key) != F.max("content").over(key),
        }
    )


def _new_in_level() -> Column:
    """Entries that a level keeps: the first of each content, and signs."""
    return F.col("fresh") & ((_kind() == MARK) | ((_kind() == ZONE) & F.col("first")))


def _found() -> Column:
    zone = _kind() == ZONE
    return _kind().isin(OPEN, REPEAT) | (zone & F.col("several")) | (zone & ~F.col("first"))


class Level:
    """A table in the shared folder that is bucketed and sorted by key."""

    def __init__(self, rows: DataFrame, buckets: int) -> None:
        spark = rows.sparkSession
        self.name = f"level_{uuid.uuid4().hex}"
        self.path = f"{shared_dir(spark)}/{self.name}"
        write = rows.write.option("path", self.path).option("compression", "zstd").bucketBy(buckets, "key").sortBy("key", "content")
        write.saveAsTable(self.name)
        self.table = spark.table(self.name)

    def entries(self) -> DataFrame:
        """What later batches are scanned against."""
        return self.table.where(_new_in_level()).select("key", "content", "doc", "at")

    def drop(self) -> None:
        self.table.sparkSession.sql(f"DROP TABLE {self.name}")
        remove(self.table.sparkSession, self.path)


class SuffixLevels:
    """The family of arrays: add() scans a batch against the levels and takes it in."""

    def __init__(self, buckets: int) -> None:
        self.buckets = min(buckets, 100_000)
        self.levels: list[tuple[int, DataFrame]] = []
        self.tables: list[Level | DataFrame] = []

    def add(self, docs: DataFrame, keep: bool = True) -> DataFrame:
        """What the batch's scan found: repeats, and zones whose strings must be looked at one by one. keep=False
        where no batch follows: the batch isn't taken in. Documents of later batches must stand behind those of
        earlier ones."""
        self._merge()
        array = suffix_array(docs).repartition(self.buckets, "key")
        scanned = merge_scan(array, [x for _, x in self.levels])
        if not keep:
            self.tables.append(materialise(scanned.where(_found()), "scan"))
            return self.tables[-1]
        level = Level(scanned.where(_new_in_level() | _found()), self.buckets)
        self.tables.append(level)
        self.levels.append((level.entries().count(), level.entries()))
        return level.table.where(_found())

    def drop(self) -> None:
        """Removes all tables, and with them what the scans found."""
        self.levels = []
        while self.tables:
            table = self.tables.pop()
            table.drop() if isinstance(table, Level) else discard(table)

    def _merge(self) -> None:
        """Merges the newest two levels while the older is less than twice the newer."""
        while len(self.levels) > 1 and self.levels[-2][0] < 2 * self.levels[-1][0]:
            (m, a), (n, b) = self.levels[-2:]
            marked = {"fresh": F.lit(True), "first": F.lit(True), "several": F.lit(False)}
            level = Level(a.unionByName(b).withColumns(marked), self.buckets)
            self.tables.append(level)
            self.levels[-2:] = [(m + n, level.entries())]


def zone_bytes(docs: DataFrame, opened: DataFrame) -> DataFrame:
    """(key, doc, at, zone): the bytes of the opened zones (columns key, doc, at)."""
    by_doc = opened.groupBy("doc", _variant()).agg(F.collect_set(F.struct("at", "key")).alias("zones"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, found in zip(batch["doc"], batch["text"], batch["zones"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                for zone in found:
                    at = zone["at"]
                    start, n = _start(at), at >> 4 & 255
                    out.append((zone["key"], doc, at, data[start : start + n + WIDTH - 1]))
            yield pd.DataFrame(out, columns=["key", "doc", "at", "zone"])

    return docs.join(by_doc, ["doc", "variant"]).select("doc", "text", "zones").mapInPandas(cut, "key long, doc long, at long, zone binary")


def _group_repeats(members: list) -> list[tuple[int, int]]:
    """The runs (doc, at) of strings of these zones that an earlier zone of the group, or string of the zone, has."""
    seen: set[bytes] = set()
    runs = []
    for doc, at, zone in sorted((m["doc"], m["at"], m["zone"]) for m in members):
        start, base = None, _start(at)
        count = len(zone) - WIDTH + 1
        for i in range(count + 1):
            known = i < count and (string := bytes(zone[i : i + WIDTH])) in seen
            if known and start is None:
                start = i
            elif not known and start is not None:
                runs.append((doc, _packed(at >> 43, base + start, i - start) | REPEAT))
                start = None
            if i < count and not known:
                seen.add(string)
    return runs


def _opened(found: DataFrame) -> DataFrame:
    """(key, doc, at) of the zones or parts that a scan leaves open; at without a kind."""
    opened = (_kind() == OPEN) | ((_kind() == ZONE) & F.col("several") & F.col("first"))
    key = F.when(_kind() == OPEN, F.col("content")).otherwise(F.col("key")).alias("key")
    return found.where(opened).select(key, "doc", (F.col("at") - _kind()).alias("at"))


def _late(found: DataFrame) -> DataFrame:
    """(doc, at) of what a scan found to be repeats."""
    return found.where((_kind() == REPEAT) | ((_kind() == ZONE) & ~F.col("first"))).select("doc", "at")


def string_repeats(zones_: DataFrame, step: int = STEP) -> DataFrame:
    """(doc, at): repeated strings within opened zones (key, doc, at, zone).

    Equal strings lie in zones of equal key. Keys of up to GROUP zones are settled key by key. The zones of larger ones
    are cut into parts of up to `step` strings, which share more bytes and so have finer keys: they are settled by block
    and by scan as zones are, and only those that stay open are looked at further, at last string by string.
    """
    sizes = zones_.groupBy("key").agg(F.count("*").alias("n"))
    sized = zones_.join(sizes, "key")
    groups = sized.where(F.col("n") <= GROUP).groupBy("key").agg(F.collect_list(F.struct("doc", "at", "zone")).alias("members"))

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([run for members in batch["members"] for run in _group_repeats(members)], columns=["doc", "at"], dtype="int64")

    def cut(zone: bytes, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, content, at, start within the zone) of its parts."""
        start, strings, key, content = parts_of(zone, step)
        return key, content, _packed(at >> 43, _start(at) + start.astype(np.int64), strings.astype(np.int64)), start

    def parts(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            for doc, at, zone in zip(batch["doc"], batch["at"], batch["zone"], strict=True):
                key, content, places, _ = cut(zone, at)
                yield key, content, doc, places

    def part_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, at, zone in zip(batch["doc"], batch["at"], batch["zone"], strict=True):
                key, _, places, start = cut(zone, at)
                for k, place, i in zip(key.view(np.int64), places, start, strict=True):
                    out.append((int(k), doc, int(place), zone[i : i + (place >> 4 & 255) + WIDTH - 1]))
            yield pd.DataFrame(out, columns=["key", "doc", "at", "zone"])

    small = groups.select("members").mapInPandas(settle, "doc long, at long")
    large = sized.where(F.col("n") > GROUP).select("doc", "at", "zone")
    if step == 1:
        return small.unionByName(_late(merge_scan(large.mapInPandas(lambda batches: _blocks(parts(batches), last=True), ROWS), [])))
    if large.isEmpty():
        return small
    found = materialise(merge_scan(large.mapInPandas(lambda batches: _blocks(parts(batches), last=False), ROWS), []), "parts")
    finer = large.mapInPandas(part_bytes, "key long, doc long, at long, zone binary").join(_opened(found).distinct(), ["key", "doc", "at"])
    return small.unionByName(_late(found)).unionByName(string_repeats(materialise(finer, "zones"), 1))


def repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc, at) rows, each a run of repeated strings; docs has doc (not null), variant and text.
    Each (doc, variant) is one row."""
    spark = docs.sparkSession
    bounds = docs.approxQuantile("doc", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    edges = [None, *sorted({int(x) for x in bounds}), None]
    family, found = SuffixLevels(int(spark.conf.get("spark.sql.shuffle.partitions"))), None
    for i, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        batch = docs.where((F.lit(True) if low is None else F.col("doc") > low) & (F.lit(True) if high is None else F.col("doc") <= high))
        scan = family.add(batch, keep=i < len(edges) - 2).select("key", "content", "doc", "at", "first", "several")
        found = scan if found is None else found.unionByName(scan)
    texts = materialise(zone_bytes(docs, _opened(found)), "zones")
    runs = _late(found).unionByName(string_repeats(texts))
    runs = materialise(runs.groupBy("doc", _variant()).agg(F.collect_set("at").alias("runs")), "runs")
    family.drop()
    discard(texts)
    return runs


def covered(data: bytes, packed: np.ndarray) -> np.ndarray:
    """For each byte whether one of these runs covers it."""
    start, n = _start(packed), packed >> 4 & 255
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + n - 1 + WIDTH, -1)
    return np.cumsum(edge[:-1]) > 0


def numbered(docs: DataFrame) -> DataFrame:
    """Adds doc and variant, one pair for each (doc_id, text), in the order of doc_id and of a text hash.

    Only rows that share a doc_id or have none need a number; the written table holds those alone, and is empty where
    doc_id is a key. Null ids begin at NO_DOC, VARIANTS of them to a number. Where a doc_id has more than VARIANTS texts all
    rows are numbered, whatever their doc_id.
    """
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_DOC)).alias("_id"), F.xxhash64("text").alias("_text"))
    shared = materialise(rows.groupBy("_id").agg(F.count("*").alias("n"), F.count("doc_id").alias("given")).where("n > 1 OR given < n").select("_id"), "shared")
    several = rows.join(shared, "_id").groupBy("_id", "_text").agg((F.count("doc_id") == 0).alias("_none")).withColumn("_one", F.lit(1))
    ranked = materialise(running_totals(several, ["_id"], ["_text"], "_one", "_rank").select("_id", "_text", "_none", "_rank"), "ranks")
    if ranked.where(~F.col("_none") & (F.col("_rank") >= VARIANTS)).isEmpty():
        doc = F.when(F.col("_none"), F.col("_id") + F.floor(F.col("_rank") / VARIANTS)).otherwise(F.col("_id"))
        ranked = ranked.select("_id", "_text", doc.cast("long").alias("_doc"), (F.col("_rank") % VARIANTS).alias("_variant"))
    else:  # a doc_id has more texts than there are variants: then every text gets a number of its own
        every = rows.select("_id", "_text", F.lit(0).alias("_all"), F.lit(1).alias("_one")).distinct()
        ranked = running_totals(every, ["_all"], ["_id", "_text"], "_one", "_doc").select("_id", "_text", F.col("_doc").cast("long"), F.lit(0).cast("long").alias("_variant"))
    ranked = materialise(ranked, "variants")
    keyed = docs.withColumns({"_id": F.coalesce("doc_id", F.lit(NO_DOC)), "_text": F.xxhash64("text")}).join(ranked, ["_id", "_text"], "left")
    return keyed.withColumns({"doc": F.coalesce("_doc", "_id"), "variant": F.coalesce("_variant", F.lit(0)).cast("long"), "_several": F.col("_doc").isNotNull()}).drop("_id", "_text", "_doc", "_variant")


def _cut_all(docs: DataFrame, batches: int) -> DataFrame:
    """doc_id, row (a struct of the other columns but text), had_text, n_bytes, n_removed, n_spans and kept."""
    bounded_batches(docs.sparkSession)
    others = [column(c).alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    keyed = numbered(docs.select("doc_id", "text", F.struct(*others or [F.lit(0)]).alias("row")))
    rows = keyed.select("doc", "variant", "text", "_several")
    once = rows.where("NOT _several").unionByName(rows.where("_several").dropDuplicates(["doc", "variant"])).drop("_several")
    runs = repeats(once, batches)

    def cut(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, found in series:
            out = []
            for text, packed in zip(texts, found, strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                if packed is None or not len(packed):
                    out.append((len(data), 0, 0, data))
                    continue
                gone = covered(data, np.asarray(packed, dtype=np.int64))
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                out.append((len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    cut_udf = F.pandas_udf(cut, "n_bytes long, n_removed long, n_spans long, kept binary")
    joined = keyed.join(runs, ["doc", "variant"], "left")
    return joined.select("doc_id", "row", F.col("text").isNotNull().alias("had_text"), cut_udf("text", "runs").alias("_cut")).select("doc_id", "row", "had_text", "_cut.*")


def without_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The documents with columns n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary: what stays).

    Null texts count as empty and lose nothing, like all texts under 100 bytes. A null doc_id stands before all
    others. Rows that share a doc_id are one document if their texts are equal (neither is then a repeat of the
    other); if not, they count as different ones in a fixed order. Other columns pass through, but for those with the
    name of a result, which the result replaces.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept"]
    given = [c for c in docs.columns if c not in ("text", *results)]
    value = lambda c: F.col("doc_id") if c == "doc_id" else F.col("row").getField(c).alias(c)
    return _cut_all(docs, batches).select(*map(value, given), *results)


def drop_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The documents with repeated passages cut out of their texts; what a cut leaves of a character goes too.
    Documents keep their row even if no text is left; a null text stays null. n_chars follows the text; all other
    columns stay as they are, whatever their names."""
    text = F.pandas_udf(lambda s: s.map(lambda x: x.decode("utf-8", "ignore")), "string")
    new = _cut_all(docs, batches).withColumn("text", F.when(F.col("had_text"), text("kept")))

    def value(c: str) -> Column:
        if c in ("doc_id", "text"):
            return F.col(c)
        old = F.col("row").getField(c)
        return (F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(old) if c == "n_chars" else old).alias(c)

    return new.select(*map(value, docs.columns))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
