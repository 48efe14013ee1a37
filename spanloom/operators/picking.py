"""Filters on turns and files, picks and batches, and the relational parts of reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators import cuts
from spanloom.operators.timeline import along, run_number

def _length() -> Column:
    return F.col("end_us") - F.col("start_us")


def hashed(seed: object, key: str) -> Column:
    """Order of a seeded shuffle: the same on every run and for every partitioning."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))


# --- filters ---


def speaker_filter(turns: DataFrame, similarity: str, least: float, least_us: int, overlapping: bool) -> DataFrame:
    """Turns of enough similarity (a missing one counts as -1) and length; with overlap only if `overlapping`."""
    kept = turns.where((F.coalesce(similarity, F.lit(-1.0)) >= least) & (_length() >= least_us))
    return kept if overlapping else kept.where(~F.col("overlap"))


def inherit(local: DataFrame, shared: DataFrame, key: str, appended: Sequence[str], united: Sequence[str], replaced: Sequence[str]) -> DataFrame:
    """Settings of a source with those of all: lists of patterns follow each other, ids are united, and single values are
    the source's where it has them."""
    general = shared.select(key, *[F.col(c).alias(f"_g_{c}") for c in (*appended, *united, *replaced)])
    both = local.join(general, key, "left")
    empty = lambda c: F.coalesce(c, F.array())
    out = {c: F.concat(empty(F.col(f"_g_{c}")), empty(F.col(c))) for c in appended}
    out |= {c: F.array_union(empty(F.col(f"_g_{c}")), empty(F.col(c))) for c in united}
    out |= {c: F.coalesce(F.col(c), F.col(f"_g_{c}")) for c in replaced}
    return both.withColumns(out).select(*local.columns)


def finite_intervals(rows: DataFrame, start: Column, length: Column) -> DataFrame:
    """Adds start_s and end_s; rows whose text isn't a finite number, or that have no length, are left out."""
    number = lambda c: c.cast("string").try_cast("double")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    cast = rows.withColumn("start_s", number(start)).withColumn("_l", number(length))
    return cast.where(finite(F.col("start_s")) & finite(F.col("_l")) & (F.col("_l") > 0)).withColumn("end_s", F.col("start_s") + F.col("_l")).drop("_l")


def turn_error(length_us: int) -> Column:
    """What is wrong with a turn, the first of several; `valid` if nothing is."""
    return (
        F.when(F.col("start_us") < 0, "negative_start").when(F.col("end_us") <= F.col("start_us"), "empty").when(F.col("end_us") > length_us, "past_end")
        .when(F.coalesce(F.trim("speaker_id"), F.lit("")) == "", "no_speaker").otherwise("valid")
    )


def strict(turns: DataFrame, length_us: int) -> DataFrame:
    """The turns; an invalid one is an error when they are read."""
    error = turn_error(length_us)
    return turns.where(F.when(error == "valid", F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("turn: "), error)).cast("boolean")))


def valid_words(words: DataFrame) -> DataFrame:
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    return words.where(finite("start") & finite("end") & (F.col("start") >= 0) & (F.col("start") < F.col("end")))


def eligible(turns: DataFrame, least_us: int, most_us: int) -> DataFrame:
    """Turns without overlap that have a clip and a length within both limits."""
    return turns.where(~F.col("overlap") & F.col("clip").isNotNull() & _length().between(least_us, most_us))


def anchors(rows: DataFrame, datasets: Sequence[str], least: float, most: float) -> DataFrame:
    """Rows of the datasets with text, no screening flag and a duration within both limits."""
    return rows.where(F.col("duration_s").between(least, most) & (F.trim("text") != "") & (F.size("screen_flags") == 0) & F.col("dataset").isin(list(datasets)))


def is_verdict(body: str) -> Column:
    """Whether a JSON text is a verdict: its operation is `verify`, or it has a verdict that isn't null."""
    whole = F.get_json_object(body, "$").isNotNull()
    return F.coalesce(whole & ((F.get_json_object(body, "$.operation") == "verify") | F.get_json_object(body, "$.verdict").isNotNull()), F.lit(False))


def drop_stage_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Leaves out columns that only hold for the stage before, as far as rows have them."""
    return rows.drop(*columns)


def with_defaults(rows: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Adds columns that rows lack, as null."""
    return rows.withColumns({n: F.lit(None).cast(k) for n, k in kinds.items() if n not in rows.columns})


def pruned(path: str, names: Sequence[str]) -> Column:
    """Whether a path leads through a hidden folder or one of these names."""
    return F.col(path).rlike(r"(^|/)(\.[^/]*|" + "|".join(names) + r")(/|$)")


def pending(wanted: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What has no valid result yet; failed results (valid is false or null) are done again."""
    return wanted.join(done.where("valid").select(*keys), list(keys), "left_anti")


def completion(wanted: DataFrame, done: DataFrame, key: str, request: str) -> DataFrame:
    """(key, action): skip where a result of the same request stands, conflict where one of another does, else run."""
    found = done.groupBy(key).agg(F.collect_set(request).alias("_done"))
    action = F.when(F.col("_done").isNull(), "run").when(F.array_contains("_done", F.col(request)), "skip").otherwise("conflict")
    return wanted.join(found, key, "left").select(key, action.alias("action"))


# --- picks ---


def by_priority(sources: DataFrame, priority: str, name: str, default: int) -> DataFrame:
    """Sources with their place by (priority, name); there is a row a source."""
    level = sources.withColumn(priority, F.coalesce(F.col(priority), F.lit(default)))
    return level.withColumn("place", F.row_number().over(Window.orderBy(priority, name)))


def capped(rows: DataFrame, source: str, order: str, per_source: int, most: int) -> DataFrame:
    """The first rows of each source, at most `most` in all by source, and whether that left some out."""
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy(source).orderBy(order))).where(F.col("_n") <= per_source)
    counts = first.groupBy(source).agg(F.count("*").alias("_c"))
    ahead = F.coalesce(F.sum("_c").over(Window.orderBy(source).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = counts.select(source, ahead.alias("_before"), F.sum("_c").over(Window.partitionBy()).alias("_all"))
    return first.join(totals, source).where(F.col("_before") + F.col("_n") <= most).select(*rows.columns, (F.col("_all") > most).alias("truncated"))


def capped_round_robin(rows: DataFrame, stratum: str, speaker: str, row_id: str, per_speaker: int, n: int) -> DataFrame:
    """(row_id, stratum, speaker, place): n rows, the strata taking turns by name, each its next row in hashed order whose speaker
    hasn't per_speaker picks yet, in whatever strata.

    Picks depend on all before, but only few rows can be picked: of a stratum and speaker the first per_speaker, and of those
    of a stratum the first 2 * n, as at most n of them are passed over. Those alone are walked.
    """
    order = [F.md5(F.col(row_id).cast("string").cast("binary")), F.col(row_id)]
    few = rows.select(row_id, stratum, speaker, F.row_number().over(Window.partitionBy(stratum, speaker).orderBy(*order)).alias("_n")).where(F.col("_n") <= per_speaker)
    few = few.withColumn("_n", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).where(F.col("_n") <= 2 * n)

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([stratum, "_n"])
        queues = {name: list(q.index[::-1]) for name, q in rows.groupby(stratum, sort=True, dropna=False)}
        picks, of = [], {}
        while len(picks) < n and any(queues.values()):
            for queue in queues.values():
                while queue and len(picks) < n:
                    at = queue.pop()
                    who = rows.at[at, speaker]
                    if of.get(who, 0) < per_speaker:
                        of[who] = of.get(who, 0) + 1
                        picks.append(at)
                        break
        return rows.loc[picks, [row_id, stratum, speaker]].assign(place=range(len(picks)))

    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"{c} {kinds[c]}" for c in (row_id, stratum, speaker)], "place int"])
    return few.groupBy(F.lit(0).alias("_all")).applyInPandas(walk, schema)


def picks_without_reuse(rows: DataFrame, spec: Sequence[tuple[str, int]], seed: str) -> DataFrame:
    """(stratum, anchor, doc_id): for each (stratum, n) of spec in turn the first n anchors in seeded order that have a row there
    and weren't picked before, with their row of the least doc_id; an error if there are fewer. Each turn sees all picks of the
    ones before, which are as many as spec asks for."""
    spark, used, picks = rows.sparkSession, [], []
    for stratum, n in spec:
        pool = rows.where(F.col("stratum") == stratum).groupBy("anchor").agg(F.min("doc_id").alias("doc_id"))
        free = pool.where(~F.col("anchor").isin(used)) if used else pool
        found = free.orderBy(F.md5(F.concat_ws(":", F.lit(seed), "anchor").cast("binary")), "anchor").limit(n).collect()
        if len(found) < n:
            raise ValueError(f"fewer than {n} anchors are left for {stratum}")
        used += [r.anchor for r in found]
        picks += [(stratum, r.anchor, r.doc_id) for r in found]
    kinds = dict(rows.dtypes)
    return spark.createDataFrame(picks, f"stratum string, anchor {kinds['anchor']}, doc_id {kinds['doc_id']}")


def sample_per(rows: DataFrame, key: str, row_id: str, n: int, seed: object) -> DataFrame:
    """n rows of each key, by seeded hash."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(hashed(seed, row_id)))).where(F.col("_n") <= n).drop("_n")


def batches(rows: DataFrame, key: str, row_id: str, size: int, seed: object) -> DataFrame:
    """Adds batch, `size` rows of a key each in shuffled order, rows without an id behind all others."""
    order = F.when(F.col(row_id).isNotNull(), hashed(seed, row_id)).asc_nulls_last()
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1) / size))


def packed(rows: DataFrame, key: str, order: str, most_bytes: int, most_rows: int) -> DataFrame:
    """(key, order, batch): rows (with bytes) in order, in batches of at most most_bytes and most_rows; a larger row is a
    batch of its own. order is a number that tells a key's rows apart."""
    grouped = cuts.pack(rows.select(key, order, "bytes"), [key], [order], order, "bytes", most_bytes, most_rows, 1 << 16)
    batches = along(grouped, [key], ["place"], at="place", width=cuts.BLOCK, batch=run_number("group"))
    return batches.select(key, order, (F.col("batch") - 1).cast("long").alias("batch"))


# --- reports ---


def split_leaks(rows: DataFrame, split: str, keys: Sequence[str]) -> DataFrame:
    """(key, value, splits): what occurs in more than one split, for each of the keys."""
    long = rows.unpivot([split], list(keys), "key", "value")
    return long.groupBy("key", "value").agg(F.count_distinct(split).alias("splits")).where("splits > 1")


def short_id(key: str, seed: str) -> Column:
    """Eight digits of a seeded hash, which several keys may share; see review_ids()."""
    return F.substring(F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")), 256), 1, 8)


def review_ids(rows: DataFrame, key: str, seed: str) -> DataFrame:
    """Adds review_id: eight digits of a seeded hash, with the key behind them where they are not the only ones."""
    named = rows.withColumn("_s", short_id(key, seed))
    again = named.groupBy("_s").agg(F.count("*").alias("_n"))
    full = F.when(F.col("_n") > 1, F.concat_ws("-", "_s", F.col(key).cast("string"))).otherwise(F.col("_s"))
    return named.join(again, "_s").withColumn("review_id", full).select(*rows.columns, "review_id")


def ledger_rows(files: DataFrame, known: DataFrame) -> DataFrame:
    """(path, sha256) of the files (path, content) that the ledger hasn't yet."""
    return files.join(known.select("path"), "path", "left_anti").select("path", F.sha2("content", 256).alias("sha256"))


def enrol(clips: DataFrame, taken: DataFrame, speaker: str, order: str, digest: str) -> DataFrame:
    """Numbers each speaker's new clips, after the last number taken (speaker, last), and names them clip_001, ..., with more
    digits from 1000 on; copies of a clip are enrolled once."""
    once = clips.groupBy(speaker, digest).agg(F.min(order).alias(order))
    number = F.row_number().over(Window.partitionBy(speaker).orderBy(F.col(order).asc_nulls_last())) + F.coalesce("last", F.lit(0))
    return once.join(F.broadcast(taken), speaker, "left").select(speaker, order, number.alias("number"), F.format_string("clip_%03d", number).alias("name"))


def first_given(*columns: Column) -> Column:
    """The first that isn't blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def outcomes(steps: DataFrame, key: str, most: int) -> DataFrame:
    """(key, outcome, attempts) from steps: complete once a step is, failed after `most` failed ones, else pending."""
    failed = F.count_if(F.col("step") == "failed")
    outcome = F.when(F.bool_or(F.col("step") == "complete"), "complete").when(failed >= most, "failed").otherwise("pending")
    return steps.groupBy(key).agg(outcome.alias("outcome"), failed.alias("attempts"))


def clip_records(rows: DataFrame) -> DataFrame:
    """(key, kind, length): every clip as anchor and as tight twin (its edges off), rejected ones as defect too."""
    kinds = F.when(F.col("candidate") == "reject", F.array(*map(F.lit, ("anchor", "twin", "defect")))).otherwise(F.array(*map(F.lit, ("anchor", "twin"))))
    each = rows.withColumn("kind", F.explode(kinds))
    length = F.when(F.col("kind") == "anchor", F.col("n_chars")).when(F.col("kind") == "twin", F.col("n_chars") - 2).otherwise(F.floor(F.col("n_chars") / 2))
    return each.select("key", "kind", length.alias("length"))


def word_ends(turns: DataFrame, words: DataFrame) -> DataFrame:
    """By turn how far its last word reaches past its end: cut, exact or slack."""
    from spanloom.operators import intervals as I

    met = I.range_join(turns, I.other(words), ["recording_id"]).groupBy("recording_id", "turn_index").agg((F.max("b_end_us") - F.max("end_us")).alias("past_us"))
    return met.withColumn("verdict", F.when(F.col("past_us") > 0, "cut").when(F.col("past_us") == 0, "exact").otherwise("slack"))


def paired(reference: DataFrame, hypothesis: DataFrame) -> DataFrame:
    """(recording_id, status, reference_turns, hypothesis_turns) over the recordings of both sides."""
    count = lambda t, n: t.groupBy("recording_id").agg(F.count("*").alias(n))
    both = count(reference, "reference_turns").join(count(hypothesis, "hypothesis_turns"), "recording_id", "full")
    status = F.when(F.col("reference_turns").isNull(), "hypothesis_only").when(F.col("hypothesis_turns").isNull(), "reference_only").otherwise("paired")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return both.select("recording_id", status.alias("status"), zero("reference_turns"), zero("hypothesis_turns"))
