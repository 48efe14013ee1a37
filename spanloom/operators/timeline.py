"""Windows along time without a task that holds a whole recording.

A window over (keys) in order of time would bring all rows of a key into one task. Here rows are windowed within time
buckets, and what a bucket needs to know of the ones around it comes from a table of one row a bucket: sums, maxima, last
and first rows. Only that small table is windowed by key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.sources.scratch import settled

#: Width of the buckets in microseconds.
BUCKET_US = 600_000_000


def before_sum(x: Column | str) -> tuple[str, Column]:
    """Sum over the rows before; 0 at first."""
    return "sum", F.coalesce(_column(x), F.lit(0))


def upto_sum(x: Column | str) -> tuple[str, Column]:
    """Sum over the rows before and this one."""
    return "upto", F.coalesce(_column(x), F.lit(0))


def before_max(x: Column | str) -> tuple[str, Column]:
    """Maximum over the rows before; null at first."""
    return "max", _column(x)


def previous(x: Column | str) -> tuple[str, Column]:
    """Value of the row before, null at first; a struct of several columns comes at once."""
    return "lag", F.struct(_column(x).alias("v"))


def following(x: Column | str) -> tuple[str, Column]:
    """Value of the next row, null at last."""
    return "lead", F.struct(_column(x).alias("v"))


def latest(x: Column | str) -> tuple[str, Column]:
    """Last value that isn't null, this row's included."""
    return "last", _column(x)


def upcoming(x: Column | str) -> tuple[str, Column]:
    """First value that isn't null among the rows behind this one."""
    return "next", _column(x)


def place() -> tuple[str, Column]:
    """Number of the rows before."""
    return "sum", F.lit(1).cast("long")


def run_number(x: Column | str) -> tuple[str, Column]:
    """Number of the run of equal values that the row is in, from 1."""
    return "run", F.struct(_column(x).alias("v"))


def island(gap: int = 0, start: str = "start_us", end: str = "end_us") -> tuple[str, Column]:
    """Start of the row's island: of the last row so far that begins more than `gap` behind the end of all rows before it.
    order has to begin with `start`."""
    return "island", F.struct(F.col(start).alias("s"), (F.col(end) + gap).alias("e"))


def _column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def along(rows: DataFrame, keys: Sequence[str], order: Sequence[str], at: str = "start_us", width: int = BUCKET_US, cheap: bool = False, **outs: tuple[str, Column]) -> DataFrame:
    """Adds the columns `outs`, each of one of the functions above, over the rows of equal keys in order.

    order must begin with `at`, a number; it has to tell rows apart, else rows alike in it come in any order, as in a
    window. Rows with a null key are a group of their own. `cheap`: the rows are a table's, or nearly so, and needn't be
    written before they are read twice.
    """
    rows = rows if cheap else settled(rows)
    x = {n: f"_x_{n}" for n in outs}
    # a struct is equal to another one with the same nulls, so one column deals out windows and joins alike
    named = rows.withColumns({x[n]: c for n, (_, c) in outs.items()}).withColumn("_k", F.struct(*[F.col(k).alias(k) for k in keys], F.floor(F.col(at) / width).alias("_bucket")))
    inside = Window.partitionBy("_k").orderBy(*order)
    ahead, upto, behind = (inside.rowsBetween(*r) for r in ((Window.unboundedPreceding, -1), (Window.unboundedPreceding, 0), (1, Window.unboundedFollowing)))
    place_, zero = F.struct(*order), F.lit(0)
    # within its bucket alone: whether a row starts a run or an island, null if the first row of a run's bucket can't tell
    fresh = {
        "run": lambda n: F.when(F.lag(x[n]).over(inside).isNotNull(), (~F.lag(x[n]).over(inside).eqNullSafe(F.col(x[n]))).cast("int")),
        "island": lambda n: F.when(F.coalesce(F.col(f"{x[n]}.s") > F.max(f"{x[n]}.e").over(ahead), F.lit(True)), F.col(f"{x[n]}.s")),
    }
    named = named.withColumns({f"_f_{n}": fresh[kind](n) for n, (kind, _) in outs.items() if kind in fresh})

    summaries = {
        "sum": lambda n: [F.sum(x[n])], "upto": lambda n: [F.sum(x[n])], "max": lambda n: [F.max(x[n])],
        "lag": lambda n: [F.max_by(x[n], place_)], "lead": lambda n: [F.min_by(x[n], place_)],
        "last": lambda n: [F.max_by(x[n], F.when(F.col(x[n]).isNotNull(), place_))], "next": lambda n: [F.min_by(x[n], F.when(F.col(x[n]).isNotNull(), place_))],
        "run": lambda n: [F.coalesce(F.sum(f"_f_{n}"), zero), F.min_by(x[n], place_), F.max_by(x[n], place_)],
        "island": lambda n: [F.max(f"{x[n]}.e"), F.max(f"_f_{n}")],
    }
    sums = named.groupBy("_k").agg(*[c.alias(f"_b{i}_{n}") for n, (kind, _) in outs.items() for i, c in enumerate(summaries[kind](n))])
    by = Window.partitionBy(*[f"_k.{k}" for k in keys]).orderBy("_k._bucket")
    earlier, now, later = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(1, Window.unboundedFollowing)
    for n, (kind, _) in outs.items():
        if kind == "run":  # the bucket's first row starts a run unless the bucket before ends with its value
            sums = sums.withColumn(f"_b3_{n}", (~F.lag(f"_b2_{n}").over(by).eqNullSafe(F.col(f"_b1_{n}"))).cast("int"))
        if kind == "island":  # the last start within the bucket is the last of all if any is: the ones before it are smaller
            sums = sums.withColumn(f"_b2_{n}", F.max(f"_b0_{n}").over(earlier))
            sums = sums.withColumn(f"_b3_{n}", F.when(F.coalesce(F.col(f"_b1_{n}") > F.col(f"_b2_{n}"), F.lit(True)), F.col(f"_b1_{n}")))
    total = lambda b: F.sum(b).over(earlier)
    carry = {
        "sum": lambda n: [total(f"_b0_{n}")], "upto": lambda n: [total(f"_b0_{n}")], "max": lambda n: [F.max(f"_b0_{n}").over(earlier)],
        "lag": lambda n: [F.lag(f"_b0_{n}").over(by)], "lead": lambda n: [F.lead(f"_b0_{n}").over(by)],
        "last": lambda n: [F.last(f"_b0_{n}", ignorenulls=True).over(earlier)], "next": lambda n: [F.first(f"_b0_{n}", ignorenulls=True).over(later)],
        "run": lambda n: [F.coalesce(total(f"_b0_{n}"), zero) + F.sum(f"_b3_{n}").over(now)],
        "island": lambda n: [F.col(f"_b2_{n}"), F.max(f"_b3_{n}").over(earlier)],
    }
    joined = named.join(sums.select("_k", *[c.alias(f"_c{i}_{n}") for n, (kind, _) in outs.items() for i, c in enumerate(carry[kind](n))]), "_k")

    def out(n: str, kind: str) -> Column:
        c = F.col(f"_c0_{n}")
        if kind in ("sum", "upto"):
            return F.coalesce(F.sum(x[n]).over(ahead if kind == "sum" else upto), zero) + F.coalesce(c, zero)
        if kind == "max":
            return F.greatest(F.max(x[n]).over(ahead), c)
        if kind == "next":
            return F.coalesce(F.first(x[n], ignorenulls=True).over(behind), c)
        if kind == "last":
            return F.coalesce(F.last(x[n], ignorenulls=True).over(upto), c)
        if kind == "run":
            return c + F.coalesce(F.sum(f"_f_{n}").over(upto), zero)
        if kind == "island":
            start = F.when(F.coalesce(F.col(f"_f_{n}") > c, F.col(f"_f_{n}").isNotNull()), F.col(f"_f_{n}"))
            return F.coalesce(F.max(start).over(upto), F.col(f"_c1_{n}"))
        near = (F.lag if kind == "lag" else F.lead)(x[n]).over(inside)
        return F.coalesce(near, c)["v"]

    found = joined.withColumns({n: out(n, kind) for n, (kind, _) in outs.items()})
    return found.select(*[c for c in rows.columns if c not in outs], *outs)
