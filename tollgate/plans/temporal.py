"""Joins and windows on time that keep no key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import chunked_running


def micros(ts: Column | str) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def _binned(intervals: DataFrame, start: str, end: str, bin_us: int) -> DataFrame:
    """A row for each bin that an interval [start, end) touches; empty ones have none."""
    first, last = F.floor(micros(start) / F.lit(bin_us)), F.floor((micros(end) - 1) / F.lit(bin_us))
    return intervals.where(F.col(end) > F.col(start)).withColumn("_bin", F.explode(F.sequence(first, last)))


def interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str, start: str, end: str,
                  bin_seconds: int, how: str = "inner") -> DataFrame:
    """Points with every interval [start, end) of the same keys they lie in.

    An interval is copied to the bins it touches and a point has one bin, so
    this is an equi-join on (keys, bin) with the rest as a residual condition:
    no nested loop, and a hot key is spread over its bins.  Bins of about an
    interval's length copy it two or three times.  NULL keys and times match
    nothing.  ``how`` is any join type that keeps the left side's columns."""
    b = _binned(intervals, start, end, bin_seconds * 1_000_000)
    b = b.withColumnsRenamed({k: f"_i_{k}" for k in keys})
    p = points.withColumn("_point_bin", F.floor(micros(ts) / F.lit(bin_seconds * 1_000_000)))
    cond = [F.col(k) == F.col(f"_i_{k}") for k in keys]
    cond += [F.col("_point_bin") == F.col("_bin"), F.col(ts) >= F.col(start), F.col(ts) < F.col(end)]
    return p.join(b, cond, how).drop("_point_bin", "_bin", *[f"_i_{k}" for k in keys])


def in_any_interval(points: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str, start: str, end: str,
                    bin_seconds: int, out: str) -> DataFrame:
    """Every point once, with whether some interval of its keys holds it.  The
    intervals of one bin stand together in one row."""
    b = _binned(intervals, start, end, bin_seconds * 1_000_000)
    b = b.groupBy(*[F.col(k).alias(f"_i_{k}") for k in keys], "_bin").agg(F.collect_set(F.struct(F.col(start).alias("a"), F.col(end).alias("b"))).alias("_all"))
    p = points.withColumn("_point_bin", F.floor(micros(ts) / F.lit(bin_seconds * 1_000_000)))
    cond = [F.col(k) == F.col(f"_i_{k}") for k in keys] + [F.col("_point_bin") == F.col("_bin")]
    found = F.exists("_all", lambda i: (F.col(ts) >= i["a"]) & (F.col(ts) < i["b"]))
    return p.join(b, cond, "left").withColumn(out, F.coalesce(found, F.lit(False))).select(*points.columns, out)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, right_ts: str, values: Sequence[str],
              chunk_seconds: int = 86_400) -> DataFrame:
    """``left`` with the ``values`` of the last ``right`` row of the same keys at
    or before ``ts`` (NULL if there is none; of several at one time the
    greatest values).

    Both sides become one table in time order; the last value is carried by
    a running maximum over chunks of time, so a key costs as many tasks as it
    has chunks.  NULL keys are a key of their own."""
    inner = [F.col(k) for k in keys]
    a = left.select(*inner, micros(ts).alias("_us"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    value = F.struct(micros(right_ts).alias("us"), *[F.col(v) for v in values])
    b = right.select(*inner, micros(right_ts).alias("_us"), F.lit(0).alias("_side"), value.alias("_value"))
    both = a.unionByName(b, allowMissingColumns=True)
    carried = chunked_running(both, keys, ["_us", "_side"], F.floor(F.col("_us") / F.lit(chunk_seconds * 1_000_000)), F.col("_value"), "max", "_last")
    return carried.where("_side = 1").select("_row.*", *[F.col("_last")[v].alias(v) for v in values])


def rolling_count(df: DataFrame, key: str, ts: str, seconds: int, out: str, subs: int = 60) -> DataFrame:
    """``df`` with the number of the key's rows in the ``seconds`` up to and
    with each row: those later than ``ts - seconds``, rows of the same time
    among them.

    Time is cut into ``subs`` buckets a window.  Whole buckets are summed over
    a range frame on one row for each key and bucket, itself cut into chunks;
    the bucket that the window's edge cuts is corrected by the rows of it that
    are already out, which meet the row in its own bucket one window later.  So
    a task holds one bucket of a key, or a chunk of its buckets, never a key."""
    width = seconds * 1_000_000 // subs
    slim = df.select(F.col(key).alias("_key"), micros(ts).alias("_us"))
    own = df.select(F.col(key).alias("_key"), micros(ts).alias("_us"), F.struct(*df.columns).alias("_row"), F.lit(1).alias("_own"))
    gone = slim.withColumn("_us", F.col("_us") + subs * width).withColumn("_own", F.lit(0))
    both = own.unionByName(gone, allowMissingColumns=True).withColumn("_sub", F.floor(F.col("_us") / F.lit(width)))
    upto = Window.partitionBy("_key", "_sub").orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = both.withColumn("_near", F.sum(F.col("_own") * 2 - 1).over(upto)).where("_own = 1")

    totals = slim.withColumn("_sub", F.floor(F.col("_us") / F.lit(width))).groupBy("_key", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    chunk = 64 * subs
    at = F.floor(F.col("_sub") / F.lit(chunk))
    copies = F.when(F.col("_sub") - at * chunk >= chunk - subs, F.array(at, at + 1)).otherwise(F.array(at))
    spread = totals.withColumn("_home", at).withColumn("_chunk", F.explode(copies))
    before = Window.partitionBy("_key", "_chunk").orderBy("_sub").rangeBetween(-subs, -1)
    sums = spread.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where("_home = _chunk")
    sums = sums.select(F.col("_key").alias("_k"), F.col("_sub").alias("_s"), "_before")
    found = near.join(sums, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_sub") == F.col("_s")))
    return found.select("_row.*", (F.col("_near") + F.col("_before")).cast("long").alias(out))
