"""Skew-tolerant running aggregates.

A plain ``Window.partitionBy(key).orderBy(t)`` puts every row of a key in
one task; when one endpoint or conversation holds a third of the data, that
task is the job.  :func:`chunked_running` splits each key into chunks of the
ordering column, computes the running aggregate inside each chunk (bounded
tasks), aggregates whole chunks (a small table: one row per key and chunk),
carries the chunk totals forward, and adds them back with one join on
``(key, chunk)``.  The big side is shuffled once, by ``(key, chunk)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunked_running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    chunk: Column, value: Column, how: str, out: str) -> DataFrame:
    """Running ``sum`` or ``max`` of ``value`` per ``keys`` in ``order``
    (inclusive of the current row).

    ``chunk`` must be monotone in ``order`` within a key (e.g. the hour of a
    timestamp, or ``turn div 4096``).  ``max`` works on any orderable type,
    including structs, and ignores NULLs.
    """
    agg = {"sum": F.sum, "max": F.max}[how]
    keys = list(keys)
    d = df.withColumn("_chunk", chunk).withColumn("_val", value)
    w_local = (Window.partitionBy(*keys, "_chunk").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = d.withColumn("_local", agg("_val").over(w_local))
    # Chunk totals are a partial aggregate over the (column-pruned) input:
    # one row per key, chunk and map task crosses the shuffle.
    totals = d.groupBy(*keys, "_chunk").agg(agg("_val").alias("_chunk_total"))
    w_prev = (Window.partitionBy(*keys).orderBy("_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = totals.withColumn("_carry", agg("_chunk_total").over(w_prev)).drop("_chunk_total")
    # Null-safe: rows without a key are one group, as in the windows.
    names = [*keys, "_chunk"]
    carry = carry.withColumnsRenamed({k: f"_c_{k}" for k in names})
    cond = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in names]
    j = local.join(carry, cond, "left").drop(*[f"_c_{k}" for k in names])
    if how == "sum":
        res = F.coalesce(F.col("_carry"), F.lit(0)) + F.coalesce(F.col("_local"), F.lit(0))
    else:
        res = F.greatest(F.col("_carry"), F.col("_local"))
    return j.withColumn(out, res).drop("_chunk", "_val", "_local", "_carry")


def chunked_prefixes(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
                     values: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Several running aggregates at once: ``values`` names each new column
    with ``sum``, ``min`` or ``max`` and what it runs over.

    As :func:`chunked_running`, but rows are dealt to (key, chunk) once and the
    chunk totals are taken from that same exchange, so an expensive ``df``
    (detectors) is evaluated once."""
    aggs = {"sum": F.sum, "min": F.min, "max": F.max}
    both = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "min": F.least, "max": F.greatest}
    keys, names = list(keys), [*keys, "_chunk"]
    valued = df.withColumn("_chunk", chunk).withColumns({f"_v_{n}": v for n, (_, v) in values.items()})
    # One struct, opened by a generator: neither use can prune it, so both read
    # the same exchange.
    packed = valued.select(*names, F.struct(*[c for c in valued.columns if c not in names]).alias("_r")).repartition(*names)
    dealt = packed.select(*names, F.inline(F.array("_r")))
    local = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = dealt.withColumns({f"_l_{n}": aggs[how](f"_v_{n}").over(local) for n, (how, _) in values.items()})
    totals = dealt.groupBy(*names).agg(*[aggs[how](f"_v_{n}").alias(f"_t_{n}") for n, (how, _) in values.items()])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*[F.col(k).alias(f"_c_{k}") for k in names], *[aggs[how](f"_t_{n}").over(before).alias(f"_a_{n}") for n, (how, _) in values.items()])
    cond = [rows[k].eqNullSafe(carry[f"_c_{k}"]) for k in names]
    return rows.join(carry, cond, "left").select(*df.columns, *[both[how](F.col(f"_a_{n}"), F.col(f"_l_{n}")).alias(n) for n, (how, _) in values.items()])
