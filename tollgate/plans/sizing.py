"""Where rows are spread, and what may be pushed down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Spread an input before regex work only if it has at most 1/SPREAD_FACTOR
# as many partitions as the cluster has cores.
SPREAD_FACTOR = 2


def spread_for_cpu(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread rows over the cluster before CPU-heavy per-row work (regex).

    A scan of one large parquet row group is a single task; regex detectors
    on it would run on one core.  (Spark still reports one byte-range split
    per few MB of the file, all but one of them empty, so the partition count
    overstates the parallelism.)  When the input would keep at most half of
    the cluster's cores busy, rows are redistributed round-robin (a cheap
    shuffle next to the regex work).  A large input already yields about as
    many splits as cores or more, and is never shuffled just to gain a few
    more tasks.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() * SPREAD_FACTOR > target:
            return df
    except Exception:  # noqa: BLE001 -- no RDD API (e.g. Spark Connect): keep the scan's split
        return df
    return df.repartition(target)


def barrier(df: DataFrame) -> DataFrame:
    """The same rows, with nothing pushed below this point.

    A report that filters on columns of an expensive projection (regex
    findings, parsed JSON) would otherwise have the filter, or a constraint
    inferred from a join, copied below it, evaluating the projection twice.
    Filters on the columns of a generator cannot move below the generator, so
    every row passes through one that makes exactly one row of it: narrow, and
    nothing is written."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))
