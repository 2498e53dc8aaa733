"""Routed outputs: one table, partitioned by decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_routed(df: DataFrame, path: str, decision: str = "decision") -> None:
    """Write ``allow`` / ``block`` / ``error`` rows into ``decision=...``
    partitions of one parquet table; readers prune to the partition they
    need.  ``path`` belongs to one run (or one input slice): a rerun replaces
    all of it, so a row whose decision has changed is not left behind in its
    old partition.  A row without a decision goes to ``error``."""
    routed = df.withColumn(decision, F.coalesce(F.col(decision), F.lit("error")))
    (routed.write.mode("overwrite")
     .option("partitionOverwriteMode", "static")
     .partitionBy(decision).parquet(path))
