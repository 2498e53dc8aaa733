"""Places of rows in an order, without one task for a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import staged

#: Low bits of ``monotonically_increasing_id``: the row's place in its partition.
_ROW = (1 << 33) - 1


def numbered(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``place`` (from 0 within ``group``, in ``order``) and ``n``
    (rows of the group).

    Rows are sorted by ranges of (group, order, place of reading), so a hot
    group and equal rows spread over many tasks, and written once.  What then
    crosses tasks is one row for each range and group: where it begins and how
    many rows it has."""
    spread = df.withColumn("_read", F.monotonically_increasing_id())
    keys = [group, *order, "_read"]
    ranged = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_read")
    ranged = staged(ranged.withColumn("_part", F.spark_partition_id())
                    .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW))), f"ranked-{name}")
    totals = ranged.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_group", "_of", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_ahead"),
                           F.sum("_rows").over(whole).alias("n"))
    found = ranged.join(totals, (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    return found.select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_ahead")).alias("place"), "n")
