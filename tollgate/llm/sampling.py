"""Bounded, reproducible samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def labelled_sample(rows: DataFrame, label: str, rows_in_all: int) -> tuple[list, DataFrame]:
    """(labels, about ``rows_in_all`` rows, the same number for each label and
    one at least).

    ``rows`` has ``doc_id`` and a non-NULL ``label``.  Rows are taken by a hash
    of doc_id.  The share that is let through before the ranking is set from
    the label's count, so that a label's window meets about twice the rows it
    keeps however large the table is.  Column ``u`` is the rank's hash."""
    counts = rows.groupBy(label).count().orderBy(label).collect()
    labels = sorted(r[label] for r in counts)
    if not labels:
        return [], rows.limit(0).withColumn("u", F.lit(0.0))
    each = max(1, rows_in_all // len(labels))
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col(label) == F.lit(r[label]), F.lit(min(1.0, (2 * each + 50) / r["count"]))).otherwise(share)
    unit = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("sample")), 11) / F.lit(float(1 << 53))
    let = rows.withColumn("u", unit).where(F.col("u") < share)
    rank = F.row_number().over(Window.partitionBy(label).orderBy("u", "doc_id"))
    return labels, let.withColumn("rank", rank).where(F.col("rank") <= each).drop("rank")
