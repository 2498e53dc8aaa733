"""Local gates that answer before any detector runs: empty and oversize."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import MAX_CONTENT_CHARS, is_blank

# FIXED VALUES: reasons of the empty gate, per client family.
EMPTY_REASON_CHAT = "No user content to scan"
EMPTY_REASON_GEMINI = "No text content to scan"


def gate_empty(df: DataFrame, col: str = "payload", reason: str = EMPTY_REASON_CHAT) -> DataFrame:
    """Blank text (Python ``str.strip()`` semantics) -> safe, scan skipped."""
    blank = F.coalesce(is_blank(F.col(col)), F.lit(False))
    return (df.withColumn("is_empty", blank)
            .withColumn("empty_reason", F.when(blank, F.lit(reason))))


def size_total(content: Column, context: Column | None = None) -> Column:
    """Characters (code points) of content plus a non-empty context."""
    total = F.coalesce(F.length(content), F.lit(0))
    if context is not None:
        total = total + F.coalesce(F.length(F.nullif(context, F.lit(""))), F.lit(0))
    return total.cast("long")


def gate_size(df: DataFrame, content: str | Column = "payload", context: str | Column | None = None,
              max_chars: int = MAX_CONTENT_CHARS, total_col: str | None = None) -> DataFrame:
    """Oversize content -> local unsafe verdict (strict ``>``).

    The verdict skips normalisation: numeric confidence 1.0, threat type
    ``size_limit_exceeded`` and one ``size_limit`` violation.  Sizes in the
    reason are floor-divided by 1024.  ``total_col`` may name a column that
    already holds the exact size (e.g. ``payload_chars``).
    """
    c = F.col(content) if isinstance(content, str) else content
    ctx = F.col(context) if isinstance(context, str) else context
    total = F.col(total_col) if total_col else size_total(c, ctx)
    limit_kb = max_chars // 1024
    over = total > max_chars
    return (df.withColumn("size_chars", total.cast("long"))
            .withColumn("oversize", over)
            .withColumn("size_reason", F.when(over, F.concat(
                F.lit("Content too large ("), F.floor(total / 1024).cast("string"),
                F.lit(f"KB > {limit_kb}KB limit)"))))
            .withColumn("size_threat_type", F.when(over, F.lit("size_limit_exceeded")))
            .withColumn("size_confidence", F.when(over, F.lit(1.0)))
            .withColumn("violation_type", F.when(over, F.lit("size_limit")))
            .withColumn("violation_description", F.when(over, F.lit(
                f"Content exceeds maximum size of {limit_kb}KB"))))
