"""Verdict normalisation: taxonomy lookup, severity, confidence, guidance.

Lookups against the taxonomy are broadcast joins with fixed-size dimensions
(92 and 18 rows), so they never shuffle the verdict table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.taxonomy import DEFAULT_SEVERITY, GUIDANCE, threat_dimension, type_dimension

# Our own wording for rows scanned without an API key.
KEYLESS_NOTE = ("Scanned without an API key: pattern checks only. "
                "Add a key for the deeper semantic checks.")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_threat(df: DataFrame, col: str | Column = "threat_type",
                     out: str = "threat_type_norm") -> DataFrame:
    """Raw label -> canonical type via a broadcast left join; NULL, empty or
    unknown labels give ``unknown``.  Folding is lower case plus '-' -> '_'."""
    dim = F.broadcast(threat_dimension(df.sparkSession).select("raw_label", "dim_threat_type"))
    return (df.join(dim, X.fold_label(_col(col)) == dim["raw_label"], "left")
            .withColumn(out, F.coalesce(F.col("dim_threat_type"), F.lit("unknown")))
            .drop("raw_label", "dim_threat_type"))


def derive_severity(df: DataFrame, type_col: str = "threat_type",
                    raw_col: str = "severity", out: str = "severity_norm") -> DataFrame:
    """Provider severity if valid (case-insensitive), else the type default."""
    return df.withColumn(out, X.resolve_severity(F.col(type_col), F.col(raw_col)))


def bucket_confidence(df: DataFrame, col: str = "confidence",
                      out: str = "confidence_level") -> DataFrame:
    return df.withColumn(out, X.bucket_confidence(F.col(col)))


def with_guidance(df: DataFrame, type_col: str = "threat_type", out: str = "guidance") -> DataFrame:
    """Canonical type -> guidance sentence via the 18-row type dimension."""
    dim = F.broadcast(type_dimension(df.sparkSession)
                      .select(F.col("threat_type").alias("_gt"), F.col("guidance").alias("_gg")))
    return (df.join(dim, F.col(type_col) == dim["_gt"], "left")
            .withColumn(out, F.coalesce(F.col("_gg"), F.lit(GUIDANCE["unknown"])))
            .drop("_gt", "_gg"))


def sanitize(df: DataFrame) -> DataFrame:
    """Normalise parsed raw verdicts (see ``sources.tables.parse_verdicts``).

    * ``safe`` absent -> safe; JSON null or falsy -> unsafe.
    * safe rows keep only ``reason`` (absent -> ``''``, null stays null).
    * unsafe rows get canonical ``threat_type`` (absent -> ``unknown``),
      ``severity``, bucketed ``confidence``, ``guidance``, and ``reason``
      (absent -> guidance, null stays null).
    * every other field of the raw verdict is dropped by construction.
    * a malformed verdict (``valid`` false) is neither safe nor unsafe: every
      field is NULL, and the failure policy decides (``policy.resolve_malformed``).
    """
    valid = F.coalesce(F.col("valid"), F.lit(False)) if "valid" in df.columns else F.lit(True)
    dim = F.broadcast(threat_dimension(df.sparkSession))
    base = df.withColumnRenamed("threat_type", "_raw_type").withColumnRenamed("severity", "_raw_sev")
    raw_type = F.when(F.col("has_threat_type"), F.col("_raw_type")).otherwise(F.lit("unknown"))
    j = base.join(dim, X.fold_label(raw_type) == dim["raw_label"], "left")
    safe = F.when(valid, F.when(~F.col("has_safe"), F.lit(True)).otherwise(F.coalesce(F.col("safe_value"), F.lit(False))))
    ttype = F.coalesce(F.col("dim_threat_type"), F.lit("unknown"))
    guidance = F.coalesce(F.col("dim_guidance"), F.lit(GUIDANCE["unknown"]))
    default_sev = F.coalesce(F.col("dim_severity"), F.lit(DEFAULT_SEVERITY["unknown"]))
    low_sev = F.lower(F.col("_raw_sev"))
    severity = F.when(low_sev.isin("critical", "high", "medium", "low"), low_sev).otherwise(default_sev)
    unsafe = ~F.col("safe")
    keep = [c for c in df.columns if c not in (
        "has_safe", "safe_value", "has_reason", "reason", "has_threat_type", "threat_type",
        "confidence", "severity")]
    return (j.withColumn("safe", safe)
            .select(*keep,
                    F.col("safe"),
                    F.when(F.col("has_reason"), F.col("reason"))
                     .when(F.col("safe"), F.lit(""))
                     .when(unsafe, guidance).alias("reason"),
                    F.when(unsafe, ttype).alias("threat_type"),
                    F.when(unsafe, severity).alias("severity"),
                    F.when(unsafe, X.bucket_confidence(F.col("confidence"))).alias("confidence"),
                    F.when(unsafe, guidance).alias("guidance")))


def tier_note(df: DataFrame, has_key: str | Column = "has_key", out: str = "note") -> DataFrame:
    """Note on rows scanned without an API key (suppressed when a key is set)."""
    return df.withColumn(out, F.when(~_col(has_key), F.lit(KEYLESS_NOTE)))


def normalize_verdict(df: DataFrame) -> DataFrame:
    """Normalise assembled verdicts row by row (no join), for streams and
    for verdicts produced in the same plan: ``threat_type`` (raw label) ->
    canonical, ``severity`` resolved, ``confidence`` bucketed, ``guidance``
    and ``reason`` added for unsafe rows; safe rows keep ``reason = ''``."""
    unsafe = ~F.col("safe")
    ttype = X.canonical_type(F.col("threat_type"))
    guidance = X.guidance_text(ttype)
    return (df.withColumn("confidence_score", F.col("confidence"))
            .withColumn("threat_type", F.when(unsafe, ttype))
            .withColumn("severity", F.when(unsafe, X.resolve_severity(ttype, F.col("severity"))))
            .withColumn("confidence", F.when(unsafe, X.bucket_confidence(F.col("confidence_score"))))
            .withColumn("guidance", F.when(unsafe, guidance))
            .withColumn("reason", F.when(unsafe, guidance).otherwise(F.lit(""))))
