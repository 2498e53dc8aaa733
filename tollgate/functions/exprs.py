"""Column-level building blocks (pure Catalyst expressions, codegen friendly)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .taxonomy import (CONFIDENCE_HIGH, CONFIDENCE_MEDIUM, DEFAULT_SEVERITY,
                       GUIDANCE, RAW_TO_CANONICAL, SEVERITIES)

# FIXED VALUES: the characters Python's ``str.strip()`` / ``str.isspace()``
# treat as whitespace.  Java's ``\s`` (even with (?U)) misses U+001C..U+001F,
# so the class is spelled out.  ``\x{..}`` works in both Java and RE2.
PY_WHITESPACE = (r"\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}"
                 r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
BLANK_PATTERN = r"^[" + PY_WHITESPACE + r"]*\z"

# FIXED VALUES: content size limit in characters (strictly greater fails).
MAX_CONTENT_CHARS = 100 * 1024


def _map_literal(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def is_blank(col: Column) -> Column:
    """True when the text is empty or only Python whitespace (NULL -> NULL)."""
    return col.rlike(BLANK_PATTERN)


def fold_label(col: Column) -> Column:
    """Label folding: lower case and '-' -> '_' (no trim)."""
    return F.translate(F.lower(col), "-", "_")


def canonical_type(raw: Column) -> Column:
    """Raw label -> canonical type as a scalar expression (unknown fallback).

    Used inside per-row array transforms where a join is not possible; the
    DataFrame-level :func:`tollgate.operators.verdicts.normalize_threat` does the
    same through a broadcast join with the taxonomy dimension.
    """
    return F.coalesce(F.try_element_at(_map_literal(RAW_TO_CANONICAL), fold_label(raw)),
                      F.lit("unknown"))


def default_severity(threat_type: Column) -> Column:
    return F.coalesce(F.try_element_at(_map_literal(DEFAULT_SEVERITY), threat_type),
                      F.lit(DEFAULT_SEVERITY["unknown"]))


def guidance_text(threat_type: Column) -> Column:
    return F.coalesce(F.try_element_at(_map_literal(GUIDANCE), threat_type),
                      F.lit(GUIDANCE["unknown"]))


def severity_rank(sev: Column) -> Column:
    """critical=0, high=1, medium=2, low=3, anything else NULL."""
    expr = F.when(sev == SEVERITIES[0], 0)
    for i, s in enumerate(SEVERITIES[1:], start=1):
        expr = expr.when(sev == s, i)
    return expr


def resolve_severity(threat_type: Column, raw_severity: Column) -> Column:
    """Provider severity wins when it is one of the four (any case)."""
    low = F.lower(raw_severity)
    return F.when(low.isin(*SEVERITIES), low).otherwise(default_severity(threat_type))


def bucket_confidence(score: Column) -> Column:
    """NULL -> medium, NaN -> low (both comparisons are false in the
    reference; Spark orders NaN above everything, so test it first)."""
    return (F.when(score.isNull(), "medium")
            .when(F.isnan(score), "low")
            .when(score >= CONFIDENCE_HIGH, "high")
            .when(score >= CONFIDENCE_MEDIUM, "medium")
            .otherwise("low"))


def variant_kind(v: Column) -> Column:
    """Coarse JSON kind of a VARIANT: string, bool, number, null, array, object."""
    t = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit(None))
            .when(t == "STRING", "string")
            .when(t == "BOOLEAN", "bool")
            .when(t == "VOID", "null")
            .when(t.startswith("ARRAY"), "array")
            .when(t.startswith("OBJECT"), "object")
            .otherwise("number"))


def python_truthy(v: Column) -> Column:
    """Python truthiness of a JSON value held in a VARIANT (absent -> NULL)."""
    k = variant_kind(v)
    return (F.when(k == "bool", F.variant_get(v, "$", "boolean"))
            .when(k == "null", F.lit(False))
            .when(k == "string", F.length(F.variant_get(v, "$", "string")) > 0)
            .when(k == "number", F.try_variant_get(v, "$", "double") != 0)
            .when(k == "array", F.size(F.variant_get(v, "$", "array<variant>")) > 0)
            .when(k == "object", F.to_json(v) != "{}"))
