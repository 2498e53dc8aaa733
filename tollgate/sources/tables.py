"""Readers for the parquet tables and JSON-lines inputs.

Readers only declare what to read; Catalyst pushes filters and column
selections into the parquet scan (see ``PushedFilters`` / ``ReadSchema`` in
``explain``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_messages(spark: SparkSession, sf_dir: str,
                  roles: Iterable[str] | None = ("user",)) -> DataFrame:
    """Flat message table ``(conv_id, turn, role, text)``; the role filter is
    pushed into the parquet scan."""
    df = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return df.where(F.col("role").isin(*roles)) if roles else df


ATTEMPT_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("scan_kind", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("kind", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("message", T.StringType()),
])


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Scan-attempt log with a declared schema (no inference pass)."""
    return spark.read.schema(ATTEMPT_SCHEMA).parquet(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per line -> ``(line_no, raw)``; never infers a schema."""
    return (spark.read.text(path)
            .withColumn("line_no", F.monotonically_increasing_id())
            .select("line_no", F.col("value").alias("raw")))


def parse_requests(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Chat request JSON -> VARIANT ``body`` plus validity flags.

    Malformed lines are kept with ``valid = false`` (they become error rows
    downstream, never silently dropped).
    """
    body = F.try_parse_json(F.col(raw))
    msgs = F.try_variant_get(body, "$.messages", "array<variant>")
    return (df.withColumn("body", body)
            .withColumn("valid", F.col("body").isNotNull())
            .withColumn("n_messages", F.when(msgs.isNotNull(), F.size(msgs)))
            .withColumn("n_user_messages", F.when(msgs.isNotNull(), F.size(F.filter(
                msgs, lambda m: F.try_variant_get(m, "$.role", "string") == "user")))))


def _present(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "variant").isNotNull()


#: Characters that JSON texts cannot hold as they are; a text that does is left alone.
_MARK, _BACKSLASH, _QUOTE = "\u0001", "\u0002\u0002", "\u0002\u0003"


def non_finite_as_null(text: Column) -> Column:
    """JSON text whose bare ``NaN`` and ``Infinity`` -- which the scan client's
    parser accepts and VARIANT does not -- are ``null``; strings stay as they are.

    Escapes are set aside, so that a string is a run without quotes; then each
    string, and each non-finite number, is followed by a mark, and a mark that
    follows no quote stands where a number was."""
    t = F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    t = F.regexp_replace(t, '("[^"]*")|-?Infinity|NaN', f"$1{_MARK}")
    t = F.replace(F.replace(t, F.lit(f'"{_MARK}'), F.lit('"')), F.lit(_MARK), F.lit("null"))
    t = F.replace(F.replace(t, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    return F.when(~text.rlike("[\u0001-\u0003]"), t)


_TYPED_VERDICT = "safe boolean, reason string, threat_type string, confidence double, severity string, _corrupt string"


def parse_verdicts(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Raw verdict JSON -> typed columns with presence flags.

    ``from_json`` cannot tell an absent field from a JSON null, and the
    normalisation depends on that difference, so the JSON goes through
    VARIANT: ``variant_get(..., 'variant') IS NULL`` means absent and
    ``is_variant_null`` means an explicit null.  Fields not listed here
    (internal detector details) are dropped by construction.

    A text VARIANT refuses is tried again with non-finite numbers set to null
    (their value then comes from a typed parse), and last, for repeated keys,
    of which the last counts, as a map of its top-level keys and by the typed
    parse.  Nothing is searched for in the raw text.  ``valid`` is false for what
    is still unparsed, is not an object, or has a ``safe`` that is neither a
    boolean nor null: such rows carry no verdict and go to the failure policy.
    """
    text = F.col(raw)
    strict = F.try_parse_json(text)
    other = [c for c in df.columns if c != raw]
    base = df.select(*other, text.alias("_raw"), strict.alias("_s"))
    refused = F.col("_s").isNull()
    typed = F.from_json("_raw", _TYPED_VERDICT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    base = base.select(*other, "_raw", "_s", F.when(refused, F.try_parse_json(non_finite_as_null(F.col("_raw")))).alias("_f"),
                       F.when(refused, typed).alias("_t"), F.when(refused, F.map_keys(F.from_json("_raw", "map<string,string>"))).alias("_keys"))
    v, t = F.coalesce(F.col("_s"), F.col("_f")), F.col("_t")
    base = base.withColumn("_v", v).withColumn("_safe", F.to_json(F.variant_get(v, "$.safe", "variant")))
    v, opened = F.col("_v"), F.ltrim(F.translate("_raw", "\t\r\n", "   ")).startswith("{")
    by_variant = F.coalesce(v.isNotNull() & opened & F.coalesce(F.col("_safe").isin("true", "false", "null"), F.lit(True)), F.lit(False))
    by_type = F.coalesce(v.isNull() & opened & t.isNotNull() & t["_corrupt"].isNull(), F.lit(False))
    # Both parsers stop after the first value; the client refuses what follows it.
    ended = F.rtrim(F.translate("_raw", "\t\r\n", "   ")).endswith("}")
    base = base.withColumn("_by_variant", ended & by_variant).withColumn("_by_type", ended & by_type)
    by_variant, by_type = F.coalesce("_by_variant", F.lit(False)), F.coalesce("_by_type", F.lit(False))

    def present(name: str) -> Column:
        return F.when(by_variant, _present(v, f"$.{name}")).when(by_type, F.coalesce(F.array_contains("_keys", name), F.lit(False))).otherwise(F.lit(False))

    def string(name: str) -> Column:
        return F.when(by_variant, F.try_variant_get(v, f"$.{name}", "string")).when(by_type, t[name])
    return base.select(
        *other,
        (by_variant | by_type).alias("valid"),
        F.when(by_variant, F.col("_safe").isNotNull()).otherwise(present("safe")).alias("has_safe"),
        F.when(by_variant, F.col("_safe") == "true").when(by_type & F.array_contains("_keys", "safe"), F.coalesce(t["safe"], F.lit(False))).alias("safe_value"),
        present("reason").alias("has_reason"),
        string("reason").alias("reason"),
        present("threat_type").alias("has_threat_type"),
        string("threat_type").alias("threat_type"),
        F.when(by_variant & F.col("_s").isNotNull(), F.try_variant_get(v, "$.confidence", "double")).when(by_variant | by_type, t["confidence"]).alias("confidence"),
        string("severity").alias("severity"))


UNREADABLE = ("no id", "no verdict", "no JSON object", "safe is neither a boolean nor null")


def read_verdicts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Verdict log, one line for each item: its id, a tab, and the JSON the scan
    service answered.  Returns (verdicts, unreadable).

    Every line with an id is a verdict row (``item_id`` and the columns of
    :func:`parse_verdicts`; ``valid`` is false where the JSON is no verdict).
    ``unreadable`` names the lines that carry none: file, the line, and the
    reason.  Both come from one reading of a line; nothing is inferred, and a
    broken line stops nothing."""
    cut = F.split("value", "\t", 2)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), F.try_to_number(F.get(cut, 0), F.lit("S9999999999999999999")).cast("bigint").alias("item_id"),
                                         F.get(cut, 1).alias("raw"))
    parsed = parse_verdicts(lines.withColumn("_body", F.col("raw")))
    why = (F.when(F.col("item_id").isNull(), UNREADABLE[0]).when(F.coalesce(F.trim("_body"), F.lit("")) == "", UNREADABLE[1])
           .when(F.try_parse_json(non_finite_as_null(F.col("_body"))).isNull() | ~F.ltrim("_body").startswith("{"), UNREADABLE[2]).otherwise(UNREADABLE[3]))
    unreadable = parsed.where(F.col("item_id").isNull() | ~F.col("valid")).select("file", "line", why.alias("why"))
    return parsed.where(F.col("item_id").isNotNull()).drop("file", "line", "_body"), unreadable
