"""Scan request payloads: prompt, SQL and file requests, and their union.

Bodies are serialised with ``to_json`` (NULL fields are omitted, which is how
an optional key is left out of the request).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gates import gate_size

# FIXED VALUES: scan routes and content kinds of the scan API.
ROUTE_PROMPT = "/scan"
ROUTE_SPECIALIZED = "/api/scan/specialized"
KIND_SQL = "sql"
KIND_FILE_PATH = "file_path"
KIND_FILE_CONTENT = "file_content"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prompt_request(df: DataFrame, prompt: str | Column = "payload",
                   context: str | Column | None = None) -> DataFrame:
    """``{"prompt": ..., "context"?: ...}``; an empty context is left out."""
    fields = [_c(prompt).alias("prompt")]
    if context is not None:
        fields.append(F.nullif(_c(context), F.lit("")).alias("context"))
    return (df.withColumn("route", F.lit(ROUTE_PROMPT))
            .withColumn("content_type", F.lit("prompt"))
            .withColumn("body", F.to_json(F.struct(*fields))))


def sql_request(df: DataFrame, query: str | Column = "text", database: str | Column = "database",
                allow_destructive: str | Column = "allow_destructive") -> DataFrame:
    """``{"content", "content_type": "sql", "context": {"database", "allow_destructive"}}``.

    A missing database is sent as ``""``; the flag is serialised lower case.
    """
    flag = F.when(F.coalesce(_c(allow_destructive), F.lit(False)), F.lit("true")).otherwise(F.lit("false"))
    ctx = F.struct(F.coalesce(_c(database), F.lit("")).alias("database"),
                   flag.alias("allow_destructive"))
    return (df.withColumn("route", F.lit(ROUTE_SPECIALIZED))
            .withColumn("content_type", F.lit(KIND_SQL))
            .withColumn("body", F.to_json(F.struct(_c(query).alias("content"),
                                                   F.lit(KIND_SQL).alias("content_type"),
                                                   ctx.alias("context")))))


def file_request(df: DataFrame, path: str | Column = "path",
                 content: str | Column = "content") -> DataFrame:
    """Path-only or path-plus-content request; empty content counts as none."""
    body_content = F.nullif(_c(content), F.lit(""))
    kind = F.when(body_content.isNotNull(), F.lit(KIND_FILE_CONTENT)).otherwise(F.lit(KIND_FILE_PATH))
    ctx = F.when(body_content.isNotNull(), F.struct(body_content.alias("file_content")))
    return (df.withColumn("route", F.lit(ROUTE_SPECIALIZED))
            .withColumn("content_type", kind)
            .withColumn("body", F.to_json(F.struct(_c(path).alias("content"),
                                                   kind.alias("content_type"),
                                                   ctx.alias("context")))))


def gated(requests: DataFrame, content: str | Column, context: str | Column | None = None) -> DataFrame:
    """Requests behind the client's size gate: one whose content plus context
    is too large is answered locally, so it has no body but a ``local_reason``."""
    g = gate_size(requests, content, context)
    return (g.withColumn("body", F.when(~F.col("oversize"), F.col("body")))
            .withColumn("local_reason", F.col("size_reason")))


def request_union(prompts: DataFrame, sqls: DataFrame, files: DataFrame) -> DataFrame:
    """All content kinds in one work table ``(source, request_id, route,
    content_type, body, local_reason)`` -- a narrow union, no shuffle."""
    cols = ["source", "request_id", "route", "content_type", "body", "local_reason"]
    return (prompts.select(*cols)
            .unionByName(sqls.select(*cols))
            .unionByName(files.select(*cols)))
