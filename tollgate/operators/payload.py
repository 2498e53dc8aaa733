"""What each scan call sees, built from a flat message table.

Per-conversation lengths are a distributive aggregate (map-side combined); the
text of a payload is one value and is gathered in one row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ordered_join(struct_col: str) -> F.Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(struct_col)),
                                    lambda x: x["text"]), "\n")


def payload_conversation(msgs: DataFrame, roles: Iterable[str] = ("user",),
                         max_chars: int | None = None) -> DataFrame:
    """One row per conversation: ``(conv_id, n_turns, payload_chars, payload)``.

    ``payload`` is the newline join of the conversation's ``roles`` turns in
    turn order; conversations with no such turn get ``''``.  A NULL text
    makes the payload NULL with ``payload_error`` set (the client would
    raise).  ``payload_chars`` is always exact.  The chat clients scan whatever
    they extract; a caller whose scans have a size gate may pass its
    ``max_chars``, and longer payloads are then not gathered (NULL).
    """
    roles = tuple(roles)
    is_role = F.col("role").isin(*roles)
    sizes = (msgs.groupBy("conv_id")
             .agg(F.count_if(is_role).alias("n_turns"),
                  F.sum(F.when(is_role, F.length("text"))).alias("_len"),
                  F.count_if(is_role & F.col("text").isNull()).alias("_nulls")))
    sizes = sizes.select(
        "conv_id", "n_turns",
        (F.coalesce(F.col("_len"), F.lit(0)) + F.greatest(F.col("n_turns") - 1, F.lit(0)))
        .cast("long").alias("payload_chars"),
        (F.col("_nulls") > 0).alias("payload_error"))
    eligible = sizes.where(~F.col("payload_error") & (F.col("n_turns") > 0))
    if max_chars is not None:
        eligible = eligible.where(F.col("payload_chars") <= max_chars)
    # Null-safe keys keep the size aggregate's plan identical in both uses,
    # so its exchange is reused instead of recomputed.
    e = eligible.select(F.col("conv_id").alias("_e"))
    user = msgs.where(is_role)
    texts = (user.join(e, user["conv_id"].eqNullSafe(e["_e"]), "left_semi")
             .groupBy("conv_id")
             .agg(_ordered_join(F.struct("turn", "text")).alias("_payload"))
             .withColumnRenamed("conv_id", "_t"))
    within = F.lit(True) if max_chars is None else F.col("payload_chars") <= max_chars
    return (sizes.join(texts, sizes["conv_id"].eqNullSafe(texts["_t"]), "left")
            .select("conv_id", "n_turns", "payload_chars", "payload_error",
                    F.when(F.col("payload_error"), F.lit(None).cast("string"))
                     .when(F.col("n_turns") == 0, F.lit(""))
                     .when(within, F.col("_payload")).alias("payload")))


def payload_history(msgs: DataFrame, roles: Iterable[str] = ("user",)) -> DataFrame:
    """One row per ``roles`` turn: everything a caller that resends its
    history would have scanned at that turn.

    The output holds every prefix of a conversation, so it grows with the
    square of its turns by definition; for verdicts alone use the decisions
    per message.  A NULL text makes the payload of its turn and of all later
    ones NULL with ``payload_error`` set (the client would raise)."""
    turns = msgs.where(F.col("role").isin(*tuple(roles))).select("conv_id", "turn", "text")
    w = Window.partitionBy("conv_id").orderBy("turn", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = turns.select("conv_id", "turn", F.collect_list(F.struct("text")).over(w).alias("h"),
                       (F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).over(w) - 1).cast("long").alias("history_chars"))
    error = F.exists("h", lambda x: x["text"].isNull())
    return run.select("conv_id", "turn", "history_chars", error.alias("payload_error"),
                      F.when(~error, F.array_join(F.transform("h", lambda x: x["text"]), "\n")).alias("payload"))


def payload_latest(msgs: DataFrame, roles: Iterable[str] = ("user",)) -> DataFrame:
    """Chat-session mode: each call scans only the new message."""
    return (msgs.where(F.col("role").isin(*tuple(roles)))
            .select("conv_id", "turn", F.col("text").alias("payload"), F.col("text").isNull().alias("payload_error"),
                    F.length("text").cast("long").alias("payload_chars")))
