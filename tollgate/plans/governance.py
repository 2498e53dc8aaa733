"""End-to-end governance plans composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.exprs import MAX_CONTENT_CHARS, is_blank
from ..operators import detect as D
from ..operators import gates as G
from ..operators import policy as P
from ..operators import verdicts as V
from .running import chunked_prefixes

ALL_FAMILIES = ("pii", "secrets", "code", "prompt")
#: Turns of a conversation that one task runs through.
HISTORY_CHUNK = 1024


def govern_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """documents -> every detector -> one verdict per row -> normalised ->
    allow / block.  Narrow: no shuffle beyond what the input brings."""
    f = docs.select(F.col(id_col).alias("item_id"),
                    D.findings(F.col(text), ALL_FAMILIES).alias("findings"))
    v = V.normalize_verdict(D.assemble(f, "findings"))
    return P.decide(v).select("item_id", "decision", "threat_type", "severity", "confidence",
                              "n_findings")


def govern_conversations(msgs: DataFrame, max_chars: int | None = None, roles: tuple[str, ...] = ("user",)) -> DataFrame:
    """conversations -> empty gate [-> size gate] -> detectors -> one verdict
    and decision per conversation.

    No rule matches across the line feed that joins turns, so the detectors
    run on each message (narrow) and a conversation's verdict is the least
    ranked finding: one scan, one partial aggregate of small values, however
    long a conversation is.  ``gate`` says which step answered: ``error`` (a
    NULL user text), ``empty`` (safe, scan skipped), ``size`` (only with
    ``max_chars``: the chat clients themselves have no such gate) or ``scan``.
    """
    return conversation_verdicts(message_verdicts(msgs, roles), max_chars)


def message_verdicts(msgs: DataFrame, roles: tuple[str, ...] = ("user",)) -> DataFrame:
    """What each message adds to its conversation's verdict (narrow)."""
    mine = F.col("role").isin(*roles)
    text = F.when(mine, F.col("text"))
    found = msgs.select("conv_id", mine.alias("mine"), text.isNull().alias("missing"), F.length(text).alias("chars"),
                        F.coalesce(is_blank(text), F.lit(True)).alias("blank"), D.findings(text, ALL_FAMILIES).alias("findings"))
    return found.select("conv_id", "mine", "missing", "chars", "blank", D.worst(F.col("findings")).alias("worst"),
                         F.size("findings").cast("long").alias("n"))


def conversation_verdicts(found: DataFrame, max_chars: int | None = None) -> DataFrame:
    """One decision per conversation from its messages' parts; a message that
    counts twice changes nothing but the size."""
    g = found.groupBy("conv_id").agg(
        F.count_if(F.col("mine") & F.col("missing")).alias("missing"), F.count_if("mine").alias("turns"), F.sum("chars").alias("chars"),
        F.bool_and(F.col("blank") | ~F.col("mine")).alias("blank"), F.min("worst").alias("worst"), F.sum("n").alias("n_findings"))
    total = F.coalesce(F.col("chars"), F.lit(0)) + F.greatest(F.col("turns") - 1, F.lit(0))
    g = G.gate_size(g.withColumn("payload_chars", total), content=F.lit(""), total_col="payload_chars", max_chars=max_chars or MAX_CONTENT_CHARS)
    err, empty = F.col("missing") > 0, F.col("blank")
    over = F.col("oversize") if max_chars is not None else F.lit(False)
    raw = F.col("worst")["raw_type"]
    v = V.normalize_verdict(g.withColumns({
        "safe": F.col("n_findings") == 0, "threat_type": raw, "confidence": F.col("worst")["confidence"],
        "severity": X.default_severity(X.canonical_type(raw))}))
    unsafe_scan = ~err & ~empty & ~over & ~F.col("safe")
    return v.select(
        "conv_id",
        F.when(err, "error").when(empty, "empty").when(over, "size").otherwise("scan").alias("gate"),
        F.when(err, "error").when(empty, "allow").when(over, "block")
         .when(F.col("safe"), "allow").otherwise("block").alias("decision"),
        F.when(err | empty, F.lit(None)).when(over, F.col("size_threat_type"))
         .when(unsafe_scan, F.col("threat_type")).alias("threat_type"),
        F.when(unsafe_scan, F.col("severity")).alias("severity"),
        F.when(unsafe_scan, F.col("confidence")).alias("confidence"),
        F.when(err, F.lit(None)).when(empty, F.lit(G.EMPTY_REASON_CHAT)).when(over, F.col("size_reason"))
         .otherwise(F.col("reason")).alias("reason"))


def conversation_findings(msgs: DataFrame, families: tuple[str, ...], roles: tuple[str, ...] = ("user",)) -> DataFrame:
    """Finding rows of whole conversations, found message by message; ``ord``
    counts a label's matches through the conversation.  A conversation with a
    NULL text has none (the client would raise)."""
    mine = msgs.where(F.col("role").isin(*roles))
    arr = mine.select("conv_id", "turn", F.inline_outer(D.findings(F.col("text"), families))).where(F.col("raw_type").isNotNull())
    broken = mine.where(F.col("text").isNull()).select("conv_id").distinct()
    order = Window.partitionBy("conv_id", "raw_type").orderBy("turn", "ord")
    return (arr.join(broken, "conv_id", "left_anti").withColumn("ord", F.row_number().over(order))
            .select(F.col("conv_id").alias("item_id"), "raw_type", "confidence", "ord", "match_hash"))


def history_verdicts(msgs: DataFrame, roles: tuple[str, ...] = ("user",), chunk_turns: int = HISTORY_CHUNK) -> DataFrame:
    """One decision per turn for a caller that resends its history: what a scan
    of everything up to that turn would say, without building that text.

    Each message is scanned once; length, number of findings, worst finding and
    a digest of the history run through (conversation, chunk of turns), so the
    output grows with the turns, not with their square, and no task holds a
    whole long conversation.  ``history_key`` is the same for the same messages
    at the same turns.  From a NULL text on, every turn is an ``error`` (the
    client would raise).  Rows of one turn are taken in the order of their
    digests; a NULL turn comes first; rows without a conversation are one.
    """
    text = F.col("text")
    digest = F.md5(F.concat_ws(":", F.col("turn").cast("string"), F.coalesce(text, F.lit(""))).cast("binary"))
    mine = msgs.where(F.col("role").isin(*roles)).select(
        "conv_id", "turn", digest.alias("digest"), F.length(text).alias("chars"), text.isNull().cast("int").alias("missing"),
        D.findings(text, ALL_FAMILIES).alias("findings"))
    judged = mine.select("conv_id", "turn", "digest", "chars", "missing", F.size("findings").cast("long").alias("n"), D.worst(F.col("findings")).alias("worst"))
    number = F.conv(F.substring("digest", 1, 15), 16, 10).cast("decimal(20,0)")
    run = chunked_prefixes(judged, ["conv_id"], ["turn", "digest"], F.floor(F.col("turn") / F.lit(chunk_turns)), {
        "length": ("sum", F.coalesce(F.col("chars"), F.lit(0)) + 1), "broken": ("sum", F.col("missing")),
        "key": ("sum", number), "n_findings": ("sum", F.col("n")), "so_far": ("min", F.col("worst"))})
    error, unsafe = F.col("broken") > 0, F.col("n_findings") > 0
    raw = F.col("so_far")["raw_type"]
    return run.select(
        "conv_id", "turn", (F.col("length") - 1).cast("long").alias("history_chars"), F.col("key").cast("decimal(38,0)").cast("string").alias("history_key"),
        F.when(error, "error").when(unsafe, "block").otherwise("allow").alias("decision"),
        F.when(~error, F.col("n_findings")).alias("n_findings"),
        F.when(~error & unsafe, X.canonical_type(raw)).alias("threat_type"),
        F.when(~error & unsafe, X.default_severity(X.canonical_type(raw))).alias("severity"),
        F.when(~error & unsafe, F.col("so_far")["confidence"]).alias("confidence"))
