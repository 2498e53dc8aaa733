"""Gate a stream of chat requests that resend their history.

Lines of JSON arrive (``{id, ts, messages}``), each a whole request body.  They
are parsed to VARIANT, cut into messages, and a message that its conversation
has brought before is dropped: the state holds a digest for each conversation
and message for as long as the watermark allows, so a conversation of n turns
that is resent n times is scanned n times and not n * n / 2 times.  New messages
are scanned where they are (narrow) and their parts of the verdict written;
:func:`tollgate.plans.governance.conversation_verdicts` puts them together, as
it does in batch.

Lines that cannot be read (broken JSON, no object, no id, no time, no list of
messages) go to a sink of their own, never to the messages.  Both streams
resume from their checkpoints, and a replayed batch replaces its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import variant_kind
from ..operators.extract import message_text
from ..plans.governance import message_verdicts


def parsed_lines(lines: DataFrame) -> DataFrame:
    """``value`` -> conv_id, ts, messages (array of VARIANT), readable."""
    body = F.try_parse_json("value")
    d = lines.select("value", body.alias("body"))
    d = d.select("value", F.try_variant_get("body", "$.id", "bigint").alias("conv_id"),
                 F.try_to_timestamp(F.try_variant_get("body", "$.ts", "string"), F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("ts"),
                 F.try_variant_get("body", "$.messages", "array<variant>").alias("messages"))
    return d.withColumn("readable", F.col("conv_id").isNotNull() & F.col("ts").isNotNull() & F.col("messages").isNotNull())


def request_messages(lines: DataFrame, watermark: str) -> DataFrame:
    """New messages of readable lines: conv_id, ts, turn, role, text, digest.
    Of the same message only the first within the watermark comes through."""
    d = parsed_lines(lines).where("readable").select("conv_id", "ts", F.posexplode("messages").alias("turn", "m"))
    role = F.when(variant_kind(F.col("m")) == "object", F.try_variant_get("m", "$.role", "string"))
    d = d.select("conv_id", "ts", "turn", role.alias("role"), message_text(F.col("m")).alias("text"))
    told = F.concat_ws(" ", F.coalesce(F.octet_length("role"), F.lit(-1)), F.coalesce(F.octet_length("text"), F.lit(-1)), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    d = d.withColumn("digest", F.sha2(told, 256))
    return d.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["conv_id", "digest"])


def run_requests(spark: SparkSession, lines_dir: str, out_path: str, watermark: str = "10 minutes", checkpoint: str | None = None,
                 max_files_per_trigger: int | None = None) -> None:
    """Drain the request lines under ``lines_dir``: message verdicts to
    ``out_path/messages``, unreadable lines to ``out_path/unreadable``."""
    from .jobs import run_available

    def source() -> DataFrame:
        r = spark.readStream.format("text")
        return (r.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else r).load(lines_dir)

    def sink(name: str):
        def write(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/{name}/batch={epoch}")
        return write
    new = request_messages(source(), watermark)
    scanned = message_verdicts(new)
    run_available(scanned.writeStream.foreachBatch(sink("messages")), "request-messages", spark, f"{checkpoint}/messages" if checkpoint else None)
    broken = parsed_lines(source()).where(~F.col("readable")).select("value")
    run_available(broken.writeStream.foreachBatch(sink("unreadable")), "request-lines", spark, f"{checkpoint}/lines" if checkpoint else None)
