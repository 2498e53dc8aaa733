"""Structured Streaming jobs: gate, per-minute quota, outage alerts.

Each job reads a file stream with a declared schema, reuses the batch
functions unchanged, and writes to a parquet sink.  A job that is to survive a
restarted driver is given its ``checkpoint`` path (on shared storage) and the
same output path each time: it resumes after the last committed batch, and a
batch that is replayed replaces its own output.  Without one, a fresh path
under ``spark.checkpoint.dir`` is used (a single run).  ``run_available``
drains what is there (``availableNow``) -- the same code runs continuously
with a processing-time trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import policy as P
from ..operators.quota import TIERS, sessions
from ..plans.governance import govern_documents
from ..session import scratch_path, ship_package
from ..sources.sinks import write_routed
from ..sources import derived
from .outage import QUIET_MINUTES, STATE_STORE, outage_events

WATERMARK = "10 minutes"


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Parquet files arriving under the directory ``path`` (optionally only
    those matching ``glob``)."""
    r = spark.readStream.format("parquet").schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def table_glob(tables_dir: str, name: str) -> str:
    """Path of a table for :func:`file_stream`.  A table may be one file or a
    folder of files; a stream takes a plain path for a folder and would list
    nothing of a file, but lists both when the path is a pattern."""
    return f"{tables_dir.rstrip('/')}/[{name[0]}]{name[1:]}.parquet"


def run_available(writer, name: str, spark: SparkSession, checkpoint: str | None = None):
    """Run a stream over everything available now, then stop; returns the
    finished query (its progress reports carry the per-batch metrics)."""
    q = (writer.option("checkpointLocation", checkpoint or scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q



# ---------------------------------------------------------------------------
def gate_stream(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                partitions: int | None = None) -> DataFrame:
    """Stateless detect -> assemble -> normalise -> decide on arriving rows.

    ``partitions`` spreads each micro-batch before the regex work, for
    sources whose batches arrive as a few large files."""
    if partitions:
        docs = docs.repartition(partitions)
    return govern_documents(docs, id_col, text)


def run_gate(spark: SparkSession, docs_dir: str, out_path: str, schema: T.StructType,
             glob: str | None = None, partitions: int | None = None, checkpoint: str | None = None,
             max_files_per_trigger: int | None = None, prepare=lambda df: df) -> None:
    """Route each micro-batch to ``batch=N/decision=allow|block`` partitions;
    a replayed batch overwrites its own folder."""
    docs = prepare(file_stream(spark, docs_dir, schema, max_files_per_trigger, glob=glob))
    routed = gate_stream(docs, partitions=partitions)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        write_routed(batch, f"{out_path.rstrip('/')}/batch={epoch}")

    run_available(routed.writeStream.foreachBatch(write_batch), "gate", spark, checkpoint)


# ---------------------------------------------------------------------------
def quota_stream(events: DataFrame, watermark: str = WATERMARK, tiers=TIERS) -> DataFrame:
    """Per-minute scans per key with the tier's rate limit and the excess over
    it (as ``operators.quota.quota_minute``); rows later than the watermark are dropped.

    ``events.ts`` is TIMESTAMP_NTZ, which ``withWatermark`` rejects, so it is
    cast to TIMESTAMP (the session time zone is UTC).
    """
    limit = F.lit(None).cast("int")
    for tier, per_minute, _ in tiers:
        limit = F.when(F.col("tier") == tier, F.lit(per_minute)).otherwise(limit)
    s = derived.scans(events).withColumn("ts", F.col("ts").cast("timestamp"))
    return (s.withWatermark("ts", watermark)
            .groupBy(F.window("ts", "1 minute").alias("w"), "key_id", "tier")
            .agg(F.count(F.lit(1)).alias("n_scans"))
            .select("key_id", "tier", F.col("w")["start"].cast("timestamp_ntz").alias("minute_start"),
                    "n_scans", limit.alias("rate_limit"),
                    F.greatest(F.col("n_scans") - limit, F.lit(0)).cast("long").alias("excess")))


def run_quota(spark: SparkSession, events_dir: str, out_path: str, schema: T.StructType,
              glob: str | None = None, max_files_per_trigger: int | None = None, checkpoint: str | None = None, tiers=TIERS) -> None:
    """Per-minute quota counts of closed windows into ``out_path``; rows that
    arrive behind the watermark are dropped."""
    agg = quota_stream(file_stream(spark, events_dir, schema, max_files_per_trigger, glob=glob), tiers=tiers)
    run_available(agg.writeStream.outputMode("append").format("parquet").option("path", out_path),
                  "quota", spark, checkpoint)


# ---------------------------------------------------------------------------
SCAN_SCHEMA = T.StructType([
    T.StructField("key_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
])


def run_sessions(spark: SparkSession, scans_dir: str, out_path: str, gap: str = "30 minutes", watermark: str = WATERMARK,
                 checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """Closed bursts per key (:func:`tollgate.operators.quota.sessions`) of the
    scans arriving under ``scans_dir``."""
    scans = file_stream(spark, scans_dir, SCAN_SCHEMA, max_files_per_trigger)
    scans = scans.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    run_available(sessions(scans, gap).writeStream.outputMode("append").format("parquet").option("path", out_path), "sessions", spark, checkpoint)


# ---------------------------------------------------------------------------
OUTCOME_SCHEMA = T.StructType([
    T.StructField("endpoint", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("ok", T.BooleanType()),
])


def heartbeat(events: DataFrame, days: int = 3) -> DataFrame:
    """One row without an endpoint, ``days`` after the last event: it closes
    every minute of a stream that ends here."""
    return events.agg(F.max("ts").alias("ts")).select(
        F.lit(None).cast("bigint").alias("endpoint"), F.lit(None).cast("bigint").alias("event_id"),
        (F.col("ts") + F.make_dt_interval(days=F.lit(days))).alias("ts"), F.lit(True).alias("ok"))


def run_outage(spark: SparkSession, outcomes_dir: str, out_path: str, threshold: int = P.FAILURE_THRESHOLD, watermark: str = WATERMARK,
               quiet_minutes: int = QUIET_MINUTES, checkpoint: str | None = None, max_files_per_trigger: int | None = None):
    """Alerts on the call outcomes arriving under ``outcomes_dir`` (see
    :func:`tollgate.streaming.outage.outage_events`) into ``out_path``.  Its
    state with timers needs Spark's RocksDB state store, set for this query."""
    ship_package(spark)
    calls = file_stream(spark, outcomes_dir, OUTCOME_SCHEMA, max_files_per_trigger)
    rows = outage_events(calls, threshold, watermark, quiet_minutes)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, STATE_STORE)
    try:
        return run_available(rows.writeStream.outputMode("append").format("parquet").option("path", out_path), "outage", spark, checkpoint)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
