"""Metering against tier limits, and threat roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.temporal import asof_join, rolling_count

# FIXED VALUES: tier limits (scans per minute, scans per calendar month);
# the anonymous tier has no published limit.
TIERS: tuple[tuple[str, int | None, int | None], ...] = (
    ("anonymous", None, None),
    ("community", 10, 1_000),
    ("pro", 100, 25_000),
    ("enterprise", 1_000, 1_000_000),
)

#: Limits of the registered queries: small enough that small tables exceed them.
TRIAL_TIERS: tuple[tuple[str, int | None, int | None], ...] = (
    ("anonymous", None, None), ("community", 1, 10), ("pro", 2, 20), ("enterprise", 1, 40))


def tier_frame(spark, tiers=TIERS) -> DataFrame:
    return spark.createDataFrame(list(tiers), "tier string, per_minute int, per_month int")


def quota_minute(scans: DataFrame, tiers=TIERS) -> DataFrame:
    """Scans per key per minute against the tier's rate limit.

    Counting is a partial aggregate on ``(key, minute)``; the tier table (4
    rows) is broadcast.
    """
    t = F.broadcast(tier_frame(scans.sparkSession, tiers))
    counts = (scans.groupBy("key_id", "tier", F.window("ts", "1 minute").alias("w"))
              .agg(F.count(F.lit(1)).alias("n_scans")))
    return (counts.join(t, "tier", "left")
            .select("key_id", "tier", F.col("w")["start"].alias("minute_start"), "n_scans",
                    F.col("per_minute").alias("rate_limit"),
                    F.greatest(F.col("n_scans") - F.col("per_minute"), F.lit(0)).cast("long").alias("excess")))


def quota_month(scans: DataFrame, tiers=TIERS) -> DataFrame:
    """Calendar-month use per key against the allowance, and the scan that
    crossed it (the ``allowance + 1``-th in ``(ts, event_id)`` order).  A key
    that changes tier within a month is counted against each tier by itself.

    Finding the crossing scan never ranks a whole key-month: per-minute counts
    (a partial aggregate) are accumulated on the ``(key, month, minute)``
    table -- at most 44,640 rows per key-month -- which pins the crossing to
    one minute; only that minute's scans of that key are ranked.
    """
    t = F.broadcast(tier_frame(scans.sparkSession, tiers))
    s = (scans.withColumn("month", F.date_trunc("month", "ts").cast("timestamp_ntz"))
         .withColumn("minute", F.date_trunc("minute", "ts").cast("timestamp_ntz")))
    per_min = s.groupBy("key_id", "tier", "month", "minute").agg(F.count(F.lit(1)).alias("n_min"))
    w = Window.partitionBy("key_id", "tier", "month").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    per_min = (per_min.join(t, "tier", "left")
               .withColumn("before", F.coalesce(F.sum("n_min").over(w), F.lit(0))))
    monthly = (per_min.groupBy("key_id", "tier", "month")
               .agg(F.sum("n_min").alias("n_scans"), F.first("per_month").alias("allowance")))
    crossing_min = per_min.where(F.col("per_month").isNotNull()
                                 & (F.col("before") < F.col("per_month") + 1)
                                 & (F.col("before") + F.col("n_min") >= F.col("per_month") + 1))
    wm = Window.partitionBy("key_id", "tier", "minute").orderBy("ts", "event_id")
    crossing = (s.join(crossing_min.select("key_id", "tier", "minute", "before", "per_month"), ["key_id", "tier", "minute"], "inner")
                .withColumn("_rn", F.row_number().over(wm) + F.col("before"))
                .where(F.col("_rn") == F.col("per_month") + 1)
                .select("key_id", "tier", "month", F.col("event_id").alias("crossed_event_id"),
                        F.col("ts").alias("crossed_ts")))
    return (monthly.join(crossing, ["key_id", "tier", "month"], "left")
            .select("key_id", "tier", F.col("month").alias("month_start"), "n_scans", "allowance",
                    F.greatest(F.col("n_scans") - F.col("allowance"), F.lit(0)).cast("long").alias("over_by"),
                    "crossed_event_id", "crossed_ts"))


def quota_asof(scans: DataFrame, changes: DataFrame, tiers=TIERS) -> DataFrame:
    """Calendar-month use per key and *tier in force* at each scan, against the
    tier's allowance.

    ``changes`` (key_id, since, new_tier) is the log of a key's changes; before
    the first one a scan's own ``tier`` holds.  The tier is carried to the
    scans by an as-of join over chunks of time, then counted by a partial
    aggregate."""
    t = F.broadcast(tier_frame(scans.sparkSession, tiers))
    billed = asof_join(scans, changes, ["key_id"], "ts", "since", ["new_tier"])
    billed = billed.withColumn("tier", F.coalesce("new_tier", "tier")).withColumn("month_start", F.date_trunc("month", "ts").cast("timestamp_ntz"))
    monthly = billed.groupBy("key_id", "tier", "month_start").agg(F.count(F.lit(1)).alias("n_scans"))
    return monthly.join(t, "tier", "left").select(
        "key_id", "tier", "month_start", "n_scans", F.col("per_month").alias("allowance"),
        F.greatest(F.col("n_scans") - F.col("per_month"), F.lit(0)).cast("long").alias("over_by"))


def quota_rolling(scans: DataFrame, seconds: int = 60, tiers=TIERS) -> DataFrame:
    """For every scan, the key's scans in the ``seconds`` up to and with it, the
    tier's rate limit, and the excess over it: what a sliding-window limiter
    sees, where a limit per calendar minute lets twice the rate pass at a
    minute's border."""
    t = F.broadcast(tier_frame(scans.sparkSession, tiers))
    n = rolling_count(scans, "key_id", "ts", seconds, "n_recent")
    return n.join(t, "tier", "left").select(
        "key_id", "event_id", "tier", "ts", "n_recent", F.col("per_minute").alias("rate_limit"),
        F.greatest(F.col("n_recent") - F.col("per_minute"), F.lit(0)).cast("long").alias("excess"))


def sessions(scans: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Bursts of a key: scans less than ``gap`` apart, with their first and last
    scan.  In a stream (``ts`` with a watermark) a burst is given out once the
    watermark has passed its end by the gap."""
    s = scans.groupBy(F.session_window("ts", gap).alias("w"), "key_id").agg(
        F.count(F.lit(1)).alias("n_scans"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return s.select("key_id", F.col("first_ts").cast("timestamp_ntz").alias("first_ts"), F.col("last_ts").cast("timestamp_ntz").alias("last_ts"), "n_scans")


def threat_rollup(verdicts: DataFrame) -> DataFrame:
    """Unsafe verdict counts by (type, severity) with subtotals and a grand total."""
    v = verdicts.where(~F.col("safe"))
    return (v.rollup("threat_type", "severity")
            .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level")))
