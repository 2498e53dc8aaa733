"""Decisions, retries, failure policy and outage detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.running import chunked_running
from ..plans.temporal import in_any_interval

# FIXED VALUES: retry defaults (attempts, first backoff seconds, multiplier, cap).
MAX_ATTEMPTS = 3
INITIAL_BACKOFF = 0.2
BACKOFF_MULTIPLIER = 2.0
MAX_BACKOFF = 5.0
# FIXED VALUES: breaker trip threshold (consecutive failed calls).
FAILURE_THRESHOLD = 5

# FIXED VALUES: block messages per client family.
BLOCK_PREFIX_OPENAI = "Request blocked: "
BLOCK_DEFAULT_OPENAI = "Security threat detected"

# Our own wording for a request whose log has no attempt within the limit.
UNLOGGED_MESSAGE = "no attempt within the limit was logged"

# Seconds of event time per chunk when tracking failure streaks: one minute
# of one endpoint is the largest group a single task sorts.
STREAK_CHUNK_SECONDS = 60


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Our own wording for a verdict that cannot be read, and for the block message
# of clients other than OpenAI's when there is no reason.
MALFORMED_MESSAGE = "the scan service returned a malformed verdict"
BLOCK_DEFAULT_OTHER = "Blocked by the security scan"
#: Decision of a request whose verdict is known to be missing its content.
NO_VERDICT = "error"


def decide(df: DataFrame, safe: str = "safe") -> DataFrame:
    """safe -> allow, unsafe -> block; a verdict without an answer (``safe``
    NULL) -> error, never allow: apply the failure policy first if it is to
    fail open."""
    return df.withColumn("decision", F.when(F.col(safe).isNull(), NO_VERDICT).when(F.col(safe), "allow").otherwise("block"))


def resolve_malformed(verdicts: DataFrame, mode: str | Column = "open") -> DataFrame:
    """Sanitised verdicts -> decisions, malformed ones by the failure policy.

    A valid verdict allows or blocks.  A malformed one is a failed scan: fail
    open allows it with the client's reason, fail closed makes an error row."""
    valid = F.coalesce(F.col("valid"), F.lit(False))
    policy = apply_fail_mode(
        verdicts.withColumnsRenamed({"safe": "_safe", "reason": "_reason"}).withColumns({
            "kind": F.when(valid, F.lit("ok")).otherwise(F.lit("parse")), "scan_kind": F.lit("prompt"),
            "status": F.lit(None).cast("int"), "message": F.lit(MALFORMED_MESSAGE)}), mode)
    answered = F.when(F.col("_safe"), F.lit("allow")).otherwise(F.lit("block"))
    return (policy.withColumn("decision", F.when(F.col("decision") == "scanned", answered).otherwise(F.col("decision")))
            .withColumn("safe", F.coalesce(F.col("_safe"), F.col("safe")))
            .withColumn("reason", F.coalesce(F.col("_reason"), F.col("reason")))
            .drop("_safe", "_reason", "kind", "scan_kind", "status", "message", "degraded"))


def _stops(verdicts: DataFrame) -> Column:
    """Verdicts that keep a request from being sent: by their decision, or
    without one, unless they say safe."""
    if "decision" in verdicts.columns:
        return F.coalesce(F.col("decision"), F.lit(NO_VERDICT)) != "allow"
    return ~F.coalesce(F.col("safe"), F.lit(False))


def allowed(requests: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """Requests that nothing stops (left anti join on ``key``)."""
    return requests.join(verdicts.where(_stops(verdicts)).select(key), key, "left_anti")


def blocked(requests: DataFrame, verdicts: DataFrame, key: str,
            provider: str | Column = "openai") -> DataFrame:
    """Block report rows for requests with an unsafe verdict.

    OpenAI-style clients prefix ``Request blocked: `` to the reason (the
    sanitised verdict always carries the key, so a JSON-null reason renders
    as ``None``); other clients use the reason itself.  Only OpenAI-style
    clients carry violations: an array of (type, description), taken from the
    verdict where it has one.
    """
    prov = F.lit(provider) if isinstance(provider, str) else provider
    v = verdicts.where(~F.coalesce(F.col("safe"), F.lit(True)))
    default = F.when(prov == "openai", F.lit(BLOCK_DEFAULT_OPENAI)).otherwise(F.lit(BLOCK_DEFAULT_OTHER))
    # A verdict table without a reason column renders the client's default text.
    reason = F.coalesce(F.col("reason"), F.lit("None")) if "reason" in verdicts.columns else default
    none = F.array().cast("array<struct<type:string,description:string>>")
    violations = F.coalesce(F.col("violations"), none) if "violations" in verdicts.columns else none
    return (requests.join(v, key, "inner")
            .withColumn("provider", prov)
            .withColumn("message", F.when(prov == "openai", F.concat(F.lit(BLOCK_PREFIX_OPENAI), reason))
                        .otherwise(reason))
            .withColumn("violations", F.when(prov == "openai", violations).otherwise(none))
            .withColumn("n_violations", F.size("violations")))


def retryable(kind: Column, status: Column) -> Column:
    """Timeouts, connection errors and 5xx retry; 4xx, breaker-open and other
    errors do not."""
    return (F.when(kind.isin("timeout", "connect"), F.lit(True))
            .when(kind == "http", F.coalesce(status >= 500, F.lit(False)))
            .otherwise(F.lit(False)))


def classify_error(df: DataFrame) -> DataFrame:
    return df.withColumn("retryable", F.when(F.col("kind") != "ok", retryable(F.col("kind"), F.col("status"))))


def total_backoff(n_retries: Column, initial: float = INITIAL_BACKOFF,
                  mult: float = BACKOFF_MULTIPLIER, cap: float = MAX_BACKOFF) -> Column:
    """Seconds slept before ``n_retries`` retries: sum of min(initial*mult^k, cap)."""
    total = F.aggregate(F.sequence(F.lit(0), n_retries - 1), F.lit(0.0),
                        lambda acc, k: acc + F.least(F.lit(initial) * F.pow(F.lit(mult), k), F.lit(cap)))
    return F.when(n_retries > 0, total).otherwise(F.lit(0.0))


def retry_resolve(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS,
                  initial: float = INITIAL_BACKOFF, mult: float = BACKOFF_MULTIPLIER,
                  cap: float = MAX_BACKOFF) -> DataFrame:
    """One outcome per request from its attempt log.

    The terminal attempt is the first success or non-retryable error;
    failing that, the last attempt within ``max_attempts``.  Attempts logged
    after it never happened; a request logged only past ``max_attempts`` gets
    an ``unlogged`` error row.  Implemented as one grouped aggregate with
    ``min(struct)`` (map-side combined, so a request with a huge log is still
    cheap); backoff is a closed form of the terminal attempt number.
    """
    within = F.col("attempt") <= max_attempts
    a = (attempts.withColumn("_retry", retryable(F.col("kind"), F.col("status")))
         .withColumn("_terminal", (F.col("kind") == "ok") | ~F.col("_retry")))
    row = F.struct("attempt", "kind", "status", "message", "ts")
    g = (a.groupBy("request_id")
         .agg(F.min("endpoint").alias("endpoint"), F.min("scan_kind").alias("scan_kind"),
              F.min(F.when(within & F.col("_terminal"), row)).alias("_term"),
              F.max(F.when(within, row)).alias("_last"), F.min("ts").alias("_first_ts")))
    unlogged = F.struct(F.lit(max_attempts).alias("attempt"), F.lit("unlogged").alias("kind"), F.lit(None).cast("int").alias("status"),
                        F.lit(UNLOGGED_MESSAGE).alias("message"), F.col("_first_ts").alias("ts"))
    pick = F.coalesce(F.col("_term"), F.col("_last"), unlogged)
    return g.select(
        "request_id", "endpoint", "scan_kind",
        pick["attempt"].alias("attempts"),
        pick["kind"].alias("kind"),
        pick["status"].alias("status"),
        pick["message"].alias("message"),
        pick["ts"].alias("resolved_ts"),
        (pick["kind"] == "ok").alias("succeeded"),
        F.round(total_backoff(pick["attempt"] - 1, initial, mult, cap), 6).alias("backoff_s"))


def apply_fail_mode(resolved: DataFrame, mode: str | Column = "open") -> DataFrame:
    """Turn an unresolved scan into a verdict (fail open) or an error row
    (fail closed), with the client's exact texts.

    ``kind``: ok, timeout, connect, http (with ``status``), breaker_open, or
    any other error (``message`` holds its text).  ``scan_kind`` picks the
    prompt or SQL/file wording.
    """
    m = F.lit(mode) if isinstance(mode, str) else mode
    kind, sk, msg = F.col("kind"), F.col("scan_kind"), F.coalesce(F.col("message"), F.lit(""))
    status = F.col("status").cast("string")
    is_open = m == "open"
    label = F.when(sk == "sql", F.lit("SQL")).otherwise(F.lit("File"))
    open_reason = (F.when(kind == "breaker_open", F.lit("Circuit breaker open, failing open"))
                   .when(kind == "timeout", F.lit("Scan timeout, failing open"))
                   .when((kind == "http") & (sk == "prompt"), F.concat(F.lit("Scan API error: "), status))
                   .otherwise(F.concat(F.lit("Scan error: "), msg)))
    closed_error = (F.when(kind == "breaker_open", F.lit("Security service circuit breaker open"))
                    .when((kind == "timeout") & (sk == "prompt"),
                          F.lit("Scan request timed out and fail_mode is 'closed'"))
                    .when(kind == "timeout", F.concat(label, F.lit(" scan request timed out")))
                    .when((kind == "http") & (sk == "prompt"), F.concat(F.lit("Scan API returned error: "), status))
                    .when(sk == "prompt", F.concat(F.lit("Scan failed: "), msg))
                    .otherwise(F.concat(label, F.lit(" scan failed: "), msg)))
    failed = kind != "ok"
    return (resolved.withColumn("fail_mode", m)
            .withColumn("decision", F.when(~failed, F.lit("scanned"))
                        .when(is_open, F.lit("allow")).otherwise(F.lit("error")))
            .withColumn("safe", F.when(failed & is_open, F.lit(True)))
            .withColumn("reason", F.when(failed & is_open, open_reason))
            .withColumn("degraded", F.when(failed & is_open & (kind == "breaker_open"), F.lit(True)))
            .withColumn("error", F.when(failed & ~is_open, closed_error)))


def _anchor(ok: Column) -> Column:
    return F.when(ok, F.struct(F.col("ts").alias("a_ts"), F.col("event_id").alias("a_id")))


def streaks(outcomes: DataFrame, chunk_seconds: int = STREAK_CHUNK_SECONDS) -> DataFrame:
    """Tag every failed call with its streak: the last success before it.

    Gaps and islands without a per-endpoint window: the running max of the
    last success ``(ts, event_id)`` is computed per time chunk and carried
    across chunks (see :func:`tollgate.plans.running.chunked_running`), so a
    hot endpoint is spread over as many tasks as it has chunks.
    """
    chunk = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(chunk_seconds * 1_000_000))
    tagged = chunked_running(outcomes, ["endpoint"], ["ts", "event_id"], chunk=chunk,
                             value=_anchor(F.col("ok")), how="max", out="anchor")
    return tagged.where(~F.col("ok"))


def outage_episodes(outcomes: DataFrame, threshold: int = FAILURE_THRESHOLD,
                    chunk_seconds: int = STREAK_CHUNK_SECONDS) -> DataFrame:
    """Runs of at least ``threshold`` consecutive failed calls per endpoint
    (the breaker's trip rule), ordered by ``(ts, event_id)``.

    Rows: ``(endpoint, start_ts, end_ts, first_event_id, last_event_id,
    n_failures)``.  The final grouping is a partial aggregate.
    """
    f = streaks(outcomes, chunk_seconds)
    first = F.struct("ts", "event_id")
    return (f.groupBy("endpoint", "anchor")
            .agg(F.count(F.lit(1)).alias("n_failures"), F.min(first).alias("_s"), F.max(first).alias("_e"))
            .where(F.col("n_failures") >= threshold)
            .select("endpoint", F.col("_s")["ts"].alias("start_ts"), F.col("_e")["ts"].alias("end_ts"),
                    F.col("_s")["event_id"].alias("first_event_id"),
                    F.col("_e")["event_id"].alias("last_event_id"), "n_failures"))


def breaker_trips(outcomes: DataFrame, threshold: int = FAILURE_THRESHOLD,
                  chunk_seconds: int = STREAK_CHUNK_SECONDS) -> DataFrame:
    """(endpoint, trip_ts): the failure that made a run ``threshold`` long.
    Failures are counted through a run chunk by chunk of time."""
    f = streaks(outcomes, chunk_seconds)
    chunk = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(chunk_seconds * 1_000_000))
    counted = chunked_running(f, ["endpoint", "anchor"], ["ts", "event_id"], chunk, F.lit(1), "sum", "k")
    return counted.where(F.col("k") == threshold).select("endpoint", F.col("ts").alias("trip_ts"))


def breaker_attempts(attempts: DataFrame, threshold: int = FAILURE_THRESHOLD, cooldown_seconds: int = 60,
                     bin_seconds: int | None = None) -> DataFrame:
    """The attempt log as a breaker would have left it: an attempt at an
    endpoint later than a trip and less than the cool-down after it is
    ``breaker_open`` (no status, no message).  Runs are those of the log as
    given."""
    outcomes = attempts.select("endpoint", (F.col("request_id") * 1000 + F.col("attempt")).alias("event_id"), "ts", (F.col("kind") == "ok").alias("ok"))
    trips = breaker_trips(outcomes, threshold)
    spans = trips.select("endpoint", (F.col("trip_ts") + F.expr("interval 1 microsecond")).alias("open_ts"),
                         (F.col("trip_ts") + F.make_dt_interval(secs=F.lit(cooldown_seconds).cast("decimal(18,6)"))).alias("until_ts"))
    a = in_any_interval(attempts, spans, ["endpoint"], "ts", "open_ts", "until_ts", bin_seconds or cooldown_seconds, "_open")
    return (a.withColumn("kind", F.when(F.col("_open"), F.lit("breaker_open")).otherwise(F.col("kind")))
            .withColumn("status", F.when(~F.col("_open"), F.col("status"))).withColumn("message", F.when(~F.col("_open"), F.col("message"))).drop("_open"))


def scan_stats(attempts: DataFrame) -> DataFrame:
    """Per-endpoint success / failure counters and the last failure time."""
    failed = F.col("kind") != "ok"
    return (attempts.groupBy("endpoint")
            .agg(F.count(F.lit(1)).alias("n_attempts"),
                 F.count_if(~failed).alias("n_success"),
                 F.count_if(failed).alias("n_failure"),
                 F.max(F.when(failed, F.col("ts"))).alias("last_failure_ts")))
