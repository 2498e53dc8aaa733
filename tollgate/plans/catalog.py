"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or inputs Spark derives from them by a
fixed rule, see :mod:`tollgate.sources.derived`) in full.  Column names
match the oracle SQL in :mod:`tollgate.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import MAX_CONTENT_CHARS
from ..operators import custom as C
from ..operators import detect as D
from ..operators import extract as E
from ..operators import gates as G
from ..operators import payload as PL
from ..operators import policy as P
from ..operators import quota as Q
from ..operators import requests as RQ
from ..operators import spans as SP
from ..operators import verdicts as V
from ..session import scratch_path
from .governance import conversation_findings, conversation_verdicts, govern_conversations, govern_documents, history_verdicts
from .sizing import barrier, spread_for_cpu
from ..sources import derived
from ..sources.sinks import write_routed
from ..sources.tables import (parse_requests, parse_verdicts, read_attempts, read_json_lines,
                              read_messages, read_table, read_verdicts)
from ..streaming import jobs as S
from ..streaming import requests as SR

Query = Callable[[SparkSession, str], DataFrame]
ALL_FAMILIES = ("pii", "secrets", "code", "prompt")
#: Our own wording for a conversation whose text cannot be joined.
PAYLOAD_ERROR = "a message has no text"
PROVIDERS = ("openai", "anthropic", "gemini")


def _docs(spark, d, cols=("doc_id", "text")):
    return read_table(spark, d, "documents", list(cols))


def _text_docs(spark, d, cols=("doc_id", "text")):
    """Documents for regex-heavy work, spread over all cores when the scan
    alone would not be (see :func:`tollgate.plans.sizing.spread_for_cpu`),
    with something for every rule to find."""
    return derived.planted_documents(spread_for_cpu(_docs(spark, d, cols)))


def _messages(spark, d, roles=("user",)):
    return derived.planted_messages(read_messages(spark, d, roles=roles))


def _events(spark, d):
    return read_table(spark, d, "events")


def _external_verdicts(spark, d) -> DataFrame:
    """Raw verdicts for every document, parsed with presence flags."""
    return parse_verdicts(derived.raw_verdicts(_docs(spark, d, ("doc_id",)), "doc_id"))


# ---------------------------------------------------------------------------
# flagship: documents -> detect -> assemble -> normalise -> decide
# ---------------------------------------------------------------------------
def governed_documents(spark: SparkSession, d: str) -> DataFrame:
    return govern_documents(_text_docs(spark, d))


def governed_conversations(spark: SparkSession, d: str) -> DataFrame:
    return govern_conversations(_messages(spark, d, roles=None))


# ---------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------
def q_src_messages(spark, d):
    return read_messages(spark, d)


def q_src_requests(spark, d):
    """Written once as JSON lines, a few of them broken off, then read as any
    request log is."""
    path = scratch_path(spark, "requests")
    derived.request_lines(derived.chat_requests(read_messages(spark, d, roles=None), "openai")).write.text(path)
    req = parse_requests(read_json_lines(spark, path))
    return req.select(F.try_variant_get("body", "$.id", "long").alias("request_id"), "valid", "n_messages", "n_user_messages")


def _finite(df, name: str):
    """Results hold finite numbers: NaN and infinities are NULL, and told from
    a missing number by a flag."""
    c = F.col(name)
    finite = F.when(c.isNotNull(), ~(F.isnan(c) | c.isin(float("inf"), float("-inf"))))
    return df.withColumn(f"{name}_finite", finite).withColumn(name, F.when(F.col(f"{name}_finite"), c))


def q_src_verdicts(spark, d):
    """Written once as a log of lines, then read as any verdict log is."""
    path = scratch_path(spark, "verdicts")
    derived.verdict_lines(derived.raw_verdicts(_docs(spark, d, ("doc_id",)), "doc_id")).write.text(path)
    return _finite(read_verdicts(spark, path)[0], "confidence")


def q_src_attempts(spark, d):
    path = scratch_path(spark, "attempts")
    derived.attempts(_events(spark, d)).write.parquet(path)
    return read_attempts(spark, path)


def q_sink_routed(spark, d):
    path = scratch_path(spark, "routed")
    write_routed(governed_documents(spark, d), path)
    return spark.read.parquet(path).select("item_id", "decision", "threat_type", "severity",
                                           "confidence", "n_findings")


# ---------------------------------------------------------------------------
# extraction and payloads
# ---------------------------------------------------------------------------
def _extract(dialect: str) -> Query:
    def q(spark, d):
        req = parse_requests(derived.chat_requests(read_messages(spark, d, roles=None), dialect))
        return E.extract_text(req, dialect).select("request_id", "text", "extract_error")
    return q


def q_payload_conversation(spark, d):
    return PL.payload_conversation(_messages(spark, d, roles=None))


def q_payload_history(spark, d):
    return PL.payload_history(_messages(spark, d))


def q_history_verdicts(spark, d):
    """Verdicts of every resent history; chunks short enough to be crossed."""
    return history_verdicts(_messages(spark, d), chunk_turns=2)


def q_payload_latest(spark, d):
    return PL.payload_latest(_messages(spark, d))


# ---------------------------------------------------------------------------
# gates and requests
# ---------------------------------------------------------------------------
def q_gate_empty(spark, d):
    p = PL.payload_conversation(_messages(spark, d, roles=None))
    return G.gate_empty(p).select("conv_id", "is_empty", "empty_reason")


def q_gate_size(spark, d):
    g = G.gate_size(derived.planted_documents(_docs(spark, d, ("doc_id", "text", "source"))), content="text", context="source")
    return g.select(F.col("doc_id").alias("item_id"), "size_chars", "oversize", "size_reason",
                    "size_threat_type", "size_confidence", "violation_type", "violation_description")


def _prompts(spark, d):
    # A conversation the client would raise on keeps its row, without a body.
    p = PL.payload_conversation(_messages(spark, d, roles=None))
    r = RQ.prompt_request(p, "payload").withColumn("body", F.when(~F.col("payload_error"), F.col("body")))
    return r.select(F.lit("conversation").alias("source"), F.col("conv_id").alias("request_id"), "route", "content_type", "body",
                    F.when(F.col("payload_error"), F.lit(PAYLOAD_ERROR)).alias("local_reason"))


def _sqls(spark, d):
    return (RQ.gated(RQ.sql_request(derived.sql_statements(_events(spark, d))), "text")
            .select(F.lit("sql").alias("source"), F.col("stmt_id").alias("request_id"),
                    "route", "content_type", "body", "local_reason"))


def _files(spark, d):
    files = derived.file_requests(derived.planted_documents(_docs(spark, d, ("doc_id", "text", "lang", "source"))))
    return (RQ.gated(RQ.file_request(files), "path", "content")
            .select(F.lit("file").alias("source"), F.col("file_id").alias("request_id"),
                    "route", "content_type", "body", "local_reason"))


def q_request_prompt(spark, d):
    return _prompts(spark, d).drop("source")


def q_request_sql(spark, d):
    return _sqls(spark, d).drop("source")


def q_request_file(spark, d):
    return _files(spark, d).drop("source")


def q_request_union(spark, d):
    return RQ.request_union(_prompts(spark, d), _sqls(spark, d), _files(spark, d))


# ---------------------------------------------------------------------------
# verdict normalisation
# ---------------------------------------------------------------------------
def q_normalize_threat(spark, d):
    v = _external_verdicts(spark, d)
    return (V.normalize_threat(v, "threat_type", "canonical")
            .select("item_id", F.col("threat_type").alias("raw_threat_type"),
                    F.col("canonical").alias("threat_type")))


def q_derive_severity(spark, d):
    v = V.normalize_threat(_external_verdicts(spark, d), "threat_type", "canonical")
    return (V.derive_severity(v, "canonical", "severity", "severity_out")
            .select("item_id", F.col("canonical").alias("threat_type"),
                    F.col("severity").alias("raw_severity"), F.col("severity_out").alias("severity")))


def q_bucket_confidence(spark, d):
    v = V.bucket_confidence(_external_verdicts(spark, d), "confidence", "level")
    v = v.select("item_id", F.col("confidence").alias("confidence_score"), F.col("level").alias("confidence"))
    return _finite(v, "confidence_score")


def q_guidance(spark, d):
    v = V.normalize_threat(_external_verdicts(spark, d), "threat_type", "canonical")
    return (V.with_guidance(v, "canonical", "guidance_text")
            .select("item_id", F.col("canonical").alias("threat_type"),
                    F.col("guidance_text").alias("guidance")))


def q_sanitize_verdicts(spark, d):
    return V.sanitize(_external_verdicts(spark, d)).drop("valid")


def q_tier_note(spark, d):
    s = V.sanitize(_external_verdicts(spark, d)).withColumn("has_key", F.col("item_id") % 5 != 0)
    return V.tier_note(s).select("item_id", "safe", "has_key", "note")


# ---------------------------------------------------------------------------
# policy
# ---------------------------------------------------------------------------
def q_decide(spark, d):
    return governed_documents(spark, d)


def q_conversation_decisions(spark, d):
    return governed_conversations(spark, d)


def q_allowed_messages(spark, d):
    msgs = read_messages(spark, d, roles=None)
    convs = msgs.select("conv_id").distinct()
    verdicts = P.resolve_malformed(V.sanitize(parse_verdicts(derived.raw_verdicts(convs, "conv_id"))), _mode_by_id())
    return P.allowed(msgs, barrier(verdicts).withColumnRenamed("item_id", "conv_id"), "conv_id")


def _mode_by_id():
    return F.when(F.col("item_id") % 2 == 0, F.lit("open")).otherwise(F.lit("closed"))


def q_govern_verdicts(spark, d):
    v = P.resolve_malformed(V.sanitize(_external_verdicts(spark, d)), _mode_by_id())
    return v.select("item_id", "fail_mode", "decision", "safe", "reason", "threat_type", "severity", "confidence", "error")


def q_blocked_report(spark, d):
    reqs = _docs(spark, d, ("doc_id",)).select(
        F.col("doc_id").alias("item_id"),
        F.element_at(F.array(*[F.lit(p) for p in PROVIDERS]), (F.col("doc_id") % 3 + 1).cast("int"))
        .alias("provider"))
    # One verdict in seven names a violation of its own.
    violation = F.array(F.struct(F.lit("policy").alias("type"), F.col("guidance").alias("description")))
    v = barrier(V.sanitize(_external_verdicts(spark, d))).withColumn("violations", F.when(F.col("item_id") % 7 == 0, violation))
    listed = F.array_join(F.transform("violations", lambda x: F.concat_ws(": ", x["type"], x["description"])), "; ")
    return (P.blocked(reqs, v, "item_id", F.col("provider")).withColumn("violations", listed)
            .select("item_id", "provider", "message", "threat_type", "confidence", "violations", "n_violations"))


def _attempts(spark, d):
    return derived.attempts(_events(spark, d))


def q_classify_error(spark, d):
    return P.classify_error(_attempts(spark, d)).select("request_id", "attempt", "kind", "status", "retryable")


def q_retry_resolve(spark, d):
    return P.retry_resolve(_attempts(spark, d))


def q_fail_mode(spark, d):
    r = P.retry_resolve(_attempts(spark, d))
    mode = F.when(F.col("endpoint").isin("ep0", "ep1", "ep2"), F.lit("open")).otherwise(F.lit("closed"))
    return (P.apply_fail_mode(r, mode)
            .select("request_id", "fail_mode", "decision", "safe", "reason", "degraded", "error"))


#: Failures that trip the breaker, its cool-down, and the attempts of a request in the registered query.
TRIP_AFTER, COOLDOWN_SECONDS, TRIES = 3, 4 * 3600, 2


def q_breaker_outcomes(spark, d):
    """Attempts while the breaker is open never reach the service."""
    r = P.retry_resolve(P.breaker_attempts(derived.gappy_attempts(_events(spark, d)), TRIP_AFTER, COOLDOWN_SECONDS), max_attempts=TRIES)
    mode = F.when(F.col("endpoint").isin("ep0", "ep1", "ep2"), F.lit("open")).otherwise(F.lit("closed"))
    return (P.apply_fail_mode(r, mode)
            .select("request_id", "kind", "attempts", "fail_mode", "decision", "safe", "reason", "degraded", "error"))


def q_outage_episodes(spark, d):
    return P.outage_episodes(derived.outcomes(_events(spark, d)))


def q_scan_stats(spark, d):
    return P.scan_stats(_attempts(spark, d))


# ---------------------------------------------------------------------------
# detectors
# ---------------------------------------------------------------------------
def q_detect_pii(spark, d):
    return D.detect(_text_docs(spark, d), "text", ("pii",), "doc_id")


def q_detect_secrets(spark, d):
    return D.detect(_text_docs(spark, d), "text", ("secrets",), "doc_id")


def q_detect_code(spark, d):
    return D.detect(_text_docs(spark, d), "text", ("code",), "doc_id")


def q_detect_prompt(spark, d):
    return conversation_findings(_messages(spark, d), ("prompt",))


def q_detect_sql(spark, d):
    return D.detect_sql(derived.sql_statements(spread_for_cpu(_events(spark, d))))


def q_detect_path(spark, d):
    files = derived.file_requests(_text_docs(spark, d, ("doc_id", "text", "lang", "source")))
    return D.detect_path(files)


def q_detect_domain(spark, d):
    return D.detect_domain(read_table(spark, d, "pages", ["page_id", "url"]))


def q_detect_domain_large(spark, d):
    """A block list that grows with the pages, behind the Bloom filter."""
    pages = read_table(spark, d, "pages", ["page_id", "url"])
    return D.detect_domain(pages, blocklist=derived.blocked_domains(pages))


def q_label_toxicity(spark, d):
    return D.label_toxicity(_docs(spark, d, ("doc_id",)), read_table(spark, d, "labels"))


def q_rule_scan(spark, d):
    rules = D.rules_frame(spark, [r for fam in ALL_FAMILIES for r in R.RULE_FAMILIES[fam]])
    return D.rule_scan(_text_docs(spark, d), "doc_id", "text", rules)


def q_rule_scan_large(spark, d):
    """A rule table that grows with the documents, through the index."""
    docs = _text_docs(spark, d)
    return D.rule_scan(docs, "doc_id", "text", derived.document_rules(_docs(spark, d)))


def q_assemble_verdict(spark, d):
    f = _text_docs(spark, d).select(F.col("doc_id").alias("item_id"),
                               D.findings(F.col("text"), ALL_FAMILIES).alias("findings"))
    return D.assemble(f, "findings").select("item_id", "safe", "threat_type", "confidence",
                                            "severity", "n_findings")


def q_assemble_findings(spark, d):
    """One verdict per document from pattern, rule-table, domain and label
    detectors (a page counts for the document of the same number)."""
    docs = _text_docs(spark, d)
    rules = D.rules_frame(spark, R.PROMPT_RULES + R.CODE_RULES)
    rows = D.union_findings(
        D.detect(docs, "text", ("pii", "secrets"), "doc_id"), D.rule_scan(docs, "doc_id", "text", rules),
        D.detect_domain(read_table(spark, d, "pages", ["page_id", "url"])),
        D.label_toxicity(_docs(spark, d, ("doc_id",)), read_table(spark, d, "labels")))
    return D.assemble_rows(_docs(spark, d, ("doc_id",)), "doc_id", rows)


def q_redact_pii(spark, d):
    return D.redact_pii(_text_docs(spark, d)).select(F.col("doc_id").alias("item_id"), "redacted")


def q_located_findings(spark, d):
    """Personal data and secrets with their places."""
    return SP.located(_text_docs(spark, d), "text", ("pii", "secrets"), "doc_id")


def q_redact_findings(spark, d):
    return SP.redact_findings(_text_docs(spark, d)).select(F.col("doc_id").alias("item_id"), "redacted")


#: Share by which the estimates of merged sketches may miss (three standard
#: errors of the default size, rounded up).
COVERAGE_ERROR = 0.05


def q_coverage_merged(spark, d):
    """Coverage of scanned keys from daily sketches, beside the exact counts."""
    verdicts = V.sanitize(_external_verdicts(spark, d))
    scans = derived.scans(_events(spark, d)).select("key_id", F.date_trunc("day", "ts").alias("scanned"), "event_id")
    v = barrier(verdicts.select("item_id", "safe", "threat_type"))
    billed = scans.join(v, scans["event_id"] == v["item_id"]).select(F.col("key_id").alias("item_id"), "scanned", "safe", "threat_type")
    path = scratch_path(spark, "coverage-daily")
    D.coverage_daily(billed, "scanned").write.parquet(path)
    merged = D.merged_coverage(spark.read.parquet(path))
    exact = D.framework_coverage(billed).select("framework", F.col("n_findings").alias("all_findings"), F.col("n_items").alias("exact_items"))
    near = F.abs(F.col("n_items") - F.col("exact_items")) <= F.lit(COVERAGE_ERROR) * F.col("exact_items")
    return merged.join(exact, "framework").select("framework", "n_findings", F.col("exact_items").alias("n_items"), near.alias("estimate_near"))


def q_framework_coverage(spark, d):
    v = barrier(governed_documents(spark, d)).withColumn("safe", F.col("decision") == "allow")
    return D.framework_coverage(v)


# ---------------------------------------------------------------------------
# quotas and roll-ups
# ---------------------------------------------------------------------------
def q_quota_minute(spark, d):
    return Q.quota_minute(derived.scans(_events(spark, d)), Q.TRIAL_TIERS)


def q_quota_month(spark, d):
    return Q.quota_month(derived.scans(_events(spark, d)), Q.TRIAL_TIERS)


def q_quota_asof(spark, d):
    ev = _events(spark, d)
    return Q.quota_asof(derived.scans(ev), derived.tier_changes(ev), Q.TRIAL_TIERS)


#: Window of the registered rolling limit and gap of the registered bursts.
ROLLING_SECONDS, BURST_GAP = 6 * 3600, "6 hours"


def q_quota_rolling(spark, d):
    return Q.quota_rolling(derived.scans(_events(spark, d)), ROLLING_SECONDS, Q.TRIAL_TIERS)


def q_sessions(spark, d):
    return Q.sessions(derived.scans(_events(spark, d)), BURST_GAP)


def q_threat_rollup(spark, d):
    return Q.threat_rollup(barrier(V.sanitize(_external_verdicts(spark, d))))


# ---------------------------------------------------------------------------
# streaming (drained with availableNow, read back from the sink)
# ---------------------------------------------------------------------------
def q_stream_gate(spark, d):
    src = f"{d.rstrip('/')}/documents.parquet"
    schema = spark.read.parquet(src).schema
    out = scratch_path(spark, "stream-gate")
    S.run_gate(spark, S.table_glob(d, "documents"), out, schema,
               partitions=spark.sparkContext.defaultParallelism, prepare=derived.planted_documents)
    return spark.read.parquet(out).select("item_id", "decision", "threat_type", "severity",
                                          "confidence", "n_findings")


def q_stream_quota(spark, d):
    src = f"{d.rstrip('/')}/events.parquet"
    out = scratch_path(spark, "stream-quota")
    S.run_quota(spark, S.table_glob(d, "events"), out, spark.read.parquet(src).schema, tiers=Q.TRIAL_TIERS)
    return spark.read.parquet(out)


def q_stream_sessions(spark, d):
    """The scans as a log of files, a heartbeat among them, drained once."""
    src, out = scratch_path(spark, "scans"), scratch_path(spark, "stream-sessions")
    scans = derived.scans(_events(spark, d)).select("key_id", "ts")
    scans.unionByName(S.heartbeat(scans).select(F.col("endpoint").alias("key_id"), "ts")).write.parquet(src)
    S.run_sessions(spark, src, out, BURST_GAP)
    return spark.read.parquet(out)


def q_stream_requests(spark, d):
    """Conversations judged from a log of requests that resend their history."""
    src, out = scratch_path(spark, "request-log"), scratch_path(spark, "stream-requests")
    derived.resent_requests(_messages(spark, d, roles=None)).write.text(src)
    SR.run_requests(spark, src, out)
    return conversation_verdicts(spark.read.parquet(f"{out}/messages"))


def q_stream_outage(spark, d):
    """Call outcomes as a log of files, a heartbeat among them, drained once."""
    src, out = scratch_path(spark, "outcomes"), scratch_path(spark, "stream-outage")
    calls = derived.outcomes(_events(spark, d)).select("endpoint", "event_id", "ts", "ok")
    calls.unionByName(S.heartbeat(calls)).write.parquet(src)
    S.run_outage(spark, src, out)
    return spark.read.parquet(out)


def q_custom_detector(spark, d):
    """A detector that fails on some texts, behind a caller's size gate."""
    docs = _text_docs(spark, d).withColumnRenamed("doc_id", "item_id")
    return C.custom_detector(docs, C.plain_text_shouting, max_chars=MAX_CONTENT_CHARS)


QUERIES: dict[str, Query] = {
    "src_messages": q_src_messages,
    "src_requests": q_src_requests,
    "src_verdicts": q_src_verdicts,
    "src_attempts": q_src_attempts,
    "sink_routed": q_sink_routed,
    "extract_openai": _extract("openai"),
    "extract_anthropic": _extract("anthropic"),
    "extract_gemini": _extract("gemini"),
    "payload_conversation": q_payload_conversation,
    "payload_history": q_payload_history,
    "history_verdicts": q_history_verdicts,
    "payload_latest": q_payload_latest,
    "gate_empty": q_gate_empty,
    "gate_size": q_gate_size,
    "request_prompt": q_request_prompt,
    "request_sql": q_request_sql,
    "request_file": q_request_file,
    "request_union": q_request_union,
    "normalize_threat": q_normalize_threat,
    "derive_severity": q_derive_severity,
    "bucket_confidence": q_bucket_confidence,
    "guidance": q_guidance,
    "sanitize_verdicts": q_sanitize_verdicts,
    "tier_note": q_tier_note,
    "decide": q_decide,
    "conversation_decisions": q_conversation_decisions,
    "govern_verdicts": q_govern_verdicts,
    "allowed_messages": q_allowed_messages,
    "blocked_report": q_blocked_report,
    "classify_error": q_classify_error,
    "retry_resolve": q_retry_resolve,
    "fail_mode": q_fail_mode,
    "breaker_outcomes": q_breaker_outcomes,
    "outage_episodes": q_outage_episodes,
    "scan_stats": q_scan_stats,
    "detect_pii": q_detect_pii,
    "detect_secrets": q_detect_secrets,
    "detect_sql": q_detect_sql,
    "detect_path": q_detect_path,
    "detect_prompt": q_detect_prompt,
    "detect_code": q_detect_code,
    "detect_domain": q_detect_domain,
    "detect_domain_large": q_detect_domain_large,
    "label_toxicity": q_label_toxicity,
    "rule_scan": q_rule_scan,
    "rule_scan_large": q_rule_scan_large,
    "assemble_verdict": q_assemble_verdict,
    "assemble_findings": q_assemble_findings,
    "located_findings": q_located_findings,
    "redact_pii": q_redact_pii,
    "redact_findings": q_redact_findings,
    "framework_coverage": q_framework_coverage,
    "coverage_merged": q_coverage_merged,
    "quota_minute": q_quota_minute,
    "quota_month": q_quota_month,
    "quota_asof": q_quota_asof,
    "quota_rolling": q_quota_rolling,
    "sessions": q_sessions,
    "threat_rollup": q_threat_rollup,
    "stream_gate": q_stream_gate,
    "stream_quota": q_stream_quota,
    "stream_outage": q_stream_outage,
    "stream_requests": q_stream_requests,
    "stream_sessions": q_stream_sessions,
    "custom_detector": q_custom_detector,
}
