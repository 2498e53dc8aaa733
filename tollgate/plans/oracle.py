"""Oracle SQL (DuckDB dialect) for every registered query that SQL can express.

Written independently of the Spark code: DuckDB runs RE2 instead of Java
regex, JSON functions instead of VARIANT, plain window functions instead of
the chunked running aggregates.  Only fixed values (taxonomy, rule patterns,
input derivations) are generated from the same Python source.
"""

from __future__ import annotations

from ..functions import rules as R
from ..functions.exprs import BLANK_PATTERN, MAX_CONTENT_CHARS
from ..functions.taxonomy import (DEFAULT_SEVERITY, GUIDANCE, RAW_TO_CANONICAL, SEVERITIES)
from ..operators.custom import SHOUT_MIN_LETTERS, SHOUT_RATIO
from ..operators.policy import MALFORMED_MESSAGE, UNLOGGED_MESSAGE
from ..operators.quota import TRIAL_TIERS
from ..operators.verdicts import KEYLESS_NOTE
from ..sources import derived

ALL_FAMILIES = ("pii", "secrets", "code", "prompt")


def lit(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _num(x) -> str:
    return "NULL" if x is None else str(x)


TAXO = "taxo(raw_label, canon) AS (VALUES " + ", ".join(
    f"({lit(k)}, {lit(v)})" for k, v in RAW_TO_CANONICAL.items()) + ")"
TYPES = "types(t, default_severity, guidance, sev_rank) AS (VALUES " + ", ".join(
    f"({lit(t)}, {lit(s)}, {lit(GUIDANCE[t])}, {SEVERITIES.index(s)})"
    for t, s in DEFAULT_SEVERITY.items()) + ")"
TIERS_CTE = "tiers(tier, per_minute, per_month) AS (VALUES " + ", ".join(
    f"({lit(t)}, {_num(m)}, {_num(mo)})" for t, m, mo in TRIAL_TIERS) + ")"


def _cols(mapping: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in mapping.items())


ATTEMPTS = f"att AS (SELECT {_cols(derived.ATTEMPT_COLUMNS_SQL)} FROM events)"
OUTCOMES = f"outc AS (SELECT {_cols(derived.OUTCOME_COLUMNS_SQL)} FROM events)"
SCANS = f"scn AS (SELECT {_cols(derived.SCAN_COLUMNS_SQL)} FROM events)"
STMTS = f"stmts AS (SELECT {_cols(derived.SQL_STATEMENT_COLUMNS_SQL)} FROM events)"
DOCS = f"pd AS (SELECT doc_id, {derived.PLANTED_TEXT_SQL} AS text, lang, source FROM documents)"
MESSAGES = f"pm AS (SELECT conv_id, turn, role, {derived.PLANTED_MESSAGE_SQL} AS text FROM conversations)"
FILES = (f"{DOCS}, files AS (SELECT {_cols(derived.FILE_REQUEST_COLUMNS_SQL)} FROM pd UNION ALL "
         f"SELECT {_cols(derived.PATH_REQUEST_COLUMNS_SQL)} FROM pd WHERE doc_id % 3 <> 0)")

CONF_BUCKET = ("CASE WHEN {c} IS NULL THEN 'medium' WHEN isnan({c}) THEN 'low' "
               "WHEN {c} >= 0.9 THEN 'high' WHEN {c} >= 0.7 THEN 'medium' ELSE 'low' END")


def parsed_verdicts(src: str, id_col: str) -> str:
    """CTEs ``rv`` (raw JSON) and ``pv`` (typed with presence flags)."""
    j = derived.verdict_json_sql(id_col, "duckdb")
    return f"""rv0 AS (SELECT {id_col} AS item_id, {j} AS raw FROM {src}),
rvm AS (SELECT *, replace(replace(regexp_replace(raw, '("[^"\\\\]*(?:\\\\.[^"\\\\]*)*")|-?Infinity|NaN', '\\1' || chr(1), 'g'), '"' || chr(1), '"'), chr(1), 'null') AS finite FROM rv0),
rv1 AS (SELECT *, CASE WHEN json_valid(finite) AND CASE WHEN json_valid(finite) THEN json_type(finite) = 'OBJECT' AND list_contains(json_keys(finite), 'safe') END
    THEN regexp_extract_all(raw, '"safe":[ ]*([^,}}]*)', 1)[-1] END AS safe_raw, regexp_extract(raw, '"confidence":[ ]*(NaN|-?Infinity)', 1) AS odd FROM rvm),
rv AS (SELECT item_id, safe_raw, odd, coalesce(json_valid(finite) AND CASE WHEN json_valid(finite) THEN json_type(finite) = 'OBJECT' END
    AND (safe_raw IS NULL OR safe_raw IN ('true', 'false', 'null')), false) AS valid, finite FROM rv1),
ok AS (SELECT *, CASE WHEN valid THEN finite ELSE '{{}}' END AS js FROM rv),
pv AS (SELECT item_id, valid,
  valid AND safe_raw IS NOT NULL AS has_safe,
  CASE WHEN valid AND safe_raw IS NOT NULL THEN safe_raw = 'true' END AS safe_value,
  json_type(js, '$.reason') IS NOT NULL AS has_reason,
  json_extract_string(js, '$.reason') AS reason,
  json_type(js, '$.threat_type') IS NOT NULL AS has_threat_type,
  json_extract_string(js, '$.threat_type') AS threat_type,
  CASE WHEN NOT valid THEN NULL WHEN odd <> '' THEN CAST(odd AS DOUBLE) ELSE TRY_CAST(json_extract_string(js, '$.confidence') AS DOUBLE) END AS confidence,
  json_extract_string(js, '$.severity') AS severity
FROM ok)"""


def sanitized(src: str, id_col: str) -> str:
    """CTEs through ``san``: the sanitised verdicts."""
    return f"""{TAXO}, {TYPES}, {parsed_verdicts(src, id_col)},
sv AS (SELECT pv.*, CASE WHEN valid THEN CASE WHEN NOT has_safe THEN true ELSE coalesce(safe_value, false) END END AS is_safe,
         coalesce(x.canon, 'unknown') AS canon
       FROM pv LEFT JOIN taxo x
         ON replace(lower(CASE WHEN has_threat_type THEN threat_type ELSE 'unknown' END), '-', '_') = x.raw_label),
san AS (SELECT sv.item_id, sv.valid, sv.is_safe AS safe,
  CASE WHEN has_reason THEN reason WHEN is_safe THEN '' WHEN NOT is_safe THEN ty.guidance END AS reason,
  CASE WHEN NOT is_safe THEN canon END AS threat_type,
  CASE WHEN NOT is_safe THEN CASE WHEN lower(severity) IN ('critical', 'high', 'medium', 'low')
       THEN lower(severity) ELSE ty.default_severity END END AS severity,
  CASE WHEN NOT is_safe THEN {CONF_BUCKET.format(c='confidence')} END AS confidence,
  CASE WHEN NOT is_safe THEN ty.guidance END AS guidance
FROM sv JOIN types ty ON ty.t = sv.canon)"""


# ---------------------------------------------------------------------------
# findings
# ---------------------------------------------------------------------------
def _luhn(x: str) -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    digit = f"CAST(substr({d}, i, 1) AS INTEGER)"
    return (f"list_sum(list_transform(range(1, length({d}) + 1), lambda i: "
            f"CASE WHEN (length({d}) - i) % 2 = 1 THEN CASE WHEN {digit} * 2 > 9 THEN {digit} * 2 - 9 "
            f"ELSE {digit} * 2 END ELSE {digit} END)) % 10 = 0")


def guarded_matches(rule: R.Rule, text: str) -> str:
    """Every place where the body stands between its guards: RE2 has no
    lookaround, so each start is tried with an anchored pattern."""
    g = rule.guard
    open_ = {"ssn": "0-9", "credit_card": "0-9", "phone_number": "0-9(", "personal_data": "0-9", "aws_key": "A",
             "api_key": "s", "email_exposure": "A-Za-z0-9._%+-"}[rule.raw_label]
    anchored = f"^({g.body})" + (f"($|[^{g.after}])" if g.after else "")
    starts = (f"list_filter(range(1, length({text}) + 1), lambda i: regexp_matches(substr({text}, i, 1), {lit('[' + open_ + ']')}) AND "
              f"(i = 1 OR NOT regexp_matches(substr({text}, i - 1, 1), {lit('[' + g.before + ']')})))")
    found = (f"list_filter(list_transform({starts}, lambda i: regexp_extract(substr({text}, i, 4000), {lit(anchored)}, 1)), "
             "lambda m: m <> '')")
    # Only texts that have a match at all are taken apart.
    return f"CASE WHEN regexp_matches({text}, {lit(rule.pattern)}) THEN {found} ELSE [] END"


def rule_rows(rule: R.Rule, src: str, id_col: str, text: str) -> str:
    arr = guarded_matches(rule, text) if rule.guard else f"regexp_extract_all({text}, {lit(rule.pattern)}, {rule.group})"
    if rule.raw_label == "credit_card":
        arr = f"list_filter({arr}, lambda x: {_luhn('x')})"
    return (f"SELECT {id_col} AS item_id, {lit(rule.raw_label)} AS raw_type, "
            f"CAST({rule.confidence} AS DOUBLE) AS confidence, CAST(u.i AS INTEGER) AS ord, "
            f"sha256(u.v) AS match_hash FROM (SELECT {id_col}, unnest(list_transform({arr}, "
            f"lambda x, i: {{'v': x, 'i': i}})) AS u FROM {src})")


def family_rows(families, src: str, id_col: str, text: str) -> str:
    return "\nUNION ALL ".join(rule_rows(r, src, id_col, text)
                               for fam in families for r in R.RULE_FAMILIES[fam])


def _flag_row(label: str, conf: float, src: str, id_col: str, cond: str) -> str:
    return (f"SELECT {id_col} AS item_id, {lit(label)} AS raw_type, CAST({conf} AS DOUBLE) AS confidence, "
            f"CAST(1 AS INTEGER) AS ord, CAST(NULL AS VARCHAR) AS match_hash FROM {src} WHERE {cond}")


def sql_rows(src: str = "stmts") -> str:
    parts = [_flag_row(r.raw_label, r.confidence, src, "stmt_id", f"regexp_matches(text, {lit(r.pattern)})")
             for r in R.SQL_RULES]
    d = R.DESTRUCTIVE_RULE
    parts.append(_flag_row(d.raw_label, d.confidence, src, "stmt_id",
                           f"regexp_matches(text, {lit(d.pattern)}) AND NOT coalesce(allow_destructive, false)"))
    for r in R.TAUTOLOGY_RULES:
        p = lit(r.pattern)
        cond = (f"len(list_filter(regexp_extract_all(text, {p}, 0), lambda m: "
                f"regexp_extract(m, {p}, 2) = regexp_extract(m, {p}, 3))) > 0")
        parts.append(_flag_row(r.raw_label, r.confidence, src, "stmt_id", cond))
    return "\nUNION ALL ".join(parts)


def path_rows(src: str = "files") -> str:
    base = "lower(regexp_extract(path, '([^/\\\\]*)$', 1))"
    ext = f"regexp_extract({base}, '\\.([a-z0-9]+)$', 1)"
    parts = [_flag_row(r.raw_label, r.confidence, src, "file_id", f"regexp_matches(path, {lit(r.pattern)})")
             for r in R.PATH_RULES]
    files = ", ".join(lit(x) for x in R.SENSITIVE_FILES)
    exts = ", ".join(lit(x) for x in R.SENSITIVE_EXTENSIONS)
    parts.append(_flag_row("sensitive_file", R.SENSITIVE_FILE_CONFIDENCE, src, "file_id", f"{base} IN ({files})"))
    parts.append(_flag_row("sensitive_extension", R.SENSITIVE_EXTENSION_CONFIDENCE, src, "file_id",
                           f"{ext} IN ({exts})"))
    parts.append(family_rows(("secrets", "pii"), src, "file_id", "nullif(content, '')"))
    return "\nUNION ALL ".join(parts)


def assembled(src_findings: str, items: str = "documents") -> str:
    """CTEs ``fr`` (findings) and ``asm`` (one raw verdict per row of
    ``items``, keyed by its ``doc_id``)."""
    return f"""{TAXO}, {TYPES},
fr AS ({src_findings}),
fk AS (SELECT fr.*, ty.default_severity AS sev, ty.sev_rank
       FROM fr LEFT JOIN taxo x ON x.raw_label = fr.raw_type
       JOIN types ty ON ty.t = coalesce(x.canon, 'unknown')),
best AS (SELECT item_id, raw_type, confidence, sev, count(*) OVER (PARTITION BY item_id) AS n,
           row_number() OVER (PARTITION BY item_id ORDER BY sev_rank, confidence DESC, raw_type, ord) AS rn
         FROM fk),
asm AS (SELECT d.doc_id AS item_id, b.item_id IS NULL AS safe, b.raw_type AS threat_type,
          b.confidence AS confidence, b.sev AS severity, coalesce(b.n, 0) AS n_findings
        FROM {items} d LEFT JOIN best b ON b.item_id = d.doc_id AND b.rn = 1)"""


GOVERNED = DOCS + ", " + assembled(family_rows(ALL_FAMILIES, "pd", "doc_id", "text")) + f""",
gov AS (SELECT a.item_id, CASE WHEN a.safe THEN 'allow' ELSE 'block' END AS decision,
          CASE WHEN NOT a.safe THEN coalesce(x.canon, 'unknown') END AS threat_type,
          CASE WHEN NOT a.safe THEN a.severity END AS severity,
          CASE WHEN NOT a.safe THEN {CONF_BUCKET.format(c='a.confidence')} END AS confidence,
          a.n_findings
        FROM asm a LEFT JOIN taxo x ON x.raw_label = a.threat_type)"""

PAYLOAD_CONV = f"""{MESSAGES}, pc AS (SELECT conv_id,
    count(*) FILTER (WHERE role = 'user') AS n_turns,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'user'), 0)
      + greatest(count(*) FILTER (WHERE role = 'user') - 1, 0) AS BIGINT) AS payload_chars,
    count(*) FILTER (WHERE role = 'user' AND text IS NULL) > 0 AS payload_error,
    string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'user') AS agg
  FROM pm GROUP BY conv_id),
pcv AS (SELECT conv_id, n_turns, payload_chars, payload_error,
    CASE WHEN payload_error THEN NULL WHEN n_turns = 0 THEN '' ELSE agg END AS payload FROM pc)"""


def _extract_sql(shape_mod: int, pieces_case: str, where: str) -> str:
    return f"""WITH m AS (SELECT conv_id, turn, role, text, (conv_id + turn) % {shape_mod} AS s FROM conversations),
a AS (SELECT conv_id, string_agg({pieces_case}, chr(10) ORDER BY turn) FILTER (WHERE {where}) AS t
      FROM m GROUP BY conv_id)
SELECT conv_id AS request_id, coalesce(t, '') AS text, false AS extract_error FROM a"""


# A consumed guard hides a neighbour from one pass; the second pass finds it.
REDACT = "text"
for _r in R.PII_RULES:
    _g = _r.guard
    _pat = (f"(^|[^{_g.before}])" if _g.before else "()") + f"({_g.body})" + (f"($|[^{_g.after}])" if _g.after else "()")
    for _ in range(2):
        REDACT = f"regexp_replace({REDACT}, {lit(_pat)}, {lit(chr(92) + '1' + R.REDACT_TOKENS[_r.raw_label] + chr(92) + '3')}, 'g')"

HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)', 2))"
LABELS = "string_split(host, '.')"

BRIDGE = "bridge(b_type, framework) AS (VALUES " + ", ".join(
    f"({lit(t)}, {lit(f)})" for t, f in R.FRAMEWORK_BRIDGE) + ")"

RULES_VALUES = "rules(raw_label, pattern, confidence) AS (VALUES " + ", ".join(
    f"({lit(r.raw_label)}, {lit(r.pattern)}, CAST({r.confidence} AS DOUBLE))"
    for fam in ALL_FAMILIES for r in R.RULE_FAMILIES[fam]) + ")"

STREAKS = f"""{OUTCOMES},
g AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY endpoint ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM outc)"""

PROVIDER = "(['openai', 'anthropic', 'gemini'])[doc_id % 3 + 1]"

ORACLE: dict[str, str] = {
    "src_messages": "SELECT conv_id, turn, role, text FROM conversations WHERE role = 'user'",
    "src_requests": """WITH c AS (SELECT conv_id, conv_id % 41 <> 3 AS ok, count(*) AS n, count(*) FILTER (WHERE role = 'user') AS u
        FROM conversations GROUP BY conv_id)
        SELECT CASE WHEN ok THEN conv_id END AS request_id, ok AS valid,
          CASE WHEN ok THEN n END AS n_messages, CASE WHEN ok THEN u END AS n_user_messages FROM c""",
    "src_verdicts": f"WITH {parsed_verdicts('documents', 'doc_id')} SELECT * REPLACE (CASE WHEN isfinite(confidence) THEN confidence END AS confidence), isfinite(confidence) AS confidence_finite FROM pv",
    "src_attempts": f"WITH {ATTEMPTS} SELECT * FROM att",
    "sink_routed": f"WITH {GOVERNED} SELECT * FROM gov",
    "extract_openai": _extract_sql(5, "CASE WHEN s = 3 THEN chr(10) || text ELSE text END",
                                   "role = 'user' AND s <> 4"),
    "extract_anthropic": _extract_sql(5, "CASE WHEN s = 3 THEN chr(10) || text ELSE text END",
                                      "role = 'user'"),
    "extract_gemini": _extract_sql(3, "text", "true"),
    "payload_conversation": f"WITH {PAYLOAD_CONV} SELECT * FROM pcv",
    "payload_history": f"""WITH {MESSAGES}, u AS (SELECT conv_id, turn, text FROM pm WHERE role = 'user'),
        h AS (SELECT conv_id, turn,
          CAST(sum(coalesce(length(text), 0) + 1) OVER w - 1 AS BIGINT) AS history_chars,
          string_agg(text, chr(10)) OVER w AS agg, count(*) FILTER (WHERE text IS NULL) OVER w > 0 AS payload_error
          FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT conv_id, turn, history_chars, payload_error, CASE WHEN NOT payload_error THEN agg END AS payload FROM h""",
    "payload_latest": f"""WITH {MESSAGES} SELECT conv_id, turn, text AS payload, text IS NULL AS payload_error, length(text) AS payload_chars
        FROM pm WHERE role = 'user'""",
    "gate_empty": f"""WITH {PAYLOAD_CONV}
        SELECT conv_id, coalesce(regexp_matches(payload, {lit(BLANK_PATTERN)}), false) AS is_empty,
          CASE WHEN coalesce(regexp_matches(payload, {lit(BLANK_PATTERN)}), false)
               THEN 'No user content to scan' END AS empty_reason FROM pcv""",
    "gate_size": f"""WITH {DOCS}, z AS (SELECT doc_id, CAST(coalesce(length(text), 0) + coalesce(length(source), 0) AS BIGINT) AS n FROM pd)
        SELECT doc_id AS item_id, n AS size_chars,
        n > {MAX_CONTENT_CHARS} AS oversize,
        CASE WHEN n > {MAX_CONTENT_CHARS} THEN 'Content too large (' ||
             CAST(n // 1024 AS VARCHAR) || 'KB > {MAX_CONTENT_CHARS // 1024}KB limit)' END
          AS size_reason,
        CASE WHEN n > {MAX_CONTENT_CHARS} THEN 'size_limit_exceeded' END AS size_threat_type,
        CASE WHEN n > {MAX_CONTENT_CHARS} THEN CAST(1.0 AS DOUBLE) END AS size_confidence,
        CASE WHEN n > {MAX_CONTENT_CHARS} THEN 'size_limit' END AS violation_type,
        CASE WHEN n > {MAX_CONTENT_CHARS}
             THEN 'Content exceeds maximum size of {MAX_CONTENT_CHARS // 1024}KB' END AS violation_description
        FROM z""",
    "normalize_threat": f"""WITH {TAXO}, {parsed_verdicts('documents', 'doc_id')}
        SELECT item_id, threat_type AS raw_threat_type, coalesce(x.canon, 'unknown') AS threat_type
        FROM pv LEFT JOIN taxo x ON replace(lower(threat_type), '-', '_') = x.raw_label""",
    "derive_severity": f"""WITH {TAXO}, {TYPES}, {parsed_verdicts('documents', 'doc_id')}
        SELECT item_id, coalesce(x.canon, 'unknown') AS threat_type, severity AS raw_severity,
          CASE WHEN lower(severity) IN ('critical', 'high', 'medium', 'low') THEN lower(severity)
               ELSE ty.default_severity END AS severity
        FROM pv LEFT JOIN taxo x ON replace(lower(threat_type), '-', '_') = x.raw_label
        JOIN types ty ON ty.t = coalesce(x.canon, 'unknown')""",
    "bucket_confidence": f"""WITH {parsed_verdicts('documents', 'doc_id')}
        SELECT item_id, CASE WHEN isfinite(confidence) THEN confidence END AS confidence_score, isfinite(confidence) AS confidence_score_finite, {CONF_BUCKET.format(c='confidence')} AS confidence FROM pv""",
    "guidance": f"""WITH {TAXO}, {TYPES}, {parsed_verdicts('documents', 'doc_id')}
        SELECT item_id, coalesce(x.canon, 'unknown') AS threat_type, ty.guidance AS guidance
        FROM pv LEFT JOIN taxo x ON replace(lower(threat_type), '-', '_') = x.raw_label
        JOIN types ty ON ty.t = coalesce(x.canon, 'unknown')""",
    "sanitize_verdicts": f"WITH {sanitized('documents', 'doc_id')} SELECT * EXCLUDE (valid) FROM san",
    "tier_note": f"""WITH {sanitized('documents', 'doc_id')}
        SELECT item_id, safe, item_id % 5 <> 0 AS has_key,
          CASE WHEN item_id % 5 = 0 THEN {lit(KEYLESS_NOTE)} END AS note FROM san""",
    "decide": f"WITH {GOVERNED} SELECT * FROM gov",
    "allowed_messages": f"""WITH convs AS (SELECT DISTINCT conv_id FROM conversations),
        {sanitized('convs', 'conv_id')}
        SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c
        WHERE c.conv_id NOT IN (SELECT item_id FROM san WHERE NOT safe OR (NOT valid AND item_id % 2 = 1))""",
    "blocked_report": f"""WITH {sanitized('documents', 'doc_id')},
        req AS (SELECT doc_id AS item_id, {PROVIDER} AS provider FROM documents)
        SELECT r.item_id, r.provider,
          CASE WHEN r.provider = 'openai' THEN 'Request blocked: ' || coalesce(s.reason, 'None')
               ELSE coalesce(s.reason, 'None') END AS message,
          s.threat_type, s.confidence,
          CASE WHEN r.provider = 'openai' AND r.item_id % 7 = 0 THEN 'policy: ' || s.guidance ELSE '' END AS violations,
          CASE WHEN r.provider = 'openai' AND r.item_id % 7 = 0 THEN 1 ELSE 0 END AS n_violations
        FROM req r JOIN san s ON s.item_id = r.item_id WHERE NOT s.safe""",
    "govern_verdicts": f"""WITH {sanitized('documents', 'doc_id')}
        SELECT item_id, CASE WHEN item_id % 2 = 0 THEN 'open' ELSE 'closed' END AS fail_mode,
          CASE WHEN valid THEN CASE WHEN safe THEN 'allow' ELSE 'block' END WHEN item_id % 2 = 0 THEN 'allow' ELSE 'error' END AS decision,
          CASE WHEN valid THEN safe WHEN item_id % 2 = 0 THEN true END AS safe,
          CASE WHEN valid THEN reason WHEN item_id % 2 = 0 THEN 'Scan error: ' || {lit(MALFORMED_MESSAGE)} END AS reason,
          threat_type, severity, confidence,
          CASE WHEN NOT valid AND item_id % 2 = 1 THEN 'Scan failed: ' || {lit(MALFORMED_MESSAGE)} END AS error FROM san""",
    "classify_error": f"""WITH {ATTEMPTS}
        SELECT request_id, attempt, kind, status,
          CASE WHEN kind = 'ok' THEN NULL WHEN kind IN ('timeout', 'connect') THEN true
               WHEN kind = 'http' THEN coalesce(status >= 500, false) ELSE false END AS retryable FROM att""",
    "retry_resolve": f"""WITH {ATTEMPTS},
        a AS (SELECT *, kind = 'ok' OR NOT (kind IN ('timeout', 'connect') OR (kind = 'http' AND coalesce(status >= 500, false)))
                AS terminal FROM att WHERE attempt <= 3),
        pick AS (SELECT request_id, min(endpoint) AS endpoint, min(scan_kind) AS scan_kind,
                   coalesce(min(attempt) FILTER (WHERE terminal), max(attempt)) AS t FROM a GROUP BY request_id)
        SELECT p.request_id, p.endpoint, p.scan_kind, p.t AS attempts, a.kind, a.status, a.message,
          a.ts AS resolved_ts, a.kind = 'ok' AS succeeded,
          CAST(CASE p.t WHEN 1 THEN 0.0 WHEN 2 THEN 0.2 ELSE 0.6 END AS DOUBLE) AS backoff_s
        FROM pick p JOIN a ON a.request_id = p.request_id AND a.attempt = p.t""",
    "fail_mode": f"""WITH {ATTEMPTS},
        a AS (SELECT *, kind = 'ok' OR NOT (kind IN ('timeout', 'connect') OR (kind = 'http' AND coalesce(status >= 500, false)))
                AS terminal FROM att WHERE attempt <= 3),
        pick AS (SELECT request_id, min(endpoint) AS endpoint, min(scan_kind) AS scan_kind,
                   coalesce(min(attempt) FILTER (WHERE terminal), max(attempt)) AS t FROM a GROUP BY request_id),
        r AS (SELECT p.request_id, p.scan_kind, a.kind, a.status, coalesce(a.message, '') AS msg,
                CASE WHEN p.endpoint IN ('ep0', 'ep1', 'ep2') THEN 'open' ELSE 'closed' END AS fail_mode
              FROM pick p JOIN a ON a.request_id = p.request_id AND a.attempt = p.t)
        SELECT request_id, fail_mode,
          CASE WHEN kind = 'ok' THEN 'scanned' WHEN fail_mode = 'open' THEN 'allow' ELSE 'error' END AS decision,
          CASE WHEN kind <> 'ok' AND fail_mode = 'open' THEN true END AS safe,
          CASE WHEN kind <> 'ok' AND fail_mode = 'open' THEN
            CASE WHEN kind = 'breaker_open' THEN 'Circuit breaker open, failing open'
                 WHEN kind = 'timeout' THEN 'Scan timeout, failing open'
                 WHEN kind = 'http' AND scan_kind = 'prompt' THEN 'Scan API error: ' || CAST(status AS VARCHAR)
                 ELSE 'Scan error: ' || msg END END AS reason,
          CASE WHEN kind = 'breaker_open' AND fail_mode = 'open' THEN true END AS degraded,
          CASE WHEN kind <> 'ok' AND fail_mode = 'closed' THEN
            CASE WHEN kind = 'breaker_open' THEN 'Security service circuit breaker open'
                 WHEN kind = 'timeout' AND scan_kind = 'prompt' THEN 'Scan request timed out and fail_mode is ''closed'''
                 WHEN kind = 'timeout' THEN CASE WHEN scan_kind = 'sql' THEN 'SQL' ELSE 'File' END || ' scan request timed out'
                 WHEN kind = 'http' AND scan_kind = 'prompt' THEN 'Scan API returned error: ' || CAST(status AS VARCHAR)
                 WHEN scan_kind = 'prompt' THEN 'Scan failed: ' || msg
                 ELSE CASE WHEN scan_kind = 'sql' THEN 'SQL' ELSE 'File' END || ' scan failed: ' || msg END END AS error
        FROM r""",
    "outage_episodes": f"""WITH {STREAKS}
        SELECT endpoint, min(ts) AS start_ts, max(ts) AS end_ts,
          first(event_id ORDER BY ts, event_id) AS first_event_id,
          last(event_id ORDER BY ts, event_id) AS last_event_id, count(*) AS n_failures
        FROM g WHERE NOT ok GROUP BY endpoint, grp HAVING count(*) >= 5""",
    "scan_stats": f"""WITH {ATTEMPTS}
        SELECT endpoint, count(*) AS n_attempts, count(*) FILTER (WHERE kind = 'ok') AS n_success,
          count(*) FILTER (WHERE kind <> 'ok') AS n_failure, max(ts) FILTER (WHERE kind <> 'ok') AS last_failure_ts
        FROM att GROUP BY endpoint""",
    "detect_pii": f"WITH {DOCS} " + family_rows(("pii",), "pd", "doc_id", "text"),
    "detect_secrets": f"WITH {DOCS} " + family_rows(("secrets",), "pd", "doc_id", "text"),
    "detect_code": f"WITH {DOCS} " + family_rows(("code",), "pd", "doc_id", "text"),
    "detect_prompt": f"WITH {PAYLOAD_CONV} " + family_rows(("prompt",), "pcv", "conv_id", "payload"),
    "detect_sql": f"WITH {STMTS} " + sql_rows(),
    "detect_path": f"WITH {FILES} " + path_rows(),
    "detect_domain": f"""WITH h AS (SELECT page_id AS item_id, {HOST} AS host FROM pages),
        p AS (SELECT item_id, host, unnest(list_transform(range(1, len({LABELS}) + 1),
                lambda i: {{'ord': i, 'matched': array_to_string(list_slice({LABELS}, i, len({LABELS})), '.')}})) AS u FROM h)
        SELECT item_id, host, 'blocked_domain' AS raw_type, CAST({R.BLOCKED_DOMAIN_CONFIDENCE} AS DOUBLE) AS confidence,
          CAST(u.ord AS INTEGER) AS ord, sha256(u.matched) AS match_hash, u.matched AS matched
        FROM p WHERE u.matched IN ({", ".join(lit(x) for x in R.BLOCKED_DOMAINS)})
        UNION ALL
        SELECT item_id, host, 'suspicious_tld', CAST({R.SUSPICIOUS_TLD_CONFIDENCE} AS DOUBLE), CAST(len({LABELS}) + 1 AS INTEGER),
          sha256({LABELS}[-1]), {LABELS}[-1]
        FROM h WHERE {LABELS}[-1] IN ({", ".join(lit(x) for x in R.SUSPICIOUS_TLDS)})""",
    "label_toxicity": """SELECT doc_id AS item_id, 'toxicity' AS raw_type, CAST(1.0 AS DOUBLE) AS confidence, CAST(1 AS INTEGER) AS ord,
        CAST(NULL AS VARCHAR) AS match_hash FROM labels
        WHERE toxic = 1 AND doc_id IN (SELECT doc_id FROM documents)""",
    "rule_scan": f"""WITH {DOCS}, {RULES_VALUES}
        SELECT d.doc_id AS item_id, r.raw_label AS raw_type, r.confidence, CAST(1 AS INTEGER) AS ord, CAST(NULL AS VARCHAR) AS match_hash
        FROM pd d JOIN rules r ON regexp_matches(d.text, r.pattern)""",
    "assemble_verdict": f"WITH {DOCS}, " + assembled(family_rows(ALL_FAMILIES, "pd", "doc_id", "text"))
                        + " SELECT * FROM asm",
    "redact_pii": f"WITH {DOCS} SELECT doc_id AS item_id, {REDACT} AS redacted FROM pd",
    "framework_coverage": f"""WITH {GOVERNED}, {BRIDGE}
        SELECT b.framework, count(*) AS n_findings, count(DISTINCT g.item_id) AS n_items
        FROM gov g JOIN bridge b ON b.b_type = g.threat_type WHERE g.decision = 'block'
        GROUP BY b.framework""",
    "quota_minute": f"""WITH {SCANS}, {TIERS_CTE},
        c AS (SELECT key_id, tier, date_trunc('minute', ts) AS minute_start, count(*) AS n_scans
              FROM scn GROUP BY key_id, tier, date_trunc('minute', ts))
        SELECT c.key_id, c.tier, c.minute_start, c.n_scans, t.per_minute AS rate_limit,
          CASE WHEN t.per_minute IS NULL THEN 0 ELSE greatest(c.n_scans - t.per_minute, 0) END AS excess
        FROM c LEFT JOIN tiers t ON t.tier = c.tier""",
    "quota_month": f"""WITH {SCANS}, {TIERS_CTE},
        m AS (SELECT key_id, tier, date_trunc('month', ts) AS month_start, count(*) AS n_scans
              FROM scn GROUP BY key_id, tier, date_trunc('month', ts)),
        r AS (SELECT key_id, date_trunc('month', ts) AS month_start, event_id, ts,
                tier, row_number() OVER (PARTITION BY key_id, tier, date_trunc('month', ts) ORDER BY ts, event_id) AS rn FROM scn)
        SELECT m.key_id, m.tier, m.month_start, m.n_scans, t.per_month AS allowance,
          CASE WHEN t.per_month IS NULL THEN 0 ELSE greatest(m.n_scans - t.per_month, 0) END AS over_by,
          r.event_id AS crossed_event_id, r.ts AS crossed_ts
        FROM m LEFT JOIN tiers t ON t.tier = m.tier
        LEFT JOIN r ON r.key_id = m.key_id AND r.tier = m.tier AND r.month_start = m.month_start AND r.rn = t.per_month + 1""",
    "threat_rollup": f"""WITH {sanitized('documents', 'doc_id')}
        SELECT threat_type, severity, count(*) AS n, grouping(threat_type, severity) AS level
        FROM san WHERE NOT safe GROUP BY ROLLUP (threat_type, severity)""",
    "stream_gate": f"WITH {GOVERNED} SELECT * FROM gov",
    "stream_quota": f"""WITH {SCANS}, {TIERS_CTE},
        c AS (SELECT key_id, tier, date_trunc('minute', ts) AS minute_start, count(*) AS n_scans
              FROM scn GROUP BY key_id, tier, date_trunc('minute', ts))
        SELECT c.*, t.per_minute AS rate_limit,
          CASE WHEN t.per_minute IS NULL THEN 0 ELSE greatest(c.n_scans - t.per_minute, 0) END AS excess
        FROM c LEFT JOIN tiers t ON t.tier = c.tier WHERE minute_start + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    "stream_outage": f"""WITH {STREAKS},
        s AS (SELECT *, CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY endpoint, grp
                ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS k FROM g),
        p AS (SELECT *, lag(CASE WHEN ok THEN 0 ELSE k END, 1, 0) OVER t AS prev, lag(ts) OVER t AS last_ts, lag(event_id) OVER t AS last_id, lead(ts) OVER t AS next_ts,
                first(ts) OVER r AS run_ts, first(event_id) OVER r AS run_id,
                lag(CASE WHEN ok THEN NULL ELSE grp END) OVER t AS prev_grp
              FROM s WINDOW t AS (PARTITION BY endpoint ORDER BY ts, event_id), r AS (PARTITION BY endpoint, grp, ok ORDER BY ts, event_id)),
        runs AS (SELECT endpoint, grp, min(ts) AS a_ts, arg_min(event_id, (ts, event_id)) AS a_id FROM p WHERE NOT ok GROUP BY endpoint, grp)
        SELECT endpoint, 'outage' AS event, event_id, ts, k AS streak, run_ts AS start_ts, run_id AS first_event_id, ts AS end_ts, event_id AS last_event_id
        FROM p WHERE NOT ok AND k = 5
        UNION ALL
        SELECT p.endpoint, 'recovery', event_id, ts, prev, a_ts, a_id, last_ts, last_id FROM p JOIN runs USING (endpoint) WHERE ok AND prev >= 5 AND runs.grp = prev_grp
        UNION ALL
        SELECT endpoint, 'open', event_id, ts, k, run_ts, run_id, ts, event_id FROM p
        WHERE NOT ok AND k >= 5 AND (next_ts IS NULL OR date_trunc('minute', next_ts) >= date_trunc('minute', ts + INTERVAL 1 DAY) + INTERVAL 1 MINUTE)""",
    "custom_detector": f"""WITH {DOCS}, c AS (SELECT doc_id AS item_id, text, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
                length(regexp_replace(text, '[^A-Z]', '', 'g')) AS up FROM pd
              WHERE text IS NOT NULL AND NOT regexp_matches(text, {lit(BLANK_PATTERN)}))
        SELECT item_id, CASE WHEN length(text) > {MAX_CONTENT_CHARS} THEN 'size_limit_exceeded' WHEN NOT contains(text, '<?php') THEN 'tonality_drift_hostile' END AS raw_type,
          CASE WHEN length(text) > {MAX_CONTENT_CHARS} THEN 1.0::DOUBLE WHEN NOT contains(text, '<?php') THEN round(up / letters, 4) END AS confidence,
          CASE WHEN length(text) > {MAX_CONTENT_CHARS} THEN 'gate' WHEN contains(text, '<?php') THEN 'error' ELSE 'finding' END AS kind,
          CASE WHEN length(text) > {MAX_CONTENT_CHARS} THEN 'Content too large (' || CAST(length(text) // 1024 AS VARCHAR) || 'KB > {MAX_CONTENT_CHARS // 1024}KB limit)'
            WHEN contains(text, '<?php') THEN 'ValueError: markup' END AS message
        FROM c WHERE length(text) > {MAX_CONTENT_CHARS} OR contains(text, '<?php') OR (letters >= {SHOUT_MIN_LETTERS} AND up / letters >= {SHOUT_RATIO})""",
}

# The size gate of SQL and file requests: over the limit there is no body.
def _sized(body: str, size: str) -> str:
    return (f"CASE WHEN {size} <= {MAX_CONTENT_CHARS} THEN {body} END AS body, CASE WHEN {size} > {MAX_CONTENT_CHARS} THEN "
            f"'Content too large (' || CAST({size} // 1024 AS VARCHAR) || 'KB > {MAX_CONTENT_CHARS // 1024}KB limit)' END AS local_reason")


_PROMPTS = f"""SELECT 'conversation' AS source, conv_id AS request_id, '/scan' AS route, 'prompt' AS content_type,
    CASE WHEN NOT payload_error THEN CAST(json_object('prompt', payload) AS VARCHAR) END AS body,
    CASE WHEN payload_error THEN 'a message has no text' END AS local_reason FROM pcv"""
_SQL_BODY = """CAST(json_object('content', text, 'content_type', 'sql', 'context',
      json_object('database', coalesce(database, ''),
                  'allow_destructive', CASE WHEN coalesce(allow_destructive, false) THEN 'true' ELSE 'false' END))
      AS VARCHAR)"""
_SQLS = f"""SELECT 'sql' AS source, stmt_id AS request_id, '/api/scan/specialized' AS route, 'sql' AS content_type,
    {_sized(_SQL_BODY, "length(text)")} FROM stmts"""
_FILE_BODY = """CAST(CASE WHEN nullif(content, '') IS NOT NULL
      THEN json_object('content', path, 'content_type', 'file_content', 'context', json_object('file_content', content))
      ELSE json_object('content', path, 'content_type', 'file_path') END AS VARCHAR)"""
_FILES = f"""SELECT 'file' AS source, file_id AS request_id, '/api/scan/specialized' AS route,
    CASE WHEN nullif(content, '') IS NOT NULL THEN 'file_content' ELSE 'file_path' END AS content_type,
    {_sized(_FILE_BODY, "(length(path) + coalesce(length(content), 0))")} FROM files"""

ORACLE["request_prompt"] = (f"WITH {PAYLOAD_CONV} SELECT request_id, route, content_type, body, local_reason "
                            f"FROM ({_PROMPTS})")
ORACLE["request_sql"] = f"WITH {STMTS} SELECT request_id, route, content_type, body, local_reason FROM ({_SQLS})"
ORACLE["request_file"] = f"WITH {FILES} SELECT request_id, route, content_type, body, local_reason FROM ({_FILES})"
ORACLE["request_union"] = (f"WITH {PAYLOAD_CONV}, {STMTS}, {FILES} {_PROMPTS} UNION ALL {_SQLS} "
                           f"UNION ALL {_FILES}")

_LABELLED = """SELECT doc_id AS item_id, 'toxicity' AS raw_type, CAST(1.0 AS DOUBLE) AS confidence, CAST(1 AS INTEGER) AS ord,
    CAST(NULL AS VARCHAR) AS match_hash FROM labels WHERE toxic = 1 AND doc_id IN (SELECT doc_id FROM documents)"""
_TABLE_RULES = " UNION ALL ".join(
    f"SELECT doc_id, {lit(r.raw_label)}, CAST({r.confidence} AS DOUBLE), CAST(1 AS INTEGER), CAST(NULL AS VARCHAR) FROM pd WHERE regexp_matches(text, {lit(r.pattern)})"
    for r in R.PROMPT_RULES + R.CODE_RULES)
ORACLE["assemble_findings"] = f"WITH {DOCS}, dom AS ({ORACLE['detect_domain']}), " + assembled(
    family_rows(("pii", "secrets"), "pd", "doc_id", "text")
    + f" UNION ALL {_TABLE_RULES} UNION ALL SELECT item_id, raw_type, confidence, ord, match_hash FROM dom UNION ALL {_LABELLED}") + " SELECT * FROM asm"


_GATED = f"""{PAYLOAD_CONV},
gc AS (SELECT pcv.*, coalesce(regexp_matches(payload, {lit(BLANK_PATTERN)}), false) AS is_empty FROM pcv),
scanned AS (SELECT conv_id AS doc_id, payload AS text FROM gc
            WHERE NOT payload_error AND NOT is_empty)"""

ORACLE["conversation_decisions"] = "WITH " + _GATED + ", " + assembled(
    family_rows(ALL_FAMILIES, "scanned", "doc_id", "text"), items="scanned") + f"""
SELECT g.conv_id,
  CASE WHEN g.payload_error THEN 'error' WHEN g.is_empty THEN 'empty' ELSE 'scan' END AS gate,
  CASE WHEN g.payload_error THEN 'error' WHEN g.is_empty THEN 'allow' WHEN a.safe THEN 'allow' ELSE 'block' END AS decision,
  CASE WHEN g.payload_error OR g.is_empty THEN NULL WHEN NOT a.safe THEN coalesce(x.canon, 'unknown') END AS threat_type,
  CASE WHEN a.item_id IS NOT NULL AND NOT a.safe THEN a.severity END AS severity,
  CASE WHEN a.item_id IS NOT NULL AND NOT a.safe THEN {CONF_BUCKET.format(c='a.confidence')} END AS confidence,
  CASE WHEN g.payload_error THEN NULL WHEN g.is_empty THEN 'No user content to scan'
       WHEN a.safe THEN '' ELSE ty.guidance END AS reason
FROM gc g LEFT JOIN asm a ON a.item_id = g.conv_id
LEFT JOIN taxo x ON x.raw_label = a.threat_type
LEFT JOIN types ty ON ty.t = coalesce(x.canon, 'unknown')"""


# Attempts in a cool-down, and requests whose first attempts were lost.
ORACLE["breaker_outcomes"] = f"""WITH {ATTEMPTS},
    att1 AS (SELECT * FROM att WHERE NOT ({derived.LOST_ATTEMPTS_SQL})),
    g AS (SELECT endpoint, ts, request_id * 1000 + attempt AS event_id, kind = 'ok' AS ok, sum(CASE WHEN kind = 'ok' THEN 1 ELSE 0 END) OVER (
            PARTITION BY endpoint ORDER BY ts, request_id * 1000 + attempt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM att1),
    trips AS (SELECT endpoint, ts AS trip FROM g WHERE NOT ok QUALIFY row_number() OVER (PARTITION BY endpoint, grp ORDER BY ts, event_id) = 3),
    cut AS (SELECT a.request_id, a.endpoint, a.scan_kind, a.attempt, h, CASE WHEN h THEN 'breaker_open' ELSE kind END AS kind,
              CASE WHEN NOT h THEN status END AS status, CASE WHEN NOT h THEN message END AS message
            FROM (SELECT *, EXISTS (SELECT 1 FROM trips t WHERE t.endpoint = a0.endpoint AND a0.ts > t.trip AND a0.ts < t.trip + INTERVAL 4 HOUR) AS h FROM att1 a0) a),
    a AS (SELECT *, kind = 'ok' OR NOT (kind IN ('timeout', 'connect') OR (kind = 'http' AND coalesce(status >= 500, false))) AS terminal FROM cut WHERE attempt <= 2),
    ids AS (SELECT request_id, min(endpoint) AS endpoint, min(scan_kind) AS scan_kind FROM cut GROUP BY request_id),
    pick AS (SELECT request_id, coalesce(min(attempt) FILTER (WHERE terminal), max(attempt)) AS t FROM a GROUP BY request_id),
    r AS (SELECT i.request_id, i.scan_kind, coalesce(a.kind, 'unlogged') AS kind, coalesce(p.t, 2) AS attempts, a.status,
            CASE WHEN p.t IS NULL THEN {lit(UNLOGGED_MESSAGE)} ELSE coalesce(a.message, '') END AS msg,
            CASE WHEN i.endpoint IN ('ep0', 'ep1', 'ep2') THEN 'open' ELSE 'closed' END AS fail_mode
          FROM ids i LEFT JOIN pick p USING (request_id) LEFT JOIN a ON a.request_id = p.request_id AND a.attempt = p.t)
    SELECT request_id, kind, attempts, fail_mode,
          CASE WHEN kind = 'ok' THEN 'scanned' WHEN fail_mode = 'open' THEN 'allow' ELSE 'error' END AS decision,
          CASE WHEN kind <> 'ok' AND fail_mode = 'open' THEN true END AS safe,
          CASE WHEN kind <> 'ok' AND fail_mode = 'open' THEN
            CASE WHEN kind = 'breaker_open' THEN 'Circuit breaker open, failing open'
                 WHEN kind = 'timeout' THEN 'Scan timeout, failing open'
                 WHEN kind = 'http' AND scan_kind = 'prompt' THEN 'Scan API error: ' || CAST(status AS VARCHAR)
                 ELSE 'Scan error: ' || msg END END AS reason,
          CASE WHEN kind = 'breaker_open' AND fail_mode = 'open' THEN true END AS degraded,
          CASE WHEN kind <> 'ok' AND fail_mode = 'closed' THEN
            CASE WHEN kind = 'breaker_open' THEN 'Security service circuit breaker open'
                 WHEN kind = 'timeout' AND scan_kind = 'prompt' THEN 'Scan request timed out and fail_mode is ''closed'''
                 WHEN kind = 'timeout' THEN CASE WHEN scan_kind = 'sql' THEN 'SQL' ELSE 'File' END || ' scan request timed out'
                 WHEN kind = 'http' AND scan_kind = 'prompt' THEN 'Scan API returned error: ' || CAST(status AS VARCHAR)
                 WHEN scan_kind = 'prompt' THEN 'Scan failed: ' || msg
                 ELSE CASE WHEN scan_kind = 'sql' THEN 'SQL' ELSE 'File' END || ' scan failed: ' || msg END END AS error
    FROM r"""

ORACLE["quota_asof"] = f"""WITH {SCANS}, {TIERS_CTE},
    ch AS (SELECT {_cols(derived.TIER_CHANGE_COLUMNS_SQL)} FROM events WHERE {derived.TIER_CHANGE_SQL}),
    b AS (SELECT s.key_id, date_trunc('month', s.ts) AS month_start, coalesce(ch.new_tier, s.tier) AS tier
          FROM scn s ASOF LEFT JOIN ch ON s.key_id = ch.key_id AND s.ts >= ch.since),
    m AS (SELECT key_id, tier, CAST(month_start AS TIMESTAMP) AS month_start, count(*) AS n_scans FROM b GROUP BY ALL)
    SELECT m.key_id, m.tier, m.month_start, m.n_scans, t.per_month AS allowance,
      CASE WHEN t.per_month IS NULL THEN 0 ELSE greatest(m.n_scans - t.per_month, 0) END AS over_by FROM m LEFT JOIN tiers t ON t.tier = m.tier"""

ORACLE["quota_rolling"] = f"""WITH {SCANS}, {TIERS_CTE},
    n AS (SELECT *, count(*) OVER (PARTITION BY key_id ORDER BY ts RANGE BETWEEN INTERVAL '21599.999999 seconds' PRECEDING AND CURRENT ROW) AS n_recent FROM scn)
    SELECT n.key_id, n.event_id, n.tier, n.ts, n.n_recent, t.per_minute AS rate_limit,
      CASE WHEN t.per_minute IS NULL THEN 0 ELSE greatest(n.n_recent - t.per_minute, 0) END AS excess FROM n LEFT JOIN tiers t ON t.tier = n.tier"""

ORACLE["sessions"] = f"""WITH {SCANS},
    s AS (SELECT *, CASE WHEN ts - lag(ts) OVER k < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM scn WINDOW k AS (PARTITION BY key_id ORDER BY ts)),
    b AS (SELECT *, sum(fresh) OVER (PARTITION BY key_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS burst FROM s)
    SELECT key_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_scans FROM b GROUP BY key_id, burst"""
ORACLE["stream_sessions"] = ORACLE["sessions"]
ORACLE["stream_requests"] = ORACLE["conversation_decisions"]

ORACLE["rule_scan_large"] = f"""WITH {DOCS},
    w AS (SELECT doc_id, regexp_extract(text, '{derived.WORD_PAIR}', 1) AS a, regexp_extract(text, '{derived.WORD_PAIR}', 2) AS b FROM documents WHERE doc_id % 4 = 1),
    rules AS (SELECT {_cols(derived.DOCUMENT_RULE_COLUMNS_SQL)} FROM w WHERE a <> '')
    SELECT d.doc_id AS item_id, r.raw_label AS raw_type, r.confidence, CAST(1 AS INTEGER) AS ord, CAST(NULL AS VARCHAR) AS match_hash
    FROM pd d JOIN rules r ON regexp_matches(d.text, r.pattern)"""

# A list of the pages' hosts against every host and its parents.
ORACLE["detect_domain_large"] = f"""WITH bl AS (SELECT DISTINCT lower({derived.DOMAIN_SQL}) AS domain FROM pages WHERE page_id % 6 = 0),
    h AS (SELECT page_id AS item_id, {HOST} AS host FROM pages),
    p AS (SELECT item_id, host, unnest(list_transform(range(1, len({LABELS}) + 1),
            lambda i: {{'ord': i, 'matched': array_to_string(list_slice({LABELS}, i, len({LABELS})), '.')}})) AS u FROM h)
    SELECT item_id, host, 'blocked_domain' AS raw_type, CAST({R.BLOCKED_DOMAIN_CONFIDENCE} AS DOUBLE) AS confidence,
      CAST(u.ord AS INTEGER) AS ord, sha256(u.matched) AS match_hash, u.matched AS matched
    FROM p WHERE u.matched <> '' AND u.matched IN (SELECT domain FROM bl)
    UNION ALL
    SELECT item_id, host, 'suspicious_tld', CAST({R.SUSPICIOUS_TLD_CONFIDENCE} AS DOUBLE), CAST(len({LABELS}) + 1 AS INTEGER),
      sha256({LABELS}[-1]), {LABELS}[-1]
    FROM h WHERE {LABELS}[-1] IN ({", ".join(lit(x) for x in R.SUSPICIOUS_TLDS)})"""

# Every history as one text, scanned whole.
ORACLE["history_verdicts"] = f"""WITH {MESSAGES}, u AS (SELECT conv_id, turn, text FROM pm WHERE role = 'user'),
    h AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS doc_id, conv_id, turn,
      CAST(sum(coalesce(length(text), 0) + 1) OVER w - 1 AS BIGINT) AS history_chars, count(*) FILTER (WHERE text IS NULL) OVER w > 0 AS broken,
      CAST(sum(CAST('0x' || substr(md5(CAST(turn AS VARCHAR) || ':' || coalesce(text, '')), 1, 15) AS BIGINT)) OVER w AS VARCHAR) AS history_key,
      string_agg(text, chr(10)) OVER w AS text
      FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    {assembled(family_rows(ALL_FAMILIES, "h", "doc_id", "text"), items="h")}
    SELECT h.conv_id, h.turn, h.history_chars, h.history_key, CASE WHEN broken THEN 'error' WHEN a.safe THEN 'allow' ELSE 'block' END AS decision,
      CASE WHEN NOT broken THEN a.n_findings END AS n_findings, CASE WHEN NOT broken AND NOT a.safe THEN coalesce(x.canon, 'unknown') END AS threat_type,
      CASE WHEN NOT broken AND NOT a.safe THEN a.severity END AS severity, CASE WHEN NOT broken AND NOT a.safe THEN a.confidence END AS confidence
    FROM h JOIN asm a ON a.item_id = h.doc_id LEFT JOIN taxo x ON x.raw_label = a.threat_type"""


def placed_rows(rule: R.Rule, src: str, id_col: str, text: str) -> str:
    """:func:`rule_rows` with places: guarded rules keep the start that was
    tried; for the others the text is split at the matches."""
    if rule.guard:
        arr = guarded_matches(rule, text).replace("lambda i: regexp_extract(", "lambda i: {'s': i - 1, 'm': regexp_extract(") \
            .replace(", 1)), lambda m: m <> '')", ", 1)}), lambda x: x.m <> '')")
        arr = f"list_filter({arr}, lambda x: {_luhn('x.m')})" if rule.raw_label == "credit_card" else arr
    else:
        p = lit(rule.pattern)
        whole, group, pieces = f"regexp_extract_all({text}, {p}, 0)", f"regexp_extract_all({text}, {p}, {rule.group})", f"string_split_regex({text}, {p})"
        arr = (f"CASE WHEN regexp_matches({text}, {p}) THEN list_transform({group}, lambda g, k: {{'s': list_sum(list_transform({pieces}[1:k], lambda q: length(q)))"
               f" + list_sum(list_transform({whole}[1:k], lambda q: length(q))) - length(g), 'm': g}}) ELSE [] END")
    return (f"SELECT {id_col} AS item_id, {lit(rule.raw_label)} AS raw_type, CAST({rule.confidence} AS DOUBLE) AS confidence, CAST(u.i AS INTEGER) AS ord, "
            f"sha256(u.x.m) AS match_hash, CAST(u.x.s AS INTEGER) AS span_start, CAST(u.x.s + length(u.x.m) AS INTEGER) AS span_end "
            f"FROM (SELECT {id_col}, unnest(list_transform({arr}, lambda x, i: {{'x': x, 'i': i}})) AS u FROM {src})")


_PLACED = "\nUNION ALL ".join(placed_rows(r, "pd", "doc_id", "text") for fam in ("pii", "secrets") for r in R.RULE_FAMILIES[fam])
ORACLE["located_findings"] = f"WITH {DOCS} {_PLACED}"
_TOKEN = "CASE kind " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in R.REDACT_TOKENS.items()) + " ELSE '[SECRET]' END"
ORACLE["redact_findings"] = f"""WITH {DOCS}, f AS ({_PLACED}),
    r AS (SELECT *, max(span_end) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f
          WINDOW w AS (PARTITION BY item_id ORDER BY span_start, span_end DESC, confidence DESC, raw_type)),
    g AS (SELECT *, sum(CASE WHEN span_start < reach THEN 0 ELSE 1 END) OVER (PARTITION BY item_id ORDER BY span_start, span_end DESC, confidence DESC, raw_type ROWS UNBOUNDED PRECEDING) AS part FROM r),
    m AS (SELECT item_id, part, min(span_start) AS a, max(span_end) AS b, arg_min(raw_type, CASE WHEN span_start < reach THEN 1 ELSE 0 END) AS kind FROM g GROUP BY item_id, part),
    k AS (SELECT item_id, part, b, substr(text, coalesce(lag(b) OVER o, 0) + 1, a - coalesce(lag(b) OVER o, 0)) || {_TOKEN} AS piece
          FROM m JOIN pd ON pd.doc_id = m.item_id WINDOW o AS (PARTITION BY item_id ORDER BY part)),
    j AS (SELECT item_id, string_agg(piece, '' ORDER BY part) AS front, max(b) AS b FROM k GROUP BY item_id)
    SELECT doc_id AS item_id, CASE WHEN j.item_id IS NULL THEN text ELSE front || substr(text, b + 1) END AS redacted FROM pd LEFT JOIN j ON j.item_id = pd.doc_id"""

ORACLE["coverage_merged"] = f"""WITH {sanitized('documents', 'doc_id')}, {BRIDGE}
    SELECT b.framework, count(*) AS n_findings, count(DISTINCT e.user_id) AS n_items, true AS estimate_near
    FROM events e JOIN san ON san.item_id = e.event_id JOIN bridge b ON b.b_type = san.threat_type WHERE NOT san.safe GROUP BY b.framework"""
