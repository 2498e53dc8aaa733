"""Threat taxonomy: raw detector labels, canonical types, default severity.

The taxonomy is a contract with the scan service, so its keys and mapping are
fixed values that must be reproduced exactly.  Guidance sentences are our own
wording; only their key set and the fallback to ``unknown`` are contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (contract with the scan service -- must not change)
# raw label -> canonical threat type, 92 entries, grouped by canonical type.
# ---------------------------------------------------------------------------
RAW_TO_CANONICAL: dict[str, str] = {
    "prompt_injection": "prompt_injection",
    "injection": "prompt_injection",
    "inject": "prompt_injection",
    "instruction_override": "prompt_injection",
    "role_hijacking": "prompt_injection",
    "context_manipulation": "prompt_injection",
    "token_manipulation": "prompt_injection",
    "indirect_injection": "prompt_injection",
    "context_poisoning": "prompt_injection",
    "function_injection": "prompt_injection",
    "memory_injection": "prompt_injection",
    "topic_mismatch": "prompt_injection",
    "jailbreak": "jailbreak",
    "jailbreak_attempt": "jailbreak",
    "safety_bypass": "jailbreak",
    "roleplay": "jailbreak",
    "hypothetical": "jailbreak",
    "completion_baiting": "jailbreak",
    "override": "jailbreak",
    "manipulate": "jailbreak",
    "tonality_drift_profanity": "jailbreak",
    "tonality_drift_casual": "jailbreak",
    "tonality_drift_hostile": "jailbreak",
    "system_prompt_leak": "system_prompt_leak",
    "system_prompt_extraction": "system_prompt_leak",
    "data_exfiltration": "data_exfiltration",
    "exfiltration": "data_exfiltration",
    "exfiltrate": "data_exfiltration",
    "extract": "data_exfiltration",
    "data_leak": "data_exfiltration",
    "information_disclosure": "data_exfiltration",
    "credential_extraction": "data_exfiltration",
    "sql_injection": "sql_injection",
    "sqli": "sql_injection",
    "tautology": "sql_injection",
    "tautology_or": "sql_injection",
    "tautology_and": "sql_injection",
    "union_injection": "sql_injection",
    "stacked_query": "sql_injection",
    "path_traversal": "path_traversal",
    "directory_traversal": "path_traversal",
    "path_violation": "path_traversal",
    "file_access": "path_traversal",
    "sensitive_path": "path_traversal",
    "sensitive_extension": "path_traversal",
    "blocked_extension": "path_traversal",
    "secrets_exposure": "secrets_exposure",
    "secrets": "secrets_exposure",
    "api_key": "secrets_exposure",
    "credential": "secrets_exposure",
    "sensitive_file": "secrets_exposure",
    "content_violation": "secrets_exposure",
    "sensitive_content": "secrets_exposure",
    "secret_key": "secrets_exposure",
    "aws_key": "secrets_exposure",
    "private_key": "secrets_exposure",
    "pii_exposure": "pii_exposure",
    "pii": "pii_exposure",
    "pii_leak": "pii_exposure",
    "personal_data": "pii_exposure",
    "pii_in_search": "pii_exposure",
    "pii_extraction": "pii_exposure",
    "ssn": "pii_exposure",
    "credit_card": "pii_exposure",
    "email_exposure": "pii_exposure",
    "phone_number": "pii_exposure",
    "unexpected_pii_leakage": "pii_exposure",
    "blocked_domain": "blocked_domain",
    "suspicious_tld": "blocked_domain",
    "suspicious_domain": "blocked_domain",
    "malicious_url": "blocked_domain",
    "toxicity": "toxicity",
    "harmful_content": "toxicity",
    "malicious_content": "malicious_code",
    "malicious_code": "malicious_code",
    "reverse_shell": "malicious_code",
    "web_shell": "malicious_code",
    "fork_bomb": "malicious_code",
    "crypto_miner": "malicious_code",
    "persistence": "malicious_code",
    "shell_injection": "malicious_code",
    "harmful_intent": "harmful_intent",
    "dangerous_request": "harmful_intent",
    "social_engineering": "social_engineering",
    "emotional": "social_engineering",
    "authority_claim": "social_engineering",
    "privilege_escalation": "privilege_escalation",
    "destructive_operation": "destructive_operation",
    "scan_error": "scan_error",
    "size_limit_exceeded": "size_limit_exceeded",
    "size_limit": "size_limit_exceeded",
    "timeout": "scan_error",
}

# FIXED VALUES: default severity per canonical type (``unknown`` is the 18th).
DEFAULT_SEVERITY: dict[str, str] = {
    "prompt_injection": "high",
    "jailbreak": "high",
    "system_prompt_leak": "high",
    "data_exfiltration": "high",
    "sql_injection": "critical",
    "path_traversal": "high",
    "secrets_exposure": "critical",
    "pii_exposure": "high",
    "blocked_domain": "medium",
    "toxicity": "medium",
    "malicious_code": "critical",
    "harmful_intent": "high",
    "social_engineering": "medium",
    "privilege_escalation": "critical",
    "destructive_operation": "critical",
    "scan_error": "medium",
    "size_limit_exceeded": "low",
    "unknown": "medium",
}

# FIXED VALUES: accepted provider severities, worst first.
SEVERITIES: tuple[str, ...] = ("critical", "high", "medium", "low")

# FIXED VALUES: confidence bucket thresholds (score >= 0.9 high, >= 0.7 medium).
CONFIDENCE_HIGH = 0.9
CONFIDENCE_MEDIUM = 0.7

# Our own wording, one sentence per canonical type.
GUIDANCE: dict[str, str] = {
    "prompt_injection": "The text tries to override or replace the model's instructions.",
    "jailbreak": "The text tries to get around the model's safety rules and was stopped.",
    "system_prompt_leak": "The text discloses or asks for hidden system instructions.",
    "data_exfiltration": "The text appears to pull sensitive data out of the system.",
    "sql_injection": "The query holds SQL constructs that are commonly used in injection attacks.",
    "path_traversal": "The path reaches outside the directories it is allowed to use.",
    "secrets_exposure": "The content holds what look like keys, tokens or credentials.",
    "pii_exposure": "The content holds personal data that identifies a person.",
    "blocked_domain": "The request targets a domain on the restricted list.",
    "toxicity": "The content holds language that may be harmful or abusive.",
    "malicious_code": "The content holds code patterns tied to attacks on a host.",
    "harmful_intent": "The request asks for help that could cause real harm.",
    "social_engineering": "The text uses pressure or false authority to steer the reader.",
    "privilege_escalation": "The query tries to gain rights it should not have.",
    "destructive_operation": "The query deletes or drops data; review it before running.",
    "scan_error": "The scan did not finish, so the content was held back as a precaution.",
    "size_limit_exceeded": "The content is larger than the scan size limit.",
    "unknown": "A possible risk was found; review the content.",
}

CANONICAL_TYPES: tuple[str, ...] = tuple(DEFAULT_SEVERITY)


def severity_rank(sev: str) -> int:
    """0 = critical ... 3 = low."""
    return SEVERITIES.index(sev)


def threat_dimension(spark: SparkSession) -> DataFrame:
    """92-row dimension: raw_label -> threat_type, default_severity, guidance.

    Its size is fixed by the taxonomy, so broadcasting it is always safe.
    """
    rows = [(raw, canon, DEFAULT_SEVERITY[canon], GUIDANCE[canon])
            for raw, canon in RAW_TO_CANONICAL.items()]
    schema = T.StructType([
        T.StructField("raw_label", T.StringType(), False),
        T.StructField("dim_threat_type", T.StringType(), False),
        T.StructField("dim_severity", T.StringType(), False),
        T.StructField("dim_guidance", T.StringType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def type_dimension(spark: SparkSession) -> DataFrame:
    """18-row dimension: canonical type -> default severity, guidance."""
    rows = [(t, DEFAULT_SEVERITY[t], GUIDANCE[t], severity_rank(DEFAULT_SEVERITY[t]))
            for t in CANONICAL_TYPES]
    schema = T.StructType([
        T.StructField("threat_type", T.StringType(), False),
        T.StructField("default_severity", T.StringType(), False),
        T.StructField("guidance", T.StringType(), False),
        T.StructField("severity_rank", T.IntegerType(), False),
    ])
    return spark.createDataFrame(rows, schema)
