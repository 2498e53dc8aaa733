"""Detector rules: (raw label, pattern, capture group, confidence).

The scan service's own detectors are not public, so these rules are ours;
they only emit labels from the taxonomy's raw-label set.  ``pattern`` stays in
the subset where Java regex (Spark) and RE2 (DuckDB, the oracle) agree: no
lookaround, no backreferences, no ``\\b`` or ``\\s`` (both differ between the
engines on accented text or vertical tab), explicit ``[ \\t]`` instead.

No pattern repeats a group: Java matches a repeated group by recursion, so a
few kilobytes of hostile text would overflow the stack.  Repeats are of single
character classes, and none can start anew at every character of a long run.

A rule with a ``guard`` is found at every place where ``body`` stands, with no
character of ``before`` in front of it and none of ``after`` behind it; guards
consume nothing, so neighbouring and overlapping matches are all found.
``pattern`` then only answers whether there is a match.
"""

from __future__ import annotations

from typing import NamedTuple


class Guard(NamedTuple):
    """``before`` and ``after`` are the insides of character classes ('' for none)."""
    before: str
    body: str
    after: str


class Rule(NamedTuple):
    """A detector rule.  ``hints`` (any-of substrings), ``ci_hints`` (any-of
    lower-case substrings of the lower-cased text, for ``(?i)`` rules) and
    ``hint_re`` are cheap *necessary* conditions: the full pattern only runs
    on rows that pass them.  They never change the result, only skip
    hopeless rows.  (Java's ``(?i)`` folds ASCII only, so a case-insensitive
    match implies the lower-cased text contains the lower-case keyword.)"""
    raw_label: str
    pattern: str
    group: int
    confidence: float
    hints: tuple[str, ...] = ()
    hint_re: str | None = None
    ci_hints: tuple[str, ...] = ()
    guard: Guard | None = None


def guarded(raw_label: str, before: str, body: str, after: str, confidence: float, pattern: str | None = None, **hints) -> Rule:
    front = f"(^|[^{before}])" if before else "()"
    back = f"($|[^{after}])" if after else "()"
    return Rule(raw_label, pattern or f"{front}({body}){back}", 2, confidence, guard=Guard(before, body, after), **hints)


WS = r"[ \t]"
WSN = r"[ \t\r\n]"

# Personal data.  credit_card candidates are also Luhn-checked.
PII_RULES: tuple[Rule, ...] = (
    guarded("email_exposure", "A-Za-z0-9._%+-", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}", "", 0.9,
            pattern=r"[A-Za-z0-9._%+-]@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z][A-Za-z]", hints=("@",)),
    guarded("ssn", "0-9-", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "0-9-", 0.95, hint_re=r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    guarded("credit_card", "0-9", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", "0-9", 0.95,
            hint_re=r"[0-9]{4}[ -]?[0-9]{4}"),
    guarded("phone_number", "0-9(", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", "0-9", 0.7,
            hint_re=r"[0-9]{3}[ .-][0-9]{4}"),
    guarded("personal_data", "0-9.", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "0-9.", 0.6,
            hint_re=r"[0-9]\.[0-9]{1,3}\.[0-9]"),
)

SECRET_RULES: tuple[Rule, ...] = (
    guarded("aws_key", "A-Za-z0-9", r"AKIA[0-9A-Z]{16}", "A-Za-z0-9", 0.95, hints=("AKIA",)),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0.99, hints=("PRIVATE KEY-----",)),
    guarded("api_key", "A-Za-z0-9_-", r"sk-[A-Za-z0-9_-]{20,}", "", 0.9, hints=("sk-",)),
    Rule("secret_key", r"(?i)(secret|token|password|passwd|api[_-]?key)" + WS + r"*[:=]" + WS
         + r"*[\"']?([A-Za-z0-9/+_=-]{16,})", 2, 0.85,
         hint_re=r"[:=]" + WS + r"*[\"']?[A-Za-z0-9/+_=-]{16}"),
)

PROMPT_RULES: tuple[Rule, ...] = (
    Rule("instruction_override", r"(?i)(ignore|disregard|forget)" + WS + r"+(all" + WS + r"+)?(the" + WS
         + r"+)?(previous|prior|above|earlier)" + WS + r"+(instructions|prompts|rules|directions)", 0, 0.9,
         ci_hints=("ignore", "disregard", "forget")),
    Rule("system_prompt_extraction", r"(?i)(reveal|show|print|repeat|output)" + WS + r"+(me" + WS
         + r"+)?(your|the)" + WS + r"+(system" + WS + r"+prompt|hidden" + WS + r"+instructions|initial"
         + WS + r"+instructions)", 0, 0.85, ci_hints=("prompt", "instructions")),
    Rule("jailbreak_attempt", r"(?i)(do" + WS + r"+anything" + WS + r"+now|developer" + WS
         + r"+mode|jailbreak|without" + WS + r"+any" + WS + r"+(restrictions|filters))", 0, 0.8,
         ci_hints=("anything", "developer", "jailbreak", "without")),
)

CODE_RULES: tuple[Rule, ...] = (
    Rule("reverse_shell", r"bash" + WS + r"+-i" + WS + r"*>&" + WS + r"*/dev/tcp/|/dev/tcp/[0-9]+\.[0-9]+|nc"
         + WS + r"+[-a-z \t]*-e" + WS + r"+/bin/(ba)?sh", 0, 0.95, hints=("/dev/tcp/", "/bin/")),
    Rule("web_shell", r"(?i)<\?php" + WS + r"+(system|eval|exec|passthru|shell_exec)" + WS + r"*\(", 0, 0.9,
         hints=("<?",)),
    Rule("fork_bomb", r":\(\)" + WS + r"*\{" + WS + r"*:" + WS + r"*\|" + WS + r"*:" + WS + r"*&" + WS
         + r"*\}" + WS + r"*;" + WS + r"*:", 0, 0.99, hints=(":(",)),
    Rule("shell_injection", r"(;|&&|\|\|)" + WS + r"*(rm" + WS + r"+-rf|curl" + WS + r"|wget" + WS
         + r"|chmod" + WS + r"+\+x)", 0, 0.8, hints=("rm", "curl", "wget", "chmod")),
)

# SQL rules are boolean (one finding per statement and label).
SQL_RULES: tuple[Rule, ...] = (
    Rule("union_injection", r"(?i)union(" + WSN + r"+all)?" + WSN + r"+select", 0, 0.9),
    Rule("stacked_query", r"(?i);" + WSN + r"*(drop|delete|insert|update|alter|create|truncate|exec|grant)"
         + r"($|[^A-Za-z0-9_])", 0, 0.85),
    Rule("privilege_escalation", r"(?i)(^|[^A-Za-z0-9_])(grant" + WSN + r"+(all|admin|superuser|dba)|alter"
         + WSN + r"+(user|role)|create" + WSN + r"+(user|role)|set" + WSN + r"+role)", 0, 0.85),
)
# destructive_operation is suppressed when the request allows it.
DESTRUCTIVE_RULE = Rule(
    "destructive_operation", r"(?i)(^|[^A-Za-z0-9_])(drop" + WSN + r"+(table|database|schema|index|view)|truncate"
    + WSN + r"+|delete" + WSN + r"+from" + WSN + r"+[A-Za-z0-9_.]+" + WSN + r"*(;|$))", 0, 0.9)
# Tautologies: ``OR x = x`` / ``AND x = x`` where both sides are the same
# literal; the sides are captured (groups 2 and 3) and compared.
TAUTOLOGY_RULES: tuple[Rule, ...] = (
    Rule("tautology_or", r"(?i)[ \t\r\n)](or)" + WSN + r"+('[^']*'|[0-9]+)" + WSN + r"*=" + WSN
         + r"*('[^']*'|[0-9]+)", 0, 0.9),
    Rule("tautology_and", r"(?i)[ \t\r\n)](and)" + WSN + r"+('[^']*'|[0-9]+)" + WSN + r"*=" + WSN
         + r"*('[^']*'|[0-9]+)", 0, 0.9),
)

# Paths.  Traversal and sensitive locations are patterns; file names and
# extensions are set lookups on the last path segment (lower case).
PATH_RULES: tuple[Rule, ...] = (
    Rule("directory_traversal", r"(?i)(^|[/\\])\.\.([/\\]|$)|%2e%2e", 0, 0.95),
    Rule("sensitive_path", r"(?i)^(/etc/|/root/|/proc/|/sys/|/var/log/|[a-z]:/windows/)|/\.ssh/|/\.aws/|/\.gnupg/",
         0, 0.8),
)
SENSITIVE_FILES: tuple[str, ...] = (
    ".env", ".env.local", "id_rsa", "id_dsa", "id_ecdsa", "id_ed25519", ".htpasswd", ".netrc",
    ".pgpass", ".npmrc", "credentials", "shadow", "passwd", ".git-credentials")
SENSITIVE_FILE_CONFIDENCE = 0.9
SENSITIVE_EXTENSIONS: tuple[str, ...] = ("pem", "key", "p12", "pfx", "jks", "keystore", "kdbx", "ppk")
SENSITIVE_EXTENSION_CONFIDENCE = 0.8

# Domains: a small configured blocklist (matched on the host and every
# parent domain) and suspicious top-level domains.
BLOCKED_DOMAINS: tuple[str, ...] = ("example.net", "malware.test", "phish.invalid")
SUSPICIOUS_TLDS: tuple[str, ...] = ("zip", "mov", "top", "xyz", "tk", "gq", "ml", "cf", "click")
BLOCKED_DOMAIN_CONFIDENCE = 0.95
SUSPICIOUS_TLD_CONFIDENCE = 0.6

# Redaction tokens (the card rule redacts without the Luhn check).
REDACT_TOKENS: dict[str, str] = {
    "email_exposure": "[EMAIL]",
    "ssn": "[SSN]",
    "credit_card": "[CARD]",
    "phone_number": "[PHONE]",
    "personal_data": "[IP]",
}

# Framework bridge: canonical type -> compliance frameworks (our reading of
# the published coverage table; many-to-many).
FRAMEWORK_BRIDGE: tuple[tuple[str, str], ...] = (
    ("pii_exposure", "GDPR"),
    ("pii_exposure", "HIPAA"),
    ("pii_exposure", "PCI-DSS"),
    ("secrets_exposure", "ISO 27001"),
    ("secrets_exposure", "SOC 2"),
    ("prompt_injection", "NIST"),
    ("prompt_injection", "WebMCP"),
    ("jailbreak", "NIST"),
    ("system_prompt_leak", "NIST"),
    ("data_exfiltration", "WebMCP"),
    ("data_exfiltration", "GDPR"),
    ("sql_injection", "ISO 27001"),
    ("path_traversal", "ISO 27001"),
    ("malicious_code", "NIST"),
    ("privilege_escalation", "SOC 2"),
    ("destructive_operation", "SOC 2"),
)

RULE_FAMILIES: dict[str, tuple[Rule, ...]] = {
    "pii": PII_RULES,
    "secrets": SECRET_RULES,
    "prompt": PROMPT_RULES,
    "code": CODE_RULES,
}
