"""Taxonomy tables and verdict normalisation (exact unit tables)."""

import json

import pytest
from pyspark.sql import functions as F

from tollgate.functions.taxonomy import DEFAULT_SEVERITY, GUIDANCE, RAW_TO_CANONICAL
from tollgate.operators import verdicts as V
from tollgate.sources.tables import parse_verdicts

# Hand-counted group sizes of the raw-label table.
EXPECTED_GROUP_SIZES = {
    "prompt_injection": 12, "jailbreak": 11, "system_prompt_leak": 2, "data_exfiltration": 7,
    "sql_injection": 7, "path_traversal": 7, "secrets_exposure": 10, "pii_exposure": 11,
    "blocked_domain": 4, "toxicity": 2, "malicious_code": 8, "harmful_intent": 2,
    "social_engineering": 3, "privilege_escalation": 1, "destructive_operation": 1,
    "scan_error": 2, "size_limit_exceeded": 2,
}


def test_taxonomy_shape():
    assert len(RAW_TO_CANONICAL) == 92
    sizes = {}
    for canon in RAW_TO_CANONICAL.values():
        sizes[canon] = sizes.get(canon, 0) + 1
    assert sizes == EXPECTED_GROUP_SIZES
    assert set(GUIDANCE) == set(DEFAULT_SEVERITY) == set(EXPECTED_GROUP_SIZES) | {"unknown"}
    # normalisation is idempotent: every canonical name maps to itself
    for canon in EXPECTED_GROUP_SIZES:
        assert RAW_TO_CANONICAL[canon] == canon


def _sanitize(spark, docs):
    rows = [(i, json.dumps(d) if not isinstance(d, str) else d) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "item_id long, raw string")
    out = V.sanitize(parse_verdicts(df)).orderBy("item_id").collect()
    return [r.asDict() for r in out]


def test_sanitize_cases(spark):
    docs = [
        {"safe": True},                                                       # 0
        {"safe": False, "reason": "x", "threat_type": "pii_extraction", "confidence": 0.95},  # 1
        {"safe": True, "threat_level": "none"},                               # 2 extra field dropped
        {"safe": False, "threat_type": "sensitive_file", "reason": "r"},     # 3 no confidence -> medium
        {"safe": False, "threat_type": "sql_injection", "confidence": 0.7},   # 4
        {},                                                                   # 5 safe absent -> safe
        '{"safe": null, "threat_type": "Prompt-Injection", "confidence": 0.3}',  # 6 null -> unsafe, folding
        {"safe": False, "reason": None, "severity": "LOW", "threat_type": " sqli"},  # 7 no trim, null reason
        {"safe": False, "threat_type": "x", "severity": "urgent", "confidence": 0.9},  # 8 invalid severity
        {"safe": "yes"},                                                      # 9 not a boolean: malformed
        {"safe": 0, "detected_by": "layer-3", "matched_text": "s3cret"},      # 10 not a boolean: malformed
        {"safe": True, "reason": None},                                       # 11 safe null reason
        {"safe": False, "threat_type": None},                                 # 12 null label
    ]
    got = _sanitize(spark, docs)
    assert got[0] == dict(item_id=0, safe=True, reason="", threat_type=None, severity=None,
                          confidence=None, guidance=None, valid=True)
    assert (got[1]["threat_type"], got[1]["severity"], got[1]["confidence"], got[1]["reason"]) == \
        ("pii_exposure", "high", "high", "x")
    assert got[2]["safe"] is True and "threat_level" not in got[2]
    assert (got[3]["threat_type"], got[3]["severity"], got[3]["confidence"]) == \
        ("secrets_exposure", "critical", "medium")
    assert (got[4]["threat_type"], got[4]["confidence"]) == ("sql_injection", "medium")
    assert got[5]["safe"] is True and got[5]["reason"] == ""
    assert (got[6]["safe"], got[6]["threat_type"], got[6]["confidence"]) == (False, "prompt_injection", "low")
    assert got[6]["reason"] == GUIDANCE["prompt_injection"]
    assert (got[7]["threat_type"], got[7]["severity"], got[7]["reason"]) == ("unknown", "low", None)
    assert (got[8]["threat_type"], got[8]["severity"], got[8]["confidence"]) == ("unknown", "medium", "high")
    for k in (9, 10):
        assert got[k] == dict(item_id=k, safe=None, reason=None, threat_type=None, severity=None, confidence=None, guidance=None, valid=False)
    assert got[11]["safe"] is True and got[11]["reason"] is None
    assert got[12]["threat_type"] == "unknown"


MALFORMED = ['{"safe": fal', "", None, '[{"safe": true}]', "null", "17", '"text"', '{"safe":"no"}', '{"safe":[]}', "{", '{"safe": true} x']


def test_malformed_verdicts_follow_the_failure_policy(spark):
    from tollgate.operators import policy as P
    df = spark.createDataFrame(list(enumerate(MALFORMED)), "item_id long, raw string")
    v = V.sanitize(parse_verdicts(df))
    assert all(r.safe is None and not r.valid for r in v.collect())
    assert {r.decision for r in P.decide(v).collect()} == {"error"}
    closed = P.resolve_malformed(v, "closed").collect()
    assert all((r.decision, r.safe) == ("error", None) and r.error.startswith("Scan failed") for r in closed)
    opened = P.resolve_malformed(v, "open").collect()
    assert all((r.decision, r.safe) == ("allow", True) and r.reason.startswith("Scan error") for r in opened)


def test_non_finite_confidence_and_repeated_keys(spark):
    docs = ['{"safe": false, "confidence": NaN, "threat_type": "sqli"}', '{"safe":false,"confidence":Infinity,"reason":null}',
            '{"safe":false,"confidence":-Infinity}', '{"safe":true,"safe":false,"threat_type":"pii"}', '{"safe":false,"safe":true}']
    got = _sanitize(spark, docs)
    assert [g["safe"] for g in got] == [False, False, False, False, True]
    assert [g["confidence"] for g in got[:3]] == ["low", "high", "low"]
    assert got[0]["threat_type"] == "sql_injection" and got[1]["reason"] is None and got[2]["reason"] == GUIDANCE["unknown"]


def test_bucket_confidence_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 0.9), (4, 0.69999), (5, 0.7)],
                               "i int, c double")
    got = {r.i: r.b for r in V.bucket_confidence(df, "c", "b").collect()}
    assert got == {1: "low", 2: "medium", 3: "high", 4: "low", 5: "medium"}


@pytest.mark.parametrize("label,canon", [
    ("pii_extraction", "pii_exposure"), ("sensitive_file", "secrets_exposure"),
    ("sql_injection", "sql_injection"), ("timeout", "scan_error"), ("TAUTOLOGY-OR", "sql_injection"),
    ("", "unknown"), ("nope", "unknown"), ("size-limit", "size_limit_exceeded"),
])
def test_normalize_threat_join(spark, label, canon):
    df = spark.createDataFrame([(1, label)], "i int, t string")
    assert V.normalize_threat(df, "t", "n").collect()[0].n == canon


def test_normalize_uses_broadcast(spark):
    df = spark.range(10).withColumn("t", F.concat(F.lit("sqli"), F.col("id").cast("string")))
    plan = V.normalize_threat(df, "t", "n")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
