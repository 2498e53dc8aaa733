"""Metamorphic checks: invariance under repartitioning, routing partitions
the input, file round trips, idempotent normalisation."""

import pytest
from pyspark.sql import functions as F

from tollgate.functions.taxonomy import DEFAULT_SEVERITY
from tollgate.operators import detect as D
from tollgate.operators import extract as E
from tollgate.operators import policy as P
from tollgate.operators import verdicts as V
from tollgate.plans.catalog import QUERIES, governed_documents
from tollgate.sources import derived
from tollgate.sources.tables import parse_requests, read_json_lines, read_messages, read_table

from conftest import SF_MID, SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_verdicts_invariant_under_repartitioning(spark):
    docs = read_table(spark, SF_SMALL, "documents", ["doc_id", "text"])
    base = docs.select(F.col("doc_id").alias("item_id"),
                       D.findings(F.col("text"), ("pii", "secrets")).alias("findings"))
    shuffled = docs.repartition(7, "text").select(
        F.col("doc_id").alias("item_id"), D.findings(F.col("text"), ("pii", "secrets")).alias("findings"))
    cols = ["item_id", "safe", "threat_type", "confidence", "n_findings"]
    assert _rows(D.assemble(base).select(*cols)) == _rows(D.assemble(shuffled).select(*cols))


def test_routed_outputs_partition_the_input(spark):
    routed = QUERIES["sink_routed"](spark, SF_SMALL)
    n_docs = read_table(spark, SF_SMALL, "documents", ["doc_id"]).count()
    counts = {r.decision: r["count"] for r in routed.groupBy("decision").count().collect()}
    assert sum(counts.values()) == n_docs and set(counts) <= {"allow", "block"}
    assert routed.select("item_id").distinct().count() == n_docs


def test_allowed_and_blocked_partition_requests(spark):
    docs = read_table(spark, SF_SMALL, "documents", ["doc_id"]).withColumnRenamed("doc_id", "item_id")
    from tollgate.sources.tables import parse_verdicts
    v = V.sanitize(parse_verdicts(derived.raw_verdicts(docs, "item_id")))
    n_allowed = P.allowed(docs, v, "item_id").count()
    n_blocked = P.blocked(docs, v, "item_id").count()
    n_malformed = v.where(~F.col("valid")).count()
    assert n_malformed > 0 and n_allowed + n_blocked + n_malformed == docs.count()
    # Fail open lets the malformed ones pass, fail closed stops them.
    for mode, passed in (("open", n_allowed + n_malformed), ("closed", n_allowed)):
        assert P.allowed(docs, P.resolve_malformed(v, mode), "item_id").count() == passed


def test_rerun_of_routed_output_leaves_no_stale_rows(spark, tmp_path):
    from tollgate.sources.sinks import write_routed
    path = str(tmp_path / "routed")
    for second in ("block", "allow", None):
        write_routed(spark.createDataFrame([(1, "allow"), (2, second)], "item_id long, decision string"), path)
    assert sorted((r.item_id, r.decision) for r in spark.read.parquet(path).collect()) == [(1, "allow"), (2, "error")]


def test_no_shared_folder_is_an_error_on_a_cluster():
    from types import SimpleNamespace

    from tollgate.session import checkpoint_root
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        checkpoint_root(SimpleNamespace(conf={}, sparkContext=sc))


BRANCHES = {
    "detect_prompt": ["raw_type = 'instruction_override'", "raw_type = 'jailbreak_attempt'"],
    "detect_code": [f"raw_type = '{t}'" for t in ("reverse_shell", "web_shell", "fork_bomb", "shell_injection")],
    "detect_pii": [f"raw_type = '{t}'" for t in ("ssn", "phone_number", "credit_card", "email_exposure", "personal_data")],
    "detect_secrets": [f"raw_type = '{t}'" for t in ("aws_key", "private_key", "api_key", "secret_key")],
    "gate_empty": ["is_empty", "not is_empty"], "gate_size": ["oversize", "not oversize"],
    "conversation_decisions": [f"gate = '{g}'" for g in ("error", "empty", "scan")] + ["decision = 'block'"],
    "request_prompt": ["body is null", "body is not null"], "request_file": ["body is null", "content_type = 'file_path'"],
    "src_verdicts": ["not valid", "not confidence_finite"], "sanitize_verdicts": ["safe is null"],
    "govern_verdicts": [f"decision = '{x}'" for x in ("allow", "block", "error")] + ["reason like 'Scan error%'"],
    "blocked_report": ["n_violations > 0"], "payload_history": ["payload_error"], "payload_latest": ["payload_error"],
    "fail_mode": ["decision = 'error'", "decision = 'allow'"],
}


@pytest.mark.parametrize("name", sorted(BRANCHES))
def test_no_branch_is_vacuous(spark, name):
    df = QUERIES[name](spark, SF_MID).cache()
    for branch in BRANCHES[name]:
        assert df.where(branch).count() > 0, branch
    df.unpersist()


def test_canonical_labels_are_fixed_points(spark):
    df = spark.createDataFrame([(t,) for t in DEFAULT_SEVERITY if t != "unknown"], "t string")
    out = V.normalize_threat(df, "t", "n").collect()
    assert all(r.t == r.n for r in out)


def test_requests_round_trip_through_json_lines(spark, tmp_path):
    msgs = read_messages(spark, SF_SMALL, roles=None)
    req = derived.chat_requests(msgs, "anthropic")
    path = str(tmp_path / "requests")
    req.select("raw").write.text(path)
    from_file = E.extract_text(parse_requests(read_json_lines(spark, path)), "anthropic")
    in_memory = E.extract_text(parse_requests(req), "anthropic")
    assert _rows(from_file.select("text")) == _rows(in_memory.select("text"))
    assert from_file.where("extract_error").count() == 0


def test_stream_gate_batch_twin_on_flagship_columns(spark):
    g = governed_documents(spark, SF_SMALL)
    assert g.where(F.col("decision") == "block").where(F.col("threat_type").isNull()).count() == 0
    assert g.where(F.col("decision") == "allow").where(F.col("n_findings") > 0).count() == 0
