"""The registered queries meet what they are there for (sf0.01), and streams of
resent requests scan a message once."""

import pytest
from pyspark.sql import functions as F

from tollgate.plans.catalog import QUERIES, governed_conversations
from tollgate.plans.governance import conversation_verdicts
from tollgate.sources import derived
from tollgate.sources.tables import read_messages, read_table
from tollgate.streaming import requests as SR

from conftest import SF_MID, SF_SMALL


@pytest.mark.parametrize("name, condition", [
    ("quota_minute", "excess > 0"), ("quota_month", "crossed_event_id is not null"), ("quota_month", "over_by > 0"), ("stream_quota", "excess > 0"),
    ("quota_rolling", "excess > 0"), ("quota_asof", "over_by > 0"), ("sessions", "n_scans > 3"), ("rule_scan_large", "raw_type like 'pair%'"),
    ("breaker_outcomes", "kind = 'breaker_open' and decision = 'error'"), ("breaker_outcomes", "degraded"), ("breaker_outcomes", "kind = 'unlogged'"),
    ("custom_detector", "kind = 'error'"), ("custom_detector", "kind = 'gate'"), ("custom_detector", "kind = 'finding'"),
    ("history_verdicts", "decision = 'error'"), ("history_verdicts", "n_findings > 1"), ("detect_domain_large", "matched = 'org'"),
    ("stream_outage", "event = 'recovery'"), ("stream_outage", "event = 'open'"),
])
def test_query_fires(spark, name, condition):
    assert QUERIES[name](spark, SF_MID).where(condition).count() > 0


def test_keys_are_billed_to_the_tier_of_the_moment(spark):
    rows = QUERIES["quota_asof"](spark, SF_MID)
    assert rows.groupBy("key_id", "month_start").count().where("count > 1").count() > 10


def _lines(spark, folder, df):
    df.coalesce(1).write.mode("append").text(folder)


def test_resent_histories_are_scanned_once(spark, tmp_path):
    """First requests, a restart, then the whole histories: one row for each
    message, and the batch's decisions."""
    msgs = derived.planted_messages(read_messages(spark, SF_SMALL, roles=None))
    lines = derived.resent_requests(msgs)
    first = lines.where(F.get_json_object("value", "$.ts").isNull() | (F.length("value") < 600))
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    _lines(spark, src, first)
    SR.run_requests(spark, src, out, checkpoint=ckpt)
    before = spark.read.parquet(f"{out}/messages").count()
    _lines(spark, src, lines.exceptAll(first))
    _lines(spark, src, lines.limit(40))
    SR.run_requests(spark, src, out, checkpoint=ckpt)
    found = spark.read.parquet(f"{out}/messages")
    assert 0 < before < found.count() == msgs.select("conv_id", "role", "text").distinct().count()
    assert sorted(map(tuple, conversation_verdicts(found).collect())) == sorted(map(tuple, governed_conversations(spark, SF_SMALL).collect()))


def test_unreadable_lines_have_a_sink_of_their_own(spark, tmp_path):
    good = '{"id": 1, "ts": "2024-01-01T00:00:00", "messages": [{"role": "user", "content": "hello"}, 5, {"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}'
    bad = ['{"id": 1, "ts"', "[]", "", '{"id": 2, "messages": []}', '{"id": 3, "ts": "no time", "messages": []}', '{"ts": "2024-01-01T00:00:00", "messages": []}']
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _lines(spark, src, spark.createDataFrame([(x,) for x in [good, *bad]], "value string"))
    SR.run_requests(spark, src, out)
    assert sorted(r.value for r in spark.read.parquet(f"{out}/unreadable").collect()) == sorted(bad)
    rows = spark.read.parquet(f"{out}/messages").orderBy("chars").collect()
    assert [(r.conv_id, r.mine, r.chars) for r in rows] == [(1, None, None), (1, True, 3), (1, True, 5)]


def test_stream_sessions_equal_batch(spark):
    assert sorted(map(tuple, QUERIES["stream_sessions"](spark, SF_SMALL).collect())) == sorted(map(tuple, QUERIES["sessions"](spark, SF_SMALL).collect()))


def test_sessions_of_a_late_file(spark, tmp_path):
    """Files in any order inside the watermark merge into the same bursts."""
    from tollgate.streaming import jobs as S
    from tollgate.operators import quota as Q
    scans = derived.scans(read_table(spark, SF_SMALL, "events")).select("key_id", "ts")
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(3):
        scans.where(F.pmod(F.hash("ts"), F.lit(3)) == k).coalesce(1).write.mode("append").parquet(src)
    S.heartbeat(scans, days=90).select(F.col("endpoint").alias("key_id"), "ts").coalesce(1).write.mode("append").parquet(src)
    S.run_sessions(spark, src, out, "6 hours", watermark="60 days", max_files_per_trigger=4)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, Q.sessions(scans, "6 hours").collect()))
