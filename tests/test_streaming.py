"""Streams equal their batch twins; custom detector errors become rows."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tollgate.operators import custom as C
from tollgate.plans.catalog import QUERIES, governed_documents
from tollgate.sources.tables import read_table

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_gate_equals_batch(spark):
    s = QUERIES["stream_gate"](spark, SF_SMALL)
    cols = ["item_id", "decision", "threat_type", "severity", "confidence", "n_findings"]
    assert _rows(s.select(*cols)) == _rows(governed_documents(spark, SF_SMALL).select(*cols))


def test_stream_outage_matches_batch_episodes(spark):
    alerts = QUERIES["stream_outage"](spark, SF_SMALL)
    episodes = QUERIES["outage_episodes"](spark, SF_SMALL)
    outages = alerts.where(F.col("event") == "outage")
    assert outages.count() == episodes.count()
    # the outage alert fires at the 5th failure of each episode
    j = episodes.join(outages.select("endpoint", "ts", F.col("first_event_id").alias("a")), "endpoint")
    assert j.where((F.col("ts") >= F.col("start_ts")) & (F.col("ts") <= F.col("end_ts"))).count() == episodes.count()


def test_stream_quota_closed_windows_subset_of_batch(spark):
    st = QUERIES["stream_quota"](spark, SF_SMALL)
    st = st.select("key_id", "tier", "minute_start", "n_scans", "rate_limit", "excess")
    b = QUERIES["quota_minute"](spark, SF_SMALL).select(*st.columns)
    assert st.exceptAll(b).count() == 0
    assert st.count() >= b.count() - 5


def test_custom_detector_errors_become_rows(spark):
    docs = read_table(spark, SF_SMALL, "documents", ["doc_id", "text"]).withColumnRenamed("doc_id", "item_id")

    def broken(b: pd.DataFrame) -> pd.DataFrame:
        raise RuntimeError("model unavailable")

    out = C.custom_detector(docs, broken)
    assert out.where(F.col("kind") == "error").count() == docs.count()
    ok = C.custom_detector(docs, C.shouting_detector)
    assert ok.where(F.col("kind") == "error").count() == 0


def _drop_file(df, folder, name, order):
    """One Parquet file with a modification time that sets its turn."""
    import glob
    import os
    import shutil
    tmp = f"{folder}-{name}"
    df.coalesce(1).write.parquet(tmp)
    os.makedirs(folder, exist_ok=True)
    target = f"{folder}/{name}.parquet"
    shutil.copy(glob.glob(f"{tmp}/*.parquet")[0], target)
    os.utime(target, (1_000_000 + order, 1_000_000 + order))


def _calls(spark):
    from tollgate.sources import derived
    return derived.outcomes(read_table(spark, SF_SMALL, "events")).select("endpoint", "event_id", "ts", "ok")


@pytest.fixture(scope="module")
def whole_alerts(spark, tmp_path_factory):
    """Alerts of all calls in one batch, runs of two, quiet after six hours."""
    from tollgate.streaming import jobs as S
    folder = str(tmp_path_factory.mktemp("whole"))
    calls = _calls(spark)
    calls.unionByName(S.heartbeat(calls)).write.parquet(f"{folder}/in")
    S.run_outage(spark, f"{folder}/in", f"{folder}/out", threshold=2, quiet_minutes=360)
    return _rows(spark.read.parquet(f"{folder}/out"))


def test_outage_alerts_hold_the_batch_episodes(spark, whole_alerts):
    from tollgate.operators import policy as P
    episodes = sorted(tuple(r) for r in P.outage_episodes(_calls(spark), threshold=2).select(
        "endpoint", "start_ts", "end_ts", "first_event_id", "last_event_id", "n_failures").collect())
    columns = ["endpoint", "event", "event_id", "ts", "streak", "start_ts", "first_event_id", "end_ts", "last_event_id"]
    rows = [dict(zip(columns, r)) for r in whole_alerts]
    found = {}
    for r in sorted(rows, key=lambda r: (r["endpoint"], r["end_ts"], r["event"] == "recovery")):
        if r["event"] != "outage":  # a later row of a run replaces an earlier one
            found[r["endpoint"], r["first_event_id"]] = (r["endpoint"], r["start_ts"], r["end_ts"], r["first_event_id"], r["last_event_id"], r["streak"])
    assert sorted(found.values()) == episodes and len(episodes) > 20
    assert sum(r["event"] == "outage" for r in rows) == len(episodes)
    assert any(r["event"] == "open" for r in rows)


def test_outage_alerts_do_not_depend_on_files_or_their_order(spark, tmp_path, whole_alerts):
    """Calls dealt over files at random, each file one batch, all of them
    inside the watermark."""
    from tollgate.streaming import jobs as S
    calls, folder = _calls(spark), str(tmp_path / "in")
    for k in range(3):
        _drop_file(calls.where(F.pmod(F.hash("event_id"), F.lit(3)) == k), folder, f"part{k}", k)
    _drop_file(S.heartbeat(calls, days=90), folder, "heart", 9)
    S.run_outage(spark, folder, str(tmp_path / "out"), threshold=2, watermark="40 days", quiet_minutes=360, max_files_per_trigger=1)
    assert _rows(spark.read.parquet(str(tmp_path / "out"))) == whole_alerts


def test_outage_stream_resumes(spark, tmp_path, whole_alerts):
    """The job ends between two files that cut runs in two; timers fire in the
    meantime, state and timers come back from the checkpoint."""
    from tollgate.streaming import jobs as S
    calls, folder, out, ckpt = _calls(spark), *(str(tmp_path / n) for n in ("in", "out", "ckpt"))
    cuts = calls.approxQuantile("event_id", [0.4, 0.7], 0.0)
    between = [None, *cuts, None]
    for k, (a, b) in enumerate(zip(between, between[1:])):
        part = calls.where((F.col("event_id") >= (a or 0)) & (F.col("event_id") < (b or 1 << 40)))
        _drop_file(part, folder, f"part{k}", k)
        S.run_outage(spark, folder, out, threshold=2, quiet_minutes=360, checkpoint=ckpt)
        assert k > 0 or 0 < spark.read.parquet(out).count() < len(whole_alerts)
    _drop_file(S.heartbeat(calls), folder, "heart", 9)
    S.run_outage(spark, folder, out, threshold=2, quiet_minutes=360, checkpoint=ckpt)
    assert _rows(spark.read.parquet(out)) == whole_alerts


def test_late_calls_are_dropped_and_counted(spark, tmp_path):
    from tollgate.streaming import jobs as S
    calls, folder = _calls(spark), str(tmp_path / "in")
    middle = calls.approxQuantile("event_id", [0.5], 0.0)[0]
    _drop_file(calls.where(F.col("event_id") >= middle), folder, "new", 0)
    _drop_file(S.heartbeat(calls, days=1), folder, "heart", 1)
    _drop_file(calls.where(F.col("event_id") < middle), folder, "old", 2)
    q = S.run_outage(spark, folder, str(tmp_path / "out"), threshold=2, max_files_per_trigger=1)
    dropped = sum(int(s.get("numRowsDroppedByWatermark", 0)) for p in q.recentProgress for s in p["stateOperators"])
    assert dropped > 0
    assert spark.read.parquet(str(tmp_path / "out")).where(F.col("first_event_id") < middle).count() == 0


def test_summaries_merge_like_the_whole(spark):
    """Any mix of calls within and across minutes, against plain counting."""
    import datetime as dt
    import random

    from tollgate.streaming import outage as O
    rnd = random.Random(1)
    for threshold in (1, 2, 3):
        t0, calls, at = dt.datetime(2024, 1, 1), [], 0
        for k in range(400):
            at += rnd.choice([0, 1, 5, 30, 70, 500])
            calls.append((1, t0 + dt.timedelta(seconds=at), k, rnd.random() < 0.35))
        df = spark.createDataFrame(calls, "endpoint long, ts timestamp_ntz, event_id long, ok boolean")
        run, got = None, []
        for s in sorted((r.asDict(True) for r in O.minute_summaries(df, "1 minute", threshold).drop("minute_time").collect()), key=lambda s: s["minute_us"]):
            more, run = O.apply_summary(run, s, threshold, 10**15)
            got += [(e, i, n) for e, i, _, n, *_ in more]
        want, streak = [], 0
        for _, _, k, ok in calls:
            if ok:
                want += [("recovery", k, streak)] if streak >= threshold else []
                streak = 0
            else:
                streak += 1
                want += [("outage", k, threshold)] if streak == threshold else []
        assert sorted(got) == sorted(want) and run[0] == streak


def test_stream_quota_drops_late_rows(spark, tmp_path):
    """Events arrive newest third first, then the middle, then the oldest
    third, one file per micro-batch.  Spark filters late input with the
    previous batch's watermark, so the middle third is still counted (its
    windows close at once) while the oldest third is behind the watermark:
    its rows are dropped and its windows never emitted."""
    import os
    import shutil
    from tollgate.streaming import jobs as S

    ev = read_table(spark, SF_SMALL, "events")
    q1, q2 = ev.approxQuantile("event_id", [1 / 3, 2 / 3], 0.0)
    parts = [ev.where(F.col("event_id") >= q2),
             ev.where((F.col("event_id") >= q1) & (F.col("event_id") < q2)),
             ev.where(F.col("event_id") < q1)]
    src = tmp_path / "flat"
    os.makedirs(src)
    for i, part in enumerate(parts):
        tmp = str(tmp_path / f"p{i}")
        part.coalesce(1).write.parquet(tmp)
        f = next(x for x in os.listdir(tmp) if x.endswith(".parquet"))
        shutil.copy(os.path.join(tmp, f), src / f"part{i}.parquet")
        os.utime(src / f"part{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    out = str(tmp_path / "quota")
    S.run_quota(spark, str(src), out, ev.schema, max_files_per_trigger=1)
    emitted = spark.read.parquet(out)
    oldest_max = parts[2].agg(F.max("ts")).first()[0]
    middle_min = parts[1].agg(F.min("ts")).first()[0]
    assert emitted.where(F.col("minute_start") >= middle_min.replace(second=0, microsecond=0)).count() > 0
    assert emitted.where(F.col("minute_start") < oldest_max.replace(second=0, microsecond=0)).count() == 0


def test_custom_detector_sees_only_gated_rows(spark):
    """Blank texts never reach the Python worker, nor do those a caller's size
    gate answers with a row of its own; a detector that always fails produces
    error rows only for the rows it was given."""
    rows = [(1, "a normal text"), (2, "   "), (3, None), (4, "x" * 50), (5, "short")]
    df = spark.createDataFrame(rows, "item_id long, text string")

    def boom(b: pd.DataFrame) -> pd.DataFrame:
        raise ValueError(f"saw {sorted(b['item_id'])}")

    got = {r.item_id: r.kind for r in C.custom_detector(df, boom, max_chars=20).collect()}
    assert got == {1: "error", 4: "gate", 5: "error"}
    assert {r.item_id for r in C.custom_detector(df, boom).collect()} == {1, 4, 5}


def test_one_bad_row_spoils_only_itself(spark):
    df = spark.range(200).selectExpr("id as item_id", "concat('text ', id) as text").coalesce(1)

    def picky(b: pd.DataFrame) -> pd.DataFrame:
        if (b["item_id"] == 77).any():
            raise ValueError("no")
        if (b["item_id"] == 78).any() and len(b) == 1:
            return pd.DataFrame({"item_id": [5000], "raw_type": ["x"], "confidence": [1.0]})
        if (b["item_id"] == 78).any():
            raise ValueError("no")
        return pd.DataFrame({"item_id": b["item_id"], "raw_type": "x", "confidence": 1.0})

    got = {r.item_id: r.kind for r in C.custom_detector(df, picky).collect()}
    assert len(got) == 200 and {i for i, k in got.items() if k == "error"} == {77, 78}


def test_gate_stream_resumes_and_replays(spark, tmp_path):
    """Batch 1 runs, the job ends; a second run with the same checkpoint takes
    only the new file, and a replayed batch replaces its own rows."""
    import glob
    import os

    from tollgate.streaming import jobs as S
    docs = read_table(spark, SF_SMALL, "documents")
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    docs.where("doc_id < 50").coalesce(1).write.parquet(src)
    S.run_gate(spark, src, out, docs.schema, checkpoint=ckpt)
    assert spark.read.parquet(out).count() == 50
    docs.where("doc_id >= 50").coalesce(1).write.mode("append").parquet(src)
    S.run_gate(spark, src, out, docs.schema, checkpoint=ckpt)
    assert spark.read.parquet(out).count() == docs.count()
    last = max(glob.glob(f"{ckpt}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    # As if the driver had died before the commit: the batch is run again.
    os.remove(last)
    os.remove(f"{ckpt}/commits/.{os.path.basename(last)}.crc")
    S.run_gate(spark, src, out, docs.schema, checkpoint=ckpt)
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("item_id").distinct().count() == docs.count()


@pytest.mark.parametrize("query, table", [("stream_gate", "documents"), ("stream_quota", "events")])
def test_streams_read_a_table_of_one_file_or_of_a_folder(spark, tmp_path, query, table):
    rows = read_table(spark, SF_SMALL, table).limit(200).cache()
    _drop_file(rows, str(tmp_path / "one"), table, 0)
    rows.repartition(3).write.parquet(str(tmp_path / "many" / f"{table}.parquet"))
    one, many = (_rows(QUERIES[query](spark, str(tmp_path / d))) for d in ("one", "many"))
    rows.unpersist()
    assert one == many and len(one) > 0


def test_packed_summaries_hold_the_summaries(spark):
    """Every field comes back as it was, NULL and large call numbers among them."""
    from tollgate.streaming import outage as O
    calls = [(e, None if (k + e) % 11 == 5 else (1 << 60) + k, f"2024-01-01 00:{k // 12:02d}:{k % 12 * 5:02d}", (k * k + e) % 7 == 1) for e in (1, 2, 3) for k in range(90)]
    df = spark.createDataFrame(calls, "endpoint long, event_id long, ts string, ok boolean").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    s = O.minute_summaries(df, "1 minute", 2).cache()
    key = lambda r: (r[0], r[1]["minute_us"])
    want = sorted(((r["endpoint"], O._plain(r.asDict(True))) for r in s.drop("minute_time").collect()), key=key)
    got = sorted(((r["endpoint"], O.unpacked(r["packed"], 2)) for r in O.packed_summaries(s).collect()), key=key)
    assert len(got) == len(want) > 20 and any(g["inner"] for _, g in got)
    for (e, g), (f, w) in zip(got, want):
        lead, end = w["lead"], w["lead"].pop("ended_by") if w["has_ok"] else None
        assert e == f and g["minute_us"] == w["minute_us"] and g["has_ok"] == w["has_ok"] and g["last_call_us"] == w["last_call_us"]
        assert end is None or g["lead"]["ended_by"] == {k: end[k] for k in ("us", "id")}
        assert g["head"] == [{k: c[k] for k in ("us", "id")} for c in w["head"]]
        for a, b in [(g["lead"], lead), (g["trail"], w["trail"]), *zip(g["inner"], w["inner"], strict=True)]:
            assert (a is None) == (b is None)
            for name in ("first", "nth", "last") if a else ():
                assert a["n"] == b["n"] and a[name] == (b[name] and {k: b[name][k] for k in ("us", "id")})
