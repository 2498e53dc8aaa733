"""Retries, failure policy, outages and quotas against hand tables and brute force."""

from collections import defaultdict

from pyspark.sql import functions as F

from tollgate.operators import policy as P
from tollgate.operators import quota as Q
from tollgate.sources import derived
from tollgate.sources.tables import read_table

from conftest import SF_SMALL

ATT = "request_id long, endpoint string, scan_kind string, attempt int, ts timestamp_ntz, kind string, status int, message string"


def _att(spark, rows):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(r, "ep0", sk, a, base + dt.timedelta(seconds=a), k, s, m) for r, sk, a, k, s, m in rows], ATT)


def test_retry_resolve_cases(spark):
    rows = [
        (1, "prompt", 1, "ok", 200, None),                                   # first try succeeds
        (2, "prompt", 1, "timeout", None, "timed out"), (2, "prompt", 2, "ok", 200, None),
        (3, "prompt", 1, "http", 503, "HTTP 503"), (3, "prompt", 2, "http", 429, "HTTP 429"),
        (3, "prompt", 3, "ok", 200, None),                                   # 429 is terminal
        (4, "sql", 1, "connect", None, "refused"), (4, "sql", 2, "timeout", None, "t"),
        (4, "sql", 3, "timeout", None, "timed out"), (4, "sql", 4, "ok", 200, None),  # beyond max
        (5, "file", 2, "ok", 200, None), (5, "file", 1, "decode", None, "bad json"),  # unordered log
    ]
    got = {r.request_id: (r.attempts, r.kind, r.status, r.backoff_s, r.succeeded)
           for r in P.retry_resolve(_att(spark, rows)).collect()}
    assert got == {1: (1, "ok", 200, 0.0, True), 2: (2, "ok", 200, 0.2, True),
                   3: (2, "http", 429, 0.2, False), 4: (3, "timeout", None, 0.6, False),
                   5: (1, "decode", None, 0.0, False)}


def test_backoff_cap(spark):
    df = spark.range(1).select(P.total_backoff(F.lit(7)).alias("b"), P.total_backoff(F.lit(0)).alias("z"))
    r = df.collect()[0]
    assert abs(r.b - (0.2 + 0.4 + 0.8 + 1.6 + 3.2 + 5 + 5)) < 1e-9 and r.z == 0.0


def test_fail_mode_texts(spark):
    cases = [  # kind, status, message, scan_kind -> (open reason, closed error)
        ("breaker_open", None, "", "prompt", "Circuit breaker open, failing open",
         "Security service circuit breaker open"),
        ("timeout", None, "t", "prompt", "Scan timeout, failing open",
         "Scan request timed out and fail_mode is 'closed'"),
        ("http", 500, "HTTP 500", "prompt", "Scan API error: 500", "Scan API returned error: 500"),
        ("connect", None, "refused", "prompt", "Scan error: refused", "Scan failed: refused"),
        ("timeout", None, "t", "sql", "Scan timeout, failing open", "SQL scan request timed out"),
        ("timeout", None, "t", "file", "Scan timeout, failing open", "File scan request timed out"),
        ("http", 502, "boom", "sql", "Scan error: boom", "SQL scan failed: boom"),
        ("connect", None, "refused", "file", "Scan error: refused", "File scan failed: refused"),
    ]
    rows = [(i, c[3], c[0], c[1], c[2]) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "request_id long, scan_kind string, kind string, status int, message string")
    op = {r.request_id: r for r in P.apply_fail_mode(df, "open").collect()}
    cl = {r.request_id: r for r in P.apply_fail_mode(df, "closed").collect()}
    for i, c in enumerate(cases):
        assert (op[i].decision, op[i].safe, op[i].reason) == ("allow", True, c[4])
        assert op[i].degraded == (True if c[0] == "breaker_open" else None)
        assert (cl[i].decision, cl[i].error, cl[i].safe) == ("error", c[5], None)


def _brute_episodes(rows, threshold):
    by_ep = defaultdict(list)
    for r in rows:
        by_ep[r.endpoint].append(r)
    out = set()
    for ep, rs in by_ep.items():
        rs.sort(key=lambda r: (r.ts, r.event_id))
        run = []
        for r in rs + [None]:
            if r is not None and not r.ok:
                run.append(r)
                continue
            if len(run) >= threshold:
                out.add((ep, run[0].ts, run[-1].ts, run[0].event_id, run[-1].event_id, len(run)))
            run = []
    return out


def test_outage_episodes_vs_brute_force(spark):
    o = derived.outcomes(read_table(spark, SF_SMALL, "events"))
    rows = o.collect()
    for threshold, chunk in [(2, 60), (3, 3600), (2, 10 ** 7)]:   # tiny chunks cross often
        got = {tuple(r) for r in P.outage_episodes(o, threshold, chunk_seconds=chunk).collect()}
        assert got == _brute_episodes(rows, threshold)
        assert got


def test_quota_month_crossing_vs_brute_force(spark):
    tiers = (("anonymous", None, None), ("community", 1, 5), ("pro", 2, 9), ("enterprise", 3, 500))
    s = derived.scans(read_table(spark, SF_SMALL, "events"))
    got = {(r.key_id, r.month_start): (r.n_scans, r.allowance, r.over_by, r.crossed_event_id)
           for r in Q.quota_month(s, tiers).collect()}
    limits = {t: m for t, _, m in tiers}
    per = defaultdict(list)
    for r in s.collect():
        per[(r.key_id, r.ts.replace(day=1, hour=0, minute=0, second=0, microsecond=0))].append(r)
    expect = {}
    for k, rs in per.items():
        rs.sort(key=lambda r: (r.ts, r.event_id))
        lim = limits[rs[0].tier]
        crossed = rs[lim].event_id if lim is not None and len(rs) > lim else None
        expect[k] = (len(rs), lim, max(len(rs) - lim, 0) if lim is not None else 0, crossed)
    assert got == expect
    assert any(v[3] is not None for v in got.values())


def test_quota_minute_excess(spark):
    tiers = (("anonymous", None, None), ("community", 1, 5), ("pro", 1, 9), ("enterprise", 1, 500))
    s = derived.scans(read_table(spark, SF_SMALL, "events"))
    got = Q.quota_minute(s, tiers)
    total = got.agg(F.sum("n_scans")).collect()[0][0]
    assert total == s.count()
    bad = got.where((F.col("tier") != "anonymous") & (F.col("excess") != F.col("n_scans") - 1)).count()
    assert bad == 0


def test_requests_logged_only_past_the_limit_are_errors(spark):
    from tollgate.operators import policy as P
    rows = [(1, "ep0", "prompt", 5, "ok"), (2, "ep0", "prompt", 1, "timeout"), (2, "ep0", "prompt", 9, "ok")]
    df = spark.createDataFrame(rows, "request_id long, endpoint string, scan_kind string, attempt int, kind string").selectExpr(
        "*", "cast(null as int) as status", "cast(null as string) as message", "timestamp_ntz'2024-01-01 00:00:00' as ts")
    got = {r.request_id: r for r in P.apply_fail_mode(P.retry_resolve(df), "closed").collect()}
    assert (got[1].kind, got[1].decision, got[1].error) == ("unlogged", "error", "Scan failed: " + P.UNLOGGED_MESSAGE)
    assert got[2].kind == "timeout"


def test_month_quota_of_a_key_that_changes_tier(spark):
    from tollgate.operators import quota as Q
    df = spark.range(30).selectExpr("1L as key_id", "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0,0,0,id) as ts",
                                    "case when id % 2 = 0 then 'a' else 'b' end as tier")
    got = {r.tier: r for r in Q.quota_month(df, (("a", None, 3), ("b", None, 100))).collect()}
    assert (got["a"].n_scans, got["a"].over_by, got["a"].crossed_event_id) == (15, 12, 6)
    assert (got["b"].n_scans, got["b"].over_by, got["b"].crossed_event_id) == (15, 0, None)


def test_rows_without_a_key_keep_their_carry(spark):
    from pyspark.sql import functions as F
    from tollgate.plans.running import chunked_running
    df = spark.range(10).selectExpr("cast(null as string) as k", "id as o")
    out = chunked_running(df, ["k"], ["o"], F.floor(F.col("o") / 3), F.lit(1), "sum", "n").orderBy("o").collect()
    assert [r.n for r in out] == list(range(1, 11))
