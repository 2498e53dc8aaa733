"""Outage alerts on a stream whose rows arrive in any order inside the watermark.

Two stateful steps.  First every endpoint's rows of one minute are gathered
until the watermark has passed the minute, sorted, and described by one
*summary* whatever their number: the failures before the first success, the
failures after the last one, and every longer run in between.  Summaries of
consecutive minutes merge, because only the two outer runs can go on.  Then
``transformWithStateInPandas`` keeps one value for each endpoint -- the open run
-- and applies its summaries in order of minute (a later batch never brings an
earlier minute).  An event-time timer reports a run that stays open without any
call for ``quiet``.

Rows: ``outage`` at the failure that makes a run ``threshold`` long, ``recovery``
at the first success after such a run, ``open`` when such a run has seen no
call for ``quiet`` (the client is down, or has given up).  ``recovery`` and
``open`` carry the run (start, end, first and last call), so that recoveries and
the last ``open`` row of an endpoint together are the batch's outage episodes,
however the rows were split into files and in whatever order these came.

Rows behind the watermark are dropped and counted by Spark
(``numRowsDroppedByWatermark`` of the query's progress).  Minutes that the
watermark has not passed are withheld: a source that ends, or falls silent,
closes them with a heartbeat row (NULL endpoint, later time).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.policy import FAILURE_THRESHOLD

#: A run without a call for so long is reported as open.
QUIET_MINUTES = 24 * 60
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MINUTE_US = 60_000_000

RUN_STATE = "streak long, first_us long, first_id long, last_us long, last_id long, expiry long, reported boolean"
EVENTS = ("endpoint bigint, event string, event_id bigint, us bigint, streak bigint, "
          "start_us bigint, first_event_id bigint, end_us bigint, last_event_id bigint")


def minute_summaries(outcomes: DataFrame, watermark: str, threshold: int) -> DataFrame:
    """One row for each endpoint and minute, once the watermark has passed it.

    ``lead``: the first ``threshold`` failures before the first success (all
    failures, if there is none); ``inner``: complete runs of at least
    ``threshold`` failures between two successes; ``trail``: failures after the
    last success.  A call is (us, id)."""
    o = outcomes.select("endpoint", F.col("ts").cast("timestamp").alias("ts"), "event_id", "ok").withWatermark("ts", watermark)
    call = F.struct(F.unix_micros("ts").alias("us"), F.col("event_id").alias("id"), F.col("ok").alias("ok"))
    g = o.groupBy(F.window("ts", "1 minute").alias("minute"), "endpoint").agg(F.sort_array(F.collect_list(call)).alias("calls"))
    # Places of the successes, with one before the first and one after the last call.
    places = F.filter(F.transform("calls", lambda c, k: F.when(c["ok"], k + 1)), lambda k: k.isNotNull())
    g = g.withColumn("ok_at", F.concat(F.array(F.lit(0)), places, F.array(F.size("calls") + 1)))
    n_runs = F.size("ok_at") - 1

    def at(k: Column) -> Column:
        return F.get("calls", k - 1)

    def run(k: Column) -> Column:
        """The run between border ``k`` and the next one."""
        before, after = F.get("ok_at", k), F.get("ok_at", k + 1)
        n = after - before - 1
        return F.struct(n.cast("long").alias("n"), F.when(n > 0, at(before + 1)).alias("first"), F.when(n >= threshold, at(before + threshold)).alias("nth"),
                        F.when(n > 0, at(after - 1)).alias("last"), at(after).alias("ended_by"))
    inner = F.when(n_runs > 2, F.transform(F.sequence(F.lit(1), n_runs - 2), run))
    lead = run(F.lit(0))
    return g.select(
        "endpoint", F.window_time("minute").alias("minute_time"), F.unix_micros(F.col("minute.start")).alias("minute_us"),
        (n_runs > 1).alias("has_ok"), lead.alias("lead"), F.slice("calls", 1, threshold).alias("head"),
        F.get("calls", F.size("calls") - 1)["us"].alias("last_call_us"),
        F.coalesce(F.filter(inner, lambda r: r["n"] >= threshold), F.array()).alias("inner"),
        F.when(n_runs > 1, run(n_runs - 1)).alias("trail"))


def packed_summaries(s: DataFrame) -> DataFrame:
    """Rows (endpoint, minute_time, packed): a summary as one array of integers,
    which a Python worker takes over without a conversion for each field.  A
    call is (us, id or 0, id is NULL); what is missing from a run follows from
    its length and place (see :func:`unpacked`)."""
    def call(c: Column) -> list[Column]:
        return [F.coalesce(c["us"], F.lit(0)), F.coalesce(c["id"], F.lit(0)), c["id"].isNull().cast("long")]

    def run(r: Column) -> list[Column]:
        return [F.coalesce(r["n"], F.lit(0)), *call(r["first"]), *call(r["nth"]), *call(r["last"]), *call(r["ended_by"])]

    def each(c: str, fields: Callable) -> Column:
        return F.flatten(F.transform(c, lambda x: F.array(*fields(x))))
    fixed = F.array("minute_us", F.col("has_ok").cast("long"), "last_call_us", *run(F.col("lead")), *run(F.col("trail")), F.size("head").cast("long"))
    return s.select("endpoint", "minute_time", F.concat(fixed, each("head", call), each("inner", run)).alias("packed"))


_RUN, _HEAD = 13, 30  # integers of a run, and of all before the head's calls


def unpacked(v: list[int], threshold: int) -> dict:
    """The summary of a row of :func:`packed_summaries`."""
    def call(i: int) -> dict:
        return {"us": v[i], "id": None if v[i + 2] else v[i + 1]}

    def run(i: int, ended: bool) -> dict:
        n = v[i]
        return {"n": n, "first": call(i + 1) if n else None, "nth": call(i + 4) if n >= threshold else None, "last": call(i + 7) if n else None,
                "ended_by": call(i + 10) if ended else None}
    has_ok, inner = bool(v[1]), _HEAD + 3 * v[_HEAD - 1]
    return {"minute_us": v[0], "has_ok": has_ok, "last_call_us": v[2], "lead": run(3, has_ok), "trail": run(3 + _RUN, False) if has_ok else None,
            "head": [call(i) for i in range(_HEAD, inner, 3)], "inner": [run(i, True) for i in range(inner, len(v), _RUN)]}


def _plain(value):
    """Rows and arrays as dicts and lists, numbers as Python's integers."""
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, np.ndarray)):
        return [_plain(v) for v in value]
    if value is None or isinstance(value, (bool, np.bool_, pd.Timestamp)):
        return value
    return None if value != value else int(value)


def apply_summary(run: tuple | None, s: dict, threshold: int, quiet_us: int) -> tuple[list[tuple], tuple]:
    """(rows to report, the open run) after one minute's summary.

    A run is (streak, first_us, first_id, last_us, last_id, expiry, reported);
    ``expiry`` is the end of the minute in which it will have been quiet for
    long enough."""
    return apply_plain(run, _plain(s), threshold, quiet_us)


def apply_plain(run: tuple | None, s: dict, threshold: int, quiet_us: int) -> tuple[list[tuple], tuple]:
    """As :func:`apply_summary`, for a summary of plain integers."""
    streak, first_us, first_id, last_us, last_id, expiry, reported = run or (0, None, None, None, None, 0, False)
    out: list[tuple] = []

    def report(event: str, us: int, ident: int) -> None:
        out.append((event, ident, us, streak, first_us, first_id, last_us, last_id))
    if streak >= threshold and not reported and s["minute_us"] >= expiry:
        report("open", last_us, last_id)
        reported = True
    lead = s["lead"]
    if lead["n"]:
        if not streak:
            first_us, first_id = lead["first"]["us"], lead["first"]["id"]
        before, streak, reported = streak, streak + lead["n"], False
        last_us, last_id = lead["last"]["us"], lead["last"]["id"]
        if before < threshold <= streak:
            nth = s["head"][threshold - before - 1]
            out.append(("outage", nth["id"], nth["us"], threshold, first_us, first_id, nth["us"], nth["id"]))
    if s["has_ok"]:
        if streak >= threshold:
            report("recovery", lead["ended_by"]["us"], lead["ended_by"]["id"])
        for r in [*s["inner"], s["trail"]]:
            streak, reported = r["n"], False
            if streak:
                first_us, first_id, last_us, last_id = r["first"]["us"], r["first"]["id"], r["last"]["us"], r["last"]["id"]
            if streak >= threshold:
                out.append(("outage", r["nth"]["id"], r["nth"]["us"], threshold, first_us, first_id, r["nth"]["us"], r["nth"]["id"]))
                if r["ended_by"] is not None:
                    report("recovery", r["ended_by"]["us"], r["ended_by"]["id"])
    expiry = (s["last_call_us"] + quiet_us) // MINUTE_US * MINUTE_US + MINUTE_US
    return out, (streak, first_us, first_id, last_us, last_id, expiry, reported)


def _processor(threshold: int, quiet_us: int) -> Callable:
    """The processor's class; made here so that it travels to the workers by value."""
    from pyspark.sql.streaming import StatefulProcessor

    apply, unpack, columns = apply_plain, unpacked, [c.split()[0] for c in EVENTS.split(", ")]

    class Outages(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.run = handle.getValueState("run", RUN_STATE)

        def _frame(self, key, rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame([(key[0], event, ident, us, streak, first_us, first_id, last_us, last_id)
                                 for event, ident, us, streak, first_us, first_id, last_us, last_id in rows], columns=columns)

        def _waits(self, run: tuple | None) -> bool:
            """Whether the run has a timer: it is long enough and not reported."""
            return run is not None and run[0] >= threshold and not run[6]

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            run = self.run.get()
            run = tuple(run) if run is not None else None
            if self._waits(run):
                for t in list(self.handle.listTimers()):
                    self.handle.deleteTimer(t)
            found = []
            for v in sorted((v.tolist() for frame in rows for v in frame["packed"]), key=lambda v: v[0]):
                more, run = apply(run, unpack(v, threshold), threshold, quiet_us)
                found += more
            self.run.update(run)
            if self._waits(run):
                self.handle.registerTimer(run[5] // 1000)
            if found:
                yield self._frame(key, found)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            run = tuple(self.run.get())
            streak, first_us, first_id, last_us, last_id, expiry, reported = run
            self.run.update((streak, first_us, first_id, last_us, last_id, expiry, True))
            if not reported:
                yield self._frame(key, [("open", last_id, last_us, streak, first_us, first_id, last_us, last_id)])

        def close(self) -> None:
            pass

    return Outages


def outage_events(outcomes: DataFrame, threshold: int = FAILURE_THRESHOLD, watermark: str = "10 minutes",
                  quiet_minutes: int = QUIET_MINUTES) -> DataFrame:
    """The alert rows of a stream of ``(endpoint, event_id, ts, ok)``."""
    s = packed_summaries(minute_summaries(outcomes, watermark, threshold))
    rows = s.groupBy("endpoint").transformWithStateInPandas(
        statefulProcessor=_processor(threshold, quiet_minutes * MINUTE_US)(), outputStructType=EVENTS, outputMode="Append", timeMode="EventTime")

    def time(c: str) -> Column:
        return F.timestamp_micros(c).cast("timestamp_ntz")
    return rows.select("endpoint", "event", "event_id", time("us").alias("ts"), "streak", time("start_us").alias("start_ts"), "first_event_id",
                       time("end_us").alias("end_ts"), "last_event_id")
