"""Verdict JSON as the scan client's parser reads it, and verdict logs."""

import json
import math
import random

from pyspark.sql import functions as F

from tollgate.sources.tables import non_finite_as_null, parse_verdicts, read_verdicts


def plain(raw):
    """(valid, has_safe, safe, has_reason, reason, confidence) by Python's parser."""
    try:
        v = json.loads(raw)
    except (TypeError, ValueError):
        v = None
    if not isinstance(v, dict) or not (v.get("safe") is None or isinstance(v["safe"], bool)):
        return (False, False, None, False, None, None)
    c = v.get("confidence")
    return (True, "safe" in v, bool(v["safe"]) if "safe" in v else None, "reason" in v, v.get("reason"), None if c is None else float(c))


CASES = [
    '{"safe":false,"confidence":NaN,"reason":"limit:NaN, Infinity"}', '{"a":{"safe":1},"b":1,"b":2}', '{"safe":true,"safe":false,"reason":"x"}',
    '{"safe":false,"reason":"a \\"NaN\\" b","confidence":-Infinity}', '{"reason":"ends in a backslash \\\\","confidence":NaN}', '{"reason":"\\\\\\"NaN","confidence":Infinity}',
    '{"safe":null}', '{"safe":"yes"}', '{"safe":0}', '{}', ' {"safe" : true} ', '[{"safe":true}]', 'null', '', None, '{"safe":true', '{"safe":true} x', '{"reason":null,"reason":null}',
    '{"x":[NaN,{"safe":Infinity}],"safe":true}', '{"reason":"","confidence":0.5}', '{"safe":true,"x":1,"x":NaN}', '{"reason":"safe","b":1,"b":2}',
]


def _same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def _rows(df):
    return {r.k: (r.valid, r.has_safe, r.safe_value, r.has_reason, r.reason, r.confidence) for r in df.collect()}


def test_verdicts_are_read_as_the_client_reads_them(spark):
    got = _rows(parse_verdicts(spark.createDataFrame(list(enumerate(CASES)), "k int, raw string")))
    for k, raw in enumerate(CASES):
        want = plain(raw)
        assert all(_same(a, b) for a, b in zip(got[k], want)), (raw, got[k], want)


def test_strings_are_never_changed(spark):
    rnd = random.Random(1)
    values = ["NaN", "Infinity", "-Infinity", 'quo"te', "back\\slash", "\\", '\\"', "a:NaN,b", "é", "", "\t"]
    docs = [{f"k{j}": rnd.choice([rnd.choice(values), rnd.random(), float("nan"), float("-inf"), None, [rnd.choice(values), float("inf")]]) for j in range(4)} for _ in range(300)]
    df = spark.createDataFrame([(json.dumps(d, ensure_ascii=rnd.random() < 0.5),) for d in docs], "raw string")

    def clean(v):
        if isinstance(v, list):
            return [clean(x) for x in v]
        return None if isinstance(v, float) and not math.isfinite(v) else v
    got = [json.loads(r.out) for r in df.select(non_finite_as_null(F.col("raw")).alias("out")).collect()]
    assert got == [{k: clean(v) for k, v in d.items()} for d in docs]


def test_verdict_log(spark, tmp_path):
    lines = ['1\t{"safe":true}', '2\t{"safe":"no"}', '3\t', '4', 'x\t{"safe":true}', '5\t{"safe":fal', '-6\t{"safe":false,"confidence":NaN}', '7\t[1]', '', '8\t{"reason":"tab\\there"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_path}/log")
    verdicts, unreadable = read_verdicts(spark, f"{tmp_path}/log")
    assert {r.item_id: r.valid for r in verdicts.collect()} == {1: True, 2: False, 3: False, 4: False, 5: False, -6: True, 7: False, 8: True}
    assert {r.line: r.why for r in unreadable.collect()} == {
        lines[1]: "safe is neither a boolean nor null", lines[2]: "no verdict", lines[3]: "no verdict", lines[4]: "no id", lines[5]: "no JSON object", lines[7]: "no JSON object", lines[8]: "no id"}
    assert all(r.file.endswith(".txt") for r in unreadable.collect())
