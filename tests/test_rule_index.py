"""Required literals and the index of rules against the plain way."""

import random
import re

import pytest

from tollgate.functions import rules as R
from tollgate.operators import detect as D
from tollgate.operators.rule_index import folded, required_literals


@pytest.mark.parametrize("pattern, want", [
    ("hello", ("hello",)), ("(?i)HeLLo", ("hello",)), ("abc|defg", ("abc", "defg")), ("abc|d", None), ("ab", None), ("colou?r", ("colo",)),
    ("xab+cde", ("xab",)), ("xyzab*c", ("xyza",)), ("[abc]def(ghi|jk)lmnop", ("lmnop",)), (r"a\.b\*c", ("a.b*c",)), (r"\bword\b", ("word",)),
    (r"(a|b", None), (r"x\x41bcd", None), (r"\Qabc\E", None), ("(?x)abc", None), ("ab(?i)cde", None), ("abc{0}d", None), ("abcd{0,2}e", ("abc",)),
    ("abc{2}def", ("abc", )), ("(?:abc)?defg", ("defg",)), ("abc.*?defgh", ("defgh",)), ("abcd+?e", ("abcd",)), ("[]", None), ("", None), ("a[b[cd]]efg", ("efg",)),
    ("ab(?=cde)fgh", ("fgh",)), ("(abc", None), ("abc)", None), ("a{,3}", None),
])
def test_required_literals(pattern, want):
    if pattern == "abc{2}def":
        assert required_literals(pattern) in (("abc",), ("def",))
    else:
        assert required_literals(pattern) == want


def test_every_match_holds_a_literal():
    rnd = random.Random(1)
    pieces = ["ab", "foo", "Bar", "[xy]", "(p|q)", "(?:rs)?", "z*", "w+", "d?", ".", "|", "\\.", "\\d", "k{2}", "m{0,2}", "t{1,}"]
    for _ in range(4000):
        pattern = rnd.choice(["", "", "(?i)"]) + "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 6)))
        try:
            compiled = re.compile(pattern)
        except re.error:
            continue
        literals = required_literals(pattern)
        for _ in range(20):
            text = "".join(rnd.choice(["ab", "foo", "FOO", "bar", "Bar", "x", "p", "rs", "z", "w", "d", ".", "1", "kk", "m", "t", "AB"]) for _ in range(rnd.randint(0, 7)))
            if literals and compiled.search(text):
                assert any(x in folded(text) for x in literals), (pattern, text, literals)


def test_folding_keeps_what_java_keeps():
    assert folded("AbC") == "abc" and folded("ÄBΣ") == "ÄbΣ" and len(folded("İA")) == 2


def some_rules(n, seed):
    rnd = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega", "Sigma", "tau", "pi"]
    out = []
    for k in range(n):
        a, b = rnd.choice(words), rnd.choice(words)
        pattern = rnd.choice([f"(?i){a}[ ]+{b}", f"{a}|{b}", f"{a}{k % 9}", f"{a[:2]}.?{b}", f"[a-z]{{3}}{k % 7}", f"{a}( {b})+", f"({a}|{b}) x{k % 5}"])
        hints = (rnd.choice(words),) if k % 11 == 0 else ()
        out.append(R.Rule(f"label{k % 13}", pattern, 0, 0.5 + k % 3 / 10, hints))
    return out


def plain(texts, rules):
    out = []
    for i, t in texts:
        for r in rules:
            if t is not None and (not r.hints or any(h in t for h in r.hints)) and re.search(r.pattern, t):
                out.append((i, r.raw_label, r.confidence, 1, None))
    return sorted(out)


@pytest.mark.parametrize("block", [20_000, 40])
def test_index_gives_the_rows_of_the_plain_way(spark, monkeypatch, block):
    from tollgate.operators import rule_index
    monkeypatch.setattr(rule_index, "BLOCK_RULES", block)
    rnd = random.Random(2)
    words = ["alpha", "Beta", "gamma", "DELTA", "omega", "sigma", "tau", "pi", "x1", "x3", "alpha3", "abc4"]
    texts = [(k, None if k == 7 else " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12)))) for k in range(120)]
    rules = some_rules(150, 3)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = D.rule_scan(df, "doc_id", "text", D.rules_frame(spark, rules).repartition(3))
    assert sorted(map(tuple, got.collect())) == plain(texts, rules)
    few = rules[:20]
    assert sorted(map(tuple, D.rule_scan(df, "doc_id", "text", D.rules_frame(spark, few)).collect())) == plain(texts, few)


def test_rules_without_label_or_pattern(spark):
    rows = [(None, "alpha beta", None), ("x", None, 0.5)] + [("y", f"never{k}", 0.5) for k in range(80)]
    rules = spark.createDataFrame(rows, "raw_label string, pattern string, confidence double")
    df = spark.createDataFrame([("a", "alpha beta"), ("b", "")], "id string, text string")
    assert [tuple(r) for r in D.rule_scan(df, "id", "text", rules).collect()] == [("a", "unknown", None, 1, None)]


@pytest.mark.parametrize("pattern, want", [
    ("(?i)Alpha[ ]+betta", ("alpha beta",)), ("a b|b  a", ("a b", "b a")), ("colou+r", ("colour",)), ("xab+cde", ("xabcde",)), ("xyzab*c", ("xyza",)),
    ("abc{0}d", None), ("aaaa", ("a",)), ("[abc]def(ghi|jk)lmnop", ("lmnop",)), ("ab[^ ]+cde", ("cde",)), (r"ab[\]+cde", None), ("a[x]?bcd", ("bcd",)),
])
def test_squeezed_literals_go_on_over_repeats(pattern, want):
    from tollgate.operators.rule_index import squeezed_literals
    assert squeezed_literals(pattern) == want


def test_every_match_holds_a_squeezed_literal():
    from tollgate.operators.rule_index import squeezed, squeezed_literals
    rnd = random.Random(4)
    pieces = ["ab", "foo", "Baar", "[x]", "[ ]+", "(p|q)", "z*", "w+", "o+?", "[d]{2}", "d?", ".", "|", "\\.", "k{2}", "m{0,2}", "t{1,}", "[F]*"]
    for _ in range(4000):
        pattern = rnd.choice(["", "(?i)"]) + "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 6)))
        try:
            compiled = re.compile(pattern)
        except re.error:
            continue
        literals = squeezed_literals(pattern)
        for _ in range(20):
            text = "".join(rnd.choice(["ab", "foo", "FOo", "baar", "Baar", "x", "p", " ", "  ", "z", "w", "ww", "dd", "d", ".", "kk", "m", "t", "F", "é"]) for _ in range(rnd.randint(0, 9)))
            if literals and compiled.search(text):
                assert any(x in squeezed(text) for x in literals), (pattern, text, literals)


def test_alike_rules_are_looked_up_once_and_all_reported(spark, monkeypatch):
    from tollgate.operators import rule_index
    seen = []
    monkeypatch.setattr(rule_index, "_candidates", lambda ref, f=rule_index._candidates: seen.append(ref.value) or f(ref))
    rules = [R.Rule(f"label{k % 3}", "(?i)alpha[ ]+beta", 0, 0.5 + k % 2 / 4, ("beta",) if k % 5 == 0 else ()) for k in range(90)]
    df = spark.createDataFrame([("a", "x ALPHA   beta"), ("b", "Alpha Beta"), ("c", "alpha, beta")], "id string, text string")
    got = sorted((r[0], r[1], r[2]) for r in D.rule_scan(df, "id", "text", D.rules_frame(spark, rules).repartition(3)).collect())
    want = sorted([("a", r.raw_label, r.confidence) for r in rules] + [("b", r.raw_label, r.confidence) for r in rules if not r.hints])
    assert got == want and [len(x) for x in seen] == [2]
    assert {y for x in seen for _, y in [(k, tuple(v)) for k, v in x]} == {("alpha beta",)}


def test_large_table_without_any_literal(spark):
    rules = [R.Rule(f"l{k}", f"[a-z]{k % 10}", 0, 0.5, ()) for k in range(70)]
    df = spark.createDataFrame([("a", "x5"), ("b", None)], "id string, text string")
    assert D.rule_scan(df, "id", "text", D.rules_frame(spark, rules)).count() == 7
