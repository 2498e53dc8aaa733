"""Literals of rules in arrays: what they decide, and how often texts are read."""

import random
import re
from types import SimpleNamespace

import pyarrow as pa
import pytest

from tollgate.functions import rules as R
from tollgate.operators import detect as D
from tollgate.operators import rule_index as RI

ANY = RI.ANY


@pytest.mark.parametrize("pattern, want", [
    ("ab", (False, [[("a", 1, ANY), ("b", 1, ANY)]])), ("(?i)aB+c", (True, [[("a", 1, ANY), ("b", 1, ANY), ("c", 1, ANY)]])),
    ("xaab{2}a[ ]{1,3}y", (False, [[("x", 1, ANY), ("a", 2, 2), ("b", 2, 2), ("a", 1, 1), (" ", 1, 3), ("y", 1, ANY)]])),
    (r"a\.+b|c d", (False, [[("a", 1, ANY), (".", 1, ANY), ("b", 1, ANY)], [("c", 1, ANY), (" ", 1, 1), ("d", 1, ANY)]])),
    ("xa+a{2,}y", (False, [[("x", 1, ANY), ("a", 3, ANY), ("y", 1, ANY)]])), ("(?i)xaAy", (True, [[("x", 1, ANY), ("a", 2, 2), ("y", 1, ANY)]])),
    ("xa{254}y", (False, [[("x", 1, ANY), ("a", 254, 254), ("y", 1, ANY)]])),
    ("aAb", None), ("a|", None), ("", None), ("a*b", None), ("a?b", None), ("a++b", None), ("a+?b", None), ("a{2}+b", None), ("a{0,2}b", None), ("xa{255}y", None),
    ("xa{3,300}y", None), ("a{2,1}b", None), ("^ab", None), (r"\bab", None), (r"a\db", None), ("[ab]c", None), ("[^a]b", None), ("(ab)", None), ("(?x)ab", None), ("a.b", None),
])
def test_whole_runs(pattern, want):
    assert RI.whole_runs(pattern) == want


def some_patterns(rnd, n):
    pieces = ["ab", "foo", "Bar", "[x]", "[ ]+", "o+", "w{2}", "z{1,2}", "é", "ß+", "K", "\\.", "t", "𝒳", "  ", "aab"]
    out = {rnd.choice(["", "", "(?i)"]) + "|".join("".join(rnd.choice(pieces) for _ in range(rnd.randint(2, 4))) for _ in range(rnd.choice([1, 1, 2]))) for _ in range(n)}
    return sorted(p for p in out if RI.squeezed_literals(p))


def some_texts(rnd, n, patterns):
    words = ["\u212a", "\u017f", "ab", "Ab", "foo", "foO", "FOOO", "bar", "Bar", "x", "xx", "X", " ", "  ", "o", "w", "ww", "www", "z", "zzz", "é", "É", "ß", "ßß", "k", "K", "K", ".", "t", "T", "𝒳", "aab", "aaab"]
    said = [re.sub(r"\(\?i\)|\\|\[|\]|\+", "", p).replace("{1,2}", rnd.choice(["", "z", "zz"])).replace("{2}", rnd.choice(["", "w", "ww"])).split("|")[0] for p in patterns]
    text = lambda: "".join(rnd.choice(words) if rnd.random() < 0.7 else rnd.choice([str, str.lower, str.swapcase])(rnd.choice(said)) for _ in range(rnd.randint(0, 9)))
    return [None if k % 17 == 3 else text() for k in range(n)]


def literals(patterns, hinted=False):
    kind = pa.list_(pa.struct([("chars", pa.string()), ("least", pa.binary()), ("most", pa.binary()), ("kind", pa.int32())]))
    return RI.Literals(pa.table({"alike": pa.array(range(10, 10 + len(patterns)), pa.int64()), "literals": pa.array([RI._described(p, hinted) for p in patterns], kind)}))


@pytest.mark.parametrize("piece, window, compared", [(1 << 18, 1 << 16, 1 << 20), (40, 16, 16)])
def test_found_is_what_the_patterns_match(monkeypatch, piece, window, compared):
    for name, value in (("PIECE_CHARS", piece), ("WINDOW", window), ("COMPARED", compared)):
        monkeypatch.setattr(RI, name, value)
    rnd = random.Random(5)
    patterns = some_patterns(rnd, 150)
    texts = some_texts(rnd, 300, patterns)
    index = literals(patterns)
    got = {}
    for a, b in RI._pieces([len(t or "") for t in texts]):
        text, rule, sure = index.found(texts[a:b])
        pairs = list(zip((text + a).tolist(), rule.tolist()))
        assert pairs == sorted(set(pairs))
        got.update(zip(pairs, sure.tolist()))
    compiled = [re.compile(p, re.ASCII) for p in patterns]
    want = {(k, r) for k, t in enumerate(texts) for r, c in enumerate(compiled) if t is not None and c.search(t)}
    assert len(want) > 300 and want <= set(got)
    assert {x for x, sure in got.items() if sure} <= want
    assert sum(got.values()) > 0.8 * len(got)  # the others have letters of both cases in one run


def test_matches_are_those_of_spark(spark):
    rnd = random.Random(6)
    patterns = some_patterns(rnd, 150)
    rules = [R.Rule(f"label{k}", p, 0, 0.5, ("a", "o") if k % 5 == 0 else ()) for k, p in enumerate(patterns)]
    assert len(rules) > D.RULES_PER_COLUMN
    texts = spark.createDataFrame(list(enumerate(some_texts(rnd, 200, patterns))), "doc_id long, text string")
    table = D.rules_frame(spark, rules).repartition(3)
    plain = texts.crossJoin(table).where("rlike(text, pattern)").select("doc_id", "raw_label", "text", "hints").collect()
    want = sorted((r[0], r[1]) for r in plain if not r["hints"] or any(h in r["text"] for h in r["hints"]))
    got = sorted((r[0], r[1]) for r in D.rule_scan(texts, "doc_id", "text", table).select("item_id", "raw_type").collect())
    assert len(want) > 200 and got == want


def test_what_is_decided_goes_back_without_its_text():
    """Before, each text went back to Spark once for every rule that might match."""
    index = literals(["alpha beta|beta  alpha", "(?i)alpha[ ]+beta", "beta[a-z]+", "gamma"])
    texts = ["an alpha beta", "an ALPHA  Beta", "a beta alpha", "betas and alpha", "alphA betas, gammas", None]
    batch = pa.RecordBatch.from_pydict({"item_id": list("abcdef"), "text": texts})
    rows = [r for out in RI._candidates(SimpleNamespace(value=index))([batch]) for r in out.to_pylist()]
    sure = {r["item_id"]: r["rules"] for r in rows if r["text"] is None}
    run = {r["item_id"]: r["rules"] for r in rows if r["text"] is not None}
    assert sure == {"a": [10, 11], "b": [11], "e": [11, 13]}
    assert run == {k: [12] for k in "abcde"} and all(r["text"] in (None, texts["abcdef".index(r["item_id"])]) for r in rows)


def test_hinted_rules_run_in_spark():
    index = literals(["alpha beta"], hinted=True)
    assert [x.tolist() for x in index.found(["alpha beta", "alpha  beta"])] == [[0, 1], [0, 0], [False, False]]


def test_many_literals_of_one_beginning():
    patterns = [f"the same beginning {k:04d}" for k in range(3000)]
    index = literals(patterns)
    assert len(set(index.anchor.tolist())) > 2000  # told apart by the rarest part, as far as squeezed literals differ
    text, rule, sure = index.found(["the same beginning " * 50 + "2999", "the same beginning 00122", "none"])
    assert (text.tolist(), [patterns[r][-4:] for r in rule], sure.tolist()) == ([0, 1], ["2999", "0012"], [True, True])


def test_blocks_count_what_is_looked_up(spark, monkeypatch):
    """Before, every copy of a rule counted, and so many more passes read the texts."""
    seen = []
    monkeypatch.setattr(RI, "_candidates", lambda ref, f=RI._candidates: seen.append(len(ref.value)) or f(ref))
    monkeypatch.setattr(RI, "BLOCK_RULES", 50)
    rules = [R.Rule(f"label{k % 3}", f"alpha{chr(97 + k % 20)}", 0, 0.5, ()) for k in range(120)]
    texts = spark.createDataFrame([(0, "an alphab"), (1, "alpha"), (2, None)], "doc_id long, text string")
    assert D.rule_scan(texts, "doc_id", "text", D.rules_frame(spark, rules)).count() == 6
    assert seen == [20]
