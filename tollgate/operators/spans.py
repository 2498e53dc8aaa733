"""Findings with places, overlaps resolved once, and exact redaction.

Spark's built-ins return matches without their offsets.  A text split at a
rule's matches gives the offsets back: they are running sums of the lengths of
the pieces.  Everything stays on the row (no shuffle, no Python) and places are
code points from 0, the end exclusive.

Running sums of an array are taken in blocks of ``BLOCK`` elements, and pieces
of a text are cut out of chunks of ``CHUNK`` code points, so that a text with
very many findings does not cost their square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from .detect import FINDING_TYPE, guard_pattern, luhn_ok, rule_hint

BLOCK, CHUNK = 64, 4096
PLACED_TYPE = T.StructType(FINDING_TYPE.fields + [T.StructField("span_start", T.IntegerType()), T.StructField("span_end", T.IntegerType())])
#: What a span of another kind is replaced by.
OTHER_TOKEN = "[SECRET]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row.  What a lambda
    takes from outside is otherwise evaluated for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _div(x: Column, by: int) -> Column:
    return F.floor(x / F.lit(by)).cast("int")


def ahead(values: Column, combine: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each element of an array, ``combine`` over all elements before it."""
    def fold(part: Column) -> Column:
        return F.aggregate(part, zero, combine)

    def in_blocks(v: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), _div(F.size(v), BLOCK)), lambda b: fold(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
        carried = let(sums, lambda s: F.transform(s, lambda x, b: fold(F.slice(s, F.lit(1), b))))
        return let(carried, lambda c: F.transform(v, lambda x, i: combine(F.get(c, _div(i, BLOCK)), fold(F.slice(v, i - i % BLOCK + 1, i % BLOCK)))))
    return let(values, in_blocks)


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _starts_at_guards(text: Column, pattern: str, found: Column) -> Column:
    """A guarded rule matches between two characters, so each match begins a
    piece; only a match at the very start makes no piece before it."""
    lengths = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    return let(ahead(lengths, _plus, F.lit(0)), lambda a: F.slice(a, F.size(a) - F.size(found) + 1, F.size(found)))


def _starts_of_matches(text: Column, rule: R.Rule, found: Column) -> Column:
    """Matches and pieces take turns.  A capture group is the end of its match."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))

    def at(v: Column) -> Column:
        both = F.zip_with(v["pieces"], v["whole"], lambda p, w: F.length(p) + F.coalesce(F.length(w), F.lit(0)))
        return let(ahead(both, _plus, F.lit(0)), lambda a: F.transform(
            v["whole"], lambda w, i: F.get(a, i) + F.length(F.get(v["pieces"], i)) + F.length(w) - F.length(F.get(found, i))))
    return let(F.struct(F.split(text, rule.pattern, -1).alias("pieces"), whole.alias("whole")), at)


def placed_rule(text: Column, rule: R.Rule) -> Column:
    """The findings of :func:`tollgate.operators.detect.rule_findings`, with
    ``span_start`` and ``span_end``."""
    pattern, group = (guard_pattern(rule.guard), 1) if rule.guard else (rule.pattern, rule.group)

    def place(found: Column) -> Column:
        starts = _starts_at_guards(text, pattern, found) if rule.guard else _starts_of_matches(text, rule, found)
        at = F.zip_with(found, starts, lambda m, s: F.struct(m.alias("m"), s.alias("s")))
        if rule.raw_label == "credit_card":
            at = F.filter(at, lambda x: luhn_ok(x["m"]))
        return F.transform(at, lambda x, i: F.struct(
            F.lit(rule.raw_label).alias("raw_type"), F.lit(float(rule.confidence)).alias("confidence"), (i + 1).alias("ord"),
            F.sha2(x["m"], 256).alias("match_hash"), x["s"].alias("span_start"), (x["s"] + F.length(x["m"])).alias("span_end")))
    # Texts without a match are not taken apart.
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    out = let(found, lambda f: F.when(F.size(f) > 0, place(f)))
    hint = rule_hint(text, rule)
    return F.coalesce(out if hint is None else F.when(hint, out), F.array().cast(T.ArrayType(PLACED_TYPE)))


def placed(text: Column, families: Iterable[str] = ("pii", "secrets")) -> Column:
    """``array<finding with its place>`` from every rule of the families."""
    return F.concat(*[placed_rule(text, r) for fam in families for r in R.RULE_FAMILIES[fam]])


def resolved(found: Column) -> Column:
    """Disjoint spans ``(span_start, span_end, raw_type)`` in text order.

    Findings that overlap are one span from the first start to the last end,
    named by the finding that starts first (of several the longest, then the
    most confident, then the first label).  Neighbours stay apart."""
    keyed = F.array_sort(F.transform(found, lambda f: F.struct(
        f["span_start"].alias("a"), (-f["span_end"]).alias("back"), (-f["confidence"]).alias("doubt"), f["raw_type"].alias("kind"))))

    def merge(v: Column) -> Column:
        ends = F.transform(v, lambda f: -f["back"])
        with_reach = let(ahead(ends, lambda x, y: F.greatest(x, y), F.lit(0)), lambda r: F.transform(
            v, lambda f, i: F.struct(f["a"].alias("a"), f["kind"].alias("kind"), F.get(r, i).alias("reach"))))
        heads = F.filter(with_reach, lambda f: f["a"] >= f["reach"])
        return let(F.struct(heads.alias("h"), F.array_max(ends).alias("last")), lambda s: F.transform(s["h"], lambda f, i: F.struct(
            f["a"].alias("span_start"), F.coalesce(F.get(s["h"], i + 1)["reach"], s["last"]).alias("span_end"), f["kind"].alias("raw_type"))))
    return let(keyed, merge)


def replaced(text: Column, spans: Column, tokens: Mapping[str, str] = R.REDACT_TOKENS, other: str = OTHER_TOKEN) -> Column:
    """``text`` with each of its disjoint spans replaced by its kind's token."""
    def token(kind: Column) -> Column:
        out = F.lit(other)
        for k, v in tokens.items():
            out = F.when(kind == k, F.lit(v)).otherwise(out)
        return out

    def render(v: Column) -> Column:
        def cut(a: Column, b: Column) -> Column:
            near = F.array_join(F.slice(v["chunks"], _div(a, CHUNK) + 1, _div(b, CHUNK) - _div(a, CHUNK) + 1), "")
            return F.substring(near, a % CHUNK + 1, b - a)

        def end(i: Column) -> Column:
            return F.coalesce(F.get(v["spans"], i)["span_end"], F.lit(0))
        parts = F.transform(v["spans"], lambda s, i: F.concat(cut(end(i - 1), s["span_start"]), token(s["raw_type"])))
        return F.concat(F.array_join(parts, ""), cut(end(F.size(v["spans"]) - 1), v["chars"]))
    chunks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))
    return let(spans, lambda s: F.when(F.size(s) > 0, let(
        F.struct(chunks.alias("chunks"), s.alias("spans"), F.length(text).alias("chars")), render)).otherwise(text))


def located(df: DataFrame, text: str, families: Iterable[str], id_col: str) -> DataFrame:
    """Finding rows with their places: the finding contract, ``span_start``
    and ``span_end``."""
    rows = df.select(F.col(id_col).alias("item_id"), F.inline_outer(placed(F.col(text), families)))
    return rows.where(F.col("raw_type").isNotNull())


def redact_findings(df: DataFrame, text: str = "text", families: Iterable[str] = ("pii", "secrets"), out: str = "redacted") -> DataFrame:
    """Replace exactly what the families' detectors find: cards that pass the
    Luhn check, kinds that overlap once.  A NULL text stays NULL."""
    return df.withColumn(out, replaced(F.col(text), resolved(placed(F.col(text), families))))
