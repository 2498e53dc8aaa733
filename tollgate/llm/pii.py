"""Personal data: base expressions as seeds, then bootstrapped context patterns.

1. One scan finds the base entities (e-mail, ip, card, phone) of every text
   and, as candidates, other tokens that look like identifiers (an ``@`` or at
   least ``MIN_DIGITS`` digits), each with its lexical contexts: the two words
   before it, and the words on both sides.  Tokens are the blank-free runs, of
   any length, and the pieces of a run between the delimiters of each of
   ``LEVELS``, so identifiers in minified JSON, markup, query strings or text
   without blanks are candidates beside the run that holds them.  Words end at
   blanks, delimiters and other tokens; a character of a script written without
   blanks is a word.
2. Contexts and instances form a graph.  Until the accepted patterns and their
   confidences (to ``DIGITS`` places) stop changing, Spark scores every pattern for every kind, conf = sum of its instances' scores / (instances +
   ``SMOOTHING``), counting distinct instances, and then every unknown
   instance, score = 1 - product of (1 - conf) over its accepted patterns.
   Seeds keep score 1.  A pattern is accepted for a kind at ``MIN_CONFIDENCE``
   and a support of ``MIN_SUPPORT`` distinct instances.
   Scores never fall from one round to the next, so the rounds end.
3. Occurrences of unknown instances inside an accepted pattern whose score
   reaches ``MIN_CONFIDENCE`` are added as spans of that kind; of tokens inside
   each other only the outermost.

Instances and words of more than ``LONG`` code points are known by a 128-bit
hash, so a text that is one long run costs no more than its own length.

Scores are partial aggregates and equi-joins on pattern or instance; a pattern
that holds a third of all rows costs one row per task and is split by adaptive
execution in the join.  Base spans are never changed.

The base expressions run in linear time: an e-mail is built around its ``@``,
the others start at digit runs only.

Defined cases: a NULL or empty text has no spans; matches of one kind never
overlap; a match that fails its check is dropped without a retry; repeated
rows are reported each (and count as one instance); other columns are carried
in ``row``.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tollgate.llm.common import python_tasks, read_table, staged

KINDS = ("email", "ip", "card", "phone")
MIN_DIGITS, LONG = 4, 64
MIN_CONFIDENCE, MIN_SUPPORT, SMOOTHING, DIGITS = 0.8, 5, 1.0, 6
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9]+|@")
_DIGIT = re.compile(r"[0-9]")
_EDGE = ".,;:!?()[]{}<>\"'"
_QUOTED = r"\s\"`\[\]{}<>=&,;|"
_APOSTROPHE = r"(?<=[^\W\d_])'(?=[^\W\d_])"  # inside a word, no delimiter
#: Tokens inside a run, each level with more delimiters: quotes, brackets and
#: separators; then colons and characters beyond ASCII; then parentheses and those of URLs.
LEVELS = (re.compile(rf"(?:[^'{_QUOTED}]|{_APOSTROPHE})+"),
          re.compile(rf"(?:(?![^\x00-\x7f])[^':{_QUOTED}]|{_APOSTROPHE})+"),
          re.compile(rf"(?:(?![^\x00-\x7f])[^':()/?#{_QUOTED}]|{_APOSTROPHE})+"))
#: South-east Asian scripts, kana and ideographs.
_NO_BLANKS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_STOPS = rf"':()/?#\u3000-\u303f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65{_QUOTED}"
_WORDS = re.compile(rf"[{_NO_BLANKS}]|(?:[^{_STOPS}{_NO_BLANKS}]|{_APOSTROPHE})+")
_RUN = re.compile(r"\S*")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    reached, at = 0, text.find("@")
    while at >= 0:
        before = text[reached:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if local else None
        if m:
            yield at - local, m.end()
        reached = m.end() if m else at + 1
        at = text.find("@", reached)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points."""
    if not text:
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    if "." in text:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


def _name(s: str) -> str:
    """What stands for an instance or word: itself, or its hash if it is long."""
    s = s.lower()
    return s if len(s) <= LONG else "\0" + blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _words(text: str, edges: list[int]) -> tuple[array, array]:
    """Starts and ends of the words of a text, cut at the edges too."""
    starts, ends, k = array("q"), array("q"), 0
    for m in _WORDS.finditer(text):
        a, b = m.span()
        while k < len(edges) and edges[k] <= a:
            k += 1
        while a < b:
            cut = edges[k] if k < len(edges) and edges[k] < b else b
            token = text[a:cut]
            word = token.strip(_EDGE)
            if word:
                a += len(token) - len(token.lstrip(_EDGE))
                starts.append(a)
                ends.append(a + len(word))
            a = cut
            k += cut < b
    return starts, ends


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the tokens that look like identifiers and meet no base span."""
    taken: list[list[int]] = []  # the base spans, those that overlap as one
    for a, b in sorted((a, b) for _, a, b in spans):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    reaches = [b for _, b in taken]
    out, reached = [], 0
    for m in _HINT.finditer(text):
        if m.start() < reached:
            continue
        left = text[reached: m.start()]
        a = m.start() - (len(left.rsplit(None, 1)[-1]) if left and not left[-1].isspace() else 0)
        reached = _RUN.match(text, m.end()).end()
        found = {(a, reached)}
        for level in LEVELS:
            found.update(p.span() for p in level.finditer(text, a, reached))
        tokens = set()
        for a, b in found:
            token = text[a:b]
            if "@" in token or len(_DIGIT.findall(token)) >= MIN_DIGITS:
                a += len(token) - len(token.lstrip(_EDGE))
                b = a + len(token.strip(_EDGE))
                k = bisect_left(reaches, a + 1)
                if k == len(taken) or taken[k][0] >= b:
                    tokens.add((a, b))
        out += sorted(tokens)
    return out


def occurrences(text: str | None, spans: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and candidates with their lexical patterns, in which the blank
    stands for the occurrence; kind -1 is unknown."""
    if not text:
        return []
    found = [*spans, *((-1, a, b) for a, b in candidates(text, spans))]
    if not found:
        return []
    starts, ends = _words(text, sorted({x for _, a, b in found for x in (a, b)}))

    def word(k: int) -> str:
        return _name(text[starts[k]: ends[k]])
    out = []
    for kind, a, b in found:
        first, nxt = bisect_left(starts, a), bisect_left(starts, b)
        patterns = []
        if first >= 2:
            patterns.append(f"{word(first - 2)} {word(first - 1)} _")
        if first and nxt < len(starts):
            patterns.append(f"{word(first - 1)} _ {word(nxt)}")
        out.append({"kind": kind, "start": a, "end": b, "instance": _name(text[a:b]), "patterns": patterns})
    return out


_FOUND = pa.struct([
    ("base", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))),
    ("seen", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])))])


def _finder():
    @arrow_udf("struct<base: array<struct<kind: int, start: int, end: int>>, "
               "seen: array<struct<kind: int, start: int, end: int, instance: string, patterns: array<string>>>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = []
            for t in column.to_pylist():
                spans = base_spans(t)
                rows.append({"base": [{"kind": k, "start": a, "end": b} for k, a, b in spans], "seen": occurrences(t, spans)})
            yield pa.array(rows, _FOUND)
    return find


def _score(k: int) -> str:
    return f"s{k}"


def accepted_patterns(seen: DataFrame, min_confidence: float = MIN_CONFIDENCE,
                      min_support: int = MIN_SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Score the pattern-instance graph until it stands: (patterns: pattern and
    one confidence per kind, NULL if not accepted; instances: instance and one
    score per kind).

    ``seen``: instance, kind, pattern (one row per occurrence and pattern)."""
    kinds = range(len(KINDS))
    edges = seen.groupBy("pattern", "instance").agg(*[F.max((F.col("kind") == k).cast("double")).alias(f"seed{k}") for k in kinds])
    edges = staged(edges, "graph")
    scored = edges.select("pattern", "instance", *[F.col(f"seed{k}").alias(_score(k)) for k in kinds])
    # What the accepted table comes to: its entries, and their sum in whole units of the last place.
    sums = [x for k in kinds for x in (F.count(f"c{k}"), F.coalesce(F.sum(F.round(F.col(f"c{k}") * 10**DIGITS).cast("bigint")), F.lit(0)))]
    before = (0,) * len(sums)
    while True:
        confidence = [(F.sum(_score(k)) / (F.count(F.lit(1)) + F.lit(SMOOTHING))) for k in kinds]
        support = [F.count(F.when(F.col(_score(k)) >= min_confidence, 1)) for k in kinds]
        patterns = scored.groupBy("pattern").agg(*[F.when((confidence[k] >= min_confidence) & (support[k] >= min_support), confidence[k]).alias(f"c{k}") for k in kinds])
        patterns = staged(patterns.where(F.coalesce(*[F.col(f"c{k}") for k in kinds]).isNotNull()), "patterns")
        now = tuple(patterns.agg(*sums).first())
        met = edges.join(patterns, "pattern")
        instances = met.groupBy("instance").agg(*[
            F.greatest(F.max(f"seed{k}"), 1 - F.exp(F.sum(F.log(F.lit(1.0) - F.least(F.coalesce(f"c{k}", F.lit(0.0)), F.lit(0.999999)))))).alias(_score(k)) for k in kinds])
        instances = staged(instances, "instances")
        if now == before:
            return patterns, instances
        before = now
        scores = instances.withColumnsRenamed({_score(k): f"n{k}" for k in kinds})
        scored = edges.join(scores, "instance", "left").select(
            "pattern", "instance", *[F.greatest(f"seed{k}", F.coalesce(f"n{k}", F.lit(0.0))).alias(_score(k)) for k in kinds])


def personal_data(docs: DataFrame, carry: list[str] | None = None, min_confidence: float = MIN_CONFIDENCE, **options) -> DataFrame:
    """``row`` (the columns in ``carry``, or all), ``base`` and ``added`` spans
    (kind, start, end; kind indexes ``KINDS``)."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in carry or docs.columns]).alias("row"), _finder()(docs["text"]).alias("f"))
    table = staged(rows.select(F.monotonically_increasing_id().alias("uid"), "row", "f.base", "f.seen"), "occurrences")
    seen = table.select("uid", F.explode("seen").alias("o")).select("uid", "o.kind", "o.start", "o.end", "o.instance", F.explode("o.patterns").alias("pattern"))
    patterns, instances = accepted_patterns(seen.select("pattern", "instance", "kind"), min_confidence=min_confidence, **options)
    hits = seen.where("kind < 0").join(patterns, "pattern").join(instances, "instance")
    best = None
    for k in range(len(KINDS)):
        ok = F.col(f"c{k}").isNotNull() & (F.col(_score(k)) >= min_confidence)
        best = F.when(ok, F.lit(k)) if best is None else best.when(ok, F.lit(k))
    spans = hits.select("uid", F.struct(best.alias("kind"), "start", "end").alias("s")).where("s.kind is not null")
    added = spans.groupBy("uid", "s.start", "s.end").agg(F.min("s.kind").alias("kind"))
    outside = Window.partitionBy("uid").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    added = added.withColumn("reached", F.max("end").over(outside)).where(F.coalesce(F.col("end") > F.col("reached"), F.lit(True))).drop("reached")
    added = added.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    none = F.expr("cast(array() as array<struct<kind: int, start: int, end: int>>)")
    return table.select("uid", "row", "base").join(added, "uid", "left").select("row", "base", F.coalesce("added", none).alias("added"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    names = F.array(*map(F.lit, KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    def count(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return out.select(F.col("row.doc_id").alias("doc_id"), *map(count, range(len(KINDS))), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      joined(F.array_sort(F.concat("base", "added"))).alias("spans"))
