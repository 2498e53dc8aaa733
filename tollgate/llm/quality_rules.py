"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Base counts of each whole text come from one row's arrays: words, code points
in words, symbols, repeated lines, and words inside three-word windows that
occur twice or more.  Four ratios of them are candidates for rules.

Thresholds.  The rules share one ladder of LEVELS levels, from the loosest
cutoffs to the strictest; a document's level is the first at which some rule
rejects it, so what a level rejects holds all that the looser ones reject.  On
labelled holdouts (label rows of good quality whose document passes the base
rule), the null hypothesis "this level rejects more than ALPHA of the good
documents" is tested in every stratum, loosest level first, until one is not
rejected; it is rejected if the exact binomial tail P(Bin(n, ALPHA) <= k) is at
most the stratum's share of DELTA, with k of the n good documents at or below
the level.  Such a fixed order needs no correction over levels, and one verdict
of all rules together none over rules.  Over strata DELTA is dealt out in
proportion to n (weighted Bonferroni: the weights depend on the number of
labels alone, never on what the documents measure).  The last level certified
is used; a stratum without one rejects nothing beyond the base rule.  With
probability 1 - DELTA, in every stratum at most ALPHA of the good documents
that pass the base rule are rejected.  As k grows with the level, so does the
tail: the last level certified is the last whose tail is small enough.

The tail is summed from k downward over about ten standard deviations, in
logarithms; what lies below is bounded by a geometric series and added, so the
test stays valid and its work grows with the root of the count.

Strata are the languages of the data, NULL one of them.  The table of thresholds
has a row for each language that certifies; it is joined without a hint, so
Spark broadcasts it where its files are small and shuffles where they are not.

Defined cases: a NULL, empty or blank text has zero words, fails the base rule
and is not kept; a document with several label rows is good if one of them says
1; labels of unknown documents and NULL labels are ignored; an empty label table
certifies nothing; repeated rows are judged each and counted once in the
holdout; a ratio equal to a cutoff is not above it; a text of any length is one
row's arrays (about 60 bytes a word while its windows are sorted); extra columns
pass through in ``row``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import pack, read_table, staged, trimmed_words

ALPHA, DELTA, LEVELS = 0.02, 0.05, 40
#: Rule name -> (ratio, cutoffs of the levels); a document is rejected by a ratio above the cutoff.
GRIDS = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", tuple(round(0.005 * k, 3) for k in range(LEVELS, 0, -1))),
    "repeated_words": ("n_repeat_words / greatest(n_words, 1)", tuple(round(0.0125 * k, 4) for k in range(LEVELS, 0, -1))),
    "repeated_lines": ("n_dup_lines / greatest(n_words, 1)", tuple(round(0.0025 * k, 4) for k in range(LEVELS, 0, -1))),
    "word_length": ("word_chars / greatest(n_words, 1)", tuple(round(4.0 + 0.2 * k, 1) for k in range(LEVELS, 0, -1))),
}


def repeated_window_words(words: Column) -> Column:
    """Words inside three-word windows found at least twice in the array.

    Every word is hashed once and a window combines three hashes.  Where all
    windows differ there is nothing to place.  Else windows are sorted by hash
    with their places; runs of equal hashes give the places, and consecutive
    places give the words covered (3, or the distance to the next place if that
    is less).  64-bit hashes stand for windows."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, F.lit(1), F.size(h) - 2), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    def doubled(sorted_windows: Column) -> Column:
        hit = F.filter(sorted_windows, lambda w, k: (F.get(sorted_windows, k - 1)["h"] == w["h"]) | (F.get(sorted_windows, k + 1)["h"] == w["h"]))
        return F.sort_array(F.transform(hit, lambda w: w["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
                           lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(i - s["last"], F.lit(3))).alias("n")), lambda s: s["n"])

    def placed(win: Column) -> Column:
        keyed = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.transform(F.array(keyed), lambda s: F.transform(F.array(doubled(s)), lambda at: covered(at))[0])[0]

    none = F.lit(0).cast("long")
    # Each array is bound once by a one-element transform.
    out = F.transform(F.array(hashes), lambda h: F.transform(F.array(windows(h)), lambda win: (
        F.when(F.size(F.array_distinct(win)) == F.size(win), none).otherwise(placed(win))))[0])[0]
    return F.when(F.size(words) < 4, none).otherwise(out)


def base_counts(text: Column) -> dict[str, Column]:
    """Columns to compute from the text itself (``words`` first)."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\x0c\r")) != "")
    return {
        "words": trimmed_words(text),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]", ""))).cast("long"),
        "n_dup_lines": F.transform(F.array(lines), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))[0],
    }


def measured(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row``, stratum, the base counts and base_failed of every document."""
    base = pack(docs).withColumns(base_counts(F.col("row.text")))
    rows = F.struct(*[F.col(f"row.{c}").alias(c) for c in carry]).alias("row") if carry is not None else F.col("row")
    out = base.select(
        rows, F.col("row.lang").alias("stratum"),
        F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols", "n_dup_lines", repeated_window_words(F.col("words")).alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def log_gamma(x: Column) -> Column:
    """Stirling's series after shifting the argument by eight."""
    y = x + 8
    product = reduce(lambda a, b: a * b, [x + k for k in range(8)])
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    return (y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727) + series - F.log(product)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Upper bound, tight to rounding, of P(Bin(n, p) <= k) for k <= n * p; else 1."""
    k, n = k.cast("double"), n.cast("double")
    log_top = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    terms = F.least(k, F.ceil(10 * F.sqrt(n * p * (1 - p)) + 50)).cast("int")
    odds = (1 - p) / p
    # Terms relative to the top one: t(i - 1) = t(i) * i / (n - i + 1) * odds.
    state = F.aggregate(
        F.sequence(F.lit(0), F.greatest(terms, F.lit(1)) - 1), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda a, j: F.transform(F.array(a["t"] * (k - j) / (n - (k - j) + 1) * odds), lambda t: F.struct(t.alias("t"), (a["s"] + t).alias("s")))[0])
    ratio = (k - terms) / (n - (k - terms) + 1) * odds
    rest = F.when(terms < k, state["t"] * ratio / (1 - ratio)).otherwise(F.lit(0.0))
    return F.when(k <= n * p, F.exp(log_top) * (state["s"] + rest)).otherwise(F.lit(1.0))


def levels(grids: dict = GRIDS) -> dict[str, Column]:
    """Rule -> the first level whose cutoff the document's ratio is above; LEVELS + 1: none."""
    def first(ratio: str, cutoffs: tuple) -> Column:
        at_most = F.lit(0)
        for c in cutoffs:
            at_most = at_most + (F.expr(ratio) <= F.lit(float(c))).cast("int")
        return at_most + 1
    return {rule: first(*grid) for rule, grid in grids.items()}


def certified_levels(good: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, certified): the strictest level certified, for strata that have one.

    ``good``: stratum and level of the holdout documents of good quality that
    pass the base rule.  Counts are partial aggregates; a table of one row for
    each stratum is left."""
    at = [F.count(F.when(F.col("level") <= t, 1)).alias(f"k_{t}") for t in range(1, LEVELS + 1)]
    table = staged(good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *at), "holdout")
    total = table.agg(F.sum("n")).scalar()
    rungs = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col(f"k_{t}").alias("k")) for t in range(1, LEVELS + 1)]))
    tested = table.select("stratum", "n", rungs.alias("c")).select("stratum", "n", "c.*")
    passed = binomial_tail(F.col("k"), F.col("n"), alpha) <= F.lit(delta) * F.col("n") / total
    return tested.where(passed).groupBy("stratum").agg(F.max("t").alias("certified"))


def judged(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Measured documents with ``certified`` (their stratum's level, NULL: none),
    ``rejected_by`` (names of the rules) and ``kept``.

    The counts are worked out once and written to the shared folder; the
    holdout and the verdict read them there."""
    table = staged(measured(docs, carry).withColumns({f"level_{r}": c for r, c in levels().items()}), "measured")
    good = labels.where(labels["quality"] == 1).select(labels["doc_id"].alias("good_id")).distinct()
    holdout = (table.where(~F.col("base_failed"))
               .select(F.col("row.doc_id").alias("good_id"), "stratum", F.least(*[f"level_{r}" for r in GRIDS]).alias("level"))
               .join(good, "good_id").distinct())
    certified = staged(certified_levels(holdout, alpha, delta).withColumnRenamed("stratum", "s"), "certified")
    out = table.join(certified, table["stratum"].eqNullSafe(certified["s"]), "left").drop("s")
    hits = [F.when(F.col(f"level_{rule}") <= F.col("certified"), F.lit(rule)) for rule in GRIDS]
    return (out.withColumn("rejected_by", F.array_compact(F.array(*hits)))
            .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
            .drop(*[f"level_{r}" for r in GRIDS]))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = judged(docs, read_table(spark, sf_dir, "labels"), carry=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.array_join("rejected_by", ",").alias("rejected_by"))


def _oracle_sql() -> str:
    ratio = {r: f"CAST({e.split(' / ')[0]} AS DOUBLE) / {e.split(' / ')[1]}" for r, (e, _) in GRIDS.items()}
    level = ", ".join(f"len(list_filter([{', '.join(f'{float(c)}::DOUBLE' for c in cs)}], lambda c: {ratio[r]} <= c)) + 1 AS level_{r}" for r, (_, cs) in GRIDS.items())
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, lang AS stratum,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM d, unnest(range(1, len(w) - 1)) AS t(i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM dup, unnest([0, 1, 2]) AS t(o) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dl AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
b AS (
  SELECT d.doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dl.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN dl ON d.doc_id = dl.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {level} FROM b),
g AS (SELECT DISTINCT f.doc_id, stratum, least({', '.join(f'level_{r}' for r in GRIDS)}) AS level
  FROM f JOIN labels l ON f.doc_id = l.doc_id WHERE l.quality = 1 AND NOT base_failed),
k AS (SELECT stratum, t, count(*) AS n, count(CASE WHEN level <= t THEN 1 END) AS k FROM g, unnest(range(1, {LEVELS + 1})) AS r(t) GROUP BY stratum, t),
tail AS (SELECT *, CASE WHEN k > n * {ALPHA} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA}) + (n - i) * ln({1 - ALPHA})))) END AS p FROM k),
cut AS (SELECT stratum, max(t) AS certified FROM tail WHERE p <= {DELTA} * n / (SELECT count(*) FROM g) GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND least({', '.join(f'level_{r}' for r in GRIDS)}) > coalesce(certified, 0) AS kept,
  array_to_string(list_filter([{', '.join(f"CASE WHEN level_{r} <= certified THEN '{r}' END" for r in GRIDS)}], lambda x: x IS NOT NULL), ',') AS rejected_by
FROM f LEFT JOIN cut ON f.stratum IS NOT DISTINCT FROM cut.stratum
"""


ORACLE_SQL = _oracle_sql()
