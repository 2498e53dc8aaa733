"""Detectors as Catalyst expressions, verdict assembly, redaction, coverage.

Every detector turns a text column into an ``array<finding>`` on the same
row (``finding = struct<raw_type, confidence, ord, match_hash>``): detection
is narrow (no shuffle), runs inside whole-stage codegen, and reads each text
once per rule.  Findings carry a SHA-256 of the match and its ordinal, never
the matched text itself.  ``*_rows`` helpers flatten findings into rows for
reporting.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..functions import rules as R
from ..session import scratch_path, ship_package
from .rule_index import indexed_matches, with_literals

FINDING_TYPE = T.StructType([
    T.StructField("raw_type", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("ord", T.IntegerType()),
    T.StructField("match_hash", T.StringType()),
])
FINDINGS_TYPE = T.ArrayType(FINDING_TYPE)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty() -> Column:
    return F.array().cast(FINDINGS_TYPE)


def _finding(label: str | Column, conf: float | Column, ord_: Column | int,
             match: Column | None) -> Column:
    return F.struct(
        (F.lit(label) if isinstance(label, str) else label).alias("raw_type"),
        (F.lit(conf) if not isinstance(conf, Column) else conf).cast("double").alias("confidence"),
        (F.lit(ord_) if isinstance(ord_, int) else ord_).cast("int").alias("ord"),
        (F.sha2(match, 256) if match is not None else F.lit(None).cast("string")).alias("match_hash"))


def luhn_ok(candidate: Column) -> Column:
    """Luhn checksum on the digits of ``candidate``."""
    digits = F.split(F.reverse(F.regexp_replace(candidate, "[^0-9]", "")), "")

    def term(c: Column, i: Column) -> Column:
        x = c.cast("int") * (1 + i % 2)
        return F.when(x > 9, x - 9).otherwise(x)

    # The digits are split once; an empty trailing piece counts nothing.
    terms = F.transform(F.filter(digits, lambda c: c != ""), term)
    return F.aggregate(terms, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def guard_pattern(guard: R.Guard) -> str:
    """Java pattern whose group 1 is each guarded match.  The body stands in a
    lookahead, so matches may overlap; the lookbehind lets a run of body
    characters start once only, which keeps the scan linear."""
    behind = f"(?<![{guard.before}])" if guard.before else ""
    ahead = f"(?![{guard.after}])" if guard.after else ""
    # The run before an @ is never given back: nothing shorter could match.
    body = guard.body.replace("]+@", "]++@")
    return f"{behind}(?=({body}){ahead})"


def rule_hint(text: Column, rule: R.Rule) -> Column | None:
    """Cheap necessary condition for ``rule`` (``None`` when it has none)."""
    conds = [text.contains(h) for h in rule.hints]
    if rule.ci_hints:
        low = F.lower(text)  # one common subexpression across the rules of a projection
        conds += [low.contains(h) for h in rule.ci_hints]
    if rule.hint_re:
        conds.append(text.rlike(rule.hint_re))
    if not conds:
        return None
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def rule_findings(text: Column, rule: R.Rule) -> Column:
    """All matches of one rule, in text order, as findings.  The full
    pattern only runs on rows that pass the rule's hint."""
    pattern, group = (guard_pattern(rule.guard), 1) if rule.guard else (rule.pattern, rule.group)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    if rule.raw_label == "credit_card":
        matches = F.filter(matches, luhn_ok)
    found = F.transform(matches, lambda m, i: _finding(rule.raw_label, rule.confidence, i + 1, m))
    hint = rule_hint(text, rule)
    if hint is not None:
        found = F.when(hint, found)
    return F.coalesce(found, _empty())


def findings(text: Column, families: Iterable[str] = ("pii", "secrets")) -> Column:
    """``array<finding>`` from every rule of the given families."""
    parts = [rule_findings(text, r) for fam in families for r in R.RULE_FAMILIES[fam]]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _flatten(df: DataFrame, id_expr: Column, arr: Column) -> DataFrame:
    """``inline`` an array of structs into rows, one per element.

    ``inline_outer`` plus a filter on the generated column, rather than
    ``inline``: for an inner generator Catalyst infers ``size(arr) > 0`` and
    pushes it below the projection (and below a repartition) into the scan,
    evaluating every detector twice.  The filter on a generated column
    cannot move below the generator.
    """
    return (df.select(id_expr.alias("item_id"), F.inline_outer(arr))
            .where(F.col("raw_type").isNotNull()))


def finding_rows(df: DataFrame, id_col: str, findings_col: str = "findings") -> DataFrame:
    """Flatten ``findings`` into ``(item_id, raw_type, confidence, ord, match_hash)``."""
    return _flatten(df, F.col(id_col), F.col(findings_col))


def detect(df: DataFrame, text: str, families: Iterable[str], id_col: str) -> DataFrame:
    """Finding rows for pattern families (``pii``, ``secrets``, ``prompt``, ``code``)."""
    return finding_rows(df.select(id_col, findings(F.col(text), families).alias("findings")), id_col)


# ----------------------------------------------------------------------------
# SQL, paths, domains, labels
# ----------------------------------------------------------------------------
def _same_sides(pattern: str):
    return lambda m: F.regexp_extract(m, pattern, 2) == F.regexp_extract(m, pattern, 3)


def sql_findings(text: Column, allow_destructive: Column | None = None) -> Column:
    found = [F.when(text.rlike(r.pattern), _finding(r.raw_label, r.confidence, 1, None))
             for r in R.SQL_RULES]
    allow = F.coalesce(allow_destructive, F.lit(False)) if allow_destructive is not None else F.lit(False)
    d = R.DESTRUCTIVE_RULE
    found.append(F.when(text.rlike(d.pattern) & ~allow, _finding(d.raw_label, d.confidence, 1, None)))
    for r in R.TAUTOLOGY_RULES:
        hits = F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0))
        same = F.exists(hits, _same_sides(r.pattern))
        found.append(F.when(same, _finding(r.raw_label, r.confidence, 1, None)))
    return F.coalesce(F.array_compact(F.array(*found)), _empty())


def detect_sql(df: DataFrame, id_col: str = "stmt_id", text: str = "text",
               allow_destructive: str | None = "allow_destructive") -> DataFrame:
    allow = F.col(allow_destructive) if allow_destructive else None
    return finding_rows(df.select(id_col, sql_findings(F.col(text), allow).alias("findings")), id_col)


def path_findings(path: Column, content: Column | None = None) -> Column:
    base = F.lower(F.regexp_extract(path, r"([^/\\]*)$", 1))
    ext = F.regexp_extract(base, r"\.([a-z0-9]+)$", 1)
    found = [F.when(path.rlike(r.pattern), _finding(r.raw_label, r.confidence, 1, None))
             for r in R.PATH_RULES]
    found.append(F.when(base.isin(*R.SENSITIVE_FILES),
                        _finding("sensitive_file", R.SENSITIVE_FILE_CONFIDENCE, 1, None)))
    found.append(F.when(ext.isin(*R.SENSITIVE_EXTENSIONS),
                        _finding("sensitive_extension", R.SENSITIVE_EXTENSION_CONFIDENCE, 1, None)))
    out = F.coalesce(F.array_compact(F.array(*found)), _empty())
    if content is not None:
        out = F.concat(out, findings(F.nullif(content, F.lit("")), ("secrets", "pii")))
    return out


def detect_path(df: DataFrame, id_col: str = "file_id", path: str = "path",
                content: str | None = "content") -> DataFrame:
    cc = F.col(content) if content else None
    return finding_rows(df.select(id_col, path_findings(F.col(path), cc).alias("findings")), id_col)


def host_of(url: Column) -> Column:
    """Lower-case host; NULL for unparsable URLs (``try_parse_url`` never throws)."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def parent_domains(host: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]`` (bounded by the label count)."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))


def detect_domain(pages: DataFrame, id_col: str = "page_id", url: str = "url",
                  blocklist: DataFrame | None = None,
                  tlds: Sequence[str] = R.SUSPICIOUS_TLDS) -> DataFrame:
    """Pages whose host, or any parent domain of it, is blocked; and pages on
    suspicious TLDs.  Rows: the finding contract plus ``host`` and ``matched``;
    ``ord`` is the place of the matched part, counted from the whole host.

    The URL is parsed once and its parts leave one generator.  The built-in
    list is three names.  A caller's list may have any size: a Bloom filter of
    it (at most 8 MB) keeps parts that cannot be listed out of the join, and a
    part without a dot (``com``), which very many pages share, is no join key:
    of the top-level names that the pages have, the listed ones are one small
    array.  Entries that are NULL or empty block nothing; case does not count.
    """
    spark = pages.sparkSession
    hosts = pages.select(F.col(id_col).alias("item_id"), host_of(F.col(url)).alias("host"))
    parents = parent_domains(F.col("host"))
    tld = F.element_at(F.split(F.col("host"), r"\."), -1)
    parts = F.concat(F.transform(parents, lambda p: F.struct(F.lit("blocked_domain").alias("raw_type"), p.alias("matched"))),
                     F.array(F.struct(F.lit("suspicious_tld").alias("raw_type"), tld.alias("matched"))))
    rows = hosts.select("item_id", "host", F.posexplode(parts).alias("pos", "part")).select("item_id", "host", "pos", "part.*")
    domain = F.col("raw_type") == "blocked_domain"

    def found(hits: DataFrame) -> DataFrame:
        conf = F.when(domain, F.lit(R.BLOCKED_DOMAIN_CONFIDENCE)).otherwise(F.lit(R.SUSPICIOUS_TLD_CONFIDENCE))
        return hits.select("item_id", "host", "raw_type", conf.alias("confidence"), (F.col("pos") + 1).cast("int").alias("ord"),
                           F.sha2("matched", 256).alias("match_hash"), "matched")
    suspicious = ~domain & F.col("matched").isin(*tlds)
    if blocklist is None:
        bl = F.broadcast(spark.createDataFrame([(d,) for d in R.BLOCKED_DOMAINS], "domain string"))
        met = rows.join(bl, domain & (rows["matched"] == bl["domain"]), "left")
        return found(met.where(F.when(domain, F.col("domain").isNotNull()).otherwise(F.col("matched").isin(*tlds))))
    from ..plans.bloom import Bloom
    listed = blocklist.select(F.lower("domain").alias("domain")).where("domain <> ''").distinct()
    dotted = F.col("domain").contains(".")
    names = hosts.select(tld.alias("domain")).distinct().join(listed.where(~dotted), "domain", "left_semi")
    tops = names.agg(F.collect_set("domain")).scalar()
    long = listed.where(dotted)
    at_top = rows.where(suspicious | (domain & ~F.col("matched").contains(".") & F.array_contains(tops, F.col("matched"))))
    likely = rows.where(domain & F.col("matched").contains(".") & Bloom(long, "domain").may_hold(F.col("matched")))
    return found(at_top.unionByName(likely.join(long.withColumnRenamed("domain", "matched"), "matched", "left_semi").select(rows.columns)))


def label_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity findings from an existing label table (no classifier)."""
    toxic = labels.where(F.col("toxic") == 1).select("doc_id")
    return (toxic.join(documents.select("doc_id"), "doc_id", "left_semi")
            .select(F.col("doc_id").alias("item_id"), F.lit("toxicity").alias("raw_type"),
                    F.lit(1.0).alias("confidence"), F.lit(1).alias("ord"),
                    F.lit(None).cast("string").alias("match_hash")))


# ----------------------------------------------------------------------------
# user rule tables
# ----------------------------------------------------------------------------
def rules_frame(spark, rules: Iterable[R.Rule]) -> DataFrame:
    """Rule table ``(raw_label, pattern, confidence, hints, hint_re,
    ci_hints)``; the optional hint columns are necessary conditions used as
    prefilters."""
    return spark.createDataFrame(
        [(r.raw_label, r.pattern, float(r.confidence), list(r.hints) or None, r.hint_re,
          list(r.ci_hints) or None) for r in rules],
        "raw_label string, pattern string, confidence double, hints array<string>, hint_re string, "
        "ci_hints array<string>")


def _row_hint(text: Column, hints, hint_re, ci_hints) -> Column | None:
    return rule_hint(text, R.Rule("", "", 0, 0.0, tuple(hints or ()), hint_re, tuple(ci_hints or ())))


# Rules of one array column.  Tables with more rules than that go through the
# index of literals; of these, the rules without a literal are still columns.
RULES_PER_COLUMN = 64


def rule_scan(df: DataFrame, id_col: str, text: str, rules: DataFrame) -> DataFrame:
    """Match every rule of a rule table ``(raw_label, pattern, confidence
    [, hints, hint_re, ci_hints])`` against every text.  Rows: the finding
    contract, with ``ord`` 1 and no ``match_hash`` (a rule says whether).

    A small table is read to the driver and inlined as a projection of ``rlike``
    columns, so each text is read once and there is no join.  A table of more
    than ``RULES_PER_COLUMN`` rules goes through an index from required literals
    to rules (:mod:`tollgate.operators.rule_index`): a pattern runs only on
    texts that hold its literal, and only the rules without a literal (see
    there) are inlined and run on every text.  Optional hint columns prefilter rows
    before the full pattern runs: a rule with no hints always runs; otherwise
    a row must pass at least one of them (a substring, a cheap regex, or a
    lower-case substring of the lower-cased text).  A rule without a pattern
    matches nothing; one without a label reports ``unknown``; a missing
    confidence stays NULL.
    """
    for c, t in (("hints", "array<string>"), ("hint_re", "string"), ("ci_hints", "array<string>")):
        if c not in rules.columns:
            rules = rules.withColumn(c, F.lit(None).cast(t))
    rules = rules.where(F.col("pattern").isNotNull()).select("raw_label", "pattern", "confidence", "hints", "hint_re", "ci_hints")
    if len(rules.select("pattern").take(RULES_PER_COLUMN + 1)) > RULES_PER_COLUMN:  # reads no more partitions than it needs
        return _indexed_scan(df, id_col, text, rules)
    return _inlined_scan(df, id_col, text, rules)


def _indexed_scan(df: DataFrame, id_col: str, text: str, rules: DataFrame) -> DataFrame:
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "rules")  # written: rules keep their numbers however often they are read
    with_literals(rules).withColumn("rule_id", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    indexed, rest = numbered.where("literals is not null"), numbered.where("literals is null")
    texts = df.select(F.col(id_col).alias("item_id"), F.col(text).alias("text"))
    hits = indexed_matches(texts, indexed).select("item_id", F.coalesce("raw_label", F.lit("unknown")).alias("raw_type"), "confidence", F.lit(1).alias("ord"), F.lit(None).cast("string").alias("match_hash"))
    return hits if rest.isEmpty() else hits.unionByName(_inlined_scan(df, id_col, text, rest))


def _inlined_scan(df: DataFrame, id_col: str, text: str, rules: DataFrame) -> DataFrame:
    t = F.col(text)
    cols = []
    for r in rules.collect():
        match = t.rlike(r["pattern"])
        hint = _row_hint(t, r["hints"], r["hint_re"], r["ci_hints"])
        cond = match if hint is None else (hint & match)
        cols.append(F.when(cond, _finding(r["raw_label"] or "unknown", F.lit(r["confidence"]), 1, None)))
    groups = [F.array_compact(F.array(*cols[k: k + RULES_PER_COLUMN])) for k in range(0, len(cols), RULES_PER_COLUMN)]
    return _flatten(df, F.col(id_col), F.concat(_empty(), *groups))


# ----------------------------------------------------------------------------
# verdict assembly
# ----------------------------------------------------------------------------
def _rank_key(f: Column) -> Column:
    """Sort key: worst severity, then highest confidence, then label, then ordinal."""
    sev = X.severity_rank(X.default_severity(X.canonical_type(f["raw_type"])))
    return F.struct(sev.alias("r"), (-f["confidence"]).alias("c"),
                    f["raw_type"].alias("t"), f["ord"].alias("o"))


def worst(findings_array: Column) -> Column:
    """The finding that decides: a struct that sorts by the ranking key, with
    its ``raw_type`` and ``confidence``; NULL without findings."""
    return F.array_min(F.transform(findings_array, lambda f: F.struct(
        _rank_key(f).alias("k"), f["raw_type"].alias("raw_type"), f["confidence"].alias("confidence"))))


def assemble(df: DataFrame, findings_col: str = "findings") -> DataFrame:
    """One raw verdict per row from its own findings array -- a per-row
    reduction (``array_min`` of a total-order key), no shuffle.

    Adds ``safe``, ``threat_type`` (raw label), ``confidence``, ``severity``
    and ``n_findings``; no findings -> safe.
    """
    fs = F.col(findings_col)
    best = F.array_min(F.transform(fs, lambda f: F.struct(_rank_key(f).alias("k"), f.alias("f"))))
    sev = X.default_severity(X.canonical_type(best["f"]["raw_type"]))
    return (df.withColumn("n_findings", F.size(fs).cast("long"))
            .withColumn("safe", F.col("n_findings") == 0)
            .withColumn("threat_type", best["f"]["raw_type"])
            .withColumn("confidence", best["f"]["confidence"])
            .withColumn("severity", F.when(~F.col("safe"), sev)))


def union_findings(*rows: DataFrame) -> DataFrame:
    """Finding rows of several detectors as one table (a narrow union)."""
    contract = ["item_id", "raw_type", "confidence", "ord", "match_hash"]
    out = rows[0].select(*contract)
    for r in rows[1:]:
        out = out.unionByName(r.select(*contract))
    return out


def assemble_rows(items: DataFrame, id_col: str, rows: DataFrame) -> DataFrame:
    """One raw verdict per item from finding *rows* of several detectors.

    ``min(struct)`` is a partial aggregate: it is combined map-side, so a hot
    item costs one row per task in the shuffle.  Items with no findings are
    kept (left join) as safe.
    """
    key = F.struct(
        X.severity_rank(X.default_severity(X.canonical_type(F.col("raw_type")))).alias("r"),
        (-F.col("confidence")).alias("c"), F.col("raw_type").alias("t"),
        F.coalesce(F.col("ord"), F.lit(1)).alias("o"))
    best = (rows.groupBy("item_id")
            .agg(F.min(F.struct(key.alias("k"), F.col("raw_type"), F.col("confidence"))).alias("b"),
                 F.count(F.lit(1)).alias("n_findings")))
    out = items.select(F.col(id_col).alias("item_id")).join(best, "item_id", "left")
    tt = F.col("b")["raw_type"]
    return out.select(
        "item_id",
        F.coalesce(F.col("n_findings"), F.lit(0)).alias("n_findings"),
        F.col("b").isNull().alias("safe"),
        tt.alias("threat_type"),
        F.col("b")["confidence"].alias("confidence"),
        F.when(tt.isNotNull(), X.default_severity(X.canonical_type(tt))).alias("severity"))


# ----------------------------------------------------------------------------
# redaction and coverage
# ----------------------------------------------------------------------------
def redact_pii(df: DataFrame, col: str = "text", out: str = "redacted") -> DataFrame:
    """Replace personal data with ``[TYPE]`` tokens (cards without Luhn), from
    left to right; guards consume nothing, so neighbours are all replaced."""
    t = F.col(col)
    for r in R.PII_RULES:
        g = r.guard
        behind = f"(?<![{g.before}])" if g.before else ""
        ahead = f"(?![{g.after}])" if g.after else ""
        replaced = F.regexp_replace(t, behind + g.body.replace("]+@", "]++@") + ahead, R.REDACT_TOKENS[r.raw_label])
        hint = rule_hint(t, r)
        t = replaced if hint is None else F.when(hint, replaced).otherwise(t)
    return df.withColumn(out, t)


#: Sketches have 2 ** SKETCH_LG buckets.
SKETCH_LG = 12


def framework_coverage(verdicts: DataFrame, type_col: str = "threat_type") -> DataFrame:
    """Unsafe verdicts per compliance framework: ``(framework, n_findings, n_items)``.

    The bridge is a fixed 16-row table joined by broadcast; ``count_distinct``
    runs as a two-phase (partial, then final) aggregate.
    """
    spark = verdicts.sparkSession
    bridge = F.broadcast(spark.createDataFrame(list(R.FRAMEWORK_BRIDGE), "b_type string, framework string"))
    v = verdicts.where(~F.col("safe"))
    return (v.join(bridge, v[type_col] == bridge["b_type"], "inner")
            .groupBy("framework")
            .agg(F.count(F.lit(1)).alias("n_findings"), F.count_distinct("item_id").alias("n_items")))


def coverage_daily(verdicts: DataFrame, day: str, item: str = "item_id", type_col: str = "threat_type", lg_config: int = SKETCH_LG) -> DataFrame:
    """Unsafe verdicts per day and framework: ``(day, framework, n_findings,
    items)``, ``items`` a sketch of the distinct items.

    Days are kept as a table and merged by :func:`merged_coverage` to any longer
    time; counts of distinct items themselves could not be added up.  The day's
    partial aggregates are sketches of at most ``2 ** lg_config`` bytes or so."""
    bridge = F.broadcast(verdicts.sparkSession.createDataFrame(list(R.FRAMEWORK_BRIDGE), "b_type string, framework string"))
    v = verdicts.where(~F.col("safe"))
    return (v.join(bridge, v[type_col] == bridge["b_type"]).groupBy(F.col(day).alias("day"), "framework")
            .agg(F.count(F.lit(1)).alias("n_findings"), F.hll_sketch_agg(F.col(item), F.lit(lg_config)).alias("items")))


def merged_coverage(daily: DataFrame, by: Sequence[str] = ("framework",)) -> DataFrame:
    """Daily tables merged: ``(*by, n_findings, n_items)``.  ``n_findings`` is
    exact; ``n_items`` is an estimate with a relative standard error of about
    ``1.04 / sqrt(2 ** lg_config)`` (1.6 % with the default)."""
    return daily.groupBy(*by).agg(F.sum("n_findings").alias("n_findings"), F.hll_sketch_estimate(F.hll_union_agg("items")).alias("n_items"))
