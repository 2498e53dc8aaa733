"""URL filter: host and path rules, then exact membership by a Bloom cascade.

The cascade encodes which keys of a complete universe are listed.  Level 1 is
a Bloom filter of the listed keys; level 2 one of the unlisted keys that level
1 wrongly holds; level 3 one of the listed keys that level 2 wrongly holds;
and so on until a level has no false positive.  A key of the universe is then
listed if and only if the first level that does not hold it is an even one (or
it is held by all and their number is odd).  Keys are dealt to segments by a
hash so that no array grows beyond ``SEGMENT_BITS``; all segments are built in
the same passes.

Levels are built with aggregates over distinct keys (bit_or of 64-bit words)
and shrink geometrically.  Probing needs no join and no shuffle at any size:
``INLINE_BYTES`` of consecutive segments at a time are one row, read by a scalar
subquery inside the expression.  A cascade of one such part is a projection; a
larger one is probed part after part, each pass judging the rows whose key lies
in its segments and writing them to the shared folder, so that neither a task
nor the driver holds more than one part and a hot host is spread as the table
is.  Every row is in exactly one pass; the table is read once a part.

Defined cases: a NULL url or one without ``://`` has an empty host and path; an
empty page table gives no rows; listed keys outside the universe are ignored;
an empty list allows everything; repeated rows are judged alike; of rules that
fit the longest wins, of one length the first given; a url of any length is one
row's strings; a NULL key is in no list; other columns pass through in ``row``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import lowered_ascii, pack, read_table, staged

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
SEGMENT_BITS = 1 << 20
INLINE_BYTES = 32 << 20
MAX_LEVELS = 64


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return lowered_ascii(host), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict): the longest that fits, else NULL."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)) if name is None else name.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    return name, verdict


class Level:
    """Shape of one filter: ``words`` 64-bit words a segment, ``hashes`` bits a key."""

    def __init__(self, number: int, words: int, hashes: int):
        self.number, self.words, self.hashes = number, words, hashes

    def places(self, key: Column) -> list[Column]:
        bits = F.lit(64 * self.words)
        return [F.pmod(F.xxhash64(key, F.lit(1000 * self.number + i)), bits) for i in range(self.hashes)]

    def holds(self, key: Column, array: Column) -> Column:
        out = F.lit(True)
        for p in self.places(key):
            word = F.get(array, F.shiftright(p, 6).cast("int"))
            out = out & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
        return F.coalesce(out, F.lit(False))


class Cascade:
    """``table``: (segment, filters), filters being the arrays of the levels."""

    def __init__(self, table: DataFrame, levels: list[Level], segments: int):
        self.table, self.levels, self.segments = table, levels, segments

    def parts(self) -> list[tuple[int, int]]:
        """Ranges of segments, each of at most ``INLINE_BYTES`` (one segment at least)."""
        each = max(1, INLINE_BYTES // (8 * sum(level.words for level in self.levels)))
        return [(k, min(k + each, self.segments)) for k in range(0, self.segments, each)]

    def segment(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(self.segments)).cast("int")

    def _listed(self, key: Column, array_of) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(~level.holds(key, array_of(level.number - 1)), F.lit(level.number % 2 == 0)).otherwise(out)
        return out

    def probed(self, df: DataFrame, key: str, use: Callable[[DataFrame, Callable[[int], Column]], DataFrame], name: str) -> DataFrame:
        """``use(rows, filter_of)`` over all rows of ``df``, each row in the part
        of its key's segment; ``filter_of(k)`` is the filter of level k + 1 there."""
        parts, segment = self.parts(), F.coalesce(self.segment(F.col(key)), F.lit(0))

        def one(first: int, end: int) -> DataFrame:
            within = self.table.where((F.col("segment") >= first) & (F.col("segment") < end))
            whole = within.agg(F.array_sort(F.collect_list(F.struct("segment", "filters"))).alias("all")).scalar()
            own = F.get(whole, segment - F.lit(first))["filters"]
            rows = df if len(parts) == 1 else df.where((segment >= first) & (segment < end))
            return use(rows, lambda k: F.get(own, F.lit(k)))
        if len(parts) == 1:
            return one(*parts[0])
        return reduce(DataFrame.unionAll, [staged(one(*p), name) for p in parts])

    def mark(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with the boolean column ``name``: is ``key`` listed?"""
        if not self.levels:
            return df.withColumn(name, F.lit(False))
        return self.probed(df, key, lambda rows, of: rows.withColumn(name, F.col(key).isNotNull() & self._listed(F.col(key), of)), "marked")


def build_cascade(universe: DataFrame, segment_bits: int = SEGMENT_BITS) -> Cascade:
    """From ``universe`` (distinct ``key``, ``listed``)."""
    spark = universe.sparkSession
    keys = staged(universe, "universe")
    listed, total = keys.agg(F.count(F.when(F.col("listed"), 1)), F.count(F.lit(1))).first()
    if not listed:
        return Cascade(keys.limit(0), [], 1)
    rate = min(0.5, max(1e-6, math.sqrt(0.5) * listed / max(1, total - listed)))
    hashes = max(1, round(-math.log2(rate)))
    per_key = -math.log(rate) / math.log(2) ** 2
    segments = max(1, math.ceil(listed * per_key / segment_bits))
    shape = Cascade(keys, [], segments)
    inside, outside, count = keys.where("listed").select("key"), keys.where("not listed").select("key"), listed
    tables, levels = [], []
    while count:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end: are the keys distinct?")
        words = math.ceil(count / segments * (per_key if not levels else 1 / math.log(2)) / 64) + 1
        level = Level(len(levels) + 1, words, hashes if not levels else 1)
        bits = inside.select(shape.segment(F.col("key")).alias("segment"), F.explode(F.array(*level.places(F.col("key")))).alias("p"))
        bits = bits.groupBy("segment", F.shiftright("p", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits"))
        blank = spark.range(segments * words).select((F.col("id") / words).cast("int").alias("segment"), (F.col("id") % words).alias("word"), F.lit(0).cast("bigint").alias("bits"))
        full = bits.unionByName(blank).groupBy("segment", "word").agg(F.expr("bit_or(bits)").alias("bits"))
        array = F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"])
        table = staged(full.groupBy("segment").agg(array.alias("filter")), "level")
        one = Cascade(table, [level], segments)
        wrong = staged(_held(one, outside), "wrong")
        tables.append(table)
        levels.append(level)
        inside, outside, count = wrong, inside, wrong.count()
    out = tables[0].select("segment", F.array("filter").alias("filters"))
    for t in tables[1:]:
        out = out.join(t, "segment").select("segment", F.concat("filters", F.array("filter")).alias("filters"))
    return Cascade(staged(out, "cascade"), levels, segments)


def _held(one: Cascade, keys: DataFrame) -> DataFrame:
    """Keys that the only level of ``one`` holds."""
    single = Cascade(one.table.select("segment", F.array("filter").alias("filters")), one.levels, one.segments)
    return single.probed(keys, "key", lambda rows, of: rows.where(one.levels[0].holds(F.col("key"), of(0))), "held")


def listed_by_digest(key: Column) -> Column:
    """Stands in for a published host list: one key in sixteen, by its md5."""
    return F.md5(key.cast("binary")).startswith("0")


def judged(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` packed as ``row`` with host, path, rule and verdict; ``listed``
    has the hosts to block in column ``key``."""
    host, path = host_path(F.col("row.url"))
    base = pack(pages).withColumn("host", host).withColumn("path", path)
    universe = base.select(F.col("host").alias("key")).distinct()
    flagged = universe.join(listed.select("key").distinct().withColumn("l", F.lit(True)), "key", "left")
    cascade = build_cascade(flagged.select("key", F.coalesce("l", F.lit(False)).alias("listed")))
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    out = cascade.mark(base, "host", "is_listed")
    return out.select("row", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("is_listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(host_path(F.col("url"))[0].alias("key")).distinct()
    out = judged(pages, hosts.where(listed_by_digest(F.col("key"))))
    return out.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def _oracle_sql() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in ordered]
    rule = " ".join(f"WHEN {f} THEN '{n}'" for f, n, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN md5(host) LIKE '0%' THEN 'block' ELSE 'allow' END AS verdict FROM p
"""


ORACLE_SQL = _oracle_sql()
