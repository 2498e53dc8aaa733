"""Mixing sources to target weights with a time-varying curriculum.

Targets.  Sources in code-point order (NULL last) weigh ``WEIGHTS`` in turn and
share all words by weight; a target stops at ``LIMIT`` times its source's
words, and the excess is reshared by weight among the others until none is
above.  That is one level ``x`` with target = min(limit, x * weight); ``x`` is
found by resharing rounds over the source table, one aggregate each.

Order.  A source's documents stand in the order of a hash and repeat as passes
over the source until its target is used up.  A copy's place in that stream
comes from running sums: the source is cut into hash ranges of bounded size,
range totals are summed ahead, and only inside a range are rows ordered, so a
source that holds a third of all rows is spread over many tasks.

Curriculum.  Each source has a schedule: a piecewise linear weight over
training time 0..1.  Its integral, scaled to the target, is the cumulative
demand for the source's words; a copy whose middle lies u of the way through
its source's stream is needed at the time where the normalised integral
reaches u (a quadratic in each piece).  Copies are range-sorted by that time.

Defined cases: a text without words (NULL, empty, blank) has size 0, is never
needed (taken 0, no position) and, alone in its source, leaves a target of 0;
a NULL source is a source of its own, the last; repeated rows and ids are
separate documents (ties in the hash are broken by a hash of the text; rows that are
alike change places without effect); an empty table gives no rows; a text of
any length is only split and counted on its row; other
columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.llm.common import read_table, staged, word_count

WEIGHTS = (1, 2, 3)
LIMIT = 3
#: Knots (time, weight) of the schedules, dealt to the sources in turn: fading, rising, steady.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
             ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
             ((0.0, 1.0), (1.0, 1.0)))
#: Rows of a hash range, on average, and sources up to which their table is broadcast.
RANGE_ROWS, BROADCAST_SOURCES = 20_000, 100_000


def _key(source: Column) -> Column:
    """Never NULL, in code-point order with NULL last."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), source))


def source_targets(numbers: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(key, source_size, source_rows, place, target), one row per source, from
    rows with ``key`` and ``size``."""
    sources = numbers.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    place = F.row_number().over(Window.orderBy("key")) - 1  # over one row a source
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int"))
    sources = staged(sources.withColumn("place", place).withColumn("weight", weight).withColumn("most", limit * F.col("source_size")), "sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    capped, level, before = F.lit(False), 0.0, None
    while True:
        used, weight, n = sources.agg(F.coalesce(F.sum(F.when(capped, F.col("most"))), F.lit(0)),
                                      F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)), F.count(F.when(capped, 1))).first()
        if n == before or not weight:
            break
        before, level = n, (total - used) / weight
        capped = F.col("most") <= F.lit(level) * F.col("weight")
    target = F.when(capped, F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return sources.select("key", "source_size", "source_rows", "place", target.alias("target"))


def inverse_demand(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """Time at which the normalised integral of the schedule reaches ``share``."""
    pieces, done = [], 0.0
    total = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
    need = share * F.lit(total)
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        a = F.greatest(need - F.lit(done), F.lit(0.0))
        # w0 * d + slope * d * d / 2 = a, solved without cancellation
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * (w1 - w0) / (t1 - t0)) * a, F.lit(0.0)))
        d = F.when(a > 0, 2 * a / (F.lit(w0) + root)).otherwise(F.lit(0.0))
        done += (t1 - t0) * (w0 + w1) / 2
        pieces.append((done, F.lit(t0) + F.least(d, F.lit(t1 - t0))))
    out = pieces[-1][1]
    for reach, time in reversed(pieces[:-1]):
        out = F.when(need <= F.lit(reach), time).otherwise(out)
    return out


def mixed(docs: DataFrame, schedules=SCHEDULES, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT,
          range_rows: int = RANGE_ROWS, whole_documents: bool = False, carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``row`` (its columns, or those in ``carry``), size,
    source_size, target, taken (words) and positions (times of its copies).

    The copy in which a source's target runs out is taken in part; with
    ``whole_documents`` it is taken whole if at least half of it is needed."""
    base = docs.select(
        F.struct(*[docs[c] for c in carry or docs.columns]).alias("row"), _key(docs["source"].cast("string")).alias("key"),
        word_count(docs["text"]).alias("size"), F.md5(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")).alias("h"),
        F.xxhash64(docs["text"]).alias("tie"))
    if carry is not None:
        base = staged(base, "sizes")  # small rows: read them again instead of the texts
        numbers = base.select("key", "size", "h")
    else:
        numbers = staged(base.select("key", "size", "h"), "sizes")
    targets = staged(source_targets(numbers, weights, limit), "targets")
    small = targets.count() <= BROADCAST_SOURCES
    per_source = targets.withColumn("ranges", F.ceil(F.col("source_rows") / range_rows))
    per_source = F.broadcast(per_source) if small else per_source

    def ranged(df: DataFrame) -> DataFrame:
        unit = F.conv(F.substring("h", 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
        return df.join(per_source, "key").withColumn("range", F.floor(unit * F.col("ranges")))
    totals = ranged(numbers).groupBy("key", "range").agg(F.sum("size").alias("words"))
    ahead = F.sum("words").over(Window.partitionBy("key").orderBy("range")) - F.col("words")
    offsets = totals.select("key", "range", ahead.alias("ahead"))
    within = Window.partitionBy("key", "range").orderBy("h", "tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged(base).join(offsets, ["key", "range"]).withColumn("start", F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    demand = F.floor("target")
    parts, times = [], []
    for j in range(limit):
        low = F.col("start") + F.lit(j) * F.col("source_size")
        part = F.greatest(F.least(demand - low, F.col("size")), F.lit(0))
        if whole_documents:
            part = F.when(2 * part >= F.col("size"), F.col("size")).otherwise(F.lit(0))
        share = F.least(F.try_divide(low + part / 2, demand), F.lit(1.0))
        time = inverse_demand(share, schedules[-1])
        for k, knots in enumerate(schedules[:-1]):
            time = F.when(F.pmod(F.col("place"), F.lit(len(schedules))) == k, inverse_demand(share, knots)).otherwise(time)
        parts.append(part)
        times.append(F.when(part > 0, time))
    taken = parts[0]
    for p in parts[1:]:
        taken = taken + p
    return rows.select("row", "size", "source_size", "target", taken.cast("bigint").alias("taken"), F.array_compact(F.array(*times)).alias("positions"))


def training_order(docs: DataFrame, **options) -> DataFrame:
    """Every copy that the mix takes whole, range-sorted by training position
    (ties, which are in one range, by doc_id and a hash of the text)."""
    copies = mixed(docs, whole_documents=True, **options).select("row", F.explode("positions").alias("position"))
    return copies.repartitionByRange("position").sortWithinPartitions("position", "row.doc_id", F.xxhash64("row.text")).select("row.*")


def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mixed(docs, carry=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken",
                                               F.round(F.get("positions", F.lit(0)), 6).alias("position"))
    # The hash spreads documents without a position over ranges of their own.
    return out.orderBy(F.col("position").asc_nulls_last(), F.xxhash64("doc_id"), "doc_id")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS h,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
r AS (SELECT source, source_size, row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1 AS place FROM s),
w AS (SELECT *, place % 3 + 1 AS weight, 3 * source_size AS most FROM r),
c AS (
  SELECT *, sum(weight) OVER () AS all_weight, sum(source_size) OVER () AS total,
    coalesce(sum(most) OVER o, 0) AS used, coalesce(sum(weight) OVER o, 0) AS gone FROM w
  WINDOW o AS (ORDER BY CAST(most AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, CAST(total - used AS DOUBLE) / (all_weight - gone) AS level FROM c),
f AS (SELECT (SELECT level FROM k WHERE most > level * weight ORDER BY CAST(most AS DOUBLE) / weight, place LIMIT 1) AS level),
t AS (SELECT w.source, w.source_size, w.place, CASE WHEN f.level IS NULL OR w.most <= f.level * w.weight THEN CAST(w.most AS DOUBLE) ELSE f.level * w.weight END AS target FROM w, f),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.place, CAST(floor(t.target) AS BIGINT) AS demand,
    CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, greatest(least(demand - start, size), 0) AS p0, greatest(least(demand - start - source_size, size), 0) AS p1,
    greatest(least(demand - start - 2 * source_size, size), 0) AS p2 FROM p),
u AS (SELECT *, CASE WHEN p0 > 0 THEN least((start + p0 / 2.0::DOUBLE) / demand, 1.0::DOUBLE) END AS x FROM q),
v AS (SELECT *,
    CASE WHEN x IS NULL THEN NULL WHEN place % 3 = 2 THEN x
      WHEN place % 3 = 0 THEN CASE WHEN x <= 0.625 THEN least(2 * x / (1.5 + sqrt(2.25 - 2 * x)), 0.5) ELSE 0.5 + least(2 * (x - 0.625) / (1 + sqrt(greatest(1 - 2 * (x - 0.625), 0))), 0.5) END
      ELSE CASE WHEN x <= 0.375 THEN least(2 * x / (0.5 + sqrt(0.25 + 2 * x)), 0.5) ELSE 0.5 + least(2 * (x - 0.375) / (1 + sqrt(1 + 2 * (x - 0.375))), 0.5) END END AS y FROM u)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(p0 + p1 + p2 AS BIGINT) AS taken, round(y, 6) AS position FROM v
"""
