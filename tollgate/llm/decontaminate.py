"""Benchmark decontamination through an FM-index per training shard.

A shard is one Arrow batch of documents.  Its words become symbols of the
benchmark's vocabulary; stretches that cannot hold a window (some neighbouring
pair of words never stands together in the benchmark, or too few words in a
row are left) become one separator, which loses no occurrence.  The FM-index
of what remains is searched backward with every benchmark window, occurrences
are located by sampled suffix positions, and the words they cover merge into
removal spans.  The plan is a projection: documents are not shuffled.

The benchmark is a stated query set.  It reaches the tasks in blocks of at
most about ``BLOCK_BYTES`` of text (the size is summed first).  One block is one
projection.  More are taken one after another: the driver and the tasks hold
one block at a time, what it finds is written to the shared folder (one row
for each different text that it hits, by a 128-bit hash of the text), and the
blocks' finds are merged by text and joined to the documents.

Defined cases: a NULL or empty text, or one without words, has no words and no
hits; an item without words has no window; a NULL item_id counts as the empty
string; repeated item_ids are one item; an empty benchmark hits nothing;
repeated documents are judged each by itself; a very
long text is indexed whole, in one batch; other columns pass through
untouched.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tollgate.llm import textvec as tv
from tollgate.llm.common import python_tasks, pack, read_table, staged
from tollgate.llm.fm_index import FMIndex

WINDOW = 10
BLOCK_BYTES = 4 << 20
RESULT = ("struct<n_words: bigint, spans: array<struct<word_start: bigint, word_end: bigint, "
          "byte_start: bigint, byte_end: bigint>>, items: array<string>>")
_TABLE_BITS = 20


def _table(hashes: np.ndarray) -> np.ndarray:
    """Membership by the top bits of a hash; may say yes too often, never no."""
    t = np.zeros(1 << _TABLE_BITS, bool)
    t[hashes >> np.uint64(64 - _TABLE_BITS)] = True
    return t


def _in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return table[hashes >> np.uint64(64 - _TABLE_BITS)]


class Windows:
    """The windows of one benchmark block, ready to be searched."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        data, offsets = tv.text_bytes(pa.array([t for _, t in items], pa.string()))
        starts, ends, first = tv.word_spans(data, offsets, tv.ALNUM)
        words = tv.word_hashes(data, starts, ends, tv.FOLDED_VALUES)
        self.names = sorted({i for i, _ in items})
        name_of = {n: k for k, n in enumerate(self.names)}
        self.vocabulary = np.unique(words)
        symbols = np.searchsorted(self.vocabulary, words) + 2
        found: dict[int, dict[tuple, set]] = {}
        for k, (name, _) in enumerate(items):
            a, b = int(first[k]), int(first[k + 1])
            size = min(window, b - a)
            for i in range(a, b - size + 1) if size else ():
                found.setdefault(size, {}).setdefault(tuple(symbols[i: i + size].tolist()), set()).add(name_of[name])
        self.by_size = []
        for size, windows in sorted(found.items()):
            owners = [np.array(sorted(s)) for s in windows.values()]
            self.by_size.append((size, np.array(list(windows), np.int64).reshape(-1, size), np.cumsum([0] + [len(o) for o in owners]), np.concatenate(owners)))
        self.least = self.by_size[0][0] if self.by_size else 0
        inside = np.ones(max(0, len(words) - 1), bool)
        inside[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(words))] - 1] = False
        self.pairs = _table(tv.window_hashes(words, 2)[inside] if len(words) > 1 else words[:0])
        self.known = _table(self.vocabulary)

    def keep(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Words that may lie in an occurrence."""
        if self.least < 2 or len(words) < 2:
            return _in_table(self.known, words)
        link = np.concatenate((_in_table(self.pairs, tv.window_hashes(words, 2)), [False]))
        last = first[1:] - 1
        link[last[last >= 0]] = False
        edge = np.diff(np.concatenate(([0], link.view(np.int8), [0])))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        enough = end - begin >= self.least - 1
        keep = np.zeros(len(words), bool)
        keep[tv.ranges(begin[enough], end[enough] - begin[enough] + 1)] = True
        return keep

    def search(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, item) pairs and the covered words of a shard."""
        none = np.zeros(0, np.int64)
        covered = np.zeros(len(words) + 1, np.int64)
        if not self.by_size or not len(words):
            return none, none, covered[:-1] > 0
        at = np.flatnonzero(self.keep(words, first))
        if not len(at):
            return none, none, covered[:-1] > 0
        doc = np.searchsorted(first, at, "right") - 1
        place = np.searchsorted(self.vocabulary, words[at])
        place[place == len(self.vocabulary)] = 0
        symbol = np.where(self.vocabulary[place] == words[at], place + 2, 1)
        broken = np.concatenate(([False], (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])))
        shift = np.arange(len(at)) + np.cumsum(broken)
        text = np.ones(shift[-1] + 1, np.int64)
        text[shift] = symbol
        origin = np.full(len(text), -1, np.int64)
        origin[shift] = at
        index = FMIndex(text, len(self.vocabulary) + 2)
        docs, items = [none], [none]
        for size, patterns, owner_at, owners in self.by_size:
            lo, hi = index.search(patterns)
            hit = np.flatnonzero(hi > lo)
            if not len(hit):
                continue
            word = origin[index.locate(tv.ranges(lo[hit], hi[hit] - lo[hit]))]
            which = np.repeat(hit, hi[hit] - lo[hit])
            np.add.at(covered, word, 1)
            np.add.at(covered, word + size, -1)
            pair = np.unique((np.searchsorted(first, word, "right") - 1) * len(patterns) + which)
            d, w = pair // len(patterns), pair % len(patterns)
            many = owner_at[w + 1] - owner_at[w]
            docs.append(np.repeat(d, many))
            items.append(owners[tv.ranges(owner_at[w], many)])
        pair = np.unique(np.concatenate(docs) * len(self.names) + np.concatenate(items))
        return pair // len(self.names), pair % len(self.names), np.cumsum(covered[:-1]) > 0


def _merged(covered: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of covered words, none across documents."""
    edge = np.diff(np.concatenate(([0], covered.view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    inner = first[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(covered))])
    cut = inner[covered[inner] & covered[inner - 1]]
    return np.sort(np.concatenate((begin, cut))), np.sort(np.concatenate((end, cut)))


def scan_batch(column: pa.Array, windows: Windows) -> pa.Array:
    """Word count, removal spans and items hit, for each text of a shard."""
    n = len(column)
    data, offsets = tv.text_bytes(column)
    starts, ends, first = tv.word_spans(data, offsets, tv.ALNUM)
    words = tv.word_hashes(data, starts, ends, tv.FOLDED_VALUES)
    docs, items, covered = windows.search(words, first)
    begin, end = _merged(covered, first)
    owner = np.searchsorted(first, begin, "right") - 1
    base, at = first[owner], offsets[owner]
    span = pa.StructArray.from_arrays(
        [pa.array(begin - base), pa.array(end - base),
         pa.array((starts[begin] if len(begin) else begin) - at), pa.array((ends[end - 1] if len(end) else end) - at)],
        ["word_start", "word_end", "byte_start", "byte_end"])
    spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), span)
    names = pa.array(windows.names, pa.string()).take(pa.array(items)) if len(items) else pa.array([], pa.string())
    hits = pa.ListArray.from_arrays(pa.array(np.searchsorted(docs, np.arange(n + 1)), pa.int32()), names)
    return pa.StructArray.from_arrays([pa.array(np.diff(first)), spans, hits], ["n_words", "spans", "items"])


def _scanner(windows_ref):
    @arrow_udf(RESULT)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows = windows_ref.value
        for column in batches:
            yield scan_batch(column, windows)
        tv.give_back()
    return scan


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[int, Iterator[Windows]]:
    """Number of blocks, and the benchmark in blocks that are each small enough
    to broadcast, made when they are asked for."""
    items = benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("i"),
                             F.coalesce(benchmark["text"], F.lit("")).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    count = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("i", "t"), F.lit(count))
    return count, (Windows([(r["i"], r["t"]) for r in items.where(block == k).toLocalIterator()], window) for k in range(count))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` packed as ``row``, with ``n_words``, merged removal ``spans``
    and the sorted distinct ``items`` whose windows occur."""
    spark = docs.sparkSession
    python_tasks(spark)
    text: Column = F.col("row.text")
    out = pack(docs)
    count, blocks = benchmark_blocks(benchmark, window)
    if count == 1:
        out = out.withColumn("found", _scanner(spark.sparkContext.broadcast(next(blocks)))(text))
        return out.select("row", "found.n_words", "found.spans", F.array_sort("found.items").alias("items"))
    key = F.md5(text.cast("binary"))
    finds = None
    for windows in blocks:
        held = spark.sparkContext.broadcast(windows)
        hit = out.select(key.alias("key"), _scanner(held)(text).alias("found")).where(F.size("found.spans") > 0)
        # Copies of a text are found alike: one row stands for all of them.
        part = staged(hit.groupBy("key").agg(F.any_value("found").alias("found")).select("key", "found.spans", "found.items"), "hits")
        held.destroy()
        finds = part if finds is None else finds.unionByName(part)
    merged = finds.groupBy("key").agg(_joined_spans(F.array_sort(F.flatten(F.collect_list("spans")))).alias("spans"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    n_words = F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"), F.lit(0))).cast("bigint")
    return out.withColumn("key", key).join(merged, "key", "left").select(
        "row", n_words.alias("n_words"), *[F.coalesce(F.col(c), F.array().cast(merged.schema[c].dataType)).alias(c) for c in ("spans", "items")])


def _joined_spans(spans: Column) -> Column:
    """Sorted spans, those that overlap or touch as one."""
    start = F.struct(F.lit(-1).cast("bigint").alias("word_start"), F.lit(-1).cast("bigint").alias("word_end"),
                     F.lit(-1).cast("bigint").alias("byte_start"), F.lit(-1).cast("bigint").alias("byte_end"))

    def join(done: Column, s: Column) -> Column:
        last = F.when(F.size(done) > 0, F.element_at(done, -1)).otherwise(start)
        grown = F.struct(last["word_start"].alias("word_start"), F.greatest(last["word_end"], s["word_end"]).alias("word_end"),
                         last["byte_start"].alias("byte_start"), F.greatest(last["byte_end"], s["byte_end"]).alias("byte_end"))
        return F.when(s["word_start"] <= last["word_end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(s)))
    return F.aggregate(spans, F.slice(spans, 1, 0), join)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any occurrence; all columns as they were."""
    return contamination(docs, benchmark).where(F.size("spans") == 0).select("row.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["word_end"] - s["word_start"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


ORACLE_SQL = """
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS k
  FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
dwin AS (
  SELECT doc_id, i AS pos, size, array_to_string(w[i : i + size - 1], ' ') AS k
  FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)),
hit AS (SELECT DISTINCT d.doc_id, d.pos, d.size, n.item FROM dwin d JOIN win n ON d.size = n.size AND d.k = n.k),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(pos, pos + size)) AS t(p) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.s, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN cover c ON d.doc_id = c.doc_id LEFT JOIN ids i ON d.doc_id = i.doc_id
"""
