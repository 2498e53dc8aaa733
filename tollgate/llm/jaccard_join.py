"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of five-word shingles; two texts link at a Jaccard similarity
of at least ``THRESHOLD``.

1. One scan hashes words and shingles and keeps ``HASHES`` MinHash values of
   16 bits (32 bands of 4) and a 128-bit key of the word sequence.  Copies
   (equal keys) fold into one representative by a partial aggregate.
2. Representatives that agree on a band meet in its bucket.  A bucket of more
   than ``BUCKET_BLOCK`` members is cut into blocks by a hash, and pairs of
   blocks meet, so no task holds an unbounded bucket.  In a bucket the MinHash
   values of a pair are compared 32 at a time, and the pair goes as soon as
   the posterior probability of reaching the threshold (uniform prior) falls
   below ``TOLERANCE``.  A pair is looked at in the first band it shares.
   What leaves the bucket is a spanning forest of the pairs that are left,
   never the pairs: at most one edge for each member.
3. Connected components of these edges (large-star / small-star, each round a
   table in the shared folder) are the candidate clusters.  Inside a cluster,
   again by blocks, all pairs pass the same pruning and what is left is
   verified on the exact shingle sets.  Links are counted, not written out;
   the exact links' forest gives the classes.

With 32 bands of 4, a pair at exactly 0.8 shares no band with probability
5e-8; the pruning loses about ``TOLERANCE`` of the pairs near the threshold.

Result per document: class_id (least doc_id of the connected class), n_links
(other documents linked, copies included), n_text_links (other word sequences
linked), n_copies (documents with its word sequence, itself included).

Defined cases: a text of one to four words is one shingle; a NULL, empty or
wordless text links with nothing and is a class of its own; a class whose
documents all lack a doc_id has a NULL class_id; repeated rows are copies;
texts that differ in white space only are copies; ties for the least document of
a class go to the lesser text hash; a text of any length is one row, its shingles
8 bytes each in the task that holds it; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tollgate.llm import textvec as tv
from tollgate.llm.common import WORD_SEPARATORS, pack, python_tasks, read_table, staged

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
HASHES, ROWS, STEP = 128, 4, 32
BANDS = HASHES // ROWS
BUCKET_BLOCK = 1024
CLUSTER_BLOCK, CLUSTER_WORDS = 2048, 2_000_000
FILTER_BITS = 1 << 27
_PAIRS_AT_ONCE = 200_000
_MULTIPLIERS = (np.random.default_rng(5_2016).integers(0, 2**31, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n compared values, the least number of matches that keeps a pair.

    With a uniform prior, P(J >= t | m of n match) = P(Bin(n + 1, t) <= m)."""
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total, m, term = 0.0, -1, (1 - threshold) ** (n + 1)
        while total + term < tolerance:
            total, m = total + term, m + 1
            term *= (n + 1 - m) / (m + 1) * threshold / (1 - threshold)
        out[n] = m + 1
    return out


def shingles(column: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word by document, shingle hashes, first shingle by document)."""
    data, offsets = tv.text_bytes(column)
    starts, ends, first = tv.word_spans(data, offsets, tv.NON_SPACE)
    words = tv.word_hashes(data, starts, ends)
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    at = np.concatenate(([0], np.cumsum(n)))
    out = np.empty(at[-1], np.uint64)
    long = count >= size
    if long.any():
        windows = tv.window_hashes(words, size)
        dest = np.repeat(long, n)
        out[dest] = windows[tv.ranges(first[:-1][long], n[long])]
    for m in range(1, size):
        short = np.flatnonzero(count == m)
        if len(short):
            h = np.full(len(short), np.uint64(m))
            for k in range(m):
                h += words[first[short] + k] * tv.POSITION[k]
            out[at[short]] = tv.mix(h)
    return words, first, out, at


def signatures(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(documents, HASHES) MinHash values of 16 bits; rows without shingles are meaningless."""
    n = len(at) - 1
    low = np.full((HASHES, n), np.uint32(0xFFFFFFFF))
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    some = np.flatnonzero(np.diff(at) > 0)
    begins = at[some]
    step = 1 << 14
    buffer = np.empty(step, np.uint32)
    for a in range(0, len(short), step):
        part = short[a: a + step]
        i = int(np.searchsorted(begins, a, "right")) - 1
        j = int(np.searchsorted(begins, a + len(part), "left"))
        cut = np.maximum(begins[i:j] - a, 0)
        docs = some[i:j]
        view = buffer[: len(part)]
        for k in range(HASHES):
            np.multiply(part, _MULTIPLIERS[k], out=view)
            low[k, docs] = np.minimum(low[k, docs], np.minimum.reduceat(view, cut))
    return (tv.mix(low.T.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def _sketcher():
    @arrow_udf("struct<n_words: bigint, seq: binary, bands: array<bigint>>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tv.start_over()
        for column in batches:
            n = len(column)
            words, first, hashes, at = shingles(column)
            sign = np.ascontiguousarray(signatures(hashes, at)).view(np.int64)
            seq = [hashlib.blake2b(words[first[k]: first[k + 1]].tobytes(), digest_size=16).digest() if first[k + 1] > first[k] else None for k in range(n)]
            yield pa.StructArray.from_arrays(
                [pa.array(np.diff(first)), pa.array(seq, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(sign.reshape(-1)))],
                ["n_words", "seq", "bands"])
        tv.give_back()
    return sketch


def _shingle_sets(bits_ref, n_bits: int):
    @arrow_udf("struct<seq: binary, shingles: binary>")
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        bits = bits_ref.value
        for place, column in batches:
            p = place.to_numpy(zero_copy_only=False)
            want = (bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)
            rows = np.flatnonzero(want)
            some = column.take(pa.array(rows))
            words, first, hashes, at = shingles(some)
            seq, sets = [None] * len(column), [None] * len(column)
            for k, r in enumerate(rows.tolist()):
                if first[k + 1] > first[k]:
                    seq[r] = hashlib.blake2b(words[first[k]: first[k + 1]].tobytes(), digest_size=16).digest()
                    sets[r] = np.unique(hashes[at[k]: at[k + 1]]).tobytes()
            yield pa.StructArray.from_arrays([pa.array(seq, pa.binary()), pa.array(sets, pa.binary())], ["seq", "shingles"])
        tv.give_back()
    # Else a filter on the result is pushed below the projection, and every text
    # is worked through twice, by two workers for each task.
    return of.asNondeterministic()


def _exact_sets(docs: DataFrame, sets) -> DataFrame:
    """(seq, shingles) of the rows that ``sets`` (of a place and a text) answers."""
    return docs.select(sets.alias("s")).select("s.*").where(F.col("seq").isNotNull())


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least index of each node's component."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if (label == before).all():
            break
    return label


def _prune(sign: np.ndarray, left: np.ndarray, right: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Indices of the pairs that survive the incremental comparison."""
    live, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for n in range(STEP, HASHES + 1, STEP):
        same = sign[left[live], n - STEP: n] == sign[right[live], n - STEP: n]
        matches[live] += same.sum(1)
        live = live[matches[live] >= least[n]]
    return live


def _pair_chunks(group: np.ndarray, side: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs within runs of equal ``group``, in bounded chunks; where
    ``cross`` is set only those of different sides."""
    n = len(group)
    end = np.searchsorted(group, group, "right")
    many = end - np.arange(n) - 1
    total = np.cumsum(many)
    a = 0
    while a < n:
        base = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, base + _PAIRS_AT_ONCE, "right")))
        left = np.repeat(np.arange(a, b), many[a:b])
        right = tv.ranges(np.arange(a, b) + 1, many[a:b])
        if len(left):
            ok = ~cross[left] | (side[left] != side[right])
            yield left[ok], right[ok]
        a = b


def _joined(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The forest ``root`` with the pairs of one more chunk: no more than a
    chunk's pairs are ever held."""
    if not len(left):
        return root
    own = np.flatnonzero(root != np.arange(len(root)))
    return _forest(len(root), np.concatenate((own, left)), np.concatenate((root[own], right)))


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches cut at group ends: (rows of whole groups, group number)."""
    held: list[pa.RecordBatch] = []

    def changes(t: pa.Table) -> np.ndarray:
        new = np.zeros(len(t), bool)
        for k in keys:
            c = t.column(k).to_numpy()
            new[1:] |= c[1:] != c[:-1]
        return new
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and all(held[-1].column(k)[-1].as_py() == batch.column(k)[-1].as_py() for k in keys):
            held.append(batch)  # still the same group: wait for its end
            continue
        t = pa.Table.from_batches([*held, batch])
        new = changes(t)
        cut = int(np.flatnonzero(new)[-1]) if new.any() else 0
        if cut:
            yield t.slice(0, cut), np.cumsum(new[:cut])
        held = t.slice(cut).to_batches()
    if held:
        t = pa.Table.from_batches(held)
        yield t, np.cumsum(changes(t))


def _bands_of(t: pa.Table) -> np.ndarray:
    flat = t.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(-1, BANDS))


def _candidates(least: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in _whole_groups(batches, ["band", "value", "i", "j"]):
            bands, rep = _bands_of(t), t.column("rep").to_numpy()
            band, side = t.column("band").to_numpy(), t.column("side").to_numpy()
            cross = t.column("i").to_numpy() != t.column("j").to_numpy()
            sign = bands.view(np.uint16)
            root = np.arange(len(rep))
            for left, right in _pair_chunks(group, side, cross):
                first = (bands[left] == bands[right]).argmax(1)
                own = first == band[left]
                left, right = left[own], right[own]
                live = _prune(sign, left, right, least)
                root = _joined(root, left[live], right[live])
            edge = np.flatnonzero(root != np.arange(len(rep)))
            if len(edge):
                yield pa.RecordBatch.from_arrays([pa.array(rep[edge]), pa.array(rep[root[edge]])], ["a", "b"])
        tv.give_back()
    return run


def _verified(least: dict[int, int], threshold: float):
    def group_links(t: pa.Table) -> pa.RecordBatch:
        n = len(t)
        rep, copies, side = (t.column(c).to_numpy() for c in ("rep", "copies", "side"))
        cross = np.full(n, t.column("i")[0].as_py() != t.column("j")[0].as_py())
        sign = _bands_of(t).view(np.uint16)
        sets = [np.frombuffer(b, np.uint64) for b in t.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        at = np.cumsum(size) - size
        distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(distinct), bool)
        links, docs, root = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
        for left, right in _pair_chunks(np.zeros(n, np.int64), side, cross):
            live = _prune(sign, left, right, least)
            left, right = left[live], right[live]
            if not len(left):
                continue
            lefts, rights = [], []
            bounds = np.flatnonzero(np.concatenate(([True], left[1:] != left[:-1], [True])))
            for a, b in zip(bounds[:-1], bounds[1:]):
                x, others = left[a], right[a:b]
                own = ids[at[x]: at[x] + size[x]]
                mark[own] = True
                hit = mark[ids[tv.ranges(at[others], size[others])]]
                common = np.add.reduceat(hit.astype(np.int64), np.cumsum(size[others]) - size[others])
                mark[own] = False
                ok = others[common >= threshold * (size[x] + size[others] - common) - 1e-9]
                links[x] += len(ok)
                docs[x] += copies[ok].sum()
                links[ok] += 1
                docs[ok] += copies[x]
                lefts.append(np.full(len(ok), x))
                rights.append(ok)
            root = _joined(root, np.concatenate(lefts), np.concatenate(rights))
        return pa.RecordBatch.from_arrays([pa.array(rep), pa.array(rep[root]), pa.array(links), pa.array(docs)], ["rep", "root", "links", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in _whole_groups(batches, ["cluster", "i", "j"]):
            bounds = np.flatnonzero(np.diff(group, prepend=-1, append=group[-1] + 1))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield group_links(t.slice(a, b - a))
            tv.give_back()
    return run


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least
    node of its component.  Large-star and small-star in turn; each round is a
    table in the shared folder, and a round sends a node's row to its least
    neighbour only, by partial aggregates."""
    edges = staged(edges.where("a <> b").distinct(), name)
    mark = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = staged(small.where("a <> b").distinct(), name)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if mark == now:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _blocked(members: DataFrame, keys: list[str], n_blocks, columns: list[str]) -> DataFrame:
    """Each member goes to the pairs of blocks that its own block is in."""
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    met = members.withColumn("blocks", n_blocks.cast("int")).withColumn("side", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(*keys, F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", *columns)
    return met.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                    bucket_block: int = BUCKET_BLOCK, cluster_block: int = CLUSTER_BLOCK) -> DataFrame:
    """(doc_id, class_id, n_links, n_text_links, n_copies) for ``docs`` (doc_id,
    text), and ``key`` (see ``row_key``), ``has_words`` and ``stays``: this key is
    the least of its class by doc_id (NULL last), then text hash."""
    spark = docs.sparkSession
    python_tasks(spark)
    least = least_matches(threshold, tolerance)
    docs = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    sketched = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _sketcher()("text").alias("s"))
    sketched = staged(sketched.select("doc_id", "text_hash", "s.*"), "sketch")
    own = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")
    some = sketched.where(F.col("seq").isNotNull())
    reps = some.groupBy("seq").agg(F.min(own).alias("least"), F.count(F.lit(1)).alias("copies"),
                                   F.first("n_words").alias("n_words"), F.first("bands").alias("bands"))
    reps = staged(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")

    banded = reps.select("rep", F.posexplode("bands").alias("band", "value"))
    shared = banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = banded.join(shared, ["band", "value"]).join(reps.select("rep", "bands"), "rep")
    met = _blocked(members, ["band", "value"], F.ceil(F.col("n") / bucket_block), ["rep", "bands"])
    edges = met.mapInArrow(_candidates(least), "a bigint, b bigint")
    clusters = staged(components(edges, "candidates").withColumnsRenamed({"node": "rep", "root": "cluster"}), "clusters")

    inside = reps.join(clusters, "rep")
    size = inside.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"))
    wanted = inside.select(F.col("least.doc_id").alias("least_doc"))
    n_bits = int(min(FILTER_BITS, max(1 << 16, 16 * clusters.count())))
    place = F.pmod(F.xxhash64("least_doc"), F.lit(n_bits))
    found = wanted.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits"))
    bits = np.zeros(n_bits // 64 + 1, np.int64)
    for r in found.toLocalIterator():
        bits[r["w"]] = r["bits"]
    sets = _shingle_sets(spark.sparkContext.broadcast(bits.view(np.uint64)), n_bits)
    exact = _exact_sets(docs, sets(F.pmod(F.xxhash64("doc_id"), F.lit(n_bits)), F.col("text")))
    exact = exact.join(inside.select("seq", "rep"), "seq").groupBy("rep").agg(F.first("shingles").alias("shingles"))
    rows = inside.join(size, "cluster").join(exact, "rep")
    blocks = F.greatest(F.ceil(F.col("n") / cluster_block), F.ceil(F.col("words") / CLUSTER_WORDS))
    met = _blocked(rows, ["cluster"], blocks, ["rep", "copies", "bands", "shingles"])
    linked = staged(met.mapInArrow(_verified(least, threshold), "rep bigint, root bigint, links bigint, docs bigint"), "links")

    degree = linked.groupBy("rep").agg(F.sum("links").alias("links"), F.sum("docs").alias("docs"))
    roots = components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")), "classes").withColumnRenamed("node", "rep")
    whole = reps.select("rep", "seq", "least", "copies").join(degree, "rep", "left").join(roots, "rep", "left")
    whole = whole.withColumn("root", F.coalesce("root", "rep"))
    heads = whole.groupBy("root").agg(F.min("least").alias("head"))
    table = whole.join(heads, "root").select("seq", "head", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("docs", F.lit(0)).alias("docs"))
    out = sketched.select("doc_id", "text_hash", "seq").join(table, "seq", "left")
    return out.select(
        "doc_id", F.when(F.col("seq").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        (F.coalesce("docs", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("bigint").alias("n_links"),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_text_links"), F.coalesce("copies", F.lit(1)).cast("bigint").alias("n_copies"),
        row_key(F.col("doc_id"), F.col("text_hash")).alias("key"), F.col("seq").isNotNull().alias("has_words"),
        (F.col("seq").isNull() | (F.col("head") == own)).alias("stays"))


def row_key(doc_id: Column, text_hash: Column) -> Column:
    """Text that tells rows apart by doc_id (NULL included) and text."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), text_hash.cast("string"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near duplicates: of each class the least document stays
    (one of its repeated rows); all columns as they were.

    Rows without words stay by their text alone and meet no shuffle.  Rows alike
    in doc_id and text fold into one in the tasks that read them, so that a row
    repeated any number of times reaches the exchange once from each task."""
    keyed = pack(docs).withColumn("key", row_key(F.col("row.doc_id").cast("bigint"), F.xxhash64(F.col("row.text"))))
    worded = F.btrim(F.coalesce(F.col("row.text"), F.lit("")), F.lit(WORD_SEPARATORS)) != ""
    found = jaccard_classes(docs, **options).where("stays and has_words").select("key").distinct()
    one = keyed.where(worded).groupBy("key").agg(F.first("row").alias("row")).join(found, "key")
    return one.select("row.*").unionAll(keyed.where(~worded).select("row.*"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_classes(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "class_id", "n_links", "n_text_links", "n_copies")
