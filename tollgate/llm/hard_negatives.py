"""Hard negatives of anchors, exact, behind rotated one-bit codes.

Every vector is scaled to whole numbers, rotated (two rounds of random signs
and Hadamard transform) and described by ``LEVELS`` one-bit codes: the signs of
the rotated vector, then the signs of what the first code leaves over, and so
on.  With c the unit vector of a code, its *alignment* a = <rest, c> and the
norm of what is left are stored beside the bits.  An anchor is rotated too and
cut into ``PLANES`` bit planes, so that <c, anchor> is a sum of popcounts; what
the planes miss is known exactly and bounded by its norm.  After each code the
true score lies within

    estimate +- rest * sqrt(|anchor|^2 - <c, anchor>^2)  (+ plane error)

for certain (Cauchy-Schwarz: what is left is orthogonal to c).  A pair whose
interval cannot reach what is sought goes no further; pairs that survive all
codes are scored in integers.  No pair is lost, so the result is exact.

Anchors are cut into blocks of ``BLOCK_ANCHORS``, which a task holds, and rows
are dealt into shards, which it streams past them: a tile is one (block, shard).
What leaves a tile is at most a handful of rows for each of its anchors.  The
first pass over the tiles finds the positives, the second the negatives in the
score window of each positive.  A hot label or vector makes no tile larger.

Defined cases: rows with a NULL label, a NULL vector, or a component that is
NULL or not finite (also after scaling) take no part.  Vectors of differing
length are compared as if the shorter one went on with zeros.  Ties go to the
smaller id, a NULL id being last; a row with the anchor's id is none of its
positives, and repeated rows count each.  An anchor that is repeated as a whole row counts once.  Scores
beyond 64 bits are held at their ends.  An anchor without another row of its
label, or without a row in a window, gives no rows; an empty table gives none.
Texts and further columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import python_tasks, read_table, staged
from tollgate.llm.textvec import give_back

LEVELS = 4
PLANES = 8
BLOCK_ANCHORS = 8192
#: Rows of a shard at most; fewer where that keeps all cores busy.
SHARD_ROWS = 4_000_000
TILES_PER_CORE = 3
#: Pairs held at once by the kernel.
PAIRS = 1 << 18
#: Relative width that makes up for rounding in the intervals.
SLACK = 1e-9
SEED = 20240611
LONG = (1 << 63) - 1
_NONE = -LONG - 1


# codes -------------------------------------------------------------------

def padded(dim: int) -> int:
    """Components after rotation: a power of two, whole 64-bit words."""
    return max(64, 1 << (max(dim, 1) - 1).bit_length())


def rotate(x: np.ndarray) -> np.ndarray:
    """The same orthogonal map for every row; norms and inner products stay."""
    n, dim = x.shape
    size = padded(dim)
    y = np.zeros((n, size))
    y[:, :dim] = x
    rng = np.random.default_rng(SEED)
    for _ in range(2):
        y = y * rng.choice([-1.0, 1.0], size)
        half = 1
        while half < size:
            z = y.reshape(n, size // (2 * half), 2, half)
            y = np.stack([z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]], 2).reshape(n, size)
            half *= 2
        y /= np.sqrt(size)
    return y


def _words(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8")


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, alignments, norms left) of each row: n x LEVELS x words of 64
    bits, n x LEVELS and n x LEVELS."""
    rest = rotate(x)
    n, size = rest.shape
    bits, align, left = [], [], []
    for _ in range(LEVELS):
        sign = rest >= 0
        a = np.abs(rest).sum(1) / np.sqrt(size)
        rest = rest - (a / np.sqrt(size))[:, None] * np.where(sign, 1.0, -1.0)
        bits.append(_words(sign))
        align.append(a)
        left.append(np.sqrt((rest * rest).sum(1)))
    shape = (n, LEVELS)
    return np.stack(bits, 1).reshape(n, LEVELS, -1), np.stack(align, 1).reshape(shape), np.stack(left, 1).reshape(shape)


class Anchors:
    """Anchors of a block, prepared for the popcounts."""

    def __init__(self, x: np.ndarray):
        y = rotate(x)
        self.x, self.size = x, y.shape[1]
        low, high = y.min(1, initial=0.0), y.max(1, initial=0.0)
        self.step = np.where(high > low, (high - low) / ((1 << PLANES) - 1), 1.0)
        self.low = low
        u = np.rint((y - low[:, None]) / self.step[:, None]).astype(np.uint64)
        missed = y - (low[:, None] + u * self.step[:, None])
        self.error = np.sqrt((missed * missed).sum(1))
        self.norm = np.sqrt((y * y).sum(1))
        self.planes = np.stack([_words((u >> np.uint64(k)) & np.uint64(1) == 1) for k in range(PLANES)], 1)
        self.total = u.sum(1).astype(float)

    def along(self, a: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """<c, planes of the anchor> for anchors ``a`` and code bits that
        broadcast against each other (words last)."""
        set_sum = _count(self.planes[a, 0] & bits)
        for k in range(1, PLANES):
            set_sum += _count(self.planes[a, k] & bits) << np.uint32(k)
        ones = _count(bits).astype(float)
        return (self.low[a] * (2.0 * ones - self.size) + self.step[a] * (2.0 * set_sum - self.total[a])) / np.sqrt(self.size)


def _count(words: np.ndarray) -> np.ndarray:
    """Bits set in the words of the last axis."""
    each = np.bitwise_count(words)
    return each[..., 0].astype(np.uint32) if each.shape[-1] == 1 else each.sum(-1, dtype=np.uint32)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, row by row, exact; beyond 64 bits held at the ends."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < 2 ** 53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    out = [sum(int(p) * int(q) for p, q in zip(x, y)) for x, y in zip(a.tolist(), b.tolist())]
    return np.array([max(_NONE + 1, min(LONG, s)) for s in out], np.int64)


# tiles -------------------------------------------------------------------

class Best:
    """The ``size`` best (score, id) of each key so far: higher scores first,
    then smaller ids, missing ids last."""

    def __init__(self, keys: int, size: int):
        self.score = np.full((keys, size), _NONE, np.int64)
        self.known = np.zeros((keys, size), bool)
        self.id = np.zeros((keys, size), np.int64)

    def worst(self) -> np.ndarray:
        """Scores below this are of no use to a key."""
        return self.score[:, -1]

    def add(self, key: np.ndarray, score: np.ndarray, known: np.ndarray, ident: np.ndarray) -> None:
        if len(key) == 0:
            return
        size = self.score.shape[1]
        touched = np.unique(key)
        key = np.concatenate([np.repeat(touched, size), key])
        score = np.concatenate([self.score[touched].ravel(), score])
        known = np.concatenate([self.known[touched].ravel(), known])
        ident = np.concatenate([self.id[touched].ravel(), ident])
        # Lowest scores stand for nothing and come last.
        order = np.lexsort((ident, ~known, -1 - score, key))
        first = np.searchsorted(key[order], touched)
        pick = order[first[:, None] + np.arange(size)]
        self.score[touched], self.known[touched], self.id[touched] = score[pick], known[pick], ident[pick]

    def listed(self, key: int) -> list[dict]:
        found = zip(self.score[key].tolist(), self.known[key].tolist(), self.id[key].tolist())
        return [{"score": s, "id": i if k else None} for s, k, i in found if s != _NONE]


def _survivors(anchors: Anchors, a: np.ndarray, rows: dict, least: np.ndarray, most: np.ndarray, other_label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, row) whose interval meets the anchor's [least, most] at
    every level; with ``other_label`` (labels of the anchors) only those of
    differing labels."""
    bits, align, left = rows["bits"], rows["align"], rows["left"]
    size = np.sqrt((align * align).sum(1) + left[:, -1] ** 2)
    at, row = np.repeat(a, len(bits)), np.tile(np.arange(len(bits)), len(a))
    estimate, error = 0.0, 0.0
    for level in range(LEVELS):
        if level == 0:  # all pairs: broadcast instead of gathering
            c = anchors.along(a[:, None], bits[None, :, 0]).ravel()
        else:
            c = anchors.along(at, bits[row, level])
        off = anchors.error[at]
        estimate, error = estimate + align[row, level] * c, error + align[row, level] * off
        along = np.maximum(np.abs(c) - off, 0.0)
        reach = left[row, level] * np.sqrt(np.maximum(anchors.norm[at] ** 2 - along * along, 0.0))
        reach += error + SLACK * anchors.norm[at] * size[row] + 1e-6
        # Not a number (components near the end of doubles) proves nothing: such pairs stay.
        # Scores are held at the ends of 64 bits, and so is what they are compared with.
        ok = ~((np.maximum(estimate + reach, -float(LONG)) < least[at]) | (np.minimum(estimate - reach, float(LONG)) > most[at]))
        if level == 0 and other_label is not None:
            ok &= other_label[at] != rows["label"][row]
        at, row, estimate, error = at[ok], row[ok], estimate[ok], error[ok]
    return at, row


def _columns(batch: pa.RecordBatch) -> dict:
    n = batch.num_rows

    def wide(name: str, kind) -> np.ndarray:
        flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
        return flat.astype(kind).reshape(n, -1) if n else np.zeros((0, 0), kind)
    x = wide("x", np.float64)
    bits = wide("bits", np.int64).view(np.uint64).reshape(n, LEVELS, -1)
    ids = batch.column("id")
    return {"x": x, "bits": bits, "align": wide("align", np.float64), "left": wide("left", np.float64),
            "known": ~np.asarray(ids.is_null()), "id": ids.fill_null(0).to_numpy(zero_copy_only=False),
            "label": batch.column("label").to_numpy(zero_copy_only=False)}


class Positives:
    """First pass: the best rows of an anchor's own label."""

    def __init__(self, held: list[dict], size: int):
        self.names = [r["anchor"] for r in held]
        self.known = np.array([r["id"] is not None for r in held])
        self.id = np.array([r["id"] or 0 for r in held], np.int64)
        label = np.array([r["label"] for r in held], np.int64)
        order = np.argsort(label, kind="stable")
        cut = np.flatnonzero(np.diff(label[order])) + 1
        self.by_label = {int(label[g[0]]): g for g in np.split(order, cut) if len(g)}
        self.anchors = Anchors(np.array([r["x"] for r in held], np.float64))
        self.best = Best(len(held), size)

    def see(self, rows: dict) -> None:
        order = np.argsort(rows["label"], kind="stable")
        for g in np.split(order, np.flatnonzero(np.diff(rows["label"][order])) + 1):
            mine = self.by_label.get(int(rows["label"][g[0]])) if len(g) else None
            if mine is not None:
                step = max(1, PAIRS // len(g))
                group = {c: v[g] for c, v in rows.items()}
                for k in range(0, len(mine), step):
                    self._meet(mine[k: k + step], group)

    def _meet(self, a: np.ndarray, rows: dict) -> None:
        worst = self.best.worst()
        at, row = _survivors(self.anchors, a, rows, worst, np.full(len(worst), LONG))
        other = ~(rows["known"][row] & self.known[at]) | (rows["id"][row] != self.id[at])
        at, row = at[other], row[other]
        score = scores(self.anchors.x[at], rows["x"][row])
        good = score >= worst[at]
        self.best.add(at[good], score[good], rows["known"][row[good]], rows["id"][row[good]])

    def rows(self) -> list[dict]:
        return [{"anchor": name, "place": 0, "best": self.best.listed(n)} for n, name in enumerate(self.names)]


class Negatives:
    """Second pass: for each positive the best rows of other labels in its
    window of scores."""

    def __init__(self, held: list[dict], size: int):
        self.names = [r["anchor"] for r in held]
        self.label = np.array([r["label"] for r in held], np.int64)
        self.anchors = Anchors(np.array([r["x"] for r in held], np.float64))
        self.windows = max((len(r["windows"]) for r in held), default=0)
        self.low, self.high = (np.full((len(held), self.windows), v, np.int64) for v in (LONG, _NONE))
        for n, r in enumerate(held):
            for k, w in enumerate(r["windows"]):
                self.low[n, k], self.high[n, k] = w["low"], w["high"]
        self.best = Best(len(held) * self.windows, size)

    def see(self, rows: dict) -> None:
        step = max(1, PAIRS // max(len(rows["label"]), 1))
        for k in range(0, len(self.names) if self.windows else 0, step):
            self._meet(np.arange(k, min(k + step, len(self.names))), rows)

    def _meet(self, a: np.ndarray, rows: dict) -> None:
        need = np.maximum(self.low, self.best.worst().reshape(self.low.shape))
        is_open = need <= self.high
        least, most = np.where(is_open, need, LONG).min(1), np.where(is_open, self.high, _NONE).max(1)
        at, row = _survivors(self.anchors, a, rows, least, most, self.label)
        score = scores(self.anchors.x[at], rows["x"][row])
        for k in range(self.windows):
            good = (score >= need[at, k]) & (score <= self.high[at, k])
            self.best.add(at[good] * self.windows + k, score[good], rows["known"][row[good]], rows["id"][row[good]])

    def rows(self) -> list[dict]:
        found = ((n, k, self.best.listed(n * self.windows + k)) for n in range(len(self.names)) for k in range(self.windows))
        return [{"anchor": self.names[n], "place": k, "best": best} for n, k, best in found if best]


BEST = "array<struct<score:bigint,id:bigint>>"
_ARROW = pa.schema([("anchor", pa.string()), ("place", pa.int32()), ("best", pa.list_(pa.struct([("score", pa.int64()), ("id", pa.int64())])))])
TILE = ["tile", "kind", "anchor", "id", "label", "x", "bits", "align", "left", "windows"]


def _tiles(search: type, size: int) -> Callable:
    """For each tile of a partition, its anchors (they come first) and then its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, state = None, [], None

        def finish() -> Iterator[pa.RecordBatch]:
            if state is not None:
                yield from pa.Table.from_pylist(state.rows(), schema=_ARROW).to_batches()
        for batch in batches:
            at = batch.column("tile").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if at[a] // 2 != tile:
                    yield from finish()
                    tile, held, state = at[a] // 2, [], None
                part = batch.slice(a, b - a)
                if at[a] % 2 == 0:
                    held += part.select(["anchor", "id", "label", "x", "windows"]).to_pylist()
                elif held:
                    if state is None:
                        state = search(held, size)
                    state.see(_columns(part))
        yield from finish()
        give_back()
    return run


# Spark -------------------------------------------------------------------

def _encode(dim: int, scale: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            x = np.zeros((batch.num_rows, dim))
            x[np.arange(dim) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.floor(x * scale) + 0.0
            with np.errstate(all="ignore"):
                bits, align, left = codes(x)

            def lists(v: np.ndarray) -> pa.Array:
                flat = np.ascontiguousarray(v.reshape(len(x), -1))
                return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * flat.shape[1], pa.int32()), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), lists(x), lists(bits.view(np.int64)), lists(align), lists(left)],
                                             ["id", "label", "x", "bits", "align", "left"])
        give_back()
    return run


CODED = "id bigint, label bigint, x array<double>, bits array<bigint>, align array<double>, left array<double>"


def coded(df: DataFrame, ident: Column, vector: Column, label: Column, scale: float = 256.0) -> DataFrame:
    """Whole-number vectors of the rows that take part, with their codes."""
    python_tasks(df.sparkSession)
    rows = df.select(ident.cast("bigint").alias("id"), label.cast("bigint").alias("label"), vector.cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & (F.abs(v * F.lit(scale)) < F.lit(float("inf"))))
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    dim = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    return staged(rows.mapInArrow(_encode(dim, scale), CODED), "one-bit-codes")


def _over_tiles(rows: DataFrame, anchors: DataFrame, search: type, size: int, n_anchors: int, n_rows: int) -> DataFrame:
    """(anchor, place, best): ``search`` over all tiles, the bests of an
    anchor's shards put together."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n_anchors // BLOCK_ANCHORS))
    shards = max(1, -(-TILES_PER_CORE * cores // blocks), -(-n_rows // SHARD_ROWS))
    none = {"anchor": F.lit(None).cast("string"), "windows": F.lit(None).cast("array<struct<low:bigint,high:bigint>>"),
            **{c: F.lit(None).cast(t) for c, t in (("bits", "array<bigint>"), ("align", "array<double>"), ("left", "array<double>"))}}
    held = anchors.withColumn("block", F.pmod(F.hash("anchor"), F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = held.select((F.col("block") * shards + F.col("shard")).alias("tile"), F.lit(0).alias("kind"), *[none[c].alias(c) if c in none and c not in held.columns else F.col(c) for c in TILE[2:]])
    dealt = rows.withColumn("shard", (F.monotonically_increasing_id() % shards).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) if blocks > 1 else dealt.withColumn("block", F.lit(0))
    dealt = dealt.select((F.col("block") * shards + F.col("shard")).alias("tile"), F.lit(1).alias("kind"), *[none[c].alias(c) if c not in dealt.columns else F.col(c) for c in TILE[2:]])
    tiles = held.unionByName(dealt).repartitionById(blocks * shards, F.col("tile")).sortWithinPartitions("tile", "kind")
    found = tiles.mapInArrow(_tiles(search, size), f"anchor string, place int, best {BEST}")
    entry = lambda e: F.struct((-e["score"]).alias("down"), e["id"].isNull().alias("unknown"), e["id"].alias("id"))
    best = found.groupBy("anchor", "place").agg(F.flatten(F.collect_list("best")).alias("all"))  # at most ``size`` from each shard
    best = best.withColumn("best", F.slice(F.array_sort(F.transform("all", entry)), 1, size))
    return best.select("anchor", "place", F.transform("best", lambda e: F.struct((-e["down"]).alias("score"), e["id"].alias("id"))).alias("best"))


def hard_negatives(df: DataFrame, ident: Column, vector: Column, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 3,
                   percent: tuple[int, int] = (50, 95), scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    for the rows where ``is_anchor`` (of the column ``id``) holds.

    A negative's score lies between the two percentages of the positive's."""
    rows = coded(df, ident, vector, label, scale)
    anchors = rows.where(is_anchor).select("id", "label", "x").dropDuplicates()
    anchors = staged(anchors.withColumn("anchor", F.md5(F.to_json(F.struct("id", "label", "x")).cast("binary"))), "anchors")
    n_anchors, n_rows = anchors.count(), rows.count()
    found = staged(_over_tiles(rows, anchors, Positives, positives, n_anchors, n_rows), "positives").select("anchor", F.col("best").alias("found"))
    exact = lambda score, share: score.cast("decimal(20,0)") * F.lit(share) / F.lit(100)
    windows = F.transform("found", lambda e: F.struct(F.ceil(exact(e["score"], percent[0])).cast("bigint").alias("low"), F.floor(exact(e["score"], percent[1])).cast("bigint").alias("high")))
    sought = staged(anchors.join(found, "anchor").where(F.size("found") > 0).withColumn("windows", windows), "windows")
    best = _over_tiles(rows, sought.drop("found"), Negatives, negatives, n_anchors, n_rows)
    best = best.join(sought.select("anchor", F.col("id").alias("anchor_id"), "found"), "anchor").withColumn("positive", F.get("found", F.col("place")))
    best = best.select("anchor_id", "positive", F.posexplode("best").alias("at", "negative"))
    return best.select("anchor_id", F.col("positive.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("negative.id").alias("negative_id"),
                       F.col("positive.score").alias("positive_score"), F.col("negative.score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    label = F.when(table["vec_id"] % 7 == 0, (table["label"] + 1) % 10).otherwise(table["label"])
    return hard_negatives(table, table["vec_id"], table["embedding"], label, F.col("id") % 50 == 0)


ORACLE_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
anchors AS (SELECT * FROM vectors WHERE vec_id % 50 = 0),
positives AS (
  SELECT a.vec_id AS anchor_id, a.label, a.x, v.vec_id AS positive_id, CAST(list_inner_product(a.x, v.x) AS BIGINT) AS positive_score
  FROM anchors a JOIN vectors v ON a.label = v.label AND a.vec_id <> v.vec_id
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY positive_score DESC, v.vec_id) <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, v.vec_id AS negative_id, CAST(list_inner_product(p.x, v.x) AS BIGINT) AS negative_score
  FROM positives p JOIN vectors v ON p.label <> v.label
  WHERE 50 * positive_score <= 100 * negative_score AND 100 * negative_score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id)
QUALIFY row_number() OVER best <= 3
"""
