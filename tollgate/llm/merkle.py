"""Merkle manifest of a dataset as a postorder append log.

Every row is a leaf; the leaves of a group (a *tree*), in order, and then the
groups' roots, form trees in which each run of ``FAN`` nodes has one parent
(a last run may be shorter, even one node).  Builders are aligned: one takes
``FAN ** SEGMENT_LEVELS`` leaves, appends each, and after a leaf all nodes
that this leaf completes.  So a builder's nodes are one stretch of the log, a
tree's log is in postorder, and nodes above the builders are appended by later
builders at positions that are known beforehand: node j of level l is complete
with its last leaf e = min((j + 1) * FAN**l, n) - 1 and stands at
l + e + e // FAN + e // FAN**2 + ... (:func:`position`).  No index is kept:
proofs address siblings by these positions.

:func:`build` writes the log, :func:`proofs` reads it back: one row for each
leaf with its siblings level by level.  A task holds one builder's stretch (at
most 4,681 digests) and the few upper nodes of its path.

Defined cases: NULL values are leaves of their own form (``-``); a NULL group
is a tree before all others; leaves of equal order are ordered by digest, equal
rows stay leaves each; an empty table has no tree, log or row; a text of any
length is hashed in one pass; further columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import learn_fold, lowered_ascii, python_tasks, read_table, staged
from tollgate.llm.ranked import numbered

FAN_BITS = 3
FAN = 1 << FAN_BITS
SEGMENT_LEVELS = 4
#: Levels that a tree of 2**63 leaves has at most.
MOST_LEVELS = 21

LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(0, (max(n, 1) - 1).bit_length() + FAN_BITS - 1) // FAN_BITS


def position(level: int, place: int, n: int) -> int:
    """Where node ``place`` of ``level`` stands in the log of a tree of n leaves."""
    last = min((place + 1) << (FAN_BITS * level), n) - 1
    at = level
    while last:
        at += last
        last >>= FAN_BITS
    return at


def _position(level: Column, place: Column, n: Column) -> Column:
    last = F.least(F.call_function("shiftleft", place + 1, level * FAN_BITS), n) - 1
    steps = F.sequence(F.lit(0), F.lit(MOST_LEVELS - 1))
    return F.aggregate(steps, level.cast("bigint"), lambda s, k: s + F.call_function("shiftright", last, k * FAN_BITS))


def _height(n: Column) -> Column:
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(MOST_LEVELS - 1)), lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), k * FAN_BITS) < n))


def parent(digests: Sequence[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


# leaves ------------------------------------------------------------------

def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: every value as its UTF-8 byte count, ``:`` and itself; NULL as ``-``."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in values]), 256)


def tree_key(c: Column) -> Column:
    """Text that orders as the group does bytewise, NULL first, and is never NULL."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


# building ----------------------------------------------------------------

@dataclass(frozen=True)
class Forest:
    """leaves: tree, block, place, n, digest and the caller's columns.  log: the
    entries of all trees, see ``LOG``.  roots: tree, digest."""
    leaves: DataFrame
    log: DataFrame
    roots: DataFrame
    segment_levels: int


#: An entry: 32 bytes for each node from position ``first`` on, the last of
#: which is node ``place`` of ``level`` of a tree of n leaves.  Builders of
#: leaves write one entry each, later builders one for each node.
LOG = "tree string, n bigint, level int, place bigint, first bigint, nodes binary"


def _completed(digests: list[str], start: int, count: int, most: int) -> Iterator[tuple[int, int, str]]:
    """(level, place, digest) in order of completion: the aligned nodes from
    ``start`` on of a level that has ``count`` nodes in all, and what they complete
    up to ``most`` levels above."""
    levels = min(most, height(count))
    runs: list[list[str]] = [[] for _ in range(levels)]
    for place, digest in enumerate(digests, start):
        yield 0, place, digest
        for level in range(levels):
            runs[level].append(digest)
            if (place + 1) & ((FAN << (FAN_BITS * level)) - 1) and place + 1 != count:
                break
            digest = parent(runs[level])
            runs[level] = []
            yield level + 1, place >> (FAN_BITS * (level + 1)), digest


def _builder(base: int, most: int) -> Callable:
    """Builders whose lowest nodes are those of level ``base``."""
    def build_nodes(key: tuple, table: pa.Table) -> pa.Table:
        tree, n = key[0].as_py(), table.column("n")[0].as_py()
        rows = sorted(zip(table.column("place").to_pylist(), table.column("digest").to_pylist()))
        count = -(-n // FAN ** base)
        made = list(_completed([d for _, d in rows], rows[0][0], count, most))
        if base == 0:
            entries = [(made[-1][0], made[-1][1], position(0, rows[0][0], n), "".join(d for _, _, d in made))]
        else:
            entries = [(base + level, place, position(base + level, place, n), d) for level, place, d in made if level]
        return pa.table({"tree": pa.array([tree] * len(entries), pa.string()), "n": pa.array([n] * len(entries), pa.int64()),
                         "level": pa.array([e[0] for e in entries], pa.int32()), "place": pa.array([e[1] for e in entries], pa.int64()),
                         "first": pa.array([e[2] for e in entries], pa.int64()), "nodes": pa.array([bytes.fromhex(e[3]) for e in entries], pa.binary())})
    return build_nodes


def _block(place: Column, levels: int) -> Column:
    return F.call_function("shiftright", place, F.lit(FAN_BITS * levels))


def _ends(log: DataFrame) -> DataFrame:
    """The last node of every entry, by position."""
    return log.select("tree", "n", "level", "place", (F.col("first") + F.floor(F.octet_length("nodes") / 32) - 1).cast("bigint").alias("at"),
                      F.lower(F.hex(F.substring("nodes", -32, 32))).alias("digest"))


def build(leaves: DataFrame, tree: str, order: Sequence[str], name: str = "merkle", segment_levels: int = SEGMENT_LEVELS) -> Forest:
    """Write the log of the trees over ``leaves``, whose column ``digest`` is
    lowercase hex; the text column ``tree`` names a leaf's tree.  A builder takes
    ``FAN ** segment_levels`` nodes."""
    spark = leaves.sparkSession
    python_tasks(spark)
    rows = numbered(leaves.withColumnRenamed(tree, "tree"), "tree", [*order, "digest"], name)
    rows = staged(rows.withColumn("block", _block(F.col("place"), segment_levels)), f"{name}-leaves")
    slim = rows.select("tree", "block", "place", "n", "digest")
    log = staged(slim.groupBy("tree", "block").applyInArrow(_builder(0, segment_levels), LOG), f"{name}-log")
    most, lower, level = rows.agg(F.max("n")).first()[0] or 0, log, segment_levels
    while height(most) > level:
        tops = _ends(lower).where((F.col("level") == level) & (_height(F.col("n")) > level)).withColumn("block", _block(F.col("place"), segment_levels))
        lower = staged(tops.select("tree", "block", "place", "n", "digest").groupBy("tree", "block").applyInArrow(_builder(level, segment_levels), LOG), f"{name}-log")
        log, level = log.unionByName(lower), level + segment_levels
    roots = _ends(log).where(F.col("level") == _height(F.col("n"))).select("tree", "digest")
    return Forest(rows, log, roots, segment_levels)


# proofs ------------------------------------------------------------------

STEPS = "array<struct<place:int,siblings:array<string>>>"


def _paths(forest: Forest) -> DataFrame:
    """(tree, block, ``upper``): for each builder of leaves the steps from its
    top node to its tree's root.  Siblings are read from the log by position."""
    most = forest.segment_levels
    tops = forest.log.where(F.col("level") <= most).select("tree", "n", F.col("place").alias("block"))
    high = _height(F.col("n"))
    levels = F.when(high > most, F.sequence(F.lit(most), high - 1))
    steps = tops.withColumn("level", F.explode(levels))
    own = F.call_function("shiftright", F.col("block"), (F.col("level") - most) * FAN_BITS)
    count = F.call_function("shiftright", F.col("n") - 1, F.col("level") * FAN_BITS) + 1
    steps = steps.withColumn("own", own).withColumn("run", F.col("own") - F.col("own").bitwiseAND(F.lit(FAN - 1)))
    steps = steps.withColumn("last", F.least(F.col("run") + FAN, count) - 1)
    one = steps.select("tree", "n", "block", "level", "own", F.explode(F.sequence("run", "last")).alias("place"))
    one = one.withColumn("at", _position(F.col("level"), F.col("place"), F.col("n")))
    found = one.join(_ends(forest.log).select("tree", "at", "digest"), ["tree", "at"])
    steps = found.groupBy("tree", "block", "level").agg(
        F.min(F.col("own").bitwiseAND(F.lit(FAN - 1))).cast("int").alias("own_place"),
        F.array_sort(F.collect_list(F.when(F.col("place") != F.col("own"), F.struct("place", "digest")))).alias("others"))
    steps = steps.groupBy("tree", "block").agg(F.array_sort(F.collect_list(F.struct("level", "own_place", "others"))).alias("steps"))
    steps = steps.select("tree", "block", F.transform("steps", lambda s: F.struct(
        s["own_place"].alias("place"), F.transform(s["others"], lambda o: o["digest"]).alias("siblings"))).alias("upper"))
    none = F.array().cast(STEPS)
    return tops.select("tree", "block").join(steps, ["tree", "block"], "left").select("tree", "block", F.coalesce("upper", none).alias("upper"))


def fold(digest: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf's digest and its siblings give."""
    for place, siblings in steps:
        digest = parent([*siblings[:place], digest, *siblings[place:]])
    return digest


def _steps(places: list[int], n: int, first: int, nodes: list[str], most: int) -> Iterator[list[tuple[int, list[str]]]]:
    """For each leaf its steps inside its builder's stretch of the log."""
    levels = min(most, height(n))
    shared: dict[tuple[int, int], list[str]] = {}
    for leaf in places:
        steps = []
        for level in range(levels):
            own = leaf >> (FAN_BITS * level)
            run = own >> FAN_BITS
            if (level, run) not in shared:
                count = -(-n // FAN ** level)
                shared[level, run] = [nodes[position(level, k, n) - first] for k in range(run << FAN_BITS, min((run + 1) << FAN_BITS, count))]
            mates, at = shared[level, run], own & (FAN - 1)
            steps.append((at, mates[:at] + mates[at + 1:]))
        yield steps


_ARROW_STEPS = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))


def _read(forest: Forest, leaves: DataFrame, above: DataFrame | None, rows: Callable[[pa.Table, Iterator], dict], schema: str) -> DataFrame:
    """The columns ``rows(leaves of a block, their steps)`` for every block of
    leaves, and what ``above`` says of their tree; the leaves meet their stretch
    of the log and its path."""
    most = forest.segment_levels
    right = forest.log.where(F.col("level") <= most).select("tree", F.col("place").alias("block"), "first", "nodes")
    paths, more = _paths(forest), []
    if above is not None:
        more = [c for c in above.columns if c not in ("tree", "steps")]
        paths = paths.join(above.withColumnRenamed("steps", "_above"), "tree").withColumn("upper", F.concat("upper", "_above")).drop("_above")
    right = right.join(paths, ["tree", "block"])

    def of_block(left: pa.Table, right: pa.Table) -> pa.Table:
        raw = right.column("nodes")[0].as_py()
        nodes = [raw[k: k + 32].hex() for k in range(0, len(raw), 32)]
        upper = [(s["place"], s["siblings"]) for s in right.column("upper")[0].as_py()]
        n, first = left.column("n")[0].as_py(), right.column("first")[0].as_py()
        found = rows(left, (own + upper for own in _steps(left.column("place").to_pylist(), n, first, nodes, most)))
        return pa.table(found | {c: pa.array(right.column(c).to_pylist() * left.num_rows, pa.string()) for c in more})
    keys = ["tree", "block"]
    schema = ", ".join([schema, *(f"{c} string" for c in more)])
    return leaves.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(of_block, schema)


def proofs(forest: Forest, key: str, above: DataFrame | None = None) -> DataFrame:
    """For each leaf: its column ``key``, digest and ``steps``: for each level
    the leaf's place in its run and its siblings, left to right.  ``above``
    (tree, steps, and text columns to return too) goes on from the trees' roots."""
    def rows(left: pa.Table, steps: Iterator) -> dict:
        steps = [[{"place": p, "siblings": m} for p, m in s] for s in steps]
        return {key: left.column(key), "digest": left.column("digest"), "steps": pa.array(steps, _ARROW_STEPS)}
    kind = forest.leaves.schema[key].dataType.simpleString()
    return _read(forest, forest.leaves.select("tree", "block", "place", "n", key, "digest"), above, rows, f"{key} {kind}, digest string, steps {STEPS}")


def verified(forest: Forest, key: str, candidate: str, above: DataFrame | None = None) -> DataFrame:
    """As :func:`proofs`, with the proof's digest (``proof_sha256``, of all
    siblings in their order) and the root that the digest in the column
    ``candidate`` gives with it (``folded_root``) instead of the steps."""
    def rows(left: pa.Table, steps: Iterator) -> dict:
        proof, folded = [], []
        for digest, s in zip(left.column(candidate).to_pylist(), steps):
            proof.append(parent([x for _, mates in s for x in mates]))
            folded.append(fold(digest, s))
        return {key: left.column(key), "digest": left.column("digest"), "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.string())}
    kind = forest.leaves.schema[key].dataType.simpleString()
    leaves = forest.leaves.select("tree", "block", "place", "n", key, "digest", candidate)
    return _read(forest, leaves, above, rows, f"{key} {kind}, digest string, proof_sha256 string, folded_root string")


@dataclass(frozen=True)
class Manifest:
    """trees: the forest of the rows.  top: the tree over their roots, in order
    of their names.  crown: (tree, steps, subroot, root), a tree's way to the
    root."""
    trees: Forest
    top: Forest
    crown: DataFrame


def manifest(leaves: DataFrame, tree: str, order: Sequence[str], segment_levels: int = SEGMENT_LEVELS) -> Manifest:
    """The log of the trees of ``leaves`` and of the tree over their roots."""
    trees = build(leaves, tree, order, segment_levels=segment_levels)
    top = build(trees.roots.select(F.lit("").alias("all"), F.col("tree").alias("name"), "digest"), "all", ["name"], "merkle-top", segment_levels)
    crown = proofs(top, "name").select(F.col("name").alias("tree"), "steps", F.col("digest").alias("subroot"))
    crown = crown.withColumn("root", top.roots.select("digest").scalar())
    return Manifest(trees, top, staged(crown, "merkle-crown"))


def documents_manifest(docs: DataFrame, segment_levels: int = SEGMENT_LEVELS) -> DataFrame:
    """Every row of documents with its leaf, proof digest and the check of a
    copy whose text is lower-cased where 3 divides crc32(doc_id)."""
    values = [docs[c] for c in LEAF_FIELDS]
    tampered = leaf_digest([*values[:-1], lowered_ascii(docs["text"])])
    leaves = docs.select(tree_key(docs["lang"]).alias("tree"), docs["doc_id"].alias("doc_id"), leaf_digest(values).alias("digest"),
                         F.when(learn_fold(docs["doc_id"]) == 0, tampered).alias("tampered"))
    # Written first: sorting by ranges reads its input twice, and texts are hashed once.
    leaves = staged(leaves, "merkle-digests").withColumn("tampered", F.coalesce("tampered", "digest"))
    made = manifest(leaves, "tree", ["doc_id"], segment_levels)
    return verified(made.trees, "doc_id", "tampered", made.crown).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_manifest(read_table(spark, sf_dir, "documents"))


# SQL ---------------------------------------------------------------------

def _sql_levels(name: str, levels: int) -> list[str]:
    """From ``name``0 (tree, place, digest): nodes of each level, and for the
    leaves the text of the siblings before and after (``name``_path)."""
    out = []
    for k in range(levels):
        out.append(f"{name}{k + 1} AS (SELECT tree, place // {FAN} AS place, sha256(string_agg(digest, '' ORDER BY place)) AS digest "
                   f"FROM {name}{k} WHERE tree IN (SELECT tree FROM {name}{k} GROUP BY tree HAVING count(*) > 1) GROUP BY tree, place // {FAN})")
    steps = " UNION ALL ".join(
        f"SELECT o.tree, o.place, {k} AS level, coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (s.place < o.place), '') AS ahead, "
        f"coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (s.place > o.place), '') AS behind "
        f"FROM {name}{k} o JOIN {name}{k} s ON o.tree = s.tree AND o.place // {FAN} = s.place // {FAN} "
        f"WHERE o.tree IN (SELECT tree FROM {name}{k + 1}) GROUP BY o.tree, o.place" for k in range(levels))
    out.append(f"{name}_step AS ({steps})")
    # The last node of a tree, wherever its levels end.
    tops = " UNION ALL ".join(f"SELECT tree, digest, {k} AS level FROM {name}{k}" for k in range(levels + 1))
    out.append(f"{name}_top AS (SELECT tree, arg_max(digest, level) AS digest FROM ({tops}) GROUP BY tree)")
    return out


def _sql_folds(rows: str, name: str, levels: int, key: str, start: str) -> list[str]:
    """``rows``: (key, tree, place, proof, folded) through the levels of ``name``."""
    out, last = [], rows
    for k in range(levels):
        out.append(f"{start}{k} AS (SELECT r.{key}, r.tree, r.place, r.proof || coalesce(s.ahead || s.behind, '') AS proof, "
                   f"CASE WHEN s.level IS NULL THEN r.folded ELSE sha256(s.ahead || r.folded || s.behind) END AS folded "
                   f"FROM {last} r LEFT JOIN {name}_step s ON s.level = {k} AND s.tree = r.tree AND s.place = r.place // {FAN ** k})")
        last = f"{start}{k}"
    return out


def oracle_sql(levels: int = 8, top_levels: int = 2) -> str:
    """For trees of at most FAN**levels leaves and FAN**top_levels trees."""
    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in (*LEAF_FIELDS[:-1], text)]
        return f"sha256({' || '.join(parts)})"
    bits = "list_reduce(list_concat([xor(c, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))"
    crc = f"xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS UBIGINT))), lambda c, b: {bits}), 4294967295::UBIGINT)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"leaves AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf('text')} AS digest, "
        f"CASE WHEN {crc} % 3 = 0 THEN {leaf(lowered)} END AS tampered FROM documents)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place FROM leaves)",
        "t0 AS (SELECT tree, place, digest FROM ranked)", *_sql_levels("t", levels),
        "u0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, digest, tree AS name FROM t_top)", *_sql_levels("u", top_levels),
        "start AS (SELECT doc_id, digest AS leaf, tree, place, '' AS proof, coalesce(tampered, digest) AS folded, row_number() OVER () AS id FROM ranked)",
        *_sql_folds("start", "t", levels, "id", "f"),
        f"crossed AS (SELECT f.id, u0.tree, u0.place, f.proof, f.folded FROM f{levels - 1} f JOIN u0 ON u0.name = f.tree)",
        *_sql_folds("crossed", "u", top_levels, "id", "g"),
    ]
    return (f"WITH {', '.join(steps)} SELECT s.doc_id, s.leaf, t_top.digest AS subroot, u_top.digest AS root, sha256(g.proof) AS proof_sha256, "
            f"g.folded AS folded_root, g.folded = u_top.digest AS verified FROM start s JOIN g{top_levels - 1} g USING (id) "
            "JOIN t_top ON t_top.tree = s.tree JOIN u_top ON TRUE")


ORACLE_SQL = oracle_sql()
