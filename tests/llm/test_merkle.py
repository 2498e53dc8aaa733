"""Merkle manifest against plain recursion."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tollgate.llm import merkle
from tollgate.llm.common import read_table


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[k:k + 8]) for k in range(0, len(below), 8)])
    return levels


def plain_steps(levels, place):
    steps = []
    for nodes in levels[:-1]:
        run = nodes[place // 8 * 8: place // 8 * 8 + 8]
        steps.append((place % 8, run[:place % 8] + run[place % 8 + 1:]))
        place //= 8
    return steps


def plain_leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows):
    """rows (doc_id, text, lang, source, n_chars) -> sorted result rows."""
    trees = {}
    for doc, text, lang, source, n in rows:
        low = text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf = plain_leaf((doc, source, lang, n, text))
        bad = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        trees.setdefault(lang, []).append((doc is not None, doc or 0, leaf, plain_leaf((doc, source, lang, n, low)) if bad else leaf))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {x: (sorted(trees[x]), plain_levels([r[2] for r in sorted(trees[x])])) for x in names}
    crown = plain_levels([made[x][1][-1][0] for x in names])
    out = []
    for k, x in enumerate(names):
        leaves, levels = made[x]
        for place, (known, doc, leaf, shown) in enumerate(leaves):
            steps, folded = plain_steps(levels, place) + plain_steps(crown, k), shown
            for at, mates in steps:
                folded = h(*mates[:at], folded, *mates[at:])
            proof = h(*(m for _, mates in steps for m in mates))
            out.append((doc if known else None, leaf, levels[-1][0], crown[-1][0], proof, folded, folded == crown[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 100, 513, 4096, 4097, 40000])
def test_positions_are_the_postorder(n):
    """Appending in order of completion, by recursion over runs."""
    height = merkle.height(n)
    assert 8 ** height >= n and (height == 0 or 8 ** (height - 1) < n)
    log = []

    def append(level, place):
        if level:
            for child in range(place * 8, min(place * 8 + 8, -(-n // 8 ** (level - 1)))):
                append(level - 1, child)
        log.append((level, place))
    append(height, 0)
    assert [merkle.position(level, place, n) for level, place in log] == list(range(len(log)))


def test_columns_agree_with_the_plain_formulas(spark):
    cases = [(level, place, n) for n in (1, 5, 8, 9, 64, 70, 5000, 2**40 + 5) for level in range(merkle.height(n) + 1) for place in {0, (-(-n // 8**level)) - 1}]
    df = spark.createDataFrame(cases, "level int, place bigint, n bigint")
    for r in df.select("*", merkle._position(F.col("level"), F.col("place"), F.col("n")).alias("p"), merkle._height(F.col("n")).alias("h")).collect():
        assert (r.p, r.h) == (merkle.position(r.level, r.place, r.n), merkle.height(r.n))


def random_rows(n, langs):
    rnd = random.Random(n)
    return [(rnd.choice([None, rnd.randrange(3 * n)]) if rnd.random() < 0.1 else k, rnd.choice([None, "", "Some TEXT Ä", f"t{k}" * 3]),
             rnd.choice(langs), rnd.choice([None, "s"]), rnd.choice([None, k])) for k in range(n)]


@pytest.mark.parametrize("levels, n", [(4, 300), (1, 300), (1, 700), (2, 700)])
def test_against_plain_trees(spark, levels, n):
    """With small builders several of them stand one above another."""
    rows = random_rows(n, ["hot"] * 30 + ["é", "z", None, ""] + [f"l{k}" for k in range(9)])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = merkle.documents_manifest(docs, levels).collect()
    assert sorted(map(tuple, got), key=repr) == plain_manifest(rows)
    assert not all(r.verified for r in got)


def test_log_is_the_postorder_of_its_trees(spark):
    leaves = [("t" if k % 5 else "u", k, h(str(k))) for k in range(400)]
    forest = merkle.build(spark.createDataFrame(leaves, "t string, k int, digest string"), "t", ["k"], segment_levels=1)
    for tree in ("t", "u"):
        levels = plain_levels([d for t, _, d in leaves if t == tree])
        want = {merkle.position(level, place, len(levels[0])): d for level, nodes in enumerate(levels) for place, d in enumerate(nodes)}
        log = {}
        for r in forest.log.where(F.col("tree") == tree).collect():
            for k in range(0, len(r.nodes), 32):
                log[r["first"] + k // 32] = r.nodes[k:k + 32].hex()
        assert log == want and sorted(log) == list(range(len(log)))
    roots = {r.tree: r.digest for r in forest.roots.collect()}
    for r in merkle.proofs(forest, "k").collect():
        assert merkle.fold(r.digest, [(s.place, s.siblings) for s in r.steps]) == roots["u" if r.k % 5 == 0 else "t"]


def test_manifest_awkward(spark, tables, empty_tables):
    rows = [tuple(r) for r in read_table(spark, tables, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert sorted(map(tuple, merkle.op13_merkle_manifest(spark, tables).collect()), key=repr) == plain_manifest(rows)
    assert merkle.op13_merkle_manifest(spark, empty_tables).count() == 0
