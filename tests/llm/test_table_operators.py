"""Joins, mixing, URL filter, pipeline and SQL twins."""

import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tollgate.llm import curriculum, jaccard_join, token_output, url_cascade
from tollgate.llm.catalog import ORACLE, QUERIES
from tollgate.llm.common import read_table, staged

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

SMALL = "/root/testdata/sf0.001"


# n-gram Jaccard join -----------------------------------------------------

def brute_classes(docs):
    """doc rows [(doc_id, text)] -> [(class_id, n_links, n_text_links, n_copies)]."""
    words = [tuple(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in docs]
    same = defaultdict(list)
    for k, w in enumerate(words):
        same[w].append(k)
    texts = [w for w in same if w]
    sets = {w: {w[i:i + 5] for i in range(len(w) - 4)} or {w} for w in texts}
    group = {w: w for w in texts}

    def find(w):
        while group[w] != w:
            w = group[w]
        return w
    links = defaultdict(list)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a].append(b)
                links[b].append(a)
                group[find(a)] = find(b)
    least = defaultdict(list)
    for w in texts:
        least[find(w)] += [docs[k][0] for k in same[w] if docs[k][0] is not None]
    out = []
    for (doc, _), w in zip(docs, words):
        if not w:
            out.append((doc, doc, 0, 0, 1))
        else:
            out.append((doc, min(least[find(w)], default=None), sum(len(same[b]) for b in links[w]) + len(same[w]) - 1, len(links[w]), len(same[w])))
    return out


def near_copies(seed, n):
    rnd = random.Random(seed)
    docs = []
    for k in range(n):
        if docs and rnd.random() < 0.75:
            w = rnd.choice(docs).split()
            for _ in range(rnd.randint(0, 2)):
                i = rnd.randrange(len(w))
                w[i:i + rnd.randint(0, 1)] = [f"n{rnd.randrange(50)}"]
            docs.append(" ".join(w))
        else:
            docs.append(" ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.choice([1, 3, 4, 5, 6, 30, 80, 150]))))
    return [(k, t) for k, t in enumerate(docs)]


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 4)])
def test_jaccard_join_against_brute_force(spark, seed, block):
    docs = near_copies(seed, 250)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = jaccard_join.jaccard_classes(df, bucket_block=block, cluster_block=block)
    got = sorted(tuple(r)[:5] for r in got.collect())
    assert sum(r[3] for r in got) > 50
    assert got == sorted(brute_classes(docs))


def test_jaccard_join_awkward(spark, awkward, tables, empty_tables, clashing):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    def key(r):
        return tuple((x is not None, x or 0) for x in r)
    got = jaccard_join.op1_ngram_jaccard_join(spark, tables).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_classes(docs), key=key)
    assert jaccard_join.op1_ngram_jaccard_join(spark, empty_tables).count() == 0
    kept = jaccard_join.one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = sorted((r.doc_id or 0) for r in kept.collect())
    assert ids == [0, 1, 4, 5, 6, 7, 8, 9, 10, 11]  # of 1, 2, 3, None one stays; one of the three 10s; the wordless all


def test_repeated_rows_fold_and_wordless_rows_stay(spark):
    rows = [(None, "one two three four five six", "a")] * 3000 + [(None, None, "a")] * 3000 + [(7, " ", "b")] * 5 + [(8, "one two three  four five six", "c")]
    kept = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, key string"))
    got = sorted(((r.doc_id or 0), r.text or "", r.key) for r in kept.collect())
    assert got == [(0, "", "a")] * 3000 + [(7, " ", "b")] * 5 + [(8, "one two three  four five six", "c")]


def test_shingle_sets_are_made_once(spark, awkward, monkeypatch):
    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name)
    monkeypatch.setattr(jaccard_join, "staged", noted)
    jaccard_join.jaccard_classes(awkward)
    # Two in one stage are two Python workers for each of its tasks.
    assert plans["sketch"].count("ArrowEvalPython") == 1
    assert plans["links"].count("ArrowEvalPython") == 1


# mixing ------------------------------------------------------------------

def plain_targets(sizes):
    """sizes: {source: words}; reshare by hand."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3.0 * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_targets_and_taken_words(spark):
    rnd = random.Random(3)
    docs = [(k, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 300])), rnd.choice(["s1"] * 9 + ["a", "b", None, "é", "Z"])) for k in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = curriculum.mixed(df, range_rows=20).collect()
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(t.split())
    target, taken = plain_targets(sizes), Counter()
    for r in rows:
        assert r.size == len(r.row.text.split()) and r.source_size == sizes[r.row.source]
        assert r.target == pytest.approx(target[r.row.source])
        assert 0 <= r.taken <= 3 * r.size and len(r.positions) == -(-r.taken // max(r.size, 1))
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        taken[r.row.source] += r.taken
    for s, n in taken.items():
        assert n == int(target[s] + 1e-9)
    again = curriculum.mixed(df.repartition(7), range_rows=20).collect()
    assert sorted((r.row.doc_id, r.taken, r.positions) for r in again) == sorted((r.row.doc_id, r.taken, r.positions) for r in rows)
    whole = curriculum.mixed(df, range_rows=20, whole_documents=True).collect()
    assert all(r.taken % max(r.size, 1) == 0 for r in whole)


def test_inverse_demand_inverts_the_integral(spark):
    knots = ((0.0, 1.5), (0.3, 0.2), (0.3 + 0.3, 0.0), (1.0, 2.0))
    def area(t):
        out = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            d = min(max(t - t0, 0.0), t1 - t0)
            out += w0 * d + (w1 - w0) / (t1 - t0) * d * d / 2
        return out
    rows = spark.range(101).select((F.col("id") / 100).alias("x")).select("x", curriculum.inverse_demand(F.col("x"), knots).alias("t")).collect()
    for r in rows:
        assert area(r.t) / area(1.0) == pytest.approx(r.x, abs=1e-9)


def test_rising_sources_come_later(spark):
    docs = [(k, "w w w", f"s{k % 3}") for k in range(3000)]
    rows = curriculum.mixed(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    mean = {s: [p for r in rows if r.row.source == s for p in r.positions] for s in ("s0", "s1", "s2")}
    mean = {s: sum(p) / len(p) for s, p in mean.items()}
    assert mean["s0"] < mean["s2"] - 0.05 < mean["s1"] - 0.1


def test_mixing_awkward(spark, tables, empty_tables, clashing):
    rows = curriculum.op10_curriculum_mix(spark, tables).collect()
    assert len(rows) == 15 and all(r.taken == 0 and r.position is None for r in rows if r.size == 0)
    assert curriculum.op10_curriculum_mix(spark, empty_tables).count() == 0
    assert curriculum.training_order(clashing).columns == clashing.columns


# URL filter --------------------------------------------------------------

def plain_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in url_cascade.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


@pytest.mark.parametrize("bits, inline", [(1 << 20, 32 << 20), (256, 32 << 20), (256, 600), (1024, 0)])
def test_cascade_is_exact(spark, monkeypatch, bits, inline):
    monkeypatch.setattr(url_cascade, "INLINE_BYTES", inline)
    keys = spark.range(5000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 13 == 0).alias("listed"))
    cascade = url_cascade.build_cascade(keys, segment_bits=bits)
    assert len(cascade.levels) > 1 and (cascade.segments > 1) == (bits <= 1024)
    assert (len(cascade.parts()) > 1) == (inline <= 600) and [k for a, b in cascade.parts() for k in range(a, b)] == list(range(cascade.segments))
    hot = spark.range(2000).select(F.lit("host13").alias("key"), F.lit(True).alias("listed")).union(spark.createDataFrame([(None, False)] * 3, "key string, listed boolean"))
    got = cascade.mark(keys.union(hot), "key", "said")
    assert got.count() == 7003 and got.where("said <> listed").count() == 0
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_cascade_of_nothing(spark):
    keys = spark.range(20).select(F.col("id").cast("string").alias("key"), F.lit(False).alias("listed"))
    assert url_cascade.build_cascade(keys).mark(keys, "key", "said").where("said").count() == 0
    every = keys.withColumn("listed", F.lit(True))
    assert url_cascade.build_cascade(every).mark(every, "key", "said").where("said").count() == 20


def test_url_filter(spark, tables, empty_tables):
    pages = read_table(spark, tables, "pages")
    rows = url_cascade.judged(pages, spark.createDataFrame([("http-none",), ("com",), ("",)], "key string")).collect()
    assert len(rows) == 10
    for r in rows:
        host, path, rule, verdict = plain_url(r.row.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if host in ("com", "") else "allow"))
    assert url_cascade.op9_url_filter(spark, empty_tables).count() == 0


# pipeline and SQL --------------------------------------------------------

def test_pipeline_stages_against_plain_versions(spark):
    from llm.tests_llm_plain import brute_hits
    docs = read_table(spark, SMALL, "documents")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontaminate", "mix_sources", "token_output"]
    kept = [sorted(texts)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SMALL), "test")
        assert docs.columns == columns
        rows = docs.collect()
        assert all(texts[r.doc_id] == r.text for r in rows)
        kept.append(sorted(r.doc_id for r in rows))
    assert len(kept[1]) >= 0.98 * len(kept[0])
    classes = {c[1] for c in brute_classes([(d, texts[d]) for d in kept[1]])}
    assert kept[2] == sorted(classes)
    items = [(str(r.item_id), r.text) for r in read_table(spark, SMALL, "benchmark").collect()]
    assert kept[3] == [d for d in kept[2] if brute_hits(texts[d], items)[1] == 0]
    assert set(kept[4]) <= set(kept[3]) and max(Counter(kept[4]).values()) <= 3
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert sorted(r.doc_id for r in out) == kept[4]


@pytest.fixture()
def many_files(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_pipeline_keeps_the_training_order(spark, many_files):
    """The result follows the schedule; the token files do not move."""
    docs = spark.createDataFrame([(k, f"w w{k} w", f"s{k % 3}") for k in range(600)], "doc_id long, text string, source string")
    found = {}
    for name, schedules in (("given", curriculum.SCHEDULES), ("turned", curriculum.SCHEDULES[1::-1] + curriculum.SCHEDULES[2:])):
        order = curriculum.mixed(docs, schedules=schedules, whole_documents=True).select("row.doc_id", F.explode("positions").alias("position")).collect()
        mixed = staged(curriculum.training_order(docs, schedules=schedules), "test")
        assert len(mixed.inputFiles()) > 2  # places run over file borders
        rows = corpus_pipeline.STAGES[-1][1](spark, mixed, SMALL).collect()
        by_rank = sorted(rows, key=lambda r: r.rank)
        assert [r.rank for r in by_rank] == list(range(len(order)))
        assert [r.doc_id for r in by_rank] == [r.doc_id for r in sorted(order, key=lambda r: (r.position, r.doc_id))]
        found[name] = [r.doc_id for r in by_rank], sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows)
    assert found["given"][0] != found["turned"][0]
    assert found["given"][1] == found["turned"][1]


def test_index_by_rank_lies_beside_the_tokens(spark, monkeypatch):
    paths = []
    write = token_output.write_tokens
    monkeypatch.setattr(token_output, "write_tokens", lambda *a: paths.append(write(*a)) or paths[-1])
    docs = spark.createDataFrame([(k, f"w{k}") for k in (5, 3, 9, 3)], "doc_id long, text string").coalesce(1)
    token_output.ordered_output(staged(docs, "test"))
    rows = spark.read.parquet(token_output.index_path(paths[0])).collect()
    assert [(r.rank, r.doc_id) for r in sorted(rows, key=lambda r: r.rank)] == [(0, 5), (1, 3), (2, 9), (3, 3)]
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [3, 3, 5, 9]


def test_pipeline_awkward(spark, tables, empty_tables):
    assert corpus_pipeline.run(spark, tables).count() > 0
    assert corpus_pipeline.run(spark, empty_tables).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)

    def tidy(row):
        return tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    assert Counter(tidy(r) for r in got.select(columns).collect()) == Counter(map(tidy, cursor.fetchall()))


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(ORACLE) <= set(entry.oracle_sql())
