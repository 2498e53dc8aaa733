"""Driver contract and the oracle comparison on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tollgate.plans.catalog import QUERIES
from tollgate.plans.oracle import ORACLE
from tollgate.sources.tables import TABLES

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["item_id", "decision", "threat_type", "severity", "confidence", "n_findings"]
    assert df.count() == 200


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    got = _rows(df.columns, df.collect())
    cur = duck.execute(oracle_sql()[name])
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert got == want


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_key_shuffle(spark):
    """Detection, assembly and decision are narrow: the only exchange allowed
    is the round-robin spread of a single-split scan."""
    plan = _plan(entry(spark))
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_spread_is_noop_on_many_splits(spark):
    from tollgate.plans.sizing import spread_for_cpu
    wide = spark.range(0, 1000, 1, spark.sparkContext.defaultParallelism * 2)
    assert spread_for_cpu(wide) is wide
    narrow = spark.range(0, 1000, 1, 1)
    assert spread_for_cpu(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_retry_resolve_is_one_partial_aggregate(spark):
    plan = _plan(queries()["retry_resolve"](spark, SF_SMALL))
    assert "partial_min" in plan and "Window" not in plan


@pytest.mark.parametrize("name", ["detect_pii", "detect_secrets", "detect_sql", "detect_path",
                                  "rule_scan"])
def test_detectors_run_once_not_in_scan_filters(spark, name):
    """No regex may be pushed into a scan filter (it would run twice, the
    first time before the rows are spread over the cores)."""
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln or "Scan parquet" in ln]
    assert scans and not any("regexp" in ln or "RLike" in ln for ln in scans)


def test_spread_skips_inputs_that_nearly_fill_the_cluster(spark):
    from tollgate.plans.sizing import spread_for_cpu
    cores = spark.sparkContext.defaultParallelism
    almost = spark.range(0, 1000, 1, max(cores // 2, 1) + 1)
    assert spread_for_cpu(almost) is almost
