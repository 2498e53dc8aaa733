"""Fixtures with the awkward cases every operator must take."""

import pytest
from pyspark.sql import functions as F

#: Names that operators use inside; as extra columns they must not disturb.
CLASHING = ["row", "key", "score", "kept", "n_words", "size", "rank", "position", "lang_pred", "seq", "rep", "uid", "u", "h", "tie",
            "stratum", "found", "spans", "items", "host", "path", "verdict", "label", "words", "target", "f", "p", "n"]

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = "the quick brown fox jumps over the lazy dog while seven other animals watch from behind an old stone wall and say nothing at all"


def rows():
    long = " ".join(f"word{k} and" for k in range(30_000))
    return [
        (1, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1),  # copies
        (3, PROSE + " today", "en", "b", 1),  # near copy
        (4, None, "en", "a", None), (5, "", None, "b", 0), (6, " \n\t ", "en", None, 3), (7, "!!! 123 ...", "de", "c", 1),
        (8, "eins zwei", "de", "c", 1), (None, PROSE + " again and again", None, None, None), (None, None, None, None, None),
        (9, long, "en", "a", 1), (10, "kurz", "de", "b", 1), (10, "kurz", "de", "b", 1), (10, "kurz", "de", "b", 1),  # repeated rows
        (11, "mail bob@example.com or call +1 (555) 123-4567 now", "en", "c", 1),
    ]


def with_clashes(df):
    return df.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(CLASHING)])


@pytest.fixture()
def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def clashing(awkward):
    return with_clashes(awkward)


@pytest.fixture(scope="session")
def tables(tmp_path_factory, spark):
    """A folder like the driver's, holding the awkward rows."""
    folder = tmp_path_factory.mktemp("awkward")
    with_clashes(spark.createDataFrame(rows(), SCHEMA)).write.parquet(f"{folder}/documents.parquet")
    bench = [("q1", PROSE), ("q1", PROSE), (None, "eins zwei"), ("q3", None), ("q4", "")]
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    marks = [(1, 1, 0), (2, 1, 0), (2, 0, 0), (3, 1, 0), (7, 0, 1), (8, 0, 0), (10, 0, 0), (None, 1, 0), (11, None, 0), (99, 1, 0)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    pages = [(1, "http://A.example.com/en/x?q#f"), (2, None), (3, "no scheme"), (4, "http://com"), (5, "x://www.example.com/en/"), (5, "x://www.example.com/en/"),
             (None, "http://b.net/es/y"), (6, "http://"), (7, "http://xnet/es/"), (8, "http://é.Ö/p?a=://z")]
    with_clashes(spark.createDataFrame(pages, "page_id bigint, url string")).write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def empty_tables(tmp_path_factory, spark):
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id string, text string"), ("labels", "doc_id bigint, quality int, toxic int"),
                         ("pages", "page_id bigint, url string")):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
