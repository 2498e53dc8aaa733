"""Helpers shared by the operators: shared storage, Arrow sizing, skew-free ranks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import checkpoint_root, ship_package

#: Characters that separate words: space, tab, LF, VT, FF, CR.
WORD_SEPARATORS = " \t\n\x0b\x0c\r"
#: Rows and bytes of one Arrow batch, so that long texts stay within a worker.
BATCH_ROWS, BATCH_BYTES = 1024, 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def python_tasks(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Before Arrow functions: modules on the executors, and batches bounded
    by rows and bytes (session settings)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: cuts the
    lineage, survives lost executors, and later readers prune columns."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pack(df: DataFrame) -> DataFrame:
    """All columns as the struct ``row``: operators then add columns beside it
    without meeting a user's column of the same name."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"))


def unpack(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def trimmed_words(text: Column) -> Column:
    """Array of the maximal runs of non-separators; NULL and blank: empty.

    One trim and one split on a character class: no lambda over the words and
    no nested regex groups."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SEPARATORS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "[\\x20\\x09-\\x0D]+"))


def word_count(text: Column) -> Column:
    """Number of words as a long."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SEPARATORS))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, "[\\x20\\x09-\\x0D]+"))).cast("long")


def learn_fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3; NULL ids get 1, so that they are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)), F.lit(1)).cast("int")


def lowered_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
