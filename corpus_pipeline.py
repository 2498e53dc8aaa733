"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and rereads it as the next one's ``docs``.
All but the last return the columns of ``docs`` as they were:

1. ``language_id`` drops documents whose language is undetermined;
2. ``near_duplicates`` keeps one document of each class of near copies;
3. ``decontaminate`` drops documents that hold a benchmark window;
4. ``mix_sources`` takes every document as often as its source's target asks
   (0 to 3 whole copies) and range-sorts the copies by training position;
5. ``token_output`` writes DAC token files in order of doc_id and, beside them,
   an index by training rank (the place of a copy in stage 4's files), and
   returns that index (rank, doc_id, start, n_tokens, ids_crc32), read back
   from the files.

Defined cases: a NULL, empty or letterless text goes in stage 1; repeated rows
are copies of one document and one stays; of a class the least doc_id stays, NULL
last; a document with a NULL doc_id is kept and mixed like any other and comes
first in the token files; a NULL source is a source of its own; very long texts
pass every stage whole; empty tables give an empty index; an empty benchmark
drops nothing; further columns of ``documents`` pass through to stage 4, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import curriculum, decontaminate, jaccard_join, language_id, token_output
from tollgate.llm.common import read_table, staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum.training_order(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.ordered_output(docs)


STAGES = [("language_id", identify_language), ("near_duplicates", drop_near_duplicates), ("decontaminate", drop_contaminated),
          ("mix_sources", mix_sources), ("token_output", write_token_ids)]

#: Neither the classifier nor the tokenizer can be written in SQL; tests/llm
#: holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
