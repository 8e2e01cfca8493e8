"""Five stages from ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all
but the last return the columns of ``documents``. Between stages the rows are written as
Parquet to the shared folder and read again.

1. language: texts in no language (null, or without a letter) go; the others carry the network's language in ``lang``,
   which the mixing weighs by.
2. near_duplicates: of each group the document with the smallest id stays; documents are linked
at a similarity of 0.85 or more, as in op2.
3. repeats: bytes of 50-byte strings that an earlier document has go; documents of which nothing
   is left go.
4. mixing: documents are drawn to the raked source, language and topic weights, half of all tokens
in expectation; cells too small for their weight are taken whole.
5. packing: the pieces of the sequences, with their places.

Rows with a null id pass the first three stages as their operators say; rows with equal ids are
one document to the second. An empty table gives an empty result. Texts are worked on whole, however
long; one must fit into a task. Columns beyond those of ``documents`` are kept up to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import langid, minmax, mixing, packing, suffixdedup
from tessera.llm.common import prepare, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return langid.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    gone = minmax.near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffixdedup.remove_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats), ("mixing", mix),
          ("packing", pack)]

#: A recurrent network and a vocabulary have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
