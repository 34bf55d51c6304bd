"""The training-data pipeline: documents through language, quality, near-duplicate, benchmark and token stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and gives the reread table to the next stage. All stages but the last return documents with their own columns, unchanged but
for the passages that stage 4 cuts.

1. ``language_id``: documents without a language, or with an ambiguous one, go.
2. ``quality_rules``: documents that fail the base rules or lose too much text by lines go.
3. ``simhash_near_dedup``: of each component of near copies the row with the smallest doc_id stays (of rows
   of equal id any one; rows with null ids stay only where a component has no other).
4. ``benchmark_decontamination``: contaminated documents go, and benchmark passages are cut out of the others.
5. ``bpe``: token counts and digests of what is left, one row per document.

A null text has no language and goes in stage 1. Empty tables pass through all stages as empty tables. Extra columns are kept until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import bpe, decontaminate, language, line_quality, simhash_vp
from tarmac.llm.queries import VOCABULARY
from tarmac.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs.where(~language.held_out()))
    return language.keep_known(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.clean(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_vp.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, VOCABULARY, forget=True)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe", tokens),
]

#: language identification and tokens have no SQL; the tests compare every stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
