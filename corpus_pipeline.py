"""The corpus pipeline: five stages over the documents, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import stages
from tidelog.llm.shared import keep

#: (name, function of (spark, docs, sf_dir)) in order.
STAGES = [
    ("quality_rules", stages.keep_good),
    ("jaccard_join", stages.keep_one_of_each),
    ("substring_dedup", stages.cut_repeats),
    ("source_mix", stages.mix_sources),
    ("bpe_encode", stages.encode),
]
#: SQL can express neither the cutoffs of the first stage nor the encoding of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
