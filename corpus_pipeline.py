"""Training corpus from raw documents: five stages, each a DataFrame operator on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from namesieve.llm.language import language_stage
from namesieve.llm.mixing import mixing_stage
from namesieve.llm.neardups import near_duplicate_stage
from namesieve.llm.packing import packing_stage
from namesieve.llm.privacy import private_data_stage
from namesieve.plans.storage import written

STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("private_data", private_data_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: Trained models, hashed signatures and tokenizers are beyond SQL: the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; what a stage returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
