"""The corpus pipeline: from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm.common import documents
from salesmart.llm.near_dedup import near_dedup_stage
from salesmart.llm.packing import packing_stage
from salesmart.llm.quality_model import quality_model_stage
from salesmart.llm.quality_rules import quality_rules_stage
from salesmart.llm.suffix_dedup import suffix_dedup_stage
from salesmart.staging import drop, own_scratch, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def alone(apply: Stage) -> Stage:
    """A stage whose intermediate tables lie in a folder of its own.

    They are let go when a later stage begins that does not read them, so the pipeline never
    holds more than one stage's tables. A stage's result must be written before the next begins.
    """

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with own_scratch(spark, docs):
            return apply(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality_rules", alone(quality_rules_stage)),
    ("quality_classifier", alone(quality_model_stage)),
    ("near_dedup", alone(near_dedup_stage)),
    ("suffix_dedup", alone(suffix_dedup_stage)),
    ("packing", alone(packing_stage)),
]

#: A trained classifier and a randomised join are among the stages; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet before the next reads it.

    What a stage wrote is deleted once the next one's result is there; the last result stays.
    """
    docs, written = documents(spark, sf_dir), []
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
        drop(*written)
        written = [docs]
    with own_scratch(spark, docs):
        return docs
