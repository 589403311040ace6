"""The corpus pipeline: from raw ``documents`` to packed training sequences.

quality -> near duplicates -> benchmark leaks -> personal data -> packing.  Every
stage works on all that its predecessor kept, and its decisions take effect:
rejected documents, near copies and leaked documents go, personal data is
masked, and what remains is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from zonecast.llm import decontam, packing, pii, quality, simhash
from zonecast.llm.common import stored
from zonecast.session import prepare


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on the labelled ones."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: three-word shingles, at most three differing bits."""
    return simhash.one_per_group(docs)


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by marks."""
    return pii.mask(docs, pii.train(docs))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 1024-token sequences with their token ids; the last stage."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", duplicates_stage),
    ("benchmark decontamination", leaks_stage),
    ("personal data", personal_stage),
    ("packing", pack_stage),
]

#: model fitting, SimHash components and byte-pair merges have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
