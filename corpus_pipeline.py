"""The training-data pipeline: documents through a list of stages, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from muster.llm.exact_dedup import drop_copies
from muster.llm.mixing import mix
from muster.llm.packing import pack
from muster.llm.quality import passing
from muster.llm.simhash import drop_near_copies
from muster.plans.session import tune
from muster.plans.staging import Staging


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return passing(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return drop_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints stays."""
    return drop_near_copies(docs, shingle=4, max_bits=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as it is drawn; some go, some are repeated."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all that is left, packed into sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), sequence=2048, end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("mixing sources", source_mix),
    ("packing", packing),
]

#: Cutting stock, random rounding and 64-bit hashing are outside SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table ``documents``; what lies between is deleted on the way."""
    staging = Staging(tune(spark))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [f"{at}-{name.replace(' ', '-')}" for at, (name, _) in enumerate(STAGES)]
    for at, (_, stage) in enumerate(STAGES):
        docs = staging.keep(stage(spark, docs, sf_dir), names[at])
        if at:
            staging.drop(names[at - 1])
    return docs
